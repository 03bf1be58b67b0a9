"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import drop_folder, write_scratch
from pulsegrid.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every end of a link (a, b): root is the least node
    that links reach.

    Alternates two steps until nothing changes: every node hands the least
    node it knows to its larger neighbours (large star), then to its smaller ones
    (small star). Both replace a link by a link to the least neighbour, so the
    table never grows. The least neighbours are stored before the links are joined with them:
    both sides of that join are then plain shuffles, of which adaptive execution splits the
    partition of a hub. Each round is stored: a lost executor repeats no earlier round; tables
    of rounds that are over are removed.
    """
    spark = links.sparkSession
    edges, folder = write_scratch(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    sign = lambda table: table.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    before = sign(edges)
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, least_at = write_scratch(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, large_at = write_scratch(large.filter("u <> v").distinct(), "large-star")
        down, down_at = write_scratch(large.groupBy("u").agg(F.min("v").alias("m")), "down")
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(down.select("u", F.col("m").alias("v"))).filter("u <> v")
        small, small_at = write_scratch(
            small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small-star"
        )
        for over in (least_at, large_at, down_at, folder):
            drop_folder(spark, over)
        edges, folder, after = small, small_at, sign(small)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = stored(roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct(), "roots")
    drop_folder(spark, folder)
    return roots
