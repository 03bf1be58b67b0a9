from __future__ import annotations

import random

import duckdb
import pytest

from pulsegrid.llm import catalog
from pulsegrid.llm.line_dedup import dedup_lines

SCHEMA = "doc_id long, text string, i int, a long, first string, gone int"


def brute(rows):
    order = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0]))
    seen, out = set(), {}
    for i, t in order:
        lines = t.split("\n")
        cover = set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if not "".join(w).strip(" \t\r\x0b\x0c"):
                continue
            if w in seen:
                cover.update((k, k + 1, k + 2))
            seen.add(w)
        out[i, t] = (i, len(lines), len(cover), "\n".join(x for k, x in enumerate(lines) if k not in cover))
    return [out.get((i, t), (i, 0, 0, None)) for i, t in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " ", "long é line"]) for _ in range(rng.randrange(1, 14)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "\n\n\n\n\n"), (203, "q\nr\ns"), (204, "q\nr\ns"), (205, "x\n" * 20_000), (206, "q\nr"), (None, "a\nb\nc\na"),
             (207, "u\nv\nw"), (207, "u\nv\nw")]
    docs = spark.createDataFrame([(i, t, 1, 2, "f", 3) for i, t in rows], SCHEMA).repartition(4)
    got = sorted(map(tuple, dedup_lines(docs).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_sql_and_empty(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, catalog.op5_line_dedup(spark, sf).collect()))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    assert got == sorted(con.sql(catalog.LINE_DEDUP_SQL).fetchall())
    assert dedup_lines(spark.createDataFrame([(1, "a", 1, 2, "f", 3)], SCHEMA).limit(0)).count() == 0


def skewed_plan(spark, build):
    """The final plan of a query run with one small partition size, nothing broadcast."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k",
    }
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = build()
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in confs:
            spark.conf.unset(k)


def test_a_hot_window_is_split(spark):
    """One window in half of the rows: its join partition is cut by adaptive execution."""
    from pyspark.sql import functions as F

    from pulsegrid.llm.line_dedup import repeated_stretches

    docs = spark.range(0, 12_000, 1, 12).select(
        F.col("id").alias("doc_id"), F.col("id").alias("tie"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c")))
        .otherwise(F.array(*(F.concat(F.lit(x), (F.col("id") % 3000).cast("string")) for x in "xyz"))).alias("lines"),
    )
    assert "skew=true" in skewed_plan(spark, lambda: repeated_stretches(docs))
