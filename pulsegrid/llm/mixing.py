"""Mixing sources to target weights.

Sizes are summed per source; the sources, by code point with null last, weigh
1, 2, 3, repeating, and share the whole size. No target exceeds ``MAX_REPEATS`` times its
source's size; what is beyond is shared again by weight until no target is. The repetition rate of a
source is its target over its size; each document is emitted floor(rate)
times, plus one copy if a number drawn from a hash of seed and id falls below
the fraction. Reruns give the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import stored, with_positions, word_count

MAX_REPEATS = 3
SEED = "mix-1"
DRAW_DIGITS = 13  # hex digits of the hash: 52 bits, exact in a double


def draw(doc_id: str, seed: str = SEED) -> Column:
    """A number in [0, 1) from seed and id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    number = F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("long").cast("double")
    return number / F.lit(float(16**DRAW_DIGITS))


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size`` to the same plus ``weight, target, rate``.

    The water level (target per weight) is found by rounds: every round
    fixes the sources that the level would lift beyond their bound, and shares
    what is left among the others. Each round is one aggregate over the
    source table; the driver holds the level only. A source without words has
    target 0 and rate 1.
    """
    ranked = with_positions(
        sizes.withColumn("_null", F.col("source").isNull()).withColumn("_one", F.lit(1)),
        ["_null", "source"], "_one", "_rank", "mix-sources",
    )
    ranked = stored(
        ranked.select("source", "source_size", ((F.col("_rank") - 1) % 3 + 1).cast("long").alias("weight")),
        "mix-weights",
    )
    bound = F.col("source_size") * max_repeats
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, beyond = None, F.lit(False)
    while True:
        fixed = ranked.agg(
            F.sum(F.when(beyond, bound)).alias("fixed"), F.sum(F.when(~beyond, F.col("weight"))).alias("weight")
        ).first()
        share = fixed["weight"] or 0
        now = float(total - (fixed["fixed"] or 0)) / float(share) if share else level
        if now is None or now == level:
            break
        level = now
        beyond = F.col("weight") * F.lit(level) > bound
    level = 0.0 if level is None else level
    lifted = F.col("weight") * F.lit(level)
    target = F.when(lifted > bound, bound.cast("double")).otherwise(lifted)
    return ranked.withColumn("target", target).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    )


def plan_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    seed: str = SEED, max_repeats: int = MAX_REPEATS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size,
    target, rate, copies`` and the columns ``keep``.

    Size is the number of words, 0 for a null text. Null sources are one
    source, the last. Rows that repeat count each and draw alike; null ids draw
    as empty ids. An empty table gives an empty result. Sources are joined by
    a join that adaptive execution broadcasts when the source table is
    measured small, and splits where a source is hot otherwise.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
    )
    if not keep:
        sized = stored(sized, "mix-sizes")  # the texts are read once
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, max_repeats).withColumnRenamed("source", "_source")
    whole = F.floor("rate")
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("copies", (whole + (draw("doc_id", seed) < F.col("rate") - whole).cast("long")).cast("long"))
        .select(
            "doc_id", "source", "size", "source_size", "target", "rate", "copies",
            *[F.col(f"_keep_{c}").alias(f"_keep_{c}") for c in keep],
        )
    )


def mix(docs: DataFrame, seed: str = SEED, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed documents: every row of ``docs``, all columns, as many times
    as :func:`plan_mix` says. Needs ``doc_id``, ``text`` and ``source``."""
    keep = tuple(docs.columns)
    planned = plan_mix(docs, seed=seed, max_repeats=max_repeats, keep=keep)
    times = F.array_repeat(F.lit(1), F.col("copies").cast("int"))
    copied = planned.filter("copies > 0").withColumn("_copy", F.explode(times))
    return copied.select(*[F.col(f"_keep_{c}").alias(c) for c in keep])
