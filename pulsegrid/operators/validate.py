"""Metadata validation: one metadata row per device, lookup by device id,
compare connector id, write the result text.

Join strategy. ``auto`` (the default) joins plainly where the plan's size estimate of the lookup is within
the session's broadcast threshold: Spark broadcasts it then. Beyond that both sides are shuffled, and a device with a large share
of all readings would be one task (adaptive execution does not split it where the
lookup is an aggregate on the join key in the same stage). So heavy devices are found by a bounded summary,
and they alone are salted: over as many tasks as their rows need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import (
    DEFAULT_SALT_BUCKETS,
    RESULT_CONNECTOR_MISMATCH,
    RESULT_DEVICE_NOT_FOUND,
    RESULT_SUCCESS,
    ROWS_PER_SALT,
)

HEAVY_DEVICES = 1_000  # devices that may be salted
TRACKED_DEVICES = 10_000  # counters of the summary; a device is missed only below rows / so many
BROADCAST_LIMIT = 1 << 30  # bytes beyond which a lookup is not broadcast, whatever the caller asks


def latest_metadata(metadata: DataFrame, order_col: str = "row_order") -> DataFrame:
    """One row per device: the row with the greatest ``order_col`` wins (the
    last row in scan order). ``order_col`` must be unique per device.

    ``max_by`` is a declarative aggregate, so it is computed partially before
    the shuffle: a device with many rows costs one row per task.
    """
    others = [c for c in metadata.columns if c != "deviceid"]
    latest = (
        metadata.filter(F.col("deviceid").isNotNull())
        .groupBy("deviceid")
        .agg(F.max_by(F.struct(*others), F.col(order_col)).alias("_m"))
    )
    return latest.select("deviceid", *[F.col(f"_m.{c}").alias(c) for c in others])


def _lookup(metadata: DataFrame, order_col: str | None) -> DataFrame:
    """Device and connector of the last row per device: two integers, so the
    aggregate stays a hash aggregate."""
    columns = [F.col("deviceid").alias("_m_deviceid"), F.col("connectorid").alias("_m_connectorid"), F.lit(True).alias("_m_found")]
    if not order_col:
        return metadata.select(*columns)
    known = metadata.filter(F.col("deviceid").isNotNull())
    return known.groupBy("deviceid").agg(F.max_by("connectorid", order_col).alias("connectorid")).select(*columns)


def validation_result(connectorid: Column, m_connectorid: Column, found: Column) -> Column:
    """``Success`` when the device is known and the connector matches;
    ``Connector id mismatch`` when known but the connector differs (a null
    connector included); otherwise ``deviceid not found in metadata``."""
    return (
        F.when(found.isNull(), F.lit(RESULT_DEVICE_NOT_FOUND))
        .when(m_connectorid == connectorid, F.lit(RESULT_SUCCESS))
        .otherwise(F.lit(RESULT_CONNECTOR_MISMATCH))
    )


def hot_devices(readings: DataFrame, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``_hot, _salts`` of devices with more than about ``rows_per_salt`` readings: as
    many salts as their rows need.

    Counted by a frequent-items summary of at most ``TRACKED_DEVICES`` counters per task, merged into one row: no
    shuffle by device and no count of all devices. At most ``HEAVY_DEVICES`` rows, so it
    is safe to broadcast. Counts are estimates; they decide how rows are spread, never a result.
    """
    top = readings.filter(F.col("deviceid").isNotNull()).agg(
        F.expr(f"approx_top_k(deviceid, {HEAVY_DEVICES}, {TRACKED_DEVICES})").alias("top")
    )
    found = top.select(F.inline("top")).select(F.col("item").alias("_hot"), F.col("count").alias("_n"))
    return found.filter(F.col("_n") > rows_per_salt).select(
        "_hot", F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_salts")
    )


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a static table's plan; runs no job. A table of unknown size counts as huge."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_threshold(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes (-1: never)."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def _salted(readings: DataFrame, lookup: DataFrame, rows_per_salt: int, salt_buckets: int) -> DataFrame:
    """Left join on device and salt. Batch: only hot devices are salted, and
    only their metadata rows are repeated. Stream: every device, over
    ``salt_buckets``, as the shares of a trigger are not known beforehand."""
    if readings.isStreaming:
        salts, left = F.lit(int(salt_buckets)), readings
        right = lookup.withColumn("_salts", F.lit(int(salt_buckets)))
    else:
        hot = F.broadcast(hot_devices(readings, rows_per_salt))
        left = readings.join(hot, F.col("deviceid") == F.col("_hot"), "left")
        salts = F.coalesce("_salts", F.lit(1))
        right = lookup.join(hot, F.col("_m_deviceid") == F.col("_hot"), "left").drop("_hot")
        right = right.withColumn("_salts", F.coalesce("_salts", F.lit(1)))
    left = left.withColumn("_salt", F.pmod(F.xxhash64("eventtime", "variableid", "value"), salts).cast("int"))
    right = right.withColumn("_m_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    match = (F.col("deviceid") == F.col("_m_deviceid")) & (F.col("_salt") == F.col("_m_salt"))
    return left.drop("_hot", "_salts").join(right, match, "left")


def join_strategy(lookup: DataFrame, strategy: str) -> str:
    """``plain``, ``broadcast`` or ``salted``, by the lookup's estimated size."""
    if strategy == "auto":
        return "plain" if estimated_bytes(lookup) <= broadcast_threshold(lookup.sparkSession) else "salted"
    if strategy == "broadcast" and estimated_bytes(lookup) > BROADCAST_LIMIT:
        return "salted"
    if strategy not in ("plain", "broadcast", "salted"):
        raise ValueError(f"unknown join strategy: {strategy}")
    return strategy


def validate_readings(
    readings: DataFrame,
    metadata: DataFrame,
    strategy: str = "auto",
    rows_per_salt: int = ROWS_PER_SALT,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
    order_col: str | None = "row_order",
) -> DataFrame:
    """Readings plus ``result``. Works on a batch or a streaming ``readings``
    (stream-static left join); ``metadata`` is a static snapshot. Only builds
    a plan: no job runs here.

    ``strategy``: ``auto`` (``plain`` where the lookup's estimated size is within the
    broadcast threshold, else ``salted``), ``plain`` (a left join as Spark plans it), ``broadcast`` (a
    hint, if the estimate is within ``BROADCAST_LIMIT``; else ``salted``) or ``salted``.
    ``order_col``: metadata column giving the scan order for the last-row-wins
    rule; ``None`` when the metadata already has one row per device.
    """
    lookup = _lookup(metadata, order_col)
    match = F.col("deviceid") == F.col("_m_deviceid")
    chosen = join_strategy(lookup, strategy)
    if chosen == "plain":
        joined = readings.join(lookup, match, "left")
    elif chosen == "broadcast":
        joined = readings.join(F.broadcast(lookup), match, "left")
    else:
        joined = _salted(readings, lookup, rows_per_salt, salt_buckets)
    result = validation_result(F.col("connectorid"), F.col("_m_connectorid"), F.col("_m_found"))
    return joined.select(*[F.col(c) for c in readings.columns], result.alias("result"))


def is_good(result: str | Column = "result") -> Column:
    """Trimmed, lower-cased result equals ``success``; never null."""
    c = F.col(result) if isinstance(result, str) else result
    return F.coalesce(F.lower(F.trim(c)) == F.lit("success"), F.lit(False))


def good_records(validated: DataFrame) -> DataFrame:
    return validated.filter(is_good())


def error_records(validated: DataFrame) -> DataFrame:
    return validated.filter(~is_good())
