"""Windowed and keyed aggregations.

All are declarative aggregates: Spark computes them partially per task before
the shuffle, so a hot key costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import AVERAGE_WINDOW, CSV_COUNT_WINDOW, DEVICE_COUNT_WINDOW
from pulsegrid.functions.text import csv_line_fields, split_words


def window_average(
    good: DataFrame,
    window: str = AVERAGE_WINDOW,
    watermark: str | None = None,
    keys: Sequence[str] = ("deviceid", "variableid"),
    time_col: str = "eventtime",
) -> DataFrame:
    """Average ``value`` per tumbling window and key: ``window, *keys, avg_value``."""
    df = good.withWatermark(time_col, watermark) if watermark else good
    return df.groupBy(F.window(time_col, window).alias("window"), *keys).agg(F.avg("value").alias("avg_value"))


def window_count(
    df: DataFrame,
    window: str = DEVICE_COUNT_WINDOW,
    watermark: str | None = None,
    keys: Sequence[str] = ("deviceid",),
    time_col: str = "eventtime",
) -> DataFrame:
    """Row count per tumbling window and key: ``window, *keys, count``."""
    src = df.withWatermark(time_col, watermark) if watermark else df
    return src.groupBy(F.window(time_col, window).alias("window"), *keys).agg(F.count(F.lit(1)).alias("count"))


def key_count(df: DataFrame, keys: Sequence[str] = ("deviceid",)) -> DataFrame:
    """Row count per key: ``*keys, count``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def last_seen(df: DataFrame, keys: Sequence[str] = ("connectorid", "deviceid"), time_col: str = "eventtime") -> DataFrame:
    """Latest event time per key: ``*keys, last_eventtime``."""
    return df.groupBy(*keys).agg(F.max(time_col).alias("last_eventtime"))


def words(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row per space-separated word: ``value``."""
    return lines.select(F.explode(split_words(col)).alias("value"))


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Count per word: ``value, count``."""
    return key_count(words(lines, col), ("value",))


def parse_csv_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``text,time`` lines to ``value, generated_timestamp``; lines whose time
    does not parse are dropped (see :func:`malformed_csv_lines`)."""
    text, ts = csv_line_fields(col)
    return lines.select(text.alias("value"), ts.alias("generated_timestamp")).filter(
        F.col("generated_timestamp").isNotNull()
    )


def malformed_csv_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    _, ts = csv_line_fields(col)
    return lines.filter(ts.isNull()).select(F.col(col).alias("value"))


def csv_window_count(
    lines: DataFrame, window: str = CSV_COUNT_WINDOW, watermark: str | None = None, col: str = "value"
) -> DataFrame:
    """Count per tumbling window and line text: ``window, value, count``."""
    parsed = parse_csv_lines(lines, col)
    return window_count(parsed, window, watermark, keys=("value",), time_col="generated_timestamp")
