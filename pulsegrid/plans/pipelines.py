"""The reference's entries as DataFrame functions (batch or stream input).

Order of the ingest chain (kept from the reference): decode, validate,
watermark, de-duplicate, then split good and error records; the watermark
sits before the good filter, so error records advance it too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import AVERAGE_WINDOW
from pulsegrid.functions.rowkey import row_key
from pulsegrid.functions.text import session_line, table_time_text, window_line
from pulsegrid.operators.aggregate import window_average
from pulsegrid.operators.decode import decode_readings
from pulsegrid.operators.dedup import drop_duplicate_readings
from pulsegrid.operators.validate import good_records, validate_readings


def validated_readings(messages: DataFrame, metadata: DataFrame, **join_opts) -> DataFrame:
    """Messages to readings with ``result``."""
    return validate_readings(decode_readings(messages), metadata, **join_opts)


def ingest_readings(
    messages: DataFrame,
    metadata: DataFrame,
    watermark: str | None = None,
    include_result: bool | None = None,
    **join_opts,
) -> DataFrame:
    """Decoded, validated, de-duplicated readings (Entry 1 up to the sink).

    ``include_result`` (default: on for batch input) adds ``result`` to the
    de-duplication key. It is a function of the key's device and connector,
    so the result is the same, and a later good/error filter then runs before
    the de-duplication's shuffle instead of after it.
    """
    validated = validated_readings(messages, metadata, **join_opts)
    if include_result is None:
        include_result = not messages.isStreaming
    return drop_duplicate_readings(validated, watermark=watermark, include_result=include_result)


def window_averages(
    ingested: DataFrame, window: str = AVERAGE_WINDOW, watermark: str | None = None
) -> DataFrame:
    """Average per window, device and variable over the good records
    (Entry 2). On a stream whose input already carries a watermark (the
    de-duplication's), pass ``watermark=None``: a second watermark on the same
    column is refused by Spark."""
    return window_average(good_records(ingested), window=window, watermark=watermark)


def _table_columns(compat_key: bool) -> list:
    return [
        F.col("connectorid").alias("CONNECTORID"),
        F.col("deviceid").alias("DEVICEID"),
        table_time_text("eventtime").alias("EVENTTIME"),
        F.col("variableid").alias("VARIABLEID"),
        F.col("value").alias("VALUE"),
        row_key(compat=compat_key).alias("row_key"),
    ]


def good_table_rows(ingested: DataFrame, compat_key: bool = False) -> DataFrame:
    """Rows of the good table: ``CONNECTORID, DEVICEID, EVENTTIME (text),
    VARIABLEID, VALUE, row_key``."""
    return ingested.select(*_table_columns(compat_key))


def error_table_rows(ingested: DataFrame, compat_key: bool = False) -> DataFrame:
    """Rows of the error table: good-table columns plus ``RESULT``."""
    return ingested.select(*_table_columns(compat_key), F.col("result").alias("RESULT"))


def average_lines(averages: DataFrame) -> DataFrame:
    """``value`` lines ``[start,end],deviceid,variableid,avg`` (Kafka-shaped)."""
    return averages.select(window_line().alias("value"))


def session_lines(sessions: DataFrame) -> DataFrame:
    """``value`` lines ``deviceid,start,end,state`` (Kafka-shaped)."""
    return sessions.select(session_line().alias("value"))


def word_count_lines(counts: DataFrame) -> DataFrame:
    """``value`` lines ``word,count`` (word counts to a topic, complete mode)."""
    return counts.select(F.concat_ws(",", F.col("value"), F.col("count").cast("string")).alias("value"))
