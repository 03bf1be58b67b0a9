"""Query catalogue over the shared test tables: ``name -> (spark, sf_dir) ->
DataFrame``. Every query reads ``events`` / ``customer`` / ``documents`` (or
data Spark derives from them) in full.

Output conventions (shared with :mod:`pulsegrid.plans.oracle`): times leave
as ``timestamp_ntz``, averages as ``round(.., 6)``, binary keys as upper-case
hex text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import (
    AVERAGE_WINDOW,
    CSV_COUNT_WINDOW,
    DEDUP_WATERMARK,
    DEVICE_COUNT_WINDOW,
    SESSION_TIMEOUT,
    VARIABLE_COUNT_WINDOW,
    micros,
    new_scratch_dir,
    use_utc,
)
from pulsegrid.functions.rowkey import row_key_hex
from pulsegrid.operators.aggregate import csv_window_count, key_count, last_seen, window_count, word_count
from pulsegrid.operators.decode import (
    cast_messages,
    decode_events,
    decode_readings,
    flatten_readings,
    malformed_messages,
)
from pulsegrid.operators.ordering import event_order
from pulsegrid.operators.sessions import coded_events, device_sessions
from pulsegrid.operators.validate import error_records, good_records, latest_metadata, validate_readings
from pulsegrid.plans.pipelines import (
    average_lines,
    error_table_rows,
    good_table_rows,
    ingest_readings,
    session_lines,
    window_averages,
    word_count_lines,
)
from pulsegrid.schemas import READING_MESSAGE, REPORT
from pulsegrid.sinks.keyed import newest_readings, readings_between, write_ordered
from pulsegrid.sinks.tables import latest_by_key
from pulsegrid.sources import testbed
from pulsegrid.sources.files import read_json_lines
from pulsegrid.sources.tables import read_metadata, read_table

Query = Callable[[SparkSession, str], DataFrame]


def _ntz(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp_ntz")


def _reading_out(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select(
        "name",
        "timeseries",
        "connectorid",
        "deviceid",
        _ntz("eventtime").alias("eventtime"),
        "variableid",
        "value",
        *extra,
    )


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.message_log(spark, sf_dir)


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.device_metadata(spark, sf_dir)


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_readings(_messages(spark, sf_dir), _metadata(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_events(_messages(spark, sf_dir))


def _averages_out(avg: DataFrame) -> DataFrame:
    return avg.select(
        _ntz("window.start").alias("window_start"),
        _ntz("window.end").alias("window_end"),
        "deviceid",
        "variableid",
        F.round("avg_value", 6).alias("avg_value"),
    )


def _count_out(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return df.select(
        _ntz("window.start").alias("window_start"),
        _ntz("window.end").alias("window_end"),
        *keys,
        "count",
    )


def _sessions_out(df: DataFrame) -> DataFrame:
    return df.select(
        "connectorid",
        "deviceid",
        _ntz("activeStartTime").alias("activeStartTime"),
        _ntz("activeEndTime").alias("activeEndTime"),
        "deviceactive",
    )


# --- decode -----------------------------------------------------------------


def q_decode_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reading_out(decode_readings(_messages(spark, sf_dir)))


def q_decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select("connectorid", "deviceid", _ntz("eventtime").alias("eventtime"), "status", "seq")


def q_malformed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return malformed_messages(_messages(spark, sf_dir)).select("key", "seq", "reason")


def q_multi_value_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reading_out(decode_readings(testbed.multi_value_log(spark, sf_dir)))


def q_json_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading bodies written as JSON lines, read back with the fixed schema."""
    path = new_scratch_dir(spark, "json-batch")
    msgs = _messages(spark, sf_dir)
    msgs.filter(F.col("key").endswith(",1")).select("value").write.mode("overwrite").text(path)
    return _reading_out(flatten_readings(read_json_lines(spark, path, READING_MESSAGE)))


def q_binary_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and values as bytes, as a broker delivers them."""
    raw = _messages(spark, sf_dir).select(F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"), "seq")
    return _reading_out(decode_readings(cast_messages(raw)))


def q_metadata_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata table written (wider types, another column) and read through the reader."""
    path = new_scratch_dir(spark, "metadata")
    wide = _metadata(spark, sf_dir).withColumn("deviceid", F.col("deviceid").cast("bigint")).withColumn("note", F.lit("x"))
    wide.write.mode("overwrite").parquet(path)
    return read_metadata(spark, path)


def q_nested_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested ``Report.tl[]`` documents built from ``events`` and exploded."""
    use_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    doc = F.to_json(
        F.struct(
            F.lit(None).cast("string").alias("ErrorMessage"),
            F.lit(False).alias("IsError"),
            F.struct(
                F.array(
                    F.struct(F.concat(F.lit("F"), F.col("event_id").cast("string")).alias("TlID"), F.col("event_type").alias("CID")),
                    F.struct(F.concat(F.lit("K"), F.col("event_id").cast("string")).alias("TlID"), F.col("event_type").alias("CID")),
                ).alias("tl")
            ).alias("Report"),
        )
    )
    parsed = ev.select(F.from_json(doc, REPORT).alias("j"))
    return parsed.select(F.explode("j.Report.tl").alias("t")).select(
        F.col("t.TlID").alias("TlID"), F.col("t.CID").alias("CID")
    )


# --- metadata and validation ------------------------------------------------


def q_metadata_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_metadata(_metadata(spark, sf_dir))


def q_validate_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate_readings(decode_readings(_messages(spark, sf_dir)), _metadata(spark, sf_dir))
    return _reading_out(v, ("result",))


def q_validate_readings_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same result through the salted shuffle join (the path taken when the
    metadata is too large to broadcast)."""
    v = validate_readings(decode_readings(_messages(spark, sf_dir)), _metadata(spark, sf_dir), strategy="salted")
    return _reading_out(v, ("result",))


def q_validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_count(_ingested(spark, sf_dir), ("result",))


def q_dedup_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reading_out(_ingested(spark, sf_dir), ("result",))


def q_good_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = good_table_rows(good_records(_ingested(spark, sf_dir)))
    return rows.withColumn("row_key", F.hex("row_key"))


def q_error_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = error_table_rows(error_records(_ingested(spark, sf_dir)))
    return rows.withColumn("row_key", F.hex("row_key"))


def q_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = testbed.device_events(spark, sf_dir)
    return ev.select(
        "deviceid",
        "connectorid",
        _ntz("eventtime").alias("eventtime"),
        "variableid",
        row_key_hex(compat=True).alias("row_key_compat"),
        row_key_hex().alias("row_key"),
    )


def q_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert view of the good table under the 17-byte key: two variables per
    message share a key; the greatest variable id (then value) wins."""
    msgs = testbed.multi_value_log(spark, sf_dir)
    ingested = ingest_readings(msgs, _metadata(spark, sf_dir))
    rows = good_table_rows(good_records(ingested), compat_key=True)
    latest = latest_by_key(rows, "row_key", ["VARIABLEID", "VALUE"])
    return latest.withColumn("row_key", F.hex("row_key"))


def newest_device(readings: DataFrame) -> tuple[int, int]:
    """Device and connector of the reading with the greatest key time, ties by device."""
    r = readings.orderBy(F.desc("eventtime"), "deviceid", "connectorid").select("deviceid", "connectorid").first()
    return r["deviceid"], r["connectorid"]


def q_newest_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings stored in key order; the 20 newest of the device that was heard last."""
    readings = decode_readings(_messages(spark, sf_dir)).dropDuplicates()
    path = new_scratch_dir(spark, "ordered")
    write_ordered(good_table_rows(readings), path)
    newest = newest_readings(spark, path, *newest_device(readings), 20)
    return newest.withColumn("row_key", F.hex("row_key"))


def q_readings_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table; the readings of that device in a given week."""
    readings = decode_readings(_messages(spark, sf_dir)).dropDuplicates()
    path = new_scratch_dir(spark, "ordered")
    write_ordered(good_table_rows(readings), path)
    first = 1_704_672_000_000  # 2024-01-08
    week = readings_between(spark, path, *newest_device(readings), first, first + 7 * 86_400_000 - 1)
    return week.withColumn("row_key", F.hex("row_key"))


# --- aggregations -----------------------------------------------------------


def q_window_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _averages_out(window_averages(_ingested(spark, sf_dir), window=AVERAGE_WINDOW))


def q_window_avg_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _averages_out(window_averages(_ingested(spark, sf_dir), window="6 hours"))


def q_window_avg_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older variant's average: 10-minute windows."""
    return _averages_out(window_averages(_ingested(spark, sf_dir), window="10 minutes"))


def _average_fields(lines: DataFrame) -> DataFrame:
    parts = F.split("value", ",")
    return lines.select(
        F.concat_ws(",", F.get(parts, 0), F.get(parts, 1)).alias("window_text"),
        F.get(parts, 2).cast("int").alias("deviceid"),
        F.get(parts, 3).alias("variableid"),
        F.round(F.get(parts, 4).cast("double"), 6).alias("avg_value"),
    )


def q_window_avg_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped average lines, parsed back into fields for comparison."""
    return _average_fields(average_lines(window_averages(_ingested(spark, sf_dir), window=AVERAGE_WINDOW)))


def q_window_count_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = decode_readings(_messages(spark, sf_dir))
    return _count_out(window_count(readings, DEVICE_COUNT_WINDOW, keys=("deviceid",)), ("deviceid",))


def q_window_count_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = good_records(_ingested(spark, sf_dir))
    keys = ("deviceid", "variableid")
    return _count_out(window_count(good, VARIABLE_COUNT_WINDOW, keys=keys), keys)


def q_device_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_count(good_records(_ingested(spark, sf_dir)), ("deviceid",))


def q_last_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    ls = last_seen(_events(spark, sf_dir))
    return ls.select("connectorid", "deviceid", _ntz("last_eventtime").alias("last_eventtime"))


def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(testbed.document_lines(spark, sf_dir))


def q_word_count_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts as Kafka-shaped lines."""
    return word_count_lines(word_count(testbed.document_lines(spark, sf_dir)))


def q_csv_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = csv_window_count(testbed.csv_lines(spark, sf_dir), CSV_COUNT_WINDOW)
    return _count_out(counts, ("value",))


# --- sessions ---------------------------------------------------------------


def q_device_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions_out(device_sessions(_events(spark, sf_dir)))


def timeout_horizon(events: DataFrame) -> int:
    """Epoch microseconds up to which a stream with the default watermark knows silence: its last ALIVE or DEAD, less the delay."""
    last = coded_events(events).agg(F.max("_t")).first()[0]
    return (last or 0) - micros(DEDUP_WATERMARK)


def q_device_sessions_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that silence ends too."""
    events = _events(spark, sf_dir)
    return _sessions_out(device_sessions(events, timeout=SESSION_TIMEOUT, until=timeout_horizon(events)))


def q_device_sessions_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a log in which one device sends nine tenths of the events."""
    return _sessions_out(device_sessions(decode_events(testbed.messages_from_events(testbed.skewed_events(spark, sf_dir)))))


def q_event_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = event_order(_events(spark, sf_dir))
    return ordered.select(
        "connectorid", "deviceid", _ntz("eventtime").alias("eventtime"), "status", "seq", "event_order"
    )


def q_session_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_lines(device_sessions(_events(spark, sf_dir)))


def batch_queries() -> dict[str, Query]:
    return {
        "decode_readings": q_decode_readings,
        "decode_events": q_decode_events,
        "malformed_messages": q_malformed_messages,
        "multi_value_readings": q_multi_value_readings,
        "json_batch": q_json_batch,
        "binary_messages": q_binary_messages,
        "metadata_read": q_metadata_read,
        "nested_report": q_nested_report,
        "metadata_latest": q_metadata_latest,
        "validate_readings": q_validate_readings,
        "validate_readings_salted": q_validate_readings_salted,
        "validation_counts": q_validation_counts,
        "dedup_readings": q_dedup_readings,
        "good_readings": q_good_readings,
        "error_readings": q_error_readings,
        "row_key": q_row_key,
        "latest_by_key": q_latest_by_key,
        "newest_readings": q_newest_readings,
        "readings_between": q_readings_between,
        "window_avg": q_window_avg,
        "window_avg_6h": q_window_avg_6h,
        "window_avg_10m": q_window_avg_10m,
        "window_avg_line": q_window_avg_line,
        "window_count_device": q_window_count_device,
        "window_count_variable": q_window_count_variable,
        "device_count": q_device_count,
        "last_seen": q_last_seen,
        "word_count": q_word_count,
        "word_count_line": q_word_count_line,
        "csv_window_count": q_csv_window_count,
        "device_sessions": q_device_sessions,
        "session_line": q_session_line,
        "event_order": q_event_order,
        "device_sessions_timeout": q_device_sessions_timeout,
        "device_sessions_skewed": q_device_sessions_skewed,
    }


def all_queries() -> dict[str, Query]:
    """Batch and streaming queries."""
    from pulsegrid.plans.stream_catalog import stream_queries

    return batch_queries() | stream_queries()
