"""Streaming entries: start queries with an explicit checkpoint each.

Every function takes a streaming input DataFrame (broker or file source with
``key, value[, seq]``), builds the same pure DataFrame plan as the batch form
and starts one query. ``trigger`` is passed through (e.g.
``{"availableNow": True}`` in tests, ``{"processingTime": "30 seconds"}`` in
production).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.config import AVERAGE_WATERMARK, AVERAGE_WINDOW, DEDUP_WATERMARK
from pulsegrid.operators.decode import decode_events, malformed_messages
from pulsegrid.operators.validate import good_records
from pulsegrid.plans.pipelines import average_lines, good_table_rows, ingest_readings, session_lines, window_averages
from pulsegrid.sinks.commits import committed_routed_writer
from pulsegrid.sinks.foreach import foreach_writer
from pulsegrid.sinks.tables import batch_directory_writer, routed_table_writer
from pulsegrid.streaming.sliced import activity_stream, device_sessions_sliced_stream
from pulsegrid.streaming.state import device_sessions_stream


def _start(writer, checkpoint: str, trigger: dict | None, name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def _routed(good_path: str, error_path: str, compat_key: bool, commits: str | None):
    if commits:
        return committed_routed_writer(good_path, error_path, commits, compat_key)
    return routed_table_writer(good_path, error_path, compat_key)


def start_row_writer(
    messages: DataFrame,
    metadata: DataFrame,
    path: str,
    checkpoint: str,
    watermark: str = DEDUP_WATERMARK,
    trigger: dict | None = None,
    **join_opts,
) -> StreamingQuery:
    """Entry 1 into one table, row by row: the good rows through
    :class:`pulsegrid.sinks.foreach.RowWriter`."""
    ingested = ingest_readings(messages, metadata, watermark=watermark, **join_opts)
    return foreach_writer(good_table_rows(good_records(ingested)), path, checkpoint, trigger=trigger)


def start_ingest(
    messages: DataFrame,
    metadata: DataFrame,
    good_path: str,
    error_path: str,
    checkpoint: str,
    watermark: str = DEDUP_WATERMARK,
    compat_key: bool = False,
    trigger: dict | None = None,
    name: str | None = None,
    commits: str | None = None,
    **join_opts,
) -> StreamingQuery:
    """Entry 1: decode, validate, watermark, de-duplicate, routed tables.
    ``commits``: folder of a commit log that makes both tables of a batch visible at once
    (:mod:`pulsegrid.sinks.commits`)."""
    ingested = ingest_readings(messages, metadata, watermark=watermark, **join_opts)
    writer = ingested.writeStream.outputMode("update").foreachBatch(_routed(good_path, error_path, compat_key, commits))
    return _start(writer, checkpoint, trigger, name)


def start_window_average(
    messages: DataFrame,
    metadata: DataFrame,
    out_path: str,
    checkpoint: str,
    window: str = AVERAGE_WINDOW,
    watermark: str = DEDUP_WATERMARK,
    output_mode: str = "append",
    trigger: dict | None = None,
    name: str | None = None,
    **join_opts,
) -> StreamingQuery:
    """Entry 2 in one query: de-duplication and average share one watermark
    (a second watermark on the same column is refused by Spark). ``append``
    writes each window once, when the watermark passes its end; ``update``
    rewrites a window as it changes (read with the latest-per-key view)."""
    ingested = ingest_readings(messages, metadata, watermark=watermark, **join_opts)
    averages = window_averages(ingested, window=window)
    writer = averages.writeStream.outputMode(output_mode).foreachBatch(batch_directory_writer(out_path))
    return _start(writer, checkpoint, trigger, name)


def start_dedup_table(
    messages: DataFrame,
    metadata: DataFrame,
    path: str,
    checkpoint: str,
    watermark: str = DEDUP_WATERMARK,
    trigger: dict | None = None,
    name: str | None = None,
    **join_opts,
) -> StreamingQuery:
    """First hop of the two-hop average: validated, de-duplicated readings
    appended to a Parquet table through the file sink (exactly once through
    its log; a stream reading the table sees each row once)."""
    ingested = ingest_readings(messages, metadata, watermark=watermark, **join_opts)
    writer = ingested.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer, checkpoint, trigger, name)


def readings_table_stream(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream over a table written by :func:`start_dedup_table`."""
    from pulsegrid.schemas import VALIDATED_READING

    reader = spark.readStream.schema(VALIDATED_READING)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def start_window_average_from_table(
    table_stream: DataFrame,
    out_path: str,
    checkpoint: str,
    window: str = AVERAGE_WINDOW,
    watermark: str = AVERAGE_WATERMARK,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Entry 2, second hop: average from a stream of already de-duplicated,
    validated readings, with its own (shorter) watermark."""
    averages = window_averages(table_stream, window=window, watermark=watermark)
    writer = averages.writeStream.outputMode("append").foreachBatch(batch_directory_writer(out_path))
    return _start(writer, checkpoint, trigger, name)


def start_tables_from_readings(
    table_stream: DataFrame,
    good_path: str,
    error_path: str,
    checkpoint: str,
    compat_key: bool = False,
    trigger: dict | None = None,
    name: str | None = None,
    commits: str | None = None,
) -> StreamingQuery:
    """Good and error tables from a stream of already de-duplicated, validated
    readings: no state of its own. ``commits`` as in :func:`start_ingest`."""
    writer = table_stream.writeStream.outputMode("append").foreachBatch(_routed(good_path, error_path, compat_key, commits))
    return _start(writer, checkpoint, trigger, name)


def start_malformed(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    """Messages that the decoders leave out, with the reason, to a table."""
    writer = malformed_messages(messages).writeStream.outputMode("append").foreachBatch(batch_directory_writer(path))
    return _start(writer, checkpoint, trigger, name)


def start_sessions(
    messages: DataFrame,
    out_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    sliced: bool = False,
    **session_opts,
) -> StreamingQuery:
    """Entry 3: status events to closed device sessions (update mode). ``sliced``: in two levels, for devices
    that send a large share of a trigger, with the options of :func:`device_sessions_sliced_stream`."""
    form = device_sessions_sliced_stream if sliced else device_sessions_stream
    sessions = form(decode_events(messages), **session_opts)
    writer = sessions.writeStream.outputMode("update").foreachBatch(batch_directory_writer(out_path))
    return _start(writer, checkpoint, trigger, name)


def start_activity(
    messages: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None, name: str | None = None, **activity_opts
) -> StreamingQuery:
    """When each device was last active and since when, per change (update
    mode); the latest row per device stands (:func:`latest_by_key`)."""
    writer = activity_stream(decode_events(messages), **activity_opts).writeStream
    return _start(writer.outputMode("update").foreachBatch(batch_directory_writer(out_path)), checkpoint, trigger, name)


def average_line_stream(
    messages: DataFrame,
    metadata: DataFrame,
    window: str = AVERAGE_WINDOW,
    watermark: str = DEDUP_WATERMARK,
    **join_opts,
) -> DataFrame:
    """Entry 2 as Kafka-shaped ``value`` lines ``[start,end],deviceid,variableid,avg``."""
    ingested = ingest_readings(messages, metadata, watermark=watermark, **join_opts)
    return average_lines(window_averages(ingested, window=window))


def average_line_stream_from_table(
    table_stream: DataFrame, window: str = AVERAGE_WINDOW, watermark: str = AVERAGE_WATERMARK
) -> DataFrame:
    """The same lines from a stream of already de-duplicated readings."""
    return average_lines(window_averages(table_stream, window=window, watermark=watermark))


def session_line_stream(messages: DataFrame, **session_opts) -> DataFrame:
    """Entry 3 as Kafka-shaped ``value`` lines ``deviceid,start,end,DEAD``, in two levels (options of
    :func:`device_sessions_sliced_stream`)."""
    return session_lines(device_sessions_sliced_stream(decode_events(messages), **session_opts))


def start_lines_to_kafka(
    lines: DataFrame,
    bootstrap_servers: str,
    topic: str,
    checkpoint: str,
    output_mode: str = "update",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """The reference's two topic writers (averages, sessions): update mode,
    explicit checkpoint."""
    writer = (
        lines.select("value")
        .writeStream.format("kafka")
        .outputMode(output_mode)
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
    )
    return _start(writer, checkpoint, trigger, name)


def await_any(spark, timeout: float | None = None) -> None:
    """Wait until any active query ends; a failing query is seen at once."""
    spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()
