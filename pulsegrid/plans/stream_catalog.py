"""Streaming queries of the catalogue.

Each one stages the message log derived from the test tables as time-ordered
files in the shared scratch folder, runs the streaming plan over them, one
time slice per trigger (``availableNow``, state carried across), and returns
the table that the query wrote. Their results must equal the batch queries' (same SQL
oracle), except where a watermark holds a window back (stated per query).

The ``run_*`` functions return a :class:`Run` with the table, the seconds of
the stream alone and its progress; the queries return its table.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import (
    CSV_COUNT_WATERMARK,
    CSV_COUNT_WINDOW,
    DEVICE_COUNT_WATERMARK,
    DEVICE_COUNT_WINDOW,
    IDLE_TIME,
    RESULT_SUCCESS,
    SESSION_TIMEOUT,
    VARIABLE_COUNT_WATERMARK,
    VARIABLE_COUNT_WINDOW,
    list_folder,
    new_scratch_dir,
    use_utc,
)
from pulsegrid.operators.aggregate import csv_window_count, parse_csv_lines, window_count, word_count
from pulsegrid.operators.decode import decode_events, decode_readings
from pulsegrid.operators.dedup import drop_duplicate_events
from pulsegrid.operators.validate import good_records
from pulsegrid.plans.catalog import _average_fields, _averages_out, _count_out, _sessions_out
from pulsegrid.plans.pipelines import good_table_rows, ingest_readings
from pulsegrid.schemas import LINE, MESSAGE
from pulsegrid.sinks.commits import read_committed
from pulsegrid.sinks.foreach import read_rows
from pulsegrid.sinks.keyed import merge_table, read_merged
from pulsegrid.sinks.misc import csv_file_writer
from pulsegrid.sinks.tables import BATCH_COLUMNS, batch_directory_writer, latest_by_key, read_batch_table
from pulsegrid.sources import testbed
from pulsegrid.sources.files import message_file_stream
from pulsegrid.sources.tables import read_table
from pulsegrid.streaming.queries import (
    average_line_stream,
    readings_table_stream,
    session_line_stream,
    start_activity,
    start_dedup_table,
    start_ingest,
    start_malformed,
    start_row_writer,
    start_sessions,
    start_tables_from_readings,
    start_window_average,
    start_window_average_from_table,
)
from pulsegrid.streaming.staging import ROWS_PER_PART, write_numbered_slices, write_time_slices

N_FILES = 4  # time slices staged per streaming query (one micro-batch each)
AVAILABLE_NOW = {"availableNow": True}


@dataclass
class Run:
    """What a finished streaming query leaves."""

    table: DataFrame
    seconds: float
    progress: list[dict] = field(default_factory=list)


def _finish(*starts: Callable) -> tuple[float, list[dict]]:
    """Start the queries one after another, each when the one before has
    ended; seconds and progress of all of them."""
    began, progress = time.perf_counter(), []
    for start in starts:
        query = start()
        query.awaitTermination()
        if query.exception() is not None:  # pragma: no cover
            raise RuntimeError(str(query.exception()))
        progress += query.recentProgress
    return time.perf_counter() - began, progress


def stage_messages(
    spark: SparkSession, sf_dir: str, root: str, n_slices: int = N_FILES, late: bool = False, rows: DataFrame | None = None
) -> tuple[str, int]:
    """The keyed log in time slices. A duplicate of a reading of the last nine
    minutes of a slice arrives with the next one: within the watermark, but in
    a later micro-batch, so only kept state can drop it. ``late``: a last
    slice repeats the first one's rows with other values, all behind the watermark.
    ``rows``: events to take instead of the table's."""
    path = f"{root}/input"
    rows = testbed.device_events(spark, sf_dir) if rows is None else rows
    per_slice = write_time_slices(
        rows, "eventtime", path, n_slices, to_messages=testbed.messages_from_events, carry="9 minutes",
        carried=testbed.duplicates_from_events,
    )
    if late:
        first = rows.withColumn("value", F.col("value") + 1000)
        write_time_slices(first, "eventtime", path, n_slices, to_messages=testbed.messages_from_events, only=[0], number=n_slices)
    return path, per_slice


def staged_stream(spark: SparkSession, staged: tuple[str, int]) -> DataFrame:
    path, per_slice = staged
    return message_file_stream(spark, f"{path}/slice=*", schema=MESSAGE, max_files_per_trigger=per_slice)


def files_per_slice(log: DataFrame) -> int:
    return max(1, -(-log.count() // (ROWS_PER_PART * N_FILES)))


def _table(spark: SparkSession, path: str) -> DataFrame:
    return read_batch_table(spark, path).drop(*BATCH_COLUMNS)


def _update_query(counts: DataFrame, root: str, mode: str = "update", only_last: bool = False):
    return (
        counts.writeStream.outputMode(mode)
        .foreachBatch(batch_directory_writer(f"{root}/out", only_last=only_last))
        .option("checkpointLocation", f"{root}/chk")
        .trigger(availableNow=True)
        .start()
    )


def _latest_counts(spark: SparkSession, root: str, keys: tuple[str, ...]) -> DataFrame:
    table = read_batch_table(spark, f"{root}/out").select(
        F.col("window.start").alias("ws"), F.col("window.end").alias("we"), *keys, "count", "batch_id"
    )
    latest = latest_by_key(table, ["ws", "we", *keys], ["batch_id"])
    return _count_out(latest.select(F.struct(F.col("ws").alias("start"), F.col("we").alias("end")).alias("window"), *keys, "count"), keys)


def _hex_key(table: DataFrame) -> DataFrame:
    return table.withColumn("row_key", F.hex("row_key"))


def run_ingest(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None, which: str = "good") -> Run:
    """Entry 1 on a stream; the good or the error table, ``row_key`` as hex."""
    use_utc(spark)
    root = new_scratch_dir(spark, "ingest")
    staged = staged or stage_messages(spark, sf_dir, root)
    seconds, progress = _finish(
        lambda: start_ingest(
            staged_stream(spark, staged), testbed.device_metadata(spark, sf_dir),
            f"{root}/good", f"{root}/error", f"{root}/chk", trigger=AVAILABLE_NOW,
        )
    )
    return Run(_hex_key(_table(spark, f"{root}/{which}")), seconds, progress)


def run_ingest_error(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """The error table, as the application makes it: readings de-duplicated
    into a table once, good and error tables from there."""
    use_utc(spark)
    root = new_scratch_dir(spark, "ingest-error")
    staged = staged or stage_messages(spark, sf_dir, root)
    meta = testbed.device_metadata(spark, sf_dir)
    seconds, progress = _finish(
        lambda: start_dedup_table(staged_stream(spark, staged), meta, f"{root}/readings", f"{root}/chk1", trigger=AVAILABLE_NOW),
        lambda: start_tables_from_readings(
            readings_table_stream(spark, f"{root}/readings"), f"{root}/good", f"{root}/error", f"{root}/chk2",
            trigger=AVAILABLE_NOW,
        ),
    )
    return Run(_hex_key(_table(spark, f"{root}/error")), seconds, progress)


def run_malformed(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    use_utc(spark)
    root = new_scratch_dir(spark, "malformed")
    staged = staged or stage_messages(spark, sf_dir, root)
    seconds, progress = _finish(
        lambda: start_malformed(staged_stream(spark, staged), f"{root}/out", f"{root}/chk", trigger=AVAILABLE_NOW)
    )
    return Run(_table(spark, f"{root}/out").select("key", "seq", "reason"), seconds, progress)


def run_window_avg(
    spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None, late: bool = False
) -> Run:
    """Entry 2 on a stream in append mode: windows whose end the 10-minute
    watermark has passed (``window_end <= max(eventtime) - 10 minutes``)."""
    use_utc(spark)
    root = new_scratch_dir(spark, "average")
    staged = staged or stage_messages(spark, sf_dir, root, late=late)
    seconds, progress = _finish(
        lambda: start_window_average(
            staged_stream(spark, staged), testbed.device_metadata(spark, sf_dir), f"{root}/out", f"{root}/chk",
            trigger=AVAILABLE_NOW,
        )
    )
    return Run(_averages_out(_table(spark, f"{root}/out")), seconds, progress)


def run_late_rows(spark: SparkSession, sf_dir: str) -> Run:
    """The same averages when rows behind the watermark arrive at the end:
    they change no window."""
    return run_window_avg(spark, sf_dir, late=True)


def run_window_avg_two_hop(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """Entry 2 as two hops, each with its own watermark: de-duplicate (10
    minutes) into a table, then average the good records from that table
    (3 minutes). Append mode: windows with
    ``window_end <= max(good eventtime) - 3 minutes``."""
    use_utc(spark)
    root = new_scratch_dir(spark, "twohop")
    staged = staged or stage_messages(spark, sf_dir, root)
    meta = testbed.device_metadata(spark, sf_dir)
    seconds, progress = _finish(
        lambda: start_dedup_table(staged_stream(spark, staged), meta, f"{root}/readings", f"{root}/chk1", trigger=AVAILABLE_NOW),
        lambda: start_window_average_from_table(
            readings_table_stream(spark, f"{root}/readings"), f"{root}/out", f"{root}/chk2", trigger=AVAILABLE_NOW
        ),
    )
    return Run(_averages_out(_table(spark, f"{root}/out")), seconds, progress)


def run_window_count_variable(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """Good readings per 2-minute window, device and variable, from the
    de-duplicated table, 3-minute watermark, update mode; latest row per group."""
    use_utc(spark)
    root = new_scratch_dir(spark, "varcount")
    staged = staged or stage_messages(spark, sf_dir, root)
    meta, keys = testbed.device_metadata(spark, sf_dir), ("deviceid", "variableid")
    seconds, progress = _finish(
        lambda: start_dedup_table(staged_stream(spark, staged), meta, f"{root}/readings", f"{root}/chk1", trigger=AVAILABLE_NOW),
        lambda: _update_query(
            window_count(
                good_records(readings_table_stream(spark, f"{root}/readings")), VARIABLE_COUNT_WINDOW,
                VARIABLE_COUNT_WATERMARK, keys=keys,
            ),
            root,
        ),
    )
    return Run(_latest_counts(spark, root, keys), seconds, progress)


def run_device_sessions(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """Entry 3 on a stream: equals the batch sessions."""
    use_utc(spark)
    root = new_scratch_dir(spark, "sessions")
    staged = staged or stage_messages(spark, sf_dir, root)
    seconds, progress = _finish(
        lambda: start_sessions(staged_stream(spark, staged), f"{root}/out", f"{root}/chk", trigger=AVAILABLE_NOW)
    )
    return Run(_sessions_out(_table(spark, f"{root}/out")), seconds, progress)


def run_sliced_sessions(
    spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None, skewed: bool = True, **session_opts
) -> Run:
    """Entry 3 in two levels, over a log in which one device sends nine tenths of
    all events: equals the batch sessions of that log."""
    use_utc(spark)
    root = new_scratch_dir(spark, "sliced")
    rows = testbed.skewed_events(spark, sf_dir) if skewed else None
    staged = staged or stage_messages(spark, sf_dir, root, rows=rows)
    seconds, progress = _finish(
        lambda: start_sessions(
            staged_stream(spark, staged), f"{root}/out", f"{root}/chk", trigger=AVAILABLE_NOW, sliced=True, **session_opts
        )
    )
    return Run(_sessions_out(_table(spark, f"{root}/out")), seconds, progress)


def run_sessions_timeout(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """Sessions with event-time timers: silence ends them too. Equals the batch
    sessions with the same timeout up to the last watermark."""
    return run_sliced_sessions(spark, sf_dir, staged, skewed=False, timeout=SESSION_TIMEOUT)


def run_activity(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """Last activity of each device and the start of its present stretch; latest row per device."""
    use_utc(spark)
    root = new_scratch_dir(spark, "activity")
    staged = staged or stage_messages(spark, sf_dir, root)
    seconds, progress = _finish(
        lambda: start_activity(staged_stream(spark, staged), f"{root}/out", f"{root}/chk", trigger=AVAILABLE_NOW, idle=IDLE_TIME)
    )
    latest = latest_by_key(read_batch_table(spark, f"{root}/out"), ["connectorid", "deviceid"], ["batch_id"])
    return Run(
        latest.select(
            "connectorid", "deviceid", F.col("lastactivetime").cast("timestamp_ntz").alias("lastactivetime"),
            F.col("activetime").cast("timestamp_ntz").alias("activetime"),
        ),
        seconds, progress,
    )


def run_average_lines(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """The average's topic lines as the stream writes them, parsed into fields."""
    use_utc(spark)
    root = new_scratch_dir(spark, "average-lines")
    staged = staged or stage_messages(spark, sf_dir, root)
    meta = testbed.device_metadata(spark, sf_dir)
    seconds, progress = _finish(
        lambda: _update_query(average_line_stream(staged_stream(spark, staged), meta), root, mode="append")
    )
    return Run(_average_fields(_table(spark, f"{root}/out")), seconds, progress)


def run_session_lines(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """The sessions' topic lines as the stream writes them."""
    use_utc(spark)
    root = new_scratch_dir(spark, "session-lines")
    staged = staged or stage_messages(spark, sf_dir, root)
    seconds, progress = _finish(lambda: _update_query(session_line_stream(staged_stream(spark, staged)), root))
    return Run(_table(spark, f"{root}/out"), seconds, progress)


def run_window_count_device(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """Count per 10-minute window and device, 5-minute watermark, update mode;
    read back as the latest row per window and device."""
    use_utc(spark)
    root = new_scratch_dir(spark, "devcount")
    staged = staged or stage_messages(spark, sf_dir, root)
    seconds, progress = _finish(
        lambda: _update_query(
            window_count(
                decode_readings(staged_stream(spark, staged)), DEVICE_COUNT_WINDOW, DEVICE_COUNT_WATERMARK, keys=("deviceid",)
            ),
            root,
        )
    )
    return Run(_latest_counts(spark, root, ("deviceid",)), seconds, progress)


def run_event_dedup(spark: SparkSession, sf_dir: str) -> Run:
    """Status events, each sent twice in its slice, de-duplicated within the
    watermark; with the event time among the columns only true copies go."""
    use_utc(spark)
    root = new_scratch_dir(spark, "eventdedup")
    twice = lambda rows: testbed.messages_from_events(rows.unionByName(rows))
    per_slice = write_time_slices(testbed.device_events(spark, sf_dir), "eventtime", f"{root}/input", N_FILES, to_messages=twice)
    columns = ("connectorid", "deviceid", "status", "eventtime")
    seconds, progress = _finish(
        lambda: _update_query(
            drop_duplicate_events(decode_events(staged_stream(spark, (f"{root}/input", per_slice))), columns=columns),
            root, mode="append",
        )
    )
    table = _table(spark, f"{root}/out")
    return Run(table.select("connectorid", "deviceid", F.col("eventtime").cast("timestamp_ntz").alias("eventtime"), "status"), seconds, progress)


def run_csv_window_count(spark: SparkSession, sf_dir: str) -> Run:
    """Text lines counted per 2-minute window and text, 5-minute watermark,
    update mode; latest row per group."""
    use_utc(spark)
    root = new_scratch_dir(spark, "csvcount")
    events = read_table(spark, sf_dir, "events").withColumn("eventtime", F.col("ts").cast("timestamp"))
    per_slice = write_time_slices(events, "eventtime", f"{root}/input", N_FILES, to_messages=testbed.csv_from_events)
    lines = message_file_stream(spark, f"{root}/input/slice=*", schema=LINE, max_files_per_trigger=per_slice)
    seconds, progress = _finish(lambda: _update_query(csv_window_count(lines, CSV_COUNT_WINDOW, CSV_COUNT_WATERMARK), root))
    return Run(_latest_counts(spark, root, ("value",)), seconds, progress)


def run_csv_sink(spark: SparkSession, sf_dir: str) -> Run:
    """Parsed text lines appended as CSV files and read back."""
    use_utc(spark)
    root = new_scratch_dir(spark, "csvsink")
    events = read_table(spark, sf_dir, "events").withColumn("eventtime", F.col("ts").cast("timestamp"))
    per_slice = write_time_slices(events, "eventtime", f"{root}/input", N_FILES, to_messages=testbed.csv_from_events)
    lines = message_file_stream(spark, f"{root}/input/slice=*", schema=LINE, max_files_per_trigger=per_slice)
    seconds, progress = _finish(
        lambda: csv_file_writer(parse_csv_lines(lines), f"{root}/out", f"{root}/chk", trigger_available_now=True)
    )
    table = spark.read.schema("value string, generated_timestamp timestamp").csv(f"{root}/out")
    return Run(table.select("value", F.col("generated_timestamp").cast("timestamp_ntz").alias("generated_timestamp")), seconds, progress)


def run_word_count(spark: SparkSession, sf_dir: str) -> Run:
    """Word count over document lines, complete mode: the one batch kept holds
    the full counts."""
    root = new_scratch_dir(spark, "words")
    docs = read_table(spark, sf_dir, "documents").select(
        F.pmod(F.col("doc_id"), F.lit(N_FILES)).alias("slice"), F.col("text").alias("value")
    )
    # as many parts as the table's bytes ask for: no task holds a whole slice, and the counts of all batches do not
    # depend on which file a batch takes
    parts = max(1, docs.rdd.getNumPartitions())
    docs.repartition(parts).write.partitionBy("slice").mode("overwrite").parquet(f"{root}/input")
    files = sum(len(list_folder(spark, f"{root}/input/{s}")) for s in list_folder(spark, f"{root}/input"))
    lines = message_file_stream(spark, f"{root}/input/slice=*", schema=LINE, max_files_per_trigger=max(1, -(-files // N_FILES)))
    seconds, progress = _finish(lambda: _update_query(word_count(lines), root, mode="complete", only_last=True))
    return Run(_table(spark, f"{root}/out"), seconds, progress)


def run_latest_by_key(spark: SparkSession, sf_dir: str) -> Run:
    """Upsert view over a table that several micro-batches wrote: 17-byte
    keys, two variables per message, the greatest variable id wins."""
    use_utc(spark)
    root = new_scratch_dir(spark, "latest")
    log = testbed.multi_value_log(spark, sf_dir).withColumn("slice", F.coalesce(F.pmod(F.col("seq"), F.lit(N_FILES)), F.lit(0)))
    files = files_per_slice(log)
    write_numbered_slices(log, "slice", f"{root}/input", range(N_FILES), files)
    messages = message_file_stream(spark, f"{root}/input/slice=*", schema=MESSAGE, max_files_per_trigger=files)
    meta = testbed.device_metadata(spark, sf_dir)
    # batch order must not matter here: no watermark, so state is kept for the short run
    seconds, progress = _finish(
        lambda: start_ingest(messages, meta, f"{root}/good", f"{root}/error", f"{root}/chk", watermark="3650 days", compat_key=True, trigger=AVAILABLE_NOW)
    )
    latest = latest_by_key(read_batch_table(spark, f"{root}/good")).drop(*BATCH_COLUMNS)
    return Run(_hex_key(latest), seconds, progress)


def run_merged_by_key(spark: SparkSession, sf_dir: str) -> Run:
    """The same log, merged while it comes in: one row per key after a merge of the first half and one of the rest."""
    use_utc(spark)
    root = new_scratch_dir(spark, "merged")
    log = testbed.multi_value_log(spark, sf_dir).withColumn("slice", F.pmod(F.col("seq"), F.lit(N_FILES)))
    meta = testbed.device_metadata(spark, sf_dir)
    seconds, progress, files = 0.0, [], files_per_slice(log)
    for half in (range(N_FILES // 2), range(N_FILES // 2, N_FILES)):
        write_numbered_slices(log, "slice", f"{root}/input", half, files)
        messages = message_file_stream(spark, f"{root}/input/slice=*", schema=MESSAGE, max_files_per_trigger=files)
        took, steps = _finish(
            lambda messages=messages: start_ingest(messages, meta, f"{root}/good", f"{root}/error", f"{root}/chk", watermark="3650 days", compat_key=True, trigger=AVAILABLE_NOW)
        )
        merge_table(spark, f"{root}/good", f"{root}/merged")
        seconds, progress = seconds + took, progress + steps
    return Run(_hex_key(read_merged(spark, f"{root}/merged").drop(*BATCH_COLUMNS, "bucket")), seconds, progress)


def run_committed_tables(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """Entry 1 with good and error rows of each batch under one commit; both tables together."""
    use_utc(spark)
    root = new_scratch_dir(spark, "committed")
    staged = staged or stage_messages(spark, sf_dir, root)
    seconds, progress = _finish(
        lambda: start_ingest(
            staged_stream(spark, staged), testbed.device_metadata(spark, sf_dir), f"{root}/good", f"{root}/error",
            f"{root}/chk", commits=f"{root}/commits", trigger=AVAILABLE_NOW,
        )
    )
    good, error = (read_committed(spark, f"{root}/commits", name, f"{root}/{name}") for name in ("good", "error"))
    both = good.withColumn("RESULT", F.lit(RESULT_SUCCESS)).unionByName(error)
    return Run(_hex_key(both.drop(*BATCH_COLUMNS)), seconds, progress)


def run_foreach_writer(spark: SparkSession, sf_dir: str, staged: tuple[str, int] | None = None) -> Run:
    """Entry 1 into the good table row by row."""
    use_utc(spark)
    root = new_scratch_dir(spark, "foreach")
    staged = staged or stage_messages(spark, sf_dir, root)
    meta = testbed.device_metadata(spark, sf_dir)
    seconds, progress = _finish(
        lambda: start_row_writer(staged_stream(spark, staged), meta, f"{root}/out", f"{root}/chk", trigger=AVAILABLE_NOW)
    )
    schema = good_table_rows(ingest_readings(testbed.message_log(spark, sf_dir), meta)).schema
    return Run(_hex_key(read_rows(spark, f"{root}/out", schema).drop("epoch")), seconds, progress)


RUNS: dict[str, Callable[..., Run]] = {
    "ingest_stream_good": run_ingest,
    "ingest_stream_error": run_ingest_error,
    "malformed_stream": run_malformed,
    "window_avg_stream": run_window_avg,
    "late_rows_stream": run_late_rows,
    "window_avg_two_hop": run_window_avg_two_hop,
    "window_count_variable_stream": run_window_count_variable,
    "device_sessions_stream": run_device_sessions,
    "device_sessions_skewed_stream": run_sliced_sessions,
    "device_sessions_timeout_stream": run_sessions_timeout,
    "last_active_stream": run_activity,
    "average_line_stream": run_average_lines,
    "session_line_stream": run_session_lines,
    "window_count_device_stream": run_window_count_device,
    "event_dedup_stream": run_event_dedup,
    "csv_window_count_stream": run_csv_window_count,
    "csv_sink_stream": run_csv_sink,
    "word_count_stream": run_word_count,
    "latest_by_key_table": run_latest_by_key,
    "merged_by_key_table": run_merged_by_key,
    "committed_tables_stream": run_committed_tables,
    "foreach_writer_stream": run_foreach_writer,
}


def stream_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def query(run: Callable[..., Run]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: run(spark, sf_dir).table

    return {name: query(run) for name, run in RUNS.items()}
