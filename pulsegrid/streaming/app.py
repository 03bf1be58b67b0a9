"""The streaming application: start the queries and wait.

    python -m pulsegrid.streaming.app --kafka broker:9092 --topic telemetry \\
        --metadata /tables/devices --tables /tables --checkpoints /chk \\
        --window-topic averages --session-topic sessions

1. ingest: readings decoded, validated and de-duplicated once, into one table;
2. from that table: the good and the error table;
3. from that table: windowed averages with a delay of their own, as lines to
   a topic or as a table;
4. device sessions, as lines to a topic or as a table;
5. malformed messages, to a table.

``--files DIR`` reads ``key, value, seq`` Parquet files instead of Kafka (one
file per trigger); topics need ``--kafka``. ``--available-now`` processes what
is there and stops.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from pulsegrid.config import (
    AVERAGE_WATERMARK,
    AVERAGE_WINDOW,
    DEDUP_WATERMARK,
    MAX_OFFSETS_PER_TRIGGER,
    apply_cluster_conf,
    make_folder,
    use_utc,
)
from pulsegrid.sources.files import message_file_stream
from pulsegrid.sources.kafka import kafka_messages
from pulsegrid.sources.tables import read_metadata
from pulsegrid.streaming.queries import (
    average_line_stream_from_table,
    await_any,
    readings_table_stream,
    session_line_stream,
    start_dedup_table,
    start_lines_to_kafka,
    start_malformed,
    start_sessions,
    start_tables_from_readings,
    start_window_average_from_table,
)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="pulsegrid.streaming.app")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="directory of key/value/seq Parquet files")
    p.add_argument("--topic", default=None, help="input topic (with --kafka)")
    p.add_argument("--max-offsets-per-trigger", type=int, default=MAX_OFFSETS_PER_TRIGGER)
    p.add_argument("--max-files-per-trigger", type=int, default=1)
    p.add_argument("--metadata", required=True, help="metadata table path (Parquet)")
    p.add_argument("--tables", required=True, help="root folder of the output tables")
    p.add_argument("--checkpoints", required=True, help="root folder of the query checkpoints")
    p.add_argument("--window-topic", default=None)
    p.add_argument("--session-topic", default=None)
    p.add_argument("--window", default=AVERAGE_WINDOW)
    p.add_argument("--dedup-watermark", default=DEDUP_WATERMARK)
    p.add_argument("--average-watermark", default=AVERAGE_WATERMARK)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--commit-log", action="store_true", help="make good and error rows of a batch visible at once")
    p.add_argument("--session-timeout", default=None, help="end sessions of devices silent for longer, e.g. '2 days'")
    args = p.parse_args(argv)
    if args.kafka and not args.topic:
        p.error("--kafka needs --topic")
    if args.files and (args.topic or args.window_topic or args.session_topic):
        p.error("topics need --kafka")
    return args


def start_all(spark: SparkSession, args: argparse.Namespace) -> list:
    """Start the queries; returns them. With ``--available-now`` the ingest
    has ended before the queries that read its table start."""
    use_utc(spark)
    if args.kafka:
        msgs = kafka_messages(spark, args.kafka, args.topic, max_offsets_per_trigger=args.max_offsets_per_trigger)
    else:
        msgs = message_file_stream(spark, args.files, max_files_per_trigger=args.max_files_per_trigger)
    meta = read_metadata(spark, args.metadata)
    trigger = {"availableNow": True} if args.available_now else None
    t, c = args.tables.rstrip("/"), args.checkpoints.rstrip("/")
    queries = [
        start_dedup_table(
            msgs, meta, f"{t}/readings", f"{c}/ingest", watermark=args.dedup_watermark, trigger=trigger, name="ingest"
        ),
        start_malformed(msgs, f"{t}/malformed", f"{c}/malformed", trigger=trigger, name="malformed"),
    ]
    if args.available_now:
        queries[0].awaitTermination()
    make_folder(spark, f"{t}/readings")  # a stream can't start on a table that is not there yet
    readings = readings_table_stream(spark, f"{t}/readings")
    queries.append(
        start_tables_from_readings(
            readings, f"{t}/good", f"{t}/error", f"{c}/tables", trigger=trigger, name="tables",
            commits=f"{t}/commits" if args.commit_log else None,
        )
    )
    if args.window_topic:
        lines = average_line_stream_from_table(readings, window=args.window, watermark=args.average_watermark)
        queries.append(start_lines_to_kafka(lines, args.kafka, args.window_topic, f"{c}/averages", trigger=trigger))
    else:
        queries.append(
            start_window_average_from_table(
                readings, f"{t}/averages", f"{c}/averages", window=args.window,
                watermark=args.average_watermark, trigger=trigger, name="averages",
            )
        )
    if args.session_topic:
        lines = session_line_stream(msgs, timeout=args.session_timeout)
        queries.append(start_lines_to_kafka(lines, args.kafka, args.session_topic, f"{c}/sessions", trigger=trigger))
    else:
        queries.append(
            start_sessions(
                msgs, f"{t}/sessions", f"{c}/sessions", trigger=trigger, name="sessions", sliced=True, timeout=args.session_timeout
            )
        )
    return queries


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = apply_cluster_conf(SparkSession.builder.appName("pulsegrid")).getOrCreate()
    queries = start_all(spark, args)
    if args.available_now:
        for q in queries:
            q.awaitTermination()
    else:
        await_any(spark)


if __name__ == "__main__":
    main()
