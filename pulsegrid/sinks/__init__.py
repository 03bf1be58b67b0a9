"""Sinks: routed keyed tables (idempotent per micro-batch, or under one commit), latest-per-key
view and merged tables, ordered range reads, row-by-row writer, console, CSV files."""

from pulsegrid.sinks.commits import committed_routed_writer, committed_writer, read_committed
from pulsegrid.sinks.foreach import RowWriter, foreach_writer, read_rows
from pulsegrid.sinks.keyed import merge_table, newest_readings, read_merged, readings_between, write_ordered
from pulsegrid.sinks.misc import console_writer, csv_file_writer
from pulsegrid.sinks.tables import (
    batch_directory_writer,
    latest_by_key,
    read_batch_table,
    routed_table_writer,
    write_batch,
)

__all__ = [
    "RowWriter",
    "committed_routed_writer",
    "committed_writer",
    "foreach_writer",
    "merge_table",
    "newest_readings",
    "read_committed",
    "read_merged",
    "read_rows",
    "readings_between",
    "write_ordered",
    "console_writer",
    "csv_file_writer",
    "batch_directory_writer",
    "latest_by_key",
    "read_batch_table",
    "routed_table_writer",
    "write_batch",
]
