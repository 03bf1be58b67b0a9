"""Composed plans: the reference's three entries (readings to tables,
windowed averages, device sessions) as pure DataFrame functions, and the
query catalogue over the shared test tables."""

from pulsegrid.plans.pipelines import (
    average_lines,
    good_table_rows,
    error_table_rows,
    ingest_readings,
    session_lines,
    validated_readings,
    window_averages,
)

__all__ = [
    "average_lines",
    "good_table_rows",
    "error_table_rows",
    "ingest_readings",
    "session_lines",
    "validated_readings",
    "window_averages",
]
