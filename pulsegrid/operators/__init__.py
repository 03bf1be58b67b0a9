"""DataFrame operators: same functions for batch and streaming inputs."""

from pulsegrid.operators.aggregate import (
    csv_window_count,
    key_count,
    last_seen,
    parse_csv_lines,
    window_average,
    window_count,
    word_count,
    words,
)
from pulsegrid.operators.decode import cast_messages, decode_events, decode_readings, malformed_messages, route
from pulsegrid.operators.dedup import drop_duplicate_events, drop_duplicate_readings
from pulsegrid.operators.sessions import device_sessions
from pulsegrid.operators.validate import error_records, good_records, latest_metadata, validate_readings

__all__ = [
    "csv_window_count",
    "key_count",
    "last_seen",
    "parse_csv_lines",
    "window_average",
    "window_count",
    "word_count",
    "words",
    "cast_messages",
    "decode_events",
    "decode_readings",
    "malformed_messages",
    "route",
    "drop_duplicate_events",
    "drop_duplicate_readings",
    "device_sessions",
    "error_records",
    "good_records",
    "latest_metadata",
    "validate_readings",
]
