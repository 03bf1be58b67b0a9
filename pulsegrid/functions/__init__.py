"""Column expressions (JVM-side, inside whole-stage codegen)."""

from pulsegrid.functions.routing import message_flag, normalized_status
from pulsegrid.functions.rowkey import reverse_millis, row_key, row_key_hex, salt_byte
from pulsegrid.functions.text import (
    csv_line_fields,
    java_time_text,
    null_text,
    session_line,
    split_words,
    table_time_text,
    window_line,
)

__all__ = [
    "message_flag",
    "normalized_status",
    "reverse_millis",
    "row_key",
    "row_key_hex",
    "salt_byte",
    "csv_line_fields",
    "java_time_text",
    "null_text",
    "session_line",
    "split_words",
    "table_time_text",
    "window_line",
]
