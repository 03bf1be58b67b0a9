"""Sources: message streams (Kafka, files), the metadata table, JSON batches,
and the device view of the shared test tables."""

from pulsegrid.sources.files import json_messages, message_file_stream, read_json_lines, text_file_stream
from pulsegrid.sources.kafka import kafka_lines, kafka_messages
from pulsegrid.sources.tables import read_metadata, read_table

__all__ = [
    "json_messages",
    "message_file_stream",
    "read_json_lines",
    "text_file_stream",
    "kafka_lines",
    "kafka_messages",
    "read_metadata",
    "read_table",
]
