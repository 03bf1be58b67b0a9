"""Kafka endpoints, kept thin: the only module that names the connector.

The connector jar is not on the test machine, so these are exercised through
the file sources in :mod:`pulsegrid.sources.files`, which yield the same
columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import MAX_OFFSETS_PER_TRIGGER


def kafka_messages(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str | None = None,
    max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming ``(key STRING, value STRING, seq BIGINT)`` from one topic.

    ``seq`` is the Kafka offset; messages of one key share a partition, so it
    orders a device's messages and breaks ties in event time.
    ``max_offsets_per_trigger`` bounds each micro-batch, which is what bounds
    the per-device work of the stateful operators (also after an outage).
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
    )
    if starting_offsets is not None:
        reader = reader.option("startingOffsets", starting_offsets)
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    raw = reader.load()
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("offset").alias("seq"),
    )


def kafka_lines(
    spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str = "latest"
) -> DataFrame:
    """Streaming ``value STRING`` only (text line stream)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )
