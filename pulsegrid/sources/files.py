"""File-backed sources with the same columns as the Kafka ones, and JSON reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pulsegrid.schemas import LINE, MESSAGE


def message_file_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = 1,
    schema: T.StructType = MESSAGE,
) -> DataFrame:
    """Streaming ``(key, value, seq)`` from files dropped into ``path``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def text_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Streaming ``value STRING`` lines from text files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(LINE.fieldNames())


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Batch JSON read with an explicit schema (one document per line)."""
    return spark.read.schema(schema).json(path)


def json_messages(spark: SparkSession, documents: Iterable[str]) -> DataFrame:
    """A small local collection of JSON strings as a ``value`` column, ready for
    ``from_json``; for samples and hand cases only."""
    return spark.createDataFrame([(d,) for d in documents], LINE)
