"""Table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.schemas import METADATA


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan of a small file (one row group is one task) over the
    cores, at the price of a shuffle: for staging in tests and benchmarks.
    Queries do not call it."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def dealt(df: DataFrame, rows_per_part: int = 50_000) -> DataFrame:
    """Deal the rows of a table to parts of about so many, where its files give fewer (one row group is one
    task): what is derived from each row then runs in tasks whose size does not grow with the table."""
    parts = -(-df.count() // rows_per_part)
    return df if parts <= df.rdd.getNumPartitions() else df.repartition(parts)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a test-data folder (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_metadata(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Device metadata table, full scan, seven typed fields plus ``row_order``.

    The table is a snapshot taken when a query starts; it is read once per
    query plan, never per row.
    """
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in METADATA.fields])
