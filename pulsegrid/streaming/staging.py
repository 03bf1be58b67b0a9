"""Cut a derived table into time-ordered files for file-stream tests and the
streaming queries of the catalogue (the stand-in for a broker topic)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import drop_folder, new_scratch_dir

ROWS_PER_PART = 50_000  # rows of a table that one file holds before it becomes messages

def write_time_slices(
    rows: DataFrame,
    time_col: str,
    path: str,
    n_slices: int,
    to_messages: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "parquet",
    only: Sequence[int] | None = None,
    number: int | None = None,
    carry: str | None = None,
    carried: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Write ``rows`` as ``n_slices`` equal event-time ranges, oldest first,
    one write per slice into ``{path}/slice=NNNN`` (so file modification times
    follow event time, which is the order a file stream reads them in).

    ``to_messages`` turns each slice into what is written (e.g. the keyed
    message log). Only ``min``/``max`` of the time column reach the driver.
    Returns the number of files of each slice: read with
    ``maxFilesPerTrigger`` set to it, each micro-batch takes one slice.
    ``only``: write just these slice numbers (e.g. to add input to a running
    or restarted stream later), ``number``: under this number instead.
    The rows are dealt to parts of ``ROWS_PER_PART`` once, whatever files the table has, so that
    each slice is made, and later read, by many tasks. All slices get the same number of files (empty ones
    fill up), else a trigger would take files of the next slice and bring the rest of it behind the watermark.
    ``carry``: what ``carried`` makes of the rows in the last such stretch of a
    slice arrives with the next slice, of all others with their own.
    """
    spark = rows.sparkSession
    bounds = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.unix_micros(F.col(time_col).cast("timestamp"))).alias("lo"),
        F.max(F.unix_micros(F.col(time_col).cast("timestamp"))).alias("hi"),
    ).first()
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    width = max(1, (hi - lo) // n_slices + 1)
    slice_no = F.floor((F.unix_micros(F.col(time_col).cast("timestamp")) - F.lit(lo)) / F.lit(width)).cast("int")
    dealt = new_scratch_dir(spark, "slices")
    numbered = rows.withColumn("_slice", slice_no).filter(F.col("_slice").isNotNull())
    numbered.repartition(-(-bounds["n"] // ROWS_PER_PART)).write.mode("overwrite").partitionBy("_slice").parquet(dealt)
    rows = spark.read.schema(numbered.schema).parquet(dealt)
    of_slice = lambda i: rows.filter(F.col("_slice") == i).drop("_slice")
    parts = -(-bounds["n"] // (ROWS_PER_PART * n_slices))
    files = parts if carry is None else 2 * parts + 1
    for i in range(n_slices) if only is None else only:
        own = of_slice(i)
        part = own.repartition(parts)
        if carry is not None:
            end = F.timestamp_micros(F.lit(lo + (i + 1) * width))
            stays = own if i == n_slices - 1 else own.filter(F.col(time_col) < end - F.expr(f"interval {carry}"))
            before = of_slice(i - 1).filter(
                F.col(time_col) >= F.timestamp_micros(F.lit(lo + i * width)) - F.expr(f"interval {carry}")
            )
            part = to_messages(part, with_duplicates=False).unionByName(carried(stays.repartition(parts)))
            part = part.unionByName(carried(before.coalesce(1)))
        elif to_messages is not None:
            part = to_messages(part)
        target = f"{path.rstrip('/')}/slice={i if number is None else number:04d}"
        part.write.mode("overwrite").format(fmt).save(target)
        fill_up(spark, part.schema, target, files, fmt)
    drop_folder(spark, dealt)
    return files


def write_numbered_slices(rows: DataFrame, slice_col: str, path: str, numbers: Sequence[int], n_files: int) -> None:
    """Write the rows of each slice number into ``{path}/slice=N``, one slice after another, ``n_files`` files each."""
    for i in numbers:
        part = rows.filter(F.col(slice_col) == i).drop(slice_col).coalesce(n_files)
        target = f"{path.rstrip('/')}/slice={i}"
        part.write.mode("overwrite").parquet(target)
        fill_up(rows.sparkSession, part.schema, target, n_files)


def fill_up(spark, schema, target: str, files: int, fmt: str = "parquet") -> None:
    """Add empty files to a slice that has fewer than ``files``."""
    for _ in range(files - _count_data_files(spark, target)):
        spark.createDataFrame([], schema).coalesce(1).write.mode("append").format(fmt).save(target)


def _count_data_files(spark, target: str) -> int:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(target)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(1 for st in fs.listStatus(jpath) if not st.getPath().getName().startswith(("_", ".")))
