"""Keyed tables on Parquet.

A micro-batch is written under ``{path}/query_id={Q}/batch_id={N}`` with
overwrite, where Q is the id that the query's checkpoint holds. A retried batch (after a
failure or an executor loss) so replaces its own output and nothing else; a new
checkpoint, whose batches start at 0 again, or a second query on the same table
never touches earlier rows. Upsert semantics of a key-value store (same row
key overwrites) are a read-side view: the latest row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.config import drop_folder, folder_exists, list_folder
from pulsegrid.operators.validate import error_records, good_records, is_good
from pulsegrid.plans.pipelines import error_table_rows, good_table_rows

ROWS_PER_FILE = 2_000_000
ONE_FILE_ROWS = 200_000  # what one task writes alone
BATCH_COLUMNS = ("query_id", "batch_id")


def query_id_of(batch: DataFrame) -> str:
    """Id of the streaming query that runs this micro-batch."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("not inside a streaming query: pass query_id")
    return found


def write_sized(df: DataFrame, folder: str, n_rows: int, fmt: str = "parquet") -> None:
    """Overwrite ``folder`` with ``df`` of ``n_rows`` rows: one file, or files by bytes where there are many."""
    sized = df.coalesce(1) if n_rows <= ONE_FILE_ROWS else df.hint("rebalance")
    out = sized.write.mode("overwrite").format(fmt)
    out.option("maxRecordsPerFile", ROWS_PER_FILE).save(folder)


def write_batch(
    df: DataFrame, path: str, batch_id: int, query_id: str | None = None, fmt: str = "parquet", n_rows: int | None = None
) -> None:
    """Overwrite the folder of one micro-batch with ``df`` (``n_rows``: its
    count, where the caller knows it).

    A batch of at most ``ONE_FILE_ROWS`` rows becomes one file; beyond, a
    ``rebalance`` hint lets adaptive execution size the files by bytes (else
    every trigger would leave one small file per shuffle partition). An empty batch writes nothing, unless it is the first, which leaves the
    table's schema, or an earlier attempt left rows to replace.
    """
    target = f"{path.rstrip('/')}/query_id={query_id or query_id_of(df)}/batch_id={int(batch_id)}"
    n = df.count() if n_rows is None else n_rows
    if batch_id and not n and not folder_exists(df.sparkSession, target):
        return
    write_sized(df, target, n, fmt)


def batch_directory_writer(path: str, fmt: str = "parquet", only_last: bool = False) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each micro-batch to its own folder.
    ``only_last`` (complete mode, where each batch holds the full result):
    earlier batches of the same query are removed once the new one stands."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        spark, query_id = batch.sparkSession, query_id_of(batch)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(batch, path, batch_id, query_id, fmt)
        finally:
            batch.unpersist()
        if only_last:
            own = f"{path.rstrip('/')}/query_id={query_id}"
            for name in list_folder(spark, own):
                if name != f"batch_id={batch_id}":
                    drop_folder(spark, f"{own}/{name}")

    return _write


def routed_table_writer(good_path: str, error_path: str, compat_key: bool = False) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for validated, de-duplicated readings:
    ``Success`` rows to the good table, all others to the error table (with
    ``RESULT``). The batch is persisted once and read by both writes."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        query_id = query_id_of(batch)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = batch.agg(F.count_if(is_good()).alias("good"), F.count(F.lit(1)).alias("all")).first()
            good = good_table_rows(good_records(batch), compat_key)
            error = error_table_rows(error_records(batch), compat_key)
            write_batch(good, good_path, batch_id, query_id, n_rows=counts["good"])
            write_batch(error, error_path, batch_id, query_id, n_rows=counts["all"] - counts["good"])
        finally:
            batch.unpersist()

    return _write


def compact_table(spark: SparkSession, path: str, target: str, fmt: str = "parquet") -> None:
    """Rewrite a batch table with few large files per query into ``target``
    (readers switch over; streams keep writing to ``path``). ``batch_id`` stays a column."""
    table = spark.read.format(fmt).load(path)
    out = table.hint("rebalance", "query_id").write.mode("overwrite").format(fmt)
    out.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("query_id").save(target)


def read_batch_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table written by :func:`write_batch`; ``batch_id`` becomes a column
    (partition pruning applies to filters on it)."""
    return spark.read.format(fmt).load(path)


def latest_by_key(
    table: DataFrame,
    key: str | Sequence[str] = "row_key",
    order: Sequence[str] = ("batch_id", "VARIABLEID", "VALUE"),
) -> DataFrame:
    """Latest row per key, ordered by ``order`` (those of its columns that the table has).

    Rows without a key (a null in a key column) name no row that could be
    replaced: they all stay. A ranking of which only the first is kept runs per
    task before the shuffle too, so a hot key costs one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    by = [F.col(c).desc() for c in order if c in table.columns]
    keyed = F.lit(True)
    for k in keys:
        keyed &= F.col(k).isNotNull()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    latest = table.filter(keyed).withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    return latest.unionByName(table.filter(~keyed))
