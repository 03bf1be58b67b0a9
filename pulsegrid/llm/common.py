"""Helpers shared by the operators: tables in the shared folder, ordered
positions over a whole table, tokens, fixed hash folds."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.config import write_scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BATCH_BYTES = 8 << 20
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def stored(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: the
    lineage is cut, a lost executor rereads files instead of replaying work,
    and every consumer sees the same rows. ``file_rows``: of a file at most."""
    return write_scratch(df, label, file_rows)[0]


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until no column is called so (letter case aside)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: str | Column) -> Column:
    """A-Z lowered, every other character left alone."""
    return F.translate(F.col(text) if isinstance(text, str) else text, UPPER, UPPER.lower())


def word_count(text: str | Column) -> Column:
    """Number of words (runs of anything but ASCII white space); null: 0."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def id_remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: 0)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % n, F.lit(0)).cast("int")


def with_positions(df: DataFrame, order: list[str], value: str, out: str, label: str) -> DataFrame:
    """``df`` plus ``out``: the sum of ``value`` over all rows up to and with
    this one in the order of the columns ``order``.

    The rows are range-partitioned once and stored with their partition's
    number, so that every later step sees the same cuts. Sums of partitions
    (one row each) give each partition's offset; a window then runs inside
    the partitions only. ``order`` must tell all rows apart for ranges to be
    even.
    """
    ranged = stored(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label
    )
    totals = ranged.groupBy("_part").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_inside", F.sum(value).over(inside))
        .join(offsets, "_part")
        .withColumn(out, (F.col("_offset") + F.col("_inside")).cast("long"))
        .drop("_part", "_inside", "_offset")
    )


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``; from here on, Arrow batches of its session hold ``BATCH_BYTES`` at
    most (one row at least), whatever the length of texts. The number of rows per
    batch is left to the session."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


# --- inside Python tasks -------------------------------------------------


def trim() -> None:
    """Give free memory of this Python worker back to the machine: workers
    live on between tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def of_worker(name: str, key: tuple, make: Callable):
    """What this Python worker keeps under ``name`` and ``key``, made at first. Spark runs many tasks in one worker, and functions
    arrive anew with each task, so what outlives a task stands in a module of its own."""
    kept = sys.modules.setdefault("_pulsegrid_worker", ModuleType("_pulsegrid_worker")).__dict__
    if (name, *key) not in kept:
        kept[(name, *key)] = make()
    return kept[(name, *key)]


def release(but: str | None = None) -> None:
    """Drop what earlier tasks of other operators keep in this worker."""
    kept = getattr(sys.modules.get("_pulsegrid_worker"), "__dict__", {})
    for key in [k for k in kept if isinstance(k, tuple) and k[0] != but]:
        del kept[key]


def lean(work: Callable, keeps: str | None = None) -> Callable:
    """``work`` on a partition's batches, trimmed at its end. What other
    operators left in the worker is dropped first, but what is kept under the name ``keeps``."""

    def run(batches):
        release(keeps)
        try:
            yield from work(batches)
        finally:
            trim()

    return run


def text_bytes(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lowered; null as empty. Lone surrogates, which no
    valid UTF-8 column holds, would be replaced."""
    return b"" if text is None else text.encode("utf-8", "replace").lower()


class Vocabulary(dict):
    """Numbers words in the order in which they are first seen."""

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (splitmix64's finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, each distinct word hashed once."""
    import xxhash

    vocab = Vocabulary()
    index = np.fromiter(map(vocab.__getitem__, words), dtype=np.int64, count=len(words))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in vocab), dtype=np.uint64, count=len(vocab))
    return hashes[index] if len(words) else np.zeros(0, np.uint64)


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words (order matters)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n] + np.uint64(width))
    return out
