"""One commit for the tables of a micro-batch.

A batch that feeds several tables writes each into a folder of this attempt alone,
and then publishes one small file that lists the folders. Readers take listed folders
only: they see all tables of a batch or none, at any moment. A batch that is
run again after its commit writes nothing; one that failed before it writes new folders, and the
old ones are listed nowhere (:func:`vacuum` removes them).

Layout: ``{table}/query_id=Q/batch_id=N/attempt=A`` and ``{log}/Q/N.json``. A commit file is
written under another name and renamed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import drop_folder, folder_exists, list_folder, write_text
from pulsegrid.operators.validate import error_records, good_records
from pulsegrid.plans.pipelines import error_table_rows, good_table_rows
from pulsegrid.sinks.tables import query_id_of, write_sized

COMMIT = "query_id string, batch_id long, tables map<string,string>"


def commit_file(log: str, query_id: str, batch_id: int) -> str:
    return f"{log.rstrip('/')}/{query_id}/{int(batch_id):012d}.json"


def compacted_upto(spark: SparkSession, log: str, query_id: str) -> int:
    """Greatest batch in the query's compacted commits (-1: none)."""
    names = [n for n in list_folder(spark, f"{log.rstrip('/')}/{query_id}") if n.startswith("upto-")]
    return max((int(n[len("upto-") : -len(".json")]) for n in names), default=-1)


def is_committed(spark: SparkSession, log: str, query_id: str, batch_id: int) -> bool:
    return folder_exists(spark, commit_file(log, query_id, batch_id)) or batch_id <= compacted_upto(spark, log, query_id)


def publish(spark: SparkSession, log: str, query_id: str, batch_id: int, tables: dict[str, str]) -> None:
    """Make a batch visible: from here on readers take its folders."""
    entry = {"query_id": query_id, "batch_id": int(batch_id), "tables": tables}
    write_text(spark, commit_file(log, query_id, batch_id), json.dumps(entry) + "\n")


def read_commits(spark: SparkSession, log: str) -> DataFrame:
    """``query_id, batch_id, tables`` (name to folder) of every commit."""
    if not list_folder(spark, log):
        return spark.createDataFrame([], COMMIT)
    commits = spark.read.schema(COMMIT).json(f"{log.rstrip('/')}/*/*.json")
    return commits.dropDuplicates(["query_id", "batch_id"])  # a compaction lists some twice until it ends


def committed_folders(spark: SparkSession, log: str, name: str) -> list[tuple[str, int, str]]:
    """(query, batch, folder) of the table ``name``, a few bytes per batch."""
    listed = read_commits(spark, log).select("query_id", "batch_id", F.col("tables")[name].alias("folder"))
    return sorted(tuple(r) for r in listed.filter("folder is not null").collect())


def read_committed(spark: SparkSession, log: str, name: str, path: str, schema=None) -> DataFrame:
    """The table ``name`` at ``path``: rows of committed batches, with ``query_id`` and
    ``batch_id``. ``schema`` (of the files) is needed only where nothing may be committed yet."""
    folders = [f for _, _, f in committed_folders(spark, log, name)]
    if not folders:
        if schema is None:
            raise ValueError(f"nothing is committed for {name}: pass its schema")
        empty = spark.createDataFrame([], schema)
        return empty.withColumns({"query_id": F.lit("").cast("string"), "batch_id": F.lit(0)})
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", path).parquet(*folders).drop("attempt")


def committed_writer(log: str, tables: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: per table (name to path and what makes its rows
    of a batch) one folder, then one commit. The batch is persisted once and read by all."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        spark, query_id = batch.sparkSession, query_id_of(batch)
        if is_committed(spark, log, query_id, batch_id):
            return
        attempt, folders = uuid.uuid4().hex, {}
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, (path, make) in tables.items():
                folder = f"{path.rstrip('/')}/query_id={query_id}/batch_id={int(batch_id)}/attempt={attempt}"
                rows = make(batch)
                n = rows.count()
                if n:
                    write_sized(rows, folder, n)
                    folders[name] = folder
            publish(spark, log, query_id, batch_id, folders)
        finally:
            batch.unpersist()

    return _write


def committed_routed_writer(good_path: str, error_path: str, log: str, compat_key: bool = False) -> Callable[[DataFrame, int], None]:
    """Good and error rows of validated, de-duplicated readings, under one commit."""
    return committed_writer(
        log,
        {
            "good": (good_path, lambda batch: good_table_rows(good_records(batch), compat_key)),
            "error": (error_path, lambda batch: error_table_rows(error_records(batch), compat_key)),
        },
    )


def compact_commits(spark: SparkSession, log: str, query_id: str) -> int:
    """Merge a query's commit files but the last into one; returns how many went.
    The merged file is there before the single ones go, so readers always find every commit."""
    own = f"{log.rstrip('/')}/{query_id}"
    names = sorted(list_folder(spark, own))
    single = [n for n in names if not n.startswith("upto-")][:-1]
    if not single:
        return 0
    earlier = [n for n in names if n.startswith("upto-")]
    entries = spark.read.schema(COMMIT).json([f"{own}/{n}" for n in earlier + single]).dropDuplicates(["query_id", "batch_id"])
    lines = [json.dumps(r.asDict()) for r in entries.orderBy("batch_id").collect()]
    write_text(spark, f"{own}/upto-{int(single[-1][: -len('.json')]):012d}.json", "\n".join(lines) + "\n")
    for n in earlier + single:
        drop_folder(spark, f"{own}/{n}")
    return len(single)


def vacuum(spark: SparkSession, log: str, name: str, path: str) -> list[str]:
    """Remove the folders of attempts that were never committed, of batches up to the
    query's last commit (a batch beyond it may be on its way). Returns them."""
    listed = committed_folders(spark, log, name)
    kept = {f.rsplit("/", 1)[1] for _, _, f in listed}
    done: dict[str, int] = {r["query_id"]: r["last"] for r in read_commits(spark, log).groupBy("query_id").agg(F.max("batch_id").alias("last")).collect()}
    gone = []
    for q in list_folder(spark, path):
        for b in list_folder(spark, f"{path}/{q}"):
            if int(b.split("=", 1)[1]) > done.get(q.split("=", 1)[1], -1):
                continue
            for a in list_folder(spark, f"{path}/{q}/{b}"):
                if a not in kept:
                    drop_folder(spark, f"{path}/{q}/{b}/{a}")
                    gone.append(f"{q}/{b}/{a}")
    return gone
