"""Tables stored by row key: merged upserts and ordered range reads.

* :func:`merge_table` turns the batch folders of a table into one row per
  key. Keys are dealt to buckets by the key's salt byte (and, if asked for, a
  hash of device and connector). A merge reads the buckets that new batches touch, and rewrites no others. A
  manifest names each bucket's folder and the batches that are merged; readers
  take what the newest manifest names, so a merge shows all at once.
* :func:`write_ordered` stores rows in key order, with the key range of every file.
  :func:`newest_readings` and :func:`readings_between` then open only the files
  whose range meets the device's prefix: keys hold the time in reverse, so newest rows come first.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import drop_folder, list_folder, read_text, write_text
from pulsegrid.functions.rowkey import key_prefix, prefix_end, time_bound
from pulsegrid.sinks.tables import ROWS_PER_FILE, latest_by_key

NO_KEY = -1  # bucket of the rows without a key
RANGES = "file string, low binary, high binary, rows long"


# --- ordered files ------------------------------------------------------------------


def _with_ranges(spark: SparkSession, path: str, folders: Sequence[str]) -> None:
    """Store the key range of every file of ``folders`` beside them: one narrow column is read."""
    files = spark.read.parquet(*folders).select("row_key", F.col("_metadata.file_path").alias("file"))
    ranges = files.filter(F.col("row_key").isNotNull()).groupBy("file").agg(
        F.min("row_key").alias("low"), F.max("row_key").alias("high"), F.count(F.lit(1)).alias("rows")
    )
    ranges.write.mode("overwrite").parquet(f"{path}/_ranges")


def write_ordered(rows: DataFrame, path: str, files: int | None = None, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Store ``rows`` sorted by ``row_key`` over all files, with their key ranges. A busy device spreads over as
    many files as its rows need. ``files``: number of ranges (default: Spark's). Rows without
    a key stand in the first file; no range read finds them."""
    ranged = rows.repartitionByRange(files, "row_key") if files else rows.repartitionByRange("row_key")
    out = ranged.sortWithinPartitions("row_key").write.mode("overwrite")
    out.option("maxRecordsPerFile", rows_per_file).parquet(path)
    _with_ranges(rows.sparkSession, path, [path])


def key_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``file, low, high, rows`` of an ordered table, or of the files that a merged one stands on."""
    if not list_folder(spark, f"{path}/{MANIFESTS}"):
        return spark.read.schema(RANGES).parquet(f"{path}/_ranges")
    folders = _manifest(spark, path)["buckets"].values()
    versions = sorted({f.split("/", 1)[0] for own in folders for f in own})
    if not versions:
        return spark.createDataFrame([], RANGES)
    ranges = spark.read.schema(RANGES).parquet(*(f"{path}/{v}/_ranges" for v in versions))
    live = [f for own in folders for f in own]
    return ranges.filter(F.regexp_extract("file", r"(v=\d+/bucket=-?\d+)/[^/]*$", 1).isin(live))


def files_of(spark: SparkSession, path: str, low: bytes, high: bytes, n: int | None = None) -> list[str]:
    """Files with keys from ``low`` up to but not ``high``, in key order; with
    ``n``, no more than what holds the first ``n`` such keys."""
    meets = (F.col("high") >= F.lit(low)) & (F.col("low") < F.lit(high))
    out, sure = [], 0
    for r in key_ranges(spark, path).filter(meets).orderBy("low").toLocalIterator():
        if n is not None and sure >= n:
            break
        out.append(r["file"])
        if bytes(r["low"]) >= low and bytes(r["high"]) < high:
            sure += r["rows"]
    return out


def _between(spark: SparkSession, path: str, low: bytes, high: bytes, n: int | None = None) -> DataFrame:
    files = files_of(spark, path, low, high, n)
    if not files:
        first = key_ranges(spark, path).select("file").first()
        if first is None:
            raise ValueError(f"no keyed file in {path}")
        return spark.read.parquet(first["file"]).limit(0)
    rows = spark.read.parquet(*files)  # Parquet skips row groups by the same bounds
    return rows.filter((F.col("row_key") >= F.lit(low)) & (F.col("row_key") < F.lit(high)))


def newest_readings(spark: SparkSession, path: str, deviceid: int, connectorid: int, n: int) -> DataFrame:
    """The ``n`` newest rows of a device and connector, newest first; rows of
    equal time by the rest of the key."""
    prefix = key_prefix(deviceid, connectorid)
    return _between(spark, path, prefix, prefix_end(prefix), n).orderBy("row_key").limit(n)


def readings_between(spark: SparkSession, path: str, deviceid: int, connectorid: int, first_ms: int, last_ms: int) -> DataFrame:
    """Rows of a device and connector whose time (epoch milliseconds) is in ``first_ms .. last_ms``."""
    low = key_prefix(deviceid, connectorid) + time_bound(last_ms)
    return _between(spark, path, low, prefix_end(key_prefix(deviceid, connectorid) + time_bound(first_ms)))


# --- merged tables ---------------------------------------------------------------------

MANIFESTS = "_manifests"


@dataclass
class Merge:
    """What a merge did: its version, the buckets written, the batches taken in."""

    version: int
    buckets: list[int] = field(default_factory=list)
    batches: list[str] = field(default_factory=list)


def _manifest(spark: SparkSession, target: str) -> dict:
    names = list_folder(spark, f"{target}/{MANIFESTS}")
    if not names:
        return {"version": 0, "merged": {}, "buckets": {}}
    return json.loads(read_text(spark, f"{target}/{MANIFESTS}/{names[-1]}"))


def bucket_of(key: str, hashed: int = 1) -> Column:
    """The key's salt digit, by ``hashed`` parts of device and connector; ``NO_KEY`` without a key."""
    salt = F.conv(F.hex(F.substring(key, 1, 1)), 16, 10).cast("int")
    part = F.pmod(F.xxhash64(F.substring(key, 2, 8)), F.lit(hashed)).cast("int")
    return F.coalesce(salt * hashed + part, F.lit(NO_KEY))


def _new_batches(spark: SparkSession, source: str, merged: dict[str, int]) -> dict[str, list[int]]:
    found: dict[str, list[int]] = {}
    for q in list_folder(spark, source):
        query = q.split("=", 1)[1]
        batches = [int(b.split("=", 1)[1]) for b in list_folder(spark, f"{source}/{q}")]
        new = sorted(b for b in batches if b > merged.get(query, -1))
        if new:
            found[query] = new
    return found


def _folders(spark: SparkSession, target: str, manifest: dict, buckets: Sequence[int] | None = None) -> list[str]:
    wanted = manifest["buckets"] if buckets is None else {str(b): manifest["buckets"].get(str(b), []) for b in buckets}
    return [f"{target}/{f}" for own in wanted.values() for f in own]


def merge_table(
    spark: SparkSession,
    source: str,
    target: str,
    key: str = "row_key",
    order: Sequence[str] = ("batch_id", "VARIABLEID", "VALUE"),
    hashed: int = 1,
    rows_per_file: int = ROWS_PER_FILE,
) -> Merge:
    """Take the batches of ``source`` (as :func:`write_batch` leaves them) that ``target`` has not merged yet into it: one row per key,
    the latest by ``order``; rows without a key all stay. Equals :func:`latest_by_key` over the whole source.

    Only buckets with new keys are read and rewritten, sorted by key, into the folder of a new version; rows
    without a key are only added. Nothing new: nothing is written. ``hashed``: parts that each of the ten
    salts is cut into, for buckets that a merge can rewrite at any size of the table; fixed by the first merge.
    One merge runs at a time. Older versions stay for their readers until :func:`drop_old_versions`.
    """
    if key != "row_key":
        raise ValueError("a merged table is keyed by row_key")
    source, target = source.rstrip("/"), target.rstrip("/")
    manifest = _manifest(spark, target)
    hashed = manifest.get("hashed", hashed)
    new = _new_batches(spark, source, manifest["merged"])
    if not new:
        return Merge(manifest["version"])
    paths = [f"{source}/query_id={q}/batch_id={b}" for q, batches in new.items() for b in batches]
    rows = spark.read.option("basePath", source).parquet(*paths).withColumn("bucket", bucket_of(key, hashed))
    buckets = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # at most ten times `hashed`, and one
    version = manifest["version"] + 1
    out = {"version": version, "hashed": hashed, "merged": dict(manifest["merged"]), "buckets": dict(manifest["buckets"])}
    for q, batches in new.items():
        out["merged"][q] = batches[-1]
    if buckets:
        folder = f"v={version:08d}"
        old = _folders(spark, target, manifest, [b for b in buckets if b != NO_KEY])
        if old:
            # `old` holds no bucket column of its own: it is the folder's name
            known = spark.read.option("basePath", target).parquet(*old).drop("v")
            rows = rows.unionByName(known, allowMissingColumns=True)
        merged = latest_by_key(rows, key, order).repartitionByRange("bucket", key).sortWithinPartitions("bucket", key)
        merged.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("bucket").parquet(f"{target}/{folder}")
        _with_ranges(spark, f"{target}/{folder}", [f"{target}/{folder}"])
        for b in buckets:
            before = manifest["buckets"].get(str(b), []) if b == NO_KEY else []
            out["buckets"][str(b)] = [*before, f"{folder}/bucket={b}"]
    write_text(spark, f"{target}/{MANIFESTS}/{version:08d}.json", json.dumps(out))
    return Merge(version, buckets, [p[len(source) + 1 :] for p in paths])


def read_merged(spark: SparkSession, target: str) -> DataFrame:
    """The merged table: every row that the newest manifest names, with its ``bucket``."""
    target = target.rstrip("/")
    folders = _folders(spark, target, _manifest(spark, target))
    if not folders:
        raise ValueError(f"nothing is merged in {target}")
    return spark.read.option("basePath", target).parquet(*folders).drop("v")


def drop_old_versions(spark: SparkSession, target: str) -> list[str]:
    """Remove bucket folders that the newest manifest does not name; returns
    them. For times without readers of older versions."""
    target = target.rstrip("/")
    manifest = _manifest(spark, target)
    live = {f for own in manifest["buckets"].values() for f in own}
    gone = []
    for v in list_folder(spark, target):
        own = [f"{v}/{b}" for b in list_folder(spark, f"{target}/{v}")]
        for f in own:
            if f not in live:
                drop_folder(spark, f"{target}/{f}")
                gone.append(f)
        if not live.intersection(own):
            drop_folder(spark, f"{target}/{v}")
    for name in list_folder(spark, f"{target}/{MANIFESTS}")[:-1]:
        drop_folder(spark, f"{target}/{MANIFESTS}/{name}")
    return gone
