"""Settings, fixed values and session helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# These must equal the reference's for equal results.
# ---------------------------------------------------------------------------
READING_FLAG = 1
EVENT_FLAG = 0
RESULT_SUCCESS = "Success"
RESULT_CONNECTOR_MISMATCH = "Connector id mismatch"
RESULT_DEVICE_NOT_FOUND = "deviceid not found in metadata"
STATUS_ALIVE = "ALIVE"
STATUS_DEAD = "DEAD"
READING_NAME = "iottesttimeseries"
EVENT_NAME = "iottestevent"
DEDUP_WATERMARK = "10 minutes"
AVERAGE_WINDOW = "3 minutes"
AVERAGE_WATERMARK = "3 minutes"
DEVICE_COUNT_WINDOW = "10 minutes"
DEVICE_COUNT_WATERMARK = "5 minutes"
VARIABLE_COUNT_WINDOW = "2 minutes"
VARIABLE_COUNT_WATERMARK = "3 minutes"
CSV_COUNT_WINDOW = "2 minutes"
CSV_COUNT_WATERMARK = "5 minutes"
EVENT_DEDUP_WATERMARK = "30 seconds"
TABLE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
CSV_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
DEDUP_COLUMNS = ("name", "timeseries", "connectorid", "deviceid", "eventtime", "variableid", "value")
EVENT_DEDUP_COLUMNS = ("connectorid", "deviceid", "status")
MAX_LONG = 9223372036854775807
# ---------------------------------------------------------------------------

# Our own defaults (not from the reference).
DEFAULT_SALT_BUCKETS = 16
ROWS_PER_SALT = 2_000_000
MAX_OFFSETS_PER_TRIGGER = 5_000_000
STATUS_TIMEOUT = "TIMEOUT"  # of a session that ends by silence
SESSION_TIMEOUT = "2 days"
IDLE_TIME = "1 day"

_UNITS = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def micros(duration: str) -> int:
    """Microseconds of a duration such as ``10 minutes``."""
    found = re.fullmatch(r"\s*(\d+)\s+(" + "|".join(_UNITS) + r")s?\s*", duration)
    if not found:
        raise ValueError(f"not a duration: {duration}")
    return int(found[1]) * _UNITS[found[2]]


def use_utc(spark: SparkSession) -> SparkSession:
    """Event time is an instant; every query pins the session time zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir) as the
    cluster names it. Only on a local master, where nothing is set, a fresh
    folder is made and registered; on a cluster that would be one machine's
    disk, so it is refused.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="pulsegrid-")
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of ``path``."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared scratch root, removed when the
    application ends (results that read it are lazy, so not before)."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    make_folder(spark, path)
    fs, jpath = _file_system(spark, path)
    fs.deleteOnExit(jpath)
    return path


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.mkdirs(jpath)


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (markers and hidden files left out)."""
    fs, jpath = _file_system(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(jpath)] if fs.exists(jpath) else []
    return sorted(n for n in names if not n.startswith(("_", ".")))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that no plan reads any more."""
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written under another name and renamed: readers find all of it or nothing."""
    attempt = path.rsplit("/", 1)[0] + f"/_{uuid.uuid4().hex}"
    fs, made = _file_system(spark, attempt)
    out = fs.create(made, True)
    out.write(bytearray(text.encode()))
    out.close()
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if fs.exists(jpath):
        fs.delete(jpath, False)
    if not fs.rename(made, jpath):
        raise OSError(f"could not publish {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _file_system(spark, path)
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """State of de-duplication and sessions in RocksDB (off-heap, on local
    disk, changelog checkpoints) instead of JVM heap maps: what large state
    needs. Call before a query's first run; the provider is fixed by its
    checkpoint afterwards."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def write_scratch(df: DataFrame, label: str, file_rows: int = 0) -> tuple[DataFrame, str]:
    """``df`` written once as a table in the shared folder; the table, and its
    folder to drop when nothing reads it any more. ``file_rows``: what a file holds at
    most (0: what the session says), so that what one task has written is read by many.

    Every consumer then sees the same rows, whatever the plan above: a range
    exchange evaluated twice may cut differently each time. The lineage is cut
    too, so a lost executor rereads files instead of replaying work.
    """
    spark = df.sparkSession
    path = new_scratch_dir(spark, label)
    writer = df.write.mode("overwrite")
    (writer.option("maxRecordsPerFile", file_rows) if file_rows else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


# Settings for large clusters (our own recommendation, applied by the caller
# when building the session; nothing here changes results).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def apply_cluster_conf(builder):
    """``SparkSession.builder`` with :data:`CLUSTER_CONF`; the shared
    ``spark.checkpoint.dir`` and shuffle partitions stay the cluster's."""
    for k, v in CLUSTER_CONF.items():
        builder = builder.config(k, v)
    return builder
