"""Row-by-row writer of a stream: ``writeStream.foreach(RowWriter(...))``.

For what only a per-row hook can do; tables are written faster by
``foreachBatch`` (:mod:`pulsegrid.sinks.tables`), which keeps rows in the JVM.

Each partition of an epoch is one file, named by both numbers. Rows are
buffered and written in groups to a file of this attempt, which is renamed when the
partition ends without an error. Another attempt of the same partition and epoch
finds the file and skips its rows: nothing is stored twice, and what a failed attempt
left has another name. This holds where a query cuts an epoch alike
each time, as behind a stateful operator, whose partitions the checkpoint fixes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

GROUP_ROWS = 50_000


class RowWriter:
    """``open``, ``process`` and ``close`` of one partition; ``path`` is a folder that all machines share."""

    def __init__(self, path: str, schema: T.StructType, group_rows: int = GROUP_ROWS):
        self.path, self.group_rows = path.rstrip("/"), group_rows
        self.schema_json = schema.json()
        self._done = None

    def _open_file(self):
        import pyarrow.parquet as pq

        self._store.create_dir(self._folder, recursive=True)
        self._out = self._store.open_output_stream(self._attempt)
        self._writer = pq.ParquetWriter(self._out, self._schema)

    def open(self, partition_id: int, epoch_id: int) -> bool:
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema

        store, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path.removeprefix("file:"))
        self._store, self._folder = store, f"{root}/epoch={epoch_id}"
        self._final = f"{self._folder}/part-{partition_id:05d}.parquet"
        self._attempt = f"{self._folder}/_attempt-{partition_id:05d}-{uuid.uuid4().hex}"
        self._schema = to_arrow_schema(T.StructType.fromJson(json.loads(self.schema_json)))
        self._buffer, self._writer = [], None
        self._done = store.get_file_info(self._final).type != fs.FileType.NotFound
        return not self._done

    def process(self, row: Row) -> None:
        self._buffer.append(row)
        if len(self._buffer) >= self.group_rows:
            self._flush()

    def _flush(self) -> None:
        import pyarrow as pa

        if self._writer is None:
            self._open_file()
        columns = [pa.array([r[name] for r in self._buffer], self._schema.field(name).type) for name in self._schema.names]
        self._writer.write_table(pa.Table.from_arrays(columns, schema=self._schema))
        self._buffer = []

    def close(self, error: Exception | None) -> None:
        if self._done or self._done is None:
            return
        if error is None and self._buffer:
            self._flush()
        if self._writer is None:
            return
        self._writer.close()
        self._out.close()
        if error is None:
            self._store.move(self._attempt, self._final)
        else:
            self._store.delete_file(self._attempt)


def foreach_writer(df: DataFrame, path: str, checkpoint: str, output_mode: str = "update", trigger: dict | None = None):
    """Start a query that writes the rows of ``df`` one by one."""
    writer = df.writeStream.outputMode(output_mode).foreach(RowWriter(path, df.schema)).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that :class:`RowWriter` leaves; ``epoch`` becomes a column."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])).parquet(path)
