"""Commits over several tables, merged tables, ordered range reads, the row-by-row writer."""

import datetime as dt
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from pulsegrid.config import list_folder
from pulsegrid.functions.rowkey import key_prefix, prefix_end, row_key
from pulsegrid.plans.pipelines import good_table_rows
from pulsegrid.schemas import METADATA, READING
from pulsegrid.sinks import commits, keyed
from pulsegrid.sinks.commits import committed_folders, compact_commits, is_committed, publish, read_committed, vacuum
from pulsegrid.sinks.foreach import RowWriter, read_rows
from pulsegrid.sinks.keyed import (
    drop_old_versions, files_of, key_ranges, merge_table, newest_readings, read_merged, readings_between, write_ordered,
)
from pulsegrid.sinks.tables import latest_by_key, read_batch_table, write_batch
from pulsegrid.sources.files import message_file_stream
from pulsegrid.streaming.queries import start_ingest
from tests.helpers import messages, reading, write_files

NOW = {"availableNow": True}
T0 = dt.datetime(2018, 7, 20, 13)


def _reading(device, minute, value=1.0):
    return (f"{device},1", reading(device, 1, f"2018-07-20 13:{minute:02d}:00.000", [("v", value)]))


def _meta(spark):
    return spark.createDataFrame([("g", 1, "c", 1, "v", 1, "DOUBLE", 1)], METADATA)


def _ingest(spark, workdir):
    src = message_file_stream(spark, f"{workdir}/in/slice=*")
    q = start_ingest(src, _meta(spark), f"{workdir}/good", f"{workdir}/error", f"{workdir}/chk", commits=f"{workdir}/log", trigger=NOW)
    q.awaitTermination()
    return q


def _tables(spark, workdir, schema=None):
    out = []
    for name in ("good", "error"):
        rows = read_committed(spark, f"{workdir}/log", name, f"{workdir}/{name}", schema="DEVICEID int, VALUE double")
        out.append(sorted((r.DEVICEID, r.VALUE) for r in rows.collect()))
    return out


def test_a_failure_between_the_writes_shows_neither_table(spark, workdir, monkeypatch):
    write_files(spark, f"{workdir}/in", [[_reading(1, 0, 1.0), _reading(2, 0, 2.0)], [_reading(1, 1, 3.0), _reading(2, 1, 4.0)]])
    real, writes = commits.write_sized, []

    def fails_at_the_fourth_write(df, folder, n, fmt="parquet"):
        writes.append(folder)
        if len(writes) == 4:  # good rows of the second batch stand, its error rows do not
            raise OSError("disk gone")
        real(df, folder, n, fmt)

    monkeypatch.setattr(commits, "write_sized", fails_at_the_fourth_write)
    with pytest.raises(Exception):
        _ingest(spark, workdir)
    assert any("batch_id=1" in w for w in writes)
    assert _tables(spark, workdir) == [[(1, 1.0)], [(2, 2.0)]]
    monkeypatch.setattr(commits, "write_sized", real)
    _ingest(spark, workdir)  # the batch again, on the same checkpoint
    assert _tables(spark, workdir) == [[(1, 1.0), (1, 3.0)], [(2, 2.0), (2, 4.0)]]
    # the first attempt's rows are in a folder that nothing lists
    assert len(vacuum(spark, f"{workdir}/log", "good", f"{workdir}/good")) == 1
    assert vacuum(spark, f"{workdir}/log", "good", f"{workdir}/good") == []
    assert _tables(spark, workdir) == [[(1, 1.0), (1, 3.0)], [(2, 2.0), (2, 4.0)]]


def test_a_committed_batch_is_not_written_again(spark, workdir, monkeypatch):
    rows = spark.createDataFrame([(1,), (2,)], "DEVICEID int")
    monkeypatch.setattr(commits, "query_id_of", lambda batch: "q")
    write = commits.committed_writer(f"{workdir}/log", {"t": (f"{workdir}/t", lambda b: b), "none": (f"{workdir}/n", lambda b: b.limit(0))})
    write(rows, 0)
    write(rows, 0)  # the engine failed after the commit and runs the batch once more
    write(rows, 1)
    assert read_committed(spark, f"{workdir}/log", "t", f"{workdir}/t").count() == 4
    assert committed_folders(spark, f"{workdir}/log", "none") == []
    with pytest.raises(ValueError):
        read_committed(spark, f"{workdir}/log", "none", f"{workdir}/n")
    assert read_committed(spark, f"{workdir}/log", "none", f"{workdir}/n", schema="DEVICEID int").count() == 0


def test_compacted_commits_read_the_same(spark, workdir):
    log = f"{workdir}/log"
    assert read_committed(spark, log, "t", workdir, schema="v int").count() == 0
    for b in range(5):
        publish(spark, log, "q", b, {"t": f"folder{b}"})
    publish(spark, log, "other", 0, {"t": "folder"})
    before = committed_folders(spark, log, "t")
    assert compact_commits(spark, log, "q") == 4 and list_folder(spark, f"{log}/q") == ["000000000004.json", "upto-000000000003.json"]
    assert committed_folders(spark, log, "t") == before
    publish(spark, log, "q", 5, {})
    assert compact_commits(spark, log, "q") == 1 and committed_folders(spark, log, "t") == before
    assert is_committed(spark, log, "q", 2) and is_committed(spark, log, "q", 5) and not is_committed(spark, log, "q", 6)
    assert compact_commits(spark, log, "other") == 0


# --- merged tables ----------------------------------------------------------------


def _rows(spark, items):
    """(device, connector, minute, variable, value) as table rows, 17-byte keys."""
    full = [("n", 1, c, d, T0 + dt.timedelta(minutes=m) if m is not None else None, v, x) for d, c, m, v, x in items]
    return good_table_rows(spark.createDataFrame(full, READING), compat_key=True)


def _listing(path):
    return sorted((os.path.join(d, f), os.path.getmtime(os.path.join(d, f))) for d, _, fs in os.walk(path) for f in fs)


def _plain(df):
    return sorted((tuple(r) for r in df.drop("query_id", "bucket").select("row_key", "DEVICEID", "VARIABLEID", "VALUE", "batch_id").collect()), key=str)


@pytest.mark.parametrize("hashed", [1, 3])
def test_merged_table_equals_the_view_and_rewrites_what_changed(spark, workdir, hashed):
    source, target = f"{workdir}/t", f"{workdir}/m"
    write_batch(_rows(spark, [(d, d % 3, m, "a", float(d)) for d in range(1, 30) for m in (0, 1)]), source, 0, "q1")
    write_batch(_rows(spark, [(4, None, 0, "a", 1.0), (14, 1, 0, "b", 2.0)]), source, 1, "q1")
    first = merge_table(spark, source, target, hashed=hashed)
    assert first.version == 1 and len(first.batches) == 2 and keyed.NO_KEY in first.buckets
    assert _plain(read_merged(spark, target)) == _plain(latest_by_key(read_batch_table(spark, source)))
    before = _listing(target)
    again = merge_table(spark, source, target)
    assert again.buckets == [] and again.batches == [] and _listing(target) == before
    # devices 4 and 14 share a salt: no other salt is touched
    write_batch(_rows(spark, [(4, 1, 0, "a", 99.0), (4, 1, 7, "a", 5.0), (4, None, 0, "a", 7.0)]), source, 2, "q1")
    write_batch(_rows(spark, [(14, 2, 1, "z", 3.0)]), source, 0, "q2")
    second = merge_table(spark, source, target)
    assert {b // hashed for b in second.buckets if b >= 0} == {4}
    assert _plain(read_merged(spark, target)) == _plain(latest_by_key(read_batch_table(spark, source)))
    kept = {f for f, _ in before}
    assert kept <= {f for f, _ in _listing(target)}  # readers of the first version still find it
    assert drop_old_versions(spark, target)
    assert _plain(read_merged(spark, target)) == _plain(latest_by_key(read_batch_table(spark, source)))
    assert merge_table(spark, source, target).buckets == []


def test_a_merge_that_fails_changes_nothing_for_readers(spark, workdir, monkeypatch):
    source, target = f"{workdir}/t", f"{workdir}/m"
    write_batch(_rows(spark, [(1, 1, 0, "a", 1.0)]), source, 0, "q")
    merge_table(spark, source, target)
    write_batch(_rows(spark, [(1, 1, 0, "a", 2.0)]), source, 1, "q")
    real = keyed.write_text
    monkeypatch.setattr(keyed, "write_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        merge_table(spark, source, target)
    assert [r.VALUE for r in read_merged(spark, target).collect()] == [1.0]
    monkeypatch.setattr(keyed, "write_text", real)
    assert merge_table(spark, source, target).version == 2
    assert [r.VALUE for r in read_merged(spark, target).collect()] == [2.0]
    with pytest.raises(ValueError):
        read_merged(spark, f"{workdir}/nowhere")
    assert merge_table(spark, f"{workdir}/nothing", f"{workdir}/m2").version == 0


# --- ordered files ----------------------------------------------------------------


def test_newest_readings_open_the_files_of_their_prefix(spark, workdir):
    items = [(d, 1, m, "v", float(m)) for d in range(-3, 40) for m in range(5)] + [(7, 1, m, "v", float(m)) for m in range(5, 600)]
    rows = _rows(spark, items + [(7, 2, 1, "v", -1.0), (7, None, 1, "v", -2.0)])
    write_ordered(rows, f"{workdir}/o", files=12, rows_per_file=50)
    total = key_ranges(spark, f"{workdir}/o").count()
    assert total >= 16
    newest = newest_readings(spark, f"{workdir}/o", 7, 1, 10)
    assert [r.VALUE for r in newest.collect()] == [float(m) for m in range(599, 589, -1)]
    prefix = key_prefix(7, 1)
    every = files_of(spark, f"{workdir}/o", prefix, prefix_end(prefix))
    few = files_of(spark, f"{workdir}/o", prefix, prefix_end(prefix), 10)
    assert len(every) >= 12 and len(few) <= 2
    assert {f.rsplit("/", 1)[1] for f in newest.inputFiles()} == {f.rsplit("/", 1)[1] for f in few}  # files read, of `total`
    assert [r.VALUE for r in newest_readings(spark, f"{workdir}/o", -3, 1, 3).collect()] == [4.0, 3.0, 2.0]
    assert len(newest_readings(spark, f"{workdir}/o", -3, 1, 3).inputFiles()) <= 2
    assert newest_readings(spark, f"{workdir}/o", 7, 1, 10_000).count() == 600
    assert newest_readings(spark, f"{workdir}/o", 1234, 1, 3).collect() == []
    ms = int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    some = readings_between(spark, f"{workdir}/o", 7, 1, ms + 100 * 60_000, ms + 120 * 60_000)
    assert sorted(r.VALUE for r in some.collect()) == [float(m) for m in range(100, 121)]
    assert len(some.inputFiles()) <= 3


def test_merged_tables_are_ordered_too(spark, workdir):
    source, target = f"{workdir}/t", f"{workdir}/m"
    write_batch(_rows(spark, [(d, 1, m, "v", float(m)) for d in range(40) for m in range(30)]), source, 0, "q")
    merge_table(spark, source, target, rows_per_file=40)
    write_batch(_rows(spark, [(7, 1, m, "v", 100.0 + m) for m in range(25, 35)]), source, 1, "q")
    merge_table(spark, source, target, rows_per_file=40)
    newest = newest_readings(spark, target, 7, 1, 12)
    assert [r.VALUE for r in newest.collect()] == [float(100 + m) for m in range(34, 24, -1)] + [24.0, 23.0]
    assert len(newest.inputFiles()) <= 3 < key_ranges(spark, target).count()


def test_prefix_equals_the_key_column(spark):
    for d, c in ((123, 5), (-123, 0), (2**31 - 1, -1), (-(2**31), 7)):
        df = spark.createDataFrame([(d, c, T0, "v")], "deviceid int, connectorid int, eventtime timestamp, variableid string")
        key = bytes(df.select(row_key().alias("k")).first()["k"])
        assert key.startswith(key_prefix(d, c)) and key < prefix_end(key_prefix(d, c))
    assert prefix_end(b"\x01\xff") == b"\x02\x00"


# --- row by row -------------------------------------------------------------------


SCHEMA = "k binary, t timestamp, v double"


def _writer(spark, path, **opts):
    return RowWriter(path, spark.createDataFrame([], SCHEMA).schema, **opts)


def _row(k, v):
    return Row(k=bytearray(k), t=T0, v=v)


def test_a_retried_epoch_leaves_no_second_copy(spark, workdir):
    path = f"{workdir}/r"

    def attempt(epoch, values, error=None, part=0):
        w = _writer(spark, path, group_rows=2)
        if w.open(part, epoch):
            for v in values:
                w.process(_row(b"k", v))
        w.close(error)

    attempt(0, [1.0, 2.0, 3.0])
    attempt(1, [4.0, 5.0, 6.0], error=OSError("lost"))  # two rows were flushed already
    attempt(1, [4.0, 5.0, 6.0])
    attempt(1, [4.0, 5.0, 6.0])  # the epoch again, after it was done
    attempt(1, [7.0], part=1)
    attempt(2, [])
    got = read_rows(spark, path, spark.createDataFrame([], SCHEMA).schema)
    assert sorted((r.epoch, r.v) for r in got.collect()) == [(0, 1.0), (0, 2.0), (0, 3.0), (1, 4.0), (1, 5.0), (1, 6.0), (1, 7.0)]
    assert {bytes(r.k) for r in got.collect()} == {b"k"} and {r.t for r in got.collect()} == {T0}
    assert not [f for f, _ in _listing(path) if "_attempt" in f]


def test_row_writer_in_a_stream_restarts(spark, workdir):
    from pulsegrid.streaming.queries import start_row_writer

    write_files(spark, f"{workdir}/in", [[_reading(1, 0, 1.0), _reading(2, 0, 2.0)], [_reading(1, 1, 3.0)]])
    run = lambda: start_row_writer(message_file_stream(spark, f"{workdir}/in/slice=*"), _meta(spark), f"{workdir}/out", f"{workdir}/chk", trigger=NOW).awaitTermination()
    run()
    messages(spark, [(*_reading(1, 2, 5.0), 9)]).coalesce(1).write.parquet(f"{workdir}/in/slice=0007")
    run()
    rows = read_rows(spark, f"{workdir}/out", good_table_rows(spark.createDataFrame([], READING)).schema)
    assert sorted(r.VALUE for r in rows.collect()) == [1.0, 3.0, 5.0]
