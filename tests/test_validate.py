import pytest

from pulsegrid.config import RESULT_CONNECTOR_MISMATCH, RESULT_DEVICE_NOT_FOUND, RESULT_SUCCESS
from pulsegrid.operators.validate import error_records, good_records, hot_devices, latest_metadata, validate_readings
from pulsegrid.schemas import METADATA, READING


def _meta(spark, rows):
    full = [(f"g{d}", d, f"c{c}", c, "v", 1, "DOUBLE", o) for d, c, o in rows]
    return spark.createDataFrame(full, METADATA)


def _readings(spark, pairs):
    import datetime as dt

    t = dt.datetime(2018, 7, 20, 13, 20)
    return spark.createDataFrame([("n", 1, c, d, t, "v", 1.0) for d, c in pairs], READING)


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "salted", "plain"])
def test_validation_hand_cases(spark, strategy):
    meta = _meta(spark, [(1, 10, 1)])
    r = _readings(spark, [(1, 10), (1, 11), (2, 10), (1, None)])
    got = sorted(
        ((x.deviceid, x.connectorid, x.result) for x in validate_readings(r, meta, strategy=strategy).collect()),
        key=str,
    )
    assert got == sorted(
        [
            (1, 10, RESULT_SUCCESS),
            (1, 11, RESULT_CONNECTOR_MISMATCH),
            (2, 10, RESULT_DEVICE_NOT_FOUND),
            (1, None, RESULT_CONNECTOR_MISMATCH),
        ],
        key=str,
    )


def test_last_metadata_row_wins(spark):
    meta = _meta(spark, [(1, 99, 1), (1, 10, 5), (1, 42, 3)])
    latest = latest_metadata(meta).collect()
    assert [(m.deviceid, m.connectorid) for m in latest] == [(1, 10)]
    r = validate_readings(_readings(spark, [(1, 10)]), meta).collect()
    assert r[0].result == RESULT_SUCCESS


def test_good_and_error_split(spark):
    meta = _meta(spark, [(1, 10, 1)])
    v = validate_readings(_readings(spark, [(1, 10), (1, 11), (2, 10)]), meta)
    assert good_records(v).count() == 1
    assert error_records(v).count() == 2


def test_salts_only_hot_devices(spark):
    meta = _meta(spark, [(d, d % 5, 1) for d in range(50)])
    r = _readings(spark, [(1, 1)] * 40 + [(d, d % 5) for d in range(2, 20)])
    hot = hot_devices(r, rows_per_salt=10).collect()
    assert [(h["_hot"], h["_salts"]) for h in hot] == [(1, 4)]
    plain = sorted(tuple(x) for x in validate_readings(r, meta).collect())
    assert sorted(tuple(x) for x in validate_readings(r, meta, strategy="salted", rows_per_salt=10).collect()) == plain


def test_salted_join_spreads_a_hot_device(spark):
    """One device with most readings: after the salted shuffle join its rows
    sit in many partitions, not one."""
    import datetime as dt

    from pyspark.sql import functions as F

    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        meta = _meta(spark, [(d, 1, 1) for d in range(1, 50)])
        t0 = dt.datetime(2018, 7, 20)
        rows = [("n", 1, 1, 1 if i % 10 else 1 + i % 49, t0 + dt.timedelta(seconds=i), "v", float(i)) for i in range(4000)]
        r = spark.createDataFrame(rows, READING)
        v = validate_readings(r, meta, strategy="salted", rows_per_salt=250)
        spread = v.filter("deviceid = 1").select(F.spark_partition_id().alias("p")).distinct().count()
        assert spread >= 6
        assert v.filter(F.col("result") == RESULT_SUCCESS).count() == 4000
    finally:
        for k, val in old.items():
            spark.conf.set(k, val)


def _skewed(spark, n=4000):
    import datetime as dt

    t0 = dt.datetime(2018, 7, 20)
    rows = [("n", 1, 1, 1 if i % 10 else 1 + i % 49, t0 + dt.timedelta(seconds=i), "v", float(i)) for i in range(n)]
    return spark.createDataFrame(rows, READING)


@pytest.fixture()
def no_broadcast(spark):
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield
    for k in confs:
        spark.conf.unset(k)


def test_default_strategy_splits_a_hot_device(spark, no_broadcast):
    """The lookup is not broadcast; nine tenths of the readings come from one device."""
    from pyspark.sql import functions as F

    meta = _meta(spark, [(d, 1, o) for d in range(1, 50) for o in (1, 2)])
    r = _skewed(spark)
    v = validate_readings(r, meta, rows_per_salt=250)
    own = "deviceid = 1 and result = 'Success'"  # the result is asked for, so the join stays in the plan
    tasks = v.filter(own).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) >= 6 and max(t["count"] for t in tasks) < 0.5 * 3600
    plan = v._jdf.queryExecution().executedPlan().toString()
    # the lookup is shuffled and joined by device and salt; only the few heavy devices are broadcast
    assert "SortMergeJoin" in plan and "_m_salt" in plan and "approx_top_k" in plan.lower().replace("approxtopk", "approx_top_k")
    # a plain join puts the device in one task
    plain = validate_readings(r, meta, strategy="plain").filter(own)
    assert plain.select(F.spark_partition_id()).distinct().count() == 1
    assert sorted(map(tuple, v.collect())) == sorted(map(tuple, validate_readings(r, meta, strategy="plain").collect()))


def test_strategy_follows_the_size_of_the_lookup(spark, monkeypatch, workdir):
    from pulsegrid.operators import validate

    _meta(spark, [(1, 1, 1)]).write.parquet(f"{workdir}/meta")
    meta = spark.read.parquet(f"{workdir}/meta")
    assert validate.join_strategy(meta, "auto") == "plain" and validate.join_strategy(meta, "broadcast") == "broadcast"
    monkeypatch.setattr(validate, "BROADCAST_LIMIT", 0)
    monkeypatch.setattr(validate, "broadcast_threshold", lambda spark: 0)
    assert validate.join_strategy(meta, "auto") == "salted" and validate.join_strategy(meta, "broadcast") == "salted"
    with pytest.raises(ValueError):
        validate.join_strategy(meta, "hash")


def test_heavy_devices_are_found_without_counting_all(spark, monkeypatch):
    from pulsegrid.operators import validate

    monkeypatch.setattr(validate, "HEAVY_DEVICES", 5)
    monkeypatch.setattr(validate, "TRACKED_DEVICES", 16)
    r = _readings(spark, [(7, 1)] * 600 + [(d, 1) for d in range(100, 700)] + [(None, 1)] * 900).repartition(4)
    hot = hot_devices(r, rows_per_salt=200)
    assert [h["_hot"] for h in hot.collect()] == [7] and hot.collect()[0]["_salts"] >= 3
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan  # one row per task goes to one row
    assert hot_devices(r.limit(0)).collect() == []
