import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.functions.rowkey import row_key, row_key_hex
from pulsegrid.functions.text import csv_line_fields, java_time_text, session_line, split_words, window_line


def _one(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_row_key_reference_value(spark):
    df = _one(spark, [(111, 1111, dt.datetime(2018, 7, 20, 13, 20), "1")], "deviceid int, connectorid int, eventtime timestamp, variableid string")
    r = df.select(row_key_hex(compat=True).alias("k"), row_key(compat=True).alias("b"), row_key_hex().alias("full")).collect()[0]
    assert r.k == "010000006F000004577FFFFE9B482723FF"
    assert len(r.b) == 17
    assert r.full == r.k + "31"


def test_row_key_salt_and_negative_device(spark):
    df = _one(
        spark,
        [(-5, 1, dt.datetime(2018, 7, 20, 13, 20), "v"), (123, 1, dt.datetime(2018, 7, 20, 13, 20), "v")],
        "deviceid int, connectorid int, eventtime timestamp, variableid string",
    )
    keys = [r.k for r in df.select(row_key_hex(compat=True).alias("k")).collect()]
    assert keys[0].startswith("05FFFFFFFB")
    assert keys[1].startswith("030000007B")


def test_row_key_before_1970_is_null(spark):
    df = _one(spark, [(1, 1, dt.datetime(1969, 12, 31, 23, 0), "v")], "deviceid int, connectorid int, eventtime timestamp, variableid string")
    assert df.select(row_key().alias("k")).collect()[0].k is None


def test_null_connector_gives_null_key(spark):
    df = _one(spark, [(1, None, dt.datetime(2018, 7, 20), "v")], "deviceid int, connectorid int, eventtime timestamp, variableid string")
    assert df.select(row_key().alias("k")).collect()[0].k is None


def test_window_line(spark):
    df = _one(
        spark,
        [(dt.datetime(2018, 7, 20, 13, 18), dt.datetime(2018, 7, 20, 13, 21), 111, "1", 20.0)],
        "s timestamp, e timestamp, deviceid int, variableid string, avg_value double",
    ).select(F.struct(F.col("s").alias("start"), F.col("e").alias("end")).alias("window"), "deviceid", "variableid", "avg_value")
    assert df.select(window_line().alias("v")).collect()[0].v == "[2018-07-20 13:18:00.0,2018-07-20 13:21:00.0],111,1,20.0"


def test_session_line(spark):
    df = _one(
        spark,
        [(111, dt.datetime(2018, 7, 20, 13, 20), dt.datetime(2018, 7, 20, 13, 25, 1, 120000), "DEAD")],
        "deviceid int, activeStartTime timestamp, activeEndTime timestamp, deviceactive string",
    )
    assert df.select(session_line().alias("v")).collect()[0].v == "111,2018-07-20 13:20:00.0,2018-07-20 13:25:01.12,DEAD"


def test_java_time_text_fraction(spark):
    df = _one(spark, [(dt.datetime(2018, 1, 1, 0, 0, 0, 123456),), (dt.datetime(2018, 1, 1, 0, 0, 0, 100000),)], "t timestamp")
    assert [r.v for r in df.select(java_time_text("t").alias("v")).collect()] == [
        "2018-01-01 00:00:00.123456",
        "2018-01-01 00:00:00.1",
    ]


def test_split_words_like_jvm(spark):
    df = _one(spark, [("a  b  ",), ("   ",), ("",), ("x y",), (None,)], "value string")
    got = [r.w for r in df.select(split_words("value").alias("w")).collect()]
    assert got == [["a", "", "b"], [], [""], ["x", "y"], []]


def test_csv_line(spark):
    df = _one(spark, [("x,2018-07-20T13:20:00.123",), ("x,bad",)], "value string")
    text, ts = csv_line_fields("value")
    rows = df.select(text.alias("v"), ts.alias("t")).collect()
    assert rows[0].v == "x" and rows[0].t == dt.datetime(2018, 7, 20, 13, 20, 0, 123000)
    assert rows[1].t is None
