import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.aggregate import csv_window_count, malformed_csv_lines, word_count
from pulsegrid.operators.decode import cast_messages, decode_readings
from pulsegrid.schemas import METADATA, REPORT
from pulsegrid.sinks.misc import console_writer, csv_file_writer
from pulsegrid.sources.files import json_messages, read_json_lines, text_file_stream
from pulsegrid.sources.kafka import kafka_lines, kafka_messages
from pulsegrid.sources.tables import read_metadata
from pulsegrid.streaming.queries import await_any
from tests.helpers import reading


def test_kafka_source_is_thin_and_reports_missing_connector(spark):
    # the connector jar is not installed here; the call must fail clearly
    with pytest.raises(Exception) as info:
        kafka_messages(spark, "localhost:9", "loadtest")
    assert "kafka" in str(info.value).lower()
    with pytest.raises(Exception):
        kafka_lines(spark, "localhost:9", "test2")


def test_cast_binary_messages(spark):
    raw = spark.createDataFrame([(bytearray(b"1,1"), bytearray(reading(1, 1, "2018-07-20 13:20:00.000", [("v", 3)]).encode()), 5)], "key binary, value binary, offset long")
    msgs = cast_messages(raw).withColumnRenamed("offset", "seq")
    assert [r.value for r in decode_readings(msgs).collect()] == [3.0]


def test_read_metadata_casts_columns(spark, workdir):
    src = spark.createDataFrame([("g", 1, "c", 2, "v", 3, "DOUBLE", 9)], "deviceguid string, deviceid long, connectorguid string, connectorid long, variablename string, variableid long, variableDataType string, row_order int")
    src.write.parquet(f"{workdir}/meta")
    m = read_metadata(spark, f"{workdir}/meta")
    assert m.schema == METADATA
    assert m.collect()[0].connectorid == 2


def test_nested_report_sample(spark):
    sample = '{"ErrorMessage": "late", "IsError": true, "Report": {"tl": [{"TlID": "A1", "CID": "north"}, {"TlID": "B2", "CID": "south"}]}}'
    df = json_messages(spark, [sample]).select(F.from_json("value", REPORT).alias("j"))
    got = [(r.TlID, r.CID) for r in df.select(F.explode("j.Report.tl").alias("t")).select("t.*").collect()]
    assert got == [("A1", "north"), ("B2", "south")]


def test_read_json_lines_with_schema(spark, workdir):
    from pulsegrid.schemas import READING_MESSAGE

    with open(f"{workdir}/m.json", "w") as f:
        f.write(reading(31, 64, "2021-05-06 07:08:09.000", [("p", "7.25")]) + "\n")
    row = read_json_lines(spark, f"{workdir}/m.json", READING_MESSAGE).collect()[0]
    assert row.header.deviceid == 31 and row.iotdata["values"][0].value == "7.25"


def test_csv_window_count_and_malformed(spark):
    lines = spark.createDataFrame(
        [("x,2018-07-20T13:20:00.123",), ("x,2018-07-20T13:21:59.000",), ("y,2018-07-20T13:20:00.000",), ("x,bad",)],
        "value string",
    )
    got = sorted((r.value, r.window.start.minute, r["count"]) for r in csv_window_count(lines).collect())
    assert got == [("x", 20, 2), ("y", 20, 1)]
    assert [r.value for r in malformed_csv_lines(lines).collect()] == ["x,bad"]


def test_console_and_csv_sinks_and_await_any(spark, workdir, capsys):
    import os

    os.makedirs(f"{workdir}/lines", exist_ok=True)
    with open(f"{workdir}/lines/in.txt", "w") as f:
        f.write("a b a\nc\n")
    lines = text_file_stream(spark, f"{workdir}/lines")
    q = console_writer(word_count(lines), f"{workdir}/chk1", output_mode="complete")
    q.processAllAvailable()
    q.stop()
    src = text_file_stream(spark, f"{workdir}/lines").select(F.upper("value").alias("value"))
    q2 = csv_file_writer(src, f"{workdir}/csv", f"{workdir}/chk2", trigger_available_now=True)
    await_any(spark, timeout=120)
    q2.awaitTermination()
    assert sorted(r.value for r in spark.read.text(f"{workdir}/csv").collect()) == ["A B A", "C"]


def test_word_count_lines(spark):
    from pulsegrid.plans.pipelines import word_count_lines

    lines = spark.createDataFrame([("a b a",)], "value string")
    got = sorted(r.value for r in word_count_lines(word_count(lines)).collect())
    assert got == ["a,2", "b,1"]
