from pulsegrid.functions.routing import message_flag
from pulsegrid.operators.decode import (
    REASON_BAD_EVENT,
    REASON_BAD_KEY,
    REASON_BAD_READING,
    REASON_BAD_TIME,
    REASON_BAD_VALUE,
    decode_events,
    decode_readings,
    malformed_messages,
)
from tests.helpers import event, messages, reading

T0 = "2018-07-20 13:20:00.000"


def test_sample_message_decodes(spark):
    body = (
        '{"name":"iottesttimeseries","header":{"timeseries":1,"connectorid":42,"deviceid":907,'
        '"eventtime":"2023-02-03 04:05:06.789"},"iotdata":{"values":[{"variableid":8,"value":"-3.5"}]}}'
    )
    rows = decode_readings(messages(spark, [("907,1", body)])).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.name, r.timeseries, r.connectorid, r.deviceid, r.variableid, r.value) == (
        "iottesttimeseries", 1, 42, 907, "8", -3.5,
    )
    assert str(r.eventtime) == "2023-02-03 04:05:06.789000"


def test_routing_by_key_flag(spark):
    df = spark.createDataFrame([("d,1",), ("d,0",), ("d,2",), ("d",), (None,), ("d,x",), ("d, 1",), ("d,+1",)], "key string")
    got = [r.f for r in df.select(message_flag("key").alias("f")).collect()]
    assert got == [1, 0, 2, None, None, None, None, 1]


def test_keys_route_and_malformed(spark):
    r = reading(1, 10, T0, [("v", 1.0)])
    e = event(1, 10, T0, "ALIVE")
    msgs = messages(spark, [("1,1", r), ("1,0", e), ("1,2", r), ("1", r), (None, r), ("1,x", r)])
    assert decode_readings(msgs).count() == 1
    assert decode_events(msgs).count() == 1
    bad = sorted((m.key or "", m.reason) for m in malformed_messages(msgs).collect())
    assert bad == [("", REASON_BAD_KEY), ("1", REASON_BAD_KEY), ("1,x", REASON_BAD_KEY)]


def test_json_hand_cases(spark):
    no_values = '{"name":"n","header":{"timeseries":1,"connectorid":1,"deviceid":1,"eventtime":"%s"}}' % T0
    msgs = messages(
        spark,
        [
            ("1,1", "{bad"),
            ("1,0", "{bad"),
            ("1,1", reading(1, 1, T0, [])),
            ("1,1", no_values),
            ("1,1", reading(1, 1, T0, [("a", "20")])),
            ("1,1", reading(1, 1, T0, [("b", 20)])),
            ("1,1", reading(1, 1, T0, [("c", "abc")])),
        ],
    )
    got = sorted((r.variableid, r.value) for r in decode_readings(msgs).collect())
    assert got == [("a", 20.0), ("b", 20.0)]
    assert decode_events(msgs).count() == 0
    reasons = sorted(r.reason for r in malformed_messages(msgs).collect())
    assert reasons == sorted([REASON_BAD_READING, REASON_BAD_EVENT, REASON_BAD_VALUE])


def test_null_device_is_malformed_null_connector_is_not(spark):
    msgs = messages(
        spark,
        [("1,1", reading(None, 10, T0, [("v", 1)])), ("1,1", reading(1, None, T0, [("v", 1)]))],
    )
    rows = decode_readings(msgs).collect()
    assert [(r.deviceid, r.connectorid) for r in rows] == [(1, None)]
    assert [r.reason for r in malformed_messages(msgs).collect()] == [REASON_BAD_READING]


def test_event_decode_keeps_status_text_and_seq(spark):
    msgs = messages(spark, [("5,0", event(5, 1, T0, " alive "), 42)])
    r = decode_events(msgs).collect()[0]
    assert (r.deviceid, r.connectorid, r.status, r.seq) == (5, 1, " alive ", 42)


def test_decode_is_map_only(spark):
    msgs = messages(spark, [("1,1", reading(1, 1, T0, [("v", 1)]))])
    plan = decode_readings(msgs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_times_before_1970_are_malformed(spark):
    old = "1969-12-31 23:59:59.999"
    msgs = messages(spark, [("1,1", reading(1, 1, old, [("v", 1.0), ("w", 2.0)])), ("1,1", reading(1, 1, "1970-01-01 00:00:00.000", [("v", 1.0)])), ("1,0", event(1, 1, old, "ALIVE"))])
    assert decode_readings(msgs).count() == 1 and decode_events(msgs).count() == 1
    assert [r.reason for r in malformed_messages(msgs).collect()] == [REASON_BAD_TIME]
