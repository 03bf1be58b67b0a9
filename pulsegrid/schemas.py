"""Fixed schemas, written by hand; nothing is inferred."""

from pyspark.sql import types as T

HEADER = T.StructType(
    [
        T.StructField("timeseries", T.IntegerType()),
        T.StructField("connectorid", T.IntegerType()),
        T.StructField("deviceid", T.IntegerType()),
        T.StructField("eventtime", T.TimestampType()),
    ]
)

# ``value`` is parsed as text: a quoted number ("20") and a bare one (20) both
# arrive as '20', and an explicit cast then tells a number from junk.
READING_VALUE = T.StructType(
    [
        T.StructField("variableid", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

READING_BODY = T.StructType([T.StructField("values", T.ArrayType(READING_VALUE))])

READING_MESSAGE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("header", HEADER),
        T.StructField("iotdata", READING_BODY),
    ]
)

EVENT_BODY = T.StructType([T.StructField("status", T.StringType())])

EVENT_MESSAGE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("header", HEADER),
        T.StructField("values", EVENT_BODY),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

READING = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("timeseries", T.IntegerType()),
        T.StructField("connectorid", T.IntegerType()),
        T.StructField("deviceid", T.IntegerType()),
        T.StructField("eventtime", T.TimestampType()),
        T.StructField("variableid", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

VALIDATED_READING = T.StructType(READING.fields + [T.StructField("result", T.StringType())])

EVENT = T.StructType(
    [
        T.StructField("connectorid", T.IntegerType()),
        T.StructField("deviceid", T.IntegerType()),
        T.StructField("eventtime", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

METADATA = T.StructType(
    [
        T.StructField("deviceguid", T.StringType()),
        T.StructField("deviceid", T.IntegerType()),
        T.StructField("connectorguid", T.StringType()),
        T.StructField("connectorid", T.IntegerType()),
        T.StructField("variablename", T.StringType()),
        T.StructField("variableid", T.IntegerType()),
        T.StructField("variableDataType", T.StringType()),
        T.StructField("row_order", T.LongType()),
    ]
)

LINE = T.StructType([T.StructField("value", T.StringType())])

# Nested report sample: a struct holding an array of two-field structs.
REPORT = T.StructType(
    [
        T.StructField(
            "Report",
            T.StructType(
                [
                    T.StructField(
                        "tl",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("CID", T.StringType()),
                                    T.StructField("TlID", T.StringType()),
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)
