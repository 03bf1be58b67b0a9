"""Independent SQL (DuckDB dialect) for each batch query of the catalogue,
over the raw test tables. The message envelope is undone here: the SQL starts
from ``events`` and ``customer`` through the same fixed mapping."""

from __future__ import annotations

_TIME_TEXT = "regexp_replace(strftime({0}, '%Y-%m-%d %H:%M:%S.%f'), '0{{1,5}}$', '')"


def _jt(expr: str) -> str:
    return _TIME_TEXT.format(expr)


_BASE = """
dev AS (
  SELECT event_id AS seq,
         CAST(user_id AS INTEGER) AS deviceid,
         CAST(user_id % 5 AS INTEGER) AS connectorid,
         date_trunc('millisecond', ts) AS eventtime,
         event_type AS variableid,
         value,
         CASE WHEN event_type = 'signup' THEN ' alive '
              WHEN event_type = 'error' THEN 'DEAD'
              ELSE upper(event_type) END AS status,
         props
  FROM events
),
readings AS (
  SELECT 'iottesttimeseries' AS name, CAST(1 AS INTEGER) AS timeseries, connectorid, deviceid,
         eventtime, variableid, value FROM dev
  UNION ALL
  SELECT 'iottesttimeseries', CAST(1 AS INTEGER), connectorid, deviceid, eventtime, variableid, value
  FROM dev WHERE seq % 3 = 0
),
multi AS (
  SELECT 'iottesttimeseries' AS name, CAST(1 AS INTEGER) AS timeseries, connectorid, deviceid,
         eventtime, variableid, value FROM dev
  UNION ALL
  SELECT 'iottesttimeseries', CAST(1 AS INTEGER), connectorid, deviceid, eventtime, 'k',
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)
  FROM dev WHERE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL
),
cust AS (
  SELECT *, CASE WHEN c_nationkey % 2 = 0 THEN c_custkey % 5 ELSE (c_custkey + 1) % 5 END AS conn
  FROM customer WHERE c_custkey % 7 <> 0
),
meta_all AS (
  SELECT 'dev-' || CAST(c_custkey AS VARCHAR) AS deviceguid, CAST(c_custkey AS INTEGER) AS deviceid,
         'conn-' || CAST(conn AS VARCHAR) AS connectorguid, CAST(conn AS INTEGER) AS connectorid,
         lower(c_mktsegment) AS variablename, CAST(c_nationkey AS INTEGER) AS variableid,
         'DOUBLE' AS variableDataType, CAST(c_custkey * 2 + 1 AS BIGINT) AS row_order
  FROM cust
  UNION ALL
  SELECT 'dev-' || CAST(c_custkey AS VARCHAR), CAST(c_custkey AS INTEGER),
         'conn-' || CAST((conn + 1) % 5 AS VARCHAR), CAST((conn + 1) % 5 AS INTEGER),
         lower(c_mktsegment), CAST(c_nationkey AS INTEGER), 'DOUBLE', CAST(c_custkey * 2 AS BIGINT)
  FROM cust WHERE c_custkey % 3 = 0
),
meta AS (
  SELECT * FROM meta_all
  QUALIFY row_number() OVER (PARTITION BY deviceid ORDER BY row_order DESC) = 1
),
validated AS (
  SELECT r.name, r.timeseries, r.connectorid, r.deviceid, r.eventtime, r.variableid, r.value,
         CASE WHEN m.deviceid IS NULL THEN 'deviceid not found in metadata'
              WHEN m.connectorid = r.connectorid THEN 'Success'
              ELSE 'Connector id mismatch' END AS result
  FROM readings r LEFT JOIN meta m ON r.deviceid = m.deviceid
),
dedup AS (SELECT DISTINCT * FROM validated),
good AS (SELECT * FROM dedup WHERE result = 'Success'),
multi_good AS (
  SELECT DISTINCT r.*
  FROM multi r JOIN meta m ON r.deviceid = m.deviceid AND m.connectorid = r.connectorid
),
status_events AS (
  SELECT connectorid, deviceid, eventtime, seq,
         CASE upper(trim(status)) WHEN 'ALIVE' THEN 1 WHEN 'DEAD' THEN 2 END AS code
  FROM dev WHERE upper(trim(status)) IN ('ALIVE', 'DEAD')
),
prev_status AS (
  SELECT *, lag(code) OVER (PARTITION BY connectorid, deviceid ORDER BY eventtime, seq) AS prev
  FROM status_events
),
kept AS (
  SELECT * FROM prev_status
  WHERE (code = 1 AND coalesce(prev, 2) = 2) OR (code = 2 AND prev = 1)
),
paired AS (
  SELECT *, lead(code) OVER w AS next_code, lead(eventtime) OVER w AS next_time
  FROM kept WINDOW w AS (PARTITION BY connectorid, deviceid ORDER BY eventtime, seq)
),
sessions AS (
  SELECT connectorid, deviceid, eventtime AS activeStartTime, next_time AS activeEndTime,
         'DEAD' AS deviceactive
  FROM paired WHERE code = 1 AND next_code = 2
)
"""


_SKEWED = """
dev AS (
  SELECT seq, deviceid, deviceid % 5 AS connectorid, eventtime, code FROM (
    SELECT event_id AS seq, CAST(CASE WHEN event_id % 10 = 0 THEN user_id ELSE 1 END AS INTEGER) AS deviceid,
           date_trunc('millisecond', ts) AS eventtime,
           CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN 2 END AS code
    FROM events)
),
status_events AS (SELECT * FROM dev WHERE code IS NOT NULL)
"""

# silence ends a session: a closing event (code 3) a timeout after the last event before it
_TIMEOUT = """
, horizon AS (SELECT max(eventtime) - INTERVAL '10 minutes' AS until FROM status_events),
spaced AS (
  SELECT *, lead(eventtime) OVER (PARTITION BY connectorid, deviceid ORDER BY eventtime, seq) AS next_event FROM status_events
),
closings AS (
  SELECT connectorid, deviceid, eventtime + INTERVAL '2 days' AS eventtime, 9223372036854775807 AS seq, 3 AS code
  FROM spaced, horizon
  WHERE next_event - eventtime > INTERVAL '2 days' OR next_event IS NULL AND eventtime + INTERVAL '2 days' < until
),
closed_events AS (SELECT connectorid, deviceid, eventtime, seq, code FROM status_events UNION ALL SELECT * FROM closings)
"""


def _sessions(events: str) -> str:
    """Sessions of coded events: 1 opens, 2 and 3 (silence) close."""
    return f"""
SELECT connectorid, deviceid, eventtime AS activeStartTime, next_time AS activeEndTime,
       CASE next_code WHEN 3 THEN 'TIMEOUT' ELSE 'DEAD' END AS deviceactive
FROM (
  SELECT *, lead(code) OVER w AS next_code, lead(eventtime) OVER w AS next_time FROM (
    SELECT *, lag(code) OVER (PARTITION BY connectorid, deviceid ORDER BY eventtime, seq) AS prev FROM {events}
  ) WHERE (code = 1 AND coalesce(prev, 2) <> 1) OR (code <> 1 AND prev = 1)
  WINDOW w AS (PARTITION BY connectorid, deviceid ORDER BY eventtime, seq)
) WHERE code = 1 AND next_code <> 1"""


def _q(body: str) -> str:
    return "WITH " + _BASE.strip() + "\n" + body.strip()


_READING_COLS = "name, timeseries, connectorid, deviceid, eventtime, variableid, value"

_ROW_KEY_COMPAT = (
    "printf('%02X%08X%08X%016X', deviceid % 10, deviceid, connectorid, "
    "9223372036854775807 - (epoch_us({t}) // 1000))"
)


def _row_key(t: str = "eventtime", compat: bool = False) -> str:
    base = _ROW_KEY_COMPAT.format(t=t)
    return base if compat else f"({base} || hex(variableid))"


def _table_cols() -> str:
    return (
        "connectorid AS CONNECTORID, deviceid AS DEVICEID, "
        "strftime(eventtime, '%Y-%m-%d %H:%M:%S.%g') AS EVENTTIME, "
        "variableid AS VARIABLEID, value AS VALUE, " + _row_key() + " AS row_key"
    )


def _window_avg(width: str) -> str:
    return _q(
        f"""
SELECT window_start, window_start + INTERVAL '{width}' AS window_end, deviceid, variableid, avg_value
FROM (
  SELECT time_bucket(INTERVAL '{width}', eventtime, TIMESTAMP '1970-01-01') AS window_start,
         deviceid, variableid, round(avg(value), 6) AS avg_value
  FROM good GROUP BY 1, 2, 3
)"""
    )


def _window_count(width: str, src: str, keys: str, time_col: str = "eventtime") -> str:
    return _q(
        f"""
SELECT window_start, window_start + INTERVAL '{width}' AS window_end, {keys}, count
FROM (
  SELECT time_bucket(INTERVAL '{width}', {time_col}, TIMESTAMP '1970-01-01') AS window_start,
         {keys}, count(*) AS count
  FROM {src} GROUP BY ALL
)"""
    )


def batch_oracle() -> dict[str, str]:
    return {
        "decode_readings": _q(f"SELECT {_READING_COLS} FROM readings"),
        "decode_events": _q("SELECT connectorid, deviceid, eventtime, status, seq FROM dev"),
        "malformed_messages": _q(
            """
SELECT CASE k WHEN 1 THEN CAST(user_id AS VARCHAR)
              WHEN 2 THEN CAST(user_id AS VARCHAR) || ',x'
              WHEN 3 THEN NULL
              WHEN 4 THEN CAST(user_id AS VARCHAR) || ',1'
              WHEN 5 THEN CAST(user_id AS VARCHAR) || ',1'
              WHEN 9 THEN CAST(user_id AS VARCHAR) || ',1'
              WHEN 6 THEN CAST(user_id AS VARCHAR) || ',0' END AS key,
       event_id AS seq,
       CASE WHEN k IN (1, 2, 3) THEN 'key has no integer flag'
            WHEN k = 4 THEN 'reading is not parsable'
            WHEN k = 5 THEN 'reading value is not a number'
            WHEN k = 9 THEN 'reading time is before 1970'
            WHEN k = 6 THEN 'event is not parsable' END AS reason
FROM (SELECT *, event_id % 50 AS k FROM events) WHERE k BETWEEN 1 AND 6 OR k = 9"""
        ),
        "multi_value_readings": _q(f"SELECT {_READING_COLS} FROM multi"),
        "json_batch": _q(f"SELECT {_READING_COLS} FROM readings"),
        "binary_messages": _q(f"SELECT {_READING_COLS} FROM readings"),
        "metadata_read": _q(
            "SELECT deviceguid, deviceid, connectorguid, connectorid, variablename, variableid, "
            "variableDataType, row_order FROM meta_all"
        ),
        "nested_report": _q(
            """
SELECT 'F' || CAST(event_id AS VARCHAR) AS TlID, event_type AS CID FROM events
UNION ALL
SELECT 'K' || CAST(event_id AS VARCHAR) AS TlID, event_type AS CID FROM events"""
        ),
        "metadata_latest": _q(
            "SELECT deviceid, deviceguid, connectorguid, connectorid, variablename, variableid, "
            "variableDataType, row_order FROM meta"
        ),
        "validate_readings": _q(f"SELECT {_READING_COLS}, result FROM validated"),
        "validate_readings_salted": _q(f"SELECT {_READING_COLS}, result FROM validated"),
        "validation_counts": _q("SELECT result, count(*) AS count FROM dedup GROUP BY result"),
        "dedup_readings": _q(f"SELECT {_READING_COLS}, result FROM dedup"),
        "good_readings": _q(f"SELECT {_table_cols()} FROM good"),
        "error_readings": _q(f"SELECT {_table_cols()}, result AS RESULT FROM dedup WHERE result <> 'Success'"),
        "row_key": """
SELECT CAST(user_id AS INTEGER) AS deviceid, CAST(user_id % 5 AS INTEGER) AS connectorid, ts AS eventtime,
       event_type AS variableid,
       printf('%02X%08X%08X%016X', user_id % 10, user_id, user_id % 5,
              9223372036854775807 - (epoch_us(ts) // 1000)) AS row_key_compat,
       printf('%02X%08X%08X%016X', user_id % 10, user_id, user_id % 5,
              9223372036854775807 - (epoch_us(ts) // 1000)) || hex(event_type) AS row_key
FROM events""".strip(),
        "latest_by_key": _q(
            f"""
SELECT row_key, CONNECTORID, DEVICEID, EVENTTIME, VARIABLEID, VALUE FROM (
  SELECT {_row_key(compat=True)} AS row_key, connectorid AS CONNECTORID, deviceid AS DEVICEID,
         strftime(eventtime, '%Y-%m-%d %H:%M:%S.%g') AS EVENTTIME, variableid AS VARIABLEID, value AS VALUE
  FROM multi_good
)
QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY VARIABLEID DESC, VALUE DESC) = 1"""
        ),
        "newest_readings": _q(
            f"""
SELECT {_table_cols()} FROM (SELECT DISTINCT * FROM readings) r
WHERE (deviceid, connectorid) = (SELECT (deviceid, connectorid) FROM readings ORDER BY eventtime DESC, deviceid, connectorid LIMIT 1)
ORDER BY row_key LIMIT 20"""
        ),
        "readings_between": _q(
            f"""
SELECT {_table_cols()} FROM (SELECT DISTINCT * FROM readings) r
WHERE (deviceid, connectorid) = (SELECT (deviceid, connectorid) FROM readings ORDER BY eventtime DESC, deviceid, connectorid LIMIT 1)
  AND eventtime >= TIMESTAMP '2024-01-08' AND eventtime < TIMESTAMP '2024-01-15'"""
        ),
        "window_avg": _window_avg("3 minutes"),
        "window_avg_6h": _window_avg("6 hours"),
        "window_avg_10m": _window_avg("10 minutes"),
        "window_avg_line": _q(
            f"""
SELECT '[' || {_jt('window_start')} || ',' || {_jt("window_start + INTERVAL '3 minutes'")} || ']' AS window_text,
       deviceid, variableid, avg_value
FROM (
  SELECT time_bucket(INTERVAL '3 minutes', eventtime, TIMESTAMP '1970-01-01') AS window_start,
         deviceid, variableid, round(avg(value), 6) AS avg_value
  FROM good GROUP BY 1, 2, 3
)"""
        ),
        "window_count_device": _window_count("10 minutes", "readings", "deviceid"),
        "window_count_variable": _window_count("2 minutes", "good", "deviceid, variableid"),
        "device_count": _q("SELECT deviceid, count(*) AS count FROM good GROUP BY deviceid"),
        "last_seen": _q(
            "SELECT connectorid, deviceid, max(eventtime) AS last_eventtime FROM dev GROUP BY connectorid, deviceid"
        ),
        "word_count": """
SELECT w AS value, count(*) AS count
FROM (
  SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS w FROM documents
  WHERE text IS NOT NULL AND NOT (text <> '' AND rtrim(text, ' ') = '')
)
GROUP BY w""".strip(),
        "word_count_line": """
SELECT w || ',' || CAST(count(*) AS VARCHAR) AS value
FROM (
  SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS w FROM documents
  WHERE text IS NOT NULL AND NOT (text <> '' AND rtrim(text, ' ') = '')
)
GROUP BY w""".strip(),
        "csv_window_count": """
SELECT window_start, window_start + INTERVAL '2 minutes' AS window_end, value, count
FROM (
  SELECT time_bucket(INTERVAL '2 minutes', date_trunc('millisecond', ts), TIMESTAMP '1970-01-01') AS window_start,
         event_type AS value, count(*) AS count
  FROM events WHERE event_id % 50 <> 1 GROUP BY ALL
)""".strip(),
        "device_sessions": _q(
            "SELECT connectorid, deviceid, activeStartTime, activeEndTime, deviceactive FROM sessions"
        ),
        "device_sessions_timeout": "WITH " + _BASE.strip() + _TIMEOUT + _sessions("closed_events"),
        "device_sessions_skewed": "WITH " + _SKEWED.strip() + _sessions("status_events"),
        "event_order": _q(
            """
SELECT connectorid, deviceid, eventtime, status, seq,
       row_number() OVER (PARTITION BY connectorid, deviceid ORDER BY eventtime, seq) AS event_order
FROM dev"""
        ),
        "session_line": _q(
            f"""
SELECT CAST(deviceid AS VARCHAR) || ',' || {_jt('activeStartTime')} || ',' || {_jt('activeEndTime')}
       || ',' || deviceactive AS value
FROM sessions"""
        ),
    }


def stream_oracle() -> dict[str, str]:
    """SQL for the streaming queries (their batch equivalents, with the
    watermark's hold-back where append mode applies)."""
    b = batch_oracle()
    return {
        "ingest_stream_good": b["good_readings"],
        "ingest_stream_error": b["error_readings"],
        "malformed_stream": b["malformed_messages"],
        "late_rows_stream": _q(
            """
SELECT window_start, window_start + INTERVAL '3 minutes' AS window_end, deviceid, variableid, avg_value
FROM (
  SELECT time_bucket(INTERVAL '3 minutes', eventtime, TIMESTAMP '1970-01-01') AS window_start,
         deviceid, variableid, round(avg(value), 6) AS avg_value
  FROM good GROUP BY 1, 2, 3
)
WHERE window_start + INTERVAL '3 minutes' <= (SELECT max(eventtime) FROM readings) - INTERVAL '10 minutes'"""
        ),
        "event_dedup_stream": _q("SELECT DISTINCT connectorid, deviceid, eventtime, status FROM dev"),
        "window_count_variable_stream": b["window_count_variable"],
        "csv_window_count_stream": b["csv_window_count"],
        "csv_sink_stream": """
SELECT event_type AS value, date_trunc('millisecond', ts) AS generated_timestamp
FROM events WHERE event_id % 50 <> 1""".strip(),
        "latest_by_key_table": _q(
            f"""
SELECT row_key, CONNECTORID, DEVICEID, EVENTTIME, VARIABLEID, VALUE FROM (
  SELECT DISTINCT {_row_key(compat=True)} AS row_key, connectorid AS CONNECTORID, deviceid AS DEVICEID,
         strftime(eventtime, '%Y-%m-%d %H:%M:%S.%g') AS EVENTTIME, variableid AS VARIABLEID, value AS VALUE
  FROM multi_good
)
QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY VARIABLEID DESC, VALUE DESC) = 1"""
        ),
        "merged_by_key_table": _q(
            f"""
SELECT row_key, CONNECTORID, DEVICEID, EVENTTIME, VARIABLEID, VALUE FROM (
  SELECT DISTINCT {_row_key(compat=True)} AS row_key, connectorid AS CONNECTORID, deviceid AS DEVICEID,
         strftime(eventtime, '%Y-%m-%d %H:%M:%S.%g') AS EVENTTIME, variableid AS VARIABLEID, value AS VALUE
  FROM multi_good
)
QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY VARIABLEID DESC, VALUE DESC) = 1"""
        ),
        "committed_tables_stream": _q(f"SELECT {_table_cols()}, result AS RESULT FROM dedup"),
        "foreach_writer_stream": b["good_readings"],
        "window_avg_stream": _q(
            """
SELECT window_start, window_start + INTERVAL '3 minutes' AS window_end, deviceid, variableid, avg_value
FROM (
  SELECT time_bucket(INTERVAL '3 minutes', eventtime, TIMESTAMP '1970-01-01') AS window_start,
         deviceid, variableid, round(avg(value), 6) AS avg_value
  FROM good GROUP BY 1, 2, 3
)
WHERE window_start + INTERVAL '3 minutes' <= (SELECT max(eventtime) FROM readings) - INTERVAL '10 minutes'"""
        ),
        "window_avg_two_hop": _q(
            """
SELECT window_start, window_start + INTERVAL '3 minutes' AS window_end, deviceid, variableid, avg_value
FROM (
  SELECT time_bucket(INTERVAL '3 minutes', eventtime, TIMESTAMP '1970-01-01') AS window_start,
         deviceid, variableid, round(avg(value), 6) AS avg_value
  FROM good GROUP BY 1, 2, 3
)
WHERE window_start + INTERVAL '3 minutes' <= (SELECT max(eventtime) FROM good) - INTERVAL '3 minutes'"""
        ),
        "device_sessions_stream": b["device_sessions"],
        "device_sessions_skewed_stream": b["device_sessions_skewed"],
        "device_sessions_timeout_stream": b["device_sessions_timeout"],
        "session_line_stream": b["session_line"],
        "average_line_stream": _q(
            f"""
SELECT '[' || {_jt('window_start')} || ',' || {_jt("window_start + INTERVAL '3 minutes'")} || ']' AS window_text,
       deviceid, variableid, avg_value
FROM (
  SELECT time_bucket(INTERVAL '3 minutes', eventtime, TIMESTAMP '1970-01-01') AS window_start,
         deviceid, variableid, round(avg(value), 6) AS avg_value
  FROM good GROUP BY 1, 2, 3
)
WHERE window_start + INTERVAL '3 minutes' <= (SELECT max(eventtime) FROM readings) - INTERVAL '10 minutes'"""
        ),
        "last_active_stream": _q(
            """
SELECT connectorid, deviceid, max(eventtime) AS lastactivetime, max(eventtime) FILTER (WHERE begins) AS activetime
FROM (
  SELECT *, coalesce(eventtime - lag(eventtime) OVER (PARTITION BY connectorid, deviceid ORDER BY eventtime, seq) > INTERVAL '1 day', true) AS begins
  FROM dev
)
GROUP BY connectorid, deviceid"""
        ),
        "window_count_device_stream": b["window_count_device"],
        "word_count_stream": b["word_count"],
    }
