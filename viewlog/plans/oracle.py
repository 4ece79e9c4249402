"""DuckDB SQL that computes the same results as the Spark queries.

The SQL is written independently of the Spark code, straight from the
operator definitions, over the raw test tables. Two engine differences are
bridged here:

* rounding: Spark rounds the shortest decimal form of a double half-up;
  ``rnd`` rounds the same decimal text in DuckDB;
* types: DuckDB date parts and some sums are BIGINT/HUGEINT, Spark's are
  INT/BIGINT; ``dayofweek`` is 0-based in DuckDB.
"""

from __future__ import annotations


def rnd(expr: str, n: int) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,17)), {n}) AS DOUBLE)"


def exact_avg(expr: str, scale: int) -> str:
    """Average of a fixed-point measure, summed exactly as integers."""
    unit = 10 ** scale
    return (f"CAST(sum(CAST(round(({expr}) * {unit}) AS BIGINT)) AS DOUBLE) / {unit}.0 "
            f"/ count({expr})")


def q(name: str) -> str:
    return f'"{name}"'


K = "json_extract_string(props, '$.k')"

SESSIONS_EV = f"""
SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE lpad(CAST(user_id AS VARCHAR), 12, '0') END AS "Mac",
  CAST(user_id AS VARCHAR) AS "CustomerID",
  concat('C', CAST(user_id % 10 AS VARCHAR)) AS "Contract",
  CAST(date_trunc('second', ts) AS TIMESTAMP) AS session_timestamp,
  CASE event_type WHEN 'view' THEN ' vod ' WHEN 'purchase' THEN 'VOD' ELSE 'iptv' END AS "AppName",
  CASE event_type WHEN 'view' THEN 'PlayVOD' WHEN 'purchase' THEN 'StopVOD '
    WHEN 'click' THEN 'StartChannel' WHEN 'error' THEN 'StopChannel' ELSE 'EnterIPTV' END AS "Event",
  {K} AS "ItemId",
  concat('Item ', {K}) AS "ItemName",
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(value * 10 AS FLOAT) END AS "RealTimePlaying",
  CAST(floor(value) AS BIGINT) AS "ElapsedTimePlaying",
  CAST({K} AS BIGINT) * 60 AS "Duration",
  CASE WHEN event_id % 2 = 0 THEN 'PlayingFromSearch' ELSE 'PlayingFromHome' END AS "Screen",
  concat('1.', CAST(event_id % 3 AS VARCHAR)) AS "Firmware",
  CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'VN' END AS "PublishCountry"
FROM events
"""

SESSIONS_EV_DUP = f"""
SELECT * FROM ({SESSIONS_EV})
UNION ALL
SELECT * REPLACE (
    CAST("RealTimePlaying" + CAST(1.0 AS FLOAT) AS FLOAT) AS "RealTimePlaying",
    CASE WHEN "Screen" = 'PlayingFromHome' THEN 'PlayingFromSearch' ELSE 'PlayingFromHome' END AS "Screen")
FROM ({SESSIONS_EV})
"""

SESSIONS_OR = """
SELECT lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS "Mac",
  CAST(o_custkey AS VARCHAR) AS "CustomerID",
  concat('C', CAST(o_custkey % 10 AS VARCHAR)) AS "Contract",
  CAST(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS TIMESTAMP) AS session_timestamp,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'VOD' ELSE 'IPTV' END AS "AppName",
  CASE WHEN o_orderpriority = '1-URGENT'
    THEN CASE o_orderstatus WHEN 'F' THEN 'STOPVOD' ELSE 'PLAYVOD' END
    ELSE CASE o_orderstatus WHEN 'F' THEN 'STOPCHANNEL' ELSE 'STARTCHANNEL' END END AS "Event",
  CAST(o_orderkey % 200 AS VARCHAR) AS "ItemId",
  concat('Item ', CAST(o_orderkey % 200 AS VARCHAR)) AS "ItemName",
  CAST(o_totalprice / 100 AS FLOAT) AS "RealTimePlaying",
  CAST(floor(o_totalprice / 100) AS BIGINT) AS "ElapsedTimePlaying",
  CAST((o_orderkey % 50) * 120 AS BIGINT) AS "Duration",
  CASE WHEN o_orderkey % 2 = 0 THEN 'PlayingFromSearch' ELSE 'PlayingFromHome' END AS "Screen",
  concat('1.', CAST(o_orderkey % 3 AS VARCHAR)) AS "Firmware",
  'VN' AS "PublishCountry"
FROM orders
"""

SESSION_COLS = ["Mac", "CustomerID", "Contract", "session_timestamp", "AppName", "Event",
                "ItemId", "ItemName", "RealTimePlaying", "ElapsedTimePlaying", "Duration",
                "Screen", "Firmware", "PublishCountry"]
DEDUP_KEYS = ["Mac", "session_timestamp", "Event", "ItemId"]

FACT_COLS = ["Mac", "CustomerID", "Contract", "session_timestamp", "session_date",
             "hour_of_day", "day_of_week", "month", "year", "AppName", "Event",
             "ItemId", "ItemName", "RealTimePlaying", "ElapsedTimePlaying", "Duration",
             "completion_rate", "watch_category", "is_primetime", "is_weekend",
             "Screen", "Firmware", "PublishCountry"]


def cols(names: list[str]) -> str:
    return ", ".join(q(c) for c in names)


def not_null(src: str) -> str:
    return f'SELECT * FROM ({src}) WHERE "Mac" IS NOT NULL AND session_timestamp IS NOT NULL'


def dedup(src: str, columns: list[str] = SESSION_COLS) -> str:
    others = [c for c in columns if c not in DEDUP_KEYS]
    order = ", ".join(f"{q(c)} ASC NULLS LAST" for c in others)
    return f"""
SELECT {cols(columns)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {cols(DEDUP_KEYS)} ORDER BY {order}) AS rn__
  FROM ({src})) WHERE rn__ = 1
"""


def fill_and_normalize(src: str) -> str:
    return f"""
SELECT * REPLACE (
    upper(trim("AppName")) AS "AppName",
    upper(trim("Event")) AS "Event",
    CASE WHEN "RealTimePlaying" IS NULL OR isnan("RealTimePlaying")
         THEN CAST(0 AS FLOAT) ELSE "RealTimePlaying" END AS "RealTimePlaying",
    coalesce("ElapsedTimePlaying", CAST(0 AS BIGINT)) AS "ElapsedTimePlaying")
FROM ({src})
"""


def clean(src: str) -> str:
    return fill_and_normalize(dedup(not_null(src)))


def features(src: str) -> str:
    return f"""
SELECT *,
  CASE WHEN "Duration" > 0 THEN {rnd('CAST("RealTimePlaying" AS DOUBLE) / "Duration"', 4)}
       ELSE NULL END AS completion_rate,
  CASE WHEN "RealTimePlaying" < 60 THEN 'short' WHEN "RealTimePlaying" < 600 THEN 'medium'
       WHEN "RealTimePlaying" < 3600 THEN 'long' ELSE 'binge' END AS watch_category,
  CASE WHEN hour_of_day BETWEEN 18 AND 23 THEN 1 ELSE 0 END AS is_primetime,
  CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend
FROM (
  SELECT *,
    CAST(hour(session_timestamp) AS INTEGER) AS hour_of_day,
    CAST(dayofweek(session_timestamp) + 1 AS INTEGER) AS day_of_week,
    CAST(session_timestamp AS DATE) AS session_date,
    CAST(month(session_timestamp) AS INTEGER) AS month,
    CAST(year(session_timestamp) AS INTEGER) AS year
  FROM ({src}))
"""


def fact(src: str) -> str:
    return f"SELECT {cols(FACT_COLS)} FROM ({features(clean(src))})"


FACT_EV = fact(SESSIONS_EV)
FACT_OR = fact(SESSIONS_OR)

USER_KEYS = ["Mac", "CustomerID", "Contract"]


def profiles(fact_sql: str, churn_days: int = 30) -> str:
    keys = cols(USER_KEYS)
    # Mode of AppName: highest count, then smallest name; NULLs are ignored.
    return f"""
WITH f AS ({fact_sql}),
agg AS (
  SELECT {keys},
    count(*) AS total_events,
    count(DISTINCT session_date) AS active_days,
    count(DISTINCT (session_date, hour_of_day)) AS session_count,
    sum(CAST("RealTimePlaying" AS DOUBLE)) AS total_watch_seconds,
    avg(CAST("RealTimePlaying" AS DOUBLE)) AS avg_watch_per_event,
    max("RealTimePlaying") AS max_single_watch,
    count(DISTINCT "ItemId") AS unique_content_watched,
    count(DISTINCT "AppName") AS unique_apps_used,
    max(session_date) AS last_active_date,
    min(session_date) AS first_active_date,
    avg(is_primetime) AS primetime_ratio,
    avg(is_weekend) AS weekend_ratio,
    {exact_avg('completion_rate', 4)} AS avg_completion_rate
  FROM f GROUP BY {keys}),
app_counts AS (
  SELECT {keys}, "AppName", count(*) AS n FROM f WHERE "AppName" IS NOT NULL
  GROUP BY {keys}, "AppName"),
app_mode AS (
  SELECT {keys}, "AppName" AS most_used_app FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, "AppName" ASC) AS rn__
    FROM app_counts) WHERE rn__ = 1),
ended AS (SELECT max(session_date) AS end_date FROM f)
SELECT a.*, m.most_used_app,
  CAST(date_diff('day', a.last_active_date, e.end_date) AS INTEGER) AS days_inactive,
  CAST(date_diff('day', a.first_active_date, a.last_active_date) AS INTEGER) AS days_since_first,
  CASE WHEN a.active_days > 0 THEN a.total_watch_seconds / a.active_days ELSE 0.0 END
    AS avg_daily_watch_seconds,
  CASE WHEN date_diff('day', a.last_active_date, e.end_date) >= {churn_days} THEN 1 ELSE 0 END
    AS churn_label
FROM agg a
LEFT JOIN app_mode m ON a."Mac" IS NOT DISTINCT FROM m."Mac"
  AND a."CustomerID" IS NOT DISTINCT FROM m."CustomerID"
  AND a."Contract" IS NOT DISTINCT FROM m."Contract"
CROSS JOIN ended e
"""


PROFILES_OR = profiles(FACT_OR)
PROFILES_EV = profiles(FACT_EV)


# --- ingest: what parsing the rendered lines must give, straight from events --

_MAC_E = "lpad(CAST(user_id AS VARCHAR), 12, '0')"
_MONTH_BAD = "event_id % 23 = 0"
_KIND = "(event_id // 50) % 8"

INGEST_STRINGS = f"""
SELECT {_MAC_E} AS "Mac", CAST(user_id AS VARCHAR) AS "CustomerID",
  CAST(NULL AS VARCHAR) AS "Contract", CAST(NULL AS VARCHAR) AS "Session",
  {_MAC_E} || ':' || CASE WHEN {_MONTH_BAD} THEN strftime(ts, '%Y:13:%d:%H:%M:%S')
                          ELSE strftime(ts, '%Y:%m:%d:%H:%M:%S') END || ':000' AS "SessionMainMenu",
  CASE WHEN event_type IN ('view', 'purchase') THEN 'VOD' ELSE 'IPTV' END AS "AppName",
  event_type AS "Event", {K} AS "ItemId", CAST(NULL AS VARCHAR) AS "ItemName",
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS "RealTimePlaying",
  CASE WHEN event_id % 19 = 0 THEN '1e3' ELSE CAST(value AS VARCHAR) END AS "ElapsedTimePlaying",
  CAST(CAST({K} AS BIGINT) * 60 AS VARCHAR) AS "Duration",
  CAST(NULL AS VARCHAR) AS "Screen", CAST(NULL AS VARCHAR) AS "Firmware",
  CAST(NULL AS VARCHAR) AS "PublishCountry",
  event_id, ts, value
FROM events
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'STOPVOD', NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  NULL, event_id, NULL, NULL
FROM events WHERE event_id % 50 = 0 AND {_KIND} = 4
"""

KEEP = ["Mac", "CustomerID", "Contract", "Session", "SessionMainMenu", "AppName", "Event",
        "ItemId", "ItemName", "RealTimePlaying", "ElapsedTimePlaying", "Duration",
        "Screen", "Firmware", "PublishCountry"]

LOGS_FROM_LINES = f"""
SELECT "Mac", "CustomerID", "Contract", "Session", "SessionMainMenu", "AppName", "Event",
  "ItemId", "ItemName",
  CASE WHEN event_id % 17 = 0 OR value IS NULL THEN NULL ELSE CAST(value AS FLOAT) END AS "RealTimePlaying",
  CASE WHEN event_id % 19 = 0 OR value IS NULL THEN NULL ELSE CAST(floor(value) AS BIGINT) END
    AS "ElapsedTimePlaying",
  CAST("Duration" AS BIGINT) AS "Duration",
  "Screen", "Firmware", "PublishCountry",
  CASE WHEN {_MONTH_BAD} OR ts IS NULL THEN NULL ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END
    AS session_timestamp
FROM ({INGEST_STRINGS})
"""

DISCOVERED = f"""
SELECT "column", count(*) AS records FROM (
  SELECT unnest([CASE WHEN event_id % 7 = 3 THEN 'MAC' ELSE 'Mac' END, 'CustomerID',
                 'SessionMainMenu', CASE WHEN event_id % 5 = 1 THEN 'appname' ELSE 'AppName' END,
                 CASE WHEN event_id % 11 = 5 THEN 'event' ELSE 'Event' END,
                 CASE WHEN event_id % 11 = 5 THEN 'itemId' ELSE 'ItemId' END,
                 'RealTimePlaying', 'ElapsedTimePlaying', 'Duration']) AS "column"
  FROM events
  UNION ALL
  SELECT unnest(['Mac', 'Event']) FROM events WHERE event_id % 50 = 0 AND {_KIND} = 4)
GROUP BY "column" ORDER BY "column"
"""

INGEST_COUNTS = f"""
SELECT count(*) + count(*) FILTER (WHERE event_id % 50 = 0) AS lines,
  count(*) + count(*) FILTER (WHERE event_id % 50 = 0 AND {_KIND} IN (3, 4)) AS parsed,
  count(*) + count(*) FILTER (WHERE event_id % 50 = 0 AND {_KIND} = 4) AS kept,
  count(*) FILTER (WHERE event_id % 50 = 0 AND {_KIND} <> 4) AS rejected
FROM events
"""

# What the extra line of every 50th event is, by kind; kind 4 is kept.
REJECTED = f"""
SELECT CASE {_KIND} WHEN 1 THEN 'not a dict' WHEN 2 THEN 'empty' WHEN 3 THEN 'no required key'
    WHEN 6 THEN 'value without text' ELSE 'not a literal' END AS reject_reason, count(*) AS lines
FROM events WHERE event_id % 50 = 0 AND {_KIND} <> 4 GROUP BY 1 ORDER BY 1
"""

# Two deliveries of the events as lines, a source per date; see the query.
SOURCE_CHANGES = """
WITH e AS (SELECT CAST(ts AS DATE) AS day, event_id FROM events),
ends AS (SELECT min(day) AS first, max(day) AS last FROM e),
b AS (SELECT day, count(*) AS n FROM e, ends WHERE day < last GROUP BY day),
a AS (SELECT day, count(*) AS n FROM e, ends WHERE day > first AND (day(day) % 2 = 0 OR event_id % 10 <> 0) GROUP BY day)
SELECT strftime(coalesce(a.day, b.day), '%Y-%m-%d') AS file,
  CASE WHEN b.day IS NULL THEN 'new' WHEN a.day IS NULL THEN 'gone' ELSE 'changed' END AS status,
  b.n AS lines_before, a.n AS lines_after
FROM a FULL JOIN b ON a.day = b.day WHERE a.n IS DISTINCT FROM b.n
"""

LOGS_COLS = KEEP + ["session_timestamp"]


def fact_from_logs(logs_sql: str) -> str:
    """The fact table built from ``logs_clean``-shaped rows (all 16 columns)."""
    cleaned = fill_and_normalize(dedup(not_null(logs_sql), LOGS_COLS))
    return f"SELECT {cols(FACT_COLS)} FROM ({features(cleaned)})"


FACT_FROM_LINES = fact_from_logs(LOGS_FROM_LINES)
