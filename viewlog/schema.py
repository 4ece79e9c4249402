"""Column names, types and fixed values of the session-log data model.

Everything a query needs to agree with the original pipeline's output lives
here, so operators never hard-code a name twice.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the original pipeline's) -----------------------
# Raw key spellings and the canonical column each one stands for, in the order
# they are applied. When several spellings of one column occur in the same
# record, the canonical spelling wins, then the aliases in this order.
COLUMN_ALIASES: list[tuple[str, str]] = [
    ("mac", "Mac"),
    ("MAC", "Mac"),
    ("customerid", "CustomerID"),
    ("Customerid", "CustomerID"),
    ("sessionmainmenu", "SessionMainMenu"),
    ("appname", "AppName"),
    ("event", "Event"),
    ("itemid", "ItemId"),
    ("itemId", "ItemId"),
    ("ItemID", "ItemId"),
    ("itemname", "ItemName"),
    ("realtimeplaying", "RealTimePlaying"),
    ("realTimePlaying", "RealTimePlaying"),
    ("Realtimeplaying", "RealTimePlaying"),
    ("elapsedtimeplaying", "ElapsedTimePlaying"),
    ("ElapsedTimePlaying", "ElapsedTimePlaying"),
    ("duration", "Duration"),
    ("firmware", "Firmware"),
    ("screen", "Screen"),
    ("publishcountry", "PublishCountry"),
    ("publishCountry", "PublishCountry"),
]

# Columns kept from a raw record, in output order.
KEEP_FIELDS: list[str] = [
    "Mac", "CustomerID", "Contract",
    "Session", "SessionMainMenu",
    "AppName", "Event",
    "ItemId", "ItemName",
    "RealTimePlaying", "ElapsedTimePlaying", "Duration",
    "Screen", "Firmware", "PublishCountry",
]

# Columns of the fact table, in output order.
FACT_COLUMNS: list[str] = [
    "Mac", "CustomerID", "Contract",
    "session_timestamp", "session_date",
    "hour_of_day", "day_of_week", "month", "year",
    "AppName", "Event",
    "ItemId", "ItemName",
    "RealTimePlaying", "ElapsedTimePlaying", "Duration",
    "completion_rate", "watch_category",
    "is_primetime", "is_weekend",
    "Screen", "Firmware", "PublishCountry",
]

# A user is one value of these.
USER_KEYS: list[str] = ["Mac", "CustomerID", "Contract"]

# A raw record is kept only when it has one of these exact keys.
REQUIRED_KEYS: tuple[str, ...] = ("Mac", "MAC")

# Session time inside SessionMainMenu: the first ":YYYY:MM:DD:HH:MM:SS".
SESSION_TS_PATTERN = r":(\d{4}:\d{2}:\d{2}:\d{2}:\d{2}:\d{2})"

# Dedup keys of the fact table.
DEDUP_KEYS: list[str] = ["Mac", "session_timestamp", "Event", "ItemId"]

# Watch-time categories by RealTimePlaying seconds (upper bounds, exclusive).
WATCH_CATEGORIES: list[tuple[float, str]] = [(60, "short"), (600, "medium"), (3600, "long")]
WATCH_CATEGORY_ELSE = "binge"

# Prime time: hour 18..23 inclusive. Weekend: day_of_week 1 (Sun) or 7 (Sat).
PRIMETIME_HOURS = (18, 23)
WEEKEND_DAYS = (1, 7)

# VOD completion buckets (upper bounds, exclusive) and the catch-all label.
COMPLETION_BUCKETS: list[tuple[float, str]] = [
    (0.25, "0-25% (dropped early)"),
    (0.50, "25-50%"),
    (0.75, "50-75%"),
]
COMPLETION_BUCKET_ELSE = "75-100% (completed)"

# Events that count as a VOD play in the top-content report.
VOD_PLAY_EVENTS = ("STOPVOD", "PLAYVOD")

# Cohort retention marks, in active days.
RETENTION_MARKS = (7, 14, 30)

# Our choice (not defined upstream): a user is churned after this many days
# without activity before the dataset's last date.
CHURN_THRESHOLD_DAYS = 30

# Load batch size of the warehouse sink.
LOAD_BATCH_ROWS = 50_000

# A NULL-Mac share above this percentage is a warning in the quality report.
NULL_MAC_WARN_PCT = 5.0
# -----------------------------------------------------------------------------

NUMERIC_TYPES: dict[str, T.DataType] = {
    "RealTimePlaying": T.FloatType(),
    "ElapsedTimePlaying": T.LongType(),
    "Duration": T.LongType(),
}

LOGS_CLEAN_SCHEMA = T.StructType(
    [T.StructField(c, NUMERIC_TYPES.get(c, T.StringType())) for c in KEEP_FIELDS]
    + [T.StructField("session_timestamp", T.TimestampNTZType())]
)

_FACT_TYPES: dict[str, T.DataType] = {
    **NUMERIC_TYPES,
    "session_timestamp": T.TimestampNTZType(),
    "session_date": T.DateType(),
    "hour_of_day": T.IntegerType(), "day_of_week": T.IntegerType(),
    "month": T.IntegerType(), "year": T.IntegerType(),
    "completion_rate": T.DoubleType(),
    "is_primetime": T.IntegerType(), "is_weekend": T.IntegerType(),
}

FACT_SCHEMA = T.StructType(
    [T.StructField(c, _FACT_TYPES.get(c, T.StringType())) for c in FACT_COLUMNS])
