"""Ingest contracts: required keys, alias folding, legacy casts, timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from viewlog.functions.casts import legacy_long, session_timestamp
from viewlog.operators.ingest import discover_columns, ingest_counts, ingest_lines
from viewlog.schema import KEEP_FIELDS

FIXTURE_LINES = [
    "{'Mac': 'B046FCAC0DC1', 'CustomerID': '12', 'SessionMainMenu': 'B046FCAC0DC1:2016:02:11:17:35:57:000', "
    "'AppName': 'VOD', 'Event': 'StopVOD', 'ItemId': '7', 'RealTimePlaying': 570.3, 'Duration': '3600'}",
    "{'MAC': 'B046FCAC0DC2', 'appname': ' iptv ', 'event': 'startchannel ', 'realtimeplaying': None}",
    "{'mac': 'B046FCAC0DC3', 'Event': 'STOPVOD'}",
    "{'Mac': None, 'Event': 'STOPVOD'}",
    "[1, 2]",
    "not a literal",
    "",
]


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_fixture_lines(spark):
    out = ingest_lines(lines_df(spark, FIXTURE_LINES))
    assert out.columns == KEEP_FIELDS + ["session_timestamp"]
    rows = {r["Mac"]: r for r in out.collect()}
    assert set(rows) == {"B046FCAC0DC1", "B046FCAC0DC2", None}
    r1 = rows["B046FCAC0DC1"]
    assert r1["session_timestamp"] == dt.datetime(2016, 2, 11, 17, 35, 57)
    assert abs(r1["RealTimePlaying"] - 570.3) < 1e-3 and r1["Duration"] == 3600
    r2 = rows["B046FCAC0DC2"]
    assert r2["AppName"] == " iptv " and r2["Event"] == "startchannel "
    assert r2["session_timestamp"] is None and r2["RealTimePlaying"] is None
    assert rows[None]["Event"] == "STOPVOD"


def test_counts_and_discovery(spark):
    c = ingest_counts(lines_df(spark, FIXTURE_LINES)).first()
    assert (c["lines"], c["parsed"], c["kept"], c["rejected"]) == (7, 4, 3, 4)
    keys = {r["column"]: r["records"] for r in discover_columns(lines_df(spark, FIXTURE_LINES)).collect()}
    assert keys["Mac"] == 2 and keys["MAC"] == 1 and "mac" not in keys


def test_alias_clash_prefers_canonical(spark):
    out = ingest_lines(lines_df(spark, [
        "{'Mac': 'A', 'MAC': 'B', 'mac': 'C'}",
        "{'MAC': 'B', 'mac': 'C'}",
        "{'MAC': None, 'mac': 'C'}",
    ])).select("Mac").collect()
    assert [r["Mac"] for r in out] == ["A", "C", "C"]


def test_legacy_long_cast(spark):
    cases = {"12.7": 12, "-3.": -3, ".5": 0, "-.5": 0, ".": 0, "1e3": None, "abc": None,
             " 42 ": 42, "\t7\n": 7, "+8": 8, "-": None, "": None, "99999999999999999999": None,
             "9223372036854775807": 9223372036854775807, "0012": 12, "1,000": None,
             "+.": 0, "1.5e3": None, "99999999999999999999.5": None, "  -0012.9 ": -12,
             "\x00 5": 5, "1.2.3": None, "--1": None, "9223372036854775808": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r["v"]: r["n"] for r in df.select("v", legacy_long(F.col("v")).alias("n")).collect()}
    assert got == cases


def test_session_timestamp(spark):
    cases = {
        "X:2016:02:11:17:35:57:000": dt.datetime(2016, 2, 11, 17, 35, 57),
        "X:2016:13:11:17:35:57:000": None,
        "X:2016:02:30:17:35:57": None,
        "X:2016:02:11:24:00:00": None,
        "no time here": None,
        "2016:02:11:17:35:57": None,  # needs the leading colon
        "a:2016:02:11:17:35:57:b:2017:01:01:00:00:00": dt.datetime(2016, 2, 11, 17, 35, 57),
    }
    df = spark.createDataFrame([(k,) for k in cases], "m string")
    got = {r["m"]: r["t"] for r in df.select("m", session_timestamp(F.col("m")).alias("t")).collect()}
    assert got == cases
    assert dict(df.select(session_timestamp(F.col("m")).alias("t")).dtypes)["t"] == "timestamp_ntz"
