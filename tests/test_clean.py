"""Cleaning contracts: dedup survivor, NULL keys, fills, normalisation order."""

from __future__ import annotations

import datetime as dt

import pytest

from viewlog.operators.clean import clean, clean_audit, dedup, fill_nulls
from viewlog.schema import LOGS_CLEAN_SCHEMA

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def logs(spark, rows):
    full = []
    for r in rows:
        base = {f.name: None for f in LOGS_CLEAN_SCHEMA.fields}
        base.update(r)
        full.append(tuple(base[f.name] for f in LOGS_CLEAN_SCHEMA.fields))
    return spark.createDataFrame(full, LOGS_CLEAN_SCHEMA)


def test_dedup_survivor_is_least_row_nulls_last(spark):
    df = logs(spark, [
        dict(Mac="m", session_timestamp=T0, Event="E", ItemId="1", CustomerID="b", RealTimePlaying=5.0),
        dict(Mac="m", session_timestamp=T0, Event="E", ItemId="1", CustomerID="a", RealTimePlaying=None),
        dict(Mac="m", session_timestamp=T0, Event="E", ItemId="1", CustomerID="a", RealTimePlaying=9.0),
        dict(Mac="m", session_timestamp=T0, Event="E", ItemId="1", CustomerID=None, RealTimePlaying=1.0),
    ])
    out = dedup(df).collect()
    assert len(out) == 1
    assert out[0]["CustomerID"] == "a" and out[0]["RealTimePlaying"] == 9.0


def test_dedup_null_keys_group_together_and_repeatable(spark):
    rows = [dict(Mac="m", session_timestamp=T0, Event=None, ItemId=None, Screen=s) for s in "cab"]
    rows += [dict(Mac="m", session_timestamp=T0, Event="E", ItemId=None, Screen="z")]
    df = logs(spark, rows)
    a = sorted(map(tuple, dedup(df).collect()), key=str)
    b = sorted(map(tuple, dedup(df.repartition(5)).collect()), key=str)
    assert a == b and len(a) == 2
    assert {r[LOGS_CLEAN_SCHEMA.fieldNames().index("Screen")] for r in a} == {"a", "z"}


def test_fill_replaces_nan_and_null(spark):
    df = logs(spark, [dict(Mac="m", RealTimePlaying=float("nan")), dict(Mac="n", RealTimePlaying=None)])
    out = fill_nulls(df).collect()
    assert [r["RealTimePlaying"] for r in out] == [0.0, 0.0]
    assert [r["ElapsedTimePlaying"] for r in out] == [0, 0]
    assert [r["Duration"] for r in out] == [None, None]


def test_normalise_after_dedup(spark):
    df = logs(spark, [
        dict(Mac="m", session_timestamp=T0, Event="stopvod ", AppName=" vod"),
        dict(Mac="m", session_timestamp=T0, Event="STOPVOD", AppName="VOD"),
        dict(Mac=None, session_timestamp=T0, Event="X"),
        dict(Mac="m", session_timestamp=None, Event="X"),
    ])
    out = clean(df).collect()
    assert len(out) == 2
    assert {r["Event"] for r in out} == {"STOPVOD"} and {r["AppName"] for r in out} == {"VOD"}
    audit = clean_audit(df).first()
    assert (audit["rows_before"], audit["rows_after"], audit["rows_removed"]) == (4, 2, 2)


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_hashed_dedup_equals_sorted(spark, monkeypatch, broadcast):
    """Single rows, copies, near copies, NULL keys and values; few and many repeated keys."""
    import random

    from viewlog.operators import clean as C

    monkeypatch.setattr(C, "BROADCAST_KEYS", broadcast)
    rng = random.Random(9)
    rows = [(rng.choice(["m1", "m2"]), rng.randint(0, 90), rng.choice(["e", None]), rng.choice(["1", "2", None]),
             rng.choice([None, 1.0, 2.0, float("nan")]) if i % 3 else 1.0, rng.choice(["x", None]) if i % 2 else "x") for i in range(900)]
    df = spark.createDataFrame(rows, "Mac string, session_timestamp int, Event string, ItemId string, RealTimePlaying float, Screen string").repartition(6)
    assert 0 < C.repeated_keys(df).count() < df.select(*C.DEDUP_KEYS).distinct().count()
    _same(C.dedup_hashed(df), C.dedup(df))
    _same(C.dedup_hashed(df.union(df)), C.dedup(df))
    _same(C.dedup_hashed(df.limit(0)), C.dedup(df.limit(0)))


def test_colliding_key_hashes_are_harmless(spark, monkeypatch):
    from pyspark.sql import functions as F

    from viewlog.operators import clean as C

    monkeypatch.setattr(C, "_key_hash", lambda keys: F.pmod(F.hash(*keys), F.lit(50)).cast("bigint"))
    df = spark.range(120).select((F.col("id") % 90).cast("string").alias("Mac"), F.lit(1).alias("session_timestamp"), F.lit("e").alias("Event"),
                                 F.lit("1").alias("ItemId"), F.col("id").alias("n"))
    _same(C.dedup_hashed(df), C.dedup(df))


def test_hashed_dedup_shuffles_only_repeated_keys(spark):
    from viewlog.operators import clean as C

    def plan(df):
        return C.dedup_hashed(df)._jdf.queryExecution().executedPlan().toString()

    rows = [(f"m{i}", i % 7, "e", "1", float(i), "x") for i in range(200)]
    schema = "Mac string, session_timestamp int, Event string, ItemId string, RealTimePlaying float, Screen string"
    df = spark.createDataFrame(rows, schema)
    assert "Exchange" not in plan(df) and "Aggregate" not in plan(df)
    near = df.union(spark.createDataFrame([("m5", 5, "e", "1", -1.0, "x")], schema))
    text = plan(near)
    assert "SortMergeJoin" not in text and "LeftAnti" in text and "LeftSemi" in text
    # Of the two branches only the repeated keys' has an exchange that is no broadcast.
    plain = text[text.index("LeftAnti"):text.index("LeftSemi")]
    assert "hashpartitioning" not in plain.split("SortAggregate")[0]
    kept = {r.Mac: r.RealTimePlaying for r in C.dedup_hashed(near).collect()}
    assert len(kept) == 200 and kept["m5"] == -1.0
