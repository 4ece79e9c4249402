"""Feature boundaries: categories, prime time, weekend, completion rate."""

from __future__ import annotations

import datetime as dt

from viewlog.operators.features import completion_bucket_col, session_features


def feats(spark, rows):
    df = spark.createDataFrame(rows, "session_timestamp timestamp_ntz, RealTimePlaying float, Duration bigint")
    return session_features(df).collect()


def test_categories_and_completion(spark):
    t = dt.datetime(2024, 1, 3, 12, 0, 0)  # a Wednesday
    rows = feats(spark, [(t, 59.5, 100), (t, 60.0, 0), (t, 599.0, None), (t, 600.0, -5),
                         (t, 3599.0, 3), (t, 3600.0, 7200), (t, 0.0, 1)])
    assert [r["watch_category"] for r in rows] == ["short", "medium", "medium", "long", "long", "binge", "short"]
    assert [r["completion_rate"] for r in rows] == [0.595, None, None, None, 1199.6667, 0.5, 0.0]


def test_time_flags(spark):
    base = dt.datetime(2024, 1, 6)  # Saturday
    rows = feats(spark, [(base.replace(hour=h), 1.0, 1) for h in (0, 17, 18, 23)]
                 + [(dt.datetime(2024, 1, 7, 9), 1.0, 1), (dt.datetime(2024, 1, 8, 20), 1.0, 1)])
    assert [r["is_primetime"] for r in rows] == [0, 0, 1, 1, 0, 1]
    assert [r["day_of_week"] for r in rows] == [7, 7, 7, 7, 1, 2]
    assert [r["is_weekend"] for r in rows] == [1, 1, 1, 1, 1, 0]
    assert {(r["year"], r["month"]) for r in rows} == {(2024, 1)}
    assert rows[0]["session_date"] == dt.date(2024, 1, 6)


def test_completion_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (None, 0.0, 0.2499, 0.25, 0.5, 0.75, 1.7)], "completion_rate double")
    plain = [r[0] for r in df.select(completion_bucket_col().alias("b")).collect()]
    assert plain == ["75-100% (completed)", "0-25% (dropped early)", "0-25% (dropped early)",
                     "25-50%", "50-75%", "75-100% (completed)", "75-100% (completed)"]
    flagged = [r[0] for r in df.select(completion_bucket_col(null_bucket=True).alias("b")).collect()]
    assert flagged[0] == "unknown" and flagged[1:] == plain[1:]
