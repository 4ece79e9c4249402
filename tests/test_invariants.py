"""Invariants over the fact table, profiles and reports at sf0.01."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID
from viewlog.operators import profiles as A
from viewlog.operators import reports as R
from viewlog.plans.transform import fact_ev, fact_or
from viewlog.session import SHUFFLE_CLEANUP, written


@pytest.fixture(scope="module")
def fact(spark):
    return fact_ev(spark, SF_MID).cache()


@pytest.fixture(scope="module")
def fact_multi(spark):
    return fact_or(spark, SF_MID).cache()


def test_fact_is_unique_on_dedup_keys(fact):
    keys = ["Mac", "session_timestamp", "Event", "ItemId"]
    assert fact.count() == fact.select(*keys).distinct().count() == 9900


def test_profile_totals_and_ratios(fact_multi):
    prof = A.user_profiles(fact_multi)
    s = prof.agg(F.sum("total_events").alias("n"), F.count(F.lit(1)).alias("u"),
                 F.min("primetime_ratio"), F.max("primetime_ratio"),
                 F.min("weekend_ratio"), F.max("weekend_ratio"),
                 F.min("days_inactive"), F.sum("churn_label")).first()
    assert s["n"] == fact_multi.count()
    assert s["u"] == 1500
    assert 0 <= s[2] <= s[3] <= 1 and 0 <= s[4] <= s[5] <= 1
    assert s[6] == 0
    assert s[7] == 1324  # 30-day threshold on the orders-based sessions


def test_session_rank_equals_plain_window(fact_multi):
    w = Window.partitionBy("Mac").orderBy("session_timestamp", F.asc_nulls_first("Event"),
                                          F.asc_nulls_first("ItemId"))
    plain = fact_multi.select("Mac", "session_timestamp", "Event", "ItemId",
                              F.row_number().over(w).alias("r"))
    ours = A.session_rank(fact_multi).select("Mac", "session_timestamp", "Event", "ItemId",
                                             F.col("session_rank").alias("r"))
    assert plain.exceptAll(ours).count() == 0 and ours.exceptAll(plain).count() == 0


def test_buckets_sum_to_vod_rows(fact):
    vod = fact.where(F.col("AppName") == "VOD").count()
    assert R.completion_buckets(fact).agg(F.sum("sessions")).first()[0] == vod
    unknown = R.completion_buckets(fact, null_bucket=True)
    assert unknown.agg(F.sum("sessions")).first()[0] == vod


def test_every_user_in_one_cohort(fact_multi):
    prof = A.user_profiles(fact_multi)
    assert R.cohort_retention(prof).agg(F.sum("cohort_size")).first()[0] == prof.count()


def test_latest_event_is_max_time(fact):
    latest = R.latest_event_per_user(fact)
    check = fact.groupBy("Mac").agg(F.max("session_timestamp").alias("t"))
    assert latest.join(check, "Mac").where(F.col("t") != F.col("last_timestamp")).count() == 0


def test_top_content_is_top_k(fact):
    top = R.top_content(fact, k=3).collect()
    assert len(top) == 3
    assert [r["total_watch_seconds"] for r in top] == sorted(
        [r["total_watch_seconds"] for r in top], reverse=True)


def test_repeatable_across_partitionings(spark, fact_multi):
    a = A.user_profiles(fact_multi)
    b = A.user_profiles(fact_multi.repartition(13))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_mode_ties_resolve_to_smallest(spark):
    df = spark.createDataFrame(
        [("m", "c", "k", "B"), ("m", "c", "k", "A"), ("m", "c", "k", None), ("n", "c", "k", None)],
        "Mac string, CustomerID string, Contract string, AppName string")
    got = {r["Mac"]: r["most_used_app"] for r in A.most_used_app(df).collect()}
    assert got == {"m": "A", "n": None}


@pytest.mark.parametrize("which", ["events", "orders"])
def test_profiles_from_summaries_equal_direct(spark, fact, fact_multi, which):
    f = fact if which == "events" else fact_multi
    direct = A.user_profiles(f)
    parts = A.profiles_from_summaries(A.user_day_summary(f), A.user_day_apps(f), A.user_day_items(f))
    assert parts.schema == direct.schema
    assert parts.exceptAll(direct).count() == 0 and direct.exceptAll(parts).count() == 0


def test_written_tables_leave_the_cleanup_setting_alone(spark):
    """A work table holds all rows, and queries outside of its write keep their shuffle files."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    counts = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()
    table = written(counts, "counts")
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
    assert table.count() == 7 and counts.agg(F.sum("count")).first()[0] == 1000
    with pytest.raises(Exception):
        written(spark.range(3).select(F.raise_error(F.lit("stop")).alias("x")), "broken")
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
