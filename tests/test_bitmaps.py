"""Bitmaps: distinct counts that merge, item codes, and profiles from month summaries."""

from __future__ import annotations

import os
import random

from pyspark.sql import functions as F

from conftest import SF_MID
from viewlog.operators import bitmaps
from viewlog.operators import profiles as A
from viewlog.plans.transform import fact_or


def test_sizes_equal_sets(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), rng.randint(0, 9), rng.choice([None, rng.randint(0, 500), 63, 64, 10**12])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, part int, n long").repartition(7)
    want = {k: len({n for x, _, n in rows if x == k and n is not None}) for k in "abc"}
    fine = bitmaps.words(df, ["k", "part"], "n")  # one set per part, then merged
    assert {r.k: r.size for r in bitmaps.counts(fine, ["k"], "size").collect()} == want
    twice = fine.union(fine)
    assert {r.k: r.size for r in bitmaps.counts(twice, ["k"], "size").collect()} == want


def test_bits_of_small_numbers(spark):
    df = spark.createDataFrame([("a", 0), ("a", 63), ("a", 63), ("b", None), ("b", 5)], "k string, n int")
    got = {r.k: r.n for r in df.groupBy("k").agg(bitmaps.bits(F.col("n")).alias("w")).groupBy("k").agg(bitmaps.size(F.col("w")).alias("n")).collect()}
    assert got == {"a": 2, "b": 1}


def test_codes_are_dense_and_stay(spark):
    none = spark.createDataFrame([], "value string, code bigint")
    first = spark.createDataFrame([(f"i{n:04}",) for n in range(500)] * 2 + [(None,)], "item string").repartition(9)
    known = {r.value: r.code for r in bitmaps.new_codes(first, none, "item").collect()}
    assert sorted(known.values()) == list(range(500)) and known["i0000"] == 0 and known["i0499"] == 499
    table = spark.createDataFrame(list(known.items()), "value string, code bigint")
    more = spark.createDataFrame([("i0003",), ("a",), ("z",), ("a",)], "item string")
    assert {r.value: r.code for r in bitmaps.new_codes(more, table, "item").collect()} == {"a": 500, "z": 501}
    assert bitmaps.new_codes(more.limit(0), table, "item").collect() == []


def test_profiles_without_expand(spark):
    plan = A.user_profiles(fact_or(spark, SF_MID))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    core = A.profile_core(fact_or(spark, SF_MID))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in core and "Join" not in core


def test_months_equal_direct_profiles(spark):
    fact = fact_or(spark, SF_MID).cache()
    items = A.user_day_items(fact)
    codes = bitmaps.new_codes(items, spark.createDataFrame([], "value string, code bigint"), "ItemId")
    got = A.profiles_from_months(A.user_month_summary(A.user_day_summary(fact)), A.user_month_apps(A.user_day_apps(fact)),
                                 A.user_month_items(items, codes))
    want = A.user_profiles(fact)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    fact.unpersist()


def _line(mac, day, app, item, hour=10):
    return str({"Mac": mac, "SessionMainMenu": f"{mac}:{day.replace('-', ':')}:{hour:02}:00:00:000", "AppName": app, "Event": "E",
                "ItemId": item, "RealTimePlaying": 10, "Duration": 100})


def test_only_touched_months_are_rebuilt(spark, tmp_dir):
    """A late file changes its month alone; profiles equal those of all lines at once."""
    from viewlog.plans.pipeline import run_incremental
    from viewlog.sources.tables import read_fact

    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    os.makedirs(raw)

    def deliver(name, lines):
        with open(f"{raw}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")

    def folder(month, table):
        path = f"{out}/incremental/profile_parts/{table}/month={month}-01"
        return {f: os.path.getmtime(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet")}

    def check():
        fact = read_fact(spark, f"{out}/incremental/fact_sessions.parquet")
        got, want = spark.read.parquet(f"{out}/incremental/user_profiles.parquet"), A.user_profiles(fact)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        return {r.Mac: (r.active_days, r.session_count, r.unique_content_watched, r.unique_apps_used) for r in got.collect()}

    deliver("logt1.txt", [_line("m1", "2024-01-05", "VOD", "a"), _line("m1", "2024-02-05", "VOD", "b"), _line("m2", "2024-02-06", "IPTV", "a")])
    run_incremental(spark, raw, out, table_prefix="bm_", reports_too=False)
    assert check() == {"m1": (2, 2, 2, 1), "m2": (1, 1, 1, 1)}
    before = {m: folder(m, "user_month_items") for m in ("2024-01", "2024-02")}
    # Late lines of January: a known and a new item, an old and a new hour of a known day.
    deliver("logt2.txt", [_line("m1", "2024-01-05", "IPTV", "b", 11), _line("m1", "2024-01-07", "VOD", "c"), _line("m1", "2024-01-05", "VOD", "a")])
    run_incremental(spark, raw, out, table_prefix="bm_", reports_too=False)
    assert check() == {"m1": (3, 4, 3, 2), "m2": (1, 1, 1, 1)}
    after = {m: folder(m, "user_month_items") for m in ("2024-01", "2024-02")}
    assert before["2024-02"] == after["2024-02"] and before["2024-01"] != after["2024-01"]
    codes = spark.read.parquet(f"{out}/incremental/profile_parts/item_codes").collect()
    assert sorted(c.value for c in codes) == ["a", "b", "c"] and sorted(c.code for c in codes) == [0, 1, 2]


def test_last_events_follow_late_files_without_the_fact(spark, tmp_dir):
    from viewlog.operators import reports as R
    from viewlog.plans.pipeline import run_incremental
    from viewlog.sources.tables import read_fact
    from viewlog.streaming.incremental import read_latest

    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    os.makedirs(raw)

    def deliver(name, lines):
        with open(f"{raw}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
        run_incremental(spark, raw, out, table_prefix="le_")
        fact = read_fact(spark, f"{out}/incremental/fact_sessions.parquet")
        latest = read_latest(spark, f"{out}/incremental/profile_parts")
        want = R.latest_event_per_user(fact)
        assert latest.exceptAll(want).count() == 0 and want.exceptAll(latest).count() == 0
        for name, report in (("last_action", R.last_action), ("crashed_share", R.crashed_share)):
            assert spark.read.parquet(f"{out}/incremental/reports/{name}.parquet").collect() == report(fact).collect()
        scans = [f for f in latest.inputFiles()]
        assert scans and all("/profile_parts/user_month_last/" in f for f in scans)
        return {r.Mac: (str(r.last_timestamp), r.last_item_id) for r in latest.collect()}

    got = deliver("logt1.txt", [_line("m1", "2024-03-05", "VOD", "a"), _line("m1", "2024-01-05", "VOD", "b"), _line("m2", "2024-01-06", "VOD", "a")])
    assert got == {"m1": ("2024-03-05 10:00:00", "a"), "m2": ("2024-01-06 10:00:00", "a")}
    # Late: an older event changes nothing; the same second with a greater item wins; a new user.
    got = deliver("logt2.txt", [_line("m1", "2024-01-09", "VOD", "z"), _line("m2", "2024-01-06", "VOD", "c"), _line("m3", "2023-12-31", "VOD", "q")])
    assert got == {"m1": ("2024-03-05 10:00:00", "a"), "m2": ("2024-01-06 10:00:00", "c"), "m3": ("2023-12-31 10:00:00", "q")}
