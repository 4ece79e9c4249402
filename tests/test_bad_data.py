"""Values and lines that must not end a job."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from viewlog.functions.parse import parse_dict_literal
from viewlog.operators import profiles as A
from viewlog.operators import reports as R
from viewlog.operators.ingest import ingest_lines
from viewlog.plans.transform import build_fact

LINES = [
    "{'Mac': 'M1', 'SessionMainMenu': 'x:2024:01:02:20:00:00:000', 'Event': 'StopVOD', 'AppName': 'VOD', "
    f"'ItemId': 'i{i}', 'RealTimePlaying': {v}, 'Duration': 10}}"
    for i, v in enumerate(["5.0", "'inf'", "'1e30'", "1e30", "'nan'", "-1e30"])
]
BAD = [
    "{'Mac': 'M', 'x': " + "9" * 5000 + "}",
    "{'Mac': 'M', 'x': 0x" + "f" * 6000 + "}",
    "{'Mac': 'M\0', 'x': 1}",
    "{'Mac': 'M', 'x': '\\ud800'}",
    "{'Mac': 'M', 'x': " + "[" * 3000 + "]" * 3000 + "}",
]


@pytest.mark.parametrize("line", BAD)
def test_lines_without_a_value_are_dropped(line):
    assert parse_dict_literal(line) is None


def test_bad_lines_do_not_end_a_job(spark):
    lines = spark.createDataFrame([(x,) for x in LINES + BAD], "value string")
    assert ingest_lines(lines).count() == len(LINES)


def test_extreme_values_pass_every_report(spark):
    fact = build_fact(ingest_lines(spark.createDataFrame([(x,) for x in LINES], "value string"))).cache()
    assert fact.count() == len(LINES)
    direct = A.user_profiles(fact).collect()
    parts = A.profiles_from_summaries(A.user_day_summary(fact), A.user_day_apps(fact), A.user_day_items(fact)).collect()
    assert len(direct) == len(parts) == 1 and direct[0]["total_events"] == len(LINES)
    for report in (R.top_content, R.completion_by_entry):
        assert report(fact).collect()
    assert R.churn_analysis(A.profile_core(fact)).collect()


def test_average_is_exact_without_extremes(spark):
    from viewlog.functions.numeric import exact_avg

    rows = spark.createDataFrame([(0.1,), (0.2,), (None,), (0.6,)], "v double")
    assert rows.agg(exact_avg("v", 4)).first()[0] == 9000 / 10000.0 / 3
    extreme = rows.union(spark.createDataFrame([(1e300,)], "v double"))
    assert extreme.agg(exact_avg("v", 4)).first()[0] == pytest.approx(2.5e299)


def test_rank_with_rows_equal_on_the_first_keys(spark):
    """Rows that tie on time, Event and ItemId get the same numbers on every partitioning."""
    fact = build_fact(ingest_lines(spark.createDataFrame([(LINES[0],)], "value string")))
    tied = fact.crossJoin(spark.range(120)).withColumn("Screen", F.col("id").cast("string")).drop("id")
    found = []
    for n in (1, 7, 40):
        ranked = A.session_rank(tied.repartition(n)).orderBy("session_rank").select("session_rank", "Screen").collect()
        assert [r["session_rank"] for r in ranked] == list(range(1, 121))
        found.append([r["Screen"] for r in ranked])
    assert found[0] == found[1] == found[2]


def test_profiles_without_self_join_repair(spark):
    """The user join names its keys apart, so it does not rely on Spark repairing a condition on equal names."""
    rows = [(f"m{i % 5}", None, "C", f"a{i % 3}") for i in range(30)]
    day = spark.createDataFrame(rows, "Mac string, CustomerID string, Contract string, AppName string")
    key = "spark.sql.selfJoinAutoResolveAmbiguity"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        left = day.groupBy("Mac", "CustomerID", "Contract").count()
        right = A.most_used_app(day)
        assert A._with_user_side(left, right).count() == 5
    finally:
        spark.conf.set(key, old)
