"""The activity cube: one scan, the rows of the single reports."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from viewlog.operators import cube, reports
from viewlog.plans.transform import fact_ev, fact_or


@pytest.fixture(scope="module", params=["events", "orders"])
def fact(spark, request):
    df = (fact_ev if request.param == "events" else fact_or)(spark, SF_MID)
    # An app without a name and users without events of some apps.
    return df.withColumn("AppName", F.when(F.col("hour_of_day") % 5 == 0, F.lit(None)).otherwise(F.col("AppName"))).cache()


@pytest.fixture(scope="module")
def written_cube(spark, fact):
    return cube.activity_cube(fact).cache()


@pytest.mark.parametrize("name", sorted(cube.REPORTS))
def test_reports_equal_those_over_the_fact(fact, written_cube, name):
    got, want = cube.REPORTS[name](written_cube), getattr(reports, name)(fact)
    assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    assert got.collect() == want.collect()


def test_one_scan_feeds_all_groupings(spark, fact, tmp_dir):
    fact.write.parquet(f"{tmp_dir}/fact")
    plan = cube.activity_cube(spark.read.parquet(f"{tmp_dir}/fact"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1 and "Join" not in plan and "SortAggregate" not in plan
    scan = next(line for line in plan.split("\n") if "FileScan" in line)
    assert "ItemName" not in scan and "CustomerID" not in scan


def test_empty_fact(spark, fact):
    c = cube.activity_cube(fact.limit(0))
    assert c.count() == 0
    assert all(r(c).count() == 0 for r in cube.REPORTS.values())
