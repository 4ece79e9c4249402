"""Views for ad-hoc SQL over the fact and profile tables."""

from __future__ import annotations

from conftest import SF_MID
from viewlog.operators.profiles import user_profiles
from viewlog.plans.sql import register_views
from viewlog.plans.transform import fact_ev, fact_or


def test_views_for_ad_hoc_sql(spark):
    fact, profiles = fact_ev(spark, SF_MID), user_profiles(fact_or(spark, SF_MID))
    register_views(fact, profiles, prefix="t_")
    n = spark.sql("SELECT COUNT(*) FROM t_fact_sessions").first()[0]
    assert n == fact.count()
    assert spark.sql("SELECT SUM(total_events) FROM t_user_profiles").first()[0] > 0
