"""Every registered query against its DuckDB oracle at sf0.001 (the driver runs sf0.01)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from viewlog.plans.catalog import ORACLE, QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.sql(ORACLE[name])
    d_cols, d_rows = _rows(res.columns, res.fetchall())
    assert s_cols == d_cols
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["session_date", "dau", "total_events", "avg_watch_sec"]
    assert df.count() > 0


SURVEY_KEYS = {
    # §2.1 sources and sinks
    "text_scan", "source_check", "roundtrip_partitioned", "roundtrip_fact", "load_table", "load_verify",
    # §2.2 parsing
    "parse_lines", "ingest_counts", "discover_columns",
    # §2.3 projection, renaming, casting
    "normalize_columns", "parse_session_timestamp", "select_and_cast", "fact_sessions",
    # §2.4 cleaning
    "dedup_sessions", "filter_not_null", "fill_nulls", "normalize_text", "clean_audit",
    # §2.5 features
    "session_features", "date_parts", "completion_rate", "watch_category", "time_flags",
    # §2.6 profiles
    "user_profiles", "dataset_end_date", "most_used_app", "user_recency", "user_daily_watch",
    "churn_label", "null_counts",
    # §2.7 windows
    "session_rank", "latest_event_per_user",
    # §2.8 reports
    "daily_active_users", "top_content", "activity_heatmap", "app_usage", "churn_analysis",
    "cohort_retention", "completion_buckets", "last_action", "monthly_active_users",
    "events_by_app", "active_hours", "watch_time_by_bucket", "crashed_share",
    "completion_by_entry", "mau_change",
    # §2.9 quality and run summary
    "quality_report", "run_summary",
}


def test_survey_keys_are_registered():
    assert SURVEY_KEYS <= set(E.queries())
