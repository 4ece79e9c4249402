"""Rejected lines: kept with their reason, by the parse that accepts the others."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from viewlog.functions import parse
from viewlog.operators import ingest
from viewlog.sources import sinks
from viewlog.sources.tables import load_raw_lines, read_logs_clean

CASES = [(None, "empty"), ("  ", "empty"), ("{'Mac': 'a'", "not a literal"), ("open('x')", "not a literal"), ("{'Mac': 'a\0'}", "not a literal"),
         ("[1]", "not a dict"), ("'text'", "not a dict"), ("{'Mac': 0x" + "f" * 6000 + "}", "value without text"),
         (r"{'Mac': '\ud800'}", "value without text"), ("{'mac': 'a'}", "no required key"), ("{}", "no required key"),
         ("{'Mac': None}", None), ("{'MAC': 'a', 'x': [1, {2: 3}]}", None)]


@pytest.mark.parametrize("line, reason", CASES)
def test_reasons(line, reason):
    record, why = parse.judge(line)
    assert (record is None) == (why is not None)
    assert (why or (None if any(k in record for k in ("Mac", "MAC")) else parse.NO_KEY)) == reason
    assert parse.parse_dict_literal(line) == record


def test_accepted_rows_are_those_of_ingest(spark, tmp_dir):
    lines = load_raw_lines(spark, SF_SMALL).cache()
    n = sinks.write_judged(ingest.ingest_judged(lines), f"{tmp_dir}/logs", f"{tmp_dir}/rejected")
    got, want = read_logs_clean(spark, f"{tmp_dir}/logs"), ingest.ingest_lines(lines)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    rejected = sinks.read_rejected(spark, f"{tmp_dir}/rejected")
    assert n == {"accepted": got.count(), "rejected": rejected.count()} and sum(n.values()) == lines.count()
    assert rejected.where("line is null or reject_reason is null").count() == 0
    # The lines kept are the input's own: parsing them again rejects them again, for the same reasons.
    again = ingest.ingest_judged(rejected.withColumnRenamed("line", "value"))
    assert again.where("verdict = 'accepted'").count() == 0
    assert ingest.reject_counts(again).collect() == ingest.reject_counts(rejected).collect()
    counts = ingest.ingest_counts(lines).first()
    assert (counts["kept"], counts["rejected"]) == (n["accepted"], n["rejected"])


def test_nothing_rejected_and_nothing_at_all(spark, tmp_dir):
    good = spark.createDataFrame([("{'Mac': 'a', 'AppName': 'VOD'}",)], "value string")
    assert sinks.write_judged(ingest.ingest_judged(good), f"{tmp_dir}/l", f"{tmp_dir}/r") == {"accepted": 1, "rejected": 0}
    assert sinks.read_rejected(spark, f"{tmp_dir}/r").count() == 0
    assert sinks.write_judged(ingest.ingest_judged(good.limit(0)), f"{tmp_dir}/l", f"{tmp_dir}/r") == {"accepted": 0, "rejected": 0}
    assert read_logs_clean(spark, f"{tmp_dir}/l").count() == 0


def test_one_parse_in_the_plan(spark):
    plan = ingest.ingest_judged(spark.createDataFrame([("x",)], "value string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
