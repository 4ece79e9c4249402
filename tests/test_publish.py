"""Outputs are exchanged whole: whatever dies, readers find the old rows or the new ones."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from viewlog.sources import sinks


def rows(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_killed_write_keeps_the_old_rows(spark, tmp_dir):
    path = f"{tmp_dir}/out.parquet"
    assert sinks.write_parquet(spark.range(5), path) == 5
    dying = spark.range(1000).repartition(4).withColumn("id", F.when(F.col("id") == 700, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_parquet(dying, path)
    assert rows(spark, path) == list(range(5))
    assert sinks.write_parquet(spark.range(7), path) == 7 and rows(spark, path) == list(range(7))


def test_partitioned_output_is_replaced_whole(spark, tmp_dir):
    path = f"{tmp_dir}/logs.parquet"
    df = spark.createDataFrame([(1, "VOD"), (2, "IPTV"), (3, None)], "id int, AppName string")
    sinks.write_partitioned(df, path)
    sinks.write_partitioned(df.where("id = 1"), path)
    assert rows(spark, path) == [1] and [d for d in os.listdir(path) if "=" in d] == ["AppName=VOD"]
    sinks.write_partitioned(df.where("id > 9"), path)  # no rows: no folders, not the old ones
    assert spark.read.schema(df.schema).parquet(path).count() == 0


def test_plan_may_read_what_it_replaces(spark, tmp_dir):
    path = f"{tmp_dir}/out.parquet"
    sinks.write_parquet(spark.range(5), path)
    sinks.write_parquet(spark.read.parquet(path).union(spark.read.parquet(path).withColumn("id", F.col("id") + 5)), path)
    assert rows(spark, path) == list(range(10))


def test_unverified_rows_are_not_published(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/out.parquet"
    sinks.write_parquet(spark.range(5), path)
    monkeypatch.setattr(sinks.F, "count", lambda c: F.sum(F.lit(2)))  # the write seems to have had more rows
    with pytest.raises(sinks.PublishError, match="were written"):
        sinks.write_parquet(spark.range(9), path)
    monkeypatch.undo()
    assert rows(spark, path) == list(range(5))


def test_run_that_dies_between_the_renames_is_made_good(spark, tmp_dir):
    path = f"{tmp_dir}/out.parquet"
    sinks.write_parquet(spark.range(5), path)
    os.makedirs(f"{tmp_dir}/_replaced", exist_ok=True)
    os.rename(path, f"{tmp_dir}/_replaced/out.parquet")  # as left by the first rename
    assert sinks.recover(spark, path) and rows(spark, path) == list(range(5))
    os.rename(path, f"{tmp_dir}/_replaced/out.parquet")
    with pytest.raises(Exception, match="lost"):
        sinks.write_parquet(spark.range(3).withColumn("id", F.raise_error(F.lit("lost")).cast("bigint")), path)
    assert rows(spark, path) == list(range(5))
    assert not sinks.recover(spark, path)


def test_failed_exchange_puts_the_old_output_back(spark, tmp_dir):
    path = f"{tmp_dir}/out.parquet"
    sinks.write_parquet(spark.range(5), path)
    with pytest.raises(Exception):
        sinks._exchange(spark, f"{tmp_dir}/_staged/missing", path)
    sinks.recover(spark, path)
    assert rows(spark, path) == list(range(5))


def test_table_stays_while_its_output_changes(spark, tmp_dir):
    df = spark.createDataFrame([(1, "VOD"), (2, "IPTV")], "id int, AppName string")
    path, name = f"{tmp_dir}/fact.parquet", "t_publish_fact"
    sinks.write_partitioned(df, path)
    dropped = []
    sinks.external_table(spark, name, df, path, "AppName")
    assert sinks._same_table(spark, name, df, path, "AppName")
    sinks.write_partitioned(spark.createDataFrame([(3, "VOD"), (4, "NEW")], df.schema), path)
    sql = spark.sql
    try:
        type(spark).sql = lambda self, q, *a, **k: (dropped.append(q) if q.startswith("DROP") else None) or sql(q, *a, **k)
        sinks.external_table(spark, name, df, path, "AppName")
    finally:
        type(spark).sql = sql.__func__
    assert not dropped and sorted(map(tuple, spark.table(name).collect())) == [(3, "VOD"), (4, "NEW")]
    # Other columns, or another place: made anew.
    assert not sinks._same_table(spark, name, df.withColumn("x", F.lit(1)), path, "AppName")
    assert not sinks._same_table(spark, name, df, f"{tmp_dir}/other", "AppName")
    assert not sinks._same_table(spark, name, df, path, None)


def test_unpartitioned_table_moves_with_its_location(spark, tmp_dir):
    name = "t_publish_profiles"
    for i, n in enumerate((3, 6)):
        sinks.write_parquet(spark.range(n), f"{tmp_dir}/v{i}")
        sinks.external_table(spark, name, spark.read.parquet(f"{tmp_dir}/v{i}"), f"{tmp_dir}/v{i}")
        assert spark.table(name).count() == n
