"""Hot keys: one user holds most rows, one dedup group holds many copies."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from viewlog.operators import profiles as A
from viewlog.operators import reports as R
from viewlog.operators.clean import clean, dedup
from viewlog.operators.features import fact_sessions, session_features
from viewlog.schema import LOGS_CLEAN_SCHEMA


@pytest.fixture(scope="module")
def skewed(spark):
    # 60,000 rows: user 'hot' has 2/3 of them; one key tuple has 10,000 near copies.
    ids = spark.range(60_000)
    hot = F.col("id") % 3 != 0
    copies = F.col("id") < 10_000
    ts = F.when(copies, F.lit(0)).otherwise(F.col("id") * 37 % 2_000_000)
    base = ids.select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 50).cast("string"))).alias("Mac"),
        F.lit("1").alias("CustomerID"), F.lit("C1").alias("Contract"),
        F.lit(None).cast("string").alias("Session"), F.lit(None).cast("string").alias("SessionMainMenu"),
        F.when(F.col("id") % 4 == 0, "VOD").otherwise("IPTV").alias("AppName"),
        F.when(copies, "STOPVOD").otherwise(F.concat(F.lit("E"), (F.col("id") % 5).cast("string"))).alias("Event"),
        F.when(copies, "7").otherwise((F.col("id") % 300).cast("string")).alias("ItemId"),
        F.lit("item").alias("ItemName"),
        (F.col("id") % 1000).cast("float").alias("RealTimePlaying"),
        F.lit(1).cast("bigint").alias("ElapsedTimePlaying"),
        F.lit(600).cast("bigint").alias("Duration"),
        F.lit("S").alias("Screen"), F.lit("F").alias("Firmware"), F.lit("VN").alias("PublishCountry"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + ts)).cast("timestamp_ntz").alias("session_timestamp"),
    ).select(*LOGS_CLEAN_SCHEMA.fieldNames())
    return base.repartition(7).cache()


def test_dedup_hot_group(skewed):
    keys = ["Mac", "session_timestamp", "Event", "ItemId"]
    others = [c for c in skewed.columns if c not in keys]
    brute = (skewed.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in others])))
        .where("_rn = 1").drop("_rn"))
    ours = dedup(skewed)
    assert ours.count() == skewed.select(*keys).distinct().count()
    assert ours.exceptAll(brute).count() == 0 and brute.exceptAll(ours).count() == 0


def test_profiles_and_rank_under_skew(skewed):
    fact = skewed.transform(clean).transform(session_features).transform(fact_sessions).cache()
    prof = A.user_profiles(fact)
    assert prof.agg(F.sum("total_events")).first()[0] == fact.count()
    w = Window.partitionBy("Mac").orderBy("session_timestamp", F.asc_nulls_first("Event"),
                                          F.asc_nulls_first("ItemId"))
    plain = fact.select("Mac", "session_timestamp", "Event", "ItemId", F.row_number().over(w).alias("r"))
    ours = A.session_rank(fact).select("Mac", "session_timestamp", "Event", "ItemId",
                                       F.col("session_rank").alias("r"))
    assert plain.exceptAll(ours).count() == 0 and ours.exceptAll(plain).count() == 0
    latest = R.latest_event_per_user(fact).where(F.col("Mac") == "hot").first()
    assert latest["last_timestamp"] == fact.where(F.col("Mac") == "hot").agg(
        F.max("session_timestamp")).first()[0]
