"""Derived columns of the fact table; all are row-local projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlog.schema import (
    COMPLETION_BUCKET_ELSE, COMPLETION_BUCKETS, FACT_COLUMNS, PRIMETIME_HOURS,
    WATCH_CATEGORIES, WATCH_CATEGORY_ELSE, WEEKEND_DAYS,
)


def date_parts(df: DataFrame, ts: str = "session_timestamp") -> DataFrame:
    return df.withColumns({
        "hour_of_day": F.hour(ts),
        "day_of_week": F.dayofweek(ts),  # 1 = Sunday ... 7 = Saturday
        "session_date": F.to_date(ts),
        "month": F.month(ts),
        "year": F.year(ts),
    })


def completion_rate_col() -> Column:
    # NULL unless Duration > 0 (also keeps ANSI mode clear of divide-by-zero).
    # Not clamped: watch time may exceed the duration.
    return (F.when(F.col("Duration") > 0,
                   F.round(F.col("RealTimePlaying") / F.col("Duration"), 4))
             .otherwise(F.lit(None).cast("double")))


def completion_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("completion_rate", completion_rate_col())


def watch_category_col(c: str = "RealTimePlaying") -> Column:
    expr = None
    for bound, label in WATCH_CATEGORIES:
        expr = F.when(F.col(c) < bound, label) if expr is None else expr.when(F.col(c) < bound, label)
    return expr.otherwise(WATCH_CATEGORY_ELSE)


def watch_category(df: DataFrame) -> DataFrame:
    return df.withColumn("watch_category", watch_category_col())


def time_flags(df: DataFrame) -> DataFrame:
    lo, hi = PRIMETIME_HOURS
    # A NULL hour or day gives 0, not NULL.
    return df.withColumns({
        "is_primetime": F.when(F.col("hour_of_day").between(lo, hi), 1).otherwise(0),
        "is_weekend": F.when(F.col("day_of_week").isin(*WEEKEND_DAYS), 1).otherwise(0),
    })


def session_features(df: DataFrame) -> DataFrame:
    return (df.transform(date_parts)
              .transform(completion_rate)
              .transform(watch_category)
              .transform(time_flags))


def fact_sessions(features_df: DataFrame) -> DataFrame:
    """The 23 fact columns in their fixed order."""
    return features_df.select(*FACT_COLUMNS)


def completion_bucket_col(c: str = "completion_rate", null_bucket: bool = False) -> Column:
    """Bucket label of a completion rate.

    As in the original report, a NULL rate falls through to the last label;
    ``null_bucket=True`` gives it an ``'unknown'`` label instead.
    """
    expr = F.when(F.col(c).isNull(), "unknown") if null_bucket else None
    for bound, label in COMPLETION_BUCKETS:
        expr = F.when(F.col(c) < bound, label) if expr is None else expr.when(F.col(c) < bound, label)
    return expr.otherwise(COMPLETION_BUCKET_ELSE)
