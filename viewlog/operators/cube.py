"""One scan for the activity reports: distinct users at five groupings at once.

The fact is first reduced to one row per (Mac, date, hour, app). GROUPING SETS
over that table give each user's rows per date, per weekday and hour, per app,
per month and per hour; a second aggregate counts the users of each group.
Both levels combine map-side, so a hot user, day or app is never gathered, and
a report reads a table whose size follows the calendar and the number of apps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlog.operators.reports import change_by_month, share_of_events

#: The groupings, by the columns that a row of each has.
GROUPINGS: dict[str, list[str]] = {
    "date": ["session_date"],
    "week_hour": ["hour_of_day", "day_of_week"],
    "app": ["AppName"],
    "month": ["year", "month"],
    "hour": ["hour_of_day"],
}
KEYS = ["session_date", "hour_of_day", "day_of_week", "AppName", "year", "month"]


def activity_cube(fact: DataFrame) -> DataFrame:
    """``grouping``, its columns (others NULL), ``users, events, watch_sum, watch_count``.

    A NULL app is a group of its own: ``grouping`` tells it from the rows that
    have no app because they are grouped by something else. Users are distinct
    not-NULL ``Mac`` values.
    """
    per_user = (fact.groupBy("Mac", "session_date", "hour_of_day", "AppName")
                .agg(F.count(F.lit(1)).alias("events"), F.sum("RealTimePlaying").alias("watch_sum"),
                     F.count("RealTimePlaying").alias("watch_count"))
                .withColumns({"day_of_week": F.dayofweek("session_date"), "year": F.year("session_date"), "month": F.month("session_date")}))
    sums = [F.sum(c).alias(c) for c in ("events", "watch_sum", "watch_count")]
    grouped = per_user.groupingSets([[F.col(c) for c in ("Mac", *by)] for by in GROUPINGS.values()], "Mac", *KEYS).agg(
        *[F.grouping(c).alias(f"_no_{c}") for c in KEYS], *sums)
    name = None
    for label, by in GROUPINGS.items():
        cond = F.lit(True)
        for c in KEYS:
            cond = cond & (F.col(f"_no_{c}") == F.lit(0 if c in by else 1))
        name = F.when(cond, label) if name is None else name.when(cond, label)
    return (grouped.withColumn("grouping", name).groupBy("grouping", *KEYS)
            .agg(F.count("Mac").alias("users"), *sums))


def _avg(scale: int = 1) -> Column:
    return F.round(F.try_divide(F.col("watch_sum"), F.col("watch_count")), scale)


def _of(cube: DataFrame, grouping: str) -> DataFrame:
    return cube.where(F.col("grouping") == grouping)


def daily_active_users(cube: DataFrame) -> DataFrame:
    return (_of(cube, "date").select("session_date", F.col("users").alias("dau"), F.col("events").alias("total_events"),
                                     _avg().alias("avg_watch_sec"))
            .orderBy("session_date"))


def activity_heatmap(cube: DataFrame) -> DataFrame:
    return (_of(cube, "week_hour").select("hour_of_day", "day_of_week", F.col("users").alias("active_users"), _avg().alias("avg_watch_sec"))
            .orderBy("day_of_week", "hour_of_day"))


def app_usage(cube: DataFrame) -> DataFrame:
    return (_of(cube, "app").select("AppName", F.col("users").alias("unique_users"), F.col("events").alias("total_events"),
                                    F.round(F.col("watch_sum") / 3600, 0).alias("total_watch_hours"), _avg().alias("avg_watch_per_event"))
            .orderBy(F.desc_nulls_last("total_watch_hours"), F.asc_nulls_first("AppName")))


def monthly_active_users(cube: DataFrame) -> DataFrame:
    return (_of(cube, "month").select("year", "month", F.col("users").alias("active_users"), F.col("events").alias("total_events"))
            .orderBy("year", "month"))


def mau_change(cube: DataFrame) -> DataFrame:
    return change_by_month(monthly_active_users(cube))


def events_by_app(cube: DataFrame) -> DataFrame:
    return share_of_events(_of(cube, "app").select("AppName", "events"))


def active_hours(cube: DataFrame) -> DataFrame:
    return (_of(cube, "hour").select("hour_of_day", "events", F.col("users").alias("active_users"), _avg().alias("avg_watch_sec"))
            .orderBy("hour_of_day"))


#: The reports that the cube answers; each gives the rows of the report of that name over the fact.
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    f.__name__: f for f in (daily_active_users, activity_heatmap, app_usage, monthly_active_users, mau_change, events_by_app, active_hours)}
