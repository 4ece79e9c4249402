"""Report queries over the fact table and the user profiles.

Every report is a grouped aggregate, so Spark combines partial results
map-side before the shuffle; distinct counts are planned as a two-level
aggregate on (group, value), which spreads a hot group over many reducers.
Orderings carry explicit tie-breaks so repeated runs give identical output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewlog.functions.numeric import exact_avg
from viewlog.operators.features import completion_bucket_col
from viewlog.schema import RETENTION_MARKS, VOD_PLAY_EVENTS


def _avg1(c: str) -> Column:
    return F.round(F.avg(c), 1)


def daily_active_users(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("session_date")
                .agg(F.countDistinct("Mac").alias("dau"),
                     F.count(F.lit(1)).alias("total_events"),
                     _avg1("RealTimePlaying").alias("avg_watch_sec"))
                .orderBy("session_date"))


def top_content(fact: DataFrame, k: int = 10) -> DataFrame:
    """Top-k items by watch time among VOD play/stop events; ties by ItemId.

    The ranking aggregates numbers only (hash aggregates); names are looked up
    for the k items afterwards.
    """
    plays = fact.where(F.col("Event").isin(*VOD_PLAY_EVENTS))
    order = [F.desc_nulls_last("total_watch_seconds"), F.asc_nulls_first("ItemId")]
    top = (plays.groupBy("ItemId")
                .agg(F.sum("RealTimePlaying").alias("total_watch_seconds"),
                     F.round(F.sum("RealTimePlaying") / 3600, 1).alias("total_watch_hours"),
                     F.countDistinct("Mac").alias("unique_viewers"),
                     F.round(exact_avg("completion_rate", 4), 3).alias("avg_completion"))
                .orderBy(*order).limit(k))
    names = plays.select(F.col("ItemId").alias("_item"), "ItemName")
    # k rows: the broadcast has a fixed size.
    named = names.join(F.broadcast(top), F.col("_item").eqNullSafe(F.col("ItemId")))
    return (named.groupBy(*top.columns).agg(F.max("ItemName").alias("item_name"))
                 .select("ItemId", "item_name", *top.columns[1:]).orderBy(*order))


def activity_heatmap(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("hour_of_day", "day_of_week")
                .agg(F.countDistinct("Mac").alias("active_users"),
                     _avg1("RealTimePlaying").alias("avg_watch_sec"))
                .orderBy("day_of_week", "hour_of_day"))


def app_usage(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("AppName")
                .agg(F.countDistinct("Mac").alias("unique_users"),
                     F.count(F.lit(1)).alias("total_events"),
                     F.round(F.sum("RealTimePlaying") / 3600, 0).alias("total_watch_hours"),
                     _avg1("RealTimePlaying").alias("avg_watch_per_event"))
                .orderBy(F.desc_nulls_last("total_watch_hours"), F.asc_nulls_first("AppName")))


def churn_analysis(profiles: DataFrame) -> DataFrame:
    return (profiles.groupBy("churn_label")
                    .agg(F.count(F.lit(1)).alias("user_count"),
                         F.round(F.avg("total_watch_seconds") / 3600, 1).alias("avg_watch_hours"),
                         _avg1("active_days").alias("avg_active_days"),
                         _avg1("unique_content_watched").alias("avg_content_variety"),
                         F.round(F.avg("avg_completion_rate"), 3).alias("avg_completion"),
                         F.round(F.avg("primetime_ratio"), 3).alias("avg_primetime_ratio"))
                    .orderBy("churn_label"))


def cohort_retention(profiles: DataFrame, marks: tuple[int, ...] = RETENTION_MARKS) -> DataFrame:
    """Users by first active month; how many reached each active-day mark."""
    cohort = F.date_format(F.trunc("first_active_date", "month"), "yyyy-MM")
    return (profiles.groupBy(cohort.alias("cohort"))
                    .agg(F.count(F.lit(1)).alias("cohort_size"),
                         _avg1("active_days").alias("avg_active_days"),
                         *[F.count_if(F.col("active_days") >= m).alias(f"retained_{m}d")
                           for m in marks])
                    .orderBy("cohort"))


def completion_buckets(fact: DataFrame, null_bucket: bool = False) -> DataFrame:
    return (fact.where(F.col("AppName") == "VOD")
                .groupBy(completion_bucket_col(null_bucket=null_bucket).alias("bucket"))
                .agg(F.count(F.lit(1)).alias("sessions"))
                .orderBy("bucket"))


#: A user's last event, as it stands in the reports and in the state.
LAST = ["last_timestamp", "last_event", "last_item_id"]


def latest_event_per_user(fact: DataFrame) -> DataFrame:
    """Each user's last event: latest time, then greatest Event, then ItemId.

    ``max(struct(...))`` instead of a descending ``row_number`` window: the
    aggregate is combined map-side, so even a user with a third of all rows
    leaves one partial row per map task.
    """
    return _latest(fact, ["Mac"])


def latest_event_per_day(fact: DataFrame) -> DataFrame:
    """Each user's last event of each date: the parts that ``merge_latest`` folds."""
    return _latest(fact, ["Mac", "session_date"])


def _latest(fact: DataFrame, keys: list[str]) -> DataFrame:
    events = fact.select(*keys, *[F.col(c).alias(name) for c, name in zip(("session_timestamp", "Event", "ItemId"), LAST)])
    return merge_latest(events, keys)


def merge_latest(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The last of ``LAST`` for each ``keys``; parts may come from any days, in any order, late or twice."""
    return parts.groupBy(*keys).agg(F.max(F.struct(*LAST)).alias("_last")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in LAST])


def last_action(fact: DataFrame) -> DataFrame:
    return last_action_of(latest_event_per_user(fact))


def last_action_of(latest: DataFrame) -> DataFrame:
    """Users by their last event, from one row per user."""
    return (latest.groupBy("last_event").agg(F.count(F.lit(1)).alias("users"))
            .orderBy(F.desc("users"), F.asc_nulls_first("last_event")))


def monthly_active_users(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("year", "month")
                .agg(F.countDistinct("Mac").alias("active_users"),
                     F.count(F.lit(1)).alias("total_events"))
                .orderBy("year", "month"))


def events_by_app(fact: DataFrame) -> DataFrame:
    """Events per app and their share of all events.

    The total is a scalar subquery over the grouped counts, not over the
    fact table: its plan then matches the main query's, so AQE reuses the
    same shuffle output instead of deduplicating the events twice. No
    single-partition window and no driver-side collect.
    """
    return share_of_events(fact.groupBy("AppName").agg(F.count(F.lit(1)).alias("events")))


def share_of_events(per_app: DataFrame) -> DataFrame:
    """Event counts per app with their share of the total."""
    total = per_app.select(F.sum("events")).scalar()
    return (per_app.withColumn("event_share", F.round(F.col("events") / total, 4))
                   .orderBy(F.desc("events"), F.asc_nulls_first("AppName")))


def active_hours(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("hour_of_day")
                .agg(F.count(F.lit(1)).alias("events"),
                     F.countDistinct("Mac").alias("active_users"),
                     _avg1("RealTimePlaying").alias("avg_watch_sec"))
                .orderBy("hour_of_day"))


def watch_time_by_bucket(fact: DataFrame, null_bucket: bool = False) -> DataFrame:
    return (fact.where(F.col("AppName") == "VOD")
                .groupBy(completion_bucket_col(null_bucket=null_bucket).alias("bucket"))
                .agg(F.count(F.lit(1)).alias("sessions"),
                     F.round(F.avg("RealTimePlaying") / 60, 1).alias("avg_watch_min"))
                .orderBy("bucket"))


def crashed_share(fact: DataFrame, crash_event: str = "STARTCHANNEL") -> DataFrame:
    """Share of users whose last event is a channel start (a crashed session)."""
    return crashed_share_of(latest_event_per_user(fact), crash_event)


def crashed_share_of(latest: DataFrame, crash_event: str = "STARTCHANNEL") -> DataFrame:
    """The crashed share from one row per user."""
    crashed = F.col("last_event") == crash_event
    return (latest
            .agg(F.count(F.lit(1)).alias("users"),
                 F.count_if(crashed).alias("crashed_users"),
                 F.round(F.avg(F.when(crashed, 1).otherwise(0)), 4).alias("crashed_share")))


def completion_by_entry(fact: DataFrame, short_play_seconds: int = 120) -> DataFrame:
    """VOD completion per entry screen, and the share of plays under 2 minutes."""
    short = F.when(F.col("RealTimePlaying") < short_play_seconds, 1).otherwise(0)
    return (fact.where(F.col("AppName") == "VOD")
                .groupBy("Screen")
                .agg(F.count(F.lit(1)).alias("sessions"),
                     F.round(exact_avg("completion_rate", 4), 4).alias("avg_completion"),
                     F.round(F.avg(short), 4).alias("short_play_share"))
                .orderBy(F.asc_nulls_first("Screen")))


def mau_change(fact: DataFrame) -> DataFrame:
    """Monthly active users and the change from the previous month.

    The window runs over the monthly result, one row per calendar month, so
    its single partition is bounded by the time span, not by the data size.
    """
    return change_by_month(monthly_active_users(fact))


def change_by_month(monthly: DataFrame) -> DataFrame:
    """The change from the previous month of ``year, month, active_users``."""
    w = Window.orderBy("year", "month")
    prev = F.lag("active_users").over(w)
    return (monthly.select("year", "month", "active_users").withColumn("prev_active_users", prev)
                   .withColumn("change", F.col("active_users") - F.col("prev_active_users"))
                   .withColumn("change_pct", F.round(
                       F.col("change") * 100.0 / F.col("prev_active_users"), 2))
                   .orderBy("year", "month"))
