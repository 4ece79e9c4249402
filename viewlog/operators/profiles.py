"""Per-user profiles: activity, watch time, recency and the churn label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewlog.functions.numeric import avg_of_units, units_of
from viewlog.operators import bitmaps
from viewlog.schema import CHURN_THRESHOLD_DAYS, USER_KEYS
from viewlog.session import written


def dataset_end_date(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("session_date").alias("dataset_end_date"))


def end_date_value(fact: DataFrame) -> Column:
    """The dataset's last date as a scalar subquery.

    Spark evaluates it once and injects the value into the plan; nothing is
    collected by our code and no join is needed.
    """
    return fact.select(F.max("session_date")).scalar()


def _top_app(fact: DataFrame) -> DataFrame:
    """Per user: the most frequent app, ties to the smallest name (``_top.app``), and the number of apps.

    Counted per (user, app) with a hash aggregate, then the least
    (NULL last, -count, name) per user. Kept out of the main profile
    aggregate on purpose: ``mode()`` there forces a sort-based pass over all
    Expand rows (measured 28.4 s vs 18.7 s for this split on 1.5 M events).
    NULL apps are counted but ordered last, so a user whose apps are all
    NULL still gets a row, with NULL, as ``mode`` gives.
    """
    per_app = fact.groupBy(*USER_KEYS, "AppName").agg(F.count(F.lit(1)).alias("n"))
    return per_app.groupBy(*USER_KEYS).agg(F.min(F.struct(
        F.col("AppName").isNull().alias("null_app"),
        (-F.col("n")).alias("neg_n"),
        F.col("AppName").alias("app"))).alias("_top"), F.count("AppName").alias("unique_apps_used"))


PROFILE_COLUMNS = USER_KEYS + [
    "total_events", "active_days", "session_count",
    "total_watch_seconds", "avg_watch_per_event", "max_single_watch",
    "unique_content_watched", "unique_apps_used",
    "last_active_date", "first_active_date",
    "primetime_ratio", "weekend_ratio", "avg_completion_rate", "most_used_app",
    "days_inactive", "days_since_first", "avg_daily_watch_seconds", "churn_label",
]


def _derived(end: Column, churn_days: int) -> dict[str, Column]:
    """The measures that follow from a user's dates and sums."""
    days_inactive = F.datediff(end, F.col("last_active_date"))
    return {
        "days_inactive": days_inactive,
        "days_since_first": F.datediff("last_active_date", "first_active_date"),
        "avg_daily_watch_seconds": F.when(
            F.col("active_days") > 0, F.col("total_watch_seconds") / F.col("active_days"),
        ).otherwise(F.lit(0.0)),
        "churn_label": F.when(days_inactive >= churn_days, 1).otherwise(0),
    }


#: A profile's parts of a user-day, and how they add up: every one merges, the sets by OR.
DAY_PARTS = ["events", "watch_sum", "watch_cnt", "watch_max", "hour_bits", "prime", "weekend",
             "comp_units", "comp_exact", "comp_cnt", "comp_sum"]


def _totals() -> list[Column]:
    """Aggregates over parts (of days or months) that hold ``DAY_PARTS`` but ``hour_bits``."""
    return [
        F.coalesce(F.sum("events"), F.lit(0).cast("bigint")).alias("total_events"),
        F.sum("watch_sum").alias("total_watch_seconds"),
        F.sum("watch_cnt").alias("_watch_cnt"),
        F.max("watch_max").alias("max_single_watch"),
        F.sum("prime").alias("_prime"), F.sum("weekend").alias("_weekend"),
        _units_total().alias("_units"),
        F.sum("comp_exact").alias("_exact"), F.sum("comp_cnt").alias("_comp"), F.sum("comp_sum").alias("_comp_sum"),
    ]


def _units_total() -> Column:
    """The sum of exact units; NULL if a part has none though it has exact values."""
    return F.when(F.count_if(F.col("comp_units").isNull() & (F.col("comp_exact") > 0)) == 0, F.try_sum("comp_units"))


def _rates() -> dict[str, Column]:
    """The averages that follow from the totals."""
    return {
        # avg() counts non-NULL values only; so does watch_cnt.
        "avg_watch_per_event": F.try_divide(F.col("total_watch_seconds"), F.col("_watch_cnt")),
        "primetime_ratio": F.col("_prime") / F.col("total_events"),
        "weekend_ratio": F.col("_weekend") / F.col("total_events"),
        "avg_completion_rate": avg_of_units(F.col("_units"), F.col("_exact"), F.col("_comp"),
                                            F.try_divide(F.col("_comp_sum"), F.col("_comp")), 4),
    }


def profile_core(fact: DataFrame, end_date: Column | None = None, churn_days: int = CHURN_THRESHOLD_DAYS,
                 items: bool = True, apps: bool = True) -> DataFrame:
    """Profiles without the most used app: no join, no Expand.

    The events are aggregated at three grains, (user, date) with the hours as a
    bitmap, (user, item) and (user, app); their union is folded per user, where
    a distinct count is the number of rows of a grain or of bits set. All
    buffers are of fixed size, so every step is a hash aggregate that combines
    map-side. Without ``items`` or ``apps`` their grain and count are left out.
    """
    left_out = {"most_used_app"} | ({"unique_content_watched"} if not items else set()) | ({"unique_apps_used"} if not apps else set())
    return _finished(_folded(fact, items, apps), end_date if end_date is not None else end_date_value(fact), churn_days,
                     [c for c in PROFILE_COLUMNS if c not in left_out])


def _folded(fact: DataFrame, items: bool, apps: bool) -> DataFrame:
    days = user_day_summary(fact)
    parts, names = [days], ["session_date", *DAY_PARTS]
    for wanted, column, name in ((items, "ItemId", "_item"), (apps, "AppName", "_app")):
        if wanted:
            parts.append(fact.where(F.col(column).isNotNull()).groupBy(*USER_KEYS, column).agg(F.lit(1).alias(name)).drop(column))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    aggs = [*_totals(), F.count("session_date").alias("active_days"), bitmaps.size(F.col("hour_bits")).alias("session_count"),
            F.max("session_date").alias("last_active_date"), F.min("session_date").alias("first_active_date")]
    aggs += [F.count(c).alias(name) for wanted, c, name in ((items, "_item", "unique_content_watched"), (apps, "_app", "unique_apps_used")) if wanted]
    return union.select(*USER_KEYS, *names, *[c for c in ("_item", "_app") if c in union.columns]).groupBy(*USER_KEYS).agg(*aggs)


def _finished(core: DataFrame, end: Column, churn_days: int, columns: list[str]) -> DataFrame:
    derived = {**_derived(end, churn_days), **_rates()}
    return core.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in columns])


def user_profiles(fact: DataFrame, end_date: Column | None = None,
                  churn_days: int = CHURN_THRESHOLD_DAYS) -> DataFrame:
    """One row per (Mac, CustomerID, Contract); NULL keys group together.

    ``profile_core`` with the apps counted, and the most used one found, by a
    separate per-(user, app) count, joined NULL-safely on the user keys.
    """
    joined = _with_user_side(_folded(fact, items=True, apps=False), _top_app(fact)).withColumns({
        "unique_apps_used": F.coalesce(F.col("unique_apps_used"), F.lit(0).cast("bigint")), "most_used_app": F.col("_top.app")})
    return _finished(joined, end_date if end_date is not None else end_date_value(fact), churn_days, PROFILE_COLUMNS)


def user_recency(profiles: DataFrame) -> DataFrame:
    return profiles.select(*USER_KEYS, "first_active_date", "last_active_date",
                           "days_inactive", "days_since_first")


def user_daily_watch(profiles: DataFrame) -> DataFrame:
    return profiles.select(*USER_KEYS, "total_watch_seconds", "active_days",
                           "avg_daily_watch_seconds")


def churn_labels(profiles: DataFrame) -> DataFrame:
    return profiles.select(*USER_KEYS, "days_inactive", "churn_label")


def most_used_app(fact: DataFrame) -> DataFrame:
    return _top_app(fact).select(*USER_KEYS, F.col("_top.app").alias("most_used_app"))


def session_rank(fact: DataFrame) -> DataFrame:
    """Row number of each event within its user, by time, Event, ItemId, then every other column.

    The events are range-partitioned and sorted by the whole order, which
    splits any user, however heavy, over as many partitions as its rows fill.
    A row's position in its partition comes with the sort; a table with one
    row per (partition, user) holds where the user starts in each partition
    and how many of its rows lie before. Only rows equal in every column can
    swap, which changes nothing. The placed rows are written once: the table
    and the numbering have to see the same partitions.
    """
    keys = ["Mac", "session_timestamp", "Event", "ItemId"]
    order = [F.asc_nulls_first(k) for k in keys + [c for c in fact.columns if c not in keys]]
    placed = written(fact.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()), "placed")
    before = Window.partitionBy("_user").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(F.col("Mac").alias("_user"), F.col("_part").alias("_slice"))
              .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    # Mac is never NULL in the fact table, so a plain equi-join suffices.
    rank = F.col("_row") - F.col("_first") + F.col("_before") + 1
    return (placed.join(starts, (F.col("Mac") == F.col("_user")) & (F.col("_part") == F.col("_slice")))
                  .select(*fact.columns, rank.cast("int").alias("session_rank")))


# --- profiles from summaries -----------------------------------------------------
# Every profile column is a sum, max/min, or the size of a set whose parts
# merge exactly. User-days hold the parts of one date and are refreshed with
# it; user-months merge the user-days of a month, with the active days and the
# items as bitmaps. Profiles are the sum of a user's months, so a run that
# touches a few dates reads the user-days of their months only, and the months.


def user_day_summary(fact: DataFrame) -> DataFrame:
    """One row per (user, date) with the mergeable parts of a profile; hours are a bitmap."""
    units = units_of("completion_rate", 4)
    return fact.groupBy(*USER_KEYS, "session_date").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("RealTimePlaying").alias("watch_sum"),
        F.count("RealTimePlaying").alias("watch_cnt"),
        F.max("RealTimePlaying").alias("watch_max"),
        bitmaps.bits(F.col("hour_of_day")).alias("hour_bits"),
        F.sum("is_primetime").alias("prime"),
        F.sum("is_weekend").alias("weekend"),
        F.try_sum(units).alias("comp_units"),
        F.count(units).alias("comp_exact"),
        F.count("completion_rate").alias("comp_cnt"),
        F.sum("completion_rate").alias("comp_sum"),
    )


def user_day_apps(fact: DataFrame) -> DataFrame:
    """Events per (user, date, app); NULL apps are left out, as in ``mode``."""
    return (fact.where(F.col("AppName").isNotNull())
                .groupBy(*USER_KEYS, "session_date", "AppName")
                .agg(F.count(F.lit(1)).alias("n")))


def user_day_items(fact: DataFrame) -> DataFrame:
    """Distinct (user, date, item)."""
    return (fact.where(F.col("ItemId").isNotNull())
                .select(*USER_KEYS, "session_date", "ItemId").distinct())


def month_of(date: str = "session_date") -> Column:
    """The first day of a date's month."""
    return F.trunc(date, "month").alias("month")


def user_month_summary(days: DataFrame) -> DataFrame:
    """User-days merged per (user, month): the active days as a bitmap, the hours (of disjoint days) as their number."""
    return days.groupBy(*USER_KEYS, month_of()).agg(
        F.sum("events").alias("events"),
        F.sum("watch_sum").alias("watch_sum"), F.sum("watch_cnt").alias("watch_cnt"), F.max("watch_max").alias("watch_max"),
        bitmaps.bits(F.dayofmonth("session_date")).alias("day_bits"),
        bitmaps.size(F.col("hour_bits")).alias("hours"),
        F.sum("prime").alias("prime"), F.sum("weekend").alias("weekend"),
        _units_total().alias("comp_units"), F.sum("comp_exact").alias("comp_exact"),
        F.sum("comp_cnt").alias("comp_cnt"), F.sum("comp_sum").alias("comp_sum"),
        F.max("session_date").alias("last_date"), F.min("session_date").alias("first_date"))


def user_month_apps(apps: DataFrame) -> DataFrame:
    """Events per (user, month, app)."""
    return apps.groupBy(*USER_KEYS, month_of(), "AppName").agg(F.sum("n").alias("n"))


def user_month_items(items: DataFrame, codes: DataFrame) -> DataFrame:
    """``user, month, word, bits``: the items of a user's month as a bitmap of their codes (``value, code``)."""
    coded = items.join(codes, F.col("ItemId") == F.col("value")).select(*USER_KEYS, month_of(), "code")
    return bitmaps.words(coded, [*USER_KEYS, "month"], "code")


def _with_user_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` and the further columns of ``right``, NULL-safe on the user keys.

    The right keys get names of their own: both sides come from one table, so
    a condition on equal names would compare a column with itself.
    """
    other = right.select(*[F.col(k).alias(f"_right_{k}") for k in USER_KEYS],
                         *[c for c in right.columns if c not in USER_KEYS])
    cond = None
    for k in USER_KEYS:
        c = F.col(k).eqNullSafe(F.col(f"_right_{k}"))
        cond = c if cond is None else cond & c
    return left.join(other, cond, "left").drop(*[f"_right_{k}" for k in USER_KEYS])


def _assembled(base: DataFrame, apps: DataFrame, items: DataFrame, end: Column, churn_days: int) -> DataFrame:
    """Profiles from per-user totals, app counts and item counts, joined NULL-safely on the user keys."""
    per_app = apps.groupBy(*USER_KEYS, "AppName").agg(F.sum("n").alias("n"))
    app_side = per_app.groupBy(*USER_KEYS).agg(
        F.count(F.lit(1)).alias("unique_apps_used"),
        # Highest count, then smallest name: the deterministic mode.
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("AppName").alias("app")))
         .alias("_top"))
    zero = F.lit(0).cast("bigint")
    joined = _with_user_side(_with_user_side(base, app_side), items).withColumns({
        "unique_content_watched": F.coalesce(F.col("unique_content_watched"), zero),
        "unique_apps_used": F.coalesce(F.col("unique_apps_used"), zero),
        "most_used_app": F.col("_top.app")})
    return _finished(joined, end, churn_days, PROFILE_COLUMNS)


def profiles_from_summaries(days: DataFrame, apps: DataFrame, items: DataFrame,
                            churn_days: int = CHURN_THRESHOLD_DAYS) -> DataFrame:
    """Same rows as ``user_profiles(fact)``, from the three per-day summaries."""
    base = days.groupBy(*USER_KEYS).agg(
        *_totals(), F.count(F.lit(1)).alias("active_days"), bitmaps.size(F.col("hour_bits")).alias("session_count"),
        F.max("session_date").alias("last_active_date"), F.min("session_date").alias("first_active_date"))
    item_side = items.groupBy(*USER_KEYS, "ItemId").agg(F.lit(1).alias("_one")).groupBy(*USER_KEYS).agg(
        F.count(F.lit(1)).alias("unique_content_watched"))
    return _assembled(base, apps, item_side, days.select(F.max("session_date")).scalar(), churn_days)


def profiles_from_months(months: DataFrame, apps: DataFrame, items: DataFrame,
                         churn_days: int = CHURN_THRESHOLD_DAYS) -> DataFrame:
    """Same rows as ``user_profiles(fact)``, from the three per-month summaries."""
    base = months.groupBy(*USER_KEYS).agg(
        *_totals(), bitmaps.size(F.col("day_bits")).alias("active_days"),
        F.coalesce(F.sum("hours"), F.lit(0).cast("bigint")).alias("session_count"),
        F.max("last_date").alias("last_active_date"), F.min("first_date").alias("first_active_date"))
    item_side = bitmaps.counts(items, USER_KEYS, "unique_content_watched")
    return _assembled(base, apps, item_side, months.select(F.max("last_date")).scalar(), churn_days)
