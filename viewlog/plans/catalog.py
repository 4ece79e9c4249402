"""Registry of named queries: Spark callables and their DuckDB oracle SQL.

Each Spark query takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole test tables (those of sources, sinks, load and streaming write files
when called); each oracle computes the same rows in DuckDB over the
pre-registered views of the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.operators import clean as C
from viewlog.operators import features as D
from viewlog.operators import ingest as I
from viewlog.operators import profiles as A
from viewlog.operators import reports as R
from viewlog.operators.bitmaps import new_codes
from viewlog.operators.cube import activity_cube
from viewlog.operators.quality import quality_report
from viewlog.plans import oracle as O
from viewlog.plans.transform import build_fact, fact_ev, fact_or, profile_core_or, profiles_or
from viewlog.session import work_path, written
from viewlog.sources import sinks as S
from viewlog.sources.ledger import line_digests, source_changes
from viewlog.sources.tables import (load_raw_lines, load_sessions_ev, load_sessions_ev_dup,
                                    read_fact, read_logs_clean, read_table)
from viewlog.sources.text import read_text_logs, source_check
from viewlog.streaming.incremental import ingest_new_files, refresh_fact

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


rnd = O.rnd

# --- cleaning ---------------------------------------------------------------

register("filter_not_null", f"SELECT * FROM ({O.not_null(O.SESSIONS_EV)})")(
    lambda s, d: C.filter_not_null(load_sessions_ev(s, d)))

register("dedup_sessions", O.dedup(O.not_null(O.SESSIONS_EV_DUP)))(
    lambda s, d: C.dedup(C.filter_not_null(load_sessions_ev_dup(s, d))))

register("dedup_hashed", O.dedup(O.not_null(O.SESSIONS_EV_DUP)))(
    lambda s, d: C.dedup_hashed(C.filter_not_null(load_sessions_ev_dup(s, d))))

register("fill_nulls", f"""
SELECT * REPLACE (
  CASE WHEN "RealTimePlaying" IS NULL OR isnan("RealTimePlaying") THEN CAST(0 AS FLOAT)
       ELSE "RealTimePlaying" END AS "RealTimePlaying",
  coalesce("ElapsedTimePlaying", CAST(0 AS BIGINT)) AS "ElapsedTimePlaying")
FROM ({O.SESSIONS_EV})""")(lambda s, d: C.fill_nulls(load_sessions_ev(s, d)))

register("normalize_text", f"""
SELECT * REPLACE (upper(trim("AppName")) AS "AppName", upper(trim("Event")) AS "Event")
FROM ({O.SESSIONS_EV})""")(lambda s, d: C.normalize_text(load_sessions_ev(s, d)))

register("clean_sessions", O.clean(O.SESSIONS_EV_DUP))(
    lambda s, d: C.clean(load_sessions_ev_dup(s, d)))

register("clean_audit", f"""
SELECT CAST(count(*) AS BIGINT) AS rows_before,
  CAST((SELECT count(*) FROM ({O.clean(O.SESSIONS_EV_DUP)})) AS BIGINT) AS rows_after,
  CAST(count(*) - (SELECT count(*) FROM ({O.clean(O.SESSIONS_EV_DUP)})) AS BIGINT) AS rows_removed
FROM ({O.SESSIONS_EV_DUP})""")(lambda s, d: C.clean_audit(load_sessions_ev_dup(s, d)))

# --- features ---------------------------------------------------------------

_FEAT_EV = O.features(O.clean(O.SESSIONS_EV))


def _features_ev(s: SparkSession, d: str) -> DataFrame:
    return C.clean(load_sessions_ev(s, d)).transform(D.session_features)


register("date_parts", f"""
SELECT "Mac", session_timestamp, session_date, hour_of_day, day_of_week, month, year
FROM ({_FEAT_EV})""")(lambda s, d: _features_ev(s, d).select(
    "Mac", "session_timestamp", "session_date", "hour_of_day", "day_of_week", "month", "year"))

register("completion_rate", f"""
SELECT "Mac", session_timestamp, "Event", "ItemId", "RealTimePlaying", "Duration", completion_rate
FROM ({_FEAT_EV})""")(lambda s, d: _features_ev(s, d).select(
    "Mac", "session_timestamp", "Event", "ItemId", "RealTimePlaying", "Duration", "completion_rate"))

register("watch_category", f"""
SELECT watch_category, CAST(count(*) AS BIGINT) AS events FROM ({_FEAT_EV}) GROUP BY 1""")(
    lambda s, d: _features_ev(s, d).groupBy("watch_category").count().withColumnRenamed("count", "events"))

register("time_flags", f"""
SELECT hour_of_day, day_of_week, is_primetime, is_weekend, CAST(count(*) AS BIGINT) AS events
FROM ({_FEAT_EV}) GROUP BY ALL""")(
    lambda s, d: _features_ev(s, d).groupBy("hour_of_day", "day_of_week", "is_primetime", "is_weekend")
    .count().withColumnRenamed("count", "events"))

register("session_features", _FEAT_EV)(_features_ev)

register("fact_sessions", O.FACT_EV)(lambda s, d: build_fact(load_sessions_ev(s, d), C.dedup_hashed))

# --- reports over the event-level fact ---------------------------------------

register("daily_active_users", f"""
SELECT session_date, count(DISTINCT "Mac") AS dau, count(*) AS total_events,
  {rnd('avg("RealTimePlaying")', 1)} AS avg_watch_sec
FROM ({O.FACT_EV}) GROUP BY session_date ORDER BY session_date""")(
    lambda s, d: R.daily_active_users(fact_ev(s, d)))

register("top_content", f"""
SELECT "ItemId", max("ItemName") AS item_name,
  sum(CAST("RealTimePlaying" AS DOUBLE)) AS total_watch_seconds,
  {rnd('sum(CAST("RealTimePlaying" AS DOUBLE)) / 3600', 1)} AS total_watch_hours,
  count(DISTINCT "Mac") AS unique_viewers,
  {rnd(O.exact_avg('completion_rate', 4), 3)} AS avg_completion
FROM ({O.FACT_EV}) WHERE "Event" IN ('STOPVOD', 'PLAYVOD')
GROUP BY "ItemId" ORDER BY total_watch_seconds DESC NULLS LAST, "ItemId" ASC NULLS FIRST
LIMIT 10""")(lambda s, d: R.top_content(fact_ev(s, d)))

register("activity_heatmap", f"""
SELECT hour_of_day, day_of_week, count(DISTINCT "Mac") AS active_users,
  {rnd('avg("RealTimePlaying")', 1)} AS avg_watch_sec
FROM ({O.FACT_EV}) GROUP BY hour_of_day, day_of_week ORDER BY day_of_week, hour_of_day""")(
    lambda s, d: R.activity_heatmap(fact_ev(s, d)))

register("app_usage", f"""
SELECT "AppName", count(DISTINCT "Mac") AS unique_users, count(*) AS total_events,
  {rnd('sum(CAST("RealTimePlaying" AS DOUBLE)) / 3600', 0)} AS total_watch_hours,
  {rnd('avg("RealTimePlaying")', 1)} AS avg_watch_per_event
FROM ({O.FACT_EV}) GROUP BY "AppName" ORDER BY total_watch_hours DESC""")(
    lambda s, d: R.app_usage(fact_ev(s, d)))

_CUBE_KEYS = {"date": ["session_date"], "week_hour": ["hour_of_day", "day_of_week"], "app": ['"AppName"'],
              "month": ["year", "month"], "hour": ["hour_of_day"]}
_CUBE_COLS = {"session_date": "DATE", "hour_of_day": "INTEGER", "day_of_week": "INTEGER", '"AppName"': "VARCHAR",
              "year": "INTEGER", "month": "INTEGER"}

register("activity_cube", f"WITH f AS ({O.FACT_EV}) " + " UNION ALL ".join(f"""
SELECT '{name}' AS "grouping", {", ".join(c if c in by else f"CAST(NULL AS {t}) AS {c}" for c, t in _CUBE_COLS.items())},
  count(DISTINCT "Mac") AS users, count(*) AS events, {rnd('sum(CAST("RealTimePlaying" AS DOUBLE))', 3)} AS watch_sum,
  count("RealTimePlaying") AS watch_count
FROM f GROUP BY {", ".join(by)}""" for name, by in _CUBE_KEYS.items()))(
    lambda s, d: activity_cube(fact_ev(s, d)).withColumn("watch_sum", F.round("watch_sum", 3)))

_BUCKET = """CASE WHEN completion_rate < 0.25 THEN '0-25% (dropped early)'
  WHEN completion_rate < 0.50 THEN '25-50%' WHEN completion_rate < 0.75 THEN '50-75%'
  ELSE '75-100% (completed)' END"""

register("completion_buckets", f"""
SELECT {_BUCKET} AS bucket, count(*) AS sessions
FROM ({O.FACT_EV}) WHERE "AppName" = 'VOD' GROUP BY 1 ORDER BY 1""")(
    lambda s, d: R.completion_buckets(fact_ev(s, d)))

_LATEST = f"""
SELECT "Mac", session_timestamp AS last_timestamp, "Event" AS last_event, "ItemId" AS last_item_id
FROM (SELECT *, row_number() OVER (PARTITION BY "Mac"
        ORDER BY session_timestamp DESC, "Event" DESC NULLS LAST, "ItemId" DESC NULLS LAST) AS rn__
      FROM ({O.FACT_EV})) WHERE rn__ = 1"""

register("latest_event_per_user", _LATEST)(lambda s, d: R.latest_event_per_user(fact_ev(s, d)))


def _latest_via_months(s: SparkSession, d: str) -> DataFrame:
    """Last events per date, merged per month, merged per user: the steps of an incremental run."""
    days = R.latest_event_per_day(fact_ev(s, d)).withColumn("month", A.month_of())
    return R.merge_latest(R.merge_latest(days, ["Mac", "month"]), ["Mac"])


register("latest_from_months", _LATEST)(_latest_via_months)

register("last_action", f"""
SELECT last_event, count(*) AS users FROM ({_LATEST}) GROUP BY last_event
ORDER BY users DESC""")(lambda s, d: R.last_action(fact_ev(s, d)))

register("events_by_app", f"""
WITH f AS ({O.FACT_EV})
SELECT "AppName", count(*) AS events,
  {rnd('count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM f)', 4)} AS event_share
FROM f GROUP BY "AppName" ORDER BY events DESC""")(lambda s, d: R.events_by_app(fact_ev(s, d)))

register("active_hours", f"""
SELECT hour_of_day, count(*) AS events, count(DISTINCT "Mac") AS active_users,
  {rnd('avg("RealTimePlaying")', 1)} AS avg_watch_sec
FROM ({O.FACT_EV}) GROUP BY hour_of_day ORDER BY hour_of_day""")(
    lambda s, d: R.active_hours(fact_ev(s, d)))

register("watch_time_by_bucket", f"""
SELECT {_BUCKET} AS bucket, count(*) AS sessions,
  {rnd('avg("RealTimePlaying") / 60', 1)} AS avg_watch_min
FROM ({O.FACT_EV}) WHERE "AppName" = 'VOD' GROUP BY 1 ORDER BY 1""")(
    lambda s, d: R.watch_time_by_bucket(fact_ev(s, d)))

register("crashed_share", f"""
SELECT count(*) AS users, count(*) FILTER (WHERE last_event = 'STARTCHANNEL') AS crashed_users,
  {rnd("avg(CASE WHEN last_event = 'STARTCHANNEL' THEN 1 ELSE 0 END)", 4)} AS crashed_share
FROM ({_LATEST})""")(lambda s, d: R.crashed_share(fact_ev(s, d)))

register("completion_by_entry", f"""
SELECT "Screen", count(*) AS sessions, {rnd(O.exact_avg('completion_rate', 4), 4)} AS avg_completion,
  {rnd('avg(CASE WHEN "RealTimePlaying" < 120 THEN 1 ELSE 0 END)', 4)} AS short_play_share
FROM ({O.FACT_EV}) WHERE "AppName" = 'VOD' GROUP BY "Screen" ORDER BY "Screen" """)(
    lambda s, d: R.completion_by_entry(fact_ev(s, d)))

# --- multi-year reports and profiles (orders-based sessions) -----------------

_MAU = f"""
SELECT year, month, count(DISTINCT "Mac") AS active_users, count(*) AS total_events
FROM ({O.FACT_OR}) GROUP BY year, month"""

register("monthly_active_users", _MAU + " ORDER BY year, month")(
    lambda s, d: R.monthly_active_users(fact_or(s, d)))

register("mau_change", f"""
SELECT year, month, active_users, prev_active_users,
  active_users - prev_active_users AS change,
  {rnd('(active_users - prev_active_users) * 100.0 / prev_active_users', 2)} AS change_pct
FROM (SELECT year, month, active_users,
        lag(active_users) OVER (ORDER BY year, month) AS prev_active_users
      FROM ({_MAU})) ORDER BY year, month""")(lambda s, d: R.mau_change(fact_or(s, d)))

register("user_profiles", O.PROFILES_OR)(profiles_or)

def _profiles_via_summaries(s: SparkSession, d: str) -> DataFrame:
    f = fact_or(s, d)
    return A.profiles_from_summaries(A.user_day_summary(f), A.user_day_apps(f), A.user_day_items(f))


register("profiles_from_summaries", O.PROFILES_OR)(_profiles_via_summaries)

def _profiles_via_months(s: SparkSession, d: str) -> DataFrame:
    """The fact is written once; items are coded, and days merged into months with bitmaps."""
    path = work_path(s, "fact")
    S.write_parquet(fact_or(s, d), path)
    f = read_fact(s, path)
    items = A.user_day_items(f)
    codes = written(new_codes(items, s.createDataFrame([], "value string, code bigint"), "ItemId"), "item-codes")
    return A.profiles_from_months(A.user_month_summary(A.user_day_summary(f)), A.user_month_apps(A.user_day_apps(f)),
                                  A.user_month_items(items, codes))


register("profiles_from_months", O.PROFILES_OR)(_profiles_via_months)

register("dataset_end_date", f"SELECT max(session_date) AS dataset_end_date FROM ({O.FACT_OR})")(
    lambda s, d: A.dataset_end_date(fact_or(s, d)))

register("most_used_app", f"""
SELECT "Mac", "CustomerID", "Contract", most_used_app FROM ({O.PROFILES_OR})""")(
    lambda s, d: A.most_used_app(fact_or(s, d)))

register("user_recency", f"""
SELECT "Mac", "CustomerID", "Contract", first_active_date, last_active_date,
  days_inactive, days_since_first FROM ({O.PROFILES_OR})""")(
    lambda s, d: A.user_recency(profile_core_or(s, d)))

register("user_daily_watch", f"""
SELECT "Mac", "CustomerID", "Contract", total_watch_seconds, active_days,
  avg_daily_watch_seconds FROM ({O.PROFILES_OR})""")(
    lambda s, d: A.user_daily_watch(profile_core_or(s, d)))

register("churn_label", f"""
SELECT "Mac", "CustomerID", "Contract", days_inactive, churn_label FROM ({O.PROFILES_OR})""")(
    lambda s, d: A.churn_labels(profile_core_or(s, d)))

register("churn_analysis", f"""
SELECT churn_label, count(*) AS user_count,
  {rnd('avg(total_watch_seconds) / 3600', 1)} AS avg_watch_hours,
  {rnd('avg(active_days)', 1)} AS avg_active_days,
  {rnd('avg(unique_content_watched)', 1)} AS avg_content_variety,
  {rnd('avg(avg_completion_rate)', 3)} AS avg_completion,
  {rnd('avg(primetime_ratio)', 3)} AS avg_primetime_ratio
FROM ({O.PROFILES_OR}) GROUP BY churn_label ORDER BY churn_label""")(
    lambda s, d: R.churn_analysis(profile_core_or(s, d, items=True)))

register("cohort_retention", f"""
SELECT strftime(date_trunc('month', first_active_date), '%Y-%m') AS cohort,
  count(*) AS cohort_size, {rnd('avg(active_days)', 1)} AS avg_active_days,
  count(*) FILTER (WHERE active_days >= 7) AS retained_7d,
  count(*) FILTER (WHERE active_days >= 14) AS retained_14d,
  count(*) FILTER (WHERE active_days >= 30) AS retained_30d
FROM ({O.PROFILES_OR}) GROUP BY 1 ORDER BY 1""")(
    lambda s, d: R.cohort_retention(profile_core_or(s, d)))

register("session_rank", f"""
SELECT {O.cols(O.FACT_COLS)}, CAST(row_number() OVER (PARTITION BY "Mac"
    ORDER BY session_timestamp, "Event" NULLS FIRST, "ItemId" NULLS FIRST) AS INTEGER) AS session_rank
FROM ({O.FACT_OR})""")(lambda s, d: A.session_rank(fact_or(s, d)))

# --- ingest of dict-literal lines rendered from events -----------------------


def _ingest(s: SparkSession, d: str) -> DataFrame:
    return I.ingest_lines(load_raw_lines(s, d))


def _normalized(s: SparkSession, d: str) -> DataFrame:
    return I.parse_lines(load_raw_lines(s, d)).transform(I.keep_required).transform(I.normalize_columns)


register("parse_lines", f"SELECT * FROM ({O.LOGS_FROM_LINES})")(_ingest)
register("select_and_cast", f"SELECT * FROM ({O.LOGS_FROM_LINES})")(
    lambda s, d: I.select_and_cast(I.parse_session_timestamp(_normalized(s, d))))
register("normalize_columns", f"SELECT {O.cols(O.KEEP)} FROM ({O.INGEST_STRINGS})")(_normalized)
register("parse_session_timestamp", f"""
SELECT "Mac", "SessionMainMenu", session_timestamp FROM ({O.LOGS_FROM_LINES})""")(
    lambda s, d: I.parse_session_timestamp(_normalized(s, d)).select(
        "Mac", "SessionMainMenu", "session_timestamp"))
register("discover_columns", O.DISCOVERED)(lambda s, d: I.discover_columns(load_raw_lines(s, d)))
register("ingest_counts", O.INGEST_COUNTS)(lambda s, d: I.ingest_counts(load_raw_lines(s, d)))
register("null_counts", f"""
SELECT count(*) FILTER (WHERE "Mac" IS NULL) AS "Mac",
  count(*) FILTER (WHERE session_timestamp IS NULL) AS session_timestamp,
  count(*) FILTER (WHERE "RealTimePlaying" IS NULL) AS "RealTimePlaying",
  count(*) FILTER (WHERE "Event" IS NULL) AS "Event"
FROM ({O.LOGS_FROM_LINES})""")(lambda s, d: I.null_counts(_ingest(s, d)))

# --- sources, sinks, load, quality, streaming ---------------------------------
# These write intermediate files under the shared checkpoint folder
# (spark.checkpoint.dir), each query into a fresh location.


def _written_lines(s: SparkSession, d: str) -> str:
    path = work_path(s, "raw-lines")
    load_raw_lines(s, d).write.mode("overwrite").text(path)
    return path


def _text_scan(s: SparkSession, d: str) -> DataFrame:
    return I.ingest_lines(read_text_logs(s, _written_lines(s, d), glob="part-*"))


def _roundtrip_partitioned(s: SparkSession, d: str) -> DataFrame:
    path = S.write_partitioned(_ingest(s, d), work_path(s, "logs-clean"), "AppName")
    return read_logs_clean(s, path)


def _roundtrip_fact(s: SparkSession, d: str) -> DataFrame:
    path = work_path(s, "fact")
    S.write_parquet(fact_ev(s, d), path)
    return s.read.parquet(path)


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def _load_table(s: SparkSession, d: str) -> DataFrame:
    name = _table_name("fact_sessions")
    S.save_table(fact_ev(s, d), name, path=work_path(s, "table"))
    return s.table(name)


def _load_verify(s: SparkSession, d: str) -> DataFrame:
    """As in the pipeline: load from the written fact, verify against its files."""
    path = work_path(s, "fact")
    S.write_parquet(fact_ev(s, d), path)
    written = s.read.parquet(path)
    name = _table_name("fact_sessions")
    S.save_table(written, name, path=work_path(s, "table"))
    return S.verify_load(s, name, written).withColumn("table_name", F.lit("fact_sessions"))


def _incremental(s: SparkSession, d: str) -> DataFrame:
    raw = _written_lines(s, d)
    out, ckpt = work_path(s, "stream-out"), work_path(s, "stream-ckpt")
    ingest_new_files(s, raw, out, ckpt, glob="part-*")
    return read_logs_clean(s, out)


def _incremental_fact(s: SparkSession, d: str) -> DataFrame:
    """Streaming ingest of the log files, then the incremental fact refresh."""
    raw = _written_lines(s, d)
    logs, fact = work_path(s, "stream-logs"), work_path(s, "stream-fact")
    ingest_new_files(s, raw, logs, work_path(s, "ck-ingest"), glob="part-*")
    refresh_fact(s, logs, fact, work_path(s, "ck-fact"))
    return read_fact(s, fact)


def _rejected(s: SparkSession, d: str) -> DataFrame:
    """As in the pipeline: log files are parsed once, accepted rows and rejected lines written; counted per reason."""
    logs, rejected = work_path(s, "logs-clean"), work_path(s, "rejected")
    S.write_judged(I.ingest_judged(read_text_logs(s, _written_lines(s, d), glob="part-*")), logs, rejected)
    return I.reject_counts(S.read_rejected(s, rejected))


def _source_changes(s: SparkSession, d: str) -> DataFrame:
    """Two deliveries of text files, a folder per event date, compared by their ledgers.

    The second lacks the first date, has the last, and lacks every tenth event
    of odd days; a date's files count as one source.
    """
    events = read_table(s, d, "events").select(F.to_date("ts").alias("day"), "event_id", F.to_json(F.struct("event_id", "event_type", "value")).alias("value"))
    first, last = events.select(F.min("day")).scalar(), events.select(F.max("day")).scalar()
    kept = (F.col("day") > first) & ((F.dayofmonth("day") % 2 == 0) | (F.col("event_id") % 10 != 0))
    ledgers = []
    for name, part in (("before", events.where(F.col("day") < last)), ("after", events.where(kept))):
        path = work_path(s, f"delivery-{name}")
        part.select("day", "value").write.partitionBy("day").text(path)
        source = F.regexp_extract(F.col("_metadata.file_path"), "day=([^/]*)/", 1)
        ledgers.append(written(line_digests(s.read.text(path), source), "ledger"))
    return source_changes(ledgers[1], ledgers[0])


register("source_changes", O.SOURCE_CHANGES)(_source_changes)
register("rejected_lines", O.REJECTED)(_rejected)
register("text_scan", f"SELECT * FROM ({O.LOGS_FROM_LINES})")(_text_scan)
register("transform_lines", O.FACT_FROM_LINES)(lambda s, d: build_fact(_ingest(s, d)))
register("incremental_fact", O.FACT_FROM_LINES)(_incremental_fact)
register("roundtrip_partitioned", f"SELECT * FROM ({O.LOGS_FROM_LINES})")(_roundtrip_partitioned)
register("roundtrip_fact", O.FACT_EV)(_roundtrip_fact)
register("load_table", O.FACT_EV)(_load_table)
register("load_verify", f"""
SELECT 'fact_sessions' AS table_name, count(*) AS source_rows, count(*) AS loaded_rows,
  true AS matches FROM ({O.FACT_EV})""")(_load_verify)
register("incremental_ingest", f"SELECT * FROM ({O.LOGS_FROM_LINES})")(_incremental)
register("quality_report", f"""
WITH f AS ({O.FACT_EV}),
r AS (
  SELECT count(*) AS fact_rows, (SELECT count(*) FROM ({O.PROFILES_EV})) AS profile_rows,
    (SELECT count(*) FILTER (WHERE churn_label = 1) FROM ({O.PROFILES_EV})) AS churned_users,
    count(*) FILTER (WHERE "Mac" IS NULL) AS null_mac,
    CASE WHEN count(*) > 0 THEN {O.rnd('count(*) FILTER (WHERE "Mac" IS NULL) * 100.0 / count(*)', 2)}
         ELSE 0.0 END AS null_mac_pct,
    min(session_date) AS min_date, max(session_date) AS max_date
  FROM f)
SELECT *,
  CASE WHEN fact_rows = 0 THEN 'FAIL' ELSE 'OK' END AS row_count_status,
  CASE WHEN null_mac_pct > 5 THEN 'WARN' ELSE 'OK' END AS null_mac_status,
  CASE WHEN fact_rows = 0 THEN 'FAIL' WHEN null_mac_pct > 5 THEN 'WARN' ELSE 'OK' END AS status
FROM r""")(lambda s, d: _quality(s, d))


def _quality(s: SparkSession, d: str) -> DataFrame:
    """As in the pipeline: the report and the profiles read the written fact table."""
    path = S.write_partitioned(fact_ev(s, d), work_path(s, "fact"), "AppName")
    fact = read_fact(s, path)
    return quality_report(fact, A.profile_core(fact, items=False, apps=False))


#: Files that the rendered log lines are written to for the two queries below.
LOG_FILES = 7


def _log_folder(s: SparkSession, d: str) -> str:
    path = work_path(s, "log-files")
    # By the line itself: a round robin would sort every line first.
    load_raw_lines(s, d).repartition(LOG_FILES, "value").write.text(path)
    return path


def _run_summary(s: SparkSession, d: str) -> DataFrame:
    """Whole pipeline over rendered log files; steps and rows of the run log it appended."""
    from viewlog.plans.pipeline import run

    out = work_path(s, "pipeline-out")
    prefix = "run_" + out.rsplit("-", 1)[-1] + "_"
    run(s, _log_folder(s, d), out, glob="part-*", table_prefix=prefix)
    return s.read.parquet(f"{out}/run_log.parquet").select("step", "rows")


register("source_check", f"SELECT {LOG_FILES} AS files, true AS has_files")(
    lambda s, d: source_check(s, _log_folder(s, d), glob="part-*").select("files", "has_files"))
# Step timings differ on every run; the rows of each step do not.
register("run_summary", f"""
WITH f AS ({O.FACT_FROM_LINES}), n AS (SELECT count(*) AS facts FROM f),
u AS (SELECT count(*) AS users FROM (SELECT DISTINCT "Mac", "CustomerID", "Contract" FROM f))
SELECT 'check' AS step, CAST({LOG_FILES} AS BIGINT) AS "rows"
UNION ALL SELECT 'ingest', count(*) FROM ({O.LOGS_FROM_LINES})
UNION ALL SELECT 'transform', facts FROM n
UNION ALL SELECT 'load', facts + users FROM n, u
UNION ALL SELECT 'quality', NULL
UNION ALL SELECT 'reports', 15""")(_run_summary)
