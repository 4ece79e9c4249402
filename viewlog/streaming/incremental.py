"""Incremental ingest of new log files with Structured Streaming.

The original pipeline re-ingests its whole input folder on a daily schedule
after checking that files exist. Here the file source remembers which files
it has already processed (in the checkpoint), so a scheduled run with the
``availableNow`` trigger ingests exactly the files that arrived since the last
run, and the Parquet sink's commit log makes each batch exactly-once even if
executors (or the driver) fail mid-run.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from viewlog.operators.ingest import ingest_lines
from viewlog.schema import FACT_SCHEMA, LOGS_CLEAN_SCHEMA
from viewlog.session import work_path
from viewlog.sources.sinks import path_exists
from viewlog.sources.tables import read_fact
from viewlog.sources.text import LOG_GLOB


def start_incremental_ingest(spark: SparkSession, raw_dir: str, out_path: str, checkpoint: str,
                             glob: str = LOG_GLOB, max_files_per_batch: int | None = None,
                             available_now: bool = True,
                             processing_time: str | None = None) -> StreamingQuery:
    """Start the stream: text lines -> ``logs_clean`` rows -> Parquet, a folder per date.

    The folders are what lets the fact refresh open only the dates it rebuilds.
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    # An empty AppName reads back as NULL from the batch layout's folders; the same here.
    logs = (ingest_lines(reader.load(raw_dir)).withColumn("AppName", F.nullif("AppName", F.lit("")))
            .withColumn("log_date", F.to_date("session_timestamp")))
    writer = (logs.writeStream.format("parquet")
              .option("path", out_path)
              .option("checkpointLocation", checkpoint)
              .partitionBy("log_date")
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


@contextmanager
def _all_progress(spark: SparkSession):
    """Keep the progress of every batch, not only of the last hundred."""
    key = "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key)
    spark.conf.set(key, "1000000")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _finish(q: StreamingQuery) -> None:
    """Wait until the query has processed all there is; raises what ended it early."""
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise q.exception()


def ingest_new_files(spark: SparkSession, raw_dir: str, out_path: str, checkpoint: str,
                     glob: str = LOG_GLOB, max_files_per_batch: int | None = None) -> int:
    """Run one scheduled increment to completion; returns the lines read.

    Zero means no new files arrived since the previous run. With
    ``max_files_per_batch`` a large backlog is ingested in several batches, so
    that a failure repeats one of them only.
    """
    with _all_progress(spark):
        q = start_incremental_ingest(spark, raw_dir, out_path, checkpoint, glob, max_files_per_batch)
        _finish(q)
        return sum(int(p.get("numInputRows", 0)) for p in q.recentProgress)


# --- incremental fact refresh -------------------------------------------------
# Dedup keys include session_timestamp, so duplicates never span two dates:
# the fact rows of a date depend only on the log rows of that date. A batch of
# new log files therefore only needs the dates it touches rebuilt, from all
# log rows of those dates, and written over just those date partitions.


#: Parts of profiles, and the last events: per date, and merged per month.
DAY_SUMMARIES = ("user_day", "user_day_apps", "user_day_items", "user_day_last")
MONTH_SUMMARIES = ("user_month", "user_month_apps", "user_month_items")
LAST_EVENTS = "user_month_last"
#: Numbers of the items, which the item bitmaps of all months share.
ITEM_CODES, CODES_SCHEMA = "item_codes", "value string, code bigint"


def _summaries(fact: DataFrame, codes: DataFrame) -> dict[str, DataFrame]:
    """Every summary of a fact table, by name."""
    from viewlog.operators import profiles as A
    from viewlog.operators.reports import latest_event_per_day

    days = dict(zip(DAY_SUMMARIES, (f(fact) for f in (A.user_day_summary, A.user_day_apps, A.user_day_items, latest_event_per_day))))
    return {**days, **_month_summaries(days, codes)}


def _month_summaries(days: dict[str, DataFrame], codes: DataFrame) -> dict[str, DataFrame]:
    from viewlog.operators import profiles as A
    from viewlog.operators.reports import merge_latest

    return {"user_month": A.user_month_summary(days["user_day"]), "user_month_apps": A.user_month_apps(days["user_day_apps"]),
            "user_month_items": A.user_month_items(days["user_day_items"], codes),
            LAST_EVENTS: merge_latest(days["user_day_last"].withColumn("month", A.month_of()), ["Mac", "month"])}


def _read_summary(spark: SparkSession, summary_dir: str, name: str) -> DataFrame:
    """A summary with the schema that its definition gives, so that one without rows reads too."""
    schema = _summaries(spark.createDataFrame([], FACT_SCHEMA), spark.createDataFrame([], CODES_SCHEMA))[name].schema
    return spark.read.schema(schema).parquet(f"{summary_dir}/{name}")


def read_months(spark: SparkSession, summary_dir: str) -> list[DataFrame]:
    """The three per-month profile summaries."""
    return [_read_summary(spark, summary_dir, name) for name in MONTH_SUMMARIES]


def read_latest(spark: SparkSession, summary_dir: str) -> DataFrame:
    """Each user's last event from the monthly state: ``latest_event_per_user`` without the fact."""
    from viewlog.operators.reports import merge_latest

    return merge_latest(_read_summary(spark, summary_dir, LAST_EVENTS), ["Mac"])


def _write_folders(df: DataFrame, path: str, column: str, first_cols: tuple[str, ...]) -> None:
    """Overwrite the folders of ``column`` (a date, a month) that ``df`` has rows of.

    The rebalance gathers a folder's rows in few tasks, so that it gets few
    files, and splits one that is too large for a task.
    """
    (df.hint("rebalance", column).sortWithinPartitions(column, *first_cols)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(column).parquet(path))


def refresh_months(spark: SparkSession, summary_dir: str, touched: DataFrame) -> None:
    """Rebuild the per-month summaries of the months that the dates of ``touched`` (column ``d``) lie in.

    Only the user-days of those months are read. Items seen for the first time
    get the next free codes before their bitmaps are built; a run that is
    repeated finds them known. Rebuilt months get the same rows again.
    """
    from viewlog.operators import bitmaps

    months = touched.select(F.trunc("d", "month").alias("m")).distinct()
    lo, hi = months.agg(F.min("m"), F.last_day(F.max("m"))).first()

    def days(name: str) -> DataFrame:
        df = _read_summary(spark, summary_dir, name).where(F.col("session_date").between(F.lit(lo), F.lit(hi)))
        return df.join(months, F.trunc("session_date", "month") == F.col("m"), "left_semi")

    items, path = days("user_day_items"), f"{summary_dir}/{ITEM_CODES}"
    if not path_exists(spark, path):
        spark.createDataFrame([], CODES_SCHEMA).write.parquet(path)
    bitmaps.new_codes(items, spark.read.schema(CODES_SCHEMA).parquet(path), "ItemId").write.mode("append").parquet(path)
    codes = spark.read.schema(CODES_SCHEMA).parquet(path)
    read = {name: days(name) for name in DAY_SUMMARIES}
    for name, df in _month_summaries(read, codes).items():
        _write_folders(df, f"{summary_dir}/{name}", "month", ("Mac",))


def refresh_fact_dates(spark: SparkSession, logs_path: str, fact_path: str,
                       dates: DataFrame, summary_dir: str | None = None) -> int:
    """Rebuild the fact partitions of ``dates`` (column ``d``) from every log row of those dates.

    Idempotent: re-running it for the same dates rewrites the same partitions
    with the same rows (the dedup survivor is deterministic), so a retried
    micro-batch cannot duplicate data. Returns the number of dates rebuilt.
    """
    from viewlog.operators.clean import dedup_hashed
    from viewlog.plans.transform import build_fact

    path = work_path(spark, "touched-dates")
    dates.select("d").where("d is not null").distinct().write.parquet(path)
    touched = spark.read.schema("d date").parquet(path)
    lo, hi, n = touched.agg(F.min("d"), F.max("d"), F.count("*")).first()
    if not n:
        return 0
    # The range prunes date folders at planning time; the join leaves exactly the touched dates.
    logs = spark.read.schema(T.StructType([*LOGS_CLEAN_SCHEMA, T.StructField("log_date", T.DateType())])).parquet(logs_path)
    logs = logs.where(F.col("log_date").between(F.lit(lo), F.lit(hi)))
    logs = logs.join(touched, F.col("log_date") == F.col("d"), "left_semi").drop("log_date")
    _write_folders(build_fact(logs, dedup_hashed), fact_path, "session_date", ("AppName", "session_timestamp"))
    if summary_dir:
        # Per-day profile parts of the same dates, from the partitions just written.
        fact = read_fact(spark, fact_path).where(F.col("session_date").between(F.lit(lo), F.lit(hi)))
        fact = fact.join(touched, F.col("session_date") == F.col("d"), "left_semi")
        parts = _summaries(fact, spark.createDataFrame([], CODES_SCHEMA))
        for name in DAY_SUMMARIES:
            _write_folders(parts[name], f"{summary_dir}/{name}", "session_date", ("Mac",))
        refresh_months(spark, summary_dir, touched)
    return n


def start_incremental_transform(spark: SparkSession, logs_path: str, fact_path: str,
                                checkpoint: str, available_now: bool = True,
                                processing_time: str | None = None,
                                summary_dir: str | None = None) -> StreamingQuery:
    """Stream over new ``logs_clean`` files; rebuild the fact dates they touch.

    The file source reads the ingest sink's commit log, so each new file is
    seen once. The dates of a batch stay a table; only their range and number
    reach the driver.
    """
    def refresh(batch, batch_id):  # noqa: ARG001 - batch_id: writes are idempotent
        refresh_fact_dates(spark, logs_path, fact_path, batch.select(F.to_date("session_timestamp").alias("d")), summary_dir)

    stream = spark.readStream.schema(LOGS_CLEAN_SCHEMA).parquet(logs_path)
    writer = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def refresh_fact(spark: SparkSession, logs_path: str, fact_path: str, checkpoint: str,
                 summary_dir: str | None = None) -> int:
    """Run one scheduled incremental fact refresh to completion; returns batches.

    With ``summary_dir`` the profile summaries of the touched dates and of their
    months are refreshed too (see ``operators.profiles.profiles_from_months``).
    """
    with _all_progress(spark):
        q = start_incremental_transform(spark, logs_path, fact_path, checkpoint, summary_dir=summary_dir)
        _finish(q)
        return len(q.recentProgress)
