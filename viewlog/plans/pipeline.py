"""The batch pipeline: check -> ingest -> transform -> load -> quality -> reports.

Each step reads what the previous step wrote, so every plan runs once: the
fact table is written, then profiles and reports read the written files
(the two outputs always agree, and lineage stays short). Counts come from
``Observation`` metrics of the writing job or from Parquet footers.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from viewlog.operators import cube, reports
from viewlog.operators.clean import clean_observed
from viewlog.operators.features import fact_sessions, session_features
from viewlog.operators.ingest import ingest_judged
from viewlog.operators.profiles import (profiles_from_months, profiles_from_summaries, user_day_apps,
                                         user_day_items, user_day_summary)
from viewlog.operators.quality import gate, quality_report
from viewlog.session import sized_shuffles, written
from viewlog.sources.ledger import current_ledger, read_ledger, source_changes, write_ledger
from viewlog.sources.sinks import (external_table, jdbc_count, jdbc_probe, path_exists, write_jdbc,
                                   write_judged, write_parquet, write_partitioned)
from viewlog.sources.tables import read_fact, read_logs_clean
from viewlog.sources.text import LOG_GLOB, read_text_logs, source_check

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("rows", T.LongType()),
    T.StructField("finished_at", T.TimestampType()),
])


@dataclass
class Paths:
    raw: str
    out: str
    glob: str = LOG_GLOB
    fact_folders: str = "AppName"  # the fact's partition column

    @property
    def logs_clean(self) -> str:
        return f"{self.out}/logs_clean.parquet"

    @property
    def rejected(self) -> str:
        return f"{self.out}/rejected_lines.parquet"

    @property
    def fact(self) -> str:
        return f"{self.out}/fact_sessions.parquet"

    @property
    def profiles(self) -> str:
        return f"{self.out}/user_profiles.parquet"

    @property
    def cube(self) -> str:
        return f"{self.out}/reports/activity_cube.parquet"

    @property
    def ledger(self) -> str:
        return f"{self.out}/input_ledger.parquet"

    @property
    def run_log(self) -> str:
        return f"{self.out}/run_log.parquet"


@dataclass
class RunResult:
    run_id: str
    steps: list[tuple[str, float, int | None]] = field(default_factory=list)
    quality: dict | None = None
    skipped: bool = False
    changes: dict[str, int] = field(default_factory=dict)  # source files by status: new, changed, gone


class SourceChanged(RuntimeError):
    """Files that earlier runs have ingested hold other lines now."""


def check_step(spark: SparkSession, p: Paths) -> int:
    """Number of matching source files (0 means: nothing to do)."""
    return int(source_check(spark, p.raw, p.glob).first()["files"])


class LoadError(RuntimeError):
    """A loaded table does not have the rows of its source."""


def ingest_step(spark: SparkSession, p: Paths) -> int:
    """One parse writes the accepted rows and, with their reasons, the rejected lines."""
    return write_judged(ingest_judged(read_text_logs(spark, p.raw, p.glob)), p.logs_clean, p.rejected)["accepted"]


def profiles_of(fact: DataFrame) -> DataFrame:
    """Profiles of a written (cheap to re-read) fact table, via per-day summaries.

    Same rows as ``user_profiles(fact)``: three narrow hash aggregates at
    (user, date) grain. Re-reading the fact three times is cheap only because it is a pruned file
    scan, so library callers with an expensive input plan keep using
    ``user_profiles``.
    """
    return profiles_from_summaries(user_day_summary(fact), user_day_apps(fact),
                                   user_day_items(fact))


def transform_step(spark: SparkSession, p: Paths) -> tuple[int, int, int]:
    """Returns (rows read, fact rows, profile rows)."""
    logs = read_logs_clean(spark, p.logs_clean)
    cleaned, after = clean_observed(logs)
    fact = cleaned.transform(session_features).transform(fact_sessions)
    write_partitioned(fact, p.fact, "AppName")
    fact_rows = int(after.get["rows"])
    # Profiles read the written fact table, so both outputs describe the same rows.
    profile_rows = write_parquet(profiles_of(read_fact(spark, p.fact)), p.profiles)
    return logs.count(), fact_rows, profile_rows


def load_step(spark: SparkSession, p: Paths, table_prefix: str = "",
              jdbc: dict[str, str] | None = None) -> int:
    """Load both outputs; returns rows found in the targets, which must be those of the outputs.

    Default: external catalog tables over the written files, without a copy.
    With ``jdbc`` options (see ``jdbc_options``) the database is probed first,
    then each table is written by all tasks in parallel, in batches, and
    counted by the database.
    """
    if jdbc is not None:
        jdbc_probe(spark, jdbc)
    n = 0
    for name, path, df, folders in (("fact_sessions", p.fact, read_fact(spark, p.fact), p.fact_folders),
                                    ("user_profiles", p.profiles, spark.read.parquet(p.profiles), None)):
        table = f"{table_prefix}{name}"
        if jdbc is not None:
            target = {**jdbc, "dbtable": table}
            write_jdbc(df, target)
            loaded = jdbc_count(spark, target)
        else:
            loaded = spark.table(external_table(spark, table, df, path, folders)).count()
        expected = df.count()  # from the files' footers
        if loaded != expected:
            raise LoadError(f"{table} has {loaded} rows, its source {expected}")
        n += loaded
    return n


def quality_step(spark: SparkSession, p: Paths) -> dict:
    return gate(quality_report(read_fact(spark, p.fact), spark.read.parquet(p.profiles)))


FACT_REPORTS = ("daily_active_users", "top_content", "activity_heatmap", "app_usage",
                "completion_buckets", "last_action", "monthly_active_users", "events_by_app",
                "active_hours", "watch_time_by_bucket", "crashed_share", "completion_by_entry",
                "mau_change")
PROFILE_REPORTS = ("churn_analysis", "cohort_retention")
#: Reports on each user's last event, from the state that incremental runs keep.
LATEST_REPORTS = {"last_action": reports.last_action_of, "crashed_share": reports.crashed_share_of}


def report_step(spark: SparkSession, p: Paths, parallel: int = 4, latest: DataFrame | None = None) -> int:
    """Write every report, computed from the written fact table and profiles.

    The reports that ``operators.cube`` answers share one scan: the cube is
    written first and they read it. Reading the AppName-partitioned fact lets
    the VOD reports prune to one folder; each is one aggregate job over pruned
    columns. The jobs are independent, so up to ``parallel`` of them run at once
    in the same session, keeping the cluster busy while small stages finish.
    Each has a scheduler pool of its own, so under FAIR scheduling none waits
    for another. With ``latest`` (a row per user) the reports on last events
    read that instead of the fact.
    """
    from concurrent.futures import ThreadPoolExecutor

    fact, profiles = read_fact(spark, p.fact), spark.read.parquet(p.profiles)
    write_parquet(cube.activity_cube(fact), p.cube)
    shared = spark.read.parquet(p.cube)

    def one(name: str) -> int:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"report-{name}")
        if name in cube.REPORTS:
            report = cube.REPORTS[name](shared)
        elif latest is not None and name in LATEST_REPORTS:
            report = LATEST_REPORTS[name](latest)
        else:
            report = getattr(reports, name)(fact if name in FACT_REPORTS else profiles)
        return write_parquet(report, f"{p.out}/reports/{name}.parquet")

    names = FACT_REPORTS + PROFILE_REPORTS
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(one, names))  # re-raises the first failure
    return len(names)


def run_summary(spark: SparkSession, result: RunResult) -> DataFrame:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(result.run_id, s, float(sec), n, now) for s, sec, n in result.steps]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


class _Run:
    """Times the steps of a run; the log is written however the run ends."""

    def __init__(self, spark: SparkSession, paths: Paths) -> None:
        self.spark, self.paths = spark, paths
        self.result = RunResult(run_id=datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f"))

    def __enter__(self) -> _Run:
        return self

    def __call__(self, name: str, fn):
        t0 = time.perf_counter()
        out = None
        try:
            out = fn()
        finally:  # a step that fails is logged too, without rows
            rows = out if isinstance(out, int) else (out[1] if isinstance(out, tuple) else None)
            self.result.steps.append((name, time.perf_counter() - t0, rows))
        return out

    def __exit__(self, *exc) -> None:
        if not self.result.skipped:
            run_summary(self.spark, self.result).write.mode("append").parquet(self.paths.run_log)


def run(spark: SparkSession, raw_dir: str, out_dir: str, glob: str = LOG_GLOB,
        steps: tuple[str, ...] = ("check", "ingest", "transform", "load", "quality", "reports"),
        table_prefix: str = "", jdbc: dict[str, str] | None = None) -> RunResult:
    """Batch run over the whole folder; every output is replaced. Shuffles are sized by the input."""
    p = Paths(raw_dir.rstrip("/"), out_dir.rstrip("/"), glob)
    size = int(source_check(spark, p.raw, p.glob).first()["total_mb"] * 1024 * 1024)
    with sized_shuffles(spark, size), _Run(spark, p) as step:
        result = step.result
        if "check" in steps and step("check", lambda: check_step(spark, p)) == 0:
            result.skipped = True
            return result
        if "ingest" in steps:
            step("ingest", lambda: ingest_step(spark, p))
        if "transform" in steps:
            step("transform", lambda: transform_step(spark, p))
        if "load" in steps:
            step("load", lambda: load_step(spark, p, table_prefix, jdbc=jdbc))
        if "quality" in steps:
            result.quality = step("quality", lambda: quality_step(spark, p))
        if "reports" in steps:
            step("reports", lambda: report_step(spark, p))
    return result


def run_incremental(spark: SparkSession, raw_dir: str, out_dir: str, glob: str = LOG_GLOB,
                    table_prefix: str = "", reports_too: bool = True, jdbc: dict[str, str] | None = None,
                    max_files_per_batch: int | None = None, accept_changed: bool = False, skip_unchanged: bool = True) -> RunResult:
    """Scheduled incremental run: new files -> touched fact dates -> profiles.

    Its files lie in ``out_dir/incremental``, apart from a batch run's. Ingest
    and the fact refresh are streaming queries with checkpoints, so each run
    processes what no earlier run has finished: new files, and the rest of a
    run that failed. The fact and three per-day profile summaries are
    partitioned by ``session_date`` and rebuilt only for touched dates, three
    per-month summaries only for the months of those dates.
    Profiles, tables and reports follow in every run that has something to do,
    so a failure in one of them is made good by the next.

    A ledger of the source files is published when a run has done all its
    steps. If the files are those of the ledger, the next run ends after the
    check (``skip_unchanged``). A file whose lines have changed since would
    never be read again by the stream: the run fails, naming such files, unless
    ``accept_changed``; a batch ``run`` reads everything anew. Files that are gone
    are counted only, as logs are rotated away.
    """
    from viewlog.streaming.incremental import ingest_new_files, read_latest, read_months, refresh_fact

    p = Paths(raw_dir.rstrip("/"), f"{out_dir.rstrip('/')}/incremental", glob, "session_date")
    ckpt, summaries = f"{p.out}/_checkpoints", f"{p.out}/profile_parts"
    with _Run(spark, p) as step:
        result = step.result
        if step("check", lambda: check_step(spark, p)) == 0:
            result.skipped = True
            return result
        last = read_ledger(spark, p.ledger)
        current = written(current_ledger(spark, p.raw, last, p.glob), "ledger")
        changes = written(source_changes(current, last), "source-changes")
        result.changes = {r.status: r["count"] for r in changes.groupBy("status").count().collect()}
        if result.changes.get("changed") and not accept_changed:
            names = [r.file for r in changes.where("status = 'changed'").orderBy("file").limit(10).collect()]
            raise SourceChanged(f"{result.changes['changed']} ingested files have changed: {', '.join(names)}")
        if skip_unchanged and not result.changes and path_exists(spark, p.ledger):
            result.skipped = True
            return result
        step("ingest", lambda: ingest_new_files(spark, p.raw, p.logs_clean, f"{ckpt}/ingest", p.glob, max_files_per_batch))
        step("transform", lambda: refresh_fact(spark, p.logs_clean, p.fact, f"{ckpt}/fact", summary_dir=summaries))
        # Profiles from the per-month summaries, not from events or user-days.
        step("profiles", lambda: write_parquet(profiles_from_months(*read_months(spark, summaries)), p.profiles))
        step("load", lambda: load_step(spark, p, table_prefix, jdbc))
        result.quality = step("quality", lambda: quality_step(spark, p))
        if reports_too:
            step("reports", lambda: report_step(spark, p, latest=read_latest(spark, summaries)))
            write_ledger(current, p.ledger)
    return result
