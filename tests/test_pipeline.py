"""End-to-end pipeline over log files, quality gate, sinks, streaming."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from viewlog.operators.quality import QualityError, gate, quality_report
from viewlog.plans.pipeline import run
from viewlog.schema import LOAD_BATCH_ROWS
from viewlog.sources.sinks import jdbc_options, write_partitioned
from viewlog.sources.tables import load_raw_lines, read_logs_clean
from viewlog.sources.text import read_text_logs, source_check
from viewlog.streaming.incremental import ingest_new_files


def write_logs(spark, path, name="logt0001.txt"):
    os.makedirs(path, exist_ok=True)
    lines = [r["value"] for r in load_raw_lines(spark, SF_SMALL).collect()]
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    return len(lines)


def test_full_run(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    write_logs(spark, raw)
    res = run(spark, raw, out, table_prefix="t_full_")
    assert not res.skipped
    assert [s for s, _, _ in res.steps] == ["check", "ingest", "transform", "load", "quality", "reports"]
    assert res.quality["status"] == "OK" and res.quality["fact_rows"] > 0
    fact = spark.read.parquet(f"{out}/fact_sessions.parquet")
    assert spark.table("t_full_fact_sessions").count() == fact.count()
    assert spark.table("t_full_user_profiles").count() == res.quality["profile_rows"]
    # The pipeline's summary-based profiles equal the direct computation.
    from viewlog.operators.profiles import user_profiles
    from viewlog.sources.tables import read_fact

    direct = user_profiles(read_fact(spark, f"{out}/fact_sessions.parquet"))
    written = spark.read.parquet(f"{out}/user_profiles.parquet")
    assert direct.exceptAll(written).count() == 0 and written.exceptAll(direct).count() == 0
    log = spark.read.parquet(f"{out}/run_log.parquet")
    assert log.count() == 6
    dau = spark.read.parquet(f"{out}/reports/daily_active_users.parquet")
    assert dau.agg(F.sum("total_events")).first()[0] == fact.count()
    assert spark.read.parquet(f"{out}/reports/cohort_retention.parquet").agg(
        F.sum("cohort_size")).first()[0] == res.quality["profile_rows"]
    # The fact table is partitioned by the normalised app name.
    assert {r["AppName"] for r in fact.select("AppName").distinct().collect()} <= {"VOD", "IPTV", None}


def test_no_files_skips(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw")
    res = run(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out")
    assert res.skipped and [s for s, _, _ in res.steps] == ["check"]
    with pytest.raises(FileNotFoundError):
        read_text_logs(spark, f"{tmp_dir}/raw")


def test_source_check_counts_files(spark, tmp_dir):
    write_logs(spark, tmp_dir, "logt0001.txt")
    write_logs(spark, tmp_dir, "logt0002.txt")
    write_logs(spark, tmp_dir, "other.txt")
    r = source_check(spark, tmp_dir).first()
    assert r["files"] == 2 and r["has_files"] and r["total_mb"] > 0
    from viewlog.sources.text import list_sources
    from viewlog.operators.quality import preview

    assert [x["file"] for x in list_sources(spark, tmp_dir).collect()] == ["logt0001.txt", "logt0002.txt"]
    assert preview(read_text_logs(spark, tmp_dir), 3).count() == 3


def test_gate_fails_on_empty_fact(spark):
    empty = spark.createDataFrame([], "Mac string, session_date date")
    rep = quality_report(empty, empty)
    assert rep.first()["status"] == "FAIL"
    with pytest.raises(QualityError):
        gate(rep)
    warn = spark.createDataFrame([(None, None), ("m", None)], "Mac string, session_date date")
    assert gate(quality_report(warn, warn))["status"] == "WARN"


def test_partition_values_stay_strings(spark, tmp_dir):
    df = spark.createDataFrame([("m1", "02"), ("m2", ""), ("m3", None)], "Mac string, AppName string")
    full = df.select(*[F.lit(None).cast("string").alias(c) if c not in ("Mac", "AppName") else F.col(c)
                       for c in ["Mac", "CustomerID", "Contract", "Session", "SessionMainMenu", "AppName",
                                 "Event", "ItemId", "ItemName"]],
                     F.lit(None).cast("float").alias("RealTimePlaying"),
                     F.lit(None).cast("bigint").alias("ElapsedTimePlaying"),
                     F.lit(None).cast("bigint").alias("Duration"),
                     *[F.lit(None).cast("string").alias(c) for c in ["Screen", "Firmware", "PublishCountry"]],
                     F.lit(None).cast("timestamp_ntz").alias("session_timestamp"))
    write_partitioned(full, f"{tmp_dir}/lc", "AppName")
    got = {r["Mac"]: r["AppName"] for r in read_logs_clean(spark, f"{tmp_dir}/lc").collect()}
    assert got == {"m1": "02", "m2": None, "m3": None}


def test_jdbc_options():
    o = jdbc_options("jdbc:postgresql://db:5432/x", "fact_sessions", user="u", password="p")
    assert o["batchsize"] == str(LOAD_BATCH_ROWS) and o["dbtable"] == "fact_sessions"
    assert o["truncate"] == "true" and o["user"] == "u"


def test_incremental_ingest_only_new_files(spark, tmp_dir):
    raw, out, ckpt = f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    n1 = write_logs(spark, raw, "logt0001.txt")
    ingest_new_files(spark, raw, out, ckpt)
    first = read_logs_clean(spark, out).count()
    ingest_new_files(spark, raw, out, ckpt)  # nothing new
    assert read_logs_clean(spark, out).count() == first
    write_logs(spark, raw, "logt0002.txt")
    ingest_new_files(spark, raw, out, ckpt)
    assert read_logs_clean(spark, out).count() == 2 * first
    assert first <= n1


def test_shuffle_sizing():
    from viewlog.session import shuffle_partitions_for

    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(10 * 1024**3) == 80
    assert shuffle_partitions_for(100 * 1024**4) == 819_200  # no ceiling


def test_fact_reads_back_with_string_app(spark, tmp_dir):
    from viewlog.operators.clean import clean
    from viewlog.operators.features import fact_sessions, session_features
    from viewlog.sources.tables import read_fact
    from viewlog.schema import FACT_SCHEMA

    df = spark.createDataFrame([("m", "02", "E", "1")], "Mac string, AppName string, Event string, ItemId string")
    logs = df.select("Mac", F.lit("c").alias("CustomerID"), F.lit("k").alias("Contract"),
                     F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("session_timestamp"),
                     "AppName", "Event", "ItemId", F.lit("n").alias("ItemName"),
                     F.lit(1.5).cast("float").alias("RealTimePlaying"),
                     F.lit(1).cast("bigint").alias("ElapsedTimePlaying"),
                     F.lit(10).cast("bigint").alias("Duration"),
                     F.lit("s").alias("Screen"), F.lit("f").alias("Firmware"), F.lit("p").alias("PublishCountry"))
    fact = logs.transform(clean).transform(session_features).transform(fact_sessions)
    write_partitioned(fact, f"{tmp_dir}/fact", "AppName")
    back = read_fact(spark, f"{tmp_dir}/fact")
    assert back.schema == FACT_SCHEMA
    assert back.first()["AppName"] == "02"


def test_jdbc_probe_fails_loudly(spark):
    from viewlog.sources.sinks import jdbc_probe

    # No database exists here: the probe must raise, never return quietly.
    with pytest.raises(Exception):
        jdbc_probe(spark, jdbc_options("jdbc:postgresql://127.0.0.1:1/none", "t", user="u", password="p"))


def test_incremental_ingest_restart_is_exactly_once(spark, tmp_dir):
    from viewlog.streaming.incremental import start_incremental_ingest

    raw, out, ckpt = f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    for i in range(3):
        write_logs(spark, raw, f"logt000{i}.txt")
    # First run: one file per micro-batch, stopped after the first batch.
    q = start_incremental_ingest(spark, raw, out, ckpt, max_files_per_batch=1,
                                 available_now=False, processing_time="1 second")
    import time

    deadline = time.time() + 60
    while time.time() < deadline and not q.recentProgress:
        time.sleep(0.2)
    q.stop()
    partial = read_logs_clean(spark, out).count()
    # Restart from the checkpoint: the rest is ingested, nothing twice.
    ingest_new_files(spark, raw, out, ckpt)
    from viewlog.operators.ingest import ingest_lines

    per_file = ingest_lines(read_text_logs(spark, raw, "logt0000.txt")).count()
    assert 0 < partial <= 3 * per_file
    assert read_logs_clean(spark, out).count() == 3 * per_file


def test_command_line_runs_chosen_steps(spark, tmp_dir, capsys):
    import json as _json

    from viewlog.__main__ import main

    write_logs(spark, f"{tmp_dir}/raw")
    assert main(["--raw", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/out",
                 "--steps", "check,ingest,transform"]) == 0
    steps = [_json.loads(x)["step"] for x in capsys.readouterr().out.strip().splitlines()]
    assert steps == ["check", "ingest", "transform"]
    with pytest.raises(SystemExit):
        main(["--raw", "x", "--out", "y", "--steps", "nope"])


def test_command_line_starts_from_any_folder(spark, tmp_dir):
    """A process of its own, in an empty folder, without the repository on its path."""
    import subprocess
    import sys

    import viewlog

    write_logs(spark, f"{tmp_dir}/raw")
    os.makedirs(f"{tmp_dir}/empty")
    script = os.path.join(os.path.dirname(viewlog.__file__), "__main__.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, script, "--raw", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/out", "--master", "local[2]"],
                          cwd=f"{tmp_dir}/empty", env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [x.split('"step": "')[1].split('"')[0] for x in done.stdout.splitlines() if '"step"' in x] == [
        "check", "ingest", "transform", "load", "quality", "reports"]


def test_jdbc_settings_from_environment_and_arguments():
    from viewlog.sources.sinks import jdbc_settings

    assert jdbc_settings({}) is None
    env = {"VIEWLOG_JDBC_URL": "jdbc:x://h/d", "VIEWLOG_JDBC_USER": "u", "VIEWLOG_JDBC_CONNECTIONS": "4"}
    got = jdbc_settings(env, user="other")
    assert got["url"] == "jdbc:x://h/d" and got["user"] == "other" and got["numPartitions"] == "4"


def test_run_log_is_written_when_the_gate_fails(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw")
    with open(f"{tmp_dir}/raw/logt0001.txt", "w") as f:
        f.write("not a literal\n")
    with pytest.raises(QualityError):
        run(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out", table_prefix="t_gate_")
    log = [r["step"] for r in spark.read.parquet(f"{tmp_dir}/out/run_log.parquet").collect()]
    assert sorted(log) == sorted(["check", "ingest", "transform", "load", "quality"])


def test_load_fails_on_missing_rows(spark, tmp_dir, monkeypatch):
    from viewlog.plans import pipeline as P

    write_logs(spark, f"{tmp_dir}/raw")
    run(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out", steps=("check", "ingest", "transform"))
    spark.range(3).write.saveAsTable("t_wrong")
    monkeypatch.setattr(P, "external_table", lambda *a: "t_wrong")
    with pytest.raises(P.LoadError):
        P.load_step(spark, P.Paths(f"{tmp_dir}/raw", f"{tmp_dir}/out"))


def test_subfolders_are_not_sources(spark, tmp_dir):
    write_logs(spark, f"{tmp_dir}/raw/below")
    assert source_check(spark, f"{tmp_dir}/raw").first()["files"] == 0


def test_incremental_fact_refresh_equals_full_build(spark, tmp_dir):
    from viewlog.plans.transform import build_fact
    from viewlog.sources.tables import read_fact
    from viewlog.streaming.incremental import refresh_fact

    raw, logs, fact = f"{tmp_dir}/raw", f"{tmp_dir}/logs", f"{tmp_dir}/fact"
    ck_in, ck_tr = f"{tmp_dir}/ck_in", f"{tmp_dir}/ck_tr"

    def full():
        return build_fact(read_logs_clean(spark, logs))

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    write_logs(spark, raw, "logt0001.txt")
    ingest_new_files(spark, raw, logs, ck_in)
    refresh_fact(spark, logs, fact, ck_tr)
    assert same(read_fact(spark, fact), full())
    # The same lines again (exact copies on the same dates) plus nothing new:
    # the touched dates are rebuilt and copies collapse.
    write_logs(spark, raw, "logt0002.txt")
    ingest_new_files(spark, raw, logs, ck_in)
    refresh_fact(spark, logs, fact, ck_tr)
    assert same(read_fact(spark, fact), full())
    n = read_fact(spark, fact).count()
    refresh_fact(spark, logs, fact, ck_tr)  # no new files: nothing changes
    assert read_fact(spark, fact).count() == n


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_run_matches_full_run(spark, tmp_dir):
    """Batch and incremental runs share an output folder and do not disturb each other."""
    from viewlog.plans.pipeline import run_incremental
    from viewlog.sources.tables import read_fact

    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    write_logs(spark, raw, "logt0001.txt")
    run(spark, raw, out, table_prefix="t_mix_")
    run_incremental(spark, raw, out, table_prefix="t_mix_", reports_too=False)
    write_logs(spark, raw, "logt0002.txt")
    full = run(spark, raw, out, table_prefix="t_mix_")
    inc = run_incremental(spark, raw, out, table_prefix="t_mix_", max_files_per_batch=1)
    assert inc.quality["status"] == full.quality["status"] == "OK"
    a, b = (read_fact(spark, f"{o}/fact_sessions.parquet") for o in (f"{out}/incremental", out))
    assert same_rows(a, b)
    pa, pb = (spark.read.parquet(f"{o}/user_profiles.parquet") for o in (f"{out}/incremental", out))
    assert same_rows(pa, pb)
    assert spark.table("t_mix_fact_sessions").count() == b.count()


@pytest.mark.parametrize("broken", ["refresh_fact", "write_parquet", "load_step", "quality_step"])
def test_incremental_run_recovers_after_any_step(spark, tmp_dir, monkeypatch, broken):
    from viewlog.plans import pipeline as P
    from viewlog.plans.transform import build_fact
    from viewlog.streaming import incremental as inc

    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    write_logs(spark, raw)

    def fails(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(inc if broken == "refresh_fact" else P, broken, fails)
        with pytest.raises(RuntimeError, match="lost"):
            P.run_incremental(spark, raw, out, table_prefix="t_rec_", reports_too=False)
    P.run_incremental(spark, raw, out, table_prefix="t_rec_", reports_too=False)
    from viewlog.operators.profiles import user_profiles
    from viewlog.sources.tables import read_fact

    p = f"{out}/incremental"
    fact = read_fact(spark, f"{p}/fact_sessions.parquet")
    assert same_rows(fact, build_fact(read_logs_clean(spark, f"{p}/logs_clean.parquet")))
    assert same_rows(spark.read.parquet(f"{p}/user_profiles.parquet"), user_profiles(fact))
    assert spark.table("t_rec_fact_sessions").count() == fact.count()


def test_incremental_refresh_rewrites_only_touched_dates(spark, tmp_dir):
    import glob
    import os as _os

    from viewlog.sources.tables import read_fact
    from viewlog.streaming.incremental import refresh_fact

    raw, logs, fact = f"{tmp_dir}/raw", f"{tmp_dir}/logs", f"{tmp_dir}/fact"
    write_logs(spark, raw, "logt0001.txt")
    ingest_new_files(spark, raw, logs, f"{tmp_dir}/ck_in")
    refresh_fact(spark, logs, fact, f"{tmp_dir}/ck_tr")

    def files_by_date():
        out = {}
        for part in glob.glob(f"{fact}/session_date=*"):
            out[part.rsplit("=", 1)[-1]] = sorted(
                (f, _os.path.getmtime(f)) for f in glob.glob(f"{part}/*.parquet"))
        return out

    before = files_by_date()
    day = sorted(before)[0]
    lines = [r["value"] for r in load_raw_lines(spark, SF_SMALL).collect()
             if f":{day.replace('-', ':')}:" in r["value"]]
    assert lines
    with open(f"{raw}/logt0002.txt", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    ingest_new_files(spark, raw, logs, f"{tmp_dir}/ck_in")
    refresh_fact(spark, logs, fact, f"{tmp_dir}/ck_tr")
    after = files_by_date()
    assert set(after) == set(before)
    assert after[day] != before[day]
    assert all(after[d] == before[d] for d in before if d != day)
    assert read_fact(spark, fact).where(F.col("session_date") == day).count() > 0


def test_sized_shuffles_per_run(spark):
    from viewlog.session import CLUSTER_CONF, INITIAL_PARTITIONS, sized_shuffles

    with sized_shuffles(spark, 1024**2) as n:
        assert n == int(spark.conf.get(INITIAL_PARTITIONS)) == 8
    with sized_shuffles(spark, 100 * 1024**4) as n:  # the second run of a session gets its own size
        assert n == int(spark.conf.get(INITIAL_PARTITIONS)) == 819_200
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    spark.conf.set(INITIAL_PARTITIONS, "123")
    try:
        with sized_shuffles(spark, 10 * 1024**4) as n:
            assert n is None and spark.conf.get(INITIAL_PARTITIONS) == "123"
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)
    assert all(isinstance(k, str) and isinstance(v, str) for k, v in CLUSTER_CONF.items())


def test_refresh_reads_only_the_dates_it_rebuilds(spark, tmp_dir):
    write_logs(spark, f"{tmp_dir}/raw")
    ingest_new_files(spark, f"{tmp_dir}/raw", f"{tmp_dir}/logs", f"{tmp_dir}/ck")
    plan = (spark.read.parquet(f"{tmp_dir}/logs").where("log_date between date'2024-01-01' and date'2024-01-02'")
            ._jdf.queryExecution().executedPlan().toString())
    assert "PartitionFilters: [isnotnull(log_date" in plan
