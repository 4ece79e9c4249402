"""The input ledger notices new, changed and removed files, and reads no unchanged one."""

from __future__ import annotations

import os

import pytest

from viewlog.sources import ledger as L


@pytest.fixture()
def raw(tmp_dir):
    os.makedirs(f"{tmp_dir}/raw")
    return f"{tmp_dir}/raw"


def put(raw, name, text, age=0):
    with open(f"{raw}/{name}", "w") as f:
        f.write(text)
    stamp = 1_700_000_000 + age
    os.utime(f"{raw}/{name}", (stamp, stamp))


def changes(spark, raw, path):
    """What changed since the ledger at ``path``, which then moves on."""
    last = L.read_ledger(spark, path)
    current = L.current_ledger(spark, raw, last)
    found = sorted(tuple(r) for r in L.source_changes(current, last).collect())
    L.write_ledger(current, path)
    return found


def test_changes_of_a_folder(spark, raw, tmp_dir):
    path = f"{tmp_dir}/ledger"
    put(raw, "logt1.txt", "a\nb\n")
    put(raw, "logt2.txt", "a\nb\nc\n")
    put(raw, "logt3.txt", "")
    put(raw, "other.txt", "x\n")
    assert changes(spark, raw, path) == [("logt1.txt", "new", None, 2), ("logt2.txt", "new", None, 3)]
    assert changes(spark, raw, path) == []
    put(raw, "logt1.txt", "a\nB\n", age=5)  # same length, other content
    put(raw, "logt2.txt", "a\nb\nc\n", age=5)  # touched only
    put(raw, "logt3.txt", "one\n", age=5)
    assert changes(spark, raw, path) == [("logt1.txt", "changed", 2, 2), ("logt3.txt", "new", None, 1)]
    put(raw, "logt1.txt", "a\n", age=9)  # shortened
    os.rename(f"{raw}/logt2.txt", f"{raw}/moved")
    assert changes(spark, raw, path) == [("logt1.txt", "changed", 2, 1), ("logt2.txt", "gone", 3, None)]


def test_unchanged_files_are_not_read(spark, raw, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/ledger"
    put(raw, "logt1.txt", "a\nb\n")
    put(raw, "logt2.txt", "c\n")
    changes(spark, raw, path)
    put(raw, "logt2.txt", "c\nd\n", age=1)
    read = []
    monkeypatch.setattr(L, "line_digests", lambda lines, file, f=L.line_digests: (read.extend(lines.inputFiles()), f(lines, file))[1])
    assert changes(spark, raw, path) == [("logt2.txt", "changed", 1, 2)]
    assert [os.path.basename(f) for f in read] == ["logt2.txt"]


def test_digest_tells_lines_apart_but_not_their_order(spark):
    from pyspark.sql import functions as F

    def digest(lines):
        df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)
        return tuple(L.line_digests(df, F.lit("f")).first())

    assert digest(["a", "b", "b"]) == digest(["b", "a", "b"])
    assert len({digest(x) for x in (["a", "b"], ["a", "b", "b"], ["a", "c"], ["ab"], ["a", "a", "b"])}) == 5


def test_incremental_run_fails_on_rewritten_and_skips_unchanged_files(spark, raw, tmp_dir):
    from viewlog.plans.pipeline import SourceChanged, run_incremental

    line = "{'Mac': '%s', 'SessionMainMenu': 'x:2024:01:0%d:10:00:00:000', 'Event': 'E', 'AppName': 'VOD'}\n"

    def go(**kwargs):
        return run_incremental(spark, raw, f"{tmp_dir}/out", table_prefix="t_ledger_", **kwargs)

    put(raw, "logt1.txt", line % ("a", 1))
    first = go()
    assert first.changes == {"new": 1} and not first.skipped
    again = go()
    assert again.skipped and [s for s, _, _ in again.steps] == ["check"]
    put(raw, "logt2.txt", line % ("b", 2))
    assert go().changes == {"new": 1}
    put(raw, "logt1.txt", line % ("c", 3), age=7)
    with pytest.raises(SourceChanged, match="logt1.txt"):
        go()
    assert go(accept_changed=True).changes == {"changed": 1}
    assert go().skipped
    assert {r.Mac for r in spark.read.parquet(f"{tmp_dir}/out/incremental/user_profiles.parquet").collect()} == {"a", "b"}
