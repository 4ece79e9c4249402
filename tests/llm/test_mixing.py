from __future__ import annotations

import re
from collections import defaultdict

from tests.llm import data
from viewlog.llm import mixing as M


def targets(sizes: dict, weights: dict, passes: int = 3) -> dict:
    total, full, open_ = sum(sizes.values()), {}, set(sizes)
    while True:
        share = {s: (total - sum(full.values())) * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > passes * sizes[s]}
        if not over:
            return share | full
        full |= {s: passes * sizes[s] for s in over}
        open_ -= over


def test_targets_and_taken(spark):
    rows = data.rows() + [(1000 + i, "few words", "en", "tiny", 0, *"abcdefg") for i in range(3)]
    found = M.mix(data.docs(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    source = {r[0]: r[3] for r in rows if r[0] is not None}
    taken = defaultdict(int)
    for r in found:
        assert 0 <= r.taken <= 3 * r.size
        if r.doc_id is not None:
            s = source[r.doc_id]
            assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
            taken[s] += r.taken
        else:
            taken["src1" if r.size else None] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * M.BLOCK, s
    again = M.mix(data.docs(spark, rows[::-1]))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, found))


def test_apportionment_is_sainte_lague(spark):
    shares = [1, 53, 24, 23, 7, 7, 310, 2]
    for seats in (0, 1, 3, 10, 57, 1000):
        wins = [0] * len(shares)
        for _ in range(seats):
            best = max(range(len(shares)), key=lambda i: (shares[i] / (wins[i] + 0.5), -i))
            wins[best] += 1
        rows = spark.createDataFrame([(0, i, float(s), seats) for i, s in enumerate(shares)], "g int, i int, share double, seats long")
        assert [r.won for r in M.apportion(rows, ["g"], "share", "seats", ["i"]).orderBy("i").collect()] == wins


def test_given_weights_and_repeats(spark):
    docs = data.simple(spark, ["w " * 100] * 50, "a").union(data.docs(spark, [(100 + i, "w " * 100, "en", "b", 0, *"abcdefg") for i in range(10)]))
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double")
    mixed = M.repeat_taken(docs, sources=weights)
    assert mixed.columns == docs.columns
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert counts["b"] == 30 and abs(counts["a"] - 30) <= 8


def test_empty(spark):
    assert M.mix(data.empty(spark)).collect() == []
    assert M.repeat_taken(data.empty(spark)).collect() == []
    assert [r.taken for r in M.mix(data.simple(spark, [None, "", " "])).collect()] == [0, 0, 0]
