from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import data
from viewlog.llm import components as C
from viewlog.llm import ngram_join as N
from viewlog.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def brute(rows, n=4, p=85, q=100):
    sets = [shingles(r[1], n) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and q * both >= p * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids else r[0]))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def variants(seed: int, n: int) -> list[tuple]:
    """Texts around the threshold: chains of small edits, short and long."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words = data.prose(rng, rng.choice([3, 6, 9, 12, 25, 60, 130, 400])).split()
        for _ in range(rng.randint(1, 8)):
            rows.append((len(rows), " ".join(words), "en", "s", 0, *"abcdefg"))
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                at = rng.randrange(len(words))
                words = rng.choice([words[:at] + words[at + 1:] or ["w"], words[:at] + [data.word(rng)] + words[at:], words[:at] + ["Z"] + words[at + 1:]])
    rng.shuffle(rows)
    return rows


def test_awkward_rows(spark):
    assert got(N.similar_documents(data.docs(spark))) == brute(data.rows())


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = variants(seed, 45)
    assert got(N.similar_documents(data.docs(spark, rows))) == brute(rows)


def test_other_parameters(spark):
    rows = variants(3, 30)
    assert got(N.similar_documents(data.docs(spark, rows), words=5, threshold=(80, 100))) == brute(rows, 5, 80)


def test_small_blocks(spark, monkeypatch):
    """Tiles split into many blocks lose nothing."""
    monkeypatch.setattr(N, "BLOCK", 2)
    rows = variants(4, 30)
    assert got(N.similar_documents(data.docs(spark, rows))) == brute(rows)


def test_tiles_are_lossless():
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = a.copy()
        for _ in range(int(rng.integers(0, max(1, n // 6)))):
            b = np.delete(b, rng.integers(len(b))) if len(b) > 1 and rng.random() < 0.5 else np.append(b, rng.integers(0, 1 << 63, dtype=np.uint64))
        b = np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            assert len(np.intersect1d(N.tile_keys(a), N.tile_keys(b)))
        x, y = N.stacked([N.bitmap(a).tobytes(), N.bitmap(b).tobytes()])
        assert both <= (len(a) + len(b) - int(N.popcount(x ^ y).sum())) // 2


def test_unlike_sets_share_few_tiles():
    """Long sets with some elements in common: neither empty groups nor groups of one common element bring them together."""
    rng = np.random.default_rng(5)
    common = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    for threshold in (N.THRESHOLD, (80, 100)):
        tiles = [N.tile_keys(np.unique(np.concatenate((common, rng.integers(0, 1 << 64, 1700, dtype=np.uint64)))), threshold) for _ in range(30)]
        shared = sum(len(np.intersect1d(a, b)) for i, a in enumerate(tiles) for b in tiles[:i])
        assert shared < 30 * 29 / 2  # under one a pair


def test_keep_one(spark):
    docs = data.docs(spark)
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    want = {c for i, n, c in brute(data.rows()) if i is not None}
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(
        list(want) + [i for i, n, _ in brute(data.rows()) if i is not None and not n and i not in want])


def test_empty(spark):
    assert got(N.similar_documents(data.empty(spark))) == []
    assert N.keep_one(data.empty(spark)).collect() == []


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    label = {}
    for a, b in edges:
        if a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted((r.node, r.component) for r in found.collect()) == sorted(label.items())
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_repeated_ids_lose_no_clean_row(spark):
    rng = random.Random(31)
    near, clean, other, lone = (data.prose(rng, 80).replace("é", "e") for _ in range(4))
    rows = [(1, near), (7, near + " more"), (7, clean), (8, other), (8, lone), (8, lone.upper()), (9, ""), (9, None), (None, near)]
    docs = data.docs(spark, [(i, t, "en", "s", 0, *"abcdefg") for i, t in rows])
    kept = N.keep_one(docs, words=5, threshold=(80, 100)).select("doc_id", "text").collect()
    found = sorted((r.doc_id or 0, (r.text or "").lower()) for r in kept)
    assert found == sorted([(1, near.lower()), (7, clean.lower()), (8, other.lower()), (8, lone.lower()), (9, ""), (9, ""), (0, near.lower())])
    assert N.keep_one(docs).columns == docs.columns


def family(n: int, changed: int) -> pa.RecordBatch:
    """A tile of ``n`` sets of 400 elements that differ from one another in ``changed`` elements each."""
    rng = np.random.default_rng(7)
    base = rng.integers(1, 1 << 63, 400, dtype=np.uint64)
    sets = []
    for _ in range(n):
        own = base.copy()
        own[rng.choice(400, changed, replace=False)] = rng.integers(1, 1 << 63, changed, dtype=np.uint64)
        sets.append(np.unique(own))
    same = [0] * n
    return pa.RecordBatch.from_pydict({"tile": same, "i": same, "j": same, "node": list(range(n)), "block": same, "component": list(range(n)),
                                       "n_shingles": [len(s) for s in sets], "bits": [N.sharp_bitmap(s).tobytes() for s in sets]})


def test_pairs_of_a_tile_do_not_grow_with_its_square():
    def count(changed, best):
        return sum(b.num_rows for b in N._tile_pairs(iter([family(120, changed)]), N.THRESHOLD, best))

    assert count(20, best=False) < 120  # similar, but not linked: 7140 pairs, of which coarse bitmaps allow most
    assert 0 < count(5, best=True) <= 120  # all linked: each with its best partner


def test_few_links_are_not_shuffled_to_meet(spark, monkeypatch):
    """A step over few links shuffles for two minima, the first of them read by both sides, and for what is distinct."""
    plans, write = [], C.written

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return write(df, name)

    monkeypatch.setattr(C, "written", noted)
    edges = spark.createDataFrame([(i + 1, i) for i in range(20)], "a long, b long")
    few = {tuple(r) for r in C.components(edges).collect()}
    assert few == {(i, 0) for i in range(21)} and max(plans) <= 4
    monkeypatch.setattr(C, "few", lambda rows: False)
    assert {tuple(r) for r in C.components(edges).collect()} == few and max(plans) > 4
