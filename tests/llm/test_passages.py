from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tests.llm import data
from viewlog.llm import passages as P
from viewlog.llm.shingles import word_hashes


def corpus(seed: int = 6):
    """Passages of 51 words and more, exact and fuzzy, in several documents, some of them many times."""
    rng = random.Random(seed)

    def prose(n):
        return [data.word(rng) + str(rng.randint(0, 999)) for _ in range(n)]

    rows, planted = [], {}
    passages = [prose(n) for n in (51, 60, 90, 200)]
    for i in range(80):
        words, marks = prose(rng.randint(0, 150)), []
        if i % 4 == 0:
            which = i // 4 % len(passages)
            passage = list(passages[which])
            if i % 8 == 4 and len(passage) > 80:  # a word here and there differs
                for k in range(20, len(passage), 40):
                    passage[k] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = passage
            marks.append((which, at, at + len(passage)))
        rows.append((i, " ".join(words), "en", "s", 0, *"abcdefg"))
        planted[i] = marks
    return rows, planted


def test_planted_passages(spark):
    rows, planted = corpus()
    found = P.repeated_passages(data.docs(spark, rows)).collect()
    covered = {}
    for r in found:
        assert r.source_id < r.doc_id and planted[r.doc_id] and planted[r.source_id]
        assert planted[r.doc_id][0][0] == planted[r.source_id][0][0]
        covered.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    firsts = {}
    for i, marks in planted.items():
        for which, start, stop in marks:
            if which not in firsts:
                firsts[which] = i
                continue
            assert any(s <= start + 2 and e >= stop - 2 for s, e in covered[i]), (i, which)
    assert {r.source_id for r in found} >= set(firsts.values())


def test_chains_match_quadratic_search():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(1, 25)
        at = np.array([rng.randrange(60) for _ in range(n)])
        there = np.array([rng.randrange(60) for _ in range(n)])
        matches = sorted(set(zip(at.tolist(), there.tolist())))
        best = {}
        for a, b in matches:
            best[a, b] = P.SEED + max([0.0, *(best[x, y] - P.GAP_COST * (a - x + b - y) for x, y in matches if x < a and y < b)])
        first = P.chains(np.array([m[0] for m in matches]), np.array([m[1] for m in matches]))[0]
        assert abs(best[first[-1]] - max(best.values())) < 1e-9
        assert all(a < c and b < d for (a, b), (c, d) in zip(first, first[1:]))


def test_seeds_cover_every_stretch():
    words = word_hashes(" ".join(str(i * 7919 % 1013) for i in range(3000)).encode())
    at, _ = P.seeds(words)
    assert max(np.diff(at)) <= P.WINDOW and at[0] < P.WINDOW
    assert len(P.seeds(word_hashes(b"same " * 1000))[0]) < 200


def test_walk():
    x = np.arange(100)
    assert P.walk(x, x) == (100, 100, 100)
    y = np.concatenate([x[:40], [900, 901], x[43:]])
    assert P.walk(x, y) == (100, 99, 97)
    assert P.walk(x, np.concatenate([x[:30], np.arange(500, 600)]))[2] == 30


def test_streams_split_anywhere(spark):
    """Matches do not depend on where Arrow batches end."""
    rows, _ = corpus()
    want = sorted(map(repr, P.repeated_passages(data.docs(spark, rows)).collect()))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        assert sorted(map(repr, P.repeated_passages(data.docs(spark, rows)).collect())) == want
    finally:
        spark.conf.set(key, old)


def test_spans_awkward_rows_and_empty(spark):
    found = P.repeated_passages(data.docs(spark))
    assert all(r.doc_id > r.source_id for r in found.collect())
    spans = {r.doc_id: r for r in P.repeated_spans(found).collect()}
    for r in spans.values():
        ends = [(s.start_word, s.end_word) for s in r.spans]
        assert ends == sorted(ends) and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
        assert r.repeated_words == sum(e - s for s, e in ends)
    assert P.repeated_passages(data.empty(spark)).collect() == []


def test_short_fuzzy_passages(spark):
    """Passages of 40 to 60 words with 10 to 20 % of the words replaced."""
    rng = random.Random(12)

    def prose(n):
        return [data.word(rng) + str(rng.randint(0, 99999)) for _ in range(n)]

    rows, planted = [], {}
    for k in range(120):
        size, share = (40, 0.1) if k % 3 == 0 else (50, 0.15) if k % 3 == 1 else (60, 0.18)
        passage = prose(size)
        copy = list(passage)
        for i in rng.sample(range(1, size - 1), int(size * share)):
            copy[i] = prose(1)[0]
        for words in (passage, copy):
            before = prose(rng.randint(10, 60))
            planted[len(rows)] = (len(before), len(before) + size)
            rows.append((len(rows), " ".join(before + words + prose(30)), "en", "s", 0, *"abcdefg"))
    found = {(r.doc_id, r.source_id): r for r in P.repeated_passages(data.docs(spark, rows)).collect()}
    assert all(late - early == 1 and early % 2 == 0 for late, early in found)
    hits = [found[i + 1, i] for i in range(0, len(rows), 2) if (i + 1, i) in found]
    assert len(hits) >= 0.95 * 120
    for r in hits:
        start, stop = planted[r.doc_id]
        assert abs(r.start_word - start) <= 10 and abs(r.end_word - stop) <= 10


def test_passages_of_frequent_lines(spark):
    """The one earlier document that has two frequent lines in a row is found among the many that have one of them."""
    rng = random.Random(13)

    def prose(n):
        return [data.word(rng) + str(rng.randint(0, 99999)) for _ in range(n)]

    lines = [prose(30) for _ in range(8)]
    rows, sources = [], {}
    for i in range(600):
        if i in (200, 201, 202, 203) or i in (500, 501, 502, 503):
            words = lines[2 * (i % 100)] + lines[2 * (i % 100) + 1]
            sources.setdefault(i % 100, []).append(i)
        else:  # frequent lines, but no two in a row
            words = [w for line in rng.sample(lines, 3) for w in line + prose(12)]
        rows.append((i, " ".join(prose(9) + words + prose(9)), "en", "s", 0, *"abcdefg"))
    found = {(r.doc_id, r.source_id): r for r in P.repeated_passages(data.docs(spark, rows)).collect()}
    for early, late in sources.values():
        r = found[late, early]
        assert r.start_word <= 9 and r.end_word >= 69 and r.matched >= 60


def test_passages_behind_gaps(spark):
    """100 shared words, inserted ones on one side or both, 100 shared words, 10 % of them replaced: both parts are found."""
    rng = random.Random(14)

    def prose(n):
        return [data.word(rng) + str(rng.randint(0, 99999)) for _ in range(n)]

    rows, parts = [], {}
    for k in range(120):
        gap, other = (30, 60, 150)[k % 3], rng.choice((0, 40))
        first, second = prose(100), prose(100)
        copies = [list(first), list(second)]
        for copy in copies:
            for i in rng.sample(range(1, 99), 10):
                copy[i] = prose(1)[0]
        before = prose(rng.randint(10, 60))
        rows.append((2 * k, " ".join(prose(20) + first + prose(other) + second + prose(20)), "en", "s", 0, *"abcdefg"))
        rows.append((2 * k + 1, " ".join(before + copies[0] + prose(gap) + copies[1] + prose(20)), "en", "s", 0, *"abcdefg"))
        parts[2 * k + 1] = (gap, len(before), len(before) + 100 + gap)
    covered = {}
    for r in P.repeated_passages(data.docs(spark, rows)).collect():
        assert r.source_id == r.doc_id - 1 and r.matched >= 0.8 * max(r.end_word - r.start_word, r.source_end - r.source_start)
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    for gap in (30, 60, 150):
        for part in (1, 2):
            starts = [(d, p[part]) for d, p in parts.items() if p[0] == gap]
            hits = sum(len(covered.get(d, set()) & set(range(s, s + 100))) >= 90 for d, s in starts)
            assert hits >= 0.95 * len(starts), (gap, part, hits)


def test_joined_stretches():
    near, far = (0, 30, 0, 30, 28), (200, 260, 100, 160, 60)
    assert P.joined([near, (34, 60, 32, 58, 26)], 40, 0.8) == [(0, 60, 0, 58, 54)]
    assert P.joined([near, far], 40, 0.8) == [far]
    assert P.joined([], 40, 0.8) == []


def test_hashes_of_runs():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    twice = np.concatenate((words[7:300], words))
    for n in (1, 5, 40):
        runs = P.runs_of(twice, n)
        assert len(runs) == len(twice) - n + 1 and len(set(runs.tolist())) == len(words)  # with those across the seam
        assert (runs[:293 - n + 1] == runs[300:300 + 293 - n + 1]).all()
    assert len(P.runs_of(words[:4], 5)) == 0


def test_single_matches_left_out_early_have_no_passage():
    """The chains left out at once are those that an alignment over the slices finds nothing in."""
    rng = np.random.default_rng(4)
    rows, want = [], []
    for _ in range(600):
        x, y = (rng.integers(0, 400, rng.integers(6, 120)).astype(np.uint32) for _ in range(2))
        n = int(rng.integers(1, min(len(x), len(y))))
        a, b = int(rng.integers(0, len(x) - n + 1)), int(rng.integers(0, len(y) - n + 1))
        y[b:b + n] = x[a:a + n]
        if rng.random() < 0.5:
            y[rng.integers(b, b + n)] = 999
        at = a + int(rng.integers(0, n))
        rows.append((1, 0, 50, 70, np.array([50 + at, 70 + b + at - a], np.int32).tobytes(), x.tobytes(), y.tobytes()))
        parts = P.stretches(x, y, np.array([[at, b + at - a]]))
        want.append(bool(P.joined(parts, P.MIN_WORDS, P.IDENTITY)))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["late", "early", "oa", "ob", "steps", "x", "y"])
    for part in (batch, batch.slice(100, 300)):
        out = P._no_passage(part, P.MIN_WORDS)
        assert out.sum() > len(out) / 4
        assert not (out & np.array(want)[100:400] if part is not batch else out & np.array(want)).any()
    found = [len(b) for b in P._aligned(iter([batch]), P.MIN_WORDS, P.IDENTITY)]
    assert sum(found) == sum(len(P.joined(P.stretches(np.frombuffer(r[5], np.uint32), np.frombuffer(r[6], np.uint32),
                                                     np.frombuffer(r[4], np.int32).reshape(-1, 2) - [50, 70]), P.MIN_WORDS, P.IDENTITY)) for r in rows)


def test_least_places_are_those_of_all_windows():
    rng = np.random.default_rng(3)
    for n, w, most in ((6, 6, 3), (50, 6, 4), (400, 10, 1 << 60), (400, 6, 2)):
        runs = rng.integers(0, most, n).astype(np.uint64)
        windows = np.lib.stride_tricks.sliding_window_view(runs, w)
        assert P.least_places(runs, w).tolist() == sorted(set((windows.argmin(axis=1) + np.arange(len(windows))).tolist()))


def test_pairs_in_whole_batches_make_the_same_chains(monkeypatch):
    """Chains of pairs inside a batch are those of ``chains``; plain copies need no search."""
    rng = np.random.default_rng(6)
    rows = []
    for late in range(300):
        n, kind = int(rng.integers(1, 12)), late % 4
        at = np.cumsum(rng.integers(1, 8 if kind < 3 else 90, n))
        there = at + 5 if kind < 2 else rng.permutation(at) if kind == 2 else np.cumsum(rng.integers(1, 60, n))
        rows += [(late, -1, int(a), int(b)) for a, b in zip(at, there) for _ in range(1 + (kind == 1 and int(rng.integers(0, 3))))]
    want, of = set(), {}
    for late, _, a, b in sorted(set(rows)):  # a match found twice is one
        of.setdefault(late, []).append((a, b))
    for late, pairs in of.items():
        want |= {(late, np.array(c, np.int32).tobytes()) for c in P.chains(*(np.array(c) for c in zip(*pairs)))}
    calls, chains = [], P.chains
    monkeypatch.setattr(P, "chains", lambda *a: (calls.append(a), chains(*a))[1])
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
    table = pa.table(columns, names=["late", "early", "at", "there"])
    for size in (10_000, 37):
        calls.clear()
        found = pa.Table.from_batches(list(P._chain_rows(iter(table.to_batches(max_chunksize=size)))))
        assert set(zip(found["late"].to_pylist(), found["steps"].to_pylist())) == want
        if size > len(rows):
            assert len(calls) < 150 + 2


def test_alignments_of_one_run_in_whole_batches(monkeypatch):
    """Chains whose alignment is one run of equal words, of one match or more, give the same passages without ``walk``."""
    rng = np.random.default_rng(8)
    rows, want = [], []
    for i in range(400):
        n = int(rng.integers(20, 120))
        common = rng.integers(0, 1 << 32, n).astype(np.uint32)
        (x0, y0), (x1, y1) = rng.integers(0, 30, (2, 2))
        x, y = (np.concatenate((rng.integers(0, 1 << 32, p), common, rng.integers(0, 1 << 32, q))).astype(np.uint32) for p, q in ((x0, x1), (y0, y1)))
        if i % 5 == 0:
            y[y0 + n // 2] ^= 1
        at = np.sort(rng.choice(n, 1 + i % 3, replace=False))
        steps = np.stack((at + x0, at + y0), axis=1)
        rows.append((i, -1, 7, 9, (steps + [7, 9]).astype(np.int32).tobytes(), x.tobytes(), y.tobytes()))
        want += [(i, 7 + p[0], 7 + p[1], -1, 9 + p[2], 9 + p[3], p[4]) for p in P.passages(x, y, steps, P.MIN_WORDS, P.IDENTITY)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["late", "early", "oa", "ob", "steps", "x", "y"])
    calls, walk = [], P.walk
    monkeypatch.setattr(P, "walk", lambda *a: (calls.append(a), walk(*a))[1])
    for part in (batch, batch.slice(3)):
        found = pa.Table.from_batches(list(P._aligned(iter([part]), P.MIN_WORDS, P.IDENTITY)))
        assert sorted(zip(*(c.to_pylist() for c in found.columns[:7]))) == sorted(w for w in want if part is batch or w[0] >= 3)
    assert len(calls) < 2 * 2 * 400 / 3


def test_periodic_texts_have_few_seeds():
    """Where a text repeats every few words, each window still has one of its seeds, and not many."""
    rng = np.random.default_rng(2)
    for period in range(1, 8):
        words = np.tile(rng.integers(0, 1 << 62, period).astype(np.uint64), 600 // period)
        for k, w in ((P.SEED, P.WINDOW), (P.MIN_WORDS, P.LONG_WINDOW)):
            at, found = P.seeds(words, k, w)
            assert np.diff(at).max() <= w and at[0] < w and at[-1] >= len(words) - k + 1 - w
            assert len(np.unique(found)) <= period and len(at) <= 600 / max(w // 2, 1) + 2
