from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import data
from viewlog.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, ranks=200):
    """Every kept term of every group, zero counts included."""
    counts, df = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(found)
        df[lang or ""].update(set(found))
    out = []
    for lang in {g[0] for g in counts}:
        kept = sorted(t for t, n in df[lang].items() if n >= 3)
        groups = {s: c for (g, s), c in counts.items() if g == lang}

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != s]
            over = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", over, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, r) for r, (value, item) in enumerate(found[:limit], 1)]
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def mixed(seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(160):
        lang = rng.choice(["en", "en", "en", "fr", None, "", "xx"])
        source = rng.choice(["hot"] * 6 + ["b", "é", "zz", None, ""])
        text = rng.choice([data.prose(rng, rng.randint(0, 40)), None, "", "Same WORDS same", "9 _ 日本 ÉCOLE école"])
        rows.append((i, None if lang == "xx" else text, lang, source, 0, *"abcdefg"))
    return rows


def test_against_brute_force(spark):
    rows = mixed()
    assert result(divergence.audit(data.docs(spark, rows))) == brute([(r[2], r[3], r[1]) for r in rows])
    assert result(divergence.audit(data.docs(spark, rows), term_ranks=3)) == brute([(r[2], r[3], r[1]) for r in rows], 3)
    awkward = data.rows()
    assert result(divergence.audit(data.docs(spark))) == brute([(r[2], r[3], r[1]) for r in awkward])


def test_no_terms_and_empty_tables(spark):
    assert divergence.audit(data.empty(spark)).collect() == []
    rows = [(i, t, "en", s, 0, *"abcdefg") for i, (t, s) in enumerate([(None, "a"), ("", "b"), ("once", None)])]
    got = result(divergence.audit(data.docs(spark, rows)))
    assert got == brute([(r[2], r[3], r[1]) for r in rows])
    assert len(got) == 6 and all(r[4] == 0 for r in got)


def test_small_slices_change_nothing(spark, monkeypatch):
    """Slices end with a term; partial sums of a pair add up."""
    rng = random.Random(2)
    entries = [("en" if t % 3 else "fr", f"t{t:03}", f"s{s}", rng.randint(1, 10**6)) for t in range(60) for s in range(9) if rng.random() < 0.5]
    z = {f"s{s}": rng.randint(1, 50) for s in range(9)}
    import pandas as pd
    import pyarrow as pa

    table = pd.DataFrame(sorted(entries), columns=["lang", "term", "source", "p"])
    table["z"] = table["source"].map(z)
    table["p"] = table["p"].astype("int64")
    batch = pa.RecordBatch.from_pandas(table, preserve_index=False)

    def total(step):
        parts = [batch.slice(i, step) for i in range(0, batch.num_rows, step)]
        sums = Counter()
        for out in divergence._scatter_batches(iter(parts)):
            for lang, a, b, v in zip(*(out.column(c).to_pylist() for c in ("lang", "source", "item", "common"))):
                sums[lang, a, b] += v
        return sums

    whole = total(10**6)
    want = Counter()
    for _, group in table.groupby(["lang", "term"]):
        for x in group.itertuples():
            for y in group.itertuples():
                if x.source != y.source:
                    f = lambda p, q: (p - q) ** 2 // q
                    want[x.lang, x.source, y.source] += f(x.p, y.p) - f(x.p, y.z) - f(x.z, y.p) + f(x.z, y.z)
    assert whole == want
    monkeypatch.setattr(divergence, "SLICE_POSTINGS", 25)
    monkeypatch.setattr(divergence, "SCATTER_POSTINGS", 7)
    assert total(10) == want


def test_counts_beyond_64_bits_inside(spark):
    """10^9 times a count of 10^11 does not fit 64 bits."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(10**11, 3 * 10**12, 7)], "n long, total long, terms long")
    got = df.select(divergence._share(F.col("n"), F.col("total"), F.col("terms"))).first()[0]
    assert got == 1 + 10**9 * (10**11 + 1) // (3 * 10**12 + 7)


def test_scatter_covers_long_posting_lists():
    rng = np.random.default_rng(0)
    n = 50
    term = np.repeat(np.arange(20), n)
    peer = np.tile(np.arange(n), 20)
    p, z = rng.integers(1, 10**9, len(term)), rng.integers(1, 100, n)
    for a, total in divergence.scatter(term, peer, p, z):
        b = (a + 1) % n
        f = lambda x, y: (int(x) - int(y)) ** 2 // int(y)
        pa_, pb = p[peer == a], p[peer == b]
        assert total[b] == sum(f(x, y) - f(x, z[b]) - f(z[a], y) + f(z[a], z[b]) for x, y in zip(pa_, pb))


@pytest.mark.parametrize("held", [1, 50])
def test_partial_counts_add_up(spark, monkeypatch, held):
    import pyarrow as pa

    rows = [(r[2] or "", r[3] or "", r[1] or "") for r in mixed()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["lang", "source", "text"])
    monkeypatch.setattr(divergence, "HELD_TERMS", held)

    def total(parts):
        sums = Counter()
        for out in divergence._count_batches(iter(parts)):
            for key in zip(*(out.column(c).to_pylist() for c in ("lang", "source", "term", "n"))):
                sums[key[:3]] += key[3]
        return sums

    assert total([batch.slice(i, 7) for i in range(0, batch.num_rows, 7)]) == total([batch])
