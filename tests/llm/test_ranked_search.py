from __future__ import annotations

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import data
from viewlog.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, queries, k=10):
    """Every document scored for every query."""
    held = [(i, words(t)) for i, t in docs]
    n_docs, n_words = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = {}
    for _, ws in held:
        for t in set(ws):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in queries:
        scored = []
        for doc_id, ws in held:
            total = 0
            for t in sorted(set(words(text)) & set(ws)):
                tf, m = ws.count(t), 10 + 90 * len(ws) * n_docs // n_words
                total += ranked_search.weight(n_docs, df[t]) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if total:
                scored.append((-total, doc_id is not None, doc_id or 0))
        out += [(item, r, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def query_table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, doc_id string")


QUERIES = [(1, "the quality ORis"), (2, None), (3, ""), (4, "nosuchterm ... !"), (5, "anthe ané lone; ané or 9x"), (5, "changed1 changed2 phrase"),
           (None, "one two x b c A"), (7, data.prose(random.Random(3), 400))]


def test_against_brute_force(spark):
    rows = data.rows()
    docs = [(r[0], r[1]) for r in rows if not (r[1] and len(r[1]) > 50_000)]
    table = data.docs(spark, [r for r in rows if not (r[1] and len(r[1]) > 50_000)])
    assert result(ranked_search.search(table, query_table(spark, QUERIES))) == brute(docs, QUERIES)
    # Small blocks and one batch a query change nothing.
    assert result(ranked_search.search(table, query_table(spark, QUERIES), max_docs=3, max_postings=40, query_bytes=30)) == brute(docs, QUERIES)
    assert result(ranked_search.search(table, query_table(spark, QUERIES), k=2)) == brute(docs, QUERIES, 2)


def test_empty_tables(spark):
    asked = query_table(spark, QUERIES)
    assert ranked_search.search(data.empty(spark), asked).collect() == []
    assert ranked_search.search(data.simple(spark, [None, "", "..."]), asked).collect() == []
    assert ranked_search.search(data.docs(spark), asked.limit(0)).collect() == []


def test_ties_go_to_the_least_id(spark):
    rows = [(i, "same words here", "en", "s", 0, *"abcdefg") for i in (9, 4, None, 7, 4, 1)]
    got = ranked_search.search(data.docs(spark, rows), query_table(spark, [(1, "words")]), k=4).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [None, 1, 4, 4]
    assert [r["rank"] for r in got] == [1, 2, 3, 4]


class Counting(ranked_search.Block):
    """Counts the documents that get an accumulator."""

    def search(self, query, weights, k):
        out = super().search(query, weights, k)
        self.made = int((self.score > 0).sum())
        return out


def block(rng, n, kind=ranked_search.Block):
    docs = [[rng.choices(range(12), [2 ** -i for i in range(12)])[0] for _ in range(rng.randint(1, 30))] for _ in range(n)]
    entries = [(t, d, w.count(t)) for d, w in enumerate(docs) for t in sorted(set(w))]
    term, doc, tf = (np.array(c, np.int64) for c in zip(*entries))
    built = kind(list(range(n)), [len(w) for w in docs], term, doc, tf, n, sum(map(len, docs)))
    return built, docs


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 80), st.integers(1, 12))
def test_stopping_never_loses_a_document(seed, n, k):
    rng = random.Random(seed)
    built, docs = block(rng, n)
    weights = np.array([rng.randint(0, 3000) for _ in range(12)])
    total = sum(map(len, docs))
    query = np.array(rng.sample(range(12), rng.randint(1, 12)))
    want = []
    for d, w in enumerate(docs):
        s = sum(int(weights[t]) * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * (10 + 90 * len(w) * n // total))) for t in query.tolist() if t in w)
        if s:
            want.append((-s, d))
    assert built.search(query, weights, k) == [(d, -s) for s, d in sorted(want)[:k]]


def test_frequent_terms_create_no_accumulators():
    rng = random.Random(1)
    built, docs = block(rng, 4_000, Counting)
    df = [sum(t in w for w in docs) for t in range(12)]
    weights = np.array([ranked_search.weight(len(docs), n) if n else 0 for n in df])
    built.search(np.array(sorted(range(12), key=lambda t: df[t])), weights, 10)
    assert built.made < max(df)
