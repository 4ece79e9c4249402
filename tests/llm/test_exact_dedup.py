from __future__ import annotations

import hashlib
from collections import defaultdict

from tests.llm import data
from viewlog.llm import exact_dedup as E

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOW)].append(r[0])
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            out.append((i, best, len(ids), hashlib.sha256(text.encode()).hexdigest(), i == best and not kept))
            kept |= i == best
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256, r.kept) for r in df.collect()), key=repr)


def test_matches_brute_force(spark):
    assert got(E.exact_duplicates(data.docs(spark))) == brute(data.rows())


def test_chunks_and_collisions(spark):
    # Tiny chunks split every text; tiny primes make different texts collide.
    assert got(E.exact_duplicates(data.docs(spark), chunk_bytes=64)) == brute(data.rows())
    rows = [(i, f"{i % 40:03d}", "en", "s", 0, *"abcdefg") for i in range(200)]
    assert got(E.exact_duplicates(data.docs(spark, rows), primes=(7, 11))) == brute(rows)


def test_chunk_prints_compose():
    p, q = E.PRIMES
    whole = E.chunk_print(b"some longer text")
    h1, s1, h2, s2 = E.chunk_print(b"some lon")
    a1, t1, a2, t2 = E.chunk_print(b"ger text")
    assert whole == ((h1 * t1 + a1) % p, s1 * t1 % p, (h2 * t2 + a2) % q, s2 * t2 % q)


def test_keep_one(spark):
    docs = data.docs(spark)
    kept = E.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [(r.text or "").translate(LOW) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({(r[1] or "").translate(LOW) for r in data.rows()})


def test_empty(spark):
    assert got(E.exact_duplicates(data.empty(spark))) == []
