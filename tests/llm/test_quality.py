from __future__ import annotations

import re
from collections import Counter

from tests.llm import data
from viewlog.llm import quality as Q

BLANK = " \t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {k for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_measures_match_brute_force(spark):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted(((r.doc_id, *(r[n] for n in names), r.base_failed) for r in Q.quality_verdicts(data.docs(spark)).collect()), key=repr)
    want = [(r[0], *(m := brute(r[1])), m[0] < 20 or 100 * m[4] > 30 * m[0]) for r in data.rows()]
    assert got == sorted(want, key=repr)


def test_host_verdicts(spark):
    """A host whose documents nearly all fail takes its good ones down; others keep theirs."""
    rows = []
    good = data.prose(__import__("random").Random(1), 60)
    for h in range(8):
        for i in range(40):
            bad = i < (39 if h == 0 else 4)
            rows.append((len(rows), "too short" if bad else good + f" {h} {i}", "en", f"h{h}", 0, *"abcdefg"))
    rows.append((999, good, "en", None, 0, *"abcdefg"))
    docs = data.docs(spark, rows)
    found = {r.doc_id: r for r in Q.quality_verdicts(docs).collect()}
    for r in rows:
        want = r[1] != "too short" and r[3] != "h0"
        assert found[r[0]].kept == want
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in found.items() if r.kept)


def test_shrinkage(spark):
    """One failing document of a one-document host is not held against the host."""
    rows = [(i, f"h{i // 100}", i % 10 == 0) for i in range(1000)] + [(1000, "tiny", True)]
    found = {r.host: r for r in Q.host_verdicts(spark.createDataFrame(rows, "doc_id long, host string, base_failed boolean")).collect()}
    assert found["tiny"].host_failed == 1 and found["tiny"].host_ok and found["tiny"].host_rate < 0.5


def test_empty(spark):
    assert Q.quality_verdicts(data.empty(spark)).collect() == []
    assert Q.keep_good(data.empty(spark)).collect() == []
