from __future__ import annotations

import random
import zlib

import numpy as np

from tests.llm import data
from viewlog.llm import toxicity as T


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_matches_brute_force():
    stems = ["idiot", "stupid", "moron", "réeux", "clown", "clowns"]
    lexicon = T.compile_lexicon(stems, [1.0] * len(stems))
    classes = T._classes(lexicon)
    rng = random.Random(3)
    words = set()
    for _ in range(3000):
        w = list(rng.choice(stems))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "o", "1", "t"])
        words.add("".join(w) + rng.choice(["", "s", "ish"]))
    words = sorted(w for w in words if w)
    n, hits = T.find_hits(" ".join(words), lexicon, classes)
    found = {at: (stem, slips) for at, stem, slips in hits}
    at = 0
    for w in words:
        exact = [s for s in stems if w.startswith(s)]
        near = [s for s in stems if s[0] == w[0] and min(distance(w[:k], s) for k in range(1, len(w) + 1)) <= 1]
        got = found.get(at)
        assert (got is not None) == bool(near), w
        if got:
            assert got[1] == (0 if exact else 1), w
        at += len(w) + 1
    assert n == len(words)


def test_contexts():
    quoted, aimed = T.in_context('he wrote "idiot" about it', 10)
    assert quoted and not aimed
    assert T.in_context("you idiot!", 4) == (False, True)
    assert T.in_context("the report called him an idiot", 25)[0]


def labelled(n: int = 600):
    rng = random.Random(5)
    bad = ["idiot", "moron", "scum", "clown"]
    rows, labels = [], []
    for i in range(n):
        words = data.prose(rng, rng.randint(20, 120)).split()
        toxic = i % 4 == 0
        for _ in range(rng.randint(3, 6) if toxic else 0):
            w = rng.choice(bad)
            words.insert(rng.randrange(len(words)), w if rng.random() < 0.8 else w[:2] + "x" + w[3:])
        rows.append((i, " ".join(words), "en", "s", 0, *"abcdefg"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_awkward_rows(spark):
    rows, labels = labelled()
    rows += [(10_000 + (r[0] or 0), *r[1:]) for r in data.rows()] + [(None, None, None, None, None, *"abcdefg")]
    labels += [(None, 1, 1), (5, None, None), (20_000_000, 1, 1), (3, 0, 0)]
    docs = data.docs(spark, rows)
    found = T.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(found) == len(rows)
    truth = {i: t for i, _, t in labels if i is not None and t is not None}
    right = held = 0
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id is not None and r.doc_id < 600 and r.held_out:
            held += 1
            right += r.predicted == truth[r.doc_id]
    assert held > 80 and right / held > 0.95


def test_long_text_in_pieces():
    lexicon = T.compile_lexicon(["idiot"], [1.0])
    classes = T._classes(lexicon)
    text = ("word " * 99 + "idiot ") * 5000
    one = T.features(text, lexicon, classes)
    assert np.isclose(one[0], np.log1p(5000)) and np.isclose(one[-1], np.log1p(500_000))


def plain(text: str, stems: list[str], piece: int = 1 << 20) -> dict[str, float]:
    lexicon = T.compile_lexicon(stems, [1.0] * len(stems))
    return dict(zip(T.FEATURES, T.features(text, lexicon, T._classes(lexicon), piece)))


def test_misspelled_hits_have_contexts():
    quoted, aimed = plain('he wrote "idiiot"', ["idiot"]), plain("you idiiot!", ["idiot"])
    assert quoted["slips_quoted"] > 0 and quoted["slips"] == quoted["slips_aimed"] == 0
    assert aimed["slips_aimed"] > 0 and aimed["slips"] > 0 and aimed["slips_quoted"] == 0


def test_any_script():
    assert plain("ты идиот!", ["идиот"])["exact"] > 0
    assert plain("ты идиит!", ["идиот"])["slips"] > 0
    assert plain("傻瓜啊", ["傻瓜啊" + T.END])["exact"] > 0
    assert plain("“идиот”", ["идиот"])["quoted"] > 0


def test_short_terms_are_whole_words_without_slips():
    assert plain("a sob story", ["sob" + T.END])["exact"] > 0
    for text in ("sober people", "a sop", "so", "sobs"):
        found = plain(text, ["sob" + T.END])
        assert found["exact"] == found["slips"] == 0, text


def test_hits_at_the_border_of_pieces():
    text = 'x' * 50 + ' he wrote "idiot" and then you idiot! ' + "word " * 20
    whole = plain(text, ["idiot"])
    assert all(plain(text, ["idiot"], n) == whole for n in range(1, len(text) + 2))


def test_every_term_with_evidence_is_learned(spark):
    rng = random.Random(9)
    bad = ["".join(rng.choice("bcdfgklmprstvz") + rng.choice("aeiou") for _ in range(3)) for _ in range(150)]
    rows = [(1, " ".join([data.prose(rng, 20), *rng.sample(bad, 40)])) for _ in range(120)] + [(0, data.prose(rng, 30)) for _ in range(240)]
    learned = [s for s, _ in T.learn_stems(spark.createDataFrame(rows, "toxic int, text string"))]
    assert all(any(b.startswith(s) for s in learned) for b in bad)


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in T.toxicity(data.docs(spark), none).collect()} == {0.0}
    assert T.toxicity(data.empty(spark), none).collect() == []
