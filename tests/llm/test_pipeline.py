from __future__ import annotations

import corpus_pipeline as C
from tests.llm import test_exact_dedup as exact
from tests.llm import test_mixing as mixing
from tests.llm import test_ngram_join as near
from tests.llm import test_quality as quality

import struct
import hashlib
import re

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Each stage on its own input; the last on the mix."""
    docs = C.documents(spark, SF)
    rows = [tuple(r) for r in docs.collect()]  # doc_id, text, ...
    got = {}
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, SF), f"test-{name}")
        got[name] = [tuple(r) for r in docs.collect()]
    measured = {r[0]: quality.brute(r[1]) for r in rows}
    good = [r for r in rows if not (measured[r[0]][0] < 20 or 100 * measured[r[0]][4] > 30 * measured[r[0]][0])]
    hosts = {r[3] for r in got["quality_rules"]}
    assert sorted(got["quality_rules"]) == sorted(r for r in good if r[3] in hosts)
    assert len({r[3] for r in good} - hosts) <= 1

    kept = {i for i, _, _, _, k in exact.brute(got["quality_rules"]) if k}
    assert sorted(got["exact_dedup"]) == sorted(r for r in got["quality_rules"] if r[0] in kept)

    groups = near.brute(got["exact_dedup"], 5, 80, 100)
    assert sorted(r[0] for r in got["ngram_jaccard"]) == sorted(i for i, _, c in groups if i == c)

    sizes, taken, source = {}, {}, {}
    for r in got["ngram_jaccard"]:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
        sizes[r[3]] = sizes.get(r[3], 0) + n
        source[r[0]] = n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    for r in got["mixing"]:
        taken[r[3]] = taken.get(r[3], 0) + source[r[0]]
    assert set(got["mixing"]) <= set(got["ngram_jaccard"])
    longest = max(source.values())
    assert all(abs(taken.get(s, 0) - want[s]) <= 2 * longest for s in sizes)

    from tests.llm.test_bpe import REFERENCE

    out = []
    for r in got["mixing"]:
        ids = REFERENCE.encode(r[1] or "", add_special_tokens=False).ids
        text = REFERENCE.decode(ids, skip_special_tokens=False)
        out.append((r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(got["bpe"]) == sorted(out)


def test_run_is_its_stages(spark):
    docs = C.documents(spark, SF)
    for _, stage in C.STAGES:
        docs = C.written(stage(spark, docs, SF), "test-run")
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))
