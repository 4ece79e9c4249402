from __future__ import annotations

import random

from tests.llm import data
from viewlog.llm import licenses as L


def corpus():
    rng = random.Random(8)
    rows, want = [], set()
    notices = [(f, t) for f, ts in L.TEMPLATES.items() for t in ts]
    for i in range(120):
        lines = [data.prose(rng, rng.randint(3, 30)).replace("\n", " ") for _ in range(3)]
        if i % 3 == 0:
            family, text = notices[i // 3 % len(notices)]
            lines.insert(1, text.upper() if i % 2 else "  " + text)
            want.add((i, 1, family))
        if i % 5 == 0:
            lines.append(rng.choice(["The driver needs a licence and a permit.", "A public library near the station.", "Software of this version is new."]))
        rows.append((i, "\n".join(lines), "en", "s", 0, *"abcdefg"))
    return rows, want


def test_finds_families_and_leaves_others_alone(spark):
    rows, want = corpus()
    found = L.license_scan(data.docs(spark, rows)).collect()
    got = {(r.doc_id, r.line_no, r.family) for r in found if r.confirmed}
    assert len(got & want) >= 0.95 * len(want)
    assert {(i, n) for i, n, _ in got} <= {(i, n) for i, n, _ in want}
    assert all(0.5 <= r.probability <= 1 for r in found)


def test_awkward_rows_and_empty(spark):
    rows = data.rows() + [(500, "Released under the MIT License.", None, None, None, *"abcdefg")] * 2
    found = L.license_scan(data.docs(spark, rows)).collect()
    assert [(r.doc_id, r.family, r.confirmed) for r in found if r.confirmed] == [(500, "mit", True)] * 2
    assert L.license_scan(data.empty(spark)).collect() == []
