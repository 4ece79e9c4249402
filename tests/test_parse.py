"""Dict-literal parsing: fixed cases and a property check of the fast path."""

from __future__ import annotations

import ast

from hypothesis import given, settings
from hypothesis import strategies as st

from viewlog.functions.parse import parse_dict_literal


def slow(line):
    text = line.strip()
    if not text:
        return None
    try:
        v = ast.literal_eval(text)
    except Exception:  # noqa: BLE001
        return None
    if not isinstance(v, dict):
        return None
    return {str(k): (None if x is None else str(x)) for k, x in v.items()}


def test_fixture_lines():
    assert parse_dict_literal(
        "{'Mac': 'B046FCAC0DC1', 'RealTimePlaying': 570.30, 'Duration': '3600'}"
    ) == {"Mac": "B046FCAC0DC1", "RealTimePlaying": "570.3", "Duration": "3600"}
    assert parse_dict_literal("{'Mac': None, 'Event': 'STOPVOD'}") == {"Mac": None, "Event": "STOPVOD"}
    assert parse_dict_literal("[1, 2]") is None
    assert parse_dict_literal("not a literal") is None
    assert parse_dict_literal("") is None
    assert parse_dict_literal("   ") is None
    assert parse_dict_literal(None) is None


def test_literal_forms():
    assert parse_dict_literal("{'a': 1.5e3}") == {"a": "1500.0"}
    assert parse_dict_literal("{'a': (1, 2)}") == {"a": "(1, 2)"}
    assert parse_dict_literal("{'a': {'b': None}}") == {"a": "{'b': None}"}
    assert parse_dict_literal("{'a': 'x' 'y'}") == {"a": "xy"}
    assert parse_dict_literal("{'a': 007}") is None
    assert parse_dict_literal("{'a': -0, 'b': +5, 'c': True}") == {"a": "0", "b": "5", "c": "True"}
    assert parse_dict_literal("{'a': 1, 'a': 2}") == {"a": "2"}
    assert parse_dict_literal("{1: 'x'}") == {"1": "x"}
    assert parse_dict_literal("{'a': 'it\\'s'}") == {"a": "it's"}


_keys = st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\\'\"\n\r"),
                max_size=8)
_vals = st.one_of(st.none(), st.booleans(), st.integers(-10**20, 10**20),
                  st.floats(allow_nan=False, allow_infinity=False), _keys,
                  st.tuples(st.integers(), st.integers()))
_space = st.sampled_from(["", " ", "  ", "\t"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(_keys, _vals, _space, _space), max_size=6), _space, st.booleans())
def test_fast_path_equals_literal_eval(pairs, pad, trailing_comma):
    body = ",".join(f"{a}{k!r}{b}:{a}{v!r}{b}" for k, v, a, b in pairs)
    if trailing_comma and pairs:
        body += ","
    line = f"{pad}{{{body}}}{pad}"
    assert parse_dict_literal(line) == slow(line)


def test_columns_are_read_by_the_layout_of_the_keys(monkeypatch):
    """Column batches equal the record's values; lines like the one before do not go through ``judge``."""
    import random

    import pyarrow as pa

    from viewlog.functions import parse

    rng, spellings = random.Random(3), {"Mac": ["Mac", "mac", "MAC"], "Event": ["Event", "event"], "Gone": ["Gone"]}
    lines: list[str | None] = [None, "", "{}", "[1]", "{'Mac': None, 'mac': 'a'}", "{'MAC': 1.50, 'Mac': 2, 'Mac': None}"]
    for _ in range(500):
        keys = rng.choice([("Mac", "Event"), ("event", "MAC"), ("mac", "Event"), ("Mac", "Mac")])
        lines.append("{" + ", ".join(f"{k!r}: {rng.choice([None, True, 3, 1.50, 'x', ''])!r}" for k in keys) + "}")
    want = []
    for line in lines:
        record, reason = parse.judge(line)
        if record is not None and not {"Mac", "MAC"} & set(record):
            record, reason = None, parse.NO_KEY
        row = [next((v for k in names if (v := (record or {}).get(k)) is not None), None) for names in spellings.values()]
        want.append((*row, reason, line if reason else None))
    calls, judge = [], parse.judge
    monkeypatch.setattr(parse, "judge", lambda line: (calls.append(line), judge(line))[1])
    batch = pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
    (judged,) = parse._judged_batches(iter([batch]), spellings, ("Mac", "MAC"))
    assert list(zip(*judged.to_pydict().values())) == want
    (kept,) = parse._column_batches(iter([batch]), spellings, ("Mac", "MAC"))
    assert list(zip(*kept.to_pydict().values())) == [w[:3] for w in want if w[3] is None]
    assert len(calls) < 50
