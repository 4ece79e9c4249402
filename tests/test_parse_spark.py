"""The Spark UDF path (Arrow batches, map output) equals the Python parser line by line."""

from __future__ import annotations

import random

from viewlog.functions.parse import parse_dict_literal, parse_records

EDGE_NUMBERS = [
    "0", "-0", "+0", "7", "-12", "+5", "123456789012345678901234567890",
    "0.0", "-0.0", "+0.0", "1.50", "570.30", "100.0", "0.0001", "0.00010", "0.00001",
    "-0.000123", "123456789012345.0", "1234567890123456.0", "9999999999999999.0",
    "10000000000000000.0", "0.123456789012345", "0.1234567890123456", "1.000000000000001",
    "3.14159265358979", "2.718281828459045", "1000000000000000.0", "0.30000000000000004",
    "4.35", "0.1", "1e3", "1.5e-7", "007", "0x1F", "1_000",
]
EDGE_LINES = [
    "{}", "{ }", "  {'a': 1}  ", "\t{'a': 'b'}\t", "{'a': 1,}", "{'a': 1, 'a': 2}", "{'a':1,'b':None}",
    "{'a': 'x' 'y'}", "{\"k\": \"'a': 'b'\"}", "{'it''s': 1}", "{'a': True, 'b': False}",
    "{'a': (1, 2)}", "{'a': [1]}", "{1: 'x'}", "[1, 2]", "not a literal", "", "   ",
    "{'a': 'tab\there'}", "{'a': 'é ü 中'}", "{'Mac': None}", "\x0c{'a': 1}", "{'a': 1}\x0c",
    "{'a' : 1 , 'b' :2}", "{'a': -}", "{'a': 1.}", "{'a': .5}",
]


def _lines(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    keys = ["Mac", "MAC", "event", "ItemId", "x", "", "k k", "RealTimePlaying"]
    strs = ["", "VOD", " iptv ", "it\"s", "a:b", "{'x': 1}", "None", "1.5"]
    out = []
    for _ in range(n):
        pairs = []
        for _ in range(rng.randint(0, 6)):
            k = rng.choice(keys)
            kind = rng.random()
            if kind < 0.35:
                v = repr(rng.choice(strs))
            elif kind < 0.5:
                v = rng.choice(["None", "True", "False"])
            elif kind < 0.8:
                v = rng.choice(EDGE_NUMBERS)
            else:
                v = repr(round(rng.uniform(-1e6, 1e6), rng.randint(0, 8)))
            sp = rng.choice(["", " ", "\t"])
            pairs.append(f"{sp}{k!r}{sp}:{sp}{v}")
        out.append("{" + ",".join(pairs) + ("," if pairs and rng.random() < 0.1 else "") + "}")
    return out


def test_udf_agrees_with_python(spark):
    lines = EDGE_LINES + [f"{{'v': {n}}}" for n in EDGE_NUMBERS] + _lines(7, 3000)
    df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    recs = [r["rec"] for r in parse_records(df).collect()]  # one partition: order kept
    got = dict(enumerate(recs))
    bad = [(lines[i], got[i], parse_dict_literal(lines[i]))
           for i in range(len(lines)) if got[i] != parse_dict_literal(lines[i])]
    assert not bad, bad[:5]
