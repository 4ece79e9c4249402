from __future__ import annotations

import hashlib
import struct

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import data
from viewlog.llm import bpe
from viewlog.llm.common import tokenizer_path

PATH = tokenizer_path()
REFERENCE = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as f:
    CODEC = bpe.Codec(f.read())


def check(text: str) -> None:
    ids = REFERENCE.encode(text, add_special_tokens=False).ids
    packed = CODEC.encode(text)
    assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == ids
    assert CODEC.decode(packed) == REFERENCE.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("abcdehilnorstuvyABÉéèüßñΣσ'. -\n\t1290!?*<|>"), max_size=60))
def test_matches_the_library(text):
    check(text)


def test_awkward_texts():
    for text in ("", " ", "a" * 30_000, "<|endoftext|>x<|startoftext|>", "I'LL don't THEY'RE", "ΑΣ ΟΔΟΣ İ", "a\x1cb\x85c", "日本語 ½ Ⅷ ²"):
        check(text)


def test_small_merge_lists_against_rank_order():
    """The automaton against merging by rank, on lists where merges overlap."""
    merges = [("a", "a"), ("b", "a"), ("aa", "b"), ("a", "ba"), ("aa", "a"), ("aab", "aa")]
    vocab = {t: i for i, t in enumerate(["a", "b", "aa", "ba", "aab", "aba", "aaa", "aabaa"])}
    automaton = bpe.Automaton(vocab, merges)

    def by_rank(word):
        parts = list(word)
        for a, b in merges:
            out, i = [], 0
            while i < len(parts):
                if parts[i:i + 2] == [a, b]:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return [vocab[p] for p in parts]

    for n in range(1, 1 << 10):
        word = bin(n)[3:].replace("0", "a").replace("1", "b")
        assert automaton.encode(word) == by_rank(word), word


def test_queries_digests(spark):
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(data.docs(spark), PATH).collect()), key=repr)
    want = []
    for r in data.rows():
        ids = REFERENCE.encode(r[1] or "", add_special_tokens=False).ids
        text = REFERENCE.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe.digests(data.empty(spark), PATH).collect() == []


def test_encode_decode_tables(spark):
    back = bpe.decode(bpe.encode(data.docs(spark), PATH), PATH)
    want = sorted((r[0] is None, r[0] or 0, REFERENCE.decode(REFERENCE.encode(r[1] or "", add_special_tokens=False).ids, skip_special_tokens=False)) for r in data.rows())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in back.collect()) == want


def test_batches_to_python_are_small_unless_the_session_says_otherwise(spark):
    from viewlog.session import BATCH_BYTES, small_batches

    before = spark.conf.get(BATCH_BYTES)
    try:
        spark.conf.unset(BATCH_BYTES)
        small_batches(spark)
        assert spark.conf.get(BATCH_BYTES) == "4m"
        spark.conf.set(BATCH_BYTES, "9m")
        small_batches(spark)
        assert spark.conf.get(BATCH_BYTES) == "9m"
    finally:
        spark.conf.set(BATCH_BYTES, before)
