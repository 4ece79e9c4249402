from __future__ import annotations

import os
import random
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import data
from viewlog.llm import token_files
from viewlog.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text: str | None) -> list[int]:
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def packed(text: str | None) -> bytes:
    ids = ids_of(text)
    return struct.pack(f"<{len(ids)}I", *ids)


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def expected(rows):
    """(doc_id, n_tokens, crc32) in file order, except among rows that share an id."""
    return [(r[0], len(ids_of(r[1])), zlib.crc32(packed(r[1]))) for r in by_id(rows)]


def test_query_against_the_library(spark):
    got = sorted(token_files.digests(data.docs(spark), PATH).collect(), key=lambda r: r.start)
    want = expected(data.rows())
    assert [r.doc_id for r in got] == [w[0] for w in want]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_empty_table(spark, tmp_dir):
    assert token_files.digests(data.empty(spark), PATH).collect() == []
    token_files.write(data.empty(spark), f"{tmp_dir}/files", PATH)
    assert token_files.lookup(spark, f"{tmp_dir}/files", spark.range(3), "id").collect() == []


@pytest.fixture()
def files(spark, tmp_dir):
    token_files.write(data.docs(spark), f"{tmp_dir}/files", PATH, shard_bytes=1 << 14)
    return f"{tmp_dir}/files"


def test_files_hold_the_ids(spark, files):
    manifest = token_files.read_manifest(spark, files).collect()
    assert len(manifest) > 8 and sum(m.n_docs for m in manifest) == len(data.rows())
    for m in manifest:
        assert os.path.getsize(f"{files}/{m.file}") == m.n_bytes
    got = {(r.doc_id, bytes(r.ids)) for r in token_files.read(spark, files).collect()}
    assert got == {(r[0], packed(r[1])) for r in data.rows()}


def test_lookup_reads_single_documents(spark, files):
    whole = {(r.doc_id, r.start): bytes(r.ids) for r in token_files.read(spark, files).collect()}
    asked = spark.createDataFrame([(3,), (3,), (44,), (10**12,), (None,), (0,)], "doc_id long")
    got = {(r.doc_id, r.start): bytes(r.ids) for r in token_files.lookup(spark, files, asked).collect()}
    assert got == {k: v for k, v in whole.items() if k[0] in (0, 3, 44)}
    assert len(got) == 1 + 3 + 2  # ids 3 and 44 repeat in the table


def test_many_rows_of_one_id_span_shards(spark, tmp_dir):
    rng = random.Random(1)
    rows = [(7 if i % 3 else i, data.prose(rng, 20), "en", "s", 0, *"abcdefg") for i in range(600)]
    token_files.write(data.docs(spark, rows), f"{tmp_dir}/f", PATH, shard_bytes=1 << 12)
    got = sorted(token_files.read(spark, f"{tmp_dir}/f").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows)
    assert {m.file for m in token_files.read_manifest(spark, f"{tmp_dir}/f").where("first_id <= 7 and last_id >= 7").collect()}.__len__() > 3
    assert token_files.lookup(spark, f"{tmp_dir}/f", spark.createDataFrame([(7,)], "doc_id long")).count() == sum(r[0] == 7 for r in rows)


def test_unreferenced_files_do_not_count(spark, files):
    """What a lost task leaves behind is not read."""
    before = token_files.read(spark, files).count()
    name = token_files.read_manifest(spark, files).first().file
    with open(f"{files}/{name}", "rb") as f, open(f"{files}/shard-000000-{'0' * 32}.tokz", "wb") as copy:
        copy.write(f.read()[:-7])
    assert token_files.read(spark, files).count() == before


def test_other_dictionary_is_an_error(spark, files):
    with open(f"{files}/dictionary.bin", "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read(spark, files).collect()


def test_shared_dictionary_saves_space(spark, tmp_dir):
    import zstandard

    rng = random.Random(5)
    texts = [data.prose(rng, 30) for _ in range(800)]
    token_files.write(data.simple(spark, texts), f"{tmp_dir}/f", PATH)
    stored = sum(m.n_bytes - 38 - 20 - 25 * m.n_docs for m in token_files.read_manifest(spark, f"{tmp_dir}/f").collect())
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(struct.pack(f"<{len(ids_of(t))}H", *ids_of(t)))) for t in texts)
    assert os.path.getsize(f"{tmp_dir}/f/dictionary.bin") > 0
    assert stored < 0.9 * alone


with open(PATH, encoding="utf-8") as f:
    ENCODER = token_files.Encoder(f.read(), 0)


def unpacked(ids: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(ids) // 2}H", ids))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcXYé日 '  \n\t\r1290!?.-_<|>"), max_size=80), st.integers(1, 12))
def test_pieces_do_not_change_the_ids(text, size):
    ids = [i for p in token_files.pieces(text, size) for i in LIBRARY.encode(p, add_special_tokens=False).ids]
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=1000, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(st.sampled_from("abé'st-(9<|> \x1c\x1f\x85\xa0\u1680\u2003\u2028\u202f\u3000\u200b\ufeff \n\r\t\x0b1½.日"), max_size=40)))
def test_chunks_do_not_change_the_ids(text):
    assert unpacked(ENCODER([text])[0]) == ids_of(text)


def test_every_white_space_character():
    import sys

    for c in map(chr, range(sys.maxunicode + 1)):
        if c.isspace() or c in "\u180e\u200b\u2060\ufeff":
            for text in (f"a{c}b", f"a{c}{c}b", f"a{c} b", f"a {c}b", f"{c}a{c}", f"a{c}!b", f"{c}1{c} "):
                assert unpacked(ENCODER([text])[0]) == ids_of(text), (text, hex(ord(c)))


def test_long_texts_and_a_full_store(monkeypatch):
    monkeypatch.setattr(token_files, "PIECE_CHARS", 500)
    monkeypatch.setattr(token_files, "HELD", 20)
    text = data.prose(random.Random(2), 3_000) + " <|endoftext|> it's\n\n x" + "y" * 2_000
    monkeypatch.setattr(token_files, "GROUP_CHARS", 700)
    texts = [text, None, "", "<|endoftext|>", "a<|endoftext|> b", text]
    assert [unpacked(x) for x in ENCODER(texts)] == [ids_of(t) for t in texts]
