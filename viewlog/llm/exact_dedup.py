"""Exact duplicates by composable polynomial fingerprints.

A text's fingerprint is its bytes read as a number in base 256, modulo two
30-bit safe primes. Two adjoining pieces combine by length-shifted
arithmetic: ``H(ab) = H(a) * 256**len(b) + H(b)``, so the chunks of a huge
text are hashed by different tasks and folded afterwards. Texts with equal
fingerprint and length are then compared chunk by chunk with their group's
representative; those that differ (a collision) are regrouped by SHA-256.

Only fingerprints (about 100 bytes a document) are shuffled for everyone;
text moves only for documents whose fingerprint occurs more than once. A hot
group is compared in salted slices, each with its own copy of the
representative's chunks.

Defined results: a null text counts as empty; empty texts equal each other;
rows that repeat both id and text form a group of which one row is kept; a
null id sorts before all others; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog.llm.common import byte_texts, map_batches, small, written

#: The two largest safe primes below 2**30: 256 generates a subgroup of at least (p - 1) / 2 elements.
PRIMES = (1073740439, 1073740127)
CHUNK_BYTES = 1 << 20
#: Members of a group that one slice compares with the representative.
SLICE_ROWS = 256

PRINT = ["h1", "h2", "n_bytes"]


def chunk_print(chunk: bytes, primes: tuple[int, int] = PRIMES) -> tuple[int, int, int, int]:
    """(hash, shift) of a chunk for each prime."""
    number = int.from_bytes(chunk, "big")
    p, q = primes
    return number % p, pow(256, len(chunk), p), number % q, pow(256, len(chunk), q)


def _normal(text: bytes | None) -> bytes:
    return (text or b"").lower()  # bytes.lower() changes A-Z only


_PRINTS = ("uid long, id long, text_sha256 string, n_bytes long, pos int, "
           "h1 long, s1 long, h2 long, s2 long, chunk binary")


def _fingerprint(batches: Iterator[pa.RecordBatch], chunk_bytes: int, primes: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """One row per document; a longer text gives one row per chunk, still to be hashed."""
    schema = pa.schema([("uid", pa.int64()), ("id", pa.int64()), ("text_sha256", pa.string()), ("n_bytes", pa.int64()),
                        ("pos", pa.int32()), ("h1", pa.int64()), ("s1", pa.int64()), ("h2", pa.int64()),
                        ("s2", pa.int64()), ("chunk", pa.binary())])
    for batch in batches:
        rows, held = [], 0
        for uid, key, text in zip(batch.column("uid").to_pylist(), batch.column("id").to_pylist(),
                                  byte_texts(batch.column("text"))):
            data = _normal(text)
            sha = hashlib.sha256(data).hexdigest()
            if len(data) <= chunk_bytes:
                rows.append((uid, key, sha, len(data), 0, *chunk_print(data, primes), None))
                continue
            for pos, at in enumerate(range(0, len(data), chunk_bytes)):
                rows.append((uid, key, sha, len(data), pos, None, None, None, None, data[at:at + chunk_bytes]))
                held += chunk_bytes
                if held > 32 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _hash_chunks(batches: Iterator[pa.RecordBatch], primes: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [chunk_print(c, primes) for c in batch.column("chunk").to_pylist()]
        h1, s1, h2, s2 = (pa.array([p[i] for p in prints], pa.int64()) for i in range(4))
        keep = [batch.column(c) for c in ("uid", "id", "text_sha256", "n_bytes", "pos")]
        yield pa.RecordBatch.from_arrays([*keep, h1, s1, h2, s2],
                                         names=["uid", "id", "text_sha256", "n_bytes", "pos", "h1", "s1", "h2", "s2"])


def _folded(parts: DataFrame, primes: tuple[int, int]) -> DataFrame:
    """Chunk hashes of each text folded in order by the length-shifted sum."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "h1", "s1", "h2", "s2")))

    def fold(h: str, s: str, p: int):
        return F.aggregate("parts", F.lit(0).cast("long"), lambda acc, x: (acc * x[s] + x[h]) % F.lit(p).cast("long"))

    return (parts.groupBy("uid", "id", "text_sha256", "n_bytes").agg(ordered.alias("parts"))
            .select("uid", "id", "text_sha256", "n_bytes",
                    fold("h1", "s1", primes[0]).alias("h1"), fold("h2", "s2", primes[1]).alias("h2")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 chunk_bytes: int = CHUNK_BYTES, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """``uid, id, text_sha256, n_bytes, h1, h2``: one row per row of ``docs``, written once."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).cast("string").alias("text"))
    first = written(map_batches(rows, partial(_fingerprint, chunk_bytes=chunk_bytes, primes=primes), _PRINTS), "prints")
    whole = first.where("chunk is null").select("uid", "id", "text_sha256", *PRINT[2:], "h1", "h2")
    # One row per chunk, dealt out evenly: the chunks of one text go to different tasks.
    chunks = first.where("chunk is not null").select("uid", "id", "text_sha256", "n_bytes", "pos", "chunk")
    hashed = map_batches(chunks.repartition("uid", "pos"), partial(_hash_chunks, primes=primes),
                         "uid long, id long, text_sha256 string, n_bytes long, pos int, h1 long, s1 long, h2 long, s2 long")
    return whole.unionByName(_folded(hashed, primes))


_CHUNKS = "id long, h1 long, h2 long, n_bytes long, rep_id long, size long, pos int, chunk binary"


def _cut(batches: Iterator[pa.RecordBatch], chunk_bytes: int, primes: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Chunks of the texts whose fingerprint is the one looked for."""
    schema = pa.schema([("id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("n_bytes", pa.int64()),
                        ("rep_id", pa.int64()), ("size", pa.int64()), ("pos", pa.int32()), ("chunk", pa.binary())])

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    names = ("id", "h1", "h2", "n_bytes", "rep_id", "size")
    for batch in batches:
        rows, held = [], 0
        for text, *key in zip(byte_texts(batch.column("text")), *(batch.column(c).to_pylist() for c in names)):
            data = _normal(text)
            if len(data) != key[3]:
                continue
            pieces = [data[at:at + chunk_bytes] for at in range(0, max(1, len(data)), chunk_bytes)]
            h1 = h2 = 0
            for piece in pieces:
                a, s, b, t = chunk_print(piece, primes)
                h1, h2 = (h1 * s + a) % primes[0], (h2 * t + b) % primes[1]
            if [h1, h2] != key[1:3]:
                continue  # another text under the same id
            for pos, piece in enumerate(pieces):
                rows.append((*key, pos, piece))
                held += len(piece)
                if held > 32 << 20:
                    yield out(rows)
                    rows, held = [], 0
        if rows:
            yield out(rows)


def _differing(docs: DataFrame, groups: DataFrame, prints: DataFrame, id_col: str, text_col: str,
               chunk_bytes: int, primes: tuple[int, int]) -> DataFrame:
    """``id, h1, h2, n_bytes`` of rows whose text is not their representative's."""
    suspects = written(prints.join(groups, PRINT).select("id", *PRINT, "rep_id", "size").distinct(), "suspects")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = rows.alias("r").join(small(suspects).alias("s"), F.col("r.id").eqNullSafe(F.col("s.id")))
    found = found.select("s.id", "text", "h1", "h2", "n_bytes", "rep_id", "size")
    chunks = written(map_batches(found, partial(_cut, chunk_bytes=chunk_bytes, primes=primes), _CHUNKS), "chunks")
    slices = F.ceil(F.col("size") / SLICE_ROWS).cast("int")
    members = chunks.withColumn("slice", F.pmod(F.xxhash64("id"), slices).cast("int"))
    models = (chunks.where(F.col("id").eqNullSafe(F.col("rep_id")))
              .groupBy(*PRINT, "pos", "size").agg(F.min("chunk").alias("model"))
              .withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("size"))
    return (members.join(models, [*PRINT, "pos", "slice"], "left")
            .where("model is null or chunk != model").select("id", *PRINT).distinct())


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     chunk_bytes: int = CHUNK_BYTES, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; of equal texts the
    row with the largest id stays.
    """
    prints = written(fingerprints(docs, id_col, text_col, chunk_bytes, primes), "fingerprints")
    best = F.max(F.struct("id", "uid"))
    groups = (prints.groupBy(*PRINT).agg(F.count("*").alias("size"), best.alias("best"))
              .select(*PRINT, "size", F.col("best.id").alias("rep_id")).where("size > 1"))
    differ = written(_differing(docs, written(groups, "groups"), prints, id_col, text_col, chunk_bytes, primes), "differ")
    # Collisions are told apart by SHA-256; everyone else's class is the compared fingerprint.
    on = [F.col("p.id").eqNullSafe(F.col("d.id")), *(F.col(f"p.{c}") == F.col(f"d.{c}") for c in PRINT)]
    classes = (prints.alias("p").join(differ.withColumn("odd", F.lit(True)).alias("d"), on, "left")
               .select("p.*", F.when(F.col("odd"), F.col("p.text_sha256")).otherwise("").alias("apart")))
    key = [*PRINT, "apart"]
    # Only texts with copies need their group; as a table of its own it joins by broadcast or skew-split.
    final = classes.groupBy(*key).agg(F.count("*").alias("group_size"), best.alias("best")).where("group_size > 1")
    return classes.join(written(final, "classes"), key, "left").select(
        F.col("id").alias("doc_id"), F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("uid") == F.col("best.uid"), F.lit(True)).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that repeat a text that stays, all columns as they were."""
    found = written(exact_duplicates(docs, id_col, text_col), "verdicts")
    ids = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("long")).alias("k"))
    ids = written(ids.where("k < n").withColumnRenamed("doc_id", "_id"), "dropped")
    own = F.col(id_col).cast("long").eqNullSafe(F.col("_id"))
    kept = docs.join(small(ids.select("_id")), own, "left_anti")
    odd = ids.where("k > 0").select("_id")
    if not odd.limit(1).count():
        return kept
    # Ids with several rows of which some go: told apart by the digest of their texts.
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    sha = F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), letters, letters.lower()), 256)
    stay = found.where("kept").select(F.col("doc_id").alias("_kid"), F.col("text_sha256").alias("_ksha")).distinct()
    rows = docs.join(small(odd), own, "left_semi").withColumn("_sha", sha)
    rows = rows.join(stay, F.col(id_col).cast("long").eqNullSafe(F.col("_kid")) & (F.col("_sha") == F.col("_ksha")), "left_semi")
    return kept.unionByName(rows.dropDuplicates([id_col, "_sha"]).select(*docs.columns))
