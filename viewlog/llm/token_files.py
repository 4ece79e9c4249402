"""Token-id files: zstandard frames under one shared dictionary, with an offset index.

``write`` encodes every text, appends an end id, and writes the ids in ascending
``doc_id`` order as shard files in a shared folder. Every document is a
zstandard frame of its own, compressed with a dictionary trained on the
serialized id arrays of a sample, so that one short document can be read
without its neighbours and still compresses well.

Shard file (all numbers little-endian)::

    "TOKZ", version (u8), bytes of an id (u8), SHA-256 of the dictionary (32)
    frames, one after the other
    index: a row per document: doc_id (i64), has_id (u1), offset (u64), n_ids (u64)
    offset of the index (u64), documents (u64), "TOKZ"

Beside the shards lie ``dictionary.bin`` and a Parquet table ``manifest``, one
row per shard: file, documents, ids, first and last ``doc_id``. A task writes
its shard under a name of its own and the manifest, committed by Spark, names
only the files of tasks that succeeded: a lost executor or a speculative copy
leaves a file that nothing refers to.

Texts are encoded and compressed where they are read; only frames are
shuffled, each straight to its shard (range limits come from the ids alone).
The tokenizer must split texts as byte-level BPE does: at white space, each
blank going with the word behind it. A worker keeps the ids of the chunks it
has met. A very long text is taken in pieces, cut where an ASCII character, a
blank or line end and an ASCII letter follow each other; stretches without
such a place are taken whole.

Defined results: a null text counts as empty and gives the end id alone; null
ids come first; rows that repeat an id lie next to each other, in any order,
and may span shards; an empty table gives an empty manifest and no files;
other columns are ignored. A dictionary whose hash is not that of the shard is
an error. The folder must be one that ``pyarrow.fs`` opens (local, HDFS, S3,
GCS) on all executors.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import operator
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewlog.llm.common import map_batches, row_slices, work_path

MAGIC, VERSION = b"TOKZ", 1
HEAD_BYTES = 4 + 1 + 1 + 32
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("n_ids", "<u8")])

#: The dictionary: its size, and the sample it is trained on (documents with the least id hashes, each up to so many characters).
DICTIONARY_BYTES = 112_640
SAMPLE_DOCS, SAMPLE_CHARS = 1_000, 8_192
LEVEL = 3
#: Text that a shard holds, roughly.
SHARD_BYTES = 128 << 20
#: Text that is cut, and encoded, at a time.
PIECE_CHARS, GROUP_CHARS = 1 << 20, 3 << 20

#: Chunks whose ids a worker keeps.
HELD = 700_000

_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # fixed values: Unicode White_Space
_CHUNK = re.compile(rf" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
#: Latin letters that ASCII punctuation, a digit or the end follows: no token goes beyond.
_WORD = re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+(?=[!-@\[-`{-~]|\Z)")
_CUT = re.compile(r"(?<=[!-~])[ \n](?=[A-Za-z])")

MANIFEST = "shard int, file string, n_docs long, n_ids long, n_bytes long, first_id long, last_id long"


def _filesystem(path: str):
    """The file system of a qualified path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, so that executors read it as the driver does."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _byte_letters() -> str:
    """The letter that byte-level BPE writes for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return "".join(chr(b if b in plain else next(others)) for b in range(256))


class Encoder:
    """The library's tokenizer; ids as packed integers of ``width`` bytes.

    Chunks are what a byte-level tokenizer's splitting never joins:
    non-white-space with at most one blank before it, or white space. Their ids
    are kept. Of new chunks, leading words go to the library's BPE model
    together, as one text of lines; what follows them goes to the whole tokenizer.
    """

    def __init__(self, spec: str, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        known = json.loads(spec)
        split = known.get("pre_tokenizer") or {}
        if known.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("token files need a tokenizer that only splits as byte-level BPE does")
        self.width = 2 if max(self.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.end = np.array([end_id], self.kind).tobytes()
        self.letters = _byte_letters()
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Split(self.letters[10], "isolated")
        self.line_end = self.tokenizer.token_to_id(self.letters[10])
        self.known: dict[str, bytes] = {}
        self.rests: dict[str, bytes] = {"": b""}

    def _words(self, words: list[str]) -> list[bytes]:
        text = "\n".join(words).encode().decode("latin-1").translate(self.letters)
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
        data, ends = ids.tobytes(), (np.flatnonzero(ids == self.line_end) * self.width).tolist()
        return [data[a:b] for a, b in zip([0, *(e + self.width for e in ends)], [*ends, len(data)])]

    def _rests(self, rests: list[str]) -> list[bytes]:
        new = list({r for r in rests if r not in self.rests})
        for r, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self.rests[r] = np.array(e.ids, self.kind).tobytes()
        return list(map(self.rests.__getitem__, rests))

    def _learn(self, chunks: list[str]) -> list[bytes]:
        if len(self.known) > HELD:
            self.known.clear()
        if len(self.rests) > HELD:
            self.rests = {"": b""}
        words = [m[0] if (m := _WORD.match(c)) else "" for c in chunks]
        rests = self._rests([c[len(w):] for c, w in zip(chunks, words)])
        ids = list(map(operator.add, self._words(words), rests))
        self.known.update(zip(chunks, ids))
        return ids

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks."""
        ids = list(map(self.known.get, chunks))
        new = [k for k, i in enumerate(ids) if i is None]
        if new:
            for k, i in zip(new, self._learn([chunks[k] for k in new])):
                ids[k] = i
        return ids

    def _group(self, group: list[str]) -> list[bytes]:
        """The ids of each of a group of texts: every distinct chunk is looked up once, then gathered by its places."""
        found = [pa.array(_CHUNK.findall(t), pa.large_string()) for t in group]
        coded = pa.concat_arrays(found).dictionary_encode()
        ids = pa.array(self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        offsets = np.frombuffer(ids.buffers()[1], np.int64)[:len(ids) + 1]
        ends = offsets[np.cumsum([0, *map(len, found)])].tolist()
        data = ids.buffers()[2].to_pybytes() if ends[-1] else b""
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The packed ids of each text with the end id."""
        out: list[list[bytes]] = [[] for _ in texts]
        owners, group, held = [], [], 0
        for i, text in enumerate(texts):
            for piece in pieces(text or ""):
                owners.append(i)
                group.append(piece)
                held += len(piece)
                if held >= GROUP_CHARS:
                    for k, ids in zip(owners, self._group(group)):
                        out[k].append(ids)
                    owners, group, held = [], [], 0
        if group:
            for k, ids in zip(owners, self._group(group)):
                out[k].append(ids)
        return [b"".join([*parts, self.end]) for parts in out]


def pieces(text: str, size: int | None = None) -> Iterator[str]:
    """Parts of a text of at least ``size`` characters, cut where no token can cross."""
    size, at = size or PIECE_CHARS, 0
    while at < len(text):
        cut = _CUT.search(text, at + size)
        stop = cut.start() if cut else len(text)
        yield text[at:stop]
        at = stop


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(spec: str, end_id: int) -> Encoder:
    key = (hashlib.sha256(spec.encode()).hexdigest(), end_id)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec, end_id)
    return _ENCODERS[key]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def train_dictionary(docs: DataFrame, spec, end_id: int, size: int = DICTIONARY_BYTES,
                     sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> bytes:
    """A zstandard dictionary over serialized id arrays of a bounded sample of ``docs`` (doc_id, text).

    The sample is found by the ids alone; at most ``sample_docs`` arrays of
    at most ``sample_chars`` characters' ids reach the driver. Samples too small
    to train on become a dictionary of plain content; without any, it is empty.
    """
    import zstandard

    place = F.xxhash64("doc_id")
    limit = docs.select(place.alias("h")).orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    if limit is None:
        return b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(spec.value, end_id)
        for batch in batches:
            for part in row_slices(batch, "text", GROUP_CHARS):
                yield pa.RecordBatch.from_arrays([pa.array(encode(part.column(0).to_pylist()), pa.binary())], names=["ids"])

    sample = docs.where(place <= limit).limit(sample_docs).select(F.substring("text", 1, sample_chars).alias("text"))
    samples = [bytes(r.ids) for r in map_batches(sample, run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        plain = b"".join(samples)[-size:]
        return plain if len(plain) >= 8 else b""  # the library takes no shorter content


def _compression(dictionary: bytes) -> dict:
    import zstandard

    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def _limits(docs: DataFrame, shards: int) -> list[tuple]:
    """The least (doc_id, row) of each shard but the first, from the ids alone."""
    slim = docs.select("doc_id", F.monotonically_increasing_id().alias("uid")).repartitionByRange(shards, "doc_id", "uid")
    least = (slim.select(F.spark_partition_id().alias("part"), F.struct("doc_id", "uid").alias("row"))
             .groupBy("part").agg(F.min("row").alias("row")).select("row.*").collect())
    return sorted(_order(r.doc_id, r.uid) for r in least)[1:]


def _order(doc_id: int | None, uid: int) -> tuple:
    return (doc_id is not None, doc_id or 0, uid)


def frames(docs: DataFrame, spec, end_id: int, dictionary: bytes, limits: list[tuple]) -> DataFrame:
    """``shard, doc_id, uid, n_ids, frame``: every document of ``docs`` (doc_id, text) encoded and compressed, unsorted."""
    limits = docs.sparkSession.sparkContext.broadcast(limits)  # one per shard
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encode = _encoder(spec.value, end_id)
        packer = zstandard.ZstdCompressor(level=LEVEL, **_compression(shared.value))
        bounds = limits.value
        for batch in batches:
            for part in row_slices(batch, "text", GROUP_CHARS):
                keys, uids = part.column("doc_id"), part.column("uid")
                shard = [bisect.bisect_right(bounds, _order(k, u)) for k, u in zip(keys.to_pylist(), uids.to_pylist())]
                ids = encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), keys, uids, pa.array([len(x) // encode.width for x in ids], pa.int64()),
                     pa.array(map(packer.compress, ids), pa.binary())],
                    names=["shard", "doc_id", "uid", "n_ids", "frame"])

    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("uid"))
    return map_batches(rows, run, "shard int, doc_id long, uid long, n_ids long, frame binary")


def _shard_writer(folder: str, width: int, digest: bytes):
    """Writes the sorted rows of a task as one file; returns its manifest row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, index, n_ids, shard = None, HEAD_BYTES, [], 0, TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.tokz"
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs, path = _filesystem(f"{folder}/{name}")
                out = fs.open_output_stream(path)
                out.write(MAGIC + bytes([VERSION, width]) + digest)
            keys = batch.column("doc_id")
            part = np.zeros(batch.num_rows, INDEX)
            part["doc_id"] = keys.fill_null(0).to_numpy(zero_copy_only=False)
            part["has_id"] = keys.is_valid().to_numpy(zero_copy_only=False)
            part["n_ids"] = batch.column("n_ids").to_numpy()
            for i, frame in enumerate(batch.column("frame")):
                data = frame.as_buffer()
                part["offset"][i] = at
                out.write(data)
                at += data.size
            index.append(part)
            n_ids += int(part["n_ids"].sum())
        if out is None:
            return
        table = np.concatenate(index)
        out.write(table.tobytes() + at.to_bytes(8, "little") + len(table).to_bytes(8, "little") + MAGIC)
        out.close()
        known = table["doc_id"][table["has_id"] == 1]
        row = [shard, name, len(table), n_ids, at + table.nbytes + 20, *((int(known[0]), int(known[-1])) if len(known) else (None, None))]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.string(), *[pa.int64()] * 5])],
                                         names=["shard", "file", "n_docs", "n_ids", "n_bytes", "first_id", "last_id"])

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the token ids of ``docs`` under ``path``, a new folder; returns the manifest."""
    spark = docs.sparkSession
    folder = _qualified(spark, path)
    docs = _rows(docs, id_col, text_col)
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    spec = spark.sparkContext.broadcast(text)
    dictionary = train_dictionary(docs, spec, end_id)
    fs, place = _filesystem(folder)
    fs.create_dir(place, recursive=True)
    with fs.open_output_stream(f"{place}/dictionary.bin") as out:
        out.write(dictionary)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    width = Encoder(text, end_id).width
    rows = frames(docs, spec, end_id, dictionary, _limits(docs, shards) if shards > 1 else [])
    dealt = rows.repartitionById(shards, "shard").sortWithinPartitions("doc_id", "uid")
    manifest = map_batches(dealt, _shard_writer(folder, width, hashlib.sha256(dictionary).digest()), MANIFEST)
    manifest.write.parquet(f"{path}/manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``: the ids of all shards before each one.

    The running sum is over one row per shard, not per document.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    return rows.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


class Shard:
    """An open shard file: its index, and frames by place."""

    def __init__(self, folder: str, name: str, dictionary: bytes) -> None:
        import zstandard

        fs, path = _filesystem(f"{folder}/{name}")
        self.file = fs.open_input_file(path)
        size = self.file.size()
        head, tail = self.file.read_at(HEAD_BYTES, 0), self.file.read_at(20, size - 20)
        if head[:4] != MAGIC or tail[16:] != MAGIC or head[4] != VERSION:
            raise ValueError(f"{name} is no token file")
        if head[6:] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name} was written with another dictionary")
        self.kind = np.dtype(f"<u{head[5]}")
        self.end, n = int.from_bytes(tail[:8], "little"), int.from_bytes(tail[8:16], "little")
        self.index = np.frombuffer(self.file.read_at(n * INDEX.itemsize, self.end), INDEX)
        self.starts = np.cumsum(self.index["n_ids"].astype("i8")) - self.index["n_ids"].astype("i8")
        self.stops = np.append(self.index["offset"][1:], np.uint64(self.end)).astype("i8")
        self.unpacker = zstandard.ZstdDecompressor(**_compression(dictionary))

    def ids(self, rows: range | list[int]) -> list[bytes]:
        """The ids of the given documents as unsigned 32-bit integers; neighbours are read at once."""
        out, rows, at = [], list(rows), 0
        while at < len(rows):
            to = at + 1
            while to < len(rows) and rows[to] == rows[to - 1] + 1:
                to += 1
            first = int(self.index["offset"][rows[at]])
            data = self.file.read_at(int(self.stops[rows[to - 1]]) - first, first)
            for r in rows[at:to]:
                frame = data[int(self.index["offset"][r]) - first:int(self.stops[r]) - first]
                ids = np.frombuffer(self.unpacker.decompress(frame), self.kind)
                if len(ids) != self.index["n_ids"][r]:
                    raise ValueError("a document's ids do not match the index")
                out.append(ids.astype("<u4").tobytes())
            at = to
        return out

    def groups(self, rows: list[int], max_bytes: int = 1 << 20) -> Iterator[list[int]]:
        """``rows`` in runs of about ``max_bytes`` of ids each."""
        run, held = [], 0
        for r in rows:
            n = 4 * int(self.index["n_ids"][r])
            if run and held + n > max_bytes:
                yield run
                run, held = [], 0
            run.append(r)
            held += n
        if run:
            yield run

    def batch(self, rows: list[int], start: int) -> pa.RecordBatch:
        part = self.index[rows]
        return pa.RecordBatch.from_arrays(
            [pa.array(part["doc_id"], mask=part["has_id"] == 0), pa.array(self.starts[rows] + start),
             pa.array(part["n_ids"].astype("i8")), pa.array(self.ids(rows), pa.binary())],
            names=["doc_id", "start", "n_tokens", "ids"])


DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def _dictionary(folder: str) -> bytes:
    fs, place = _filesystem(folder)
    with fs.open_input_stream(f"{place}/dictionary.bin") as f:
        return f.read()


def read(spark: SparkSession, path: str) -> DataFrame:
    """``DOCUMENTS``: every document of the files; ids as little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before it. A task reads one
    shard at a time, a bounded stretch after the other.
    """
    folder = _qualified(spark, path)
    manifest = read_manifest(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = _dictionary(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                shard = Shard(folder, name, dictionary)
                for rows in shard.groups(range(len(shard.index))):
                    yield shard.batch(rows, start)
                shard.file.close()

    shards = max(1, spark.read.schema(MANIFEST).parquet(f"{path}/manifest").count())
    return map_batches(manifest.select("file", "start").repartition(shards), run, DOCUMENTS)


def lookup(spark: SparkSession, path: str, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``DOCUMENTS`` of the wanted ids: their frames alone are read, found through the offset index.

    An id that repeats in the files gives all its documents; one that is asked
    for twice is given once; null and unknown ids give none.
    """
    folder = _qualified(spark, path)
    wanted = ids.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    shards = read_manifest(spark, path).where("first_id is not null").orderBy("shard").collect()  # a row per shard
    firsts, lasts = [s.first_id for s in shards], [s.last_id for s in shards]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(shards[k].file, shards[k].start, i) for i in batch.column(0).to_pylist()
                    for k in range(bisect.bisect_left(lasts, i), bisect.bisect_right(firsts, i))]
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))],
                                             names=["file", "start", "doc_id"])

    asked = map_batches(wanted, place, "file string, start long, doc_id long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, shard, opened = _dictionary(folder), None, None
        for batch in batches:
            files, starts, keys = (batch.column(c).to_pylist() for c in ("file", "start", "doc_id"))
            at = 0
            while at < len(files):
                to = at
                while to < len(files) and files[to] == files[at]:
                    to += 1
                if files[at] != opened:
                    shard, opened = Shard(folder, files[at], dictionary), files[at]
                known = np.flatnonzero(shard.index["has_id"])
                places = shard.index["doc_id"][known]  # ascending
                lo, hi = np.searchsorted(places, keys[at:to], "left"), np.searchsorted(places, keys[at:to], "right")
                rows = sorted(int(known[i]) for a, b in zip(lo, hi) for i in range(a, b))
                for group in shard.groups(rows):
                    yield shard.batch(group, starts[at])
                at = to

    return map_batches(asked.repartition("file").sortWithinPartitions("file", "doc_id"), run, DOCUMENTS)


def digests(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of files written from ``docs`` into the shared work folder and read back."""
    spark = docs.sparkSession
    path = work_path(spark, "token-files")
    write(docs, path, tokenizer, end_id, id_col, text_col)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
