"""BPE encoding and decoding by a tokenization automaton.

The automaton's arcs carry tokens; the state an arc leads to depends only on
its token. It is built by adding one gadget per merge ``(u, v) -> w``, in
order: the state that ``u`` leads to is replaced by a copy without its ``v``
arc, and every state with a ``u`` arc gets a ``w`` arc to where ``v`` led. Each
string then has exactly one path, and that path spells its BPE tokens. Copies
are not stored: a state is the chain of cuts it inherited, so the table of cut
arcs (one per merge, with its number) answers whether an arc exists.

A word is encoded left to right: for each position the one token that ends a
path there is looked up, so the work is the word's length times the longest
token, for words of any length. Decoding emits the arcs' labels.

The tokenizer file is read on the driver and broadcast (its size is that of the
vocabulary); nothing else leaves a task. Word results are cached in a bounded
dictionary.

Defined results: a null text counts as empty (no tokens, empty decoded text);
every row gives one row, repeated rows too; a text longer than any batch is
handled whole; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog.llm.common import map_batches

#: White space that ends every word, and characters that only str.split() takes for white space.
_SEPARATORS = regex.compile(r"[\x20\x09-\x0D]+")
_ODD = regex.compile(r"[\x1c-\x1f]")

#: Words, runs and arcs remembered per worker; fewer only cost recomputation.
CACHE_WORDS = 200_000
CACHE_ARCS = 250_000
_NEVER = 1 << 62


def byte_letters() -> list[str]:
    """The printable stand-in for each byte: printable Latin-1 stands for itself, the rest follow from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, nxt = [], 0x100
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(nxt))
            nxt += 1
    return out


class Automaton:
    """Arcs and cut arcs compiled from a merge list; tokens are integers."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = "") -> None:
        self.suffix = suffix
        self.labels = {i: t for t, i in vocab.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.cut: dict[int, dict[int, int]] = {}  # by state, the merge that cut each arc
        made = {a + b for a, b in merges}
        self.arcs = {t: i for t, i in vocab.items() if t not in made}
        for i, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            for part in (a, b):
                if part in made and vocab[part] not in self.born:
                    raise ValueError(f"merge {i} uses {part!r} before it is made")
            self.left[w], self.right[w], self.born[w] = u, v, i
            if self._open(u, v):
                self.arcs[a + b] = w
            self.cut.setdefault(u, {})[v] = i
        stem = max((len(t.removesuffix(suffix)) if suffix else len(t)) for t in self.arcs)
        self.longest = stem + 1
        self._known: dict[tuple[int, int], bool] = {}

    def _open(self, state: int, token: int) -> bool:
        """Whether the state after ``state`` has an arc ``token``.

        A cut ``(r, x)`` holds for a state that inherited from ``r`` before the
        cut is made (strictly), and for an arc built from ``x`` after it.
        """
        inherited, built = [], []
        x, until = token, _NEVER
        while x is not None:
            built.append((x, until))
            x, until = self.left.get(x), self.born.get(x)
        x, until = state, _NEVER
        while x is not None:
            if x in self.cut:
                inherited.append((self.cut[x], until))
            x, until = self.right.get(x), self.born.get(x)
        for cuts, r_until in inherited:
            for x, x_until in built:
                at = cuts.get(x)
                if at is not None and at < r_until and at <= x_until:
                    return False
        return True

    def step(self, state: int, token: int) -> bool:
        known = self._known.get((state, token))
        if known is None:
            if len(self._known) >= CACHE_ARCS:
                self._known.clear()
            known = self._known[state, token] = self._open(state, token)
        return known

    def encode(self, letters: str) -> list[int]:
        """Tokens of one word given as byte letters.

        Follows the longest arc first. A position reached by a path has one
        path only, so one that leads nowhere is left for good and each position
        is tried once.
        """
        n, arcs, known, longest, suffix = len(letters), self.arcs, self._known, self.longest, self.suffix
        path: list[int] = []
        ends = [0]
        dead: set[int] = set()
        at, stop = 0, min(n, longest)
        while at < n:
            while stop > at:
                token = arcs.get(letters[at:stop] + suffix if stop == n else letters[at:stop])
                if token is not None and stop not in dead:
                    if not path:
                        break
                    open_ = known.get((path[-1], token))
                    if open_ or open_ is None and self.step(path[-1], token):
                        break
                stop -= 1
            if stop > at:
                path.append(token)
                ends.append(stop)
                at, stop = stop, min(n, stop + longest)
            elif path:
                dead.add(at)
                path.pop()
                stop = ends.pop() - 1
                at = ends[-1]
            else:
                raise ValueError(f"no path spells {letters!r}")
        return path


class Codec:
    """Encoder and decoder for a tokenizer file with word ends.

    Supports what ``word_bpe_49k.json`` uses: NFC and lower case, a split by
    one pattern whose matches are the words, byte letters, BPE with a word-end
    suffix, added tokens found verbatim in the raw text.
    """

    def __init__(self, spec: str) -> None:
        conf = json.loads(spec)
        model = conf["model"]
        split = next(p for p in conf["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        if model["type"] != "BPE" or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("unsupported tokenizer file")
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.added = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.labels = self.automaton.labels | {i: t for t, i in self.added.items()}
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.letters = byte_letters()
        self.cache: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _spelled(self, word: str) -> bytes:
        letters = word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode()])
        ids = self.automaton.encode(letters)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        packed = self.cache[word] = self._spelled(word)
        return packed

    def _run(self, run: str) -> bytes:
        """The words of a run between white space."""
        cache, word, words = self.cache, self._word, self.words.findall(run)
        if len(words) == 1 and len(run) <= 64 and words[0] == run:  # remembered once, as a run
            packed = cache.get(run) or self._spelled(run)
        else:
            packed = b"".join([cache.get(w) or word(w) for w in words])
        if len(run) <= 64:
            if len(self.runs) >= CACHE_WORDS:
                self.runs.clear()
            self.runs[run] = packed
        return packed

    def _plain(self, text: str) -> list[bytes]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma: letters one by one
        # No word spans white space. split() also cuts at U+001C to U+001F, which are words' characters here.
        runs, run = self.runs, self._run
        pieces = _SEPARATORS.split(text.lower()) if _ODD.search(text) else text.lower().split()
        out = []
        for p in pieces:
            packed = runs.get(p)
            out.append(run(p) if packed is None else packed)
        return out

    def encode(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.cuts is None or not self.cuts.search(text):
            return b"".join(self._plain(text))
        out: list[bytes] = []
        for piece in self.cuts.split(text):
            if piece in self.added:
                out.append(struct.pack("<I", self.added[piece]))
            elif piece:
                out += self._plain(piece)
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """Labels of the arcs, as a tokenizer without a decoder joins them."""
        return " ".join(map(self.labels.__getitem__, struct.unpack(f"<{len(packed) // 4}I", packed)))


_CODECS: dict[str, Codec] = {}


def codec(spec: str) -> Codec:
    """The compiled codec, once per worker process."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def _spec(df: DataFrame, path: str):
    """The tokenizer file's text as a broadcast value."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: each text's token ids as little-endian 32-bit integers."""
    spec = _spec(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # keeps a batch's ids near its texts in size
                part = batch.slice(at, 256)
                ids = [c.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return map_batches(_rows(docs, id_col, text_col), run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of ``encode``'s rows: the token labels, joined by spaces."""
    spec = _spec(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [c.decode(ids or b"") for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode, decode and digest in one pass over the texts."""
    spec = _spec(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec.value)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column("text"):
                ids = c.encode(text.as_py())
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(_rows(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
