"""Toxicity by a misspelling-tolerant lexicon and context windows.

The lexicon is learned from labelled rows: word stems, and whole words of up to
three letters, that are much more frequent in toxic than in clean texts. All
terms with enough evidence enter, in any script. The lexicon becomes a trie, and
the trie intersected with the Levenshtein automaton of distance one becomes one
deterministic table: a word is read letter by letter and the state tells which
stem it starts with, exactly or, from four letters on, with one slip (the first
letter must be right). All words of a text go through the table together in
numpy. Each hit, misspelled or not, is weighed by the characters around it:
quotation marks on both sides or a reporting verb mark a quotation, direct
address or an exclamation marks abuse. A logistic model of the hit counts and
rates gives the score.

Learning uses at most ``max_toxic`` and ``max_clean`` labelled texts, chosen by
hash among the rows that are not held out, which bounds the lexicon too; a table
of more than ``MAX_TABLE_BYTES`` is an error and never cut. Scoring is one pass
over the texts without a shuffle. Only text enters the score. In scripts without
blanks a stem is found where a run of letters starts.

Defined results: a null or empty text has no hits and gets the score of none;
a document without a label is scored alike; labels that are null or repeated
count once by their largest value; without usable labels of both kinds every
score is 0; repeated rows are scored separately; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlog.llm.common import map_batches, small, written

MAX_TOXIC = 4000
MAX_CLEAN = 8000
#: The table goes to every executor, so its size is checked.
MAX_TABLE_BYTES = 256 << 20
STEM_LETTERS = range(4, 10)
#: Twice the log likelihood ratio that a term's frequencies differ by label, and the least log odds.
EVIDENCE = 25.0
ODDS = 1.5
#: Ends a term that is a whole word.
END = "\n"
#: Words of up to this many letters are terms as a whole, without slips.
SHORT = 3
#: Characters before and after a hit that its context covers.
CONTEXT = 60

_WORDS = re.compile(r"[^\W\d_]+")
_EDGE = re.compile(r"[^\w@$*']")
_QUOTES = "\"“”„«»‘’"
_REPORTS = re.compile(r"\b(?:said|says|wrote|writes|quoted?|quoting|called|according|reported|the word|the term)\b")
_ADDRESS = re.compile(r"\b(?:you|your|you're|u r|ur|they|them|these)\b|!")

FEATURES = ("exact", "slips", "quoted", "aimed", "slips_quoted", "slips_aimed", "rate", "slip_rate", "length")


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: a fifth, by the checksum of the id's text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class Lexicon(NamedTuple):
    """The compiled table. State 0 is dead, state 1 starts a word."""

    letters: str           # letter class i + 1 stands for letters[i]; class 0 for any other word character; END for the word's end
    table: np.ndarray      # state x class -> state
    entry: np.ndarray      # state -> best stem reached so far, -1 for none
    slips: np.ndarray      # state -> slips of that match
    weight: np.ndarray     # stem -> log odds
    moving: np.ndarray     # state -> whether it has a way out


def compile_lexicon(stems: list[str], weights: list[float]) -> Lexicon:
    """The trie of ``stems`` intersected with the distance-one automaton, made deterministic."""
    letters = "".join(sorted({c for s in stems for c in s} | {END}))
    child: list[dict[str, int]] = [{}]
    final: dict[int, int] = {}
    for i, stem in enumerate(stems):
        at = 0
        for c in stem:
            if c not in child[at]:
                child[at][c] = len(child)
                child.append({})
            at = child[at][c]
        final.setdefault(at, i)

    def closed(nodes: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        """With letters left out (one slip), and without what a cheaper match covers."""
        out = set(nodes)
        for node, e in nodes:
            if e == 0 and node:
                out |= {(n, 1) for n in child[node].values()}
        return frozenset((n, e) for n, e in out if e == 0 or (n, 0) not in out)

    def step(state: frozenset, c: str | None) -> frozenset:
        out = set()
        for node, e in state:
            if c in child[node]:
                out.add((child[node][c], e))
            if e == 0 and node:  # the first letter has to be right
                out |= {(n, 1) for n in child[node].values()}  # another letter
                out.add((node, 1))                               # a letter too many
        return closed(out)

    def best(state: frozenset, before: tuple[int, int]) -> tuple[int, int]:
        """(slips, stem), fewest slips first; a match once made stays."""
        return min([before, *((e, final[n]) for n, e in state if n in final and (e == 0 or len(stems[final[n]]) > 1 + SHORT))])

    nothing = (9, -1)
    start = (frozenset({(0, 0)}), nothing)
    dead = (frozenset(), nothing)
    index = {dead: 0, start: 1}
    queue, rows = [dead, start], []
    for state, hit in queue:
        row = []
        likely = {c for node, _ in state for c in child[node]}
        other = step(state, None)  # what any letter does that continues no stem here
        for c in (None, *letters):
            reached = step(state, c) if c in likely else other
            hit_now = best(reached, hit)
            # After an exact match nothing better can come.
            nxt = (frozenset(), hit_now) if hit_now[0] == 0 else (reached, hit_now)
            if nxt not in index:
                index[nxt] = len(index)
                queue.append(nxt)
            row.append(index[nxt])
        rows.append(row)
        if len(index) * (len(letters) + 1) * 4 > MAX_TABLE_BYTES:
            raise ValueError(f"the table of {len(stems)} terms exceeds {MAX_TABLE_BYTES} bytes; raise EVIDENCE")
    hits = [h for _, h in queue]
    table = np.array(rows, np.int32)
    return Lexicon(letters, table, np.array([h[1] for h in hits], np.int32),
                   np.array([h[0] if h[1] >= 0 else 0 for h in hits], np.int8), np.array(weights, np.float64), table.any(axis=1))


@cache
def _word_characters() -> np.ndarray:
    """Code point to 0 for characters of words, -1 for all others."""
    out = np.fromiter((0 if chr(cp).isalnum() else -1 for cp in range(0x110000)), np.int32, 0x110000)
    out[[ord(c) for c in "@$*'"]] = 0
    return out


def _classes(lexicon: Lexicon) -> np.ndarray:
    """Code point to letter class; -1 ends a word."""
    out = _word_characters().copy()
    for i, c in enumerate(lexicon.letters):
        if c != END:
            out[ord(c)] = i + 1
    return out


def find_hits(text: str, lexicon: Lexicon, classes: np.ndarray) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of words and the hits (place, stem, slips) of one lower-cased text."""
    kind = classes[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    inside = kind >= 0
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    kind = np.append(kind, -1)
    kind[ends] = lexicon.letters.index(END) + 1
    states = np.ones(len(starts), np.int32)
    live, at = np.arange(len(starts)), starts.copy()
    while len(live):
        states[live] = lexicon.table[states[live], kind[at[live]]]
        at[live] += 1
        live = live[(at[live] <= ends[live]) & lexicon.moving[states[live]]]
    found = np.flatnonzero(lexicon.entry[states] >= 0)
    return len(starts), list(zip(starts[found].tolist(), lexicon.entry[states[found]].tolist(), lexicon.slips[states[found]].tolist()))


def in_context(text: str, place: int) -> tuple[bool, bool]:
    """Whether a hit reads as quoted, and as aimed at someone."""
    before, after = text[max(0, place - CONTEXT):place], text[place:place + CONTEXT]
    marks = sum(before.count(q) for q in _QUOTES) % 2 == 1 and any(q in after for q in _QUOTES)
    return marks or bool(_REPORTS.search(before)), bool(_ADDRESS.search(before) or _ADDRESS.search(after))


def features(text: str | None, lexicon: Lexicon, classes: np.ndarray, piece: int = 1 << 20) -> tuple[float, ...]:
    """``FEATURES`` of a text; long texts are read in pieces cut between words, contexts reach over the cuts."""
    text = (text or "").lower()
    n, at = 0, 0
    plain, quoted, aimed = [0.0, 0.0], [0.0, 0.0], [0.0, 0.0]  # of exact and of misspelled hits
    while at < len(text):
        cut = _EDGE.search(text, at + piece)
        stop = cut.end() if cut else len(text)
        words, hits = find_hits(text[at:stop], lexicon, classes)
        n += words
        for place, stem, slip in hits:
            weight = float(lexicon.weight[stem])
            is_quoted, is_aimed = in_context(text, at + place)
            if is_quoted:
                quoted[slip] += weight
            else:
                plain[slip] += weight
                aimed[slip] += weight * is_aimed
        at = stop
    return (*map(math.log1p, (*plain, quoted[0], aimed[0], quoted[1], aimed[1])),
            math.sqrt(plain[0] / max(n, 1)), math.sqrt(plain[1] / max(n, 1)), math.log1p(n))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_toxic: int, max_clean: int) -> DataFrame:
    """``toxic, text`` of the bounded learning sample."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("_id is not null and toxic is not null").groupBy("_id").agg(F.max("toxic").alias("toxic")))
    marks = marks.where(~held_out(F.col("_id")))

    def some(toxic: int, n: int) -> DataFrame:
        return marks.where(F.col("toxic") == toxic).orderBy(F.xxhash64("_id"), "_id").limit(n)

    chosen = written(some(1, max_toxic).union(some(0, max_clean)), "labelled")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return written(texts.join(small(chosen), F.col("doc_id") == F.col("_id")).select("toxic", "text"), "examples")


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each stem by label, summed within the task (the sample is bounded)."""
    toxic: Counter = Counter()
    clean: Counter = Counter()
    for batch in batches:
        for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            words = set(_WORDS.findall((text or "").lower()))
            terms = {w[:k] for w in words for k in STEM_LETTERS if len(w) >= k}
            (toxic if label else clean).update(terms | {w + END for w in words if len(w) <= SHORT})
    stems = list(toxic)  # a stem of clean texts only is no candidate
    yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array([toxic[s] for s in stems], pa.int64()),
                                      pa.array([clean[s] for s in stems], pa.int64())], names=["stem", "toxic", "clean"])
    rest = [s for s in clean if s not in toxic and clean[s] > 1]
    yield pa.RecordBatch.from_arrays([pa.array(rest, pa.string()), pa.array([0] * len(rest), pa.int64()),
                                      pa.array([clean[s] for s in rest], pa.int64())], names=["stem", "toxic", "clean"])


def learn_stems(examples: DataFrame) -> list[tuple[str, float]]:
    """(stem, log odds), most telling first; empty without examples of both kinds."""
    totals = {r["toxic"]: r["count"] for r in examples.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)
    if not n_toxic or not n_clean:
        return []
    counts = map_batches(examples, _stem_counts, "stem string, toxic long, clean long")
    counts = counts.groupBy("stem").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    odds = (F.log((F.col("a") + 0.5) / (F.lit(n_toxic + 0.5) - F.col("a")))
            - F.log((F.col("b") + 0.5) / (F.lit(n_clean + 0.5) - F.col("b"))))
    gain = F.col("a") / F.lit(float(n_toxic)) - F.col("b") / F.lit(float(n_clean))

    def term(seen: str, n: int) -> Column:
        expected = (F.col("a") + F.col("b")) * F.lit(n / (n_toxic + n_clean))
        return F.when(F.col(seen) > 0, F.col(seen) * F.log(F.col(seen) / expected)).otherwise(F.lit(0.0))

    # The terms come from the bounded sample; only those with evidence reach the driver.
    best = (counts.withColumn("odds", odds).withColumn("gain", gain).withColumn("evidence", 2 * (term("a", n_toxic) + term("b", n_clean)))
            .where((F.col("odds") >= ODDS) & (F.col("evidence") >= EVIDENCE)).orderBy(F.desc("gain"), F.desc(F.length("stem")), "stem").collect())
    out: list[tuple[str, float]] = []
    taken: set[str] = set()
    begun: set[str] = set()
    for r in best:
        # Of stems that extend each other the more telling stays: a hit on the longer is one on the shorter.
        starts = {r["stem"][:k] for k in range(1, len(r["stem"]) + 1)}
        if r["stem"] not in begun and not starts & taken:
            out.append((r["stem"], r["odds"]))
            taken.add(r["stem"])
            begun |= starts
    return out


def _feature_rows(lexicon, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon.value
        classes = _classes(lex)
        for batch in batches:
            rows = [features(t.as_py(), lex, classes) for t in batch.column("text")]
            columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([batch.column(key), *columns], names=[key, *FEATURES])

    return run


_FEATURE_SCHEMA = ", ".join(f"{f} double" for f in FEATURES)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    examples = _labelled(docs, labels, id_col, text_col, max_toxic, max_clean)
    stems = learn_stems(examples)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = held_out(F.col("doc_id")).alias("held_out")
    if not stems:
        return rows.select("doc_id", out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    lexicon = docs.sparkSession.sparkContext.broadcast(compile_lexicon([s for s, _ in stems], [w for _, w in stems]))
    seen = written(map_batches(examples, _feature_rows(lexicon, "toxic"), "toxic int, " + _FEATURE_SCHEMA), "features")
    model = LogisticRegression(featuresCol="x", labelCol="y", maxIter=60, regParam=1e-4, standardization=True).fit(
        VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(
            seen.withColumn("y", F.col("toxic").cast("double")).coalesce(1)))
    margin = F.lit(float(model.intercept))
    for name, c in zip(FEATURES, model.coefficients.toArray().tolist()):
        margin = margin + F.lit(c) * F.col(name)
    scored = map_batches(rows, _feature_rows(lexicon, "doc_id"), "doc_id long, " + _FEATURE_SCHEMA)
    scored = scored.withColumn("score", 1 / (1 + F.exp(-margin)))
    return scored.select("doc_id", out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
