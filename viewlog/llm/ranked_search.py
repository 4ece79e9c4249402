"""Ranked lexical search: accumulator-limited term-at-a-time over blocks of documents.

Terms are runs of ASCII letters and digits and of non-ASCII characters, with
A-Z lower-cased. One pass over the texts writes, per document, its length and
the frequencies of those terms that any query holds; corpus figures (documents,
length, document frequencies) come from that table. Then every task inverts
blocks of documents and answers all queries on them, one term after the other,
the corpus's rarest first. A document gets an accumulator while one without it
could still reach the k-th partial score; once the bounds of the terms left
(weight times the block's largest impact) sum to less, no accumulator is
created any more and the existing ones are brought to their exact scores. The
k best of each block merge to the k best of all: no posting is shuffled, and a
frequent term costs a block no more than its documents.

Queries are taken in batches of bounded text, each broadcast; more queries
mean more batches over the corpus, not a larger broadcast.

Defined results: a null or empty text has no terms; a query without terms, or
whose terms occur nowhere, gives no rows; each row of the queries is a query of
its own and each row of the documents a document of its own, also if ids
repeat; of equal scores the least doc_id ranks first, null ids before all;
documents with a score of 0 are not returned; no documents give no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewlog.llm.common import byte_texts, map_batches, row_slices, written

K = 10
#: Text of the queries of one batch; what a batch broadcasts follows from it.
QUERY_BYTES = 32 << 20
#: A block ends with the document that reaches one of these.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 15, 1 << 21

_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_SPLIT).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _query_batches(queries: DataFrame, id_col: str, text_col: str, max_bytes: int) -> list[list[tuple[int | None, list[bytes]]]]:
    """(item_id, distinct terms) of all queries, in batches of about ``max_bytes`` of text, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                found = [sorted(set(terms(t))) for t in byte_texts(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    rows = queries.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // max_bytes)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else rows
        got = map_batches(part, run, "item_id long, terms array<binary>").collect()
        yield [(r.item_id, [bytes(t) for t in r.terms]) for r in got if r.terms]


def index(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, terms, tfs``: each document's length, and the terms of the vocabulary (by place) that it holds."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            for part in row_slices(batch, "text"):
                n, held, tfs = [], [], []
                for text in byte_texts(part.column("text")):
                    words = terms(text)
                    found = [(i, c) for t, c in Counter(words).items() if (i := place.get(t)) is not None]
                    n.append(len(words))
                    held.append([i for i, _ in found])
                    tfs.append([c for _, c in found])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(held, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Block:
    """An inverted block of documents."""

    def __init__(self, doc_ids: list[int | None], lengths: list[int], term: np.ndarray, doc: np.ndarray, tf: np.ndarray,
                 n_docs: int, n_words: int) -> None:
        order = sorted(range(len(doc_ids)), key=lambda i: (doc_ids[i] is not None, doc_ids[i] or 0))
        self.doc_ids = [doc_ids[i] for i in order]
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))  # documents by place in id order: the lower place wins a tie
        slack = np.array([8 * (100 - 90 + 90 * n * n_docs // n_words) for n in lengths], np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + slack[doc])
        by_term = np.argsort(term, kind="stable")
        self.doc, self.impact = at[doc[by_term]], impact[by_term]
        self.terms, self.first = np.unique(term[by_term], return_index=True)
        self.last = np.append(self.first[1:], len(term))
        self.largest = np.maximum.reduceat(self.impact, self.first) if len(term) else np.zeros(0, np.int64)
        self.score = np.zeros(len(order), np.int64)

    def search(self, query: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(place, score) of the k best documents for a query, whose terms come rarest first."""
        if not len(self.terms):
            return []
        at = np.searchsorted(self.terms, query)
        at[at == len(self.terms)] = 0
        held = self.terms[at] == query
        at, w = at[held], weights[query[held]]
        left = np.append(np.cumsum((w * self.largest[at])[::-1])[::-1], 0).tolist()
        score, creating, live = self.score, True, None
        score[:] = 0
        for i, t in enumerate(at):
            if creating and i and left[i] < score.max() and left[i] < self._kth(k):
                creating, live = False, score > 0
            docs, gain = self.doc[self.first[t]:self.last[t]], self.impact[self.first[t]:self.last[t]] * w[i]
            if not creating:
                known = live[docs]
                docs, gain = docs[known], gain[known]
            score[docs] += gain  # a term's documents are distinct
        best = np.flatnonzero(score >= max(self._kth(k), 1))
        best = best[np.lexsort((best, -score[best]))][:k]
        return [(int(b), int(score[b])) for b in best]

    def _kth(self, k: int) -> int:
        """The k-th largest partial score; 0 if there are fewer documents."""
        n = len(self.score)
        return int(np.partition(self.score, n - k)[n - k]) if n >= k else 0


def _blocks(batches: Iterator[pa.RecordBatch], n_docs: int, n_words: int, max_docs: int, max_postings: int) -> Iterator[Block]:
    ids, lengths, term, tf, sizes, postings = [], [], [], [], [], 0

    def block() -> Block:
        doc = np.repeat(np.arange(len(ids)), np.concatenate(sizes))
        return Block(ids, lengths, np.concatenate(term), doc, np.concatenate(tf), n_docs, n_words)

    for batch in batches:
        size = np.array([len(t) for t in batch.column("terms")], np.int64)
        at = 0
        while at < batch.num_rows:
            room = np.searchsorted(np.cumsum(size[at:]), max_postings - postings) + 1
            part = batch.slice(at, max(1, min(int(room), max_docs - len(ids))))
            at += part.num_rows
            ids += part.column("doc_id").to_pylist()
            lengths += part.column("n").to_pylist()
            term.append(part.column("terms").flatten().to_numpy())
            tf.append(part.column("tfs").flatten().to_numpy())
            sizes.append(size[at - part.num_rows:at])
            postings += len(term[-1])
            if len(ids) >= max_docs or postings >= max_postings:
                yield block()
                ids, lengths, term, tf, sizes, postings = [], [], [], [], [], 0
    if ids:
        yield block()


def _search_batch(docs: DataFrame, queries: list[tuple[int | None, list[bytes]]], k: int, id_col: str, text_col: str,
                  max_docs: int, max_postings: int) -> DataFrame | None:
    spark = docs.sparkSession
    vocabulary = sorted({t for _, ts in queries for t in ts})
    place = {t: i for i, t in enumerate(vocabulary)}
    rows = written(index(docs, vocabulary, id_col, text_col), "search-index")
    n_docs, n_words = rows.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs:
        return None
    df = {r.term: r["count"] for r in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}  # the batch's terms at most
    weights = np.array([weight(n_docs, df[i]) if i in df else 0 for i in range(len(vocabulary))], np.int64)
    asked = []
    for item, ts in queries:
        known = sorted((i for t in ts if (i := place[t]) in df), key=lambda i: (df[i], i))
        asked.append((item, np.array(known, np.int64)))
    shared = spark.sparkContext.broadcast((asked, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        for block in _blocks(batches, n_docs, n_words, max_docs, max_postings):
            out = [(q, item, block.doc_ids[b], s) for q, (item, known) in enumerate(asked) for b, s in block.search(known, weights, k)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["query", "item_id", "doc_id", "score"])

    found = map_batches(rows, run, "query long, item_id long, doc_id long, score long")
    # k rows per query and block; row numbers up to k are limited in each task before the shuffle.
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           query_id: str = "item_id", query_text: str = "text", query_bytes: int = QUERY_BYTES,
           max_docs: int = BLOCK_DOCS, max_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each query, all documents considered."""
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for batch in _query_batches(queries, query_id, query_text, query_bytes):
        if batch:
            part = _search_batch(docs, batch, k, id_col, text_col, max_docs, max_postings)
            out = out if part is None else out.union(part)
    return out
