"""Source divergence audit: how the sources of a language differ in their words.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased; a
language keeps those found in at least ``MIN_DOCS`` of its documents. A group
(lang, source) gives each kept term the smoothed share ``p``, in parts of 10^9
and at least 1, also if the term does not occur there. The divergence of a
group from a peer sums ``f(p, q) = (p - q)^2 div q`` over all kept terms; its
peers are all other sources of its language.

Most terms of most groups do not occur, so the sum is split around the zero
share ``z`` of either side. With ``f0 = f(za, zb)`` and V kept terms::

    value(a, b) = V * f0
                + sum over a's terms  of f(pa, zb) - f0
                + sum over b's terms  of f(za, pb) - f0
                + sum over common terms of f(pa, pb) - f(pa, zb) - f(za, pb) + f0

The middle lines need only how many terms of a group have which share; they
are small aggregates per group and zero share. The last is a sparse matrix
product by rows (Gustavson): each task holds a term-major index of a slice of
the terms, each group scatters its terms through it into a dense accumulator
over its peers, and only the accumulators leave the task, one number per pair,
slice and language instead of one row per pair and term. All arithmetic is on
integers, so the split changes nothing.

Defined results: null text, lang and source count as empty strings; a group
exists if a row has it, with or without terms; a group without terms, and a
language without kept terms, take part (with divergence 0 in the latter);
repeated rows count as documents of their own; an empty table gives an empty
result; other columns are ignored. ``value`` is exact while 10^18 bounds it,
which holds whatever the counts.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewlog.llm.common import byte_texts, map_batches, row_slices, small, written

SCALE = 1_000_000_000
MIN_DOCS = 3
TERM_RANKS = 200
#: Counted terms that a task holds before it hands them on.
HELD_TERMS = 1 << 19
#: Postings of a slice of the term-major index, and of one scatter through it.
SLICE_POSTINGS, SCATTER_POSTINGS = 1 << 20, 1 << 20

_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_SPLIT).split()


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts per (lang, source, term); a group's row without term keeps it known."""
    counts: dict[tuple, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in counts.items():
            yield _counted(lang, source, [None, *n], [0, *n.values()], [0, *(df[t] for t in n)])
        counts.clear()

    for batch in batches:
        for part in row_slices(batch, "text"):
            for lang, source, text in zip(*(byte_texts(part.column(c)) for c in ("lang", "source", "text"))):
                n, df = counts[lang, source]
                found = terms(text)
                n.update(found)
                df.update(set(found))
            if sum(len(n) for n, _ in counts.values()) > HELD_TERMS:
                yield from rows()
    yield from rows()


def _counted(lang: bytes, source: bytes, found: list, n: list[int], df: list[int]) -> pa.RecordBatch:
    def text(values: list) -> pa.Array:
        return pa.array(values, pa.binary()).cast(pa.string())

    return pa.RecordBatch.from_arrays([text([lang] * len(found)), text([source] * len(found)), text(found),
                                       pa.array(n, pa.int64()), pa.array(df, pa.int64())], names=["lang", "source", "term", "n", "df"])


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, term, n, df``: occurrences and documents per group; each group has one row with a null term."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    parts = map_batches(rows, _count_batches, "lang string, source string, term string, n long, df long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + terms)), beyond 64 bits inside."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return (F.call_function("div", scaled, (total + terms).cast("decimal(21,0)")) + 1).cast("long")


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def scatter(term: np.ndarray, peer: np.ndarray, p: np.ndarray, z: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each group's dense accumulator over its peers: corrections on common terms.

    ``term`` ascends and with ``peer`` and ``p`` is the term-major index, a
    posting per term and group; ``z`` holds the zero share of each group.
    """
    first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    size = np.diff(np.append(first, len(term)))
    row = np.repeat(np.arange(len(first)), size)  # posting -> place of its term
    by_group = np.argsort(peer, kind="stable")
    cuts = np.searchsorted(peer[by_group], np.arange(len(z) + 1))
    for a in range(len(z)):
        own = by_group[cuts[a]:cuts[a + 1]]
        if not len(own):
            continue
        total, sizes = np.zeros(len(z), np.int64), size[row[own]]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(own):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SCATTER_POSTINGS, "right")))
            n, postings = sizes[at:to], own[at:to]
            # The posting lists of the group's terms, one after the other.
            ahead = np.repeat(first[row[postings]] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            b, pa_, pb = peer[ahead], np.repeat(p[postings], n), p[ahead]
            zb = z[b]
            np.add.at(total, b, _gap(pa_, pb) - _gap(pa_, zb) - _gap(z[a], pb) + _gap(z[a], zb))
            at = to
        yield a, total


def _scatter_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, term): slices of whole terms of one language, scattered one after the other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= SLICE_POSTINGS:
            table = pa.Table.from_batches(held).combine_chunks()
            last = table.slice(table.num_rows - 1, 1)
            mine = [table.column(c).combine_chunks() for c in ("lang", "term")]
            import pyarrow.compute as pc

            same = pc.and_(pc.equal(mine[0], last.column("lang")[0]), pc.equal(mine[1], last.column("term")[0])).to_numpy(zero_copy_only=False)
            stop = int(np.argmax(same))  # the last term may go on in the next batch
            if stop == 0:
                break
            yield from _slices(table.slice(0, stop))
            held = table.slice(stop).to_batches()
    if held:
        yield from _slices(pa.Table.from_batches(held))


def _slices(table: pa.Table) -> Iterator[pa.RecordBatch]:
    frame = table.to_pandas()
    for lang, part in frame.groupby("lang", sort=False):
        term = part["term"].to_numpy()
        codes = np.cumsum(np.append(0, term[1:] != term[:-1]))
        names, first, peer = np.unique(part["source"].to_numpy(), return_index=True, return_inverse=True)
        z = part["z"].to_numpy()[first]
        for a, total in scatter(codes, peer, part["p"].to_numpy(), z):
            total[a] = 0
            hit = np.flatnonzero(total)
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hit)), pa.array([names[a]] * len(hit)), pa.array(names[hit]),
                                                  pa.array(total[hit])], names=["lang", "source", "item", "common"])


def common_terms(shares: DataFrame) -> DataFrame:
    """``lang, source, item, common``: the last line of the sum, for pairs that have any."""
    slices = shares.select("lang", "term", "source", "p", "z").repartition("lang", "term").sortWithinPartitions("lang", "term")
    parts = map_batches(slices, _scatter_batches, "lang string, source string, item string, common long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("common").alias("common"))


def group_shares(docs: DataFrame, min_docs: int = MIN_DOCS, **columns: str) -> tuple[DataFrame, DataFrame]:
    """Groups (``lang, source, z, terms``) and their kept terms (``lang, source, term, p, z, q``), both written."""
    counts = written(term_counts(docs, **columns), "term-counts")
    known = counts.where("term is not null")
    kept = written(known.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
                   .where(F.col("df") >= min_docs).drop("df"), "kept-terms")
    mine = written(known.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "group-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = mine.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (counts.where("term is null").select("lang", "source").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
              .na.fill(0, ["terms", "lang_total", "total"]))
    groups = written(groups.withColumn("z", F.when(F.col("terms") > 0, _share(zero, F.col("total"), F.col("terms")))), "groups")
    shares = (mine.join(small(groups), ["lang", "source"])
              .select("lang", "source", "term", "z", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                      _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")))
    return groups.select("lang", "source", "z", "terms"), written(shares, "shares")


def pair_divergences(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang, source, item, value``: every group against every other source of its language."""
    marks = shares.groupBy("lang", "source", "p", "z").agg(F.count(F.lit(1)).alias("n"))
    zeros = written(groups.where("z is not null").select("lang", F.col("z").alias("other")).distinct(), "zeros")
    seen = marks.join(small(zeros), "lang")
    other, p, z, n = (F.col(c) for c in ("other", "p", "z", "n"))
    sums = written(seen.groupBy("lang", "source", "other").agg(F.sum(n * (gap(p, other) - gap(z, other))).alias("from"),
                                                              F.sum(n * (gap(other, p) - gap(other, z))).alias("to")), "marginals")
    a = groups.select("lang", "source", F.col("z").alias("za"), "terms")
    b = groups.select("lang", F.col("source").alias("item"), F.col("z").alias("zb"))
    pairs = a.join(small(b), "lang").where("source <> item")
    pairs = (pairs.join(sums.select("lang", "source", F.col("other").alias("zb"), F.col("from")), ["lang", "source", "zb"], "left")
             .join(sums.select("lang", F.col("source").alias("item"), F.col("other").alias("za"), F.col("to")), ["lang", "item", "za"], "left")
             .join(common_terms(shares), ["lang", "source", "item"], "left"))
    parts = [F.col("terms") * gap(F.col("za"), F.col("zb")), F.col("from"), F.col("to"), F.col("common")]
    value = sum((F.coalesce(x, F.lit(0).cast("long")) for x in parts[1:]), F.coalesce(parts[0], F.lit(0).cast("long")))
    return pairs.select("lang", "source", "item", value.alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, term_ranks: int = TERM_RANKS, **columns: str) -> DataFrame:
    """``lang, source, part, item, value, rank``: peers by divergence, and the terms a group uses above its language's share."""
    groups, shares = group_shares(docs, min_docs, **columns)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pair_divergences(groups, shares).withColumn("rank", F.row_number().over(order))
    over = (shares.where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= term_ranks))
    parts = [df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, df in (("pair", pairs), ("term", over))]
    return parts[0].union(parts[1])
