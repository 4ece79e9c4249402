"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersections.

Every text becomes a set of word shingles. Equal sets are one node, so copies
cost one row per task. Nodes meet in tiles: sizes are banded, and in a band the
hash range is cut into K groups, where two sets similar enough differ in at
most H < K elements. By the pigeonhole principle they then agree on K - H whole
groups, so the tile key is (band, group, hash of the group's elements). Each set
leaves out its first K - H - 1 groups in the order of their elements' number and
their key. Equal groups stand in the same order on both sides, so both leave out
the first ones they agree on, and one at least is left. That is lossless, and
a passage that many texts share does not fill tiles, nor does a common shingle or
an empty group, since the larger groups stay and must agree as a whole.

Within a tile each node is first compared with the tile's smallest node only
(a star, linear in the tile). Components of the links found so far then rule
out all further work inside one component. In tiles that still hold several,
hashed bitmaps bound the overlaps from above: each node is intersected with its
best partner in another component (linear again), and one without any such
partner is done. The nodes left get sharp bitmaps, which bound closely, and
further rounds with their best partners, until a round links nothing. A last pass
intersects every pair between components that the sharp bitmaps still allow, so
no link is lost.

Text is read twice, a third time where tiles stay open, and not shuffled; sets
travel only for nodes in surviving pairs. Components are found in Spark and
never collected.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; a text shorter than a shingle is one shingle;
repeated rows link with each other; a null id counts as no id when the
smallest id of a component is taken; an empty table gives an empty result;
other columns are ignored. Elements are 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog.llm.common import FEW_ROWS, byte_texts, few, map_batches, row_slices, small
from viewlog.llm.common import hashes_written as written
from viewlog.llm.components import components
from viewlog.llm.shingles import mixed, popcount, shingle_set, texts_word_hashes

WORDS = 4
THRESHOLD = (85, 100)
#: Nodes in a block of a tile.
BLOCK = 1024
#: Ratio of successive band edges.
BAND = 1.6
#: Groups beyond those needed, besides half as many as these: each set leaves out as many, the ones of fewest elements.
SPARE = 4
#: Bits an element in the bitmaps of all nodes, and in the sharp ones, up to ``SHARP_BITS`` bits a node.
COARSE, SHARP = 2, 16
SHARP_BITS = 1 << 16

_U = np.uint64


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part in row_slices(batch, "text"):
        texts = [(t or b"").lower() for t in byte_texts(part.column("text"))]  # changes A-Z only
        yield part, [shingle_set(w, n) for w in texts_word_hashes(texts)]


def node_of(elements: np.ndarray) -> int:
    """A set's identity: a 64-bit hash that ignores order."""
    total = mixed(elements).sum(dtype=np.uint64) + _U(len(elements))
    return int(mixed(np.array([total])).view(np.int64)[0])


def bitmap(elements: np.ndarray, scale: int = COARSE) -> np.ndarray:
    """A set's signature: one hashed bit per element, in ``scale`` to twice ``scale`` times as many bits."""
    bits = max(64, 1 << int(scale * len(elements) - 1).bit_length())
    out = np.zeros(bits, bool)
    out[(mixed(elements) & _U(bits - 1)).astype(np.int64)] = True
    return np.packbits(out)


def sharp_bitmap(elements: np.ndarray) -> np.ndarray:
    """A larger signature, which tells pairs just below the threshold from linked ones; long sets keep the coarse size."""
    return bitmap(elements, max(COARSE, min(SHARP, SHARP_BITS // (2 * max(1, len(elements))))))


def folded(rows: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps as they are with fewer bits: ``width`` bytes."""
    return np.bitwise_or.reduce(rows.reshape(len(rows), -1, width), axis=1)


def stacked(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps of several sizes as rows of the least size."""
    size = np.array([len(b) for b in bitmaps])
    width = int(size.min())
    out = np.empty((len(bitmaps), width), np.uint8)
    for s in np.unique(size):
        at = np.flatnonzero(size == s)
        out[at] = folded(np.frombuffer(b"".join([bitmaps[i] for i in at]), np.uint8).reshape(len(at), s), width)
    return out


def band_edges(limit: int) -> list[int]:
    """1 = E0 < E1 < ...: band k holds sizes from E(k) to E(k+1) - 1."""
    out = [1]
    while out[-1] <= limit:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return out


def most_different(small_size: int, threshold: tuple[int, int]) -> int:
    """Elements in which two linked sets can differ if the smaller has at most ``small_size``."""
    p, q = threshold
    both = small_size + small_size * q // p
    return (q - p) * both // (q + p)


@cache
def _cuts(groups: int) -> np.ndarray:
    """Where equal parts of the hash range start."""
    return (np.arange(groups, dtype=object) * (1 << 64) // groups).astype(np.uint64)


def tile_keys(elements: np.ndarray, threshold: tuple[int, int] = THRESHOLD) -> np.ndarray:
    """The tiles that a set (sorted distinct hashes) belongs to."""
    n, (p, q) = len(elements), threshold
    edges = band_edges(n)
    spread = mixed(elements)
    out = []
    for k in range(len(edges) - 1):
        # Band k: the smaller set of a pair lies in it; this set is that or the larger.
        if edges[k] > n or (edges[k + 1] - 1) * q < p * n:
            continue
        differ = most_different(edges[k + 1] - 1, threshold)
        spare = SPARE + differ // 2 if differ else 0
        groups = differ + 1 + spare
        start = np.searchsorted(elements, _cuts(groups))
        stop = np.append(start[1:], n)
        full = stop > start
        sums = np.zeros(groups, np.uint64)
        sums[full] = np.add.reduceat(spread, start[full])
        label = np.arange(groups, dtype=np.uint64) + _U((k + 1) << 32)
        keys = mixed(sums * _U(0x9E3779B97F4A7C15) + mixed(label))
        # A pair agrees on one group more than either side leaves out, and of these both leave out the first.
        out.append(keys[np.lexsort((keys, stop - start))[spare:]])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _nodes(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, sets in _sets(batch, n):
            full = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([node_of(s) if f else None for s, f in zip(sets, full)], pa.int64()),
                pa.array([bitmap(s).tobytes() if f else None for s, f in zip(sets, full)], pa.binary()),
            ], names=["doc_id", "n_shingles", "node", "bits"])


def _tiles(batches: Iterator[pa.RecordBatch], n: int, threshold: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # copies within this task are one node
    for batch in batches:
        for _, sets in _sets(batch, n):
            keys, nodes = [], []
            for s in sets:
                if len(s) and (node := node_of(s)) not in seen:
                    seen.add(node)
                    keys.append(tile_keys(s, threshold))
                    nodes.append(np.full(len(keys[-1]), node, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))], names=["tile", "node"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile and node: (tile, its first node, each further node)."""
    tile = head = last = None
    for batch in batches:
        t, v = batch.column("tile").to_numpy(), batch.column("node").to_numpy()
        if not len(t):
            continue
        opens = np.empty(len(t), bool)
        opens[0] = t[0] != tile
        opens[1:] = t[1:] != t[:-1]
        first = np.where(opens, np.arange(len(t)), -1)
        first = np.maximum.accumulate(first)
        heads = np.where(first >= 0, v[np.maximum(first, 0)], 0 if head is None else head)
        again = np.empty(len(t), bool)
        again[0] = not opens[0] and v[0] == last
        again[1:] = ~opens[1:] & (v[1:] == v[:-1])
        keep = ~opens & ~again
        tile, head, last = t[-1], heads[-1], v[-1]
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(t[keep]), pa.array(heads[keep]), pa.array(v[keep])], names=["tile", "a", "b"])


def _can_link(na, nb, overlap, threshold: tuple[int, int]):
    p, q = threshold
    return q * overlap >= p * (na + nb - overlap)


def _bounded(batches: Iterator[pa.RecordBatch], threshold: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs whose bitmaps allow the overlap they need."""
    for batch in batches:
        if not batch.num_rows:
            continue
        xa, xb = batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist()
        na, nb = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        differ = np.zeros(batch.num_rows, np.int64)
        width = np.array([min(len(x), len(y)) for x, y in zip(xa, xb)])
        for w in np.unique(width):  # each pair with the bits of its smaller bitmap
            at = np.flatnonzero(width == w)
            x, y = stacked([xa[i] for i in at] + [b"\0" * int(w)]), stacked([xb[i] for i in at] + [b"\0" * int(w)])
            differ[at] = popcount(x[:-1] ^ y[:-1]).sum(axis=1, dtype=np.int64)
        most = (na + nb - differ) // 2
        keep = _can_link(na, nb, np.minimum(most, np.minimum(na, nb)), threshold)
        if keep.any():
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])


def _set_rows(batches: Iterator[pa.RecordBatch], n: int, sharp: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, sets in _sets(batch, n):
            rows = [(node, s) for node, s in zip(part.column("node").to_pylist(), sets) if len(s) and node_of(s) == node]
            if rows:
                yield pa.RecordBatch.from_arrays([
                    pa.array([node for node, _ in rows], pa.int64()), pa.array([len(s) for _, s in rows], pa.int64()),
                    pa.array([s.tobytes() for _, s in rows], pa.binary()),
                    pa.array([sharp_bitmap(s).tobytes() if sharp else None for _, s in rows], pa.binary()),
                ], names=["node", "n_shingles", "elements", "bits"])


def _verified(batches: Iterator[pa.RecordBatch], threshold: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs whose exact overlap links them."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            at[at == len(y)] = len(y) - 1
            keep.append(bool(_can_link(len(x), len(y), int((y[at] == x).sum()), threshold)))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], names=["a", "b"])


def _tile_pairs(batches: Iterator[pa.RecordBatch], threshold: tuple[int, int], best: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block pair: the pairs between components that the bitmaps allow, or each node's ``best`` one only."""
    names = ("tile", "i", "j", "node", "block", "component", "n_shingles", "bits")

    def pairs(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        i, j = rows[0][1], rows[0][2]
        node, comp, n = (np.array([r[k] for r in rows], np.int64) for k in (3, 5, 6))
        block = np.array([r[4] for r in rows])
        bits = stacked([r[7] for r in rows])
        a, b = [], []
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        for x, others in [(x, right) for x in left] + [(y, left) for y in right if best and i != j]:
            ys = others[others > x] if i == j and not best else others
            ys = ys[comp[ys] != comp[x]]
            if not len(ys):
                continue
            most = (n[x] + n[ys] - popcount(bits[ys] ^ bits[x]).sum(axis=1, dtype=np.int64)) // 2
            most = np.minimum(most, np.minimum(n[x], n[ys]))
            can = _can_link(n[x], n[ys], most, threshold)
            if best and can.any():
                ys = ys[[np.argmax(np.where(can, most / (n[x] + n[ys] - most), -1))]]
            else:
                ys = ys[can]
            a += [min(node[x], node[y]) for y in ys]
            b += [max(node[x], node[y]) for y in ys]
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if held and held[0][:3] != row[:3]:
                yield from pairs(held)
                held = []
            held.append(row)
    if held:
        yield from pairs(held)


class _Join:
    """The steps over one table of texts."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, threshold: tuple[int, int]) -> None:
        self.words, self.threshold = words, threshold
        self.rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        self.nodes = written(map_batches(self.rows, partial(_nodes, n=words),
                                         "doc_id long, n_shingles long, node long, bits binary"), "nodes")
        # One row per node: its size, bitmap and smallest id.
        distinct = self.nodes.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"))
        self.known = written(distinct, "known")

    def stars(self) -> DataFrame:
        keys = map_batches(self.rows, partial(_tiles, n=self.words, threshold=self.threshold), "tile long, node long")
        return written(map_batches(keys.repartition("tile").sortWithinPartitions("tile", "node"), _stars,
                                   "tile long, a long, b long"), "stars")

    def sets(self, nodes: DataFrame, sharp: bool = False) -> DataFrame:
        """``node, n_shingles, elements`` of the distinct ``nodes``, from one text each, and sharp ``bits`` if asked for."""
        wanted = written(self.known.select("node", "doc_id").join(nodes, "node"), "wanted").alias("w")
        texts = (self.rows.alias("r").join(small(wanted).alias("w"), F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")))
                 .select("w.node", "r.text"))
        # Rows that repeat an id give a set once per row; one is enough.
        sets = map_batches(texts, partial(_set_rows, n=self.words, sharp=sharp), "node long, n_shingles long, elements binary, bits binary")
        return written(sets.dropDuplicates(["node"]), "sets")

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the pairs whose sets are similar enough."""
        full = (pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b"))
        return written(map_batches(full, partial(_verified, threshold=self.threshold), "a long, b long"), "edges")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct pairs whose sets are similar enough; bitmaps rule out most before any set is made."""
        info = self.known.select("node", "n_shingles", "bits")

        def side(c: str) -> DataFrame:
            return info.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))

        both = pairs.join(side("a"), "a").join(side("b"), "b")
        left = written(map_batches(both, partial(_bounded, threshold=self.threshold), "a long, b long"), "bounded")
        return self.verified(left, self.sets(_ends(left)))

    def tile_pairs(self, members: DataFrame, bitmaps: DataFrame, best: bool) -> DataFrame:
        """Distinct pairs of members of one tile and several components that the bitmaps allow; each node's ``best`` one or all."""
        rows = (bitmaps.select("node", "n_shingles", "bits").join(small(members, FEW_ROWS), "node")
                .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
                .select("tile", "i", "j", "node", "block", "component", "n_shingles", "bits"))
        rows = rows.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j")
        pairs = map_batches(rows, partial(_tile_pairs, threshold=self.threshold, best=best), "a long, b long").distinct()
        return written(pairs, "pairs")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """The ``tile, node`` rows of tiles that hold several components, each node's ``component`` and the tile's ``blocks``."""
    members = members.select("tile", "node").join(small(found, FEW_ROWS), "node", "left").withColumn("component", F.coalesce("component", "node"))
    members = written(members, "members")
    several = members.groupBy("tile").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                          F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("lo != hi")
    return written(members.join(several.select("tile", "blocks"), "tile"), "open")


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                  threshold: tuple[int, int] = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Membership ``doc_id, n_shingles, node`` and ``node, component`` of all nodes that link."""
    join = _Join(docs, id_col, text_col, words, threshold)
    stars = join.stars()
    found = written(components(join.linked(stars.select("a", "b").distinct())), "found")
    # Every node of a star but its head, which has met all of its tile.
    many = stars.groupBy("tile").count().where("count > 1").select("tile")
    members = _open(stars.select("tile", F.col("b").alias("node")).join(many, "tile", "left_semi"), found)
    if not members.limit(1).count():
        return join.nodes.select("doc_id", "n_shingles", "node"), found
    pairs = join.tile_pairs(members, join.known, best=True)
    sets = join.sets(_ends(pairs), sharp=True)
    best, sharp = True, False
    while True:
        more = join.verified(pairs, sets)
        linked = more.limit(1).count() > 0
        if linked:
            found = written(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "found")
        if not best:
            break
        # A node that no bitmap allows a partner in another component is done.
        partners = F.broadcast(_ends(pairs)) if few(pairs) else _ends(pairs)
        members = _open(members.join(partners, "node", "left_semi"), found)
        if not members.limit(1).count():
            break
        best, sharp = linked or not sharp, True
        pairs = join.tile_pairs(members, sets, best)
    return join.nodes.select("doc_id", "n_shingles", "node"), found


def _named(members: DataFrame, found: DataFrame) -> DataFrame:
    """``node, component_id, least``: the least id of each node's component, and its first node with that id."""
    ids = members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    ids = ids.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = ids.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("least"))
    return ids.join(least, "component").select("node", F.col("least.doc_id").alias("component_id"), F.col("least.node").alias("least"))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                      threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id`` (the smallest id reachable by links)."""
    members, found = jaccard_links(docs, id_col, text_col, words, threshold)
    named = _named(members, found).drop("least")
    return members.join(named, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
             threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without those similar to one that stays: the smallest id of each component stays.

    Rows without an id stay. Rows that repeat an id are judged by their own
    texts: of those with one set of shingles one stays, if that set's does.
    """
    members, found = jaccard_links(docs, id_col, text_col, words, threshold)
    # The set that stays for a component, and the id it stays with.
    best = _named(members, found).where("node = least").select("node", F.col("component_id").alias("stays_as"))
    seen = members.where("doc_id is not null").join(best, "node", "left")
    seen = seen.withColumn("stays", F.col("node").isNull() | F.coalesce(F.col("doc_id") == F.col("stays_as"), F.lit(False)))
    by_id = written(seen.groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("n"), F.min("stays").alias("stays")), "judged")
    own = F.col(id_col).cast("long") == F.col("_id")
    twice = written(by_id.where("n > 1").select("_id"), "twice")
    drop = written(by_id.where("n > 1 or not stays").select("_id"), "dropped")
    kept = docs.join(small(drop), own, "left_anti")
    if not twice.limit(1).count():
        return kept
    again = written(docs.join(small(twice), own, "left_semi").withColumn("_row", F.monotonically_increasing_id()), "again")
    sets = map_batches(again.select(F.col("_row").alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                       partial(_nodes, n=words), "doc_id long, n_shingles long, node long, bits binary")
    sets = sets.select(F.col("doc_id").alias("_at"), F.col("node").alias("_node"))
    again = again.join(sets, F.col("_row") == F.col("_at"))
    empty = again.where("_node is null").select(*docs.columns)
    stay = again.join(best.select(F.col("node").alias("_known"), F.col("stays_as").alias("_as")),
                      (F.col("_node") == F.col("_known")) & (F.col(id_col).cast("long") == F.col("_as")), "left_semi")
    first = stay.groupBy("_node").agg(F.min("_row").alias("_first")).select("_first")
    whole = again.join(first, F.col("_row") == F.col("_first"), "left_semi").select(*docs.columns)
    return kept.unionByName(empty).unionByName(whole)
