"""Repeated passages: shared seeds, collinear chains, alignment.

Texts are read as words (A-Z lower-cased). Of every ``WINDOW`` successive runs
of ``SEED`` words the one with the least hash is a seed, so any stretch of
``SEED + WINDOW - 1`` words that two texts share has a common seed. Documents
meet on equal seeds. In a seed's list every occurrence is matched with the
first one and with the last one of the document before it, which costs two
matches per occurrence, however long the list. A passage made of frequent lines
can have other partners seed by seed, so runs of ``min_words`` words, the least
of ``LONG_WINDOW`` successive ones, are keys too: whoever meets on one shares
that many words. The matches of two documents are chained: the best chain ending in a match is found with a Fenwick tree of
prefix maxima, where gaps on either side cost ``GAP_COST`` a word. Chains are
then aligned word by word over the texts, from match to match and outwards
beyond their ends: where an alignment loses its way, it starts again at the
chain's next match, in both directions. Neighbouring stretches are joined while
they reach ``identity`` together with the gap between them, and else are judged
apart; those of at least ``min_words`` words with at least ``identity`` of them
matching are passages.

Seeds, matches and word slices are shuffled, by seed and by document pair;
texts are read again only for documents with a chain. Document pairs are dealt
over ``ROUNDS`` rounds of alignment, as their slices are the largest thing
shuffled. All groups are read as
sorted streams: a seed's list is never held, a document pair's matches are as
many as the seeds and long runs of its later document times two.

Defined results: a null text has no words; a document is not matched with
itself, and rows that repeat an id count as one document; rows with a null id
are not compared; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog.llm.common import byte_texts, map_batches, row_slices, small, written
from viewlog.llm.shingles import mixed, texts_word_hashes

SEED = 5
WINDOW = 6
#: Successive runs of ``min_words`` words of which one is a key.
LONG_WINDOW = 10
MIN_WORDS = 40
IDENTITY = 0.8
GAP_COST = 0.12
#: Words within which an alignment has to find its way again after a difference.
RESYNC = 24
#: Words around a chain that its alignment may extend over in one go.
MARGIN = 96
#: Words of a slice up to which chains are aligned in whole batches if one run of equal words is all.
BATCHED = 512
#: Rounds in which the document pairs are aligned; the word slices of one round only are on disk at a time.
ROUNDS = 3


_BASE = np.uint64(0x9FB21C651E98DF25)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def runs_of(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words by differences of one running sum, whatever ``n`` is."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    up, down = _powers(1 << (len(words) - 1).bit_length())
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[:len(words)], dtype=np.uint64)))
    return mixed((total[n:] - total[:-n]) * down[:len(words) - n + 1])


def least_places(runs: np.ndarray, w: int) -> np.ndarray:
    """The places, ascending, of the first least hash in each ``w`` successive ones."""
    n = len(runs) - w + 1
    places = np.arange(len(runs))
    least, at = runs[:n].copy(), places[:n].copy()
    for i in range(1, w):
        less = runs[i:i + n] < least
        np.copyto(least, runs[i:i + n], where=less)
        np.copyto(at, places[i:i + n], where=less)
    return at[np.concatenate(([True], at[1:] != at[:-1]))]  # ascending, as the first least one only moves on


def seeds(words: np.ndarray, k: int = SEED, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a text's seeds."""
    runs = runs_of(words, k)
    if not len(runs):
        return np.empty(0, np.int64), runs
    if len(runs) <= w:
        at = np.array([int(runs.argmin())])
    else:
        at = least_places(runs, w)
        # Where a text repeats every ``gap`` words, each ``w`` successive runs need one of its equal seeds.
        gap = np.concatenate(([1], np.diff(at)))
        same = np.concatenate(([False], (runs[at][1:] == runs[at][:-1]))) & (gap <= w)
        last = np.concatenate((~same[1:], [True]))
        at = at[~same | last | (at // gap % np.maximum(w // gap, 1) == 0)]
    return at, runs[at]


def _word_rows(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part in row_slices(batch, "text"):
        yield part, texts_word_hashes([(t or b"").lower() for t in byte_texts(part.column("text"))])


def _seed_rows(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in _word_rows(batch):
            ids, places, hashes = [], [], []
            for doc, words in zip(part.column("doc_id").to_pylist(), texts):
                at, found = seeds(words)
                if len(words) >= min_words > SEED:
                    at, found = (np.concatenate(c) for c in zip((at, found), seeds(words, min_words, LONG_WINDOW)))
                ids.append(np.full(len(at), doc, np.int64))
                places.append(at.astype(np.int32))
                hashes.append(found.view(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (hashes, ids, places)], names=["seed", "doc", "place"])


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by seed, document, place: matches of a later with an earlier document."""
    seed = doc = None
    head = last = other = (-1, -1)  # first occurrence, last one, last one of the document before
    for batch in batches:
        s, d, p = (batch.column(c).to_numpy() for c in ("seed", "doc", "place"))
        if not len(s):
            continue
        new_seed = np.empty(len(s), bool)
        new_seed[0] = s[0] != seed
        new_seed[1:] = s[1:] != s[:-1]
        new_doc = new_seed.copy()
        new_doc[0] |= d[0] != doc
        new_doc[1:] |= d[1:] != d[:-1]
        row = np.arange(len(s))
        first = np.maximum.accumulate(np.where(new_seed, row, -1))
        before = np.maximum.accumulate(np.where(new_doc, row, -1)) - 1  # last row of the document before, -2 if in an earlier batch

        def pick(at, values, kept):
            return np.where(at >= 0, values[np.maximum(at, 0)], kept)

        head_doc, head_place = pick(first, d, head[0]), pick(first, p, head[1])
        # A document that goes on from the last batch has its predecessor there too; one that opens this batch follows ``last``.
        opens = before == -1
        prev_doc = np.where(before >= 0, d[np.maximum(before, 0)], np.where(opens & new_doc[0], last[0], other[0]))
        prev_place = np.where(before >= 0, p[np.maximum(before, 0)], np.where(opens & new_doc[0], last[1], other[1]))
        in_head = head_doc == d
        with_prev = ~in_head & (prev_doc != head_doc)
        out = [(~in_head, head_doc, head_place), (with_prev, prev_doc, prev_place)]
        late, early, at, there = (np.concatenate(c) for c in zip(*((d[m], e[m], p[m], q[m]) for m, e, q in out)))
        if len(late):
            yield pa.RecordBatch.from_arrays([pa.array(late), pa.array(early.astype(np.int64)), pa.array(at), pa.array(there.astype(np.int32))],
                                             names=["late", "early", "at", "there"])
        seed, doc = s[-1], d[-1]
        head, other, last = (head_doc[-1], head_place[-1]), (prev_doc[-1], prev_place[-1]), (d[-1], p[-1])


def chains(at: np.ndarray, there: np.ndarray, weight: float = SEED, gap_cost: float = GAP_COST) -> list[list[tuple[int, int]]]:
    """Disjoint best chains of matches (at, there), each in ascending order, best first."""
    order = np.lexsort((there, at))
    a, b = at[order].tolist(), there[order].tolist()
    n = len(a)
    rank = np.unique(there[order], return_inverse=True)[1].tolist()
    size = max(rank) + 1
    tree: list[tuple[float, int]] = [(0.0, -1)] * (size + 1)  # prefix maxima of score + gap_cost * (at + there)
    score, back = [0.0] * n, [-1] * n
    i = 0
    while i < n:
        j = i
        while j < n and a[j] == a[i]:  # matches at one place cannot follow each other
            best, r = (0.0, -1), rank[j]
            while r > 0:
                if tree[r][1] >= 0 and (best[1] < 0 or tree[r][0] > best[0]):
                    best = tree[r]
                r -= r & -r
            joined = best[0] - gap_cost * (a[j] + b[j]) if best[1] >= 0 else 0.0
            if joined > 0:
                back[j] = best[1]
            score[j] = weight + max(0.0, joined)
            j += 1
        for m in range(i, j):
            value, r = (score[m] + gap_cost * (a[m] + b[m]), m), rank[m] + 1
            while r <= size:
                if tree[r][1] < 0 or value[0] > tree[r][0]:
                    tree[r] = value
                r += r & -r
        i = j
    used = [False] * n
    out = []
    for end in sorted(range(n), key=lambda m: (-score[m], m)):
        if used[end]:
            continue
        m, chain = end, []
        while m >= 0 and not used[m]:
            used[m] = True
            chain.append((a[m], b[m]))
            m = back[m]
        out.append(chain[::-1])
    return out


def _one_chain(at: np.ndarray, there: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of runs of matches in order, those that ``chains`` makes one chain of: all ascend in both texts, each goes on
    from the one before it, and the score of the last one is the best."""
    size = ends - starts
    inner = np.ones(len(at), bool)
    inner[starts] = False
    ascends = np.ones(len(at), bool)
    ascends[1:] = (at[1:] > at[:-1]) & (there[1:] > there[:-1])
    place = at.astype(np.int64) + there
    score = SEED * (np.arange(len(at)) - np.repeat(starts, size) + 1) - GAP_COST * (place - np.repeat(place[starts], size))
    last = np.repeat(score[ends - 1], size)
    is_last = np.zeros(len(at), bool)
    is_last[ends - 1] = True
    # Near ties, where rounding decides, are left to ``chains``.
    good = (~inner | (ascends & (score > SEED + 1e-6))) & (is_last | (score < last - 1e-6))
    return np.logical_and.reduceat(good, starts)


CHAIN = "late long, early long, a0 long, b0 long, a1 long, b1 long, steps binary"


def _chain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by document pair: the chains, for alignment to decide on, however short; ``steps`` are their matches as 32-bit places.

    A seed and a long run at the same places are one match.
    """
    types = {"late": pa.int64(), "early": pa.int64(), "a0": pa.int64(), "b0": pa.int64(), "a1": pa.int64(), "b1": pa.int64(), "steps": pa.binary()}

    def found(pair: tuple[int, int], held: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple]:
        at, there = (np.concatenate(c) for c in zip(*held))
        at, there = np.array(sorted(set(zip(at.tolist(), there.tolist())))).T
        return [(*pair, *c[0], c[-1][0] + SEED, c[-1][1] + SEED, np.array(c, np.int32).tobytes()) for c in chains(at, there)]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], names=list(types))

    def whole(late: np.ndarray, early: np.ndarray, at: np.ndarray, there: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        first, last = (np.stack((at, there), axis=1)[m].astype(np.int64) for m in (starts, ends - 1))
        size = ends - starts
        offset = np.concatenate(([0], np.cumsum(size)))
        places = np.repeat(starts - offset[:-1], size) + np.arange(offset[-1])
        steps = np.stack((at[places], there[places]), axis=1).astype(np.int32)
        steps = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((8 * offset).astype(np.int32)), pa.py_buffer(steps)])
        ends_ = (first[:, 0], first[:, 1], last[:, 0] + SEED, last[:, 1] + SEED)
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in (late[starts], early[starts], *ends_)), steps], names=list(types))

    pair, held = None, []
    for batch in batches:
        late, early, at, there = (batch.column(c).to_numpy() for c in ("late", "early", "at", "there"))
        if not len(late):
            continue
        cuts = np.flatnonzero((late[1:] != late[:-1]) | (early[1:] != early[:-1])) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(late)]))
        # The pairs at a batch's ends may go on in another; of the others some make one chain for sure.
        of = np.repeat(np.arange(len(starts)), ends - starts)
        order = np.lexsort((there, at, of))
        at, there = at[order], there[order]
        new = np.ones(len(at), bool)
        new[1:] = (of[1:] != of[:-1]) | (at[1:] != at[:-1]) | (there[1:] != there[:-1])
        late, early, at, there = late[new], early[new], at[new], there[new]
        ends = np.cumsum(np.bincount(of[new]))
        starts = np.concatenate(([0], ends[:-1]))
        one = _one_chain(at, there, starts, ends)
        one[[0, -1]] = False
        if one.any():
            yield whole(late, early, at, there, starts[one], ends[one])
        rows: list[tuple] = []
        for lo, hi in zip(starts[~one].tolist(), ends[~one].tolist()):
            key = (int(late[lo]), int(early[lo]))
            if key != pair:
                if held:
                    rows += found(pair, held)
                pair, held = key, []
            held.append((at[lo:hi], there[lo:hi]))
        if rows:
            yield batch_of(rows)
    if held and (rows := found(pair, held)):
        yield batch_of(rows)


def walk(x: np.ndarray, y: np.ndarray, resync: int = RESYNC) -> tuple[int, int, int]:
    """Words of ``x`` and ``y`` that an alignment from their starts covers, and how many match.

    After a difference it goes on with the same word one or two further on in
    both, or else with the nearest pair of equal word pairs within ``resync``. The alignment ends with the match up to which matches outnumber
    differences most, so chance matches beyond a passage are not part of it.
    """
    i = j = matched = differing = 0
    best = (0, 0, 0, 0)
    n, m = len(x), len(y)
    while i < n and j < m:
        run = min(n - i, m - j)
        differ = np.flatnonzero(x[i:i + run] != y[j:j + run])
        same = int(differ[0]) if len(differ) else run
        if same:
            i, j, matched = i + same, j + same, matched + same
            best = max(best, (matched - differing, i, j, matched))
        if i >= n or j >= m:
            break
        replaced = next((d for d in (1, 2) if i + d < n and j + d < m and x[i + d] == y[j + d]), 0)
        if replaced:
            i, j, differing = i + replaced, j + replaced, differing + replaced
            continue
        xs, ys = x[i:i + resync + 2], y[j:j + resync + 2]
        eq = xs[:, None] == ys[None, :]
        two = eq[:-1, :-1] & eq[1:, 1:]
        hits = np.argwhere(two)
        if not len(hits):
            break
        cost = hits.max(axis=1) * 1000 + hits.sum(axis=1)
        di, dj = hits[int(cost.argmin())]
        i, j, differing = i + int(di), j + int(dj), differing + int(max(di, dj))
    return best[1:]


def stretches(x: np.ndarray, y: np.ndarray, steps: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """The parts of a chain that alignments cover: (start, end) in ``x``, (start, end) in ``y``, matching words.

    An alignment starts at the first match beyond the stretch before it and goes
    both ways, backwards at most to that stretch, so matches behind a gap count too.
    """
    out, i, j, k = [], 0, 0, 0
    while True:
        k += int(np.searchsorted(steps[k:, 0], i))
        while k < len(steps) and steps[k, 1] < j:
            k += 1
        if k == len(steps):
            return out
        a, b = int(steps[k, 0]), int(steps[k, 1])
        ri, rj, right = walk(x[a:], y[b:])
        li, lj, left = walk(x[i:a][::-1], y[j:b][::-1])
        if left + right:
            out.append((a - li, a + ri, b - lj, b + rj, left + right))
            i, j = a + ri, b + rj
        k += 1


def joined(parts: list[tuple[int, int, int, int, int]], min_words: int, identity: float) -> list[tuple[int, int, int, int, int]]:
    """Stretches joined with the next one while the whole reaches the identity; those that are passages."""
    def similar(p: tuple[int, int, int, int, int]) -> bool:
        return p[4] >= identity * max(p[1] - p[0], p[3] - p[2])

    whole: list[tuple[int, int, int, int, int]] = []
    for part in parts:
        if whole and similar(both := (whole[-1][0], part[1], whole[-1][2], part[3], whole[-1][4] + part[4])):
            whole[-1] = both
        else:
            whole.append(part)
    return [p for p in whole if max(p[1] - p[0], p[3] - p[2]) >= min_words and similar(p)]


def passages(x: np.ndarray, y: np.ndarray, steps: np.ndarray, min_words: int, identity: float) -> list[tuple[int, int, int, int, int]]:
    """The passages of a chain; a match in none of them is aligned for itself, as a chain of its own."""
    found = joined(stretches(x, y, steps), min_words, identity)
    for a, b in steps.tolist() if len(steps) > 1 else ():
        if not any(p[0] <= a < p[1] and p[2] <= b < p[3] for p in found):
            i, j = max(a - MARGIN, 0), max(b - MARGIN, 0)
            own = stretches(x[i:a + SEED + MARGIN], y[j:b + SEED + MARGIN], np.array([[a - i, b - j]]))
            found += [(i + p[0], i + p[1], j + p[2], j + p[3], p[4]) for p in joined(own, min_words, identity)]
    return found


def _ahead(x: pa.Array, at: np.ndarray, step: int, n: int, none: int) -> np.ndarray:
    """Of each word slice the ``n`` words from a place on, forwards or backwards; ``none`` beyond its ends."""
    ends = np.frombuffer(x.buffers()[1], np.int32)[x.offset:x.offset + len(x) + 1].astype(np.int64) // 4
    held = np.frombuffer(x.buffers()[2], np.uint32) if x.buffers()[2] else np.empty(0, np.uint32)
    words = np.append(held[ends[0]:ends[-1]].astype(np.int64), none)
    left = (ends[1:] - ends[:-1] - at if step > 0 else at + 1)[:, None]
    ahead = np.arange(n)
    return words[np.where(ahead < left, (ends[:-1] - ends[0] + at)[:, None] + step * ahead, len(words) - 1)]


def _first_run(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words ``walk`` covers before the first difference or a slice's end, and whether it ends there.

    Rows hold more words than any slice has left, so each has a difference.
    """
    run = (x != y).argmax(axis=1)
    first = run[:, None] + np.arange(3)
    xs, ys = np.take_along_axis(x, first, axis=1), np.take_along_axis(y, first, axis=1)
    over = (xs[:, 0] < 0) | (ys[:, 0] < 0)
    # Beyond the end of a slice there is nothing to go on with.
    open_ = np.flatnonzero(~(over | (xs[:, 1:] == ys[:, 1:]).any(axis=1)))
    at = run[open_, None] + np.arange(RESYNC + 2)
    eq = x[open_[:, None], at][:, :, None] == y[open_[:, None], at][:, None, :]
    over[open_] = ~(eq[:, :-1, :-1] & eq[:, 1:, 1:]).any(axis=(1, 2))
    return run, over


def _one_run(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Chains of whose alignment one run of equal words, from the first match on both ways, is all: their rows, and
    per row (start, end) in ``x``, (start, end) in ``y``, as ``stretches`` gives them."""
    def words(column: str) -> np.ndarray:
        return pa.compute.binary_length(batch.column(column)).to_numpy().astype(np.int64) // 4

    size = {c: words(c) for c in ("x", "y")}
    some = np.flatnonzero((np.maximum(size["x"], size["y"]) <= BATCHED) & (words("steps") > 0))
    some = some[np.argsort(size["x"][some], kind="stable")]  # rows of about one width together
    rows, spans = [some[:0]], [np.empty((0, 4), np.int64)]
    for lo in range(0, len(some), 512):
        at = some[lo:lo + 512]
        part = batch.take(pa.array(at))
        steps = [np.frombuffer(m, np.int32) for m in part.column("steps").to_pylist()]
        ends = np.array([(m[0], m[1], m[-2], m[-1]) for m in steps], np.int64)
        oa, ob = part.column("oa").to_numpy(), part.column("ob").to_numpy()
        a, b = ends[:, 0] - oa, ends[:, 1] - ob
        whole, reach = np.ones(len(a), bool), []
        for step, i, j, most in ((-1, a - 1, b - 1, np.minimum(a, b)), (1, a, b, np.minimum(size["x"][at] - a, size["y"][at] - b))):
            n = int(most.max()) + RESYNC + 3
            run, over = _first_run(_ahead(part.column("x"), i, step, n, -1), _ahead(part.column("y"), j, step, n, -2))
            reach.append(run)
            whole &= over
        back, on = reach
        # Every other match is part of the run.
        apart = np.array([len(m) > 2 and (m[::2] - m[1::2] != m[0] - m[1]).any() for m in steps])
        whole &= ~apart & ((ends[:, 2] - oa < a + on) | (ends[:, 2] == ends[:, 0]))
        rows.append(at[whole])
        spans.append(np.stack((a - back, a + on, b - back, b + on), axis=1)[whole])
    return np.concatenate(rows), np.concatenate(spans)


def _no_passage(batch: pa.RecordBatch, min_words: int) -> np.ndarray:
    """Chains whose alignment ends both ways at the first difference, before it has ``min_words`` words."""
    out = np.zeros(batch.num_rows, bool)
    rows, spans = _one_run(batch)
    out[rows[spans[:, 1] - spans[:, 0] < min_words]] = True
    return out


def _aligned(batches: Iterator[pa.RecordBatch], min_words: int, identity: float) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start_word", "end_word", "source_id", "source_start", "source_end", "matched", "identity"]
    types = [pa.int64()] * 7 + [pa.float64()]
    for batch in batches:
        done, spans = _one_run(batch)
        long = spans[:, 1] - spans[:, 0] >= min_words
        if long.any() and identity <= 1:
            found = batch.select(["late", "early", "oa", "ob"]).take(pa.array(done[long]))
            late, early, oa, ob = (c.to_numpy() for c in found.columns)
            x0, x1, y0, y1 = spans[long].T
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (late, oa + x0, oa + x1, early, ob + y0, ob + y1, x1 - x0, np.ones(len(late)))], names=names)
        rows = []
        left = np.ones(batch.num_rows, bool)
        left[done] = False
        some = batch.filter(pa.array(left))
        for late, early, oa, ob, steps, x, y in zip(*(some.column(c).to_pylist() for c in ("late", "early", "oa", "ob", "steps", "x", "y"))):
            x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
            at = np.frombuffer(steps, np.int32).reshape(-1, 2) - np.array([oa, ob])  # within the slices
            rows += [(late, oa + p[0], oa + p[1], early, ob + p[2], ob + p[3], p[4], p[4] / max(p[1] - p[0], p[3] - p[2]))
                     for p in passages(x, y, at, min_words, identity)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in _word_rows(batch):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([(w >> np.uint64(32)).astype(np.uint32).tobytes() for w in texts], pa.binary())],
                names=["doc_id", "words"])


PASSAGE = ("doc_id long, start_word long, end_word long, source_id long, source_start long, source_end long, "
           "matched long, identity double")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                      identity: float = IDENTITY) -> DataFrame:
    """One row per passage of a document (``doc_id``) and where an earlier one (``source_id``) has it, in words."""
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .where("doc_id is not null"))
    seeded = map_batches(rows, partial(_seed_rows, min_words=min_words), "seed long, doc long, place int").repartition("seed")
    matches = map_batches(seeded.sortWithinPartitions("seed", "doc", "place"), _matches, "late long, early long, at int, there int")
    paired = matches.repartition("late", "early").sortWithinPartitions("late", "early")
    found = written(map_batches(paired, _chain_rows, CHAIN), "chains")
    ids = found.select(F.explode(F.array("late", "early")).alias("_id")).distinct()
    ids = small(written(ids, "ids"))
    words = map_batches(rows.join(ids, F.col("doc_id") == F.col("_id"), "left_semi"), _words, "doc_id long, words binary")
    words = written(words.dropDuplicates(["doc_id"]), "words")

    def cut(first: str, last: str):
        """Where the slice of a chain starts, and the slice with its margins (four bytes a word)."""
        start = F.greatest(F.col(first) - MARGIN, F.lit(0))
        return start, F.expr(f"substring(words, int(4 * greatest({first} - {MARGIN}, 0L) + 1), int(4 * ({last} + {MARGIN} - greatest({first} - {MARGIN}, 0L))))")

    oa, x = cut("a0", "a1")
    ob, y = cut("b0", "b1")
    rounds = []
    for no in range(ROUNDS):
        some = found.where(F.pmod(F.xxhash64("late", "early"), F.lit(ROUNDS)) == no)
        left = some.join(words.withColumnRenamed("doc_id", "late"), "late").select(*found.columns, oa.alias("oa"), x.alias("x"))
        both = left.join(words.withColumnRenamed("doc_id", "early"), "early").select("late", "early", "steps", "oa", "x", ob.alias("ob"), y.alias("y"))
        rounds.append(written(map_batches(both, partial(_aligned, min_words=min_words, identity=identity), PASSAGE).distinct(), "passages"))
    return reduce(DataFrame.union, rounds)


def repeated_spans(passages: DataFrame) -> DataFrame:
    """``doc_id, spans, repeated_words``: the disjoint word spans of a document that an earlier one has too."""
    spans = passages.select("doc_id", F.struct("start_word", "end_word").alias("s")).distinct()
    merged = F.aggregate(
        F.array_sort(F.collect_list("s")), F.array().cast("array<struct<start_word:bigint,end_word:bigint>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end_word"] >= s["start_word"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start_word"].alias("start_word"),
                F.greatest(F.element_at(acc, -1)["end_word"], s["end_word"]).alias("end_word")))))
        .otherwise(F.concat(acc, F.array(s))))
    out = spans.groupBy("doc_id").agg(merged.alias("spans"))
    return out.withColumn("repeated_words", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["start_word"]))
