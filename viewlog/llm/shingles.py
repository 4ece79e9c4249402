"""Word and shingle hashes of whole texts, in numpy, for use inside tasks."""

from __future__ import annotations

import re

import numpy as np

_U = np.uint64
_RNG = np.random.default_rng(20240229)
#: A random odd 64-bit number for each byte, and the base of the word polynomial.
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CUT = re.compile(rb"[\x20\x09-\x0D]")

PIECE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _piece_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    solid = ~_BLANK[raw]
    if not solid.any():
        return np.empty(0, np.uint64)
    edge = np.diff(np.concatenate(([False], solid, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = ends - starts
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    letters = raw[solid]
    offset = np.arange(len(letters)) - np.repeat(first, size)
    terms = _BYTE[letters] * _powers(int(size.max()))[offset]
    return mixed(np.add.reduceat(terms, first) + size.astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text, in order; memory follows the words, in pieces of a megabyte."""
    if len(data) <= 2 * PIECE:
        return _piece_hashes(data)
    out, at = [], 0
    while at < len(data):
        cut = _CUT.search(data, min(len(data), at + PIECE))
        stop = cut.start() if cut else len(data)
        out.append(_piece_hashes(data[at:stop]))
        at = stop
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words, in order."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total = mixed(total * _U(0x2545F4914F6CDD1D) + words[i:len(words) - n + 1 + i])
    return total


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return np.empty(0, np.uint64)
    if len(words) < n:
        return windows(words, len(words)) ^ _U(len(words))
    return np.unique(windows(words, n))


def texts_word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """``word_hashes`` of many texts; short ones are hashed together."""
    out: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
    held, size = [], 0

    def flush() -> None:
        nonlocal held, size
        if held:
            # One blank between texts; words are told apart by the texts' word counts.
            counts = [len(texts[i].split()) for i in held]
            found = _piece_hashes(b"\n".join(texts[i] for i in held))
            for i, part in zip(held, np.split(found, np.cumsum(counts)[:-1])):
                out[i] = part
        held, size = [], 0

    for i, data in enumerate(texts):
        if len(data) > PIECE:
            out[i] = word_hashes(data)
            continue
        if size + len(data) > PIECE:
            flush()
        held.append(i)
        size += len(data)
    flush()
    return out


def popcount(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits)
