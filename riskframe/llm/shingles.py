"""Numpy kernels over many texts at once: word hashes, 5-word shingles, bottom-k sketches."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15
SHINGLE_WORDS = 5
#: Bytes that are hashed at once.
HASH_BLOCK = 1 << 17
#: Powers are made in steps of so many, and kept up to so many.
STEP, KEEP = 1 << 17, 5 << 18

_space = np.zeros(256, bool)
_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.full(max(1, -(-n // STEP)) * STEP, U(base))
        p[0] = 1
        with np.errstate(over="ignore"):
            have = np.cumprod(p, dtype=np.uint64)
        if len(have) <= KEEP:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, start, end) of every word ``[^\\x20\\x09-\\x0D]+``."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~_space[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | first[1:])) + 1
    return np.searchsorted(offsets, start, side="right") - 1, start, end


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each span of bytes (in order), A-Z lower-cased if ``fold``.

    The hash does not depend on where a span stands, so blocks of spans that fit a processor's cache
    are worked on one after another.
    """
    out = np.empty(len(start), np.uint64)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(start // HASH_BLOCK)) + 1, [len(start)])) if len(start) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        base, stop = start[a], end[a:b].max()
        out[a:b] = _block_hashes(data[base:stop], start[a:b] - base, end[a:b] - base, fold)
    return out


def _block_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    n = len(data)
    with np.errstate(over="ignore"):
        h = np.zeros(n + 1, np.uint64)
        src = _lower[data] if fold else data
        np.cumsum((src.astype(np.uint64) + U(1)) * powers(BASE, n), out=h[1:])
        inv = pow(BASE, -1, 1 << 64)
        got = (h[end] - h[start]) * powers(inv, n + 1)[start]
        return mix(got + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values): the sorted distinct k-word shingle hashes of each text.

    A text of fewer words has the hash of its whole word sequence; one without words, none.
    """
    m = len(offsets) - 1
    doc, start, end = word_spans(data, offsets)
    if len(doc) == 0:
        return np.zeros(m + 1, np.int64), np.zeros(0, np.uint64)
    w = span_hashes(data, start, end)
    count = np.bincount(doc, minlength=m)
    at = np.concatenate(([0], np.cumsum(count)[:-1]))
    parts_d, parts_h = [], []
    with np.errstate(over="ignore"):
        if len(w) >= k:
            size = len(w) - k + 1
            h = np.full(size, U(k))
            for j in range(k):
                h = h * U(BASE) + w[j:j + size]
            whole = doc[:size] == doc[k - 1:]
            parts_d.append(doc[:size][whole])
            parts_h.append(mix(h[whole]))
        short = np.flatnonzero((count > 0) & (count < k))
        if len(short):
            h = count[short].astype(np.uint64)
            for j in range(k - 1):
                has = count[short] > j
                h[has] = h[has] * U(BASE) + w[at[short[has]] + j]
            parts_d.append(short)
            parts_h.append(mix(h))
    d, h = np.concatenate(parts_d), np.concatenate(parts_h)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    d, h = d[new], h[new]
    return np.concatenate(([0], np.cumsum(np.bincount(d, minlength=m)))), h


def bottom_k(offsets: np.ndarray, values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k of each sorted set."""
    size = np.diff(offsets)
    rank = np.arange(len(values)) - np.repeat(offsets[:-1], size)
    return np.concatenate(([0], np.cumsum(np.minimum(size, k)))), values[rank < k]


def resemblance(ao: np.ndarray, av: np.ndarray, bo: np.ndarray, bv: np.ndarray, k: int) -> np.ndarray:
    """Estimated Jaccard likeness of sketches, pair by pair, from the bottom k of each union.

    Two empty sketches are alike (1.0); an empty and a filled one are not (0.0).
    """
    m = len(ao) - 1
    pair = np.concatenate((np.repeat(np.arange(m), np.diff(ao)), np.repeat(np.arange(m), np.diff(bo))))
    v = np.concatenate((av, bv))
    order = np.lexsort((v, pair))
    pair, v = pair[order], v[order]
    new = np.ones(len(v), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(new)
    both = np.diff(np.concatenate((at, [len(v)]))) == 2
    owner = pair[at]
    size = np.bincount(owner, minlength=m)
    rank = np.arange(len(at)) - np.repeat(np.concatenate(([0], np.cumsum(size)[:-1])), size)
    hit = np.bincount(owner[both & (rank < k)], minlength=m)
    seen = np.minimum(size, k)
    return np.where(seen == 0, 1.0, hit / np.maximum(seen, 1))
