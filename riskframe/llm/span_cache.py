"""A worker's memory of encoded spans: what many texts share is encoded once, and looked up by hash."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from riskframe.llm.shingles import span_hashes

#: Spans that a worker keeps before it starts anew (about 13 bytes and the ids each).
LIMIT = 1_000_000


class SpanCache:
    """Ids of byte spans; ``learn`` encodes spans that are new: list of texts -> (sizes, ids)."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = LIMIT):
        self.learn, self.limit = learn, limit
        self.reset()

    def reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def add(self, keys: np.ndarray, texts: list[str]) -> None:
        """``keys`` are sorted and new."""
        sizes, ids = self.learn(texts)
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat[:self.used], np.zeros(max(self.used, len(ids)), np.int32)))
        self.flat[self.used:self.used + len(ids)] = ids
        at = np.searchsorted(self.keys, keys)
        self.starts = np.insert(self.starts, at, self.used + np.cumsum(sizes) - sizes)
        self.sizes = np.insert(self.sizes, at, sizes)
        self.keys = np.insert(self.keys, at, keys)
        self.used += len(ids)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets of each span's ids, ids)."""
        if len(start) == 0:
            return np.zeros(1, np.int64), np.zeros(0, np.int32)
        if len(self.keys) > self.limit:
            self.reset()
        keys, first, inverse = np.unique(span_hashes(data, start, end, fold=False), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        if not known.all():
            new = first[~known]
            raw = data.tobytes()
            self.add(keys[~known], [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(start[new].tolist(), end[new].tolist())])
            at = np.searchsorted(self.keys, keys)
        code = at[inverse]
        size = self.sizes[code].astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(size)))
        return ends, self.flat[np.arange(ends[-1]) + np.repeat(self.starts[code] - ends[:-1], size)]
