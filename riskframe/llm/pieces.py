"""SentencePiece encoding and decoding by batched numpy Viterbi over distinct words.

Words of equal length advance together, one character at a time: hashes of all substrings that end
at the position probe the sorted keys of the pieces, and the maximum over them stores a backpointer.
The model is a BPE model, so the best path is the one that the merges give, not the one with the
largest sum of scores: a piece may follow the piece that ends the best path before it only if merging
would keep the boundary between the two (undoing their merges from the latest one backwards, no pair
across the boundary may merge earlier).  Exactly one piece passes at each position; the maximum finds it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskframe.llm.common import byte_slices, text_buffer
from riskframe.llm.shingles import BASE
from riskframe.llm.span_cache import SpanCache

U = np.uint64
SPACE = "▁"
#: Words of one batch in the lattice.
BATCH = 1 << 13


@dataclass
class Model:
    """A BPE piece table as arrays; built once on the driver."""

    keys: np.ndarray  # sorted hashes of the pieces a path may use
    key_ids: np.ndarray
    longest: int
    rank: np.ndarray  # order of the merge that makes a piece; -1: a single character
    left: np.ndarray  # the two pieces that merge into it
    right: np.ndarray
    pair_keys: np.ndarray  # left * size + right, sorted
    pair_rank: np.ndarray
    byte_ids: np.ndarray  # piece of each byte
    flat: np.ndarray  # bytes of all pieces, spaces restored
    starts: np.ndarray
    dummy_prefix: bool

    def __post_init__(self) -> None:
        self.key_seen, self.pair_seen = seen_table(self.keys), seen_table(self.pair_keys)

    @property
    def size(self) -> int:
        return len(self.rank) - 1

    @property
    def other(self) -> int:
        """Stands for a character without a piece, until its bytes replace it."""
        return self.size


#: Bits of the table that tells at once that a hash is none of the sorted keys.
SEEN_BITS = 18


def seen_table(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << SEEN_BITS, bool)
    out[slots(keys)] = True
    return out


def slots(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (keys.astype(np.uint64) * U(0x9E3779B97F4A7C15) >> U(64 - SEEN_BITS)).astype(np.int64)


def probe(keys: np.ndarray, seen: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``wanted`` (flat) that are among the sorted keys, their positions in ``keys``)."""
    at = np.flatnonzero(seen[slots(wanted)])
    some = wanted.ravel()[at]
    i = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
    ok = keys[i] == some
    return at[ok], i[ok]


def hash_text(codes: np.ndarray) -> np.ndarray:
    h = np.zeros(codes.shape[0], np.uint64)
    with np.errstate(over="ignore"):
        for j in range(codes.shape[1]):
            h = h * U(BASE) + codes[:, j].astype(np.uint64) + U(1)
    return h


def merge_chars(text: str, ranks: dict[str, float], last: float) -> list[str]:
    """Plain BPE of one short string with the merges that come before ``last``."""
    parts = list(text)
    while len(parts) > 1:
        best = min(((ranks.get(a + b, last), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(last, 0))
        if best[0] >= last:
            break
        parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return parts


def load_model(path: str) -> Model:
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    if proto.trainer_spec.model_type != 2:
        raise ValueError("only BPE models are supported")
    norm = proto.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only models with identity normalisation are supported")
    normal = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type == 1}
    if any(SPACE in p.lstrip(SPACE) for p in normal):
        raise ValueError("pieces may hold white space in front only")
    n = len(proto.pieces)
    by_score = sorted((p for p in normal if len(p) > 1), key=lambda p: (-normal[p][1], normal[p][0]))
    ranks = {p: float(r) for r, p in enumerate(by_score)}
    rank = np.full(n + 1, -1, np.int64)
    left, right = np.full(n + 1, n, np.int64), np.full(n + 1, n, np.int64)
    usable = {p for p in normal if len(p) == 1}
    for r, p in enumerate(by_score):
        parts = merge_chars(p, ranks, float(r))
        if len(parts) == 2 and parts[0] in normal and parts[1] in normal:
            i = normal[p][0]
            rank[i], left[i], right[i] = r, normal[parts[0]][0], normal[parts[1]][0]
            usable.add(p)
    pieces = sorted(usable, key=len)
    ids = np.array([normal[p][0] for p in pieces])
    keys = np.concatenate([hash_text(np.array([[ord(c) for c in p] for p in pieces if len(p) == k]))
                           for k in sorted({len(p) for p in pieces})])
    order = np.argsort(keys)
    made = np.flatnonzero(rank >= 0)
    pair = left[made] * (n + 1) + right[made]
    pair_order = np.argsort(pair)
    byte_ids = np.full(256, -1, np.int64)
    raw = []
    for i, p in enumerate(proto.pieces):
        if p.type == 6:
            byte_ids[int(p.piece[1:-1], 16)] = i
        raw.append(bytes([int(p.piece[1:-1], 16)]) if p.type == 6 else b"" if p.type == 3 else p.piece.replace(SPACE, " ").encode())
    if (byte_ids < 0).any():
        raise ValueError("only models with byte fallback are supported")
    return Model(keys[order], ids[order], max(map(len, usable)), rank, left, right, pair[pair_order], rank[made][pair_order],
                 byte_ids, np.frombuffer(b"".join(raw), np.uint8).copy(),
                 np.concatenate(([0], np.cumsum([len(x) for x in raw]))), norm.add_dummy_prefix)


def stays_apart(m: Model, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the boundary between pieces a and b survives all merges."""
    ok = np.ones(len(a), bool)
    at = np.arange(len(a))
    a, b = a.copy(), b.copy()
    limit = np.full(len(a), np.iinfo(np.int64).max)
    while len(at):
        key = a * (m.size + 1) + b
        hit, i = probe(m.pair_keys, m.pair_seen, key)
        merges = np.zeros(len(key), bool)
        merges[hit] = m.pair_rank[i] < limit[hit]
        ok[at[merges]] = False
        ra, rb = m.rank[a], m.rank[b]
        on = ~merges & ((ra >= 0) | (rb >= 0))
        at, a, b, ra, rb = at[on], a[on], b[on], ra[on], rb[on]
        first = ra > rb
        limit = np.where(first, ra, rb + 1)
        a, b = np.where(first, m.right[a], a), np.where(first, b, m.left[b])
    return ok


def encode_words(m: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, ids) of the words' pieces."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    sizes = np.zeros(len(words), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # word, place from the end, id
    for n in np.unique(lengths):
        same = np.flatnonzero(lengths == n)
        step = max(1, BATCH // max(1, int(n) // 8))
        for lo in range(0, len(same), step):
            rows = same[lo:lo + step]
            codes = np.frombuffer("".join([words[i] for i in rows]).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(rows), n)
            last, back = lattice(m, codes)
            at = np.full(len(rows), n)
            live, place = np.arange(len(rows)), 0
            while len(live):
                i = at[live]
                found.append((rows[live], np.full(len(live), place), last[live, i]))
                odd = found[-1][2] == m.other
                if odd.any():  # replaced by bytes below
                    found[-1][2][odd] = -1 - codes[live[odd], i[odd] - 1].astype(np.int64)
                at[live] -= back[live, i]
                live = live[at[live] > 0]
                place += 1
    if not found:
        return sizes, np.zeros(0, np.int64)
    word, place, ids = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((-place, word))
    word, ids = word[order], ids[order]
    odd = np.flatnonzero(ids < 0)
    if len(odd):
        raw = [m.byte_ids[list(chr(-1 - c).encode("utf-8", "surrogatepass"))] for c in ids[odd]]
        times = np.ones(len(ids), np.int64)
        times[odd] = [len(r) for r in raw]
        new = np.repeat(ids, times)
        new[np.repeat(ids < 0, times)] = np.concatenate(raw)
        word, ids = np.repeat(word, times), new
    return np.bincount(word, minlength=len(words)), ids


def lattice(m: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, length) that end the best path of every prefix of each word (rows of equal length)."""
    rows, n = codes.shape
    top = min(n, m.longest)
    ids = []
    with np.errstate(over="ignore"):
        h = np.zeros((rows, n), np.uint64)
        for size in range(1, top + 1):
            h = h[:, :n - size + 1] * U(BASE) + codes[:, size - 1:].astype(np.uint64) + U(1)
            found = np.full(h.shape, m.other if size == 1 else -1, np.int32)
            hit, i = probe(m.keys, m.key_seen, h)
            found.ravel()[hit] = m.key_ids[i]
            ids.append(found)
    last, back = np.full((rows, n + 1), -1), np.zeros((rows, n + 1), np.int64)
    for i in range(1, n + 1):
        reach = min(i, top)
        piece = np.stack([ids[size - 1][:, i - size] for size in range(1, reach + 1)], axis=1)
        row, size = np.nonzero(piece >= 0)
        piece, size = piece[row, size], size + 1
        ok = size == i
        inner = np.flatnonzero(~ok)
        ok[inner] = stays_apart(m, last[row[inner], i - size[inner]], piece[inner])
        best = np.zeros(rows, np.int64)
        np.maximum.at(best, row[ok], size[ok])
        chosen = ok & (size == best[row])
        last[row[chosen], i] = piece[chosen]
        back[:, i] = best
    return last, back


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of parts that no piece spans: each begins with its run of spaces (each text starts one)."""
    n = len(data)
    cut = data == 0x20
    b1, b2, b3 = (np.concatenate((np.zeros(j, np.uint8), data[:-j]))[:n] for j in (1, 2, 3))
    cut &= (b1 != 0x20) & ~((b3 == 0xE2) & (b2 == 0x96) & (b1 == 0x81))  # U+2581 itself stands for a space
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


class WordEncoder:
    """Ids of many texts; each distinct word goes through the lattice once per worker."""

    def __init__(self, model: Model):
        self.model = model
        self.cache = SpanCache(lambda new: encode_words(model, [w.replace(" ", SPACE) for w in new]))

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of each text's pieces; an empty text has none."""
        if self.model.dummy_prefix:
            filled = np.diff(offsets) > 0
            data = np.insert(data, offsets[:-1][filled], 0x20)
            offsets = offsets + np.concatenate(([0], np.cumsum(filled)))
        start = word_starts(data, offsets)
        ends, ids = self.cache(data, start, np.append(start[1:], len(data)))
        return ends[np.searchsorted(start, offsets)], ids


def decode(m: Model, offsets: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """The texts of ids: pieces' bytes side by side, the space in front taken away again."""
    size = np.diff(m.starts)[ids]
    ends = np.concatenate(([0], np.cumsum(size)))
    flat = m.flat[np.arange(ends[-1]) + np.repeat(m.starts[:-1][ids] - ends[:-1], size)].tobytes()
    out = []
    for a, b in zip(ends[offsets[:-1]], ends[offsets[1:]]):
        raw = flat[a:b]
        out.append(raw[1:] if m.dummy_prefix and raw[:1] == b" " else raw)
    return out


_encoders: dict[str, WordEncoder] = {}


def encode_texts(docs: DataFrame, model: Model, name: str, carry: list[str],
                 make: Callable[[Model, list[bytes], np.ndarray, np.ndarray], list[pa.Array]], schema: str) -> DataFrame:
    """Run the encoder over ``text`` and add the columns that ``make`` builds from ids to ``carry``.

    Null texts are empty and have no ids.  ``name`` keeps workers' caches of several models apart.
    """
    fields = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _encoders:
            _encoders[name] = WordEncoder(model)
        enc = _encoders[name]
        for batch in batches:
            data, off = text_buffer(batch.column(len(carry)))
            for lo, hi in byte_slices(off, 3 << 20):
                part, o = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                raw = [part[a:b].tobytes() for a, b in zip(o[:-1], o[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(lo, hi - lo) for i in range(len(carry))] + make(enc.model, raw, *enc(part, o)), fields)

    return docs.select(*carry, "text").mapInArrow(run, schema)


def with_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids of every document."""
    make = lambda m, raw, o, ids: [pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(ids, pa.int32()))]
    return encode_texts(docs, load_model(path), path, ["doc_id"], make, "doc_id bigint, ids array<int>")


def with_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian 32-bit ids), and whether decoding gives the text back."""
    def make(m, raw, o, ids):
        le = ids.astype("<u4").tobytes()
        same = [d == t.replace(SPACE.encode(), b" ") for d, t in zip(decode(m, o, ids), raw)]
        return [pa.array(np.diff(o)), pa.array([zlib.crc32(le[4 * a:4 * b]) for a, b in zip(o[:-1], o[1:])], pa.int64()), pa.array(same)]

    return encode_texts(docs, load_model(path), path, ["doc_id"], make,
                        "doc_id bigint, n_ids bigint, ids_crc32 bigint, round_trip boolean")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6(spark, sf_dir: str, model_path: str | None = None) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_digests(docs, model_path or default_model())
