"""Suffix-array dedup: removes every byte that lies in a long string which also starts elsewhere.

A sparse suffix array: each window of ``length`` bytes is owned by one anchor, the position of its
smallest K-gram hash (leftmost if equal), so equal windows lie at the same distance before anchors
with the same K-gram.  The windows of an anchor form one string, the extended suffix.  Suffixes of
anchors whose K-gram occurs again are range-partitioned by their leading bytes with sampled
splitters; a bucket sorts them by multikey quicksort, forwards from the anchor and backwards before
it, and the neighbours' common prefixes tell which windows are equal.  Splitters are shorter than K,
so equal K-grams never lie on two sides of a bucket's boundary; the comparison across boundaries is
decided by the splitters themselves.  A K-gram that stands so often that its suffixes would not fit a
bucket (HOT) is split further: its windows are dealt out one by one, by a 128-bit digest, and combined
before the shuffle.

The pipeline's stage judges repeats by WORDS words as well, however few bytes they take: windows of WORDS
words are owned by their smallest gram of GRAM_WORDS words.  If all windows of a repeated gram's anchors
agree, one row per anchor settles them; the windows of the other repeated grams meet by digest.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import byte_slices, cut, partitions, text_buffer, unused
from riskframe.llm.shingles import BASE, mix, powers, span_hashes, word_spans

#: Bytes of a string that may not occur twice.
LENGTH = 400
#: Bytes of the K-gram at an anchor, and of the splitters.
K = 160
LEAD = 96
#: Words (as in ``word_spans``) of a passage that the pipeline's stage does not keep twice, and of its anchors' grams.
WORDS = 51
GRAM_WORDS = 20
#: A K-gram that more anchors than these have is split by the content of its windows.
HOT = 100_000
#: Bits of the maps by which a scan leaves out what cannot be repeated.
TEXT_BITS = 1 << 24
GRAM_BITS = 1 << 26
#: Bytes that are worked on at once.
SLICE = 1 << 20
#: Documents from which the splitters are sampled, about.
SAMPLE_DOCS = 4000


def bitmap(values: DataFrame, column: Column, bits: int) -> np.ndarray:
    """A bitmap of ``column`` modulo ``bits`` (a power of two); its size does not depend on the rows."""
    got = (values.select((F.pmod(column, F.lit(bits)) + 1).alias("h"))
           .groupBy(F.expr("bitmap_bucket_number(h)").alias("b"))
           .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("m")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in got:
        lo = (r["b"] - 1) * 4096
        out[lo:lo + 4096] = np.frombuffer(r["m"], np.uint8)[:len(out) - lo]
    return out


def has_bit(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    h = values.astype(np.int64) & (8 * len(bits) - 1)
    return (bits[h >> 3] >> (h & 7).astype(np.uint8) & 1).astype(bool)


def text_ids(raw: list[bytes]) -> np.ndarray:
    """Two 64-bit numbers per text, from its SHA-256."""
    return np.frombuffer(b"".join(hashlib.sha256(t).digest()[:16] for t in raw), "<i8").reshape(-1, 2)


def owners(gram: np.ndarray, w: int) -> np.ndarray:
    """Where the smallest of each ``w`` neighbouring hashes stands, the leftmost if equal."""
    low = gram & ~np.uint64(0xFFFFFF) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while 2 * span <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if w > span:
        low = np.minimum(low[:len(low) - (w - span)], low[w - span:])
    return (low & np.uint64(0xFFFFFF)).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = K):
    """(text, first window, last window, anchor, K-gram hash) of all runs of windows with one anchor.

    Positions count from the start of ``data``; texts shorter than ``length`` have no window.
    """
    z = np.zeros(0, np.int64)
    n, w = len(data), length - k + 1
    if n < length:
        return z, z, z, z, z.astype(np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=h[1:])
        inv = powers(pow(BASE, -1, 1 << 64), n + 1)
        gram = mix((h[k:] - h[:-k]) * inv[:n - k + 1])
    owner = owners(gram, w)  # one for each window start 0 .. n - length
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(owner)]
    valid = np.arange(len(owner)) + length <= offsets[text + 1]
    at = np.flatnonzero(valid)
    if len(at) == 0:
        return z, z, z, z, z.astype(np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = (owner[at[1:]] != owner[at[:-1]]) | (text[at[1:]] != text[at[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    a = owner[at[first]]
    return text[at[first]], at[first], at[last], a, gram[a]


def pieces(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, limit: int = SLICE):
    """Slices of whole texts, long texts cut with an overlap: (first text, bytes, offsets, start in text)."""
    for lo, hi in byte_slices(offsets, limit):
        a, b = offsets[lo], offsets[hi]
        if b - a <= 2 * limit:
            yield lo, data[a:b], offsets[lo:hi + 1] - a, 0
        else:
            for c in range(a, b - length + 1, limit):
                part = data[c:min(c + limit + length - 1, b)]
                yield lo, part, np.array([0, len(part)]), c - a


def word_anchors(data: np.ndarray, offsets: np.ndarray):
    """(text, first window, last window, anchor, gram hash) of all runs, and start and end of each window.

    As ``anchors``, for windows of WORDS words; windows and anchors are numbered by their first word.
    """
    z = np.zeros(0, np.int64)
    text, start, end = word_spans(data, offsets)
    m = len(text) - WORDS + 1
    if m < 1:
        return z, z, z, z, z.astype(np.uint64), z, z
    gram = span_hashes(data, start[:len(start) - GRAM_WORDS + 1], end[GRAM_WORDS - 1:], fold=False)
    owner = owners(gram, WORDS - GRAM_WORDS + 1)
    at = np.flatnonzero(text[:m] == text[WORDS - 1:])
    new = np.ones(len(at), bool)
    new[1:] = (owner[at[1:]] != owner[at[:-1]]) | (text[at[1:]] != text[at[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[:len(first)] - 1
    a = owner[at[first]]
    return text[at[first]], at[first], at[last], a, gram[a], start[:m], end[WORDS - 1:]


def word_pieces(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE):
    """As ``pieces``, for windows of WORDS words: long texts are cut at words, with an overlap."""
    for lo, hi in byte_slices(offsets, limit):
        a, b = offsets[lo], offsets[hi]
        if b - a <= 2 * limit:
            yield lo, data[a:b], offsets[lo:hi + 1] - a, 0
        else:
            _, start, end = word_spans(data[a:b], np.array([0, b - a]))
            step = max(1, limit // 8)
            for c in range(0, len(start) - WORDS + 1, step):
                part = data[a + start[c]:a + end[min(c + step + WORDS - 1, len(end)) - 1]]
                yield lo, part, np.array([0, len(part)]), int(start[c])


def word_sort(rows: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): byte strings in order within groups, and the common prefix of neighbours.

    Multikey quicksort, breadth first: all ranges that are still equal are split by their next eight
    bytes at once; a range of one string is done.  ``rows`` are zero-padded strings of ``sizes``
    bytes; a string sorts before those it begins.  ``common`` is -1 where a group begins.
    """
    n, width = rows.shape
    words = np.zeros((n, -(-width // 8) * 8), np.uint8)
    words[:, :width] = rows
    words = words.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    g = group[order]
    same = np.concatenate(([False], g[1:] == g[:-1]))  # equal to the string before, as far as seen
    for d in range(words.shape[1] + 1):
        again = same.copy()
        again[:-1] |= same[1:]
        at = np.flatnonzero(again)
        if len(at) == 0:
            break
        part = order[at]
        key = words[part, d] if d < words.shape[1] else sizes[part].astype(np.uint64)
        rng = np.cumsum(~same[at])
        inner = np.lexsort((key, rng))
        order[at] = part[inner]
        key = key[inner]
        if d < words.shape[1]:
            same[at[1:]] &= key[1:] == key[:-1]
    common = np.empty(n, np.int64)
    common[:1] = -1
    for lo in range(1, n, 4096):
        hi = min(n, lo + 4096)
        a, b = order[lo - 1:hi - 1], order[lo:hi]
        differ = rows[a] != rows[b]
        c = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        c = np.minimum(c, np.minimum(sizes[a], sizes[b]))
        common[lo:hi] = np.where(group[a] == group[b], c, -1)
    return order, common


def padded(flat: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """Rows of ``width`` bytes: flat[start], flat[start + step], ... up to ``size``, then zeros."""
    out = np.zeros((len(start), width), np.uint8)
    col = np.arange(width)
    for lo in range(0, len(start), 4096):
        s, z = start[lo:lo + 4096, None], size[lo:lo + 4096, None]
        inside = col < z
        out[lo:lo + 4096] = np.where(inside, flat[np.where(inside, s + step * col, 0)], 0)
    return out


def repeated_windows(x: list[bytes], before: np.ndarray, count: np.ndarray, many: np.ndarray, length: int = LENGTH,
                     k: int = K) -> list[np.ndarray]:
    """For each distinct extended suffix, which of its windows occur again (in it or another one).

    ``before``: bytes before the anchor, ``count``: windows, ``many``: it occurs at several places.
    Window j lies ``before - j`` bytes before the anchor.
    """
    n = len(x)
    size = np.array([len(s) for s in x])
    flat = np.frombuffer(b"".join(x), np.uint8)
    at = np.concatenate(([0], np.cumsum(size)[:-1])) + before
    right_size = size - before
    right = padded(flat, at, right_size, length)
    order, common = word_sort(right, right_size, np.zeros(n, np.int64))
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(common < k)
    several = np.bincount(group) > 1
    found = [np.full(c, m) for c, m in zip(count, many)]
    use = np.flatnonzero(several[group])
    if len(use) == 0:
        return found
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    left = padded(flat, at[use] - 1, before[use], length - k, -1)
    l_order, l_common = word_sort(left, before[use], group[use])
    l_rank = np.empty(len(use), np.int64)
    l_rank[l_order] = np.arange(len(use))
    first_o, last_o = before[use] - count[use] + 1, before[use]
    for o in range(int(max(0, first_o.min())), int(last_o.max()) + 1):
        has = np.flatnonzero((first_o <= o) & (o <= last_o))
        if len(has) < 2:
            continue
        key = np.cumsum(l_common < o)[l_rank[has]] * (n + 1) + np.cumsum(common < length - o)[rank[use[has]]]
        sort = np.argsort(key, kind="stable")
        key = key[sort]
        pair = key[1:] == key[:-1]
        hit = np.zeros(len(has), bool)
        hit[1:] |= pair
        hit[:-1] |= pair
        for i in use[has[sort[hit]]]:
            found[i][before[i] - o] = True
    return found


def _kept_texts(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Maps by which a scan passes over further copies of a text.

    A row stays if its text's bit is not among the texts that stand several times, or its id's bit
    is among the ids that stand for such texts.  Bits that coincide only let more rows through.
    """
    several = bitmap(keys.where("copies > 1"), F.col("t1"), TEXT_BITS)
    shared = keys.join(keys.where("copies > 1").select(F.pmod("t1", F.lit(TEXT_BITS)).alias("bit")).distinct(),
                       F.pmod(keys["t1"], F.lit(TEXT_BITS)) == F.col("bit"), "left_semi")
    owners = bitmap(shared, F.coalesce(F.col("rep"), F.lit(-1)), TEXT_BITS)
    return several, owners


def _scan(docs: DataFrame, maps, emit, schema: str, least: int = LENGTH) -> DataFrame:
    """Run ``emit(ids, data, offsets)`` over one row per distinct text (or a few) of ``least`` bytes or more."""
    several, owners = maps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            _, off = text_buffer(texts)
            for lo, hi in byte_slices(off, 2 * SLICE):
                part = texts.slice(lo, hi - lo)
                data, o = text_buffer(part)
                raw = [data[a:b].tobytes() for a, b in zip(o[:-1], o[1:])]
                ids = text_ids(raw)
                names = batch.column(0).slice(lo, hi - lo).fill_null(-1).to_numpy()
                keep = np.flatnonzero((~has_bit(several, ids[:, 0]) | has_bit(owners, names)) & (np.diff(o) >= least))
                if len(keep) < len(raw):
                    raw, ids = [raw[i] for i in keep], ids[keep]
                    data = np.frombuffer(b"".join(raw), np.uint8)
                    o = np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)
                if len(raw):
                    yield from emit(ids, data, o)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, sha256, t1, t2 of every row (null text: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            digests = [hashlib.sha256(data[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])]
            ids = np.frombuffer(b"".join(d.digest()[:16] for d in digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(off)), pa.array([d.hexdigest() for d in digests], pa.string()),
                 pa.array(ids[:, 0].copy()), pa.array(ids[:, 1].copy())], ["doc_id", "n_bytes", "sha256", "t1", "t2"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_bytes bigint, sha256 string, t1 bigint, t2 bigint")


def repeated_spans(docs: DataFrame, named: DataFrame, words: bool = False) -> tuple[DataFrame, tuple]:
    """(t1, t2, spans) of every distinct text with repeated bytes, and the maps of its scan.

    Spans are maximal runs of bytes that are covered by a LENGTH-byte string which also starts
    anywhere else, or with ``words`` by such a string of WORDS whole words.
    """
    runs, keys, maps = _byte_runs(docs, named)
    return cut(_merged(runs.unionByName(_word_runs(docs, keys, maps)) if words else runs)), maps


def _byte_runs(docs: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame, tuple]:
    """(t1, t2, s, e) of repeated strings of LENGTH bytes, runs that may overlap; distinct texts; maps of the scan.

    Equal texts share every suffix: one of them is sorted, and if it has LENGTH bytes or more, all of it is repeated.
    """
    keys = cut(named.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"),
                                             F.first("n_bytes").alias("n_bytes")))
    maps = _kept_texts(keys)

    def grams(ids, data, o):
        for lo, part, po, at in pieces(data, o):
            text, first, _, a, gram = anchors(part, po)
            with np.errstate(over="ignore"):
                place = mix(ids[lo + text, 0].astype(np.uint64) + (a - po[text] + at).astype(np.uint64) * np.uint64(BASE))
            yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(place.astype(np.int64))], ["gram", "place"])

    # The same anchor may stand in several scanned copies of a text: two places must differ.
    seen = cut(_scan(docs, maps, grams, "gram bigint, place bigint").groupBy("gram").agg(
        F.min("place").alias("a"), F.max("place").alias("b"), F.count(F.lit(1)).alias("n")).where("a != b").select("gram", "n"))
    twice = bitmap(seen.where(F.col("n") <= HOT), F.col("gram"), GRAM_BITS)
    hot = bitmap(seen.where(F.col("n") > HOT), F.col("gram"), GRAM_BITS)

    def suffixes(splitters):
        def emit(ids, data, o):
            for lo, part, po, at in pieces(data, o):
                text, first, last, a, gram = anchors(part, po)
                use = np.flatnonzero(has_bit(twice, gram.astype(np.int64)))
                if len(use) == 0:
                    continue
                text, first, last, a = text[use], first[use], last[use], a[use]
                raw = part.tobytes()
                # equal suffixes of a slice travel once, with the list of their places
                found: dict[tuple[bytes, int], list[int]] = {}
                for i, (f, e, p) in enumerate(zip(first.tolist(), last.tolist(), a.tolist())):
                    found.setdefault((raw[f:e + LENGTH], p - f), []).append(i)
                where = list(found.values())
                flat = np.array([i for v in where for i in v])
                ends = np.concatenate(([0], np.cumsum([len(v) for v in where]))).astype(np.int32)
                pos = first[flat] - po[text[flat]] + at
                own = ids[lo + text[flat]]
                listed = lambda v: pa.ListArray.from_arrays(pa.array(ends), pa.array(v))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bisect_right(splitters, s[b:b + LEAD]) for s, b in found], pa.int32()),
                     pa.array([s for s, _ in found], pa.binary()), pa.array([b for _, b in found], pa.int32()),
                     listed(own[:, 0].copy()), listed(own[:, 1].copy()), listed(pos)],
                    ["bucket", "x", "before", "t1", "t2", "pos"])

        return emit

    schema = "bucket int, x binary, before int, t1 array<bigint>, t2 array<bigint>, pos array<bigint>"
    n_buckets = partitions(docs.sparkSession)
    n_docs = max(1, keys.count())
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 20)) < int(min(1.0, SAMPLE_DOCS / n_docs) * (1 << 20)))
    sample = sorted(bytes(r["s"]) for r in _scan(chosen, maps, suffixes([]), schema).select(
        F.expr(f"substring(x, before + 1, {LEAD})").alias("s")).collect())
    splitters = sorted({sample[len(sample) * i // n_buckets] for i in range(1, n_buckets)}) if sample else []

    def sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or table.num_rows == 0:
            return
        distinct: dict[tuple[bytes, int], list[int]] = {}
        for i, key in enumerate(zip(table["x"].to_pylist(), table["before"].to_pylist())):
            distinct.setdefault(key, []).append(i)
        t1, t2, pos = (table[c].combine_chunks() for c in ("t1", "t2", "pos"))
        ends = pos.offsets.to_numpy()
        t1, t2, pos = (c.flatten().to_numpy() for c in (t1, t2, pos))
        x = [s for s, _ in distinct]
        before = np.array([b for _, b in distinct])
        count = np.array([len(s) for s in x]) - LENGTH + 1
        places = [np.concatenate([np.arange(ends[i], ends[i + 1]) for i in rows]) for rows in distinct.values()]
        many = np.array([len(p) > 1 and bool((t1[p] != t1[p[0]]).any() or (t2[p] != t2[p[0]]).any() or (pos[p] != pos[p[0]]).any())
                         for p in places])
        out = [[], [], [], []]
        for p, windows in zip(places, repeated_windows(x, before, count, many)):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], windows.astype(np.int8), [0]))))
            for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
                out[0].append(t1[p])
                out[1].append(t2[p])
                out[2].append(pos[p] + s)
                out[3].append(pos[p] + e - 1 + LENGTH)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["t1", "t2", "s", "e"])

    runs = (_scan(docs, maps, suffixes(splitters), schema).repartitionById(n_buckets, F.col("bucket"))
            .mapInArrow(sort_bucket, "t1 bigint, t2 bigint, s bigint, e bigint"))
    if hot.any():
        runs = runs.unionByName(_hot_runs(docs, maps, hot))
    runs = runs.unionByName(keys.where(f"copies > 1 and n_bytes >= {LENGTH}").select("t1", "t2", F.lit(0).cast("bigint").alias("s"),
                                                                                 F.col("n_bytes").alias("e")))
    return runs, keys, maps


def _merged(runs: DataFrame) -> DataFrame:
    """(t1, t2, spans): the maximal runs of bytes that ``runs`` cover."""
    order = Window.partitionBy("t1", "t2").orderBy("s", "e")
    upto = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.coalesce((F.col("s") > F.col("upto")).cast("int"), F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (runs.withColumn("upto", upto).withColumn("island", island).groupBy("t1", "t2", "island")
            .agg(F.min("s").alias("s"), F.max("e").alias("e"))
            .groupBy("t1", "t2").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans")))


def _hot_runs(docs: DataFrame, maps, hot: np.ndarray) -> DataFrame:
    """(t1, t2, s, e) of the repeated windows whose anchors have a hot K-gram, as runs of bytes."""

    def chosen(data, o):
        for lo, part, po, at in pieces(data, o):
            text, first, last, _, gram = anchors(part, po)
            use = np.flatnonzero(has_bit(hot, gram.astype(np.int64)))
            start = _each(first[use], last[use])
            text = np.repeat(text[use], last[use] - first[use] + 1)
            yield part, lo + text, start, start + LENGTH, at - po[text]

    return _equal_windows(docs, maps, chosen, LENGTH)


def _each(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """first[0] .. last[0], first[1] .. last[1], ..."""
    n = last - first + 1
    ends = np.cumsum(n)
    return np.arange(n.sum()) + np.repeat(first - (ends - n), n)


def _word_runs(docs: DataFrame, keys: DataFrame, maps) -> DataFrame:
    """(t1, t2, s, e) of the strings of WORDS whole words that also start elsewhere, as runs of bytes."""
    least = 2 * WORDS - 1
    several = maps[0]

    def grams(ids, data, o):
        for lo, part, po, at in word_pieces(data, o):
            text, first, last, a, gram, start, end = word_anchors(part, po)
            place = np.zeros(0, np.uint64) if len(text) == 0 else start[first] - po[text] + at
            with np.errstate(over="ignore"):
                place = mix(ids[lo + text, 0].astype(np.uint64) + place.astype(np.uint64) * np.uint64(BASE))
                run = mix(span_hashes(part, start[first], end[last], fold=False) + (a - first).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (gram, place, run)], ["gram", "place", "run"])

    seen = cut(_scan(docs, maps, grams, "gram bigint, place bigint, run bigint", least).groupBy("gram").agg(
        F.min("place").alias("a"), F.max("place").alias("b"), F.min("run").alias("r"), F.max("run").alias("q"))
        .where("a != b").select("gram", F.expr("r = q").alias("agree")))
    agree = bitmap(seen.where("agree"), F.col("gram"), GRAM_BITS)
    mixed = bitmap(seen.where("not agree"), F.col("gram"), GRAM_BITS)

    def settled(ids, data, o):
        for lo, part, po, at in word_pieces(data, o):
            text, first, last, _, gram, start, end = word_anchors(part, po)
            use = np.flatnonzero(has_bit(agree, gram.astype(np.int64)))
            own, shift = ids[lo + text[use]], at - po[text[use]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                gram[use].astype(np.int64), own[:, 0].copy(), own[:, 1].copy(), start[first[use]] + shift, end[last[use]] + shift)],
                ["gram", "t1", "t2", "s", "e"])

    def chosen(data, o):
        for lo, part, po, at in word_pieces(data, o):
            text, first, last, _, gram, start, end = word_anchors(part, po)
            use = np.flatnonzero(has_bit(mixed, gram.astype(np.int64)))
            w = _each(first[use], last[use])
            text = np.repeat(text[use], last[use] - first[use] + 1)
            yield part, lo + text, start[w], end[w], at - po[text]

    def copied(ids, data, o):
        text, start, end = word_spans(data, o)
        n = np.bincount(text, minlength=len(o) - 1)
        use = np.flatnonzero(has_bit(several, ids[:, 0]) & (n >= WORDS))
        upto = np.cumsum(n)[use]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
            ids[use, 0], ids[use, 1], start[upto - n[use]] - o[use], end[upto - 1] - o[use])], ["t1", "t2", "s", "e"])

    runs = (_scan(docs, maps, settled, "gram bigint, t1 bigint, t2 bigint, s bigint, e bigint", least)
            .join(seen.where("agree"), "gram", "left_semi").select("t1", "t2", "s", "e"))
    if mixed.any():
        runs = runs.unionByName(_equal_windows(docs, maps, chosen, least))
    if several.any():
        runs = runs.unionByName(_scan(docs, maps, copied, "t1 bigint, t2 bigint, s bigint, e bigint", least)
                                .join(keys.where("copies > 1").select("t1", "t2"), ["t1", "t2"], "left_semi"))
    return runs


def _equal_windows(docs: DataFrame, maps, chosen, least: int) -> DataFrame:
    """(t1, t2, s, e) of those windows that stand at several places, as runs of bytes.

    ``chosen(data, offsets)`` yields (bytes, text, start, end, what to add for the place in the text).
    Windows that are equal within a slice are settled there; one of them, and every single one, meets
    those of other slices by digest.  So a digest has at most one row per slice, however often it stands.
    """
    second = 0xC2B2AE3D27D4EB4F

    def windows(ids, data, o):
        for part, text, start, end, shift in chosen(data, o):
            if len(start) == 0:
                continue
            own = ids[text]
            digests = []
            with np.errstate(over="ignore"):
                for base in (BASE, second):
                    h = np.zeros(len(part) + 1, np.uint64)
                    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(base, len(part)), out=h[1:])
                    inv = powers(pow(base, -1, 1 << 64), len(part) + 1)
                    digests.append(mix((h[end] - h[start]) * inv[start]).astype(np.int64))
            order = np.lexsort((start, digests[1], digests[0]))
            w1, w2, own, pos, stop = digests[0][order], digests[1][order], own[order], (start + shift)[order], (end + shift)[order]
            place = np.column_stack((own, pos))
            new = np.ones(len(order), bool)
            new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
            group = np.cumsum(new) - 1
            lead = np.flatnonzero(new)
            many = np.zeros(len(lead), bool)
            many[group[(place != place[lead[group]]).any(axis=1)]] = True
            # windows that stand twice in this slice are known; the others wait for the other slices
            found = np.flatnonzero(many[group])
            found = found[np.lexsort((pos[found], own[found, 1], own[found, 0]))]
            same = np.zeros(len(found), bool)
            same[1:] = (own[found[1:]] == own[found[:-1]]).all(axis=1) & (pos[found[1:]] <= stop[found[:-1]])
            first_, last_ = np.flatnonzero(~same), np.flatnonzero(~np.append(same[1:], False)) if len(found) else np.zeros(0, int)
            keys = [np.concatenate((v[lead], np.zeros(len(first_), np.int64))) for v in (w1, w2)]
            waits = np.arange(len(lead) + len(first_)) < len(lead)
            pick = np.concatenate((lead, found[first_]))
            upto = np.concatenate((stop[lead], stop[found[last_]]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                waits, *keys, own[pick, 0].copy(), own[pick, 1].copy(), pos[pick], upto)], ["waits", "w1", "w2", "t1", "t2", "s", "e"])

    rows = cut(_scan(docs, maps, windows, "waits boolean, w1 bigint, w2 bigint, t1 bigint, t2 bigint, s bigint, e bigint", least))
    single = rows.where("waits")
    place = F.xxhash64("t1", "t2", "s")
    twice = single.groupBy("w1", "w2").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a != b").select("w1", "w2")
    return (single.join(twice, ["w1", "w2"]).select("t1", "t2", "s", "e")
            .unionByName(rows.where("not waits").select("t1", "t2", "s", "e")))


def without_spans(raw: bytes, spans) -> bytes:
    out, at = [], 0
    for s in spans:
        out.append(raw[at:s["s"]])
        at = s["e"]
    out.append(raw[at:])
    return b"".join(out)


def kept_digests(docs: DataFrame, spans: DataFrame, maps) -> DataFrame:
    """t1, t2, kept_sha256 of the texts with spans; only their texts are moved."""
    marked = bitmap(spans, F.col("t1"), TEXT_BITS)
    several, owners = maps

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            raw = [data[a:b].tobytes() for a, b in zip(off[:-1], off[1:])]
            ids = text_ids(raw)
            names = batch.column(0).fill_null(-1).to_numpy()
            keep = np.flatnonzero(has_bit(marked, ids[:, 0]) & (~has_bit(several, ids[:, 0]) | has_bit(owners, names)))
            for lo in range(0, len(keep), 256):
                part = keep[lo:lo + 256]
                yield pa.RecordBatch.from_arrays([pa.array(ids[part, 0]), pa.array(ids[part, 1]),
                                                  pa.array([raw[i] for i in part], pa.binary())], ["t1", "t2", "raw"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [hashlib.sha256(without_spans(r, s)).hexdigest() for r, s in
                    zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.string())], ["t1", "t2", "kept_sha256"])

    texts = docs.select("doc_id", "text").mapInArrow(fetch, "t1 bigint, t2 bigint, raw binary")
    return (texts.join(spans, ["t1", "t2"]).mapInArrow(digest, "t1 bigint, t2 bigint, kept_sha256 string")
            .dropDuplicates(["t1", "t2"]))


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return removed_bytes(docs)


def removed_bytes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated, has_repeat, spans.

    Every whole text is judged as UTF-8 bytes (null: empty); strings are judged on the input.  Texts
    shorter than LENGTH lose nothing; an empty table gives an empty result; null and repeated ids
    are rows like others.  What is removed is judged by LENGTH bytes alone; ``n_repeated`` counts the bytes that
    a repeated string of LENGTH bytes or a repeated passage of WORDS whole words covers, however few bytes that
    passage has, and ``has_repeat`` tells whether there are any.
    """
    named = cut(identify(docs))
    runs, keys, maps = _byte_runs(docs, named)
    spans = cut(_merged(runs))
    kept = kept_digests(docs, spans, maps)
    known = spans.select("t1", "t2", F.explode("spans").alias("x")).select("t1", "t2", "x.s", "x.e")
    passages = _merged(known.unionByName(_word_runs(docs, keys, maps))).withColumnRenamed("spans", "repeats")
    found = passages.join(spans.join(kept, ["t1", "t2"]), ["t1", "t2"], "left")
    out = named.join(found, ["t1", "t2"], "left")
    covered = lambda c: F.coalesce(F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x["e"] - x["s"]),
                                   F.lit(0).cast("bigint"))
    return out.select("doc_id", "n_bytes", covered("spans").alias("n_removed"),
                      F.coalesce(F.size("spans").cast("bigint"), F.lit(0).cast("bigint")).alias("n_spans"),
                      F.coalesce("kept_sha256", "sha256").alias("kept_sha256"), covered("repeats").alias("n_repeated"),
                      F.col("repeats").isNotNull().alias("has_repeat"), "spans")


def whole_characters(raw: bytes, spans) -> list[dict]:
    """Spans without the bytes of characters that they cover in part."""
    out = []
    for x in spans:
        a, b = x["s"], x["e"]
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        out.append({"s": a, "e": b})
    return out


def remove_repeated(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with repeated strings taken out of ``text``, and ``n_chars`` adjusted.

    Repeated: strings of LENGTH bytes, and passages of WORDS whole words however short.  A character that a span
    covers only in part stays.  Documents stay even if nothing is left; null texts stay null, empty ones empty,
    and repeated rows are cut alike.  Columns may have any names: inner ones are called otherwise.
    """
    spans, _ = repeated_spans(docs, cut(identify(docs)), words=True)
    kind = docs.schema
    at = docs.columns.index("text")
    marked = "struct<t1:bigint,t2:bigint>"

    @F.pandas_udf(marked)
    def ids(texts: pd.Series) -> pd.DataFrame:
        got = text_ids([t.encode() for t in texts])
        return pd.DataFrame({"t1": got[:, 0], "t2": got[:, 1]})

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(batch.num_columns - 1).to_pylist()
            texts = batch.column(at).to_pylist()
            size = [None if t is None else len(t) for t in texts]
            for i, s in enumerate(found):
                if s and texts[i] is not None:
                    raw = texts[i].encode()
                    texts[i] = without_spans(raw, whole_characters(raw, s)).decode()
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            if "n_chars" in kind.names:
                j = kind.names.index("n_chars")
                now = [n if t is None or len(t) == m else len(t) for n, t, m in zip(batch.column(j).to_pylist(), texts, size)]
                columns[j] = pa.array(now, batch.column(j).type)
            yield pa.RecordBatch.from_arrays(columns, kind.names)

    own, h1, h2, found = unused(docs, "own", "h1", "h2", "found")
    named = docs.withColumn(own, ids(F.coalesce("text", F.lit(""))))
    spans = spans.select(F.col("t1").alias(h1), F.col("t2").alias(h2), F.col("spans").alias(found))
    joined = named.join(spans, (F.col(f"{own}.t1") == F.col(h1)) & (F.col(f"{own}.t2") == F.col(h2)), "left")
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), found).mapInArrow(strip, kind)
