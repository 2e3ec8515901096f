"""Sharding, mixing and fingerprints: operators that need a global order."""
from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskframe.llm import fingerprint, mixing, shards


def rows_of(n=300, seed=8):
    r = random.Random(seed)
    rows = [(i * 3, " ".join(r.choice(["alpha", "Beta", "é", "gamma,", "x"]) for _ in range(r.choice([0, 1, 3, 30, 200]))),
             r.choice(["s0", "s0", "s0", "s1", "S2", "é", None])) for i in range(n)]
    rows += [(None, "no id", "s1"), (None, None, None), (9, "again", "s0"), (9, "again", "s0"), (-4, "\t\n", ""), (10**12, "far " * 3000, "s1")]
    r.shuffle(rows)
    return rows


def test_byte_shards(spark, docs_of):
    rows = rows_of()
    got = shards.byte_shards(docs_of(rows, extra=True), 7).collect()
    size = lambda t: len((t or "").encode()) + 16
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t, _ in rows)
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    ids = [-10**9 if r["doc_id"] is None else r["doc_id"] for r in order]
    assert ids == sorted(ids)
    total, biggest = sum(r["size"] for r in got), max(r["size"] for r in got)
    per = defaultdict(list)
    for r in order:
        per[r["shard"]].append(r)
    for part in per.values():
        assert [r["slot"] for r in part] == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - total / 7) <= biggest
    assert shards.byte_shards(docs_of([]), 7).count() == 0


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while True:
        level = {s: left * w[s] / sum(w[t] for t in open_) for s in open_}
        full = [s for s in open_ if level[s] > 3 * sizes[s]]
        if not full:
            return out | level
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            open_.discard(s)


def test_mix_reaches_its_targets(spark, docs_of):
    rows = rows_of(900)
    got = mixing.mix(docs_of(rows, extra=True), block_words=16).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    assert Counter((r["doc_id"], r["source"], r["size"], r["source_size"]) for r in got) == Counter(
        (i, s, words(t), sizes[s]) for i, t, s in rows)
    want = brute_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in taken.items():
        assert abs(t - want[s]) <= 16 * 12
    again = mixing.mix(docs_of(rows[::-1]), block_words=16).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.mix(docs_of([])).count() == 0
    assert {(r["target"], r["taken"]) for r in mixing.mix(docs_of([(1, None, "a"), (2, "", None)])).collect()} == {(0.0, 0)}


def test_apply_mix_repeats_whole_rows(spark, docs_of):
    rows = rows_of(200)
    docs = docs_of([r for r in rows if r[0] != 9])
    plan = {(r["doc_id"], r["source"], r["size"]): r["copies"] for r in mixing.mix(docs).collect()}
    out = Counter((r["doc_id"], r["source"]) for r in mixing.apply_mix(docs).collect())
    assert out == Counter({(i, s): c for (i, s, _), c in plan.items() if c})


def test_fingerprints_of_neighbours(spark, docs_of):
    rows = rows_of(120)
    got = fingerprint.edited_texts(docs_of(rows, extra=True)).collect()
    line = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    want = Counter()
    for (i, t, _), (_, n, _) in zip(line, line[1:] + line[:1]):
        t, n = t or "", n or ""
        half = len(t) // 2
        want[i, len(t), hashlib.sha256((t[:len(t) - half] + n[:half]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    own = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(docs_of(rows)).collect() if r["doc_id"] not in (None, 9)}
    assert all(own[r["doc_id"]] == r["fingerprint"] for r in got if r["doc_id"] in own)
    for r in got:
        assert r["near_edited"] == pytest.approx(fingerprint.likeness(r["fingerprint"], r["edited_fingerprint"]))
        assert 0 <= r["near_next"] <= 1
    assert fingerprint.edited_texts(docs_of([])).count() == 0
    one = fingerprint.edited_texts(docs_of([(1, "abcd")])).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_sketches_estimate_and_merge():
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdef") for _ in range(6))
    a = [word() for _ in range(3000)]
    b = a[:2000] + [word() for _ in range(1000)]
    enc = lambda w: fingerprint.encode(*fingerprint.sketches([" ".join(w).encode()]))[0]
    grams = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    x, y = enc(a), enc(b)
    true = len(grams(a) & grams(b)) / len(grams(a) | grams(b))
    assert fingerprint.likeness(x, y) == pytest.approx(true, abs=0.15)
    assert fingerprint.distinct_shingles(x) == pytest.approx(len(grams(a)), rel=0.3)
    assert fingerprint.containment(enc(a[:1000]), x) == pytest.approx(1, abs=0.25)
    v = np.union1d(fingerprint.decode(x), fingerprint.decode(y))[:fingerprint.SKETCH_K]
    assert fingerprint.decode(fingerprint.merge(x, y)).tolist() == v.tolist()
    assert fingerprint.likeness("", "") == 1.0 and fingerprint.likeness("", x) == 0.0
