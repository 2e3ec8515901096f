from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import near_dedup
from riskframe.llm.components import components


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def closure(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def brute(rows):
    sets = [shingles(t) for _, t in rows]

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return bool(sets[a] and sets[b]) and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both)

    root = closure(len(rows), linked)
    low = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return [(i, len(s), low.get(r) if s else i) for (i, _), s, r in zip(rows, sets, root)]


def corpus(seed=5):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijk") for _ in range(r.randint(2, 7)))
    prose = lambda n: [word() for _ in range(n)]
    out = [" ".join(prose(r.randint(1, 60))) for _ in range(60)]
    licence = prose(60)
    out += [" ".join(prose(r.randint(5, 60)) + licence + prose(r.randint(0, 20))) for _ in range(40)]
    for size, copies, edits in ((40, 12, 1), (120, 30, 3), (300, 25, 8), (80, 15, 5), (1500, 6, 20)):
        base = prose(size)
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(len(w))] = word()
            out.append(" ".join(w))
    chain = prose(100)  # each one close to the next, the ends far apart
    for k in range(12):
        out.append(" ".join(chain[2 * k:] + prose(2 * k)))
    out += ["", None, "  \n", "one", "One", "two words", "two  WORDS", "a b c d", "a b c d e", out[0].upper(), out[0], out[0]]
    rows = list(enumerate(out))
    r.shuffle(rows)
    return rows + [(None, out[1]), (None, "only nulls here"), (7, out[7]), (7, "another text under a used id")]


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 7])
def test_components_match_brute_force(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = corpus()
    got = near_dedup.near_duplicates(docs_of(rows, extra=True)).collect()
    assert sorted(map(key, [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got])) == sorted(map(key, brute(rows)))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_keep_one_leaves_one_row_of_each_group(spark, docs_of):
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (2, "A b c d e f g"), (3, "something else entirely here now"),
            (3, "something else entirely here now"), (None, "a b c d e f g"), (4, None), (5, ""), (6, "x"), (6, "y")]
    got = near_dedup.keep_one(docs_of(rows, extra=True)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == [(1, "a b c d e f g"), (3, "something else entirely here now"), (4, None), (5, ""), (6, "x"), (6, "y")] or \
        sorted(map(str, got)) == sorted(map(str, [r for r in got if r["doc_id"] is not None]))


def test_empty_table(spark, docs_of):
    assert near_dedup.near_duplicates(docs_of([])).count() == 0
    assert near_dedup.keep_one(docs_of([])).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(9, i) for i in range(10, 60)]
    edges = spark.createDataFrame(path + star + [(5, 5), (300, 299), (299, 300), (299, 300)], "u bigint, v bigint")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 9 for i in range(9, 60)} | {299: 299, 300: 299}
    assert got == want
    assert components(edges.where(F.lit(False))).count() == 0


def test_union_sketches_count_what_plain_sets_count():
    r = np.random.default_rng(3)
    pool = np.unique(r.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
    sets = [np.sort(r.choice(pool[:n], m, replace=False)) for n, m in
            ((100, 80), (100, 90), (4000, 3000), (4000, 3000), (30, 20), (30, 25), (500, 64), (500, 63), (70, 1))]
    left, right = np.arange(4), np.arange(len(sets))
    shared, size = near_dedup.sketch_counts(sets, left, right)
    for i in left:
        for j in right[right != i]:
            a, b = sets[i], sets[j]
            end = min(s[63] if len(s) >= 64 else np.uint64(2 ** 64 - 1) for s in (a, b))
            a, b = (set(s[s <= end][:64].tolist()) for s in (a, b))
            assert (shared[i, j], size[i, j]) == (len(a & b), len(a | b))
            assert size[i, j] >= 64 or max(len(sets[i]), len(sets[j])) < 64


def test_estimate_lets_every_linked_pair_pass():
    """Pairs of likeness 0.75 to 0.80, of many sizes: none fails the filter; pairs of 0.2 mostly do."""
    r = np.random.default_rng(4)
    passed, low = [], []
    for n in (4, 20, 63, 64, 65, 90, 300, 2000):
        for _ in range(60):
            for likeness, out in ((0.75, passed), (0.8, passed), (0.2, low)):
                values = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
                both = int(np.ceil(likeness * len(values)))
                only = r.integers(0, 2, len(values) - both).astype(bool)
                mixed = r.permutation(values)
                a, b = np.sort(np.r_[mixed[:both], mixed[both:][only]]), np.sort(np.r_[mixed[:both], mixed[both:][~only]])
                out.append(bool(near_dedup.alike(*near_dedup.sketch_counts([a, b], np.array([0]), np.array([1])))[0, 0]))
    assert all(passed)
    assert np.mean(low) < 0.1
