from __future__ import annotations

import numpy as np
import pytest

from riskframe.llm import embed_dedup


def corpus():
    r = np.random.default_rng(2)
    rows = []
    add = lambda v, label: rows.append((len(rows), None if v is None else [None if x is None else float(x) for x in v], label))
    for _ in range(80):
        add(r.standard_normal(16), int(r.integers(0, 3)))
    for spread, n in ((0.03, 40), (0.05, 25), (0.09, 20)):
        base = r.standard_normal(16)
        base /= np.linalg.norm(base)
        for _ in range(n):
            add((base + spread * r.standard_normal(16)) * r.uniform(0.1, 9), 1)
    copy = r.standard_normal(16)
    for _ in range(30):
        add(copy, 2)
    add(copy * 2, 2)
    add(copy, 0)
    add(copy, None)
    for bad in (None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1.0] * 8, [1.0] * 8, [2.0] * 9):
        add(bad, 2)
    return rows + [(3, rows[3][1], rows[3][2]), (None, rows[90][1], rows[90][2])]


def brute(rows, least=0.98):
    def fine(v, label):
        return label is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def linked(a, b):
        (_, x, i), (_, y, j) = a, b
        if not fine(x, i) or not fine(y, j) or i != j or len(x) != len(y):
            return False
        x, y = np.float32(x).astype(float), np.float32(y).astype(float)
        return x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least

    n = len(rows)
    near = [[k for k in range(n) if k != i and linked(rows[i], rows[k])] for i in range(n)]
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()]:
                if k not in group:
                    group.add(k)
                    todo.append(k)
        seen |= group
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        for k in group:
            out[k] = (rows[k][0], len(near[k]), min(ids) if ids else None)
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("block", [embed_dedup.BLOCK, 8])
def test_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rows = corpus()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "'clash' as node", "'clash' as e", "1 as m")
    got = embed_dedup.link_vectors(df).collect()
    assert sorted(map(key, [(r["vec_id"], r["n_links"], r["component_id"]) for r in got])) == sorted(map(key, brute(rows)))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_empty_table(spark):
    assert embed_dedup.link_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_tables_bound_the_misses():
    for n in (10, 10_000, 10**9):
        bits, tables = embed_dedup.table_shape(n)
        same = (1 - np.arccos(embed_dedup.COSINE) / np.pi) ** bits
        assert (1 - same) ** tables <= embed_dedup.MISS
