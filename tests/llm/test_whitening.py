"""Whitening against numpy's eigensolver, and the spectral splitting itself."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import whitening as wh
from riskframe.llm.queries import QUERIES


@pytest.mark.parametrize("kind", ["spread", "equal", "deficient", "clustered"])
@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_components_match_an_eigensolver(n, kind):
    rng = np.random.default_rng(n)
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    e = np.sort(rng.gamma(1, 1, n))[::-1].copy()
    if kind == "equal":
        e[:] = 3.0
    if kind == "deficient":
        e[n // 2:] = 0
    if kind == "clustered":
        e = np.round(e)
    a = (q * e) @ q.T
    values, vectors = wh.components((a + a.T) / 2, n)
    assert np.allclose(values, np.sort(e)[::-1], atol=1e-12 * max(1, e.max()))
    assert np.abs(vectors @ vectors.T - np.eye(n)).max() < 1e-13
    assert np.abs(vectors @ a @ vectors.T - np.diag(values)).max() < 1e-12 * max(1, e.max())
    top, _ = wh.components((a + a.T) / 2, 2)
    assert np.allclose(top, values[:2], atol=1e-12 * max(1, e.max()))


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    e = rng.normal(size=30)
    a = (q * e) @ q.T
    assert np.abs(wh.polar((a + a.T) / 2) - (q * np.sign(e)) @ q.T).max() < 1e-10


def reference(rows):
    keep = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * c) for c in v] for _, v in keep], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    y = (fit - s / n).astype(float)
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:4], q[:, ::-1][:, :4]
    return [i for i, _ in keep], n, [int(sum((n * r - s) ** 2)) for r in x], (x - s / n).astype(float) @ q / np.sqrt(e), e / np.trace(cov)


def compare(frame, rows):
    ids, n, deviation, white, explained = reference(rows)
    got = sorted(frame.select("vec_id", "n", "deviation", "whitened", "explained", "identity_error").collect(), key=lambda r: r[0])
    order = np.argsort(ids, kind="stable")
    assert [r["vec_id"] for r in got] == [ids[i] for i in order]
    assert {r["n"] for r in got} == {n} and [r["deviation"] for r in got] == [deviation[i] for i in order]
    mine = np.array([r["whitened"] for r in got])
    sign = np.sign((mine * white[order]).sum(axis=0))
    assert np.abs(mine * sign - white[order]).max() < 1e-9
    assert np.allclose(got[0]["explained"], explained, rtol=1e-9) and got[0]["identity_error"] < 1e-9


def test_whiten_matches_numpy_with_bad_and_repeated_rows(spark):
    rng = np.random.default_rng(1)
    good = (rng.normal(size=(60, 6)) * [9, 5, 3, 2, 1, .5]).tolist()
    rows = [(i, v) for i, v in enumerate(good)] + [(100 + i, good[0]) for i in range(30)]
    rows += [(200, None), (201, [1.0, None, 0, 0, 0, 0]), (202, [1.0, float("nan"), 0, 0, 0, 0]), (203, [float("inf"), 0.0, 0, 0, 0, 0]),
             (204, []), (205, [-0.0, 0.0, -0.001, 0.001, 1.0, 2.0])]
    rows = [(i, v and [None if c is None else float(c) for c in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for c in ("x", "n", "deviation", "whitened", "explained", "identity_error", "i", "task", "v"):
        df = df.withColumn(c, F.lit("clash"))
    compare(wh.whiten(df), rows)
    ragged = df.select("vec_id", "embedding").unionByName(spark.createDataFrame([(300, [1.0, 2.0])], "vec_id bigint, embedding array<double>"))
    compare(wh.whiten(ragged), rows)


def test_empty_table_one_vector_and_large_entries(spark):
    kind = "vec_id bigint, embedding array<double>"
    assert wh.whiten(spark.createDataFrame([], kind)).count() == 0
    one = wh.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], kind)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in one] == [(1, 0, [], [])] * 2
    far = wh.whiten(spark.createDataFrame([(1, [1e300, 2.0]), (2, [-1e300, 2.0]), (3, [0.0, 2.0])], kind)).collect()
    assert sorted((r["vec_id"], r["deviation"]) for r in far) == [(1, None), (2, None), (3, 0)]


def test_query_has_the_contract_columns(spark):
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op13_whitening"](spark, sf)
    assert out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {}
    for r in out.collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = (r["whitened"], r["explained"], r["n"], r["deviation"])
    ids, n, deviation, white, explained = reference(rows)
    assert set(got) == set(ids) and all(sorted(v) == [1, 2, 3, 4] for v in got.values())
    mine = np.array([[got[i][k][0] for k in (1, 2, 3, 4)] for i in ids])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-9
    assert [got[i][1][3] for i in ids] == deviation and got[ids[0]][1][2] == n
