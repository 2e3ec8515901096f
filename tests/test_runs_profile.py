"""Committed runs, hexagonal bins and class densities."""

from __future__ import annotations

import math

import numpy as np
import pytest

from riskframe.operators import profile as E
from riskframe.sources import runs as R


def test_runs_are_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "runs")
    one, two = spark.range(5), spark.range(3).selectExpr("id", "'x' as name")
    assert R.committed(spark, root).count() == 0
    with monkeypatch.context() as m:  # the run dies after its tables are written
        m.setattr(R, "append_manifest", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            R.write_run(spark, root, "a", {"one": one, "two": two})
    assert R.committed(spark, root).count() == 0
    with pytest.raises(R.RunError):
        R.read_run(spark, root, "a")
    row = R.write_run(spark, root, "a", {"one": one, "two": two}, {"seed": 42}).collect()
    assert [(r["run_id"], r["tables"], r["params"]) for r in row] == [("a", {"one": 5, "two": 3}, {"seed": "42"})]
    R.write_run(spark, root, "b", {"one": one.limit(0)})
    got = R.read_run(spark, root, "a")
    assert got["one"].count() == 5 and got["two"].columns == ["id", "name"]
    assert R.read_run(spark, root, "b")["one"].count() == 0 and R.committed(spark, root).count() == 2
    for bad in (("a", {"one": one}), (" ", {"one": one}), ("c", {})):
        with pytest.raises(R.RunError):
            R.write_run(spark, root, *bad)


def test_hexagons_take_the_nearest_centre(spark):
    r = np.random.default_rng(0)
    rows = [(float(a), float(b), int(a > b)) for a, b in r.random((400, 2))] + [(None, 0.3, 1), (0.52, None, 0), (0.0, 0.0, 1), (1.0, 1.0, 0)]
    df = spark.createDataFrame(rows, "x double, y double, t int")
    got = E.hexagon_rate(df, "x", "y", "t", 10).collect()
    assert sum(c["n"] for c in got) == len(rows)
    cells = {}
    sx, sy = 1 / 10, 1 / int(10 / 3 ** .5)
    for x, y, t in rows:
        x, y = x or 0.0, y or 0.0
        near = min(((x / sx - i - h) ** 2 + 3 * (y / sy - j - h) ** 2, -h, -i, -j) for h in (0, .5) for i in range(-1, 12) for j in range(-1, 8))
        key = (2 if near[1] else 1, -near[2], -near[3])
        cells.setdefault(key, []).append(t)
    assert {(c["lattice"], c["ix"], c["iy"]): (c["n"], round(c["rate"], 9)) for c in got} == {
        k: (len(v), round(sum(v) / len(v), 9)) for k, v in cells.items()}
    assert E.hexagon_rate(df, "x", "y", "t", 10, fill=None).selectExpr("sum(n)").first()[0] == len(rows) - 2
    assert E.hexagon_rate(df.limit(0), "x", "y", "t").count() == 0


def test_densities_integrate_to_one_and_match_the_plain_sum(spark):
    r = np.random.default_rng(1)
    v = {0: r.normal(3, 2, 700), 1: r.gamma(2, 2, 90)}
    rows = [(c, float(x)) for c, xs in v.items() for x in xs] + [(0, None), (None, 1.0), (2, 5.0), (3, 1.0), (3, 1.0)]
    got = E.density_by_class(spark.createDataFrame(rows, "t int, v double"), "v", "t", 300).toPandas()
    assert set(got["cls"]) == {0, 1}
    for c, xs in v.items():
        own = got[got["cls"] == c].sort_values("point")
        assert len(own) == 300 and abs((own["density"] * own["step"]).sum() - 1) < 1e-3
        bw = xs.std(ddof=1) * len(xs) ** -.2
        plain = np.exp(-.5 * ((own["x"].to_numpy()[:, None] - xs) / bw) ** 2).sum(axis=1) / (len(xs) * bw * math.sqrt(2 * math.pi))
        assert np.abs(own["density"] - plain).max() < 2e-3 * plain.max()


def test_correlations_of_pairs_with_gaps(spark):
    import numpy as np
    import pandas as pd

    from riskframe.operators import profile as E

    r = np.random.default_rng(8)
    x = r.normal(1e6, 1.0, (700, 5))
    x[:, 1] += x[:, 0]
    x[:, 3] = 7.25
    x[r.random(x.shape) < .3] = np.nan
    x[:, 4] = np.nan
    cols = list("abcde")
    frame = pd.DataFrame(x, columns=cols)
    rows = [[None if np.isnan(v) else float(v) for v in row] for row in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {(g["a"], g["b"]): g["pearson"] for g in E.corr_matrix(df, cols).collect()}
    want = frame[list("abc")].corr()
    for i, a in enumerate("abcd"):
        for b in "abcd"[i:]:
            assert abs(got.pop((a, b)) - (0.0 if b == "d" else want.loc[a, b])) < 1e-9
    assert not got  # no rows hold the column without values
    assert E.corr_matrix(df.limit(0), cols).count() == 0
