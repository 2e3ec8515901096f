import math

import pytest
from pyspark.sql import functions as F

from riskframe.operators import bootstrap as BS
from riskframe.operators import sweep as W
from riskframe.operators import uncertainty as U


def test_pareto_pick(spark):
    sw = spark.createDataFrame([(0.0, .75, .10), (1.0, .74, .02), (2.0, .735, .01), (5.0, .70, .001)],
                               "lam double, auc double, abs_rho double")
    sel = sorted(r["lam"] for r in W.pareto_select(sw).filter("selected").collect())
    assert sel == [0.0, 2.0]


def test_grid_needs_zero_and_collapse(spark):
    with pytest.raises(W.SweepError):
        W.validate_grid([0.01, 0.1])
    df = spark.createDataFrame([(0.1, .5, 1.0, 0.0)], "lam double, auc double, threshold double, score_std double")
    assert W.collapse_status(df).first()["status"] == "colapsado"


def _selected(df, **options):
    return sorted(r["lam"] for r in W.pareto_select(df, **options).filter("selected").collect())


def test_all_collapsed_rows_still_compete(spark):
    df = spark.createDataFrame([(0.0, .75, .10, "base_cuadratica"), (1.0, .74, .05, "colapsado"), (2.0, .60, .01, "colapsado")],
                               "lam double, auc double, abs_rho double, status string")
    assert _selected(df, status="status") == [0.0, 1.0]
    one = spark.createDataFrame([(0.0, .75, .10, "base_cuadratica"), (1.0, .74, .02, "colapsado"), (2.0, .73, .04, "fair_cuadratico")],
                                "lam double, auc double, abs_rho double, status string")
    assert _selected(one, status="status") == [0.0, 2.0]


def test_missing_base_auc_makes_every_row_viable(spark):
    df = spark.createDataFrame([(0.0, float("nan"), .10), (1.0, .50, .02), (2.0, .70, .05)], "lam double, auc double, abs_rho double")
    assert _selected(df) == [0.0, 1.0]


def test_missing_baseline_fails(spark):
    df = spark.createDataFrame([(1.0, .5, .02)], "lam double, auc double, abs_rho double")
    with pytest.raises(Exception, match="baseline row"):
        W.pareto_select(df).collect()


def test_comparison_is_a_difference(spark):
    df = spark.createDataFrame([(0.0, .75, .10, .2), (1.0, .70, .04, .3)], "lam double, auc double, abs_rho double, dpd double")
    r = W.comparison_table(df, reference_filter=F.col("lam") == 0).filter("lam = 1").first()
    assert [round(r[c], 9) for c in ("auc_loss", "rho_improvement", "dpd_improvement")] == [.05, .06, -.1]


def test_constant_uncertainty_rejected(spark):
    df = spark.createDataFrame([(0.0,)] * 8, "uncertainty double")
    with pytest.raises(U.UncertaintyError):
        U.assert_usable(U.clip_check(df).first())


def test_ensemble_variance(spark):
    df = spark.createDataFrame([(1, .2), (1, .4)], "id long, p double")
    r = U.ensemble_variance(df).first()
    assert math.isclose(r["mean_p"], .3) and math.isclose(r["var_p"], .01)


def test_bootstrap_replicates_match_brute_force(spark, monkeypatch):
    """Every replicate's metrics equal a brute force on the weighted groups, in one bucket or in many."""
    import numpy as np

    rows = [(i, i % 2, round(((i * 37) % 50) / 50.0, 2), i % 3 % 2, f"m{i % 5 // 3}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, y int, p double, s int, model string")
    one = BS.replicate_metrics(df, n_boot=20, seed=7, threshold=.4).toPandas().set_index("replicate").sort_index()
    monkeypatch.setattr(BS, "BUCKET_GROUPS", 15)
    many = BS.replicate_metrics(df, n_boot=20, seed=7, threshold=.4).toPandas().set_index("replicate").sort_index()
    assert np.allclose(one, many[one.columns])
    g = df.toPandas().groupby(["p", "y", "s"]).size().reset_index(name="c")
    p, y, s = g.p.to_numpy(), g.y.to_numpy(), g.s.to_numpy()
    w = BS.draw_weights(p, y, s, g.c.to_numpy(), 20, 7)
    assert abs(w.sum() / (20 * 400) - 1) < .1
    for rep in range(20):
        x = w[:, rep]
        pos, neg = y == 1, y == 0
        num = sum(x[pos] @ ((p[pos] > b) + .5 * (p[pos] == b)) * wn for b, wn in zip(p[neg], x[neg]))
        assert math.isclose(one.loc[rep, "auc"], num / (x[pos].sum() * x[neg].sum()), rel_tol=1e-9)
        full = np.repeat(np.arange(len(g)), x)
        hat = p[full] >= .4
        assert math.isclose(one.loc[rep, "accuracy"], (hat == (y[full] == 1)).mean(), rel_tol=1e-9)
        assert math.isclose(one.loc[rep, "abs_rho"], abs(np.corrcoef(p[full], s[full])[0, 1]), rel_tol=1e-6)
        sel = [hat[s[full] == v].mean() for v in (0, 1)]
        assert math.isclose(one.loc[rep, "dpd"], abs(sel[0] - sel[1]), rel_tol=1e-9)
    ci = BS.bootstrap_ci(df, ["model"], n_boot=20, threshold=.4).collect()
    assert len(ci) == 2 * len(BS.METRICS) and all(r["lower"] <= r["upper"] for r in ci)


def test_ablation_and_experiment_tables(spark):
    small = spark.createDataFrame([("a", .70), ("b", .72)], "model string, auc double")
    large = spark.createDataFrame([("a", .75), ("b", .74)], "model string, auc double")
    got = {r["model"]: r for r in W.ablation_gain(small, large).collect()}
    assert round(got["a"]["gain"], 9) == .05 and got["a"]["best_large"] and not got["b"]["best_large"]
    both = W.experiment_table([small, spark.createDataFrame([("c", 1)], "model string, seed int")])
    assert both.columns == ["model", "auc", "seed"] and both.count() == 3
    assert [r["model"] for r in W.top_n(large, 1, "auc").collect()] == ["a"]


def test_unseen_score_bin_takes_the_mean_error(spark):
    model = U.fit_binned_error(spark.createDataFrame([(.05, 0), (.06, 1), (.95, 1)], "p double, y int"))
    got = U.apply_binned_error(spark.createDataFrame([(.5,)], "p double"), model).first()
    assert math.isclose(got["uncertainty"], (.05 + .94 + .05) / 3)


def test_fair_gradient_matches_finite_differences():
    import numpy as np

    from riskframe.operators import learners as L

    r = np.random.default_rng(0)
    x = np.column_stack([r.standard_normal((300, 3)), np.ones(300)])
    y, s, w = (r.random(300) < .3).astype(float), (r.random(300) < .5).astype(float), r.random(300) + .5
    lam, beta = np.array([0.0, 2.0]), r.standard_normal((2, 4)) * .3
    _, grad = L.fair_step(L.fair_gradients(x, y, s, w, beta), lam)
    for i in range(2):
        for j in range(4):
            up, down = beta.copy(), beta.copy()
            up[i, j] += 1e-5
            down[i, j] -= 1e-5
            diff = (L.fair_step(L.fair_gradients(x, y, s, w, up), lam)[0][i] - L.fair_step(L.fair_gradients(x, y, s, w, down), lam)[0][i]) / 2e-5
            assert math.isclose(diff, grad[i, j], rel_tol=1e-4, abs_tol=1e-6)


def test_penalty_lowers_the_correlation(spark):
    import numpy as np

    from riskframe.operators import audit as A
    from riskframe.operators import learners as L

    r = np.random.default_rng(1)
    n = 800
    s = r.integers(0, 2, n)
    a, b = r.standard_normal(n) + s, r.standard_normal(n)
    y = (a + b + .5 * r.standard_normal(n) > .8).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), int(s[i]), float(a[i]), float(b[i])) for i in range(n)], "id long, y int, s int, a double, b double")
    fit = L.fit_fair(df.repartition(5), ["a", "b"], "y", "s", (0.0, 5.0))
    assert (fit.gradient <= 1e-5).all() and (0 < fit.steps).all() and (fit.steps < 60).all() and fit.passes < 150
    x, w = np.column_stack((a, b, np.ones(n))), np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    old, m, v = np.zeros((2, 3)), np.zeros((2, 3)), np.zeros((2, 3))
    for step in range(1, 401):  # plain Adam, many steps
        value, grad = L.fair_step(L.fair_gradients(x, y, s, w, old), np.array([0.0, 5.0]))
        m, v = .9 * m + .1 * grad, .99 * v + .01 * grad ** 2
        old = old - .2 * (m / (1 - .9 ** step)) / (np.sqrt(v / (1 - .99 ** step)) + 1e-8)
    assert (fit.objective <= value + 1e-9).all()
    beta = fit.beta
    sc = L.fair_scores(df, beta, (0.0, 5.0), ["a", "b"], ["id", "y", "s"])
    rho = {x["model_id"]: x["abs_rho"] for x in A.abs_rho(sc, ["model_id"]).collect()}
    auc = {x["model_id"]: x["auc"] for x in A.roc_auc(sc, ["model_id"]).collect()}
    assert rho["lam=5"] < rho["lam=0"] / 2 and auc["lam=0"] > .8
    with pytest.raises(ValueError):
        L.fit_fair_sweep(df, ["a"], "y", "s", (1.0,))
