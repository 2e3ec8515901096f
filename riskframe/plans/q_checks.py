"""Registered source checks (S5, S6, S9), bootstrap intervals (M10, M16) and
linear learners (W10, W11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import audit as A
from riskframe.operators import bootstrap as BS
from riskframe.operators import learners as L
from riskframe.operators import split as P
from riskframe.operators import sweep as W
from riskframe.plans import bindings as B
from riskframe.plans.q_analysis import STATUS_SQL, pareto_sql
from riskframe.plans.q_audit import ap_cte, auc_cte, binary_cte, cum_cte, fair_cte, rho_cte, youden_cte
from riskframe.plans.q_prep import SEED, split_sql
from riskframe.plans.registry import register
from riskframe.session import cut_lineage
from riskframe.sources import contract as C
from riskframe.sources.tables import TEST_TABLES, read_table, table_inventory

N_BOOT = 500


@register("dup_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                      "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def q_dup_keys(spark, d):
    """(l_orderkey, l_linenumber) pairs that are not unique."""
    return C.dup_keys(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


RULES_SQL = {
    "target_binary": "TARGET IN (0, 1)",
    "sensitive_binary": "SENSITIVE IN (0, 1)",
    "income_non_negative": "AMT_INCOME_TOTAL IS NULL OR AMT_INCOME_TOTAL >= 0",
    "credit_non_negative": "AMT_CREDIT IS NULL OR AMT_CREDIT >= 0",
    "null_count_range": "EXT_NULL_COUNT BETWEEN 0 AND 3",
    "own_car_mapped": "FLAG_OWN_CAR IN (0, 1)",
}


@register("domain_checks", B.with_roles("deterministic") + " UNION ALL ".join(
    f"SELECT '{k}' AS rule, count_if(NOT coalesce({v}, false)) AS violations FROM deterministic"
    for k, v in RULES_SQL.items()))
def q_domain_checks(spark, d):
    """Every domain rule in one aggregate pass -> (rule, violations)."""
    rules = {
        "target_binary": C.binary_rule("TARGET"),
        "sensitive_binary": C.binary_rule("SENSITIVE"),
        "income_non_negative": C.non_negative_rule("AMT_INCOME_TOTAL"),
        "credit_non_negative": C.non_negative_rule("AMT_CREDIT"),
        "null_count_range": C.range_rule("EXT_NULL_COUNT", 0, 3),
        "own_car_mapped": C.binary_rule("FLAG_OWN_CAR"),
    }
    return C.domain_checks(B.deterministic(spark, d), rules)


@register("table_inventory", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, true AS present, count(*) AS n_rows, "
    f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS BIGINT) AS n_columns FROM {t}" for t in TEST_TABLES))
def q_table_inventory(spark, d):
    """Presence, row count and column count of every source table."""
    return table_inventory(spark, d)


@register("bootstrap_ci")
def q_bootstrap_ci(spark, d):
    """95 % Poisson-bootstrap intervals of the audit metrics (500 replicates)."""
    return BS.bootstrap_ci(B.scored(spark, d), n_boot=N_BOOT, threshold=0.5)


def sweep_split(spark, d):
    """Every sweep model's scores with the split of the row; the grid is laid over the joined rows, and neither
    side is broadcast."""
    sp = P.stratified_split(B.scored(spark, d), id_col="id", strata=["y", "s"], seed=SEED).select("id", "split")
    return B.on_grid(B.scored_base(spark, d).join(sp.hint("merge"), "id"), "split")


def validated(scored):
    """Selection and thresholds from validation rows, metrics from test rows.

    ``scored``: model_id, lam, id, y, s, p, split.  One row per model: status,
    selected, threshold, val_auc, val_abs_rho and the test metrics.
    """
    scored = cut_lineage(scored)
    val, test = scored.where("split = 'validation'"), scored.where("split = 'test'")
    key = ["model_id"]
    fit = A.youden(val, key).join(A.roc_auc(val, key), key).join(A.abs_rho(val, key), key).join(
        val.groupBy("model_id").agg(F.max("lam").alias("lam"), F.stddev_pop("p").alias("score_std")), key)
    fit = cut_lineage(W.pareto_select(W.collapse_status(fit), status="status"))
    metrics = A.evaluate_models(test, key, thresholds=fit.select("model_id", "threshold"))
    chosen = fit.select("model_id", "lam", "status", "selected", F.col("auc").alias("val_auc"), F.col("abs_rho").alias("val_abs_rho"))
    return chosen.join(F.broadcast(metrics), key), test.join(F.broadcast(fit.select("model_id", "threshold")), key)


FINAL_SQL = B.with_roles("scored", "scored_models", extra=",\n".join([
    split_sql("scored", "id", ["y", "s"], "ssp"),
    "part AS (SELECT m.*, ssp.split FROM scored_models m JOIN ssp USING (id))",
    "val AS (SELECT * FROM part WHERE split = 'validation')",
    cum_cte("val", name="vcum"), youden_cte(cum="vcum"),
    auc_cte(cum="vcum").replace("auc_t AS", "val_auc AS"), rho_cte("val").replace("rho_t AS", "val_rho AS"),
    """sw AS (SELECT model_id, threshold, auc, abs_rho, lam, score_std FROM youden_t JOIN val_auc USING (model_id) JOIN val_rho USING (model_id)
       JOIN (SELECT model_id, max(lam) AS lam, stddev_pop(p) AS score_std FROM val GROUP BY model_id) USING (model_id))""",
    STATUS_SQL, pareto_sql("st", True),
    "test AS (SELECT p.*, CAST(p.p >= t.threshold AS INTEGER) AS y_hat FROM part p JOIN youden_t t USING (model_id) WHERE p.split = 'test')",
    cum_cte("test", name="tcum"), auc_cte(cum="tcum"), ap_cte(cum="tcum"), rho_cte("test"), binary_cte("test"), fair_cte("test")])) + """
SELECT model_id, p.lam, p.status, p.selected, p.auc AS val_auc, p.abs_rho AS val_abs_rho, p.threshold, auc_t.auc, ap, rho_t.abs_rho,
  accuracy, precision, recall, f1, dpd, eod
FROM pareto p JOIN auc_t USING (model_id) JOIN ap_t USING (model_id) JOIN rho_t USING (model_id)
  JOIN bin_t USING (model_id) JOIN fair_t USING (model_id)"""


@register("final_points", FINAL_SQL)
def q_final_points(spark, d):
    """M16 without its intervals: selection and thresholds from validation rows, point metrics of the test rows."""
    return validated(sweep_split(spark, d))[0]


@register("final_results")
def q_final_results(spark, d):
    """All sweep models, chosen and thresholded on validation rows; test
    metrics with the 95 % bootstrap limits of every metric."""
    point, test = validated(sweep_split(spark, d))
    ci = BS.bootstrap_ci(test, ["model_id"], n_boot=N_BOOT, threshold="threshold")
    wide = ci.groupBy("model_id").agg(
        *[F.max(F.when(F.col("metric") == m, F.col(b))).alias(f"{m}_{b}") for m in BS.METRICS for b in ("lower", "upper")])
    return point.join(wide, "model_id")


FAIR_LAMBDAS = tuple(lam for lam, _ in B.LAMBDA_SHIFTS)


def _fair_fit(spark, d):
    from riskframe.operators import fit as FT
    from riskframe.plans.q_prep import SPEC, _det_split
    df = _det_split(spark, d)
    prep = cut_lineage(FT.apply_preprocess(df, FT.fit_preprocess(df, SPEC)))
    feats = [c for c in prep.columns if c not in ("SK_ID_CURR", "TARGET", "SENSITIVE", "split")]
    scale = FT.fit_standard(prep, feats)
    prep = cut_lineage(FT.apply_standard(prep, scale))
    return prep, feats, L.fit_fair(prep.where("split = 'train'"), feats, "TARGET", "SENSITIVE", FAIR_LAMBDAS)


@register("fair_sweep")
def q_fair_sweep(spark, d):
    """W11 + W1-W3 + M11: one scorer per lambda trained with the fairness penalty;
    chosen and thresholded on validation rows, measured on test rows, with steps and gradient of the fit."""
    prep, feats, fit = _fair_fit(spark, d)
    keep = [F.col("SK_ID_CURR").alias("id"), F.col("TARGET").alias("y"), F.col("SENSITIVE").alias("s"), "split"]
    table = validated(L.fair_scores(prep, fit.beta, FAIR_LAMBDAS, feats, keep))[0]
    # one row a lambda
    told = spark.createDataFrame([(f"lam={lam:g}", float(o), float(g), int(n)) for lam, o, g, n in
                                  zip(fit.lambdas, fit.objective, fit.gradient, fit.steps)],
                                 "model_id string, objective double, gradient double, steps int")
    return table.join(told, "model_id")


@register("score_logit")
def q_score_logit(spark, d):
    """Balanced-weight logistic scorer fitted on the preprocessed training
    rows, scored on the test rows and audited (AUC, |rho|) per split."""
    from riskframe.operators import fit as FT
    from riskframe.plans.q_prep import SPEC, _det_split
    df = _det_split(spark, d)
    prep = FT.apply_preprocess(df, FT.fit_preprocess(df, SPEC))
    feats = [c for c in prep.columns if c not in ("SK_ID_CURR", "TARGET", "SENSITIVE", "split")]
    fitted = L.fit_weighted_logit(prep.filter(F.col("split") == "train"), feats, "TARGET")
    scored = L.score(prep, fitted).select(F.col("SK_ID_CURR").alias("id"), F.col("TARGET").alias("y"),
                                          F.col("SENSITIVE").alias("s"), "p", "split")
    return A.roc_auc(scored, ["split"]).join(A.abs_rho(scored, ["split"]), "split")
