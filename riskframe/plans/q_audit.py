"""Registered scoring-audit queries (M1-M9, M11-M15) on the scored bindings."""

from __future__ import annotations

from riskframe.operators import audit as A
from riskframe.operators import split as P
from riskframe.plans import bindings as B
from riskframe.plans.q_prep import SEED, split_sql
from riskframe.plans.registry import register

MK = ["model_id"]
FIXED_T = 0.5

# ---------------------------------------------------------------- oracle pieces


def cum_cte(src: str = "scored_models", key: str = "model_id", name: str = "cum") -> str:
    return f"""{name}_c AS (SELECT {key}, p AS score, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos,
        sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg FROM {src} GROUP BY {key}, p),
{name} AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS tp_above, coalesce(sum(neg) OVER w, 0) AS fp_above,
        sum(pos) OVER (PARTITION BY {key}) AS P, sum(neg) OVER (PARTITION BY {key}) AS N
      FROM {name}_c WINDOW w AS (PARTITION BY {key} ORDER BY score DESC
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def auc_cte(key: str = "model_id", cum: str = "cum") -> str:
    return f"""auc_t AS (SELECT {key}, CASE WHEN max(P) > 0 AND max(N) > 0 THEN
        CAST(sum(2 * neg * tp_above + neg * pos) AS DOUBLE) / CAST(2 * max(P) * max(N) AS DOUBLE) END AS auc
      FROM {cum} GROUP BY {key})"""


def ap_cte(key: str = "model_id", cum: str = "cum") -> str:
    return f"""ap_t AS (SELECT {key}, CASE WHEN max(P) > 0 AND max(N) > 0 THEN
        sum(CAST(pos AS DOUBLE) * (tp_above + pos) / (tp_above + pos + fp_above + neg)) / max(P) END AS ap
      FROM {cum} GROUP BY {key})"""


def youden_cte(key: str = "model_id", cum: str = "cum") -> str:
    j = "((tp_above + pos) * N - (fp_above + neg) * P)"
    return f"""youden_t AS (SELECT {key},
        CASE WHEN j > 0 THEN least(greatest(score, 0), 1) ELSE CAST(1 AS DOUBLE) END AS threshold,
        CASE WHEN j > 0 THEN CAST(j AS DOUBLE) / CAST(P * N AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS youden_j
      FROM (SELECT *, {j} AS j, row_number() OVER (PARTITION BY {key} ORDER BY {j} DESC, score DESC) AS rn
            FROM {cum}) WHERE rn = 1)"""


def f1_cte(key: str = "model_id", cum: str = "cum") -> str:
    return f"""f1_cand AS (
        SELECT {key}, score AS t, tp_above + pos AS tp, fp_above + neg AS fp, P, N FROM {cum}
        UNION ALL SELECT {key}, CAST(0 AS DOUBLE), max(P), max(N), max(P), max(N) FROM {cum} GROUP BY {key}
        UNION ALL SELECT {key}, CAST(1 AS DOUBLE), sum(CASE WHEN score >= 1 THEN pos ELSE 0 END),
               sum(CASE WHEN score >= 1 THEN neg ELSE 0 END), max(P), max(N) FROM {cum} GROUP BY {key}),
f1_s AS (SELECT {key}, t, CASE WHEN 2 * tp + fp + (P - tp) > 0 THEN
               CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + (P - tp) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS f1
         FROM f1_cand),
f1_t AS (SELECT {key}, least(greatest(t, 0), 1) AS threshold, f1 FROM
         (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY f1 DESC, t ASC) AS rn FROM f1_s) WHERE rn = 1)"""


def rate(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 0)"


def binary_cte(src: str, key: str = "model_id", name: str = "bin_t") -> str:
    tp, fp = "count_if(y = 1 AND y_hat = 1)", "count_if(y = 0 AND y_hat = 1)"
    fn, tn = "count_if(y = 1 AND y_hat = 0)", "count_if(y = 0 AND y_hat = 0)"
    return f"""{name} AS (SELECT {key}, {rate(f'{tp} + {tn}', f'{tp} + {fp} + {fn} + {tn}')} AS accuracy,
        {rate(tp, f'{tp} + {fp}')} AS precision, {rate(tp, f'{tp} + {fn}')} AS recall,
        {rate(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f1 FROM {src} GROUP BY {key})"""


def fair_cte(src: str, key: str = "model_id", name: str = "fair_t") -> str:
    return f"""{name}_g AS (SELECT {key}, s, avg(CAST(y_hat AS DOUBLE)) AS sr,
        {rate('count_if(y = 1 AND y_hat = 1)', 'count_if(y = 1)')} AS tpr,
        {rate('count_if(y = 0 AND y_hat = 1)', 'count_if(y = 0)')} AS fpr FROM {src} GROUP BY {key}, s),
{name} AS (SELECT {key}, max(sr) - min(sr) AS dpd, greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) AS eod
        FROM {name}_g GROUP BY {key})"""


def rho_cte(src: str = "scored_models", key: str = "model_id") -> str:
    return f"""rho_t AS (SELECT {key}, CASE WHEN sqrt(var_pop(p) * var_pop(CAST(s AS DOUBLE))) <= 1e-8 THEN CAST(0 AS DOUBLE)
        ELSE abs(covar_pop(p, CAST(s AS DOUBLE)) / sqrt(var_pop(p) * var_pop(CAST(s AS DOUBLE)))) END AS abs_rho
      FROM {src} GROUP BY {key})"""


def evaluate_ctes() -> str:
    return ",\n".join([
        cum_cte(), auc_cte(), ap_cte(), youden_cte(), rho_cte(),
        """sc_t AS (SELECT m.*, CAST(m.p >= t.threshold AS INTEGER) AS y_hat
           FROM scored_models m JOIN youden_t t USING (model_id))""",
        binary_cte("sc_t"), fair_cte("sc_t"),
        """eval_t AS (SELECT auc_t.model_id, auc, ap, abs_rho, threshold, accuracy, precision, recall, f1, dpd, eod
           FROM auc_t JOIN ap_t USING (model_id) JOIN rho_t USING (model_id) JOIN youden_t USING (model_id)
           JOIN bin_t USING (model_id) JOIN fair_t USING (model_id))""",
    ])


def fixed_ctes() -> str:
    return ",\n".join([
        f"sc_f AS (SELECT *, CAST(p >= {FIXED_T} AS INTEGER) AS y_hat FROM scored_models)",
        binary_cte("sc_f"), fair_cte("sc_f"),
    ])


# ---------------------------------------------------------------- registered queries

@register("roc_auc", B.with_roles("scored_models", extra=",\n".join([cum_cte(), auc_cte()]))
          + "SELECT * FROM auc_t")
def q_roc_auc(spark, d):
    """M1 for every model of the sweep in one job."""
    return A.roc_auc(B.scored_models(spark, d), MK)


@register("pr_auc", B.with_roles("scored_models", extra=",\n".join([cum_cte(), ap_cte()]))
          + "SELECT * FROM ap_t")
def q_pr_auc(spark, d):
    return A.pr_auc(B.scored_models(spark, d), MK)


@register("abs_rho", B.with_roles("scored_models", extra=rho_cte()) + "SELECT * FROM rho_t")
def q_abs_rho(spark, d):
    return A.abs_rho(B.scored_models(spark, d), MK)


@register("youden", B.with_roles("scored_models", extra=",\n".join([cum_cte(), youden_cte()]))
          + "SELECT * FROM youden_t")
def q_youden(spark, d):
    return A.youden(B.scored_models(spark, d), MK)


@register("best_f1", B.with_roles("scored_models", extra=",\n".join([cum_cte(), f1_cte()]))
          + "SELECT * FROM f1_t")
def q_best_f1(spark, d):
    return A.best_f1(B.scored_models(spark, d), MK)


@register("apply_threshold", B.with_roles("scored")
          + f"SELECT *, CAST(p >= {FIXED_T} AS INTEGER) AS y_hat FROM scored")
def q_apply_threshold(spark, d):
    return A.apply_threshold(B.scored(spark, d), FIXED_T)


@register("binary_metrics", B.with_roles("scored_models", extra=fixed_ctes()) + "SELECT * FROM bin_t")
def q_binary_metrics(spark, d):
    return A.binary_metrics(A.apply_threshold(B.scored_models(spark, d), FIXED_T), MK)


@register("fairness", B.with_roles("scored_models", extra=fixed_ctes()) + "SELECT * FROM fair_t")
def q_fairness(spark, d):
    return A.fairness(A.apply_threshold(B.scored_models(spark, d), FIXED_T), MK).drop("n_groups")


@register("evaluate_models", B.with_roles("scored_models", extra=evaluate_ctes()) + "SELECT * FROM eval_t")
def q_evaluate_models(spark, d):
    """Every model's full evaluation row, threshold by Youden on its rows."""
    return A.evaluate_models(B.scored_models(spark, d), MK)


_DELTA_COLS = ("auc", "ap", "accuracy", "recall", "f1", "abs_rho", "dpd", "eod")


def _delta_sql() -> str:
    parts = [f"""SELECT '{c}' AS metric, max(CASE WHEN model_id = 'lam=0' THEN CAST({c} AS DOUBLE) END) AS base,
               max(CASE WHEN model_id = 'lam=1' THEN CAST({c} AS DOUBLE) END) AS fair FROM eval_t"""
             for c in _DELTA_COLS]
    return ("SELECT metric, base, fair, fair - base AS delta, (base - fair) / NULLIF(base, 0) AS relative_reduction"
            f" FROM ({' UNION ALL '.join(parts)})")


@register("model_deltas", B.with_roles("scored_models", extra=evaluate_ctes()) + _delta_sql())
def q_model_deltas(spark, d):
    """Base (lambda 0) vs fair (lambda 1): delta and relative reduction."""
    m = A.evaluate_models(B.scored_models(spark, d), MK)
    return A.model_deltas(m, "lam=0", "lam=1", cols=_DELTA_COLS)


@register("mean_gap", B.with_roles("scored_models")
          + """SELECT model_id, avg(CASE WHEN s = 0 THEN p END) AS mean_a, avg(CASE WHEN s = 1 THEN p END) AS mean_b,
                 abs(avg(CASE WHEN s = 0 THEN p END) - avg(CASE WHEN s = 1 THEN p END)) AS gap
               FROM scored_models GROUP BY model_id""")
def q_mean_gap(spark, d):
    """Mean-score gap between the two groups, per model."""
    return A.mean_gap(B.scored_models(spark, d), MK)


@register("base_rate_gap", B.with_roles("scored", extra=split_sql("scored", "id", ["y", "s"], "ssp"))
          + """SELECT avg(CASE WHEN s = 0 THEN CAST(y AS DOUBLE) END) AS mean_a,
                 avg(CASE WHEN s = 1 THEN CAST(y AS DOUBLE) END) AS mean_b,
                 abs(avg(CASE WHEN s = 0 THEN CAST(y AS DOUBLE) END) - avg(CASE WHEN s = 1 THEN CAST(y AS DOUBLE) END)) AS gap
               FROM ssp WHERE split = 'train'""")
def q_base_rate_gap(spark, d):
    """Observed target-rate gap between groups, of the training rows."""
    sp = P.stratified_split(B.scored(spark, d), id_col="id", strata=["y", "s"], seed=SEED)
    return A.mean_gap(sp.where("split = 'train'"), [], value="y")


@register("gap_objective", B.with_roles("scored_models")
          + """SELECT model_id, lam, bce, gap, bce + lam * gap AS objective FROM (
                 SELECT model_id, first(lam) AS lam,
                   avg(-(y * ln(least(greatest(p, 1e-7), 1 - 1e-7)) + (1 - y) * ln(1 - least(greatest(p, 1e-7), 1 - 1e-7)))) AS bce,
                   abs(avg(CASE WHEN s = 0 THEN p END) - avg(CASE WHEN s = 1 THEN p END)) AS gap
                 FROM scored_models GROUP BY model_id)""")
def q_gap_objective(spark, d):
    """M15, older form: BCE + lambda times the gap of the mean scores, per sweep model."""
    return A.gap_objective(B.scored_models(spark, d), "lam", MK)


@register("fair_objective", B.with_roles("scored_models")
          + """SELECT model_id, lam, bce, rho, bce + lam * rho * rho AS objective FROM (
                 SELECT model_id, first(lam) AS lam,
                   avg(-(y * ln(least(greatest(p, 1e-7), 1 - 1e-7)) + (1 - y) * ln(1 - least(greatest(p, 1e-7), 1 - 1e-7)))) AS bce,
                   covar_pop(p, CAST(s AS DOUBLE)) / sqrt(var_pop(p) * var_pop(CAST(s AS DOUBLE)) + 1e-8) AS rho
                 FROM scored_models GROUP BY model_id)""")
def q_fair_objective(spark, d):
    """Training objective BCE + lambda rho^2 evaluated per sweep model."""
    return A.fair_objective(B.scored_models(spark, d), "lam", MK)
