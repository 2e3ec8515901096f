"""Registered sweep (W), uncertainty (U) and profile (E) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import audit as A
from riskframe.operators import profile as E
from riskframe.operators import split as P
from riskframe.operators import sweep as W
from riskframe.operators import uncertainty as U
from riskframe.plans import bindings as B
from riskframe.plans.q_audit import auc_cte, cum_cte, evaluate_ctes, youden_cte
from riskframe.plans.q_prep import SEED, split_sql
from riskframe.plans.registry import register
from riskframe.session import cut_lineage

MK = ["model_id"]
SEEDS3 = P.repeat_seeds(SEED, 3)
N_BINS = 20

# ---------------------------------------------------------------- sweep (W)


def sweep_table(spark, d):
    """One row per sweep model: evaluation metrics, lambda and score std."""
    sm = B.scored_models(spark, d)
    ev = A.evaluate_models(sm, MK)
    extra = sm.groupBy("model_id").agg(F.max("lam").alias("lam"), F.stddev_pop("p").alias("score_std"))
    return ev.join(extra, "model_id")


SWEEP_CTES = evaluate_ctes() + """,
sw AS (SELECT e.*, m.lam, m.score_std FROM eval_t e JOIN
       (SELECT model_id, max(lam) AS lam, stddev_pop(p) AS score_std FROM scored_models GROUP BY model_id) m
       USING (model_id))"""


def pareto_sql(src: str, status: bool) -> str:
    if status:
        ok = "lam <> 0 AND (status <> 'colapsado' OR all_collapsed)"
        viable = f"coalesce({ok} AND NOT (auc IS NULL OR isnan(auc)) AND auc >= base_auc - 0.02, false)"
    else:
        ok = "lam <> 0"
        viable = (f"coalesce({ok} AND (base_auc IS NULL OR isnan(base_auc) OR auc IS NULL OR isnan(auc) "
                  "OR auc >= base_auc - 0.02), false)")
    collapsed = ", count_if(lam <> 0 AND status <> 'colapsado') OVER () = 0 AS all_collapsed" if status else ""
    return f"""pb AS (SELECT *, max(CASE WHEN lam = 0 THEN auc END) OVER () AS base_auc{collapsed} FROM {src}),
pv AS (SELECT *, {viable} AS viable FROM pb),
pc AS (SELECT *, CASE WHEN max(CAST(viable AS INTEGER)) OVER () = 1 THEN viable ELSE coalesce({ok}, false) END AS cand FROM pv),
pr AS (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY abs_rho ASC NULLS LAST, auc DESC NULLS LAST, lam ASC) AS rk FROM pc),
pareto AS (SELECT *, (lam = 0) OR (cand AND rk = 1) AS selected FROM pr)"""


STATUS_SQL = """st AS (SELECT *, CASE WHEN lam = 0 THEN 'base_cuadratica'
    WHEN coalesce(auc <= 0.55 OR threshold >= 0.99 OR score_std <= 0.0001, false) THEN 'colapsado' ELSE 'fair_cuadratico' END AS status FROM sw)"""


@register("pareto_select", B.with_roles("scored_models", extra=SWEEP_CTES + ",\n" + pareto_sql("sw", False))
          + "SELECT model_id, lam, auc, abs_rho, viable, selected FROM pareto")
def q_pareto_select(spark, d):
    """Keep the baseline, pick the fairest viable lambda."""
    return W.pareto_select(sweep_table(spark, d)).select("model_id", "lam", "auc", "abs_rho", "viable", "selected")


@register("collapse_status", B.with_roles("scored_models", extra=SWEEP_CTES + ",\n" + STATUS_SQL)
          + "SELECT model_id, lam, auc, threshold, score_std, status FROM st")
def q_collapse_status(spark, d):
    """Base / collapsed / ok per sweep row."""
    return W.collapse_status(sweep_table(spark, d)).select("model_id", "lam", "auc", "threshold", "score_std", "status")


@register("pareto_select_status", B.with_roles("scored_models", extra=SWEEP_CTES + ",\n" + STATUS_SQL + ",\n"
                                               + pareto_sql("st", True))
          + "SELECT model_id, lam, auc, abs_rho, status, viable, selected FROM pareto")
def q_pareto_select_status(spark, d):
    """W1 after excluding collapsed rows (missing AUC not viable)."""
    st = W.collapse_status(sweep_table(spark, d))
    return W.pareto_select(st, status="status").select("model_id", "lam", "auc", "abs_rho", "status",
                                                       "viable", "selected")


@register("comparison_table", B.with_roles("scored_models", extra=SWEEP_CTES + ",\n" + STATUS_SQL + ",\n" + pareto_sql("st", True))
          + """SELECT model_id, lam, status, auc, abs_rho, dpd, eod,
                 max(CASE WHEN lam = 0 THEN auc END) OVER () - auc AS auc_loss,
                 max(CASE WHEN lam = 0 THEN abs_rho END) OVER () - abs_rho AS rho_improvement,
                 max(CASE WHEN lam = 0 THEN dpd END) OVER () - dpd AS dpd_improvement FROM pareto WHERE selected""")
def q_comparison_table(spark, d):
    """The selected sweep rows against the baseline row."""
    st = W.pareto_select(W.collapse_status(sweep_table(spark, d)), status="status").where("selected")
    return W.comparison_table(st.select("model_id", "lam", "status", "auc", "abs_rho", "dpd", "eod"),
                              reference_filter=F.col("lam") == 0)


@register("model_ladder", B.with_roles("scored_models", extra=SWEEP_CTES)
          + "SELECT model_id, auc, auc = max(auc) OVER () AS is_best FROM sw")
def q_model_ladder(spark, d):
    """Ladder with the best-AUC marker."""
    return W.model_ladder(sweep_table(spark, d).select("model_id", "auc"))


def _seed_test_rows(spark, d):
    """Test rows of every seed under every lambda: the base scores are split once
    per seed, and the grid is exploded last."""
    base = B.scored(spark, d).select("id", "y", "s")
    out = None
    for seed in SEEDS3:
        sp = P.stratified_split(base, id_col="id", strata=["y", "s"], seed=seed)
        part = sp.filter(F.col("split") == "test").select("id", F.lit(seed).alias("seed"))
        out = part if out is None else out.unionByName(part)
    # (id, seed) of 15 % of the rows per seed; read once by the join
    chosen = out.groupBy("id").agg(F.collect_list("seed").alias("seeds"))
    return B.on_grid(B.scored_base(spark, d).join(chosen.hint("merge"), "id"), "seeds").select(
        "*", F.explode("seeds").alias("seed")).drop("seeds")


def _seed_sql() -> str:
    ctes = []
    for s in SEEDS3:
        ctes.append(split_sql("(SELECT id, y, s FROM scored_models WHERE lam = 0)", "id", ["y", "s"], f"sp{s}", seed=s))
    union = " UNION ALL ".join(f"SELECT id, {s} AS seed FROM sp{s} WHERE split = 'test'" for s in SEEDS3)
    ctes.append(f"seed_ids AS ({union})")
    ctes.append("seed_rows AS (SELECT m.*, t.seed FROM scored_models m JOIN seed_ids t USING (id))")
    ctes.append(cum_cte("seed_rows", "model_id, seed", "scum"))
    ctes.append(auc_cte("model_id, seed", "scum"))
    ctes.append("""gap_t AS (SELECT model_id, seed, max(lam) AS lam,
        abs(avg(CASE WHEN s = 0 THEN p END) - avg(CASE WHEN s = 1 THEN p END)) AS gap
        FROM seed_rows GROUP BY model_id, seed)""")
    ctes.append("per_seed AS (SELECT * FROM auc_t JOIN gap_t USING (model_id, seed))")
    return ",\n".join(ctes)


@register("sweep_over_seeds", B.with_roles("scored_models", extra=_seed_sql())
          + """SELECT lam, auc_mean, auc_std, gap_mean, gap_std, n_seeds,
                 auc_mean - max(CASE WHEN lam = 0 THEN auc_mean END) OVER () AS delta_auc,
                 (max(CASE WHEN lam = 0 THEN gap_mean END) OVER () - gap_mean)
                   / NULLIF(max(CASE WHEN lam = 0 THEN gap_mean END) OVER (), 0) * 100 AS gap_reduction_pct
               FROM (SELECT lam, avg(auc) AS auc_mean, stddev_pop(auc) AS auc_std, avg(gap) AS gap_mean,
                       stddev_pop(gap) AS gap_std, count(*) AS n_seeds FROM per_seed GROUP BY lam)""")
def q_sweep_over_seeds(spark, d):
    """Per lambda, mean / population std over three evaluation seeds (each
    seed's stratified test split), with deltas against lambda 0."""
    # AUC and gap both follow from the counts of (lambda, seed, score, y, s)
    rows = cut_lineage(_seed_test_rows(spark, d).groupBy("lam", "seed", "p", "y", "s").agg(F.count(F.lit(1)).alias("c")))
    auc = A.roc_auc(rows, ["lam", "seed"], weight="c")
    mean = [F.sum(F.when(F.col("s") == v, F.col("p") * F.col("c"))) / F.sum(F.when(F.col("s") == v, F.col("c"))) for v in (0, 1)]
    gap = rows.groupBy("lam", "seed").agg(F.abs(mean[0] - mean[1]).alias("gap"))
    per_seed = auc.join(gap, ["lam", "seed"])
    return W.sweep_over_seeds(per_seed)


def _oof(spark, d):
    sc = B.scored(spark, d)
    folds = P.kfold_assign(sc, id_col="id", strata=["y", "s"], k=5, seeds=[SEED])
    return sc.join(folds.select("id", "fold"), "id")


@register("oof_metrics", B.with_roles("scored") + f""", folds AS (SELECT *, CAST((row_number() OVER (
              PARTITION BY CAST(y AS VARCHAR) || '_' || CAST(s AS VARCHAR) ORDER BY md5(CAST(id AS VARCHAR) || ':{SEED}'), id) - 1) % 5 AS INTEGER) AS fold
            FROM scored),
{cum_cte('folds', 'fold', 'fcum')},
{auc_cte('fold', 'fcum')}
SELECT avg(auc) AS fold_auc_mean, stddev_pop(auc) AS fold_auc_std, count(*) AS n_folds FROM auc_t""")
def q_oof_metrics(spark, d):
    """Fold AUCs of out-of-fold scores, their mean and population std."""
    return W.fold_summary(A.roc_auc(_oof(spark, d), ["fold"]))


# ---------------------------------------------------------------- uncertainty (U)

def _scored_split(spark, d):
    return P.stratified_split(B.scored(spark, d), id_col="id", strata=["y", "s"], seed=SEED)


SSP = split_sql("scored", "id", ["y", "s"], "ssp")


def _nulls_per_order(spark, d):
    """Null count of the customer of every order, of whatever gender code."""
    o = B.read_table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey"))
    app = B.application(spark, d)
    nulls = sum((F.col(c).isNull().cast("int") for c in EXT), F.lit(0))
    app = app.select(F.col("SK_ID_CURR").alias("o_custkey"), nulls.alias("ext_null_count"))
    return o.join(app, "o_custkey").select("id", "ext_null_count")


def _uncertainty_rows(spark, d):
    """Validation fits the binned error model and the Youden threshold; test rows
    get their uncertainty."""
    sp = _scored_split(spark, d)
    val = sp.filter(F.col("split") == "validation")
    model = U.fit_binned_error(val, n_bins=N_BINS)
    t = A.youden(val).first()["threshold"]
    test = sp.filter(F.col("split") == "test").join(_nulls_per_order(spark, d), "id", "left")
    return U.prediction_table(U.apply_binned_error(test, model, n_bins=N_BINS), threshold=t, null_count="ext_null_count")


EXT = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
NULLS_CTE = "nulls AS (SELECT o_orderkey AS id, " + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in EXT) + """ AS ext_null_count
              FROM orders JOIN application ON o_custkey = SK_ID_CURR)"""


UNC_CTES = SSP + ",\n" + NULLS_CTE + f""",
val AS (SELECT *, 'v' AS k FROM ssp WHERE split = 'validation'),
{cum_cte('val', 'k', 'vcum')},
{youden_cte('k', 'vcum')},
binerr AS (SELECT CAST(least(floor(p * {N_BINS}), {N_BINS - 1}) AS INTEGER) AS b, avg(abs(p - CAST(y AS DOUBLE))) AS u
           FROM val GROUP BY 1),
pred AS (SELECT t.id, t.y AS y_true, t.p AS y_proba, CAST(t.p >= yt.threshold AS INTEGER) AS y_pred, t.s AS sensitive,
           yt.threshold, nulls.ext_null_count, coalesce(be.u, (SELECT avg(abs(p - CAST(y AS DOUBLE))) FROM val)) AS uncertainty
         FROM (SELECT * FROM ssp WHERE split = 'test') t CROSS JOIN youden_t yt LEFT JOIN nulls ON nulls.id = t.id
         LEFT JOIN binerr be ON CAST(least(floor(t.p * {N_BINS}), {N_BINS - 1}) AS INTEGER) = be.b)"""


@register("error_target", B.with_roles("scored", extra=SSP)
          + "SELECT *, abs(p - CAST(y AS DOUBLE)) AS abs_error FROM ssp WHERE split = 'validation'")
def q_error_target(spark, d):
    """|p - y| on the validation rows."""
    return U.error_target(_scored_split(spark, d).filter(F.col("split") == "validation"))


@register("prediction_table", B.with_roles("scored", "application", extra=UNC_CTES) + "SELECT * FROM pred")
def q_prediction_table(spark, d):
    """U2 (binned) + U4: test prediction rows with validation-fitted uncertainty."""
    return _uncertainty_rows(spark, d)


@register("clip_check", B.with_roles("scored", "application", extra=UNC_CTES)
          + """SELECT count(*) AS n, count_if(uncertainty IS NULL OR isnan(uncertainty) OR isinf(uncertainty)) AS n_non_finite,
                 count(DISTINCT round(CASE WHEN uncertainty < 0 THEN 0 WHEN uncertainty > 1 THEN 1 ELSE uncertainty END, 8)) AS n_distinct,
                 min(CASE WHEN uncertainty < 0 THEN 0 WHEN uncertainty > 1 THEN 1 ELSE uncertainty END) AS min_u,
                 max(CASE WHEN uncertainty < 0 THEN 0 WHEN uncertainty > 1 THEN 1 ELSE uncertainty END) AS max_u FROM pred""")
def q_clip_check(spark, d):
    """Clip + finiteness + non-constant check of the uncertainty column."""
    return U.clip_check(_uncertainty_rows(spark, d))


def _summary_sql(src: str, group: str, value: str) -> str:
    return f"""SELECT {group}, count(*) AS n, avg({value}) AS mean, quantile_cont({value}, 0.25) AS q1,
        quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3,
        quantile_cont({value}, 0.75) - quantile_cont({value}, 0.25) AS iqr FROM {src} GROUP BY {group}"""


@register("uncert_by_target", B.with_roles("scored", "application", extra=UNC_CTES) + _summary_sql("pred", "y_true", "uncertainty"))
def q_uncert_by_target(spark, d):
    """Uncertainty summary per true class (exact quartiles)."""
    return U.summary_by(_uncertainty_rows(spark, d), "y_true")


@register("uncert_histogram", B.with_roles("scored", "application", extra=UNC_CTES)
          + """SELECT y_pred, y_true, CAST(least(greatest(floor(uncertainty * 30), 0), 29) AS INTEGER) AS bin, count(*) AS n
               FROM pred GROUP BY 1, 2, 3""")
def q_uncert_histogram(spark, d):
    """30-bin uncertainty histogram by predicted / real class."""
    return U.histogram(_uncertainty_rows(spark, d), "uncertainty", ["y_pred", "y_true"], 30)


@register("oof_errors", B.with_roles("scored") + f"""SELECT id, y, s, p, abs(p - CAST(y AS DOUBLE)) AS abs_error,
      CAST((row_number() OVER (PARTITION BY CAST(y AS VARCHAR) || '_' || CAST(s AS VARCHAR)
        ORDER BY md5(CAST(id AS VARCHAR) || ':{SEED}'), id) - 1) % 5 AS INTEGER) AS fold FROM scored""")
def q_oof_errors(spark, d):
    """Out-of-fold error table (id, y, s, p, |error|, fold)."""
    return U.error_target(_oof(spark, d)).select("id", "y", "s", "p", "abs_error", "fold")


def _ensemble(spark, d):
    sm = B.scored_models(spark, d)
    var = U.ensemble_variance(sm)
    labels = B.scored(spark, d).select("id", "y")
    return var.join(labels, "id")


ENS_CTE = """ens AS (SELECT id, avg(p) AS mean_p, var_pop(p) AS var_p, count(*) AS n_passes, max(y) AS y
                FROM scored_models GROUP BY id)"""


@register("ensemble_variance", B.with_roles("scored_models", extra=ENS_CTE) + "SELECT * FROM ens")
def q_ensemble_variance(spark, d):
    """U8 (re-aimed): mean and population variance of a row over ensemble members."""
    return _ensemble(spark, d)


@register("variance_by_class", B.with_roles("scored_models", extra=ENS_CTE)
          + "SELECT y, count(*) AS n, avg(var_p) AS mean, quantile_cont(var_p, 0.5) AS median FROM ens GROUP BY y")
def q_variance_by_class(spark, d):
    """Variance per class."""
    return U.variance_by_class(_ensemble(spark, d), "y")


@register("class_variance_ratio", B.with_roles("scored_models", extra=ENS_CTE) + """SELECT mean_0, mean_1, mean_1 / nullif(mean_0, 0) AS ratio
          FROM (SELECT avg(CASE WHEN y = 0 THEN var_p END) AS mean_0, avg(CASE WHEN y = 1 THEN var_p END) AS mean_1 FROM ens)""")
def q_class_variance_ratio(spark, d):
    """Mean variance of class 1 over class 0."""
    return U.class_variance_ratio(_ensemble(spark, d), "y")


@register("variance_by_missing", B.with_roles("scored_models", "application", extra=ENS_CTE + ",\n" + NULLS_CTE + """,
    agg AS (SELECT CAST(ext_null_count AS INTEGER) AS ext_null_count, count(*) AS n, avg(var_p) AS mean,
                   stddev_pop(var_p) AS sd FROM ens JOIN nulls USING (id) GROUP BY 1)""")
          + """SELECT k.ext_null_count, coalesce(n, 0) AS n, mean, 1.96 * sd / sqrt(n) AS ci95
               FROM (SELECT CAST(range AS INTEGER) AS ext_null_count FROM range(4)) k LEFT JOIN agg USING (ext_null_count)""")
def q_variance_by_missing(spark, d):
    """Variance per missing count 0..3 (zero-filled) with a 95 % interval."""
    return U.variance_by_missing(_ensemble(spark, d).join(_nulls_per_order(spark, d), "id"))


@register("uncert_by_nulls", B.with_roles("scored", "application", extra=UNC_CTES) + _summary_sql("pred", "ext_null_count", "uncertainty"))
def q_uncert_by_nulls(spark, d):
    """Uncertainty summary per customer null count."""
    return U.summary_by(_uncertainty_rows(spark, d), "ext_null_count")


# ---------------------------------------------------------------- profiles (E)

NUM = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "EXT_SOURCE_1", "EXT_SOURCE_2",
       "EXT_SOURCE_3", "AGE_YEARS", "EMPLOYED_YEARS", "CNT_CHILDREN"]


def _long_sql(cols, keep: str = "TARGET", src: str = "deterministic") -> str:
    return " UNION ALL ".join(f"SELECT {keep}, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)


@register("headline_rates", B.with_roles("deterministic")
          + """SELECT count(*) AS n_rows, avg(CAST(TARGET AS DOUBLE)) AS target_rate,
                 avg(CAST(SENSITIVE AS DOUBLE)) AS sensitive_rate, count_if(TARGET = 1) AS n_positive FROM deterministic""")
def q_headline_rates(spark, d):
    """E1."""
    return E.headline_rates(B.deterministic(spark, d))


@register("null_rates", B.with_roles("deterministic") + " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count_if({c} IS NULL) AS n_null, count_if({c} IS NULL) * 100.0 / count(*) AS null_pct,
          CASE WHEN count_if({c} IS NULL) = 0 THEN '0' WHEN count_if({c} IS NULL) * 100.0 / count(*) <= 20 THEN '<=20'
               WHEN count_if({c} IS NULL) * 100.0 / count(*) <= 60 THEN '<=60' ELSE '>60' END AS band FROM deterministic"""
    for c in NUM))
def q_null_rates(spark, d):
    """Null rate per column with bands."""
    return E.null_rates(B.deterministic(spark, d), NUM)


@register("rate_by_category", B.with_roles("deterministic")
          + "SELECT NAME_SEGMENT, count(*) AS n, avg(CAST(TARGET AS DOUBLE)) AS rate FROM deterministic GROUP BY 1")
def q_rate_by_category(spark, d):
    """E3."""
    return E.rate_by_category(B.deterministic(spark, d), "NAME_SEGMENT")


CATS = ["NAME_SEGMENT", "REGION_CODE", "FLAG_OWN_CAR"]


@register("category_strength", B.with_roles("deterministic") + "SELECT feature, count(*) AS cardinality, stddev_samp(rate) AS rate_std FROM ("
          + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v, avg(CAST(TARGET AS DOUBLE)) AS rate FROM deterministic GROUP BY 2"
                               for c in CATS) + ") GROUP BY feature")
def q_category_strength(spark, d):
    """Cardinality and spread of category target rates."""
    return E.category_strength(B.deterministic(spark, d), CATS)


@register("rate_by_decile", B.with_roles("deterministic", extra="""q AS (SELECT unnest(quantile_cont(EXT_SOURCE_2,
          [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS e FROM deterministic),
        edges AS (SELECT DISTINCT e FROM q),
        b AS (SELECT *, greatest((SELECT count(*) FROM edges WHERE e < EXT_SOURCE_2) - 1, 0) AS bin
              FROM deterministic WHERE EXT_SOURCE_2 IS NOT NULL)""")
          + """SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, avg(CAST(TARGET AS DOUBLE)) AS rate,
                 min(EXT_SOURCE_2) AS score_min, max(EXT_SOURCE_2) AS score_max,
                 stddev_samp(CAST(TARGET AS DOUBLE)) / sqrt(count(*)) AS se FROM b GROUP BY bin""")
def q_rate_by_decile(spark, d):
    """Target rate by exact-quantile bins (duplicate edges dropped)."""
    return E.rate_by_decile(B.deterministic(spark, d), "EXT_SOURCE_2", "TARGET")


@register("rate_by_nulls", B.with_roles("deterministic")
          + """SELECT EXT_NULL_COUNT, count(*) AS n, avg(CAST(TARGET AS DOUBLE)) AS rate,
                 count(*) / sum(count(*)) OVER () AS share FROM deterministic GROUP BY 1""")
def q_rate_by_nulls(spark, d):
    """E8."""
    return E.rate_by_nulls(B.deterministic(spark, d))


def _pearson_sql(x: str, y: str) -> str:
    return (f"CASE WHEN sqrt(var_pop({x}) * var_pop({y})) > 0 THEN covar_pop({x}, {y}) / sqrt(var_pop({x}) * var_pop({y})) "
            "ELSE 0 END")


@register("pearson_target", B.with_roles("deterministic")
          + f"SELECT feature, count(*) AS n, {_pearson_sql('value', 'CAST(TARGET AS DOUBLE)')} AS pearson FROM ("
          + _long_sql(NUM) + ") WHERE value IS NOT NULL AND TARGET IS NOT NULL GROUP BY feature")
def q_pearson_target(spark, d):
    """Guarded Pearson of every numeric column with the target."""
    return E.pearson_target(B.deterministic(spark, d), NUM)


CM = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AGE_YEARS"]


@register("corr_matrix", B.with_roles("deterministic") + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {_pearson_sql(f'CAST({a} AS DOUBLE)', f'CAST({b} AS DOUBLE)')} AS pearson "
    f"FROM deterministic WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
    for i, a in enumerate(CM) for b in CM[i:]))
def q_corr_matrix(spark, d):
    """Pairwise Pearson matrix (long form)."""
    return E.corr_matrix(B.deterministic(spark, d), CM)


SPEAR_CTES = "l AS (" + _long_sql(NUM) + """),
        r AS (SELECT feature, value, CAST(TARGET AS DOUBLE) AS y,
                rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS rx,
                rank() OVER (PARTITION BY feature ORDER BY TARGET) + (count(*) OVER (PARTITION BY feature, TARGET) - 1) / 2.0 AS ry
              FROM l WHERE value IS NOT NULL AND TARGET IS NOT NULL)"""
SPEAR_SQL = f"""SELECT feature, spearman, pearson, spearman - pearson AS gap FROM (
                 SELECT feature, {_pearson_sql('CAST(rx AS DOUBLE)', 'CAST(ry AS DOUBLE)')} AS spearman,
                   {_pearson_sql('value', 'y')} AS pearson FROM r GROUP BY feature)"""


@register("spearman_target", B.with_roles("deterministic", extra=SPEAR_CTES) + SPEAR_SQL)
def q_spearman_target(spark, d):
    """Spearman (average ranks, distributed) vs Pearson per feature."""
    return E.spearman_target(B.deterministic(spark, d), NUM)


COHEN_SQL = """SELECT feature, n, null_pct, cohens_d FROM (
    SELECT feature, count(CASE WHEN TARGET IS NOT NULL THEN value END) AS n, 100.0 * (count(*) - count(value)) / count(*) AS null_pct,
      abs(avg(CASE WHEN TARGET = 1 THEN value END) - avg(CASE WHEN TARGET = 0 THEN value END))
        / (stddev_samp(CASE WHEN TARGET IS NOT NULL THEN value END) + 1e-9) AS cohens_d
    FROM l GROUP BY feature)"""


@register("cohens_d", B.with_roles("deterministic", extra="l AS (" + _long_sql(NUM) + ")")
          + COHEN_SQL + " WHERE n >= 1000 AND null_pct > 20 AND null_pct <= 70")
def q_cohens_d(spark, d):
    """Difference of the class means in standard deviations, for columns with 20-70 % nulls."""
    return E.cohens_d(B.deterministic(spark, d), NUM)


@register("feature_pick", B.with_roles("deterministic", extra=SPEAR_CTES + ", c AS (" + COHEN_SQL + " WHERE n >= 1000)")
          + f"""SELECT feature, spearman, cohens_d FROM ({SPEAR_SQL}) FULL OUTER JOIN c USING (feature)
                WHERE abs(spearman) > 0.04 OR cohens_d > 0.10""")
def q_feature_pick(spark, d):
    """Columns with |Spearman| > 0.04 or a difference of means > 0.10."""
    df = B.deterministic(spark, d)
    return E.feature_pick(E.spearman_target(df, NUM), E.cohens_d(df, NUM, null_pct=None)).select("feature", "spearman", "cohens_d")


@register("fast_abs_corr", B.with_roles("deterministic", extra="l AS (" + _long_sql(NUM) + """),
        a AS (SELECT feature, count(value) AS n, avg(value) AS mx, stddev_pop(value) AS sx, sum(value * TARGET) AS sxy,
                sum(CASE WHEN value IS NOT NULL THEN TARGET END) AS sy, stddev_pop(CAST(TARGET AS DOUBLE)) AS sdy FROM l GROUP BY feature)""")
          + "SELECT feature, abs(sxy - mx * sy) / (n * sx * sdy) AS abs_corr_target FROM a WHERE n >= 1000 AND sx * sdy > 1e-9")
def q_fast_abs_corr(spark, d):
    """|correlation| with the target, its moments taken over all rows."""
    return E.fast_abs_corr(B.deterministic(spark, d), NUM)


@register("crosstab_rate", B.with_roles("deterministic") + """SELECT NAME_SEGMENT, count_if(TARGET = 0) / count(*) AS share_0,
          count_if(TARGET = 1) / count(*) AS share_1 FROM deterministic WHERE TARGET IS NOT NULL GROUP BY 1""")
def q_crosstab_rate(spark, d):
    """Row-normalised crosstab of segment and target."""
    return E.crosstab_rate(B.deterministic(spark, d).where("TARGET IS NOT NULL"), "NAME_SEGMENT", "TARGET", [0, 1])


@register("group_share", B.with_roles("deterministic")
          + """SELECT NAME_SEGMENT, TARGET, count(*) AS n,
                 count(*) / sum(count(*)) OVER (PARTITION BY NAME_SEGMENT) AS share FROM deterministic GROUP BY 1, 2""")
def q_group_share(spark, d):
    """Share of each target class within a segment."""
    return E.group_share(B.deterministic(spark, d), "NAME_SEGMENT", "TARGET")


@register("grid_rate", B.with_roles("deterministic")
          + """SELECT CAST(least(greatest(floor(EXT_SOURCE_1 * 10), 0), 9) AS INTEGER) AS bx,
                 CAST(least(greatest(floor(EXT_SOURCE_2 * 10), 0), 9) AS INTEGER) AS by,
                 count(*) AS n, avg(CAST(TARGET AS DOUBLE)) AS rate FROM deterministic
               WHERE EXT_SOURCE_1 IS NOT NULL AND EXT_SOURCE_2 IS NOT NULL GROUP BY 1, 2""")
def q_grid_rate(spark, d):
    """E15 (re-aimed): square 2-D bins of two scores with mean target."""
    return E.grid_rate(B.deterministic(spark, d), "EXT_SOURCE_1", "EXT_SOURCE_2", "TARGET", 10, (0.0, 1.0), (0.0, 1.0))


BOX = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


@register("box_stats", B.with_roles("deterministic", extra="l AS (" + _long_sql(BOX) + ")")
          + """SELECT feature, TARGET, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
                 max(value) AS max, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                 quantile_cont(value, 0.75) AS q3 FROM l WHERE value IS NOT NULL GROUP BY feature, TARGET""")
def q_box_stats(spark, d):
    """Unpivoted scores by target with exact box statistics."""
    return E.box_stats(B.deterministic(spark, d), BOX, "TARGET")


WIN = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY"]


@register("describe", B.with_roles("deterministic", extra="l AS (" + _long_sql(BOX) + ")")
          + """SELECT feature, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
                 max(value) AS max, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                 quantile_cont(value, 0.75) AS q3 FROM l WHERE value IS NOT NULL GROUP BY feature""")
def q_describe(spark, d):
    """Exact description of numeric columns."""
    return E.describe(B.deterministic(spark, d), BOX)


@register("last_and_best", """WITH e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
            row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM events WHERE value IS NOT NULL),
          b AS (SELECT user_id, count(*) AS n, max(value) AS best, max(CASE WHEN back = 1 THEN value END) AS last FROM e GROUP BY 1)
          SELECT b.user_id, n, last, best, (SELECT min(step) FROM e WHERE e.user_id = b.user_id AND e.value = b.best) AS best_step FROM b""")
def q_last_and_best(spark, d):
    """Last and best step of every run (a user's events in time order)."""
    return E.last_and_best(B.read_table(spark, d, "events").select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"], "value")


@register("winsor_long", B.with_roles("deterministic", extra="cap AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.99) AS c_{c}" for c in WIN) + " FROM deterministic)")
          + "SELECT * FROM (" + " UNION ALL ".join(
              f"SELECT TARGET, '{c}' AS feature, CAST(CASE WHEN {c} > c_{c} THEN c_{c} ELSE {c} END AS DOUBLE) AS value "
              f"FROM deterministic, cap" for c in WIN) + ") WHERE value IS NOT NULL")
def q_winsor_long(spark, d):
    """Money columns capped at their exact p99, unpivoted to long form."""
    return E.winsor_long(B.deterministic(spark, d), WIN, 0.99, keep=["TARGET"])


@register("histogram_by_class", B.with_roles("deterministic", extra="""h AS (SELECT ln(1 + AMT_CREDIT) AS x, TARGET AS cls
          FROM deterministic WHERE AMT_CREDIT IS NOT NULL),
        mm AS (SELECT min(x) AS lo, max(x) AS hi FROM h)""")
          + """SELECT cls, CAST(least(floor((x - lo) / (hi - lo) * 80), 79) AS INTEGER) AS bin, count(*) AS n,
                 lo + CAST(least(floor((x - lo) / (hi - lo) * 80), 79) AS INTEGER) * ((hi - lo) / 80) AS bin_lo
               FROM h, mm GROUP BY cls, bin, lo, hi""")
def q_histogram_by_class(spark, d):
    """80-bin histogram of log1p(credit) per target class."""
    return E.histogram_by_class(B.deterministic(spark, d), "AMT_CREDIT", "TARGET", 80, log1p=True)


HEX = 40


@register("hexagon_rate", B.with_roles("deterministic", extra=f"""r AS (SELECT coalesce(EXT_SOURCE_2, 0)::DOUBLE AS hx, coalesce(EXT_SOURCE_3, 0)::DOUBLE AS hy,
        TARGET::DOUBLE AS t FROM deterministic),
    m AS (SELECT min(hx) AS lx, min(hy) AS ly, (max(hx) - min(hx)) / {HEX} AS sx, (max(hy) - min(hy)) / {int(HEX / 3 ** 0.5)} AS sy FROM r),
    p AS (SELECT t, (hx - lx) / sx AS u, (hy - ly) / sy AS v FROM r, m),
    c AS (SELECT t, pow(u - floor(u + 0.5), 2) + 3 * pow(v - floor(v + 0.5), 2) < pow(u - floor(u) - 0.5, 2) + 3 * pow(v - floor(v) - 0.5, 2) AS a, u, v FROM p),
    h AS (SELECT t, CASE WHEN a THEN 1 ELSE 2 END AS lattice, CASE WHEN a THEN floor(u + 0.5) ELSE floor(u) END::BIGINT AS ix,
                 CASE WHEN a THEN floor(v + 0.5) ELSE floor(v) END::BIGINT AS iy FROM c),
    g AS (SELECT lattice, ix, iy, count(*) AS n, avg(t) AS rate FROM h GROUP BY ALL)""")
          + """SELECT lattice, ix, iy, n, rate, lx + (ix + CASE WHEN lattice = 2 THEN 0.5::DOUBLE ELSE 0 END) * sx AS centre_x,
                  ly + (iy + CASE WHEN lattice = 2 THEN 0.5::DOUBLE ELSE 0 END) * sy AS centre_y FROM g, m""")
def q_hexagon_rate(spark, d):
    """Hexagonal bins of two external scores with the mean target."""
    return E.hexagon_rate(B.deterministic(spark, d), "EXT_SOURCE_2", "EXT_SOURCE_3", "TARGET", HEX)


@register("density_by_class", B.with_roles("deterministic", extra="""r AS (SELECT TARGET AS cls, AGE_YEARS::DOUBLE AS v FROM deterministic WHERE AGE_YEARS IS NOT NULL),
    s0 AS (SELECT cls, count(*) AS size, stddev_samp(v) * pow(count(*)::DOUBLE, -0.2) AS bw, min(v) AS low, max(v) AS high FROM r GROUP BY cls),
    s AS (SELECT cls, size, bw, low - 4 * bw AS lo, (high + 4 * bw - (low - 4 * bw)) / 199 AS step FROM s0 WHERE bw > 0),
    a AS (SELECT cls, (v - lo) / step AS pos FROM r JOIN s USING (cls)),
    b AS (SELECT cls, floor(pos)::BIGINT AS i, sum(floor(pos) + 1 - pos) AS w FROM a GROUP BY ALL
          UNION ALL SELECT cls, floor(pos)::BIGINT + 1, sum(pos - floor(pos)) FROM a GROUP BY ALL),
    w AS (SELECT cls, i, sum(w) AS w FROM b GROUP BY ALL),
    g AS (SELECT s.*, unnest(range(200))::INTEGER AS point FROM s)""")
          + """SELECT cls, point, lo + point * step AS x, sum(w * exp(-0.5 * pow((point - i) * step / bw, 2))) / (size * bw * sqrt(2 * pi())) AS density, step
               FROM g JOIN w USING (cls) GROUP BY cls, point, lo, step, size, bw""")
def q_density_by_class(spark, d):
    """Kernel density of the age per target class on a grid of 200 points."""
    return E.density_by_class(B.deterministic(spark, d), "AGE_YEARS", "TARGET", 200)
