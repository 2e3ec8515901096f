"""Scoring audits on a scored DataFrame.

Input: rows ``(keys..., y, p[, s])``; ``keys`` (e.g. ``model_id``) lets every
model of a sweep be audited in one job.  Ranking metrics use the exact
distributed prefix sums of :mod:`riskframe.operators.ranked`; everything else
is one hash aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ranked import cumulative
from riskframe.session import cut_lineage

EPS_RHO = 1e-8


def roc_auc(df: DataFrame, keys: Sequence[str] = (), score: str = "p", label: str = "y",
            weight: str | Column | None = None, n_buckets: int = 64) -> DataFrame:
    """M1: tie-aware ROC-AUC = sum_i neg_i (pos_above_i + pos_i / 2) / (P N);
    NULL when a key has one class.  Decimal numerator: exact, and wide enough for 5e9 x 5e9 rows."""
    return _auc_of(cumulative(df, keys, score, label, weight, n_buckets), keys)


def _auc_of(cum: DataFrame, keys: Sequence[str]) -> DataFrame:
    neg, wide = F.col("neg").cast("decimal(19,0)"), "decimal(19,0)"
    num2 = neg * (F.col("tp_above") * 2 + F.col("pos")).cast(wide)
    agg = cum.groupBy(*keys).agg(F.sum(num2).alias("_num2"), F.first("P").alias("P"),
                                 F.first("N").alias("N"))
    return agg.select(*keys, F.when((F.col("P") > 0) & (F.col("N") > 0),
                                    F.col("_num2").cast("double") / (2.0 * F.col("P").cast("double") * F.col("N")))
                      .alias("auc"))


def pr_auc(df: DataFrame, keys: Sequence[str] = (), score: str = "p", label: str = "y") -> DataFrame:
    """M2: average precision sum_n (R_n - R_{n-1}) P_n over distinct thresholds."""
    return _ap_of(cumulative(df, keys, score, label), keys)


def _ap_of(cum: DataFrame, keys: Sequence[str]) -> DataFrame:
    tp = F.col("tp_above") + F.col("pos")
    fp = F.col("fp_above") + F.col("neg")
    term = F.col("pos").cast("double") * tp / (tp + fp)
    agg = cum.groupBy(*keys).agg(F.sum(term).alias("_s"), F.first("P").alias("P"),
                                 F.first("N").alias("N"))
    return agg.select(*keys, F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_s") / F.col("P"))
                      .alias("ap"))


def youden(df: DataFrame, keys: Sequence[str] = (), score: str = "p", label: str = "y") -> DataFrame:
    """M4: threshold maximising TPR - FPR (integer J = TP N - FP P so ties are
    exact); ties go to the highest threshold; no positive J -> threshold 1.0."""
    return _youden_of(cumulative(df, keys, score, label), keys)


def _youden_of(cum: DataFrame, keys: Sequence[str]) -> DataFrame:
    tp = F.col("tp_above") + F.col("pos")
    fp = F.col("fp_above") + F.col("neg")
    wide = "decimal(19,0)"
    jint = tp.cast(wide) * F.col("N").cast(wide) - fp.cast(wide) * F.col("P").cast(wide)
    best = cum.groupBy(*keys).agg(
        F.max_by(F.struct(jint.alias("j"), F.col("score").alias("t")),
                 F.struct(jint, F.col("score"))).alias("b"),
        F.first("P").alias("P"), F.first("N").alias("N"))
    j = F.col("b.j").cast("double") / (F.col("P").cast("double") * F.col("N"))
    pos_j = F.col("b.j") > 0
    return best.select(
        *keys,
        F.when(pos_j, F.least(F.greatest(F.col("b.t"), F.lit(0.0)), F.lit(1.0)))
        .otherwise(F.lit(1.0)).alias("threshold"),
        F.when(pos_j, j).otherwise(F.lit(0.0)).alias("youden_j"))


def best_f1(df: DataFrame, keys: Sequence[str] = (), score: str = "p", label: str = "y") -> DataFrame:
    """M5: threshold with the largest F1 over distinct scores and {0, 1}; ties go
    to the smallest threshold."""
    cum = cumulative(df, keys, score, label)
    tp = F.col("tp_above") + F.col("pos")
    fp = F.col("fp_above") + F.col("neg")
    cand = cum.select(*keys, F.col("score").alias("t"), tp.alias("tp"), fp.alias("fp"), "P", "N")
    # boundary candidates 0 and 1 (p >= 0 selects all rows; p >= 1 only scores of 1)
    tot = cum.groupBy(*keys).agg(
        F.first("P").alias("P"), F.first("N").alias("N"),
        F.sum(F.when(F.col("score") >= 1, F.col("pos")).otherwise(0)).alias("tp1"),
        F.sum(F.when(F.col("score") >= 1, F.col("neg")).otherwise(0)).alias("fp1"))
    zero = tot.select(*keys, F.lit(0.0).alias("t"), F.col("P").alias("tp"), F.col("N").alias("fp"), "P", "N")
    one = tot.select(*keys, F.lit(1.0).alias("t"), F.col("tp1").alias("tp"), F.col("fp1").alias("fp"), "P", "N")
    allc = cand.unionByName(zero).unionByName(one)
    fn = F.col("P") - F.col("tp")
    den = 2 * F.col("tp") + F.col("fp") + fn
    f1 = F.when(den > 0, (2 * F.col("tp")).cast("double") / den).otherwise(F.lit(0.0))
    best = allc.select(*keys, "t", f1.alias("f1")).groupBy(*keys).agg(
        F.max_by(F.struct("f1", "t"), F.struct(F.col("f1"), -F.col("t"))).alias("b"))
    return best.select(*keys, F.least(F.greatest(F.col("b.t"), F.lit(0.0)), F.lit(1.0)).alias("threshold"),
                       F.col("b.f1").alias("f1"))


def apply_threshold(df: DataFrame, threshold: float | str | Column, score: str = "p",
                    out: str = "y_hat") -> DataFrame:
    """M6: ``p >= t`` as 0/1; ``threshold`` may be a number or a column."""
    t = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else (
        F.col(threshold) if isinstance(threshold, str) else threshold)
    return df.withColumn(out, (F.col(score) >= t).cast("int"))


def _rate(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, keys: Sequence[str] = (), label: str = "y",
                   pred: str = "y_hat") -> DataFrame:
    """M7: accuracy, precision, recall, F1 (zero division -> 0) in one aggregate."""
    y, h = F.col(label), F.col(pred)
    agg = df.groupBy(*keys).agg(
        F.count_if((y == 1) & (h == 1)).alias("tp"), F.count_if((y == 0) & (h == 1)).alias("fp"),
        F.count_if((y == 1) & (h == 0)).alias("fn"), F.count_if((y == 0) & (h == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return agg.select(*keys,
                      _rate(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                      _rate(tp, tp + fp).alias("precision"),
                      _rate(tp, tp + fn).alias("recall"),
                      _rate(2 * tp, 2 * tp + fp + fn).alias("f1"))


def group_rates(df: DataFrame, keys: Sequence[str] = (), label: str = "y", pred: str = "y_hat",
                sensitive: str = "s") -> DataFrame:
    """Per (keys, group): selection rate, TPR and FPR (undefined rates -> 0)."""
    y, h = F.col(label), F.col(pred)
    return df.groupBy(*keys, F.col(sensitive).alias("group")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(h.cast("double")).alias("selection_rate"),
        _rate(F.count_if((y == 1) & (h == 1)), F.count_if(y == 1)).alias("tpr"),
        _rate(F.count_if((y == 0) & (h == 1)), F.count_if(y == 0)).alias("fpr"),
        F.count_if(y == 1).alias("n_pos"), F.count_if(y == 0).alias("n_neg"))


def fairness(df: DataFrame, keys: Sequence[str] = (), label: str = "y", pred: str = "y_hat",
             sensitive: str = "s") -> DataFrame:
    """M8 + M9: demographic parity difference (max - min selection rate) and
    equalised odds difference max(dTPR, dFPR) across groups."""
    g = group_rates(df, keys, label, pred, sensitive)
    return g.groupBy(*keys).agg(
        (F.max("selection_rate") - F.min("selection_rate")).alias("dpd"),
        F.greatest(F.max("tpr") - F.min("tpr"), F.max("fpr") - F.min("fpr")).alias("eod"),
        F.count(F.lit(1)).alias("n_groups"))


def abs_rho(df: DataFrame, keys: Sequence[str] = (), score: str = "p", sensitive: str = "s",
            eps: float = EPS_RHO) -> DataFrame:
    """M3: |Pearson(p, s)| with population moments; 0 when sqrt(var p var s) <= eps."""
    agg = df.groupBy(*keys).agg(
        F.covar_pop(F.col(score), F.col(sensitive).cast("double")).alias("_c"),
        F.var_pop(F.col(score)).alias("_vp"),
        F.var_pop(F.col(sensitive).cast("double")).alias("_vs"))
    den = F.sqrt(F.col("_vp") * F.col("_vs"))
    return agg.select(*keys, F.when(den <= eps, F.lit(0.0)).otherwise(F.abs(F.col("_c") / den))
                      .alias("abs_rho"))


def fair_objective(df: DataFrame, lam: float | str, keys: Sequence[str] = (), score: str = "p",
                   label: str = "y", sensitive: str = "s", eps: float = 1e-8,
                   clip: float = 1e-7) -> DataFrame:
    """Weighted-free BCE + lambda * rho^2 with eps inside the square root,
    evaluated as a metric over the whole table."""
    p = F.least(F.greatest(F.col(score), F.lit(clip)), F.lit(1 - clip))
    y = F.col(label).cast("double")
    bce = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    lam_c = F.lit(float(lam)) if not isinstance(lam, str) else F.first(F.col(lam))
    agg = df.groupBy(*keys).agg(
        F.avg(bce).alias("bce"),
        F.covar_pop(F.col(score), F.col(sensitive).cast("double")).alias("_c"),
        F.var_pop(F.col(score)).alias("_vp"),
        F.var_pop(F.col(sensitive).cast("double")).alias("_vs"),
        lam_c.alias("lam"))
    rho = F.col("_c") / F.sqrt(F.col("_vp") * F.col("_vs") + F.lit(eps))
    return agg.select(*keys, "lam", "bce", rho.alias("rho"),
                      (F.col("bce") + F.col("lam") * rho * rho).alias("objective"))


def gap_objective(df: DataFrame, lam: float | str, keys: Sequence[str] = (), score: str = "p",
                  label: str = "y", sensitive: str = "s", clip: float = 1e-7) -> DataFrame:
    """M15, older form: BCE + lambda * |mean(p | s = 0) - mean(p | s = 1)|."""
    p = F.least(F.greatest(F.col(score), F.lit(clip)), F.lit(1 - clip))
    y, s = F.col(label).cast("double"), F.col(sensitive)
    lam_c = F.lit(float(lam)) if not isinstance(lam, str) else F.first(F.col(lam))
    agg = df.groupBy(*keys).agg(
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("bce"),
        F.abs(F.avg(F.when(s == 0, F.col(score))) - F.avg(F.when(s == 1, F.col(score)))).alias("gap"), lam_c.alias("lam"))
    return agg.select(*keys, "lam", "bce", "gap", (F.col("bce") + F.col("lam") * F.col("gap")).alias("objective"))


def mean_gap(df: DataFrame, keys: Sequence[str] = (), value: str = "p", sensitive: str = "s",
             group_a=0, group_b=1) -> DataFrame:
    """|mean(value | s = a) - mean(value | s = b)|."""
    s = F.col(sensitive)
    agg = df.groupBy(*keys).agg(
        F.avg(F.when(s == group_a, F.col(value).cast("double"))).alias("mean_a"),
        F.avg(F.when(s == group_b, F.col(value).cast("double"))).alias("mean_b"))
    return agg.select(*keys, "mean_a", "mean_b", F.abs(F.col("mean_a") - F.col("mean_b")).alias("gap"))


def evaluate_models(df: DataFrame, keys: Sequence[str] = ("model_id",),
                    thresholds: DataFrame | None = None, score: str = "p", label: str = "y",
                    sensitive: str = "s") -> DataFrame:
    """One evaluation row per model: AUC, AP, |rho|, threshold (given per
    model or chosen by Youden on the same rows), binary and fairness metrics.

    Every joined table has one row per model and is broadcast by hint: left to its estimates, which do not know
    how many models a row was exploded to, the planner may broadcast the scored rows instead."""
    keys = list(keys)
    # one row per (model, distinct score): the ranking metrics share its prefix sums
    cum = cut_lineage(cumulative(df, keys, score, label))
    auc, ap = _auc_of(cum, keys), _ap_of(cum, keys)
    rho = abs_rho(df, keys, score, sensitive)
    thr = cut_lineage((thresholds if thresholds is not None else _youden_of(cum, keys)).select(*keys, "threshold"))
    scored = apply_threshold(df.join(F.broadcast(thr), keys), "threshold", score)
    bm = binary_metrics(scored, keys, label)
    fm = fairness(scored, keys, label, "y_hat", sensitive).drop("n_groups")
    out = auc
    for t in (ap, rho, thr.select(*keys, "threshold"), bm, fm):
        out = out.join(F.broadcast(t), keys)
    return out


def model_deltas(metrics: DataFrame, base_id: str, fair_id: str, key: str = "model_id",
                 cols: Sequence[str] = ("auc", "ap", "accuracy", "recall", "f1", "abs_rho", "dpd", "eod")
                 ) -> DataFrame:
    """Base vs fair side by side, the delta and relative reduction per metric."""
    long = metrics.filter(F.col(key).isin(base_id, fair_id)).select(
        key, F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v"))
                                 for c in cols])).alias("m"))
    wide = long.groupBy(F.col("m.metric").alias("metric")).agg(
        F.max(F.when(F.col(key) == base_id, F.col("m.v"))).alias("base"),
        F.max(F.when(F.col(key) == fair_id, F.col("m.v"))).alias("fair"))
    return wide.select("metric", "base", "fair", (F.col("fair") - F.col("base")).alias("delta"),
                       F.try_divide(F.col("base") - F.col("fair"), F.col("base")).alias("relative_reduction"))
