"""Sweep selection, comparisons and OOF summaries.

Inputs here are small: one row per configuration / fold / feature.  Windows
without a partition key are used only on such tables, whose size is fixed by
the parameter grid, never by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.relational import source_of

AUC_TOLERANCE = 0.02
# Status of a sweep row, as other tools read it.
BASE, COLLAPSED, FAIR = "base_cuadratica", "colapsado", "fair_cuadratico"
# Collapse limits of a fair model (AUC, threshold, score std).
COLLAPSE_AUC, COLLAPSE_THRESHOLD, COLLAPSE_STD = 0.55, 0.99, 1e-4



def _all():
    """Window over a whole small table (one row per configuration)."""
    return Window.partitionBy()


class SweepError(ValueError):
    pass


def validate_grid(values: Sequence[float]) -> None:
    if 0.0 not in [float(v) for v in values]:
        raise SweepError("the grid must contain 0.0 (the baseline)")


def _nan(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def pareto_select(sweep: DataFrame, *, lam: str = "lam", auc: str = "auc", rho: str = "abs_rho",
                  tolerance: float = AUC_TOLERANCE, status: str | None = None) -> DataFrame:
    """Baseline (lambda 0) always kept; among lambda != 0 rows with
    AUC >= base - tolerance pick the smallest |rho|, then the largest AUC; when
    none is viable all lambda != 0 rows compete.  With ``status`` collapsed rows
    compete only if all have collapsed, and a missing AUC is not viable (W2);
    without it a missing AUC, of the row or of the baseline, counts as viable
    (W1).  A sweep without a baseline row fails when it is run."""
    base_auc = F.max(F.when(F.col(lam) == 0, F.col(auc))).over(_all())
    nonbase = F.col(lam) != 0
    if status is None:
        ok = nonbase
        viable = ok & (_nan(base_auc) | _nan(F.col(auc)) | (F.col(auc) >= base_auc - tolerance))
    else:
        stands = nonbase & (F.col(status) != COLLAPSED)
        ok = nonbase & (stands | (F.max(stands.cast("int")).over(_all()) == 0))
        viable = ok & ~_nan(F.col(auc)) & (F.col(auc) >= base_auc - tolerance)
    marked = sweep.withColumn("viable", F.coalesce(viable, F.lit(False)))
    any_viable = F.max(F.col("viable").cast("int")).over(_all()) == 1
    cand = F.when(any_viable, F.col("viable")).otherwise(F.coalesce(ok, F.lit(False)))
    marked = marked.withColumn("_cand", cand)
    order = Window.partitionBy("_cand").orderBy(F.col(rho).asc_nulls_last(), F.col(auc).desc_nulls_last(),
                                                F.col(lam).asc())
    marked = marked.withColumn("_rk", F.row_number().over(order))
    has_base = F.max((F.col(lam) == 0).cast("int")).over(_all()) == 1
    selected = F.when(has_base, (F.col(lam) == 0) | (F.col("_cand") & (F.col("_rk") == 1))).otherwise(
        F.raise_error(F.lit("baseline row (lambda = 0) is mandatory")).cast("boolean"))
    return marked.withColumn("selected", selected).drop("_cand", "_rk")


def collapse_status(sweep: DataFrame, *, lam: str = "lam", auc: str = "auc",
                    threshold: str = "threshold", score_std: str = "score_std") -> DataFrame:
    """Baseline / collapsed / fair classification of every sweep row."""
    collapsed = ((F.col(auc) <= COLLAPSE_AUC) | (F.col(threshold) >= COLLAPSE_THRESHOLD)
                 | (F.col(score_std) <= COLLAPSE_STD))
    return sweep.withColumn("status", F.when(F.col(lam) == 0, BASE)
                            .when(F.coalesce(collapsed, F.lit(False)), COLLAPSED).otherwise(FAIR))


def comparison_table(rows: DataFrame, *, reference_filter: Column, auc: str = "auc",
                     rho: str = "abs_rho", dpd: str = "dpd") -> DataFrame:
    """Every row beside the reference row: AUC loss, and by how much
    |rho| and the parity difference are below the reference's."""
    def ref(c: str) -> Column:
        return F.max(F.when(reference_filter, F.col(c))).over(_all())

    return rows.select("*", (ref(auc) - F.col(auc)).alias("auc_loss"),
                       (ref(rho) - F.col(rho)).alias("rho_improvement"),
                       (ref(dpd) - F.col(dpd)).alias("dpd_improvement"))


def sweep_over_seeds(per_seed: DataFrame, *, lam: str = "lam", auc: str = "auc",
                     gap: str = "gap") -> DataFrame:
    """Mean and population std per lambda across seeds; AUC change and gap
    reduction (%) against lambda 0."""
    agg = per_seed.groupBy(lam).agg(
        F.avg(auc).alias("auc_mean"), F.stddev_pop(auc).alias("auc_std"),
        F.avg(gap).alias("gap_mean"), F.stddev_pop(gap).alias("gap_std"),
        F.count(F.lit(1)).alias("n_seeds"))
    base_auc = F.max(F.when(F.col(lam) == 0, F.col("auc_mean"))).over(_all())
    base_gap = F.max(F.when(F.col(lam) == 0, F.col("gap_mean"))).over(_all())
    return agg.select("*", (F.col("auc_mean") - base_auc).alias("delta_auc"),
                      (F.try_divide(base_gap - F.col("gap_mean"), base_gap) * 100).alias("gap_reduction_pct"))


def model_ladder(rows: DataFrame, auc: str = "auc") -> DataFrame:
    """Ladder table with a best-AUC marker."""
    return rows.withColumn("is_best", F.col(auc) == F.max(auc).over(_all()))


def fold_summary(fold_metrics: DataFrame, keys: Sequence[str] = (), auc: str = "auc") -> DataFrame:
    """Mean and population std of fold AUCs."""
    return fold_metrics.groupBy(*keys).agg(F.avg(auc).alias("fold_auc_mean"),
                                           F.stddev_pop(auc).alias("fold_auc_std"),
                                           F.count(F.lit(1)).alias("n_folds"))


def oof_average(oof: DataFrame, *, id_col: str = "id", score: str = "p",
                keys: Sequence[str] = ()) -> DataFrame:
    """Average out-of-fold score per row over seeds."""
    return oof.groupBy(*keys, id_col).agg(F.avg(score).alias(score), F.first("y").alias("y"))


def importance_by_source(importance: DataFrame, *, feature: str = "feature",
                         value: str = "importance") -> DataFrame:
    """Total importance per source table, largest first."""
    return (importance.groupBy(source_of(F.col(feature)).alias("source"))
            .agg(F.sum(value).alias("importance"), F.count(F.lit(1)).alias("n_features")))


def top_n(df: DataFrame, n: int, order: str, desc: bool = True, tiebreak: str | None = None) -> DataFrame:
    """Top-n rows by a column (the limit is the feature)."""
    o = [F.col(order).desc() if desc else F.col(order).asc()]
    if tiebreak:
        o.append(F.col(tiebreak).asc())
    return df.orderBy(*o).limit(n)


def ablation_gain(small: DataFrame, large: DataFrame, key: str = "model", auc: str = "auc") -> DataFrame:
    """AUC gain from the compact to the extended feature set per model, and
    the best model of the extended set."""
    j = small.select(key, F.col(auc).alias("auc_small")).join(
        large.select(key, F.col(auc).alias("auc_large")), key)
    return j.select("*", (F.col("auc_large") - F.col("auc_small")).alias("gain"),
                    (F.col("auc_large") == F.max("auc_large").over(_all())).alias("best_large"))


def experiment_table(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of heterogeneous experiment rows (missing columns -> NULL)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
