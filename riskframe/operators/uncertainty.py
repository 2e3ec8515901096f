"""Error-based uncertainty.

The error model (a regressor of |p - y| trained on the validation rows) is
offered two ways: a binned regressor (mean absolute error of the validation
rows in the same score bin; one aggregate, SQL-expressible) and Spark ML's
gradient-boosted regressor in :mod:`riskframe.operators.learners`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ranked import exact_quantiles


class UncertaintyError(ValueError):
    pass


def error_target(df: DataFrame, score: str = "p", label: str = "y", out: str = "abs_error") -> DataFrame:
    """|p - y| as the error model's target (features keep p)."""
    return df.withColumn(out, F.abs(F.col(score) - F.col(label).cast("double")))


def score_bin(score: str = "p", n_bins: int = 20):
    """Equal-width score bin on [0, 1]; 1.0 falls in the last bin."""
    return F.least(F.floor(F.col(score) * n_bins), F.lit(n_bins - 1)).cast("int")


def fit_binned_error(train: DataFrame, score: str = "p", label: str = "y", n_bins: int = 20) -> DataFrame:
    """U2 (binned): mean absolute error per score bin on the fitting rows."""
    return (error_target(train, score, label)
            .groupBy(score_bin(score, n_bins).alias("_bin"))
            .agg(F.avg("abs_error").alias("_u"), F.count(F.lit(1)).alias("_n")))


def apply_binned_error(df: DataFrame, model: DataFrame, score: str = "p", n_bins: int = 20,
                       out: str = "uncertainty") -> DataFrame:
    """Uncertainty of each row = its bin's fitted error; a bin without fitting
    rows takes the mean error of all of them."""
    whole = model.agg((F.sum(F.col("_u") * F.col("_n")) / F.sum("_n")).alias("_all"))
    j = df.withColumn("_bin", score_bin(score, n_bins)).join(model, "_bin", "left").crossJoin(whole)
    return j.withColumn(out, F.coalesce("_u", "_all")).drop("_bin", "_u", "_n", "_all")


def clip_check(df: DataFrame, col: str = "uncertainty", digits: int = 8) -> DataFrame:
    """Clip to [0, 1] and report non-finite and distinct (rounded) counts;
    a single distinct value means a constant, unusable uncertainty."""
    x = F.col(col)
    clipped = F.when(x < 0, F.lit(0.0)).when(x > 1, F.lit(1.0)).otherwise(x)
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))).alias("n_non_finite"),
                  F.count_distinct(F.round(clipped, digits)).alias("n_distinct"),
                  F.min(clipped).alias("min_u"), F.max(clipped).alias("max_u"))


def assert_usable(check_row) -> None:
    if check_row["n_non_finite"] > 0:
        raise UncertaintyError("non-finite uncertainty values")
    if check_row["n_distinct"] <= 1:
        raise UncertaintyError("uncertainty is constant")


def prediction_table(df: DataFrame, *, id_col: str = "id", threshold: float, score: str = "p",
                     label: str = "y", sensitive: str = "s", uncertainty: str = "uncertainty",
                     null_count: str | None = None) -> DataFrame:
    """U4: the prediction row of every scored id."""
    cols = [F.col(id_col), F.col(label).alias("y_true"), F.col(score).alias("y_proba"),
            (F.col(score) >= F.lit(threshold)).cast("int").alias("y_pred"),
            F.col(sensitive).alias("sensitive"), F.lit(float(threshold)).alias("threshold"),
            F.col(uncertainty).alias("uncertainty")]
    if null_count:
        cols.append(F.col(null_count).alias("ext_null_count"))
    return df.select(*cols)


def summary_by(df: DataFrame, group: str, value: str = "uncertainty") -> DataFrame:
    """Count, mean, median, q1, q3 and IQR of a value per group (exact,
    distributed quantiles)."""
    basic = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
    q = exact_quantiles(df, [value], [0.25, 0.5, 0.75], keys=[group])
    qw = q.groupBy(group).agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"))
    return basic.join(qw, group, "left").withColumn("iqr", F.col("q3") - F.col("q1"))


def ensemble_variance(long: DataFrame, *, id_col: str = "id", score: str = "p") -> DataFrame:
    """U8: mean and population variance over passes / members per row."""
    return long.groupBy(id_col).agg(F.avg(score).alias("mean_p"), F.var_pop(score).alias("var_p"),
                                    F.count(F.lit(1)).alias("n_passes"))


def variance_by_class(var: DataFrame, label: str = "y", value: str = "var_p") -> DataFrame:
    """Mean and median variance per class."""
    s = summary_by(var, label, value)
    return s.select(label, "n", "mean", "median")


def class_variance_ratio(var: DataFrame, label: str = "y", value: str = "var_p") -> DataFrame:
    """Mean variance of class 1 over that of class 0."""
    m1, m0 = (F.avg(F.when(F.col(label) == c, F.col(value))) for c in (1, 0))
    return var.agg(m1.alias("mean_1"), m0.alias("mean_0")).select(
        "mean_0", "mean_1", F.try_divide("mean_1", "mean_0").alias("ratio"))


def variance_by_missing(var: DataFrame, null_count: str = "ext_null_count", value: str = "var_p",
                        max_missing: int = 3) -> DataFrame:
    """Mean variance per missing count 0..max (zero-filled keys) with a
    95 % interval 1.96 sd / sqrt(n)."""
    spark = var.sparkSession
    keys = spark.range(max_missing + 1).select(F.col("id").cast("int").alias(null_count))
    agg = var.groupBy(F.col(null_count).cast("int").alias(null_count)).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    return keys.join(agg, null_count, "left").select(
        null_count, F.coalesce("n", F.lit(0)).alias("n"), "mean",
        (F.lit(1.96) * F.col("sd") / F.sqrt("n")).alias("ci95"))


def histogram(df: DataFrame, value: str, groups: Sequence[str], n_bins: int = 30,
              lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Equal-width bin counts by group (figure data only)."""
    b = F.least(F.greatest(F.floor((F.col(value) - lo) / (hi - lo) * n_bins), F.lit(0)),
                F.lit(n_bins - 1)).cast("int")
    return df.groupBy(*groups, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
