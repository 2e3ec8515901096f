"""Distributed prefix sums over a score ordering (shared by M1, M2, M4, M5, E10).

An unpartitioned ``Window.orderBy(score)`` pulls every row into one task.
Instead:

1. rows are combined per ``(keys, score)`` into positive / negative counts
   (map-side partial aggregation, so a score value held by a third of all rows
   is a single row after this step);
2. each key's distinct scores are cut into ``n_buckets`` ranges by approximate
   splitters (any split is correct; the approximation only balances work); a
   range that holds more than ``BUCKET_ROWS`` distinct scores is counted and cut
   once more, so buckets grow in number with the data and not in size;
3. per-bucket totals (a table of keys x buckets) give each bucket the counts of
   everything above it through a window over that small table;
4. within a bucket a running window adds the rows above inside the bucket.

The result is exact: ``tp_above`` / ``fp_above`` = positives / negatives with a
strictly larger score under the same key, plus the key totals ``P`` and ``N``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Distinct scores of a range from which on it is cut into ranges of its own.
BUCKET_ROWS = 200_000


def score_counts(df: DataFrame, keys: Sequence[str], score: str = "p", label: str = "y",
                 weight: str | Column | None = None) -> DataFrame:
    """``(keys, score, pos, neg)``: label counts (or weight sums) per distinct score."""
    y = F.col(label)
    if weight is None:
        pos, neg = F.count_if(y == 1), F.count_if(y == 0)
    else:
        w = F.col(weight) if isinstance(weight, str) else weight
        pos = F.sum(F.when(y == 1, w).otherwise(F.lit(0)))
        neg = F.sum(F.when(y == 0, w).otherwise(F.lit(0)))
    return df.groupBy(*keys, F.col(score).alias("score")).agg(pos.alias("pos"), neg.alias("neg"))


def _ranges(counts: DataFrame, keys: list[str], n_buckets: int, accuracy: int, bucket_rows: int,
            grid: bool) -> DataFrame:
    """``counts`` with ``_bucket``, which rises with the score within ``keys``."""
    fracs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = F.percentile_approx("score", fracs, accuracy).alias("_splits")
    small = F.broadcast if grid else (lambda t: t)

    def place(splits: str) -> Column:
        return F.when(F.col(splits).isNull(), 0).otherwise(F.size(F.filter(splits, lambda s: s < F.col("score"))))

    first = counts.groupBy(*keys).agg(cuts)
    coarse = counts.join(small(first), keys).withColumn("_cell", place("_splits")).drop("_splits")
    large = (coarse.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_rows"), cuts)
             .where(F.col("_rows") > bucket_rows).drop("_rows"))
    return (coarse.join(small(large), [*keys, "_cell"], "left")
            .withColumn("_bucket", F.col("_cell") * n_buckets + place("_splits")).drop("_splits", "_cell"))


def with_cumulative(counts: DataFrame, keys: Sequence[str], n_buckets: int = 64,
                    accuracy: int = 10_000, bucket_rows: int = BUCKET_ROWS, grid: bool = True) -> DataFrame:
    """Add ``tp_above``, ``fp_above`` (strictly higher score) and totals ``P``, ``N``.

    ``grid``: the keys come from parameters (models, columns), so their splitters, one row a key, are
    broadcast.  Keys that come from the data grow with it: pass False, and they are joined by key.
    """
    keys = list(keys)
    drop_all = not keys
    if drop_all:  # a single global ordering: use one constant key
        counts = counts.withColumn("_all", F.lit(0))
        keys, grid = ["_all"], True
    if n_buckets <= 1:
        # many keys (e.g. bootstrap replicates): the key alone spreads the work
        b = counts.withColumn("_bucket", F.lit(0))
    else:
        b = _ranges(counts, keys, n_buckets, accuracy, bucket_rows, grid)
    totals = b.groupBy(*keys, "_bucket").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    wk = Window.partitionBy(*keys)
    above = wk.orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_bucket",
        F.coalesce(F.sum("_bp").over(above), F.lit(0)).alias("_op"),
        F.coalesce(F.sum("_bn").over(above), F.lit(0)).alias("_on"),
        F.sum("_bp").over(wk).alias("P"),
        F.sum("_bn").over(wk).alias("N"),
    )
    inner = (Window.partitionBy(*keys, "_bucket").orderBy(F.col("score").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    local = b.select("*",
                     F.coalesce(F.sum("pos").over(inner), F.lit(0)).alias("_lp"),
                     F.coalesce(F.sum("neg").over(inner), F.lit(0)).alias("_ln"))
    # the window has partitioned the scores by these keys already: only the offsets move, and no side is broadcast
    j = local.join(offsets.hint("merge"), [*keys, "_bucket"])
    out_keys = [] if drop_all else keys
    return j.select(*out_keys, "score", "pos", "neg",
                    (F.col("_op") + F.col("_lp")).alias("tp_above"),
                    (F.col("_on") + F.col("_ln")).alias("fp_above"), "P", "N")


def cumulative(df: DataFrame, keys: Sequence[str] = (), score: str = "p", label: str = "y",
               weight: str | Column | None = None, n_buckets: int = 64) -> DataFrame:
    return with_cumulative(score_counts(df, keys, score, label, weight), keys, n_buckets)


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank",
                  n_buckets: int = 64) -> DataFrame:
    """Average (tie-aware, 1-based) rank of ``value`` within ``keys``, distributed.
    Rows with a missing value get a missing rank."""
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, F.col(value).alias("score"))
              .agg(F.count(F.lit(1)).alias("pos")).withColumn("neg", F.lit(0)))
    # rank ascending = rows strictly below + (ties + 1) / 2; flip the sign to reuse "above"
    flipped = counts.withColumn("score", -F.col("score"))
    cum = with_cumulative(flipped, keys, n_buckets, grid=not keys)
    ranks = cum.select(*keys, (-F.col("score")).alias(value),
                       (F.col("tp_above") + (F.col("pos") + 1) / 2.0).alias(out))
    return df.join(ranks, [*keys, value], "left")


def exact_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float],
                    keys: Sequence[str] = (), n_buckets: int = 64) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy / ``quantile_cont`` rule) of
    many columns at once, without holding a column's values in one task.

    Values are unpivoted to ``(keys, column, value)``, counted per distinct
    value (map-side combined), and the rows strictly below each value come from
    the distributed prefix sums.  Output: ``(keys, column, q, value)``.
    """
    keys = list(keys)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                      for c in cols])
    long = df.select(*keys, F.inline(pairs)).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = (long.groupBy(*keys, "column", (-F.col("v")).alias("score"))
              .agg(F.count(F.lit(1)).alias("pos")).withColumn("neg", F.lit(0)))
    cum = with_cumulative(counts, [*keys, "column"], n_buckets, grid=not keys)
    # tp_above on the negated value = rows strictly below v; P = non-missing count
    below, c, n = F.col("tp_above"), F.col("pos"), F.col("P")
    v = -F.col("score")
    out = []
    for q in qs:
        pos = F.lit(float(q)) * (n - 1)
        k1, k2 = F.floor(pos), F.ceil(pos)
        frac = pos - k1
        out.append(F.struct(
            F.lit(float(q)).alias("q"),
            F.max(F.when((below <= k1) & (k1 < below + c), v)).alias("v1"),
            F.max(F.when((below <= k2) & (k2 < below + c), v)).alias("v2"),
            F.first(frac).alias("frac")))
    agg = cum.groupBy(*keys, "column").agg(F.array(*out).alias("_qs"))
    res = agg.select(*keys, "column", F.inline("_qs"))
    return res.select(*keys, "column", "q",
                      (F.col("v1") + (F.col("v2") - F.col("v1")) * F.col("frac")).alias("value"))
