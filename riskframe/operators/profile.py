"""Profiles / EDA tables (E1-E19): data behind the reference's figures.

Wide per-column statistics are computed in long form: columns are unpivoted
to ``(feature, value)`` rows and grouped by feature, so the work spreads over
features and rows instead of one very wide aggregate in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.ranked import exact_quantiles, with_cumulative


def long_form(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
              name: str = "feature", value: str = "value") -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(*keep, F.inline(pairs))


def headline_rates(df: DataFrame, target: str = "TARGET", sensitive: str = "SENSITIVE") -> DataFrame:
    """Row count, target rate and sensitive share in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.avg(F.col(target).cast("double")).alias("target_rate"),
                  F.avg(F.col(sensitive).cast("double")).alias("sensitive_rate"),
                  F.count_if(F.col(target) == 1).alias("n_positive"))


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null rate (%) per column with its band (0 / <=20 / <=60 / >60)."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_z{i}").alias("n_null"))
                      for i, c in enumerate(cols)])
    long = one.select("_n", F.inline(pairs))
    rate = F.col("n_null") * 100.0 / F.col("_n")
    return long.select("column", "n_null", rate.alias("null_pct"),
                       F.when(F.col("n_null") == 0, "0").when(rate <= 20, "<=20")
                       .when(rate <= 60, "<=60").otherwise(">60").alias("band"))


def rate_by_category(df: DataFrame, cat: str, target: str = "TARGET") -> DataFrame:
    """Target rate and count per category."""
    return df.groupBy(cat).agg(F.count(F.lit(1)).alias("n"),
                               F.avg(F.col(target).cast("double")).alias("rate"))


def category_strength(df: DataFrame, cats: Sequence[str], target: str = "TARGET") -> DataFrame:
    """Per categorical column, its cardinality and the sample std of the
    category target rates (one (column, value) aggregate for all columns)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in cats])
    long = df.select(F.col(target).cast("double").alias("_y"), F.inline(pairs))
    per = long.groupBy("feature", "v").agg(F.avg("_y").alias("rate"))
    return per.groupBy("feature").agg(F.count(F.lit(1)).alias("cardinality"),
                                     F.stddev_samp("rate").alias("rate_std"))


def quantile_edges(df: DataFrame, col: str, n_bins: int = 10) -> list[float]:
    """E4 edges: exact quantiles at k / n_bins, duplicates dropped (driver list
    of at most n_bins + 1 numbers)."""
    qs = [i / n_bins for i in range(n_bins + 1)]
    rows = exact_quantiles(df, [col], qs).orderBy("q").collect()
    edges: list[float] = []
    for r in rows:
        if r["value"] is not None and (not edges or r["value"] != edges[-1]):
            edges.append(r["value"])
    return edges


def decile_bin(col: str, edges: Sequence[float]) -> Column:
    """Right-closed bins (e[i], e[i+1]]; the first bin also holds the minimum."""
    x = F.col(col)
    e = None
    for i in range(len(edges) - 1):
        cond = (x <= F.lit(edges[i + 1])) if i == 0 else ((x > F.lit(edges[i])) & (x <= F.lit(edges[i + 1])))
        e = F.when(cond, F.lit(i)) if e is None else e.when(cond, F.lit(i))
    return e


def rate_by_decile(df: DataFrame, col: str, target: str = "TARGET", n_bins: int = 10) -> DataFrame:
    """Target rate, count, score range and standard error per quantile bin."""
    edges = quantile_edges(df, col, n_bins)
    y = F.col(target).cast("double")
    return (df.filter(F.col(col).isNotNull()).groupBy(decile_bin(col, edges).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("rate"),
                 F.min(col).alias("score_min"), F.max(col).alias("score_max"),
                 (F.stddev_samp(y) / F.sqrt(F.count(F.lit(1)))).alias("se")))


def winsor_long(df: DataFrame, cols: Sequence[str], q: float = 0.99, keep: Sequence[str] = ()) -> DataFrame:
    """Cap each column at its exact q-quantile, then unpivot to long form."""
    caps = {r["column"]: r["value"] for r in exact_quantiles(df, cols, [q]).collect()}
    capped = df.select(*keep, *[F.when(F.col(c) > F.lit(caps[c]), F.lit(caps[c])).otherwise(F.col(c)).alias(c)
                                for c in cols])
    return long_form(capped, cols, keep).filter(F.col("value").isNotNull())


def box_stats(df: DataFrame, cols: Sequence[str], group: str) -> DataFrame:
    """Count, mean, std, min, quartiles, max per (feature, group), exact."""
    long = long_form(df, cols, [group]).filter(F.col("value").isNotNull())
    basic = long.groupBy("feature", group).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, ["value"], [0.25, 0.5, 0.75], keys=["feature", group])
    qw = q.groupBy("feature", group).agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"))
    return basic.join(qw, ["feature", group], "left")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max per column."""
    return box_stats(df.withColumn("_all", F.lit(0)), cols, "_all").drop("_all")


def last_and_best(df: DataFrame, run: str, order: Sequence[str], metric: str) -> DataFrame:
    """Per run the number of rows, the metric of the last row in ``order``,
    and the row number (1-based) and value of the best one (ties: the first).

    Partial aggregation only: a long run is never sorted in one task.
    """
    pos = F.struct(*order)
    rows = df.where(F.col(metric).isNotNull())
    best = rows.groupBy(run).agg(
        F.count(F.lit(1)).alias("n"), F.max_by(metric, pos).alias("last"), F.max(metric).alias("best"))
    at = rows.join(best.select(run, "best"), run).where(F.col(metric) == F.col("best")).groupBy(run).agg(F.min(pos).alias("_at"))
    step = rows.join(at, run).groupBy(run).agg(F.count_if(pos <= F.col("_at")).alias("best_step"))
    return best.join(step, run)


def rate_by_nulls(df: DataFrame, null_count: str = "EXT_NULL_COUNT", target: str = "TARGET") -> DataFrame:
    """Target rate, volume and share of rows per null count."""
    agg = df.groupBy(null_count).agg(F.count(F.lit(1)).alias("n"),
                                     F.avg(F.col(target).cast("double")).alias("rate"))
    # one row per distinct null count: a window over a handful of rows
    return agg.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def _pearson(x: Column, y: Column) -> Column:
    """Pearson from population moments with a zero-variance guard (never raises)."""
    den = F.sqrt(F.var_pop(x) * F.var_pop(y))
    return F.when(den > 0, F.covar_pop(x, y) / den).otherwise(F.lit(0.0))


def pearson_target(df: DataFrame, cols: Sequence[str], target: str = "TARGET") -> DataFrame:
    """Pearson of every column with the target on pairwise non-null rows."""
    long = long_form(df, cols, [F.col(target).cast("double").alias("_y")]).filter(
        F.col("value").isNotNull() & F.col("_y").isNotNull())
    return long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"),
                                       _pearson(F.col("value"), F.col("_y")).alias("pearson"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise Pearson matrix in long form (a <= b in the order of ``cols``), each pair over the rows
    that have both values; NaN counts as missing, and a pair without spread has 0.

    Every task adds up four products of the masked, shifted values (counts, sums, squares, cross
    products), so a row costs no more rows; the sums of a column meet in two steps.
    """
    cols, d = list(cols), len(cols)
    num = [F.col(c).cast("double") for c in cols]
    num = [F.when(~F.isnan(x), x) for x in num]
    # any shift is right; the mean keeps the products from cancelling
    mean = df.agg(*(F.avg(x).alias(f"m{i}") for i, x in enumerate(num))).first()
    shift = np.array([0.0 if m is None else m for m in mean])

    def products(batches):
        n, sx, sxx, sxy = (np.zeros((d, d)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(d)]).astype(float)
            have = ~np.isnan(x)
            x = np.where(have, x - shift, 0.0)
            mask = have.astype(float)
            n += mask.T @ mask
            sx += x.T @ mask
            sxx += (x * x).T @ mask
            sxy += x.T @ x
        # row i: its sums over the rows that have j too, and those of j over the rows that have i
        rows = np.stack((n, sx, sx.T, sxx, sxx.T, sxy), axis=1)
        salt = TaskContext.get().partitionId() % 32
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(np.arange(d, dtype=np.int32)), "salt": pa.array(np.full(d, salt, np.int32)),
            "sums": pa.array([row.tobytes() for row in rows], pa.binary())})

    def total(part):
        out = np.zeros(6 * d)
        for sums in part["sums"]:
            out += np.frombuffer(sums)
        return out

    def add(part):
        return pd.DataFrame({"i": part["i"].iloc[:1], "sums": [total(part).tobytes()]})

    def pearson(part):
        i = int(part["i"].iloc[0])
        n, sx, sy, sxx, syy, sxy = total(part).reshape(6, d)[:, i:]
        with np.errstate(all="ignore"):
            vx, vy = sxx / n - (sx / n) ** 2, syy / n - (sy / n) ** 2
            # what rounding leaves of a constant is no spread
            spread = (vx > 1e-14 * sxx / n) & (vy > 1e-14 * syy / n)
            r = np.where(spread, (sxy / n - sx / n * sy / n) / np.sqrt(vx * vy), 0.0)
        return pd.DataFrame({"a": cols[i], "b": cols[i:], "pearson": r})[n > 0]

    sums = df.select(*(x.alias(f"x{i}") for i, x in enumerate(num))).mapInArrow(products, "i int, salt int, sums binary")
    sums = sums.groupBy("i", "salt").applyInPandas(add, "i int, sums binary")
    return sums.groupBy("i").applyInPandas(pearson, "a string, b string, pearson double")


def spearman_target(df: DataFrame, cols: Sequence[str], target: str = "TARGET",
                    id_col: str = "SK_ID_CURR") -> DataFrame:
    """Spearman = Pearson of average ranks on pairwise-complete rows, with
    the Pearson value and the gap beside it, for a 0/1 target.

    Rows are reduced to (feature, value) with their counts of either class; the
    ranks of a value come from prefix sums over these counts and the target's
    two ranks are constants of the feature, so nothing is joined back to rows.
    """
    y = F.col("_y")
    counts = (long_form(df, cols, [F.col(target).cast("double").alias("_y")])
              .where(F.col("value").isNotNull() & y.isNotNull())
              .groupBy("feature", (-F.col("value")).alias("score"))
              .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))
    cum = with_cumulative(counts, ["feature"])
    c, n1 = F.col("pos") + F.col("neg"), F.col("P")
    v = -F.col("score")
    rank = F.col("tp_above") + F.col("fp_above") + (c + 1) / 2.0

    def moments(x: Column) -> list[Column]:
        return [F.sum(c * x), F.sum(c * x * x), F.sum(F.col("pos") * x)]

    agg = cum.groupBy("feature").agg(
        F.sum(c).cast("double").alias("n"), F.first(n1).cast("double").alias("n1"),
        *(e.alias(f"{k}{i}") for k, x in (("r", rank), ("v", v)) for i, e in enumerate(moments(x))))

    def corr(k: str) -> Column:
        # Pearson with a 0/1 target equals that with its two ranks: both are the same line of y
        n, p = F.col("n"), F.col("n1")
        cov = F.col(f"{k}2") / n - F.col(f"{k}0") * p / (n * n)
        den = F.sqrt(F.greatest(F.col(f"{k}1") / n - (F.col(f"{k}0") / n) ** 2, F.lit(0.0)) * (p / n - (p / n) ** 2))
        return F.when(den > 0, cov / den).otherwise(F.lit(0.0))

    return agg.select("feature", corr("r").alias("spearman"), corr("v").alias("pearson"),
                      (corr("r") - corr("v")).alias("gap"))


def cohens_d(df: DataFrame, cols: Sequence[str], target: str = "TARGET", min_n: int = 1000,
             eps: float = 1e-9, null_pct: tuple[float, float] | None = (20.0, 70.0)) -> DataFrame:
    """|m1 - m0| / (sample std of all of them + eps) on rows with value and
    target.  Only columns with more than ``null_pct[0]`` and at most
    ``null_pct[1]`` % nulls (None: all columns), and ``min_n`` such rows."""
    long = long_form(df, cols, [F.col(target).alias("_y")])
    y, v = F.col("_y"), F.col("value")
    agg = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("n_values"), F.count(F.when(y.isNotNull(), v)).alias("n"),
        F.avg(F.when(y == 1, v)).alias("m1"), F.avg(F.when(y == 0, v)).alias("m0"),
        F.stddev_samp(F.when(y.isNotNull(), v)).alias("sd"))
    d = F.abs(F.col("m1") - F.col("m0")) / (F.col("sd") + F.lit(eps))
    out = agg.select("feature", "n", (100.0 * (F.col("n_rows") - F.col("n_values")) / F.col("n_rows")).alias("null_pct"),
                     d.alias("cohens_d")).where(F.col("n") >= min_n)
    return out if null_pct is None else out.where((F.col("null_pct") > null_pct[0]) & (F.col("null_pct") <= null_pct[1]))


def fast_abs_corr(df: DataFrame, cols: Sequence[str], target: str = "TARGET", min_n: int = 1000) -> DataFrame:
    """|sum (x - mean x)(y - mean of all y)| / (n sd(x) sd(all y)) over the
    finite values of each column; the target's moments are those of all rows.
    Columns with fewer values, or next to no spread, are left out."""
    y = F.col(target).cast("double")
    long = long_form(df, cols, [y.alias("_y")])
    fine = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf"))
    x, yy = F.when(fine, F.col("value")), F.col("_y")
    agg = long.groupBy("feature").agg(
        F.count(x).alias("n"), F.avg(x).alias("mx"), F.stddev_pop(x).alias("sx"), F.sum(x * yy).alias("sxy"),
        F.sum(F.when(fine, yy)).alias("sy"), F.avg(yy).alias("my"), F.stddev_pop(yy).alias("sdy"))
    # sum (x - mx)(y - my) = sum xy - mx * sum y, as the deviations of x add up to 0
    corr = F.abs(F.col("sxy") - F.col("mx") * F.col("sy")) / (F.col("n") * F.col("sx") * F.col("sdy"))
    return (agg.where((F.col("n") >= min_n) & (F.col("sx") * F.col("sdy") > 1e-9))
            .select("feature", corr.alias("abs_corr_target")))


def feature_pick(spearman: DataFrame, d: DataFrame, rho_min: float = 0.04, d_min: float = 0.10) -> DataFrame:
    """Keep features with |Spearman| > rho_min or d > d_min."""
    j = spearman.select("feature", "spearman").join(d.select("feature", "cohens_d"), "feature", "full_outer")
    return j.filter((F.abs(F.col("spearman")) > rho_min) | (F.col("cohens_d") > d_min))


def group_share(df: DataFrame, group: str, sub: str) -> DataFrame:
    """Count per (group, sub) and its share within the group."""
    agg = df.groupBy(group, sub).agg(F.count(F.lit(1)).alias("n"))
    return agg.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(group)))


def crosstab_rate(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Row-normalised crosstab with explicit pivot values."""
    piv = df.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1)))
    total = sum((F.coalesce(F.col(str(v)), F.lit(0)) for v in values), F.lit(0))
    return piv.select(row, *[(F.coalesce(F.col(str(v)), F.lit(0)) / total).alias(f"share_{v}") for v in values])


def grid_rate(df: DataFrame, x: str, y: str, target: str, n_bins: int, x_range: tuple, y_range: tuple) -> DataFrame:
    """Square 2-D bins with count and mean target (hexbin data, re-aimed)."""
    def b(c: str, lo: float, hi: float) -> Column:
        return F.least(F.greatest(F.floor((F.col(c) - lo) / (hi - lo) * n_bins), F.lit(0)),
                       F.lit(n_bins - 1)).cast("int")
    return (df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(b(x, *x_range).alias("bx"), b(y, *y_range).alias("by"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("rate")))


def histogram_by_class(df: DataFrame, col: str, target: str, n_bins: int = 80, log1p: bool = False) -> DataFrame:
    """Equal-width bins from the column's min/max (one small aggregate),
    counted per class."""
    x = F.log1p(F.col(col)) if log1p else F.col(col)
    base = df.select(x.alias("_x"), F.col(target).alias("cls")).filter(F.col("_x").isNotNull())
    mm = base.agg(F.min("_x"), F.max("_x")).first()
    lo, hi = float(mm[0]), float(mm[1])
    width = (hi - lo) or 1.0
    b = F.least(F.floor((F.col("_x") - lo) / width * n_bins), F.lit(n_bins - 1)).cast("int")
    return base.groupBy("cls", b.alias("bin")).agg(F.count(F.lit(1)).alias("n")) \
               .withColumn("bin_lo", F.lit(lo) + F.col("bin") * (width / n_bins))


def hexagon_rate(df: DataFrame, x: str, y: str, target: str, gridsize: int = 40, fill: float | None = 0.0) -> DataFrame:
    """Hexagonal bins with centre, count and mean target.

    Hexagons are the cells of two rectangular lattices, the second one shifted by half a step: lattice 1 has its
    points on whole steps, lattice 2 on halves.  A row belongs to the nearer point (a height counts
    three times as a width, squared); a tie goes to lattice 2, halfway rounding up.  ``gridsize`` hexagons are
    side by side and gridsize / sqrt(3) on top of each other between the least and the largest value.
    Nulls take ``fill``, or are left out if it is None.
    """
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(fill).cast("double"))
    rows = df.select(value(x).alias("hx"), value(y).alias("hy"), F.col(target).cast("double").alias("t")).where(
        F.col("hx").isNotNull() & F.col("hy").isNotNull())
    lo_x, hi_x, lo_y, hi_y = rows.agg(F.min("hx"), F.max("hx"), F.min("hy"), F.max("hy")).first()
    if lo_x is None:
        lo_x, hi_x, lo_y, hi_y = 0.0, 1.0, 0.0, 1.0
    sx = (hi_x - lo_x) / gridsize or 1.0
    sy = (hi_y - lo_y) / int(gridsize / 3 ** 0.5) or 1.0
    u, v = (F.col("hx") - F.lit(lo_x)) / F.lit(sx), (F.col("hy") - F.lit(lo_y)) / F.lit(sy)
    rows = rows.select("t", u.alias("u"), v.alias("v")).select(
        "t", "u", "v", F.floor(F.col("u") + 0.5).alias("i1"), F.floor(F.col("v") + 0.5).alias("j1"),
        F.floor("u").alias("i2"), F.floor("v").alias("j2"))
    d1 = F.pow(F.col("u") - F.col("i1"), 2) + 3 * F.pow(F.col("v") - F.col("j1"), 2)
    d2 = F.pow(F.col("u") - F.col("i2") - 0.5, 2) + 3 * F.pow(F.col("v") - F.col("j2") - 0.5, 2)
    first = d1 < d2
    cell = rows.select("t", F.when(first, 1).otherwise(2).alias("lattice"),
                       F.when(first, F.col("i1")).otherwise(F.col("i2")).alias("ix"),
                       F.when(first, F.col("j1")).otherwise(F.col("j2")).alias("iy"))
    half = F.when(F.col("lattice") == 2, 0.5).otherwise(0.0)
    return (cell.groupBy("lattice", "ix", "iy").agg(F.count(F.lit(1)).alias("n"), F.avg("t").alias("rate"))
            .withColumn("centre_x", F.lit(lo_x) + (F.col("ix") + half) * sx)
            .withColumn("centre_y", F.lit(lo_y) + (F.col("iy") + half) * sy))


def density_by_class(df: DataFrame, col: str, target: str, points: int = 200, cut: float = 4.0) -> DataFrame:
    """Gaussian kernel density of ``col`` on a grid, each class by itself (its integral is 1).

    Bandwidth: sample deviation * n^(-1/5).  The grid has ``points`` points from ``cut`` bandwidths below the least
    value to as many above the largest one.  A value gives its weight to the two grid points beside it in proportion to
    the distance, so the rows are summed in one pass and only grid weights meet in the convolution.  Null values are left
    out; a class without spread (one value, one row) has no density.
    """
    rows = df.select(F.col(target).alias("cls"), F.col(col).cast("double").alias("v")).where(
        F.col("v").isNotNull() & F.col("cls").isNotNull())
    # one row a class
    shape = (rows.groupBy("cls").agg(F.count(F.lit(1)).alias("size"), F.stddev_samp("v").alias("sd"), F.min("v").alias("low"), F.max("v").alias("high"))
             .where("sd > 0").withColumn("bw", F.col("sd") * F.pow(F.col("size").cast("double"), F.lit(-0.2)))
             .withColumn("lo", F.col("low") - cut * F.col("bw"))
             .withColumn("step", (F.col("high") + cut * F.col("bw") - F.col("lo")) / (points - 1))
             .select("cls", "size", "bw", "lo", "step"))
    at = rows.join(shape, "cls").withColumn("pos", (F.col("v") - F.col("lo")) / F.col("step")).withColumn("i", F.floor("pos"))
    halves = at.groupBy("cls", "i").agg(F.sum(F.col("i") + 1 - F.col("pos")).alias("here"), F.sum(F.col("pos") - F.col("i")).alias("next"))
    weight = halves.select("cls", F.inline(F.array(F.struct(F.col("i").alias("i"), F.col("here").alias("w")),
                                                   F.struct((F.col("i") + 1).alias("i"), F.col("next").alias("w")))))
    weight = weight.groupBy("cls", "i").agg(F.sum("w").alias("w"))
    grid = shape.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    # points x points rows a class
    z = (F.col("point") - F.col("i")) * F.col("step") / F.col("bw")
    kernel = F.col("w") * F.exp(-0.5 * z * z)
    return (grid.join(weight, "cls").groupBy("cls", "point", "size", "bw", "lo", "step").agg(F.sum(kernel).alias("s"))
            .select("cls", "point", (F.col("lo") + F.col("point") * F.col("step")).alias("x"),
                    (F.col("s") / (F.col("size") * F.col("bw") * F.lit((2 * math.pi) ** 0.5))).alias("density"), "step"))
