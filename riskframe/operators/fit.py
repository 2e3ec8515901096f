"""Fit-on-train preprocessing.

``fit_*`` runs one aggregate over the training rows only and returns a few
numbers per column; ``apply_*`` is a single projection over every split.
Quantiles are exact and distributed (:func:`riskframe.operators.ranked.exact_quantiles`).
One-hot columns come from declared categories; without a declaration the
category is a code in a sparse vector, whose width is not a number of columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.encode import apply_label_codes, fit_label_codes
from riskframe.operators.ranked import exact_quantiles, with_cumulative
from riskframe.session import cut_lineage


class FitError(ValueError):
    pass


def _train(df: DataFrame, split: str | None, train_value: str = "train") -> DataFrame:
    return df if split is None else df.filter(F.col(split) == train_value)


# ------------------------------------------------------------------ F1 / F2 / F3

def fit_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float],
                  split: str | None = "split") -> dict[str, dict[float, float]]:
    rows = exact_quantiles(_train(df, split), cols, qs).collect()  # cols x qs rows
    out: dict[str, dict[float, float]] = {c: {} for c in cols}
    for r in rows:
        out[r["column"]][r["q"]] = r["value"]
    return out


def fit_medians(df: DataFrame, cols: Sequence[str], split: str | None = "split") -> dict[str, float]:
    """exact medians on the training rows."""
    q = fit_quantiles(df, cols, [0.5], split)
    return {c: q[c].get(0.5) for c in cols}


def apply_impute(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()
                           if v is not None})


@dataclass
class RobustParams:
    median: dict[str, float]
    iqr: dict[str, float]


def fit_robust(df: DataFrame, cols: Sequence[str], split: str | None = "split",
               impute: Mapping[str, float] | None = None) -> RobustParams:
    """centre = median, scale = q75 - q25 (0 -> 1), fitted on the imputed
    training rows (the scaler sees the imputer's output)."""
    base = apply_impute(_train(df, split), impute or {})
    q = fit_quantiles(base, cols, [0.25, 0.5, 0.75], None)
    iqr = {}
    for c in cols:
        width = (q[c].get(0.75) or 0.0) - (q[c].get(0.25) or 0.0)
        iqr[c] = width if width != 0 else 1.0
    return RobustParams({c: q[c].get(0.5) for c in cols}, iqr)


def apply_robust(df: DataFrame, p: RobustParams) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(p.median[c])) / F.lit(p.iqr[c]) for c in p.median})


def fit_modes(df: DataFrame, cols: Sequence[str], split: str | None = "split") -> dict[str, object]:
    """most frequent value per column, ties -> smallest (T14); one aggregate
    of (column, value) counts, so no column's values meet in one task."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                      for c in cols])
    long = _train(df, split).select(F.inline(pairs)).filter(F.col("v").isNotNull())
    counts = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.max_by(F.col("v"), F.struct(F.col("n"), -F.col("v"))).alias("mode")).collect()
    return {r["column"]: r["mode"] for r in best}


# ------------------------------------------------------------------ F4 / F10 / F11

def one_hot_sparse(df: DataFrame, col: str, split: str | None = "split", fill: str = "MISSING",
                   out: str | None = None) -> DataFrame:
    """F4 / F10 without declared categories: (size, index) of the one-hot vector.

    ``index`` is the position of the value among the sorted training categories
    (NULL: unseen, an all-zero vector).  Any number of categories.
    """
    out = out or f"{col}_VEC"
    filled = df.withColumn(out, F.coalesce(F.col(col).cast("string"), F.lit(fill)))
    codes = fit_label_codes([_train(filled, split)], [out])
    size = codes.agg(F.count(F.lit(1)).cast("int").alias("_size"))
    coded = apply_label_codes(filled, [out], codes).crossJoin(size)
    return coded.withColumn(out, F.struct(F.col("_size").alias("size"), F.col(out).alias("index"))).drop("_size")


def apply_one_hot(df: DataFrame, cats: Mapping[str, Sequence[str]], fill: str = "MISSING",
                  drop_last: bool = False, drop_source: bool = True) -> DataFrame:
    """0/1 columns ``col_value`` of declared categories in sorted order
    (``drop_last``: without the last); other values give all zeros."""
    new: dict[str, Column] = {}
    for c, values in cats.items():
        vals = sorted(values)[:-1] if drop_last else sorted(values)
        x = F.coalesce(F.col(c).cast("string"), F.lit(fill))
        for v in vals:
            new[f"{c}_{v}"] = (x == F.lit(v)).cast("int")
    out = df.withColumns(new)
    return out.drop(*cats.keys()) if drop_source else out


# ------------------------------------------------------------------ F5 / F6

@dataclass(frozen=True)
class PreprocessSpec:
    financial: Sequence[str] = ()
    scaled: Sequence[str] = ()
    binary: Sequence[str] = ()
    categorical: Mapping[str, Sequence[str]] = field(default_factory=dict)  # declared categories
    keep: Sequence[str] = ()  # passed through untouched (ids, target, audit columns)


@dataclass
class FittedPreprocess:
    spec: PreprocessSpec
    fin_median: dict[str, float] = field(default_factory=dict)
    scaled_median: dict[str, float] = field(default_factory=dict)
    robust: RobustParams | None = None
    modes: dict[str, object] = field(default_factory=dict)


def fit_preprocess(df: DataFrame, spec: PreprocessSpec, split: str | None = "split") -> FittedPreprocess:
    """F6 fit: every statistic from the training rows only, in one job.

    One pass counts (column, value) of all columns, map-side combined.  Medians
    follow from the counts; the scaler sees imputed values, so its quantiles
    follow from the same counts with the column's nulls added at the median;
    modes are the largest counts.
    """
    fitted = FittedPreprocess(spec)
    cols = list(dict.fromkeys([*spec.financial, *spec.scaled, *spec.binary]))
    if not cols:
        return fitted
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])
    counts = (_train(df, split).select(F.inline(pairs)).groupBy("column", (-F.col("v")).alias("score"))
              .agg(F.count(F.lit(1)).alias("pos")).withColumn("neg", F.lit(0)))
    counts = cut_lineage(counts)  # one row per (column, distinct value), read three times
    missing = F.col("score").isNull() | F.isnan("score")
    nulls = counts.groupBy("column").agg(F.sum(F.when(missing, F.col("pos")).otherwise(0)).alias("nulls"))
    cum = with_cumulative(counts.where(~F.coalesce(missing, F.lit(True))), ["column"]).join(nulls, "column")
    v, below, c, n = -F.col("score"), F.col("tp_above"), F.col("pos"), F.col("P")

    def at(k: Column, lo: Column, hi: Column) -> Column:
        return F.max(F.when((lo <= k) & (k < hi), v))

    mid = F.lit(0.5) * (n - 1)
    stats = cum.groupBy("column").agg(
        at(F.floor(mid), below, below + c).alias("m1"), at(F.ceil(mid), below, below + c).alias("m2"),
        F.first(mid - F.floor(mid)).alias("mf"), F.first("nulls").alias("nulls"), F.first(n).alias("n"),
        F.max_by(v, F.struct(c, -v)).alias("mode"))
    stats = stats.withColumn("median", F.col("m1") + (F.col("m2") - F.col("m1")) * F.col("mf")).select(
        "column", "median", "mode", "nulls", F.col("n").alias("known"))
    filled = cum.drop("nulls").join(stats, "column")
    total = F.col("known") + F.col("nulls")
    quantiles = []
    for q in (0.25, 0.5, 0.75):
        pos = F.lit(q) * (total - 1)
        ends = []
        for k in (F.floor(pos), F.ceil(pos)):
            # position k of the imputed values: the nulls stand right behind the values up to the median
            up = (v <= F.col("median")) & (below <= k) & (k < below + c)
            down = (v > F.col("median")) & (below + F.col("nulls") <= k) & (k < below + c + F.col("nulls"))
            upto = F.sum(F.when(v <= F.col("median"), c).otherwise(0))
            ends.append(F.coalesce(F.max(F.when(up | down, v)),
                                   F.when((F.first(k) >= upto) & (F.first(k) < upto + F.first("nulls")), F.first("median"))))
        quantiles.append((ends[0] + (ends[1] - ends[0]) * F.first(pos - F.floor(pos))).alias(f"q{int(q * 100)}"))
    rows = filled.groupBy("column").agg(F.first("median").alias("median"), F.first("mode").alias("mode"), *quantiles).collect()
    got = {r["column"]: r for r in rows}
    fitted.fin_median = {x: got[x]["median"] for x in spec.financial if x in got}
    fitted.scaled_median = {x: got[x]["median"] for x in spec.scaled if x in got}
    fitted.robust = RobustParams({x: got[x]["q50"] for x in spec.scaled if x in got},
                                 {x: (got[x]["q75"] - got[x]["q25"]) or 1.0 for x in spec.scaled if x in got})
    fitted.modes = {x: got[x]["mode"] for x in spec.binary if x in got}
    return fitted


def apply_preprocess(df: DataFrame, fitted: FittedPreprocess, raw_copies: Mapping[str, str] = ()
                     ) -> DataFrame:
    """F5 / F6 apply: one projection; columns outside the spec are dropped, raw
    copies (e.g. the audit null count) are kept beside the transformed ones."""
    spec = fitted.spec
    out = df.withColumns({dst: F.col(src) for src, dst in dict(raw_copies).items()}) if raw_copies else df
    out = apply_impute(out, fitted.fin_median)
    out = apply_impute(out, fitted.scaled_median)
    if fitted.robust is not None:
        out = apply_robust(out, fitted.robust)
    types = dict(out.dtypes)
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
                           for c, v in fitted.modes.items() if v is not None})
    out = apply_one_hot(out, spec.categorical)
    one_hot_cols = [f"{c}_{v}" for c, vals in spec.categorical.items() for v in sorted(vals)]
    cols = [*spec.keep, *dict(raw_copies).values(), *spec.financial, *spec.scaled, *spec.binary,
            *one_hot_cols]
    return out.select(*cols)


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F6 check: missing values left after the fit, one aggregate."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


# ------------------------------------------------------------------ F7 / F8 / F9

def class_weights(df: DataFrame, label: str = "y") -> DataFrame:
    """balanced weights n / (2 n_c) from one aggregate; the class table has
    two rows, so its total is a window over two rows."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n_c"))
    n = F.sum("n_c").over(Window.partitionBy())
    return counts.select("label", "n_c", (n / (2.0 * F.col("n_c"))).alias("weight"))


def fit_standard(df: DataFrame, cols: Sequence[str], split: str | None = "split") -> dict[str, tuple]:
    """F8: mean and population std on training rows; zero std -> 1."""
    r = _train(df, split).agg(*[x for c in cols for x in (
        F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (r[f"m_{c}"], (r[f"s_{c}"] or 1.0) if r[f"s_{c}"] != 0 else 1.0) for c in cols}


def apply_standard(df: DataFrame, params: Mapping[str, tuple]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()})


def target_encode(df: DataFrame, cat: str, target: str, *, split: str | None = "split",
                  smoothing: float = 20.0, out: str | None = None) -> DataFrame:
    """``(n m + k g) / (n + k)`` per category from training rows; unseen -> g.
    g is a fitted constant; the per-category table is joined back by key."""
    out = out or f"{cat}_TE"
    train = _train(df, split)
    g = train.agg(F.avg(F.col(target).cast("double"))).first()[0]
    enc = train.groupBy(cat).agg(F.count(F.lit(1)).alias("_n"),
                                 F.avg(F.col(target).cast("double")).alias("_m")).select(
        cat, ((F.col("_n") * F.col("_m") + F.lit(smoothing) * F.lit(g))
              / (F.col("_n") + F.lit(smoothing))).alias(out))
    return df.join(enc, cat, "left").withColumn(out, F.coalesce(F.col(out), F.lit(g)))
