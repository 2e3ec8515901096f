"""Deterministic stratified splits, folds and per-class samples.

Order inside a stratum = ``md5("{id}:{seed}")`` then id.  Positions are exact
without ranking a whole stratum in one task:

1. a histogram of rows per ``(stratum, first L hex digits of the hash)`` cell
   (16^L cells per stratum, a table bounded by strata x 16^L);
2. a running sum over that small table gives each cell the number of rows
   before it;
3. a cell that lies entirely on one side of every cut is assigned as a whole;
   only the rows of a cell that straddles a cut are sorted (window partitioned
   by the cell), so the sort work is a couple of cells per stratum.

The assignment depends only on id, seed and stratum sizes: it is the same for
any partitioning and is reproducible in plain SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class SplitConfigError(ValueError):
    pass


def hash_key(id_col: str, seed: int | Column) -> Column:
    s = F.lit(str(seed)) if isinstance(seed, int) else seed.cast("string")
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(":"), s))


def strata_key(df: DataFrame, cols: Sequence[str], out: str = "stratum") -> DataFrame:
    """Joint strata key ``"{target}_{sensitive}"``."""
    return df.withColumn(out, F.concat_ws("_", *[F.col(c).cast("string") for c in cols]))


def strata_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return strata_key(df, cols).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))


def validate_fractions(test: float, val: float) -> None:
    """Fractions in (0, 1) and summing below 1."""
    for name, f in (("test", test), ("validation", val)):
        if not 0.0 < f < 1.0:
            raise SplitConfigError(f"{name} fraction must be in (0, 1): {f}")
    if test + val >= 1.0:
        raise SplitConfigError("test + validation fractions must be below 1")


def _cells(df: DataFrame, stratum: str, prefix_len: int) -> tuple[DataFrame, DataFrame]:
    rows = df.withColumn("_cell", F.substring("_key", 1, prefix_len))
    hist = rows.groupBy(stratum, "_cell").agg(F.count(F.lit(1)).alias("_cn"))
    w = Window.partitionBy(stratum).orderBy("_cell")
    hist = hist.select(stratum, "_cell", "_cn",
                       (F.sum("_cn").over(w) - F.col("_cn")).alias("_lo"),
                       F.sum("_cn").over(Window.partitionBy(stratum)).alias("_n"))
    return rows, hist


def assign_by_rank(df: DataFrame, *, stratum: str, id_col: str, seed: int,
                   cuts: Sequence[Column], labels: Sequence[str], out: str,
                   prefix_len: int = 3) -> DataFrame:
    """Label rows by their 0-based hash rank ``r`` inside the stratum:
    ``labels[i]`` for ``cuts[i-1] <= r < cuts[i]`` (cuts are expressions of the
    stratum size ``_n``), last label for the rest."""
    if len(labels) != len(cuts) + 1:
        raise SplitConfigError("need one more label than cuts")
    keyed = df.withColumn("_key", hash_key(id_col, seed))
    rows, hist = _cells(keyed, stratum, prefix_len)
    hist = hist.select("*", *[c.alias(f"_cut{i}") for i, c in enumerate(cuts)])

    def label_of(r: Column) -> Column:
        e = None
        for i, _ in enumerate(cuts):
            cond = r < F.col(f"_cut{i}")
            e = F.when(cond, F.lit(labels[i])) if e is None else e.when(cond, F.lit(labels[i]))
        return e.otherwise(F.lit(labels[-1]))

    lo, hi = F.col("_lo"), F.col("_lo") + F.col("_cn") - 1
    whole = F.lit(True)
    for i, _ in enumerate(cuts):
        c = F.col(f"_cut{i}")
        whole = whole & ((hi < c) | (lo >= c))
    hist = hist.withColumn("_whole", whole).withColumn("_label", label_of(lo))
    # the cell table is strata x 16^prefix_len rows: bounded, broadcast
    j = rows.join(F.broadcast(hist), [stratum, "_cell"])
    direct = j.filter("_whole").withColumn(out, F.col("_label"))
    w = Window.partitionBy(stratum, "_cell").orderBy("_key", id_col)
    edge = (j.filter(~F.col("_whole"))
            .withColumn("_r", F.col("_lo") + F.row_number().over(w) - 1)
            .withColumn(out, label_of(F.col("_r"))).drop("_r"))
    drop = ["_key", "_cell", "_cn", "_lo", "_n", "_whole", "_label"] + [f"_cut{i}" for i in range(len(cuts))]
    return direct.unionByName(edge).drop(*drop)


def _round_half_up(x: Column) -> Column:
    return F.floor(x + F.lit(0.5))


def stratified_split(df: DataFrame, *, id_col: str, strata: Sequence[str], seed: int = 42,
                     test: float = 0.15, val: float = 0.15, out: str = "split",
                     prefix_len: int = 3) -> DataFrame:
    """Test first (round(n * test)), then validation = round(rest * val / (1 - test))."""
    validate_fractions(test, val)
    keyed = strata_key(df, strata, "_stratum")
    n = F.col("_n")
    n_test = _round_half_up(n * F.lit(test))
    n_val = _round_half_up((n - n_test) * F.lit(val / (1.0 - test)))
    out_df = assign_by_rank(keyed, stratum="_stratum", id_col=id_col, seed=seed,
                            cuts=[n_test, n_test + n_val], labels=["test", "validation", "train"],
                            out=out, prefix_len=prefix_len)
    return out_df.drop("_stratum")


def kfold_assign(df: DataFrame, *, id_col: str, strata: Sequence[str], k: int = 5,
                 seeds: Sequence[int] = (42,), prefix_len: int = 3) -> DataFrame:
    """Stratified K folds for each seed: fold = (hash rank in stratum) mod K.
    Returns ``(id, seed, fold)``; every row is ranked, by cells in parallel."""
    parts = []
    base = strata_key(df.select(id_col, *strata), strata, "_stratum")
    for seed in seeds:
        keyed = base.withColumn("_key", hash_key(id_col, seed))
        rows, hist = _cells(keyed, "_stratum", prefix_len)
        j = rows.join(F.broadcast(hist), ["_stratum", "_cell"])
        w = Window.partitionBy("_stratum", "_cell").orderBy("_key", id_col)
        r = F.col("_lo") + F.row_number().over(w) - 1
        parts.append(j.select(F.col(id_col), F.lit(seed).alias("seed"), (r % k).cast("int").alias("fold")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def repeat_seeds(seed: int, n: int, step: int = 101) -> list[int]:
    return [seed + step * i for i in range(n)]


def sample_per_class(df: DataFrame, *, id_col: str, label: str, n: int, seed: int = 42,
                     prefix_len: int = 3) -> DataFrame:
    """The n rows with the smallest hash key of each class (all if fewer)."""
    tagged = assign_by_rank(df.withColumn("_stratum", F.col(label).cast("string")), stratum="_stratum",
                            id_col=id_col, seed=seed, cuts=[F.lit(n)], labels=["in", "out"],
                            out="_sample", prefix_len=prefix_len)
    return tagged.filter(F.col("_sample") == "in").drop("_sample", "_stratum")


def split_report(df: DataFrame, *, split: str = "split", target: str = "y",
                 sensitive: str = "s") -> DataFrame:
    """Size, target rate, sensitive rate and the four joint counts per split."""
    y, s = F.col(target), F.col(sensitive)
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(y.cast("double")).alias("target_rate"),
        F.avg(s.cast("double")).alias("sensitive_rate"),
        F.count_if((y == 0) & (s == 0)).alias("n_y0_s0"),
        F.count_if((y == 0) & (s == 1)).alias("n_y0_s1"),
        F.count_if((y == 1) & (s == 0)).alias("n_y1_s0"),
        F.count_if((y == 1) & (s == 1)).alias("n_y1_s1"))


def write_split_ids(df: DataFrame, path: str, *, id_col: str, split: str = "split") -> None:
    """P5: ``(split, id)`` partitioned by split, written on the cluster."""
    df.select(split, id_col).write.mode("overwrite").partitionBy(split).parquet(path)
