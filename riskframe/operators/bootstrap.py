"""Poisson bootstrap of scoring metrics.

Rows are first reduced to groups of identical ``(keys, score, y, s)``; a group
of c rows gets a Poisson(c) weight per replicate (the sum of c independent
Poisson(1) row weights has exactly that law).  All replicates of a group are
one array, drawn from a generator that is seeded by the group's values, so they
do not depend on partitioning and are never rows of their own.

Groups are dealt to score buckets of a bounded number of groups.  A bucket
returns per replicate its weighted counts in the (y, s, y_hat) cells, its score
moments and its share of the AUC numerator; the rest of the numerator follows
from the buckets above it.  This is the Poisson bootstrap, not the exact
multinomial resampling: intervals agree statistically, not digit for digit.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

#: Groups of one bucket, about; a bucket holds groups x replicates weights.
BUCKET_GROUPS = 2_000
METRICS = ("auc", "accuracy", "precision", "recall", "f1", "dpd", "eod", "abs_rho")
EPS_RHO = 1e-8
# weighted counts of the cells: y, s and y_hat as digits
CELLS = tuple(f"n{y}{s}{h}" for y in (0, 1) for s in (0, 1) for h in (0, 1))
MOMENTS = ("sp", "spp", "sps")


def draw_weights(score: np.ndarray, y: np.ndarray, s: np.ndarray, c: np.ndarray, n_boot: int, seed: int) -> np.ndarray:
    """(groups, replicates) Poisson(c) weights; each group has its own generator."""
    out = np.empty((len(c), n_boot), np.int64)
    bits = score.astype(np.float64).view(np.uint64)
    for i in range(len(c)):
        key = [int(bits[i]), int(y[i]) & 0xFF, int(s[i]) & 0xFF, seed]
        out[i] = np.random.Generator(np.random.SFC64(np.random.SeedSequence(key))).poisson(c[i], n_boot)
    return out


def bucket_sums(score: np.ndarray, y: np.ndarray, s: np.ndarray, w: np.ndarray, threshold: float) -> dict[str, np.ndarray]:
    """Per replicate: cells, moments, positives, negatives and twice the AUC numerator within the bucket."""
    out = {}
    hat = score >= threshold
    for cell in CELLS:
        pick = (y == int(cell[1])) & (s == int(cell[2])) & (hat == (cell[3] == "1"))
        out[cell] = w[pick].sum(axis=0)
    out["sp"] = score @ w
    out["spp"] = (score * score) @ w
    out["sps"] = (score * s) @ w
    order = np.argsort(-score, kind="stable")
    score, y, w = score[order], y[order], w[order]
    starts = np.flatnonzero(np.concatenate(([True], score[1:] != score[:-1])))
    pos = np.add.reduceat(w * (y == 1)[:, None], starts, axis=0)
    neg = np.add.reduceat(w * (y == 0)[:, None], starts, axis=0)
    above = np.cumsum(pos, axis=0) - pos
    out["pos"], out["neg"] = pos.sum(axis=0), neg.sum(axis=0)
    out["twice"] = (neg.astype(float) * (2.0 * above + pos)).sum(axis=0)
    return out


def replicate_metrics(df: DataFrame, keys: Sequence[str] = (), *, n_boot: int = 500, seed: int = 42,
                      threshold: float | str = 0.5, score: str = "p", label: str = "y",
                      sensitive: str = "s") -> DataFrame:
    """``(keys, replicate, metrics)``.  ``threshold`` is a number or a column that is constant per key."""
    keys = list(keys) or ["_all"]
    base = df if "_all" not in keys else df.withColumn("_all", F.lit(0))
    t = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    groups = base.groupBy(*keys, F.col(score).cast("double").alias("p"), F.col(label).cast("int").alias("y"),
                          F.col(sensitive).cast("int").alias("s")).agg(
        F.count(F.lit(1)).alias("c"), F.first(t).cast("double").alias("t"))
    groups = cut_lineage(groups)
    n_buckets = max(1, int((groups.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) // BUCKET_GROUPS))
    cuts = groups.groupBy(*keys).agg(F.percentile_approx("p", [(i + 1) / n_buckets for i in range(n_buckets)], 10_000).alias("cuts"))
    dealt = groups.join(F.broadcast(cuts), keys).withColumn("bucket", F.size(F.filter("cuts", lambda x: x < F.col("p")))).drop("cuts")
    sums = [*CELLS, *MOMENTS, "pos", "neg", "twice"]
    schema = dealt.select(*keys).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

    def run(key, frame):
        p, y, s, c = (frame[x].to_numpy() for x in ("p", "y", "s", "c"))
        got = bucket_sums(p, y, s, draw_weights(p, y, s, c, n_boot, seed), float(frame["t"].iloc[0]))
        out = pd.DataFrame({**{k: [v] * n_boot for k, v in zip([*keys, "bucket"], key)}, "replicate": np.arange(n_boot),
                            **{k: got[k].astype(float) for k in sums}})
        return out[[*keys, "bucket", "replicate", *sums]]

    parts = dealt.groupBy(*keys, "bucket").applyInPandas(
        run, fields + ", bucket int, replicate int, " + ", ".join(f"{k} double" for k in sums))
    above = Window.partitionBy(*keys, "replicate").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("twice", F.col("twice") + 2 * F.col("neg") * F.coalesce(F.sum("pos").over(above), F.lit(0.0)))
    m = parts.groupBy(*keys, "replicate").agg(*(F.sum(k).alias(k) for k in sums))
    return _metrics(m, keys).drop("_all")


def _metrics(m: DataFrame, keys: Sequence[str]) -> DataFrame:
    def rate(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    def cells(y="01", s="01", h="01"):
        return sum((F.col(c) for c in CELLS if c[1] in y and c[2] in s and c[3] in h), F.lit(0.0))

    tp, fp, fn, tn = cells("1", h="1"), cells("0", h="1"), cells("1", h="0"), cells("0", h="0")
    n = F.nullif(cells(), F.lit(0.0))
    ss = cells(s="1")
    cov = F.col("sps") / n - F.col("sp") * ss / (n * n)
    vp = F.col("spp") / n - (F.col("sp") / n) ** 2
    vs = ss / n - (ss / n) ** 2
    den = F.sqrt(F.greatest(vp, F.lit(0.0)) * F.greatest(vs, F.lit(0.0)))

    def gap(y):
        # a group without weight has no rate of its own; an undefined rate counts as 0
        one, zero = rate(cells(y, "1", "1"), cells(y, "1")), rate(cells(y, "0", "1"), cells(y, "0"))
        return F.when((cells(s="0") > 0) & (cells(s="1") > 0), F.abs(one - zero)).otherwise(0.0)

    return m.select(
        *keys, "replicate",
        F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("twice") / (2.0 * F.col("pos") * F.col("neg"))).alias("auc"),
        rate(tp + tn, tp + fp + fn + tn).alias("accuracy"), rate(tp, tp + fp).alias("precision"),
        rate(tp, tp + fn).alias("recall"), rate(2 * tp, 2 * tp + fp + fn).alias("f1"),
        gap("01").alias("dpd"), F.greatest(gap("1"), gap("0")).alias("eod"),
        F.when(den <= EPS_RHO, F.lit(0.0)).otherwise(F.abs(cov / den)).alias("abs_rho"))


def bootstrap_ci(df: DataFrame, keys: Sequence[str] = (), *, n_boot: int = 500, seed: int = 42,
                 threshold: float | str = 0.5, alpha: float = 0.05, metrics: Sequence[str] = METRICS,
                 score: str = "p", label: str = "y", sensitive: str = "s") -> DataFrame:
    """``(keys, metric, lower, upper, n_valid)`` percentile intervals of the
    finite replicate values (linear interpolation)."""
    keys = list(keys)
    per = replicate_metrics(df, keys, n_boot=n_boot, seed=seed, threshold=threshold, score=score, label=label,
                            sensitive=sensitive)
    long = per.select(*keys, F.inline(F.array(*[F.struct(F.lit(x).alias("metric"), F.col(x).cast("double").alias("v"))
                                                for x in metrics])))
    finite = long.where(F.col("v").isNotNull() & ~F.isnan("v"))
    # n_boot values per (key, metric)
    q = F.percentile("v", F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))
    return finite.groupBy(*keys, "metric").agg(q.alias("q"), F.count(F.lit(1)).alias("n_valid")).select(
        *keys, "metric", F.col("q")[0].alias("lower"), F.col("q")[1].alias("upper"), "n_valid")
