"""Linear learners (W10, W11): a Spark ML fit, and a fair sweep.  Boosted trees are in ``boosting.py``.

* W10: a class-weighted linear scorer, ``LogisticRegression`` with balanced
  weights (F7) as ``weightCol``.
* W11: logistic scorers under BCE + lambda * rho^2 (rho: correlation of score
  and sensitive attribute).  All lambdas train together by L-BFGS: one pass over the
  training rows returns the sums that objective and gradient of all need.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.fit import class_weights
from riskframe.session import cut_lineage

#: Sums of tasks that meet in one step.
FAN = 64


def fit_weighted_logit(train: DataFrame, features: Sequence[str], label: str,
                       reg: float = 0.0, max_iter: int = 100):
    """Balanced-weight logistic regression on the training rows."""
    w = class_weights(train, label).select(F.col("label").alias(label), F.col("weight").alias("_w"))
    # the class table has two rows
    data = train.join(F.broadcast(w), label)
    va = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep")
    lr = LogisticRegression(featuresCol="_x", labelCol=label, weightCol="_w", regParam=reg,
                            maxIter=max_iter)
    model = lr.fit(va.transform(data.withColumn(label, F.col(label).cast("double"))))
    return va, model


def score(df: DataFrame, fitted, out: str = "p") -> DataFrame:
    va, model = fitted
    scored = model.transform(va.transform(df))
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(
        "_x", "rawPrediction", "probability", "prediction")


def fair_gradients(x: np.ndarray, y: np.ndarray, s: np.ndarray, w: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Sums of one block of rows for all models: one row per model."""
    p = 1 / (1 + np.exp(-np.clip(x @ beta.T, -30, 30)))
    q = p * (1 - p)
    r = w[:, None] * (p - y[:, None])
    loss = -w[:, None] * (y[:, None] * np.log(np.maximum(p, 1e-12)) + (1 - y[:, None]) * np.log(np.maximum(1 - p, 1e-12)))
    ones = np.ones(beta.shape[0])
    head = [ones * len(y), ones * w.sum(), loss.sum(0), p.sum(0), (p * p).sum(0), ones * s.sum(), ones * (s * s).sum(), s @ p]
    return np.column_stack([*head, r.T @ x, q.T @ x, (q * s[:, None]).T @ x, (q * p).T @ x])


def fair_step(sums: np.ndarray, lambdas: np.ndarray, eps: float = 1e-8) -> tuple[np.ndarray, np.ndarray]:
    """(objective, gradient) of BCE + lambda * rho^2 per model from the summed blocks."""
    n, sw, loss, sp, spp, ss, sss, sps = sums[:, :8].T
    d = (sums.shape[1] - 8) // 4
    g, a, b, c = (sums[:, 8 + i * d:8 + (i + 1) * d] for i in range(4))
    cov, vp, vs = sps / n - sp * ss / n ** 2, spp / n - (sp / n) ** 2, sss / n - (ss / n) ** 2
    den = vp * vs + eps
    rho = cov / np.sqrt(den)
    dcov = b / n[:, None] - a * (ss / n ** 2)[:, None]
    dvp = 2 * c / n[:, None] - 2 * a * (sp / n ** 2)[:, None]
    drho = dcov / np.sqrt(den)[:, None] - dvp * (cov * vs / (2 * den ** 1.5))[:, None]
    return loss / sw + lambdas * rho ** 2, g / sw[:, None] + (2 * lambdas * rho)[:, None] * drho


@dataclass
class FairFit:
    """One scorer per lambda: coefficients (bias last), objective, largest gradient entry, steps and passes."""

    lambdas: list[float]
    beta: np.ndarray
    objective: np.ndarray
    gradient: np.ndarray
    steps: np.ndarray
    passes: int


def _fair_pass(rows: DataFrame, beta: dict[int, np.ndarray], lambdas: np.ndarray, d: int, n_tasks: int) -> dict[int, tuple]:
    """{model: (objective, gradient)} at the points ``beta`` in one pass; tasks' sums are added on the executors."""
    index, points = list(beta), np.array(list(beta.values()))
    block = fair_gradients

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(points), 8 + 4 * d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, d)
            total += block(x, *(batch.column(i).to_numpy() for i in (1, 2, 3)), points)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(index, pa.int32()), pa.array([task] * len(index), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())],
            ["model", "task", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(8 + 4 * d)
        for i in np.argsort(table["task"].to_numpy(), kind="stable"):
            total += np.frombuffer(table["sums"][int(i)].as_buffer(), np.float64)
        return table.slice(0, 1).set_column(2, "sums", pa.array([total.tobytes()], pa.binary()))

    kind = "model int, task int, sums binary"
    parts = rows.mapInArrow(sums, kind)
    step = n_tasks
    while step > FAN:  # sums of many tasks meet in several steps
        step = -(-step // FAN)
        parts = parts.groupBy("model", (F.col("task") % step).alias("part")).applyInArrow(add, kind)
    got = parts.groupBy("model").applyInArrow(add, kind).collect()  # one row a model
    at = [r["model"] for r in got]
    value, grad = fair_step(np.array([np.frombuffer(r["sums"], np.float64) for r in got]), lambdas[at])
    return {m: (float(v), g) for m, v, g in zip(at, value, grad)}


def _direction(grad: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the inverse Hessian, as known from the last moves, times the gradient (two loops)."""
    q, alphas = grad.copy(), []
    for s, y in reversed(history):
        a = (s @ q) / (s @ y)
        alphas.append(a)
        q = q - a * y
    if history:
        s, y = history[-1]
        q = q * ((s @ y) / (y @ y))
    for (s, y), a in zip(history, reversed(alphas)):
        q = q + s * (a - (y @ q) / (s @ y))
    return -q


def fit_fair(train: DataFrame, features: Sequence[str], label: str, sensitive: str, lambdas: Sequence[float], *,
             tolerance: float = 1e-5, steps: int = 200, memory: int = 10) -> FairFit:
    """One scorer per lambda by L-BFGS, all lambdas in shared passes over the checkpointed training rows.

    ``features`` are scaled and complete.  A pass evaluates each lambda at its own trial point: it moves there
    if the objective falls enough (Armijo), else it tries half the way.  A lambda leaves the passes as soon as no
    entry of its gradient exceeds ``tolerance``, or no step lowers its objective any more; ``steps`` is a limit that
    it does not reach on data that can be fitted, and the result tells the gradient that is left.
    """
    if 0.0 not in [float(v) for v in lambdas]:
        raise ValueError("the grid must contain 0.0 (the baseline)")
    lam = np.array(lambdas, float)
    w = class_weights(train, label).select(F.col("label").alias(label), F.col("weight").alias("_w"))
    # the class table has two rows
    rows = cut_lineage(train.join(F.broadcast(w), label).select(
        F.array(*[F.col(c).cast("double") for c in features], F.lit(1.0)).alias("x"),
        F.col(label).cast("double").alias("y"), F.col(sensitive).cast("double").alias("s"), F.col("_w").alias("w")))
    n_tasks = (rows.select(F.spark_partition_id().alias("task")).agg(F.max("task")).head()[0] or 0) + 1
    d, k = len(features) + 1, len(lam)
    at = _fair_pass(rows, {i: np.zeros(d) for i in range(k)}, lam, d, n_tasks)
    out = FairFit([float(v) for v in lam], np.zeros((k, d)), np.array([at[i][0] for i in range(k)]), np.zeros(k), np.zeros(k, int), 1)
    grad = [at[i][1] for i in range(k)]
    history: list[list] = [[] for _ in range(k)]
    go = [-g / max(1.0, np.linalg.norm(g)) for g in grad]
    length, open_ = np.ones(k), {i for i in range(k) if np.abs(grad[i]).max() > tolerance}
    while open_:
        trial = {i: out.beta[i] + length[i] * go[i] for i in sorted(open_)}
        out.passes += 1
        for i, (value, g) in _fair_pass(rows, trial, lam, d, n_tasks).items():
            if not np.isfinite(value) or value > out.objective[i] + 1e-4 * length[i] * (grad[i] @ go[i]):
                length[i] /= 2
                if length[i] < 1e-10:  # rounding: nothing lower is near
                    open_.discard(i)
                continue
            s, y = trial[i] - out.beta[i], g - grad[i]
            if s @ y > 1e-12:
                history[i] = [*history[i], (s, y)][-memory:]
            out.beta[i], out.objective[i], grad[i] = trial[i], value, g
            out.steps[i] += 1
            if np.abs(g).max() <= tolerance or out.steps[i] >= steps:
                open_.discard(i)
            go[i], length[i] = _direction(g, history[i]), 1.0
            if g @ go[i] >= 0:
                go[i], history[i] = -g, []
    out.gradient = np.array([np.abs(g).max() for g in grad])
    return out


def fit_fair_sweep(train: DataFrame, features: Sequence[str], label: str, sensitive: str, lambdas: Sequence[float], **options) -> np.ndarray:
    """Coefficients (bias last) of one scorer per lambda (see ``fit_fair``)."""
    return fit_fair(train, features, label, sensitive, lambdas, **options).beta


def fair_scores(df: DataFrame, beta: np.ndarray, lambdas: Sequence[float], features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(model_id, lam, keep..., p): the score of every row under every model."""
    models = F.array(*[
        F.struct(F.lit(f"lam={lam:g}").alias("model_id"), F.lit(float(lam)).alias("lam"),
                 (1 / (1 + F.exp(-(sum((F.lit(float(b)) * F.col(c).cast("double") for b, c in zip(row, features)),
                                       F.lit(float(row[-1]))))))).alias("p"))
        for lam, row in zip(lambdas, beta)])
    return df.select(*keep, F.inline(models))
