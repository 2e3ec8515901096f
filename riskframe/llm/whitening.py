"""Embedding whitening by QDWH spectral divide-and-conquer.

The covariance is summed on the executors, block by block of centred vectors, and reduced there row
by row.  The driver gets a matrix of dimension x dimension (its size is fixed by the width of the
vectors) and splits its space: the polar factor of the covariance less a shift is a matrix sign, half
of sign plus identity projects onto the components above the shift, and both sides are split again.
The components travel to the tasks with the function that projects the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import cut

#: Integer steps of one unit of an entry.
STEPS = 256
#: Components that are returned for every row, at most.
COMPONENTS = 4
#: Vectors that are multiplied at once.
BLOCK_ROWS = 4096
#: Partial sums of one row of the covariance that meet in a first step.
FAN = 64
#: Polar iterations (QDWH needs six at double precision), and shifts that are tried for one split.
POLAR_STEPS = 30
SHIFTS = 12
#: Variances below so many times the largest one are rounding: no direction.
RANK_EPS = 1e-11
LARGEST = 9_223_372_036_854_774_784


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QR-based dynamically weighted Halley steps."""
    n = len(a)
    scale = np.linalg.norm(a, 1)  # not below the largest singular value
    if scale == 0:
        return np.eye(n)
    x = a / scale
    try:  # not above the smallest one
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = max(low, 1e-15) if np.isfinite(low) else 1e-15
    eye = np.eye(n)
    for _ in range(POLAR_STEPS):
        d = np.cbrt(4 * max(1 - low * low, 0.0) / low ** 4)
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d)), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.concatenate((np.sqrt(wc) * x, eye)))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        low = min(low * (wa + wb * low * low) / (1 + wc * low * low), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if moved < np.cbrt(np.finfo(float).eps) * 1e-3 and 1 - low < 1e-12:
            break
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first k columns span the eigenvectors above a shift, or None if no
    shift parts them (all eigenvalues agree to rounding)."""
    n = len(a)
    diagonal = np.sort(np.diag(a))
    spread = np.abs(a - np.diag(np.diag(a))).sum(axis=1)
    low, high = (np.diag(a) - spread).min(), (np.diag(a) + spread).max()
    shift = float((diagonal[(n - 1) // 2] + diagonal[n // 2]) / 2)
    eps = np.finfo(float).eps * np.linalg.norm(a)
    for i in range(SHIFTS):
        if high - low <= 8 * eps:
            return None
        sign = polar(a - shift * np.eye(n))
        above = (sign + np.eye(n)) / 2
        k = int(round(np.trace(above)))
        if 0 < k < n:
            # columns of the projector, the longest one of what is left first
            basis = _range(above, k)
            off = basis[:, :k].T @ a @ basis[:, k:]
            if np.linalg.norm(off) <= 64 * n * eps:
                return basis, k
            shift += (high - low) * 1e-3 * (1 if i % 2 else -1) * (i + 1)
        elif k == 0:
            high = min(high, shift)
            shift = (low + shift) / 2
        else:
            low = max(low, shift)
            shift = (high + shift) / 2
    return None


def _range(p: np.ndarray, k: int) -> np.ndarray:
    """A full orthogonal basis whose first k columns span the range of the projector ``p`` of rank k."""
    rest, chosen = p.copy(), []
    for _ in range(k):
        size = (rest * rest).sum(axis=0)
        j = int(size.argmax())
        v = rest[:, j] / np.sqrt(size[j])
        for u in chosen:
            v = v - u * (u @ v)
        v /= np.linalg.norm(v)
        chosen.append(v)
        rest -= np.outer(v, v @ rest)
    q, _ = np.linalg.qr(np.concatenate((p @ np.array(chosen).T, np.eye(len(p))), axis=1))
    q1, _ = np.linalg.qr(p @ q[:, :k])  # one step of subspace iteration with the projector
    q, _ = np.linalg.qr(np.concatenate((q1, np.eye(len(p))), axis=1))
    return q[:, :len(p)]


def components(cov: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the ``wanted`` largest, falling.

    A part is split until it has one dimension, or all its eigenvalues agree to rounding, and then any
    basis of it will do.  Parts below a shift are opened only if those above hold too few components.
    """
    n = len(cov)
    values, vectors = [], []
    open_parts = [(np.eye(n), cov)]  # the last one holds the largest eigenvalues
    while open_parts and len(values) < wanted:
        basis, a = open_parts.pop()
        a = (a + a.T) / 2
        if len(a) > 1 and (found := _split(a)) is not None:
            q, k = found
            open_parts.append((basis @ q[:, k:], q[:, k:].T @ a @ q[:, k:]))
            open_parts.append((basis @ q[:, :k], q[:, :k].T @ a @ q[:, :k]))
            continue
        order = np.argsort(-np.diag(a), kind="stable")
        values += np.diag(a)[order].tolist()
        vectors += list(basis[:, order].T)
    v = np.array(vectors[:wanted]).reshape(-1, n)
    q, r = np.linalg.qr(v.T)
    v = (q * np.sign(np.where(np.diag(r) == 0, 1, np.diag(r)))).T
    e = np.einsum("ij,jk,ik->i", v, cov, v)
    order = np.argsort(-e, kind="stable")
    return e[order], v[order]


def steps(vectors: DataFrame, column: str = "embedding", step: int = STEPS) -> DataFrame:
    """``vectors`` with the column x (array of long): floor(step * c) of every entry c as double.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out.  Entries
    beyond the range of a long take its nearest end.  Of vectors of several lengths only those of
    the most frequent one (the longer one on ties) can be compared; the others are left out.
    """
    usable = F.forall(column, lambda c: F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    bound = lambda v: F.greatest(F.least(v, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    x = F.transform(column, lambda c: F.floor(bound(c.cast("double") * step)).cast("bigint"))
    rows = vectors.where(F.col(column).isNotNull() & (F.size(column) > 0) & usable)
    widths = rows.groupBy(F.size(column).alias("w")).count().orderBy(F.desc("count"), F.desc("w")).limit(1).collect()
    width = widths[0]["w"] if widths else 0
    return rows.where(F.size(column) == width).withColumn("x", x)


def _block(batch: pa.RecordBatch | pa.ListArray) -> np.ndarray:
    column = batch.column(0) if isinstance(batch, pa.RecordBatch) else batch
    return column.flatten().to_numpy().reshape(len(column), -1)


def _summed(parts: DataFrame, width: int) -> np.ndarray:
    """Sum of matrices given as (i, task, v): row number, number of the partial sum, the row's values."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        v = np.zeros(width)
        for row in frame.sort_values("task")["v"]:
            v += np.frombuffer(row, "<f8")
        return pd.DataFrame({"i": [frame["i"].iloc[0]], "task": [frame["task"].iloc[0] % FAN], "v": [v.tobytes()]})

    kind = "i int, task long, v binary"
    once = parts.groupBy("i", F.col("task") % FAN).applyInPandas(lambda key, frame: add(frame), kind)
    rows = once.groupBy("i").applyInPandas(lambda key, frame: add(frame), kind).collect()
    out = np.zeros((max((r["i"] for r in rows), default=-1) + 1, width))
    for r in rows:
        out[r["i"]] = np.frombuffer(r["v"], "<f8")
    return out


def totals(fit: DataFrame) -> tuple[int, list[int]]:
    """(rows of ``fit``, exact sum of every dimension of its column x)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for batch in batches:
            x = _block(batch)
            n += len(x)
            high = high + (x >> 32).sum(axis=0)  # halves of 32 bits: a task's sums fit a long
            low = low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high)), pa.int32()), pa.array(np.full(len(high), n)),
                                              pa.array(high), pa.array(low)], ["i", "n", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    got = (fit.select("x").mapInArrow(add, "i int, n long, high long, low long").groupBy("i")
           .agg(F.sum("n").alias("n"), wide("high"), wide("low")).orderBy("i").collect())
    return (got[0]["n"] if got else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in got]


def covariance(fit: DataFrame, mean: np.ndarray, n: int, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of the column x of ``fit``, centred before multiplying, on the executors;
    with ``project`` (rows are directions) that of the projected vectors."""
    width = len(mean) if project is None else len(project)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((width, width))
        for batch in batches:
            x = _block(batch)
            for lo in range(0, len(x), BLOCK_ROWS):
                y = x[lo:lo + BLOCK_ROWS] - mean
                y = y if project is None else y @ project.T
                total += y.T @ y
        context = TaskContext.get()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width), pa.int32()), pa.array(np.full(width, context.partitionId() if context else 0)),
             pa.array([row.tobytes() for row in total], pa.binary())], ["i", "task", "v"])

    return _summed(fit.select("x").mapInArrow(gram, "i int, task long, v binary"), width) / n


def whiten(vectors: DataFrame, column: str = "embedding", wanted: int = COMPONENTS, step: int = STEPS) -> DataFrame:
    """``vectors`` without unusable rows, with x, n, deviation, whitened, explained, identity_error.

    Fitted on each distinct x once: a vector that stands a million times counts once.  ``whitened``
    and ``explained`` are arrays with one entry for each of the ``wanted`` components of the largest
    variance e; a direction without variance (below 1e-11 of the largest) is none, so one distinct
    vector gives empty arrays.  ``deviation`` is the sum over dimensions of (n*x - S)^2, exact (null
    beyond the range of a long).  ``identity_error`` is the largest absolute entry of the covariance of
    the whitened fit vectors minus the identity, measured in a pass of its own.  Columns of ``vectors``
    with these names are replaced; null ids and repeated rows are rows like others; an empty table
    gives an empty result.
    """
    own = ["x", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = steps(vectors.select(*(F.col(f"`{c}`") for c in vectors.columns if c not in own)), column, step)
    fit = cut(rows.select("x").distinct())
    n, total = totals(fit)
    mean = np.array([s / n for s in total])
    values, axes, error, trace = np.zeros(0), np.zeros((0, len(total))), 0.0, 0.0
    if n > 1:
        cov = covariance(fit, mean, n)
        trace = float(np.trace(cov))
        if trace > 0:
            values, axes = components(cov, min(wanted, len(total)))
            keep = values > RANK_EPS * values[0]
            values, axes = values[keep], axes[keep]
            axes = axes / np.sqrt(values)[:, None]
            error = float(np.abs(covariance(fit, mean, n, axes) - np.eye(len(axes))).max())
    explained = [float(e / trace) for e in values]
    wrapped = np.array([s & (2 ** 64 - 1) for s in total], np.uint64).view(np.int64)

    kept = rows.columns
    at = kept.index("x")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _block(batch.column(at))
            white, off, far = np.zeros((len(x), len(axes))), np.zeros(len(x), np.int64), np.zeros(len(x), bool)
            for lo in range(0, len(x), BLOCK_ROWS):
                part = x[lo:lo + BLOCK_ROWS]
                y = part - mean
                white[lo:lo + BLOCK_ROWS] = y @ axes.T
                far[lo:lo + BLOCK_ROWS] = ((y * n) ** 2).sum(axis=1) > 9.2e18
                with np.errstate(over="ignore"):  # exact wherever the sum fits a long
                    off[lo:lo + BLOCK_ROWS] = ((part * np.int64(n) - wrapped) ** 2).sum(axis=1)
            ends = np.arange(len(x) + 1, dtype=np.int32) * len(axes)
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(off, mask=far), pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel()))],
                [*kept, "deviation", "whitened"])

    out = rows.mapInArrow(project, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
                          + ", deviation bigint, whitened array<double>")
    return out.select(*kept, F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                      F.array(*(F.lit(e) for e in explained)).cast("array<double>").alias("explained"),
                      F.lit(error).alias("identity_error"))


def op13(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    white = whiten(vectors)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "c")
    return white.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"), "identity_error")
