"""Helpers shared by the pipeline operators: shared folder, range cells, prefix sums, Arrow bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from riskframe.session import package_on_workers

#: Rows of one Arrow batch: whole texts are carried in them, on both sides of a worker's pipe.
BATCH_ROWS = 2_000
#: Rows that one window partition of a prefix sum holds, on average.
ROWS_PER_CELL = 1_000_000
#: Fewest cells of a prefix sum.
MIN_CELLS = 256


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only in local mode (tests, laptops)."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later stages survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` is called so (in any case of its letters)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def prepare(spark: SparkSession) -> None:
    """What all operators ask of a session: the package on the workers, and small batches of texts."""
    package_on_workers(spark)
    # workers are reused: what a task frees goes back to the system, not to the worker's heap
    env = spark.sparkContext.environment
    env.setdefault("MALLOC_MMAP_THRESHOLD_", str(1 << 20))
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_splits(df: DataFrame, id_col: str, n: int | None = None) -> list[int]:
    """Sorted cut points of an id column for about ``n`` equal cells (None: by row count)."""
    if n is None:
        n = max(MIN_CELLS, df.select(id_col).count() // ROWS_PER_CELL)
    probs = [i / n for i in range(1, n)]
    got = df.agg(F.percentile_approx(F.col(id_col), probs, max(10_000, 10 * n)).alias("q")).head()["q"]
    return sorted({int(x) for x in got or []})


def cell_of(id_col: Column, splits: Sequence[int]) -> Column:
    """Number of cut points <= the id; -1 for a null id."""
    cuts = np.asarray(splits, dtype=np.int64)

    @F.pandas_udf(IntegerType())
    def locate(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(np.int64), side="right").astype(np.int32))

    return F.when(id_col.isNull(), F.lit(-1)).otherwise(locate(F.coalesce(id_col, F.lit(0).cast("bigint"))))


def running_totals(df: DataFrame, cell: str, order: list[Column], values: dict[str, str],
                   by: Sequence[str] = ()) -> DataFrame:
    """Exclusive running sums over rows ordered by (cell, order), per ``by`` group.

    Cells get their offset from a table of one row per (group, cell); only rows of one cell meet in
    a window partition.  ``values`` maps a value column to the name of its running sum; the value
    ``1`` counts rows.
    """
    by = list(by)
    val = {name: (F.lit(1).cast("bigint") if v == "1" else F.col(v)) for v, name in values.items()}
    totals = df.groupBy(*by, cell).agg(*(F.sum(v).alias(f"_t_{n}") for n, v in val.items()))
    before = Window.partitionBy(*by).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *(F.col(c).alias(f"_k_{c}") for c in [*by, cell]),
        *(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in val))
    on = None
    for c in [*by, cell]:
        cond = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        on = cond if on is None else on & cond
    inside = Window.partitionBy(*by, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.join(offsets, on, "left")
    for n, v in val.items():
        out = out.withColumn(n, (F.col(f"_o_{n}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).cast("bigint"))
    return out.drop(*(f"_k_{c}" for c in [*by, cell]), *(f"_o_{n}" for n in val))


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary array; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    if len(arr) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_slices(offsets: np.ndarray, limit: int = 1 << 20):
    """Index ranges of consecutive texts of about ``limit`` bytes each (one long text stands alone)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi
