"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosine, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import cut, partitions
from riskframe.llm.components import components, local_roots

COSINE = 0.98
#: A pair at exactly the threshold is missed by all tables with at most this probability.
MISS = 1e-8
#: Vectors of one side of a block in which all pairs are compared.
BLOCK = 1024
#: Rows of one comparison task, about.
TASK_ROWS = 8192
SEED = 29


def table_shape(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits of a table, number of tables) for n vectors."""
    bits = min(28, max(10, math.ceil(math.log2(max(n, 2)))))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-same))


def sign_codes(x: np.ndarray, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """One integer of ``bits`` signs per row and table."""
    out = np.empty((len(x), tables), np.int32)
    weight = 1 << np.arange(bits)
    for t in range(tables):
        planes = np.random.default_rng((seed, t, x.shape[1])).standard_normal((x.shape[1], bits))
        out[:, t] = (x @ planes > 0) @ weight
    return out


def link_vectors(vectors: DataFrame, cosine: float = COSINE, miss: float = MISS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine in double precision is at
    least ``cosine``.  Vectors that are null, empty, zero or hold null or non-finite numbers, and
    vectors of different lengths, do not link.  Equal vectors of a label are one node with a count,
    so a large group of copies is one row; nodes that share a sign code in any table are compared in
    blocks of at most BLOCK x BLOCK, each pair in the first table in which it meets.  Blocks return
    link counts and a spanning star, never pairs.  Null ids take part; a component's id is its
    smallest id that is not null.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    fine = (F.col("label").isNotNull() & F.col("e").isNotNull()
            & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("e", lambda x: x != 0))
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    nodes = cut(rows.where("fine").groupBy("label", "e").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("m"))
                .withColumn("node", F.monotonically_increasing_id()))
    bits, tables = table_shape(nodes.count(), cosine, miss)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            at = np.concatenate(([0], np.cumsum(size)))
            got = np.zeros((len(size), tables), np.int32)
            raw: list[bytes] = [b""] * len(size)
            for d in np.unique(size):
                pick = np.flatnonzero(size == d)
                x = flat[at[pick][:, None] + np.arange(d)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                got[pick] = sign_codes(x, bits, tables)
                for i, r in zip(pick, x):
                    raw[i] = r.astype("<f8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary()),
                 pa.ListArray.from_arrays(np.arange(len(size) + 1, dtype=np.int32) * tables, pa.array(got.ravel())),
                 batch.column(2), batch.column(3), pa.array(size.astype(np.int32))],
                ["node", "x", "codes", "m", "label", "d"])

    hashed = cut(nodes.select("node", "e", "m", F.col("label").cast("string").alias("label")).mapInArrow(
        codes, "node bigint, x binary, codes array<int>, m bigint, label string, d int"))
    key = F.xxhash64("t", "label", "d", "code")
    placed = hashed.select("node", "label", "d", F.posexplode("codes").alias("t", "code")).select(
        "node", "t", key.alias("key"))
    shared = placed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    found = placed.join(shared, ["t", "key"])
    found = found.withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    found = found.withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), "blocks"))
    found = found.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    found = cut(found.select("node", "t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own"))
    n_tasks = max(partitions(spark), -(-found.count() // TASK_ROWS))
    cell = F.pmod(F.xxhash64("t", "key", "i", "j"), F.lit(n_tasks)).cast("int")

    def compare(_, frame):
        frame = frame.sort_values(["t", "key", "i", "j", "node"], kind="stable").reset_index(drop=True)
        k = frame[["t", "key", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(axis=1))))
        node, m, own = frame["node"].to_numpy(), frame["m"].to_numpy(), frame["own"].to_numpy()
        label, dims = frame["label"].to_numpy(), frame["d"].to_numpy()
        code = np.stack(frame["codes"].to_numpy())
        raw = frame["x"].to_list()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for lo, hi in zip(starts, np.concatenate((starts[1:], [len(frame)]))):
            if hi - lo < 2:
                continue
            t, i, j = int(k[lo, 0]), k[lo, 2], k[lo, 3]
            left = np.arange(lo, hi)[own[lo:hi] == i]
            right = np.arange(lo, hi)[own[lo:hi] == j]
            if not len(left) or not len(right) or len({*dims[lo:hi]}) > 1:
                continue  # lengths differ only where two keys collide; such vectors meet in no other way
            x = np.stack([np.frombuffer(raw[r], "<f8") for r in left])
            y = x if i == j else np.stack([np.frombuffer(raw[r], "<f8") for r in right])
            cos = x @ y.T
            cos /= np.sqrt((x * x).sum(1))[:, None]
            cos /= np.sqrt((y * y).sum(1))[None, :]
            a, b = np.nonzero(cos >= cosine)
            a, b = left[a], right[b]
            ok = (a < b) if i == j else np.ones(len(a), bool)
            a, b = a[ok], b[ok]
            ok = (label[a] == label[b])
            ok &= (code[a, t] == code[b, t]) & ~(code[a, :t] == code[b, :t]).any(axis=1)
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            n = hi - lo
            links = np.bincount(a - lo, weights=m[b], minlength=n) + np.bincount(b - lo, weights=m[a], minlength=n)
            root = local_roots(n, a - lo, b - lo)
            has = np.flatnonzero(links)
            out.append((node[lo + has], links[has].astype(np.int64), node[lo + root[has]]))
        if not out:
            return pd.DataFrame({"node": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(("node", "links", "root"), zip(*out))})

    linked = cut(found.join(hashed, "node").groupBy(cell.alias("cell"))
                 .applyInPandas(compare, "node bigint, links bigint, root bigint"))
    joined = components(linked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    degree = linked.groupBy("node").agg(F.sum("links").alias("links"))
    known = (nodes.join(degree, "node", "left").join(joined, "node", "left")
             .select("node", "label", "e", "low", "m", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("root", "node").alias("root")))
    lowest = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = known.join(lowest, "root").select(
        F.col("label").alias("_l"), F.col("e").alias("_e"), (F.col("links") + F.col("m") - 1).alias("n_links"), "component_id")
    out = rows.join(known, F.col("fine") & (F.col("label") == F.col("_l")) & (F.col("e") == F.col("_e")), "left")
    comp = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), comp.alias("component_id"),
                      F.col("vec_id").eqNullSafe(comp).alias("kept"))


def op2(spark, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding"))


def op2_sql(cosine: float = COSINE) -> str:
    """All pairs and a recursive closure: for small tables only."""
    return f"""
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= {cosine}),
reach as (
  select vec_id as node, vec_id as low from embeddings
  union
  select l.b, r.low from reach r join links l on l.a = r.node where r.low < l.b),
comp as (select node, min(low) as component_id from reach group by node),
degree as (select a, count(*) as n from links group by a)
select c.node as vec_id, coalesce(d.n, 0)::bigint as n_links, c.component_id, c.node = c.component_id as kept
from comp c left join degree d on d.a = c.node
"""
