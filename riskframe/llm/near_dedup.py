"""Near-duplicate documents: bottom-k sketches of one hash function, inverted lists, exact Jaccard."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import byte_slices, cut, partitions, text_buffer, unused
from riskframe.llm.components import components, local_roots
from riskframe.llm.shingles import shingle_sets

#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Values of a sketch.
SKETCH_K = 64
#: Values that two sketches share at least if their texts link.  64 draws at 0.75 give 48 on average;
#: fewer than 26 has a probability below 1e-9.
SHARED_LEAST = 26
#: Documents of one side of a block in which all pairs are compared, and of a pivot's group.
BLOCK = 1024
#: Shingles of one comparison task, about.
TASK_VALUES = 1_000_000
#: Bits of the filter by which a scan finds the documents that need their full sets.
FILTER_BITS = 1 << 24
#: Columns of one slab of the membership matrix.
SLAB = 4096


def signatures(docs: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """doc_id, text_hash, n_shingles, h1, h2 (a 128-bit digest of the shingle set) and sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            for lo, hi in byte_slices(off):
                o, v = shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                raw = v.astype("<u8").tobytes()
                sets = [raw[8 * a:8 * b] for a, b in zip(o[:-1], o[1:])]
                keys = np.frombuffer(b"".join(hashlib.blake2b(s, digest_size=16).digest() for s in sets), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(np.diff(o)), pa.array(keys[:, 0].copy()),
                     pa.array(keys[:, 1].copy()), pa.array([s[:8 * k] for s in sets], pa.binary())],
                    ["doc_id", "text_hash", "n_shingles", "h1", "h2", "sketch"])

    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(
        run, "doc_id bigint, text_hash bigint, n_shingles bigint, h1 bigint, h2 bigint, sketch binary")


def wanted(n):
    """Values that the sketch of a text of n shingles shares at least with that of any linked text."""
    return F.least(F.ceil(n * PERCENT / 100), F.lit(SHARED_LEAST)).cast("int")


def inverted_lists(nodes: DataFrame) -> DataFrame:
    """(value, node): for each node the rarest sketch values, enough to meet every linked node once.

    Two sketches that share t values have one in common among the first size - t + 1 of either in
    any fixed order; here: rarest first.  Values that no other node has need no list, so frequent
    passages are listed only for texts that consist mostly of them.
    """
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffer(batch.column(2))
            size = np.diff(off) // 8
            node = np.repeat(batch.column(0).to_numpy(), size)
            n = np.repeat(batch.column(1).to_numpy(), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(n), pa.array(np.repeat(size, size).astype(np.int32)),
                 pa.array(np.ascontiguousarray(data).view("<i8"))], ["node", "n", "size", "value"])

    values = nodes.select("node", "n_shingles", "sketch").mapInArrow(explode, "node bigint, n bigint, size int, value bigint")
    common = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = values.join(common, "value")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "value"))
    alone = F.col("size") - F.count(F.lit(1)).over(Window.partitionBy("node"))
    held = held.select("node", "value", "n", "size", rank.alias("rank"), alone.alias("alone"))
    return (held.where(F.col("alone") + F.col("rank") <= F.col("size") - wanted(F.col("n")) + 1)
            .select("value", "node"))


def filter_bits(ids: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of hashed ids; ``bits`` bounds its size whatever the number of ids."""
    h = (F.pmod(F.xxhash64("id"), F.lit(bits)) + 1)
    got = (ids.select(h.alias("h")).groupBy(F.expr("bitmap_bucket_number(h)").alias("b"))
           .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("m")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in got:
        lo = (r["b"] - 1) * 4096
        out[lo:lo + 4096] = np.frombuffer(r["m"], np.uint8)[:len(out) - lo]
    return out


def full_sets(docs: DataFrame, wanted_ids: DataFrame) -> DataFrame:
    """doc_id, set (sorted 64-bit values) of the documents whose ids are in ``wanted_ids`` (column id).

    A second scan of the texts; a fixed-size bitmap keeps most other documents from being hashed,
    a join by id removes the rest.
    """
    bitmap = filter_bits(wanted_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(2).to_numpy()
            keep = (bitmap[h >> 3] >> (h & 7).astype(np.uint8)) & 1
            batch = batch.filter(pa.array(keep.astype(bool)))
            data, off = text_buffer(batch.column(1))
            for lo, hi in byte_slices(off):
                o, v = shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                raw = v.astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([raw[8 * a:8 * b] for a, b in zip(o[:-1], o[1:])], pa.binary())],
                    ["doc_id", "set"])

    rows = docs.where("doc_id is not null").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("h"))
    return rows.mapInArrow(run, "doc_id bigint, set binary")


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of sets[left] x sets[right], by slabs of a membership matrix."""
    used = np.unique(np.concatenate((left, right)))
    size = np.array([len(sets[i]) for i in used])
    owner = np.repeat(np.arange(len(used)), size)
    value, col, times = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    shared = times[col] > 1
    owner, col = owner[shared], col[shared]
    _, col = np.unique(col, return_inverse=True)
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    at_l, at_r = np.searchsorted(used, left), np.searchsorted(used, right)
    out = np.zeros((len(left), len(right)), np.int64)
    n_cols = int(col[-1]) + 1 if len(col) else 0
    for lo in range(0, n_cols, SLAB):
        a, b = np.searchsorted(col, [lo, lo + SLAB])
        x = np.zeros((len(used), min(SLAB, n_cols - lo)), np.float32)
        x[owner[a:b], col[a:b] - lo] = 1
        out += np.rint(x[at_l] @ x[at_r].T).astype(np.int64)
    return out


def sketch_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, k: int = SKETCH_K) -> tuple[np.ndarray, np.ndarray]:
    """For all pairs of different sets of left x right: (values both sketches retain, size of the pair's union sketch).

    The union sketch holds what either sketch retains up to the smaller of their largest values: both
    are complete up to there, so shared / size estimates the likeness.  A sketch of fewer than k values is
    its whole set and complete everywhere.  The union sketch has k values or more unless both are whole sets.
    """
    sketches = [s[:k] for s in sets]
    shared = overlaps(sketches, left, right)
    end = np.array([s[-1] if len(s) == k else np.uint64(2 ** 64 - 1) for s in sketches], np.uint64)
    rows = np.stack([np.searchsorted(sketches[i], np.minimum(end[i], end[right]), side="right") for i in left])
    cols = np.stack([np.searchsorted(sketches[j], np.minimum(end[j], end[left]), side="right") for j in right], axis=1)
    return shared, rows + cols - shared


def alike(shared: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the estimate from the union sketch is SHARED_LEAST of SKETCH_K or more.

    A pair of likeness 0.75 fails with a probability below 2e-8, whatever the size of its union sketch.
    """
    return shared * SKETCH_K >= SHARED_LEAST * size


def _empty(**kinds: str) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(dtype=k) for c, k in kinds.items()})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_hash (xxhash64 of the text).

    A document's set: the distinct 5-word shingles of its whole text (A-Z lower-cased, words
    ``[^\\x20\\x09-\\x0D]+``); with fewer words the whole sequence; none without words, which links
    with nothing.  Documents link if 100 * intersection >= 75 * union.  component_id is the smallest
    doc_id reachable, so equal texts always share one; kept marks the document that has it.

    Equal sets are one node (copies are never paired).  Each node's sketch is its 64 smallest
    hashes.  Inverted lists of retained values join nodes to clusters; within a cluster nodes are
    verified on full sets, first against a pivot.  What the pivot leaves open is compared in blocks:
    the lists of the block's retained values give the overlaps of its sketches, the estimate from
    the union sketch filters, full sets verify.  Links that exist are missed only if two sketches
    share less than 26 values at a likeness of 0.75, or 26/64 of their union sketch (below 2e-8).
    Null ids take part (a set that only null ids have is a node without links); repeated rows of an
    id have the same component if their texts do.  An empty table gives an empty result.
    """
    rows = cut(signatures(docs))
    nodes = cut(rows.where("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("low"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()))
    links = link_nodes(docs, nodes.where("low is not null"))
    root = nodes.select("node", "h1", "h2", "low").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = root.groupBy("root").agg(F.min("low").alias("component_id"))
    named = root.join(lowest, "root").select(F.col("h1").alias("_1"), F.col("h2").alias("_2"), "component_id")
    out = rows.select("doc_id", "text_hash", "n_shingles", "h1", "h2").join(
        named, (F.col("n_shingles") > 0) & (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")), "left")
    comp = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"), "text_hash")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) with one document of each group of near-duplicates.

    Of equal rows (id and text), one stays.  Only the rows to leave are joined by id and text hash.  Null and
    empty texts are near no other text; null ids are ids like others.  Columns may have any names: inner ones are
    called otherwise.
    """
    own, text, hashed = unused(docs, "own", "hashed", "text_of")
    judged = cut(near_duplicates(docs).groupBy("doc_id", "text_hash").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).where("not kept or rows > 1"))

    def marked(which: str) -> DataFrame:
        return judged.where(which).select(F.col("doc_id").alias(own), F.col("text_hash").alias(text))

    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64("text") == F.col(text))
    once = docs.join(marked("true"), same, "left_anti")
    again = docs.join(marked("kept"), same, "left_semi").withColumn(hashed, F.xxhash64("text"))
    return once.unionByName(again.dropDuplicates(["doc_id", hashed]).drop(hashed))


def link_nodes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root) of all nodes that link with another one."""
    spark = docs.sparkSession
    lists = cut(inverted_lists(nodes))
    heads = lists.groupBy("value").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    clusters = components(lists.join(heads, "value").select(F.col("node").alias("u"), "v"))
    member = nodes.select("node", "low").join(clusters.withColumnRenamed("root", "cluster"), "node")
    # a node has the set of the row with its smallest id; repeated ids with other texts drop out by the digest
    member = cut(member.join(nodes.select("node", "h1", "h2"), "node"))
    sets = full_sets(docs, member.select(F.col("low").alias("id")))
    digest = _digest()
    sets = sets.join(member.select(F.col("low").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = sets.withColumn("d", digest("set"))
    sets = (sets.join(member, (F.col("doc_id") == F.col("low")) & (F.col("d")["h1"] == F.col("h1")) & (F.col("d")["h2"] == F.col("h2")))
            .groupBy("cluster", "node").agg(F.first("set").alias("set")))
    sets = cut(sets)
    sizes = sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot"),
                                        F.sum(F.length("set") / 8).alias("values"))
    sizes = cut(sizes)
    total = sizes.agg(F.coalesce(F.sum("values"), F.lit(0))).head()[0]
    n_tasks = max(partitions(spark), int(total // TASK_VALUES))

    # 1. every node against its cluster's pivot, in groups of BLOCK nodes that each get a copy of the pivot
    sized = sets.join(sizes.drop("values"), "cluster").withColumn("groups", F.ceil(F.col("size") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("node", F.lit(7)), "groups").cast("int")
    dealt = sized.withColumn("group", F.explode(F.when(
        F.col("node") == F.col("pivot"), F.sequence(F.lit(0), F.col("groups") - 1)).otherwise(F.array(own))))
    cell = F.pmod(F.xxhash64("cluster", "group"), F.lit(n_tasks)).cast("int")

    def against_pivot(_, frame):
        got = []
        for (cluster, _), part in frame.groupby(["cluster", "group"], sort=False):
            node = part["node"].to_numpy()
            raw = part["set"].to_list()
            at = int(np.flatnonzero(node == part["pivot"].iloc[0])[0])
            pivot = np.frombuffer(raw[at], "<u8")
            size = np.array([len(r) // 8 for r in raw])
            value = np.frombuffer(b"".join(raw), "<u8")
            pos = np.minimum(np.searchsorted(pivot, value), len(pivot) - 1)
            both = np.bincount(np.repeat(np.arange(len(node)), size), weights=pivot[pos] == value, minlength=len(node))
            union = size + len(pivot) - both
            got.append(pd.DataFrame({"node": node, "cluster": cluster, "pivot": node[at], "both": both.astype("int64"),
                                     "near": 100 * both >= PERCENT * union}))
        return pd.concat(got)[["node", "cluster", "pivot", "both", "near"]]

    first = cut(dealt.select("cluster", "group", "pivot", "node", "set").groupBy(cell.alias("cell"))
                .applyInPandas(against_pivot, "node bigint, cluster bigint, pivot bigint, both bigint, near boolean")
                .distinct())
    # 2. clusters with nodes that the pivot left open: blocks of all pairs but those the pivot already joined
    open_ = first.groupBy("cluster").agg(F.count(F.when(~F.col("near"), 1)).alias("open")).where("open > 0")
    rest = (sets.join(first.select("node", "near"), "node").join(open_, "cluster").join(sizes.drop("pivot", "values"), "cluster")
            .where("size > 2").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")))
    own = F.pmod(F.xxhash64("node", F.lit(11)), "blocks").cast("int")
    rest = rest.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("cluster", "node", "set", "near", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    cell = F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(n_tasks)).cast("int")

    def all_pairs(_, frame):
        out_n, out_r = [], []
        for (_, i, j), part in frame.groupby(["cluster", "i", "j"], sort=False):
            node, own, near = part["node"].to_numpy(), part["own"].to_numpy(), part["near"].to_numpy()
            sets_ = [np.frombuffer(r, "<u8") for r in part["set"]]
            size = np.array([len(s) for s in sets_])
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            if near.all() or not len(left) or not len(right):
                continue
            least = np.minimum(np.minimum(-(-size[left][:, None] * PERCENT // 100), -(-size[right][None, :] * PERCENT // 100)), SHARED_LEAST)
            shared, union_size = sketch_counts(sets_, left, right)
            maybe = (shared >= least) & alike(shared, union_size)
            maybe &= ~(near[left][:, None] & near[right][None, :])
            if i == j:
                maybe &= left[:, None] < right[None, :]
            rows_, cols = maybe.any(axis=1), maybe.any(axis=0)
            if not rows_.any():
                continue
            left, right, maybe = left[rows_], right[cols], maybe[np.ix_(rows_, cols)]
            both = overlaps(sets_, left, right)
            union = size[left][:, None] + size[right][None, :] - both
            a, b = np.nonzero(maybe & (100 * both >= PERCENT * union))
            root = local_roots(len(node), left[a], right[b])
            moved = np.flatnonzero(root != np.arange(len(node)))
            out_n.append(node[moved])
            out_r.append(node[root[moved]])
        if not out_n:
            return _empty(u="int64", v="int64")
        return pd.DataFrame({"u": np.concatenate(out_n), "v": np.concatenate(out_r)})

    second = rest.groupBy(cell.alias("cell")).applyInPandas(all_pairs, "u bigint, v bigint")
    direct = first.where("near and node != pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v"))
    return components(direct.unionByName(second))


def _digest():
    @F.pandas_udf("h1 bigint, h2 bigint")
    def digest(s: pd.Series) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in s), "<i8").reshape(-1, 2)
        return pd.DataFrame({"h1": keys[:, 0], "h2": keys[:, 1]})

    return digest


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).drop("text_hash")


def op10_sql() -> str:
    """All pairs that share a shingle and a recursive closure: for small tables only."""
    return f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then []
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end as s from w),
one as (select doc_id, len(s) as n, unnest(s) as s from sets),
links as (
  select a.doc_id as a, b.doc_id as b from one a join one b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reach as (
  select doc_id as node, doc_id as low from documents
  union
  select l.b, r.low from reach r join links l on l.a = r.node where r.low < l.b),
comp as (select node, min(low) as component_id from reach group by node)
select s.doc_id, len(s.s)::bigint as n_shingles, c.component_id, s.doc_id = c.component_id as kept
from sets s join comp c on c.node = s.doc_id
"""
