"""Sharding: contiguous, byte-balanced shards from global prefix sums of sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import cell_of, cut, id_splits, running_totals

#: Bytes that a row costs besides its text.
ROW_BYTES = 16


def byte_shards(docs: DataFrame, n_shards: int, row_bytes: int = ROW_BYTES) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    Documents stand in ascending doc_id order (null ids first, repeated ids by checksum and size).
    Cells of the id range give per-cell byte totals; their prefix sums place every document in one
    global byte line, which is cut at equal targets: a document belongs to the shard in which its
    middle byte falls.  Sizes differ by one document at most.  A null text has size ``row_bytes``
    and checksum 0; an empty table gives an empty result.  Only (id, size, checksum) are moved.
    """
    rows = docs.select(
        "doc_id",
        (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + F.lit(row_bytes)).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("cell", cell_of(F.col("doc_id"), id_splits(docs, "doc_id")))
    rows = cut(rows)
    order = [F.asc_nulls_first("doc_id"), F.asc("text_crc32"), F.asc("size")]
    placed = running_totals(rows, "cell", order, {"size": "before", "1": "rank"})
    total = rows.agg(F.sum("size").alias("total"))
    target = ((F.col("before") * 2 + F.col("size")) * n_shards / (F.col("total") * 2)).cast("int")
    placed = cut(placed.crossJoin(total).withColumn("shard", F.least(target, F.lit(n_shards - 1))).drop("total", "cell"))
    starts = placed.groupBy("shard").agg(F.min("rank").alias("_first")).withColumnRenamed("shard", "_shard")
    return (placed.join(starts, F.col("shard") == F.col("_shard"))
            .select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("_first")).alias("slot")))


def op8(spark, sf_dir: str, n_shards: int = 40) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return byte_shards(docs, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
