"""A training-data pipeline over ``documents``: every stage is one of the numbered operators.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``.  ``run`` writes each stage's rows as Parquet in the shared folder and reads them
again, so a lost executor repeats at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import mixing, near_dedup, pieces, suffix_dedup, toxicity
from riskframe.llm.common import prepare, shared_path

#: The stages involve trained weights, hashing and tokenizer tables: tested against brute force instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or score is below the threshold; labels of the training folds only."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.keep_clean(docs, *toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, likeness 0.75 or more)."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that also stand elsewhere."""
    prepare(spark)
    return suffix_dedup.remove_repeated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixing schedule takes them."""
    prepare(spark)
    return mixing.apply_mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and ids of every document that is left."""
    prepare(spark)
    return pieces.with_ids(docs, pieces.default_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeated_passages),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
