"""Registered queries of the numbered operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import (conversation_repair, embed_dedup, fingerprint, language_id, mixing, near_dedup, pieces, shards,
                           suffix_dedup, token_files, toxicity, url_filter, whitening)
from riskframe.llm.common import prepare

OPERATORS = {
    "op1_suffix_dedup": suffix_dedup.op1,
    "op2_embedding_dedup": embed_dedup.op2,
    "op3_url_filter": url_filter.op3,
    "op4_token_files": token_files.op4,
    "op5_toxicity": toxicity.op5,
    "op6_sentencepiece": pieces.op6,
    "op7_fingerprints": fingerprint.op7,
    "op8_byte_shards": shards.op8,
    "op9_mixing": mixing.op9,
    "op10_near_dedup": near_dedup.op10,
    "op11_conversation_repair": conversation_repair.op11,
    "op12_language_id": language_id.op12,
    "op13_whitening": whitening.op13,
}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return run(spark, sf_dir)

    return query


QUERIES = {name: _query(run) for name, run in OPERATORS.items()}
ORACLE = {
    "op2_embedding_dedup": embed_dedup.op2_sql(),
    "op9_mixing": mixing.op9_sql(),
    "op10_near_dedup": near_dedup.op10_sql(),
}
