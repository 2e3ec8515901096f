"""Committed runs (S7, S8): the tables of a run become visible together, by one row of a manifest.

A run writes its tables below ``<root>/data`` in a folder of its own name, which nobody reads yet.  The last
step appends one row to ``<root>/manifest``: a single file that the file system's commit puts in place as a whole.
Readers start from the manifest, so they see all tables of a run or none; what a run that died has left is not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.sources.sinks import append_manifest, write_table

SCHEMA = "run_id string, committed_at timestamp, folder string, tables map<string,bigint>, params map<string,string>"


class RunError(ValueError):
    pass


def committed(spark: SparkSession, root: str) -> DataFrame:
    """The manifest: one row per committed run (no rows if there is none)."""
    try:
        return spark.read.schema(SCHEMA).parquet(f"{root}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def write_run(spark: SparkSession, root: str, run_id: str, tables: Mapping[str, DataFrame], params: Mapping[str, object] = {}) -> DataFrame:
    """Write all ``tables`` and commit them under ``run_id``; returns the run's manifest row.

    A run id is committed once.  A run that failed before can be started again under its id: it writes to a new folder.
    """
    if not tables:
        raise RunError("a run has one table at least")
    if not run_id.strip() or committed(spark, root).where(F.col("run_id") == run_id).take(1):
        raise RunError(f"the run id is empty or already committed: {run_id!r}")
    folder = f"{root}/data/{uuid.uuid4().hex}"
    counts = {}
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", mode="errorifexists")
        counts[name] = spark.read.parquet(f"{folder}/{name}").count()
    row = spark.createDataFrame([(run_id, None, folder, counts, {k: str(v) for k, v in params.items()})], SCHEMA)
    append_manifest(row.withColumn("committed_at", F.current_timestamp()).coalesce(1), f"{root}/manifest")
    return committed(spark, root).where(F.col("run_id") == run_id)


def read_run(spark: SparkSession, root: str, run_id: str) -> dict[str, DataFrame]:
    """The tables of a committed run; a run whose row counts differ from its manifest is refused."""
    found = committed(spark, root).where(F.col("run_id") == run_id).collect()  # at most one row
    if not found:
        raise RunError(f"no committed run {run_id!r}")
    out = {}
    for name, n in found[0]["tables"].items():
        out[name] = spark.read.parquet(f"{found[0]['folder']}/{name}")
        if out[name].count() != n:
            raise RunError(f"{run_id}/{name}: {n} rows were committed")
    return out
