"""Sinks (S7): result tables are written by the executors, never collected.

Large tables go to parquet; small report tables may also go to a single CSV
file (``coalesce(1)`` only for tables whose size is fixed by parameters).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, *, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_small_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV file for a report table (one row per model / metric / split)."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def append_manifest(df: DataFrame, path: str) -> None:
    """Append one manifest row to a run log table."""
    df.write.mode("append").parquet(path)
