"""Table scans.

Parquet is the native input; CSV is supported with an explicit schema (the
reference reads CSV).  Column projection is expressed as a ``select`` right
after the scan so Catalyst prunes it into the ``ReadSchema``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.exprs import nan_to_null

# The driver's test tables.
TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class MissingSourceError(FileNotFoundError):
    pass


def table_path(d: str, name: str) -> str:
    return f"{d.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, d: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """The table's columns; a float NaN is a missing value from here on."""
    df = spark.read.parquet(table_path(d, name))
    df = df.select(*columns) if columns else df
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def read_csv(spark: SparkSession, path: str, schema, columns: Sequence[str] | None = None,
             header: bool = True) -> DataFrame:
    """CSV scan with a declared schema (no inference pass); NaN text becomes NULL."""
    df = spark.read.schema(schema).option("header", header).option("nanValue", "NaN").csv(path)
    return df.select(*columns) if columns else df


def read_csv_apart(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that fit ``schema``, malformed lines) of a CSV scan.

    A line is malformed if a field does not parse as its type, or if it has more or fewer fields than the
    schema; all lines are in exactly one of the two tables (``line`` holds them as they stand).  Fields are parsed
    whatever columns are read later, so what counts as malformed does not depend on the query.
    """
    df = (spark.read.schema(f"{schema}, _malformed string").option("header", header).option("nanValue", "NaN")
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_malformed")
          .option("columnPruning", False).csv(path))
    # the scan refuses plans that read nothing but the malformed line: this is always true and reads a column
    reads = F.pmod(F.xxhash64(df.columns[0]), F.lit(2)) < 2
    good = df.where(F.col("_malformed").isNull() & reads).drop("_malformed")
    return good, df.where(F.col("_malformed").isNotNull() & reads).select(F.col("_malformed").alias("line"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store its scheme names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def missing_sources(spark: SparkSession, paths: dict[str, str]) -> list[str]:
    """Names whose path does not exist in its store (a listing, no data read)."""
    return [name for name, p in paths.items() if not path_exists(spark, p)]


def assert_sources_exist(spark: SparkSession, paths: dict[str, str]) -> None:
    missing = missing_sources(spark, paths)
    if missing:
        raise MissingSourceError("missing source tables: " + ", ".join(missing))


def table_inventory(spark: SparkSession, d: str, names: Sequence[str] = TEST_TABLES) -> DataFrame:
    """One row per table: present flag, row count and column count.
    Each count is a distributed job on that table; results are unioned."""
    parts = []
    for name in names:
        p = table_path(d, name)
        if path_exists(spark, p):
            df = spark.read.parquet(p)
            parts.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), F.lit(True).alias("present"),
                F.col("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")))
        else:
            parts.append(spark.range(1).select(
                F.lit(name).alias("table_name"), F.lit(False).alias("present"),
                F.lit(None).cast("bigint").alias("n_rows"),
                F.lit(None).cast("bigint").alias("n_columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
