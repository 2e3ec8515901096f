"""Column contract and data checks.

Schema checks are set logic on ``df.schema`` (no data pass).  Data checks are
one aggregate of ``count_if(rule)`` per rule, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    """Required columns with their role and feature group."""
    id_column: str
    target: str | None
    sensitive: str | None
    roles: Mapping[str, str] = field(default_factory=dict)   # column -> role
    groups: Mapping[str, str] = field(default_factory=dict)  # column -> feature group
    excluded: Sequence[str] = ()                             # present but never a model input

    def required(self) -> list[str]:
        cols = [self.id_column] + [c for c in (self.target, self.sensitive) if c]
        return cols + [c for c in self.roles if c not in cols]


def validate_columns(spark: SparkSession, columns: Sequence[str], contract: Contract,
                     strict: bool = False) -> DataFrame:
    """S3: ``(column, status)`` with status present / missing / unexpected
    (unexpected only reported in strict mode)."""
    have = list(columns)
    req = contract.required()
    rows = [(c, "present" if c in have else "missing") for c in req]
    if strict:
        rows += [(c, "unexpected") for c in have if c not in req]
    return spark.createDataFrame(rows, "column string, status string")


def assert_columns(columns: Sequence[str], contract: Contract, strict: bool = False) -> None:
    missing = [c for c in contract.required() if c not in columns]
    extra = [c for c in columns if c not in contract.required()] if strict else []
    if missing or extra:
        raise ContractError(f"missing columns: {missing}; unexpected columns: {extra}")


def contract_roles(spark: SparkSession, contract: Contract) -> DataFrame:
    """``(column, role, group, in_model)``."""
    rows = []
    for c in contract.required():
        role = ("id" if c == contract.id_column else "target" if c == contract.target
                else "sensitive" if c == contract.sensitive else contract.roles.get(c, "feature"))
        in_model = role not in ("id", "target", "sensitive") and c not in contract.excluded
        rows.append((c, role, contract.groups.get(c), in_model))
    return spark.createDataFrame(rows, "column string, role string, group string, in_model boolean")


def dup_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    if dup_keys(df, key).limit(1).count() > 0:
        raise ContractError(f"duplicated key values in {key}")


def domain_checks(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One aggregate counting the rows that break each rule -> ``(rule, violations)``.
    A rule is a boolean column that must be true; NULL counts as a violation."""
    one = df.agg(*[F.count_if(~F.coalesce(r, F.lit(False))).alias(f"_r{i}") for i, r in enumerate(rules.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("violations"))
                      for i, name in enumerate(rules)])
    return one.select(F.inline(pairs))


def binary_rule(c: str) -> Column:
    return F.col(c).isin(0, 1)


def non_negative_rule(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) >= 0)


def finite_rule(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(F.col(c)) & (F.abs(F.col(c)) != float("inf"))


def range_rule(c: str, lo: float, hi: float) -> Column:
    return F.col(c).between(lo, hi)


def raise_on_violations(report: DataFrame) -> None:
    bad = [r for r in report.collect() if r["violations"] > 0]  # one row per rule
    if bad:
        raise ContractError("; ".join(f"{r['rule']}: {r['violations']}" for r in bad))


def run_manifest(spark: SparkSession, params: Mapping[str, object], metrics: DataFrame | None = None) -> DataFrame:
    """Manifest row(s): run parameters as literal columns beside the metric
    row(s) of a small summary table (no join)."""
    items = sorted(params.items())
    if metrics is None:
        return spark.createDataFrame([tuple(str(v) for _, v in items)], ", ".join(f"{k} string" for k, _ in items))
    return metrics.select(*[F.lit(str(v)).alias(k) for k, v in items], "*")
