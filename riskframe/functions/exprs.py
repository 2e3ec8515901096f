"""Null-safe column expressions.

The reference computes in pandas, where NaN means "missing", division by zero
yields inf (later turned into NaN) and group sums of all-missing values are 0.
These helpers give the same answers with built-in Spark expressions so that
everything stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_or",
    "nan_to_null",
    "safe_ratio",
    "ratio_plus_one",
    "clip_lower",
    "clip_range",
    "flag_gt",
    "flag_eq",
    "not_equal_keep_null",
    "row_mean",
    "row_std",
    "row_min",
    "row_max",
    "row_null_count",
    "row_sum_skipna",
    "product",
    "fixed_bins",
    "sigmoid",
    "gated",
    "sum0",
    "days_between",
]


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """Float NaN is the largest value in Spark; the reference treats it as missing."""
    x = col_or(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den with NULL instead of +-inf or an ANSI error."""
    return F.try_divide(col_or(num).cast("double"), col_or(den).cast("double"))


def ratio_plus_one(num: str | Column, den: str | Column) -> Column:
    """The reference's ratio ``num / (den + 1)``; den = -1 gives NULL."""
    return safe_ratio(num, col_or(den).cast("double") + F.lit(1.0))


def clip_lower(c: str | Column, lower: float = 0.0) -> Column:
    """pandas ``clip(lower=...)``: NULL stays NULL (``greatest`` would not)."""
    x = col_or(c)
    return F.when(x < F.lit(lower), F.lit(lower)).otherwise(x)


def clip_range(c: str | Column, lower: float, upper: float) -> Column:
    x = col_or(c)
    return (F.when(x < F.lit(lower), F.lit(lower))
             .when(x > F.lit(upper), F.lit(upper))
             .otherwise(x))


def flag_gt(c: str | Column, threshold: float = 0.0) -> Column:
    """``(x > t)`` as 0/1 where a missing x gives 0."""
    return F.coalesce(col_or(c) > F.lit(threshold), F.lit(False)).cast("int")


def flag_eq(c: str | Column, value) -> Column:
    return F.coalesce(col_or(c) == F.lit(value), F.lit(False)).cast("int")


def not_equal_keep_null(c: str | Column, value) -> Column:
    """pandas ``s != v`` keeps missing rows; SQL ``<>`` would drop them."""
    return ~col_or(c).eqNullSafe(F.lit(value))


def _present(cols: Sequence[str | Column]) -> Column:
    arr = F.array(*[col_or(c).cast("double") for c in cols])
    return F.filter(arr, lambda x: x.isNotNull())


def row_mean(cols: Sequence[str | Column]) -> Column:
    p = _present(cols)
    total = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(p) > 0, total / F.size(p))


def row_std(cols: Sequence[str | Column]) -> Column:
    """Sample std over the non-missing values; fewer than two values give NULL."""
    p = _present(cols)
    n = F.size(p)
    mean = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x) / n
    ss = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(n > 1, F.sqrt(ss / (n - 1)))


def row_min(cols: Sequence[str | Column]) -> Column:
    return F.least(*[col_or(c).cast("double") for c in cols])


def row_max(cols: Sequence[str | Column]) -> Column:
    return F.greatest(*[col_or(c).cast("double") for c in cols])


def row_null_count(cols: Iterable[str | Column]) -> Column:
    terms = [col_or(c).isNull().cast("int") for c in cols]
    if not terms:
        return F.lit(0)
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def row_sum_skipna(cols: Sequence[str | Column]) -> Column:
    """pandas ``sum(axis=1)``: missing values skipped, all missing gives 0."""
    terms = [F.coalesce(col_or(c).cast("double"), F.lit(0.0)) for c in cols]
    if not terms:
        return F.lit(0.0)
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def product(cols: Sequence[str | Column]) -> Column:
    """Product that propagates missing values like pandas ``*``."""
    out = col_or(cols[0]).cast("double")
    for c in cols[1:]:
        out = out * col_or(c).cast("double")
    return out


def fixed_bins(c: str | Column, edges: Sequence[float]) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]`` labelled by index; outside gives NULL."""
    x = col_or(c)
    expr = None
    for i in range(len(edges) - 1):
        cond = (x > F.lit(edges[i])) & (x <= F.lit(edges[i + 1]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def sigmoid(c: str | Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_or(c)))


def gated(cond: Column, expr: Column) -> Column:
    """Value of a subset block: NULL when the key has no row in the subset."""
    return F.when(F.count_if(cond) > 0, expr)


def sum0(c: str | Column) -> Column:
    """pandas group ``sum``: all-missing gives 0."""
    return F.coalesce(F.sum(col_or(c)), F.lit(0))


def days_between(ts: str | Column, reference_date: str) -> Column:
    """Signed whole days from ``reference_date`` to the date of ``ts`` (negative = before)."""
    return F.datediff(F.to_date(col_or(ts)), F.lit(reference_date).cast("date"))
