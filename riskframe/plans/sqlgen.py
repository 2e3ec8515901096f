"""Small helpers that write the DuckDB oracle SQL for wide aggregates.

Only text is produced here; the SQL runs in DuckDB, never in Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def sql_stat(stat: str, x: str, kind: str) -> str:
    stat = stat.lower()
    if stat == "mean":
        return f"avg({x})"
    if stat in ("max", "min"):
        return f"{stat}({x})"
    if stat == "sum":
        t = "BIGINT" if kind == "int" else "DOUBLE"
        return f"CAST(coalesce(sum({x}), 0) AS {t})"
    if stat == "count":
        return f"count({x})"
    if stat == "std":
        return f"stddev_samp({x})"
    raise ValueError(stat)


def gate(cond: str | None, expr: str) -> str:
    if cond is None:
        return expr
    return f"CASE WHEN sum(CASE WHEN {cond} THEN 1 ELSE 0 END) > 0 THEN {expr} END"


def val(cond: str | None, col: str) -> str:
    return col if cond is None else f"CASE WHEN {cond} THEN {col} END"


def sql_block(prefix: str, cols: Mapping[str, str], stats: Sequence[str],
              cond: str | None = None) -> list[str]:
    """``{prefix}_{col}_{STAT}`` expressions; ``cols`` maps column -> 'int' | 'double'."""
    out = []
    for c, kind in cols.items():
        for s in stats:
            out.append(f"{gate(cond, sql_stat(s, val(cond, c), kind))} AS {prefix}_{c}_{s.upper()}")
    return out


def codes_cte(name: str, source: str, col: str) -> str:
    """Sorted-vocabulary label codes of one string column (missing -> 'nan')."""
    return (f"{name} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
            f"FROM (SELECT DISTINCT coalesce({col}, 'nan') AS v FROM {source}))")


def encode_ctes(prefix: str, source: str, cols: Sequence[str], out: str) -> str:
    """CTEs that replace ``cols`` of ``source`` by their label codes as ``out``."""
    ctes = [codes_cte(f"{prefix}_{c}", source, c) for c in cols]
    repl = ", ".join(f"{prefix}_{c}.code AS {c}" for c in cols)
    joins = " ".join(f"LEFT JOIN {prefix}_{c} ON coalesce({source}.{c}, 'nan') = {prefix}_{c}.v"
                     for c in cols)
    ctes.append(f"{out} AS (SELECT {source}.* REPLACE ({repl}) FROM {source} {joins})")
    return ",\n".join(ctes)


def ratio1(num: str, den: str) -> str:
    """The reference ratio num / (den + 1) with NULL on a zero denominator."""
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE) + 1, 0))"


def clip0(x: str) -> str:
    return f"CAST(CASE WHEN {x} < 0 THEN 0 ELSE {x} END AS DOUBLE)"


def flag_gt0(x: str) -> str:
    return f"CAST(coalesce({x} > 0, false) AS INTEGER)"
