"""Relational aggregation: many history rows -> one wide row per customer.

Design (R1-R16):
* Each source is read once and grouped once.  The reference's subset blocks
  (all / active / closed, all / recent, all / approved / refused) become
  conditional aggregates inside that single ``groupBy``; every subset
  expression is gated so that a key with no row in the subset gets NULL for the
  whole block, while a key whose subset values are all missing gets sum 0 and
  count 0 (T5, T19).
* Feature lists are planned from ``df.schema`` on the driver (schema-adaptive):
  a feature is emitted only when its inputs exist.
* String columns are label-encoded per source before aggregation (T20).
* Every block comes out of ``groupBy(key)`` and is therefore already hash
  partitioned on the key; the final left joins reuse that partitioning.
* A block has hundreds of aggregates: a partial row is many times larger than
  a source row, and a task would hold one for every key that it meets.  So rows are
  dealt by key before they are grouped: a task holds its own keys only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.exprs import (
    clip_lower, flag_gt, gated, ratio_plus_one, sum0,
)
from riskframe.operators.encode import label_encode, string_columns

KEY = "SK_ID_CURR"
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)

# Monthly status codes of a credit history ("X" = unknown).
STATUS_CODES = {"0": 0.0, "1": 1.0, "2": 2.0, "3": 3.0, "4": 4.0, "5": 5.0, "C": 0.0, "X": None}
# The date sentinel meaning "not available".
DAYS_SENTINEL = 365243


class RelationalError(ValueError):
    pass


def _group(frame: DataFrame, exprs: list) -> DataFrame:
    """One row per key; a source without any usable column yields only its ids."""
    if not exprs:
        return frame.select(KEY).distinct()
    return frame.repartition(KEY).groupBy(KEY).agg(*exprs)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def _stat(stat: str, x: Column) -> Column:
    stat = stat.lower()
    if stat == "mean":  # shares the buffers of the block's sum and count
        return F.try_divide(F.sum(x).cast("double"), F.count(x))
    if stat == "max":
        return F.max(x)
    if stat == "min":
        return F.min(x)
    if stat == "sum":
        return sum0(x)
    if stat == "count":
        return F.count(x)
    if stat == "std":
        return F.stddev_samp(x)
    raise RelationalError(f"unknown statistic: {stat}")


def _stat_of_halves(stat: str, x: Column, half: Column) -> Column:
    """The statistic over all rows; all but the sum from the buffers of the two halves."""
    a, b = F.when(half, x), F.when(~half, x)
    if stat == "mean":
        return F.try_divide(F.sum(x).cast("double"), F.count(a) + F.count(b))
    join = {"max": F.greatest, "min": F.least, "count": lambda m, n: m + n}.get(stat)
    return join(_stat(stat, a), _stat(stat, b)) if join else _stat(stat, x)


def numeric_block(prefix: str, cols: Sequence[str], stats: Sequence[str],
                  cond: Column | None = None, halves: Column | None = None) -> list[Column]:
    """``{prefix}_{col}_{STAT}`` aggregate expressions, optionally over a subset.

    ``halves``: a condition, never NULL, whose two subsets have blocks of their own in the same ``groupBy``: counts
    and extremes over all rows are put together from theirs.  Sums are not: doubles would be added in another order.
    """
    out = []
    for c in cols:
        x = F.col(c) if cond is None else F.when(cond, F.col(c))
        for s in stats:
            e = _stat(s, x) if halves is None else _stat_of_halves(s, x, halves)
            if cond is not None:
                e = gated(cond, e)
            out.append(e.alias(f"{prefix}_{c}_{s.upper()}"))
    return out


def aggregate_numeric(df: DataFrame, prefix: str, *, key: str = KEY,
                      exclude: Sequence[str] = (),
                      stats: Sequence[str] = ("mean", "max", "min", "sum", "count")) -> DataFrame:
    """Every numeric column x stats, one row per key."""
    cols = numeric_columns(df, [key, *exclude])
    if not cols:
        return df.select(key).distinct()
    return df.groupBy(key).agg(*numeric_block(prefix, cols, stats))


# ---------------------------------------------------------------- R2 / R3 / R4

def status_history(balance: DataFrame, *, credit_key: str = "SK_ID_BUREAU") -> DataFrame:
    """R2: one row per credit from its monthly status rows."""
    mapping = F.create_map(*[x for k, v in STATUS_CODES.items()
                             for x in (F.lit(k), F.lit(v).cast("double"))])
    if "STATUS" in balance.columns:
        # unknown status texts map to NULL, as an unmapped pandas value does
        frame = balance.withColumn("STATUS_NUM", F.try_element_at(mapping, F.col("STATUS")))
    else:
        frame = balance.withColumn("STATUS_NUM", F.lit(None).cast("double"))
    return frame.groupBy(credit_key).agg(
        F.count("MONTHS_BALANCE").alias("BB_MONTHS_COUNT"),
        F.max("STATUS_NUM").alias("BB_STATUS_MAX"),
        F.avg("STATUS_NUM").alias("BB_STATUS_MEAN"),
        F.stddev_samp("STATUS_NUM").alias("BB_STATUS_STD"),
        F.min("MONTHS_BALANCE").alias("BB_MONTHS_MIN"),
        F.count_if(F.col("STATUS_NUM") > 0).alias("BB_DPD_MONTHS"),
    )


def bureau_features(bureau: DataFrame, balance: DataFrame | None = None, *,
                    encode: bool = True) -> DataFrame:
    """R3 + R4: bureau credits joined with their status history, aggregated for
    all / active / closed credits in a single pass, plus named totals."""
    frame = bureau
    has_active = "CREDIT_ACTIVE" in frame.columns
    if has_active:
        frame = frame.withColumn("CREDIT_ACTIVE_BIN", F.coalesce(
            F.col("CREDIT_ACTIVE") == "Active", F.lit(False)).cast("int"))
    # strings come from the bureau table only: fit the codes on that scan, not on the join
    strings = string_columns(bureau)
    if encode:
        frame = label_encode(frame, strings, fit_on=[bureau])
    else:
        frame = frame.drop(*strings)
    if balance is not None and "SK_ID_BUREAU" in bureau.columns:
        frame = frame.join(status_history(balance), "SK_ID_BUREAU", "left")
    cols = numeric_columns(frame, [KEY, "SK_ID_BUREAU", "CREDIT_ACTIVE_BIN"])
    stats = ("mean", "max", "min", "sum", "count")
    active = F.col("CREDIT_ACTIVE_BIN") == 1 if has_active else None
    exprs = numeric_block("BUR", cols, stats, halves=active)
    if has_active:
        exprs += numeric_block("BUR_ACT", cols, stats, active)
        exprs += numeric_block("BUR_CLS", cols, stats, ~active)
    required = {"SK_ID_BUREAU", "CREDIT_ACTIVE_BIN", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM",
                "AMT_CREDIT_SUM_OVERDUE", "CNT_CREDIT_PROLONG", "AMT_CREDIT_MAX_OVERDUE"}
    named = required.issubset(frame.columns)
    if named:
        exprs += [
            F.count("SK_ID_BUREAU").alias("BUR_N_CREDITS"),
            sum0("CREDIT_ACTIVE_BIN").alias("BUR_N_ACTIVE"),
            sum0("AMT_CREDIT_SUM_DEBT").alias("BUR_DEBT_TOTAL"),
            sum0("AMT_CREDIT_SUM").alias("BUR_CREDIT_TOTAL"),
            sum0("AMT_CREDIT_SUM_OVERDUE").alias("BUR_OVERDUE_TOTAL"),
            sum0("CNT_CREDIT_PROLONG").alias("BUR_PROLONG_TOTAL"),
            F.avg("AMT_CREDIT_SUM_DEBT").alias("BUR_DEBT_RATIO"),
            F.max("AMT_CREDIT_MAX_OVERDUE").alias("BUR_MAX_OVERDUE"),
        ]
    out = _group(frame, exprs)
    if named:
        out = out.withColumn("BUR_DEBT_CREDIT_RATIO",
                             ratio_plus_one("BUR_DEBT_TOTAL", "BUR_CREDIT_TOTAL"))
    return out


# ---------------------------------------------------------------- D11 / R5 / R6

@dataclass(frozen=True)
class RatioSpec:
    output: str
    left: str
    right: str
    kind: str  # "ratio" -> left / (right + 1); "diff" -> left - right


def ratio_columns(df: DataFrame, specs: Sequence[RatioSpec | tuple]) -> DataFrame:
    """Declarative ratio / difference columns, emitted when inputs exist."""
    new = {}
    for spec in specs:
        spec = spec if isinstance(spec, RatioSpec) else RatioSpec(*spec)
        if spec.kind not in ("ratio", "diff"):
            raise RelationalError(f"unknown feature operation: {spec.kind}")
        if spec.left in df.columns and spec.right in df.columns:
            if spec.kind == "ratio":
                new[spec.output] = ratio_plus_one(spec.left, spec.right)
            else:
                new[spec.output] = F.col(spec.left) - F.col(spec.right)
    return df.withColumns(new) if new else df


PREVIOUS_RATIOS = (
    RatioSpec("PREV_CREDIT_DIFF", "AMT_APPLICATION", "AMT_CREDIT", "diff"),
    RatioSpec("PREV_CREDIT_RATIO", "AMT_CREDIT", "AMT_APPLICATION", "ratio"),
    RatioSpec("PREV_DOWN_PAYMENT_RATIO", "AMT_DOWN_PAYMENT", "AMT_APPLICATION", "ratio"),
    RatioSpec("PREV_ANNUITY_RATIO", "AMT_ANNUITY", "AMT_APPLICATION", "ratio"),
    RatioSpec("PREV_PAYMENT_LENGTH", "AMT_CREDIT", "AMT_ANNUITY", "ratio"),
)


def previous_features(prev: DataFrame, *, encode: bool = True) -> DataFrame:
    """R5 + R6: previous applications for all / approved / not approved."""
    frame = prev
    status = (F.coalesce(F.col("NAME_CONTRACT_STATUS"), F.lit("nan"))
              if "NAME_CONTRACT_STATUS" in frame.columns else F.lit(""))
    frame = frame.withColumn("_APPROVED", (status == "Approved").cast("int"))
    day_cols = [c for c in frame.columns if "DAYS" in c]
    frame = frame.withColumns({c: F.when(F.col(c) != DAYS_SENTINEL, F.col(c)) for c in day_cols})
    frame = ratio_columns(frame, PREVIOUS_RATIOS)
    if encode:
        frame = label_encode(frame, string_columns(frame))
    else:
        frame = frame.drop(*string_columns(frame))
    cols = numeric_columns(frame, [KEY, "SK_ID_PREV", "_APPROVED"])
    stats = ("mean", "max", "min", "sum", "count")
    appr = F.col("_APPROVED") == 1
    exprs = (numeric_block("PREV", cols, stats, halves=appr)
             + numeric_block("PREV_APPR", cols, stats, appr)
             + numeric_block("PREV_REF", cols, stats, ~appr))
    if "SK_ID_PREV" in frame.columns:
        exprs += [
            F.count("SK_ID_PREV").alias("PREV_N_APPS"),
            sum0("_APPROVED").alias("PREV_N_APPROVED"),
            F.avg("_APPROVED").alias("PREV_APPROVAL_RATE"),
        ]
        optional = (("PREV_MAX_CREDIT", "AMT_CREDIT", F.max),
                    ("PREV_MEAN_CREDIT", "AMT_CREDIT", F.avg),
                    ("PREV_LAST_DAYS_DEC", "DAYS_DECISION", F.max),
                    ("PREV_CREDIT_DIFF_MEAN", "PREV_CREDIT_DIFF", F.avg),
                    ("PREV_CREDIT_RATIO_MEAN", "PREV_CREDIT_RATIO", F.avg),
                    ("PREV_ANNUITY_RATIO_MEAN", "PREV_ANNUITY_RATIO", F.avg),
                    ("PREV_PAYMENT_LEN_MEAN", "PREV_PAYMENT_LENGTH", F.avg))
        exprs += [fn(src).alias(name) for name, src, fn in optional if src in frame.columns]
    return _group(frame, exprs)


# ---------------------------------------------------------------- R7 / R8

INSTALMENT_STAT_COLS = ("AMT_INSTALMENT", "AMT_PAYMENT", "PAYMENT_DIFF", "PAYMENT_RATIO", "DPD", "DBD")


def instalment_rows(inst: DataFrame) -> DataFrame:
    """Per-payment behaviour columns."""
    new: dict[str, Column] = {}
    cols = set(inst.columns)
    if {"AMT_INSTALMENT", "AMT_PAYMENT"} <= cols:
        diff = F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT")
        new["PAYMENT_DIFF"] = diff
        new["PAYMENT_RATIO"] = ratio_plus_one("AMT_PAYMENT", "AMT_INSTALMENT")
        new["UNDERPAYMENT"] = flag_gt(diff)
    if {"DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT"} <= cols:
        dpd = clip_lower(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT"))
        dbd = clip_lower(F.col("DAYS_INSTALMENT") - F.col("DAYS_ENTRY_PAYMENT"))
        new["DPD"] = dpd
        new["DBD"] = dbd
        new["LATE_PAYMENT"] = flag_gt(dpd)
        new["EARLY_PAYMENT"] = flag_gt(dbd)
    return inst.withColumns(new) if new else inst


def _instalment_block(frame: DataFrame, prefix: str, cond: Column | None) -> list[Column]:
    cols = [c for c in INSTALMENT_STAT_COLS if c in frame.columns]
    exprs = numeric_block(prefix, cols, ("mean", "max", "sum", "std"), cond)

    def g(e: Column) -> Column:
        return e if cond is None else gated(cond, e)

    def v(c: str) -> Column:
        return F.col(c) if cond is None else F.when(cond, F.col(c))

    for name, src in (("LATE_RATE", "LATE_PAYMENT"), ("EARLY_RATE", "EARLY_PAYMENT"),
                      ("UNDER_RATE", "UNDERPAYMENT")):
        if src in frame.columns:
            exprs.append(g(F.avg(v(src))).alias(f"{prefix}_{name}"))
    if "AMT_PAYMENT" in frame.columns:
        exprs.append(g(F.count(v("AMT_PAYMENT"))).alias(f"{prefix}_N_PAYMENTS"))
    return exprs


def instalment_features(inst: DataFrame, *, recent_days: int = 365) -> DataFrame:
    """R8 + R16: all payments and the last ``recent_days`` days, one pass.

    Payments are dealt by key before their behaviour columns are built, so that those are not shuffled.
    """
    frame = instalment_rows(inst.repartition(KEY))
    exprs = _instalment_block(frame, "INST", None)
    if "DAYS_INSTALMENT" in frame.columns:
        recent = F.col("DAYS_INSTALMENT") >= -recent_days
        exprs += _instalment_block(frame, "INST_REC", recent)
    return _group(frame, exprs)


# ---------------------------------------------------------------- R9 / R10

def _monthly_block(frame: DataFrame, prefix: str, cond: Column | None,
                   named: Sequence[tuple[str, str, str]]) -> list[Column]:
    cols = numeric_columns(frame, [KEY, "SK_ID_PREV"])
    exprs = numeric_block(prefix, cols, ("mean", "max", "min", "sum"), cond)

    def g(e: Column) -> Column:
        return e if cond is None else gated(cond, e)

    def v(c: str) -> Column:
        return F.col(c) if cond is None else F.when(cond, F.col(c))

    if "MONTHS_BALANCE" in frame.columns:
        exprs.append(g(F.count(v("MONTHS_BALANCE"))).alias(f"{prefix}_N_MONTHS"))
    for name, src, stat in named:
        if src in frame.columns:
            exprs.append(g(_stat(stat, v(src))).alias(f"{prefix}_{name}"))
    return exprs


def modal_share(frame: DataFrame, category: str, prefix: str, *,
                recent: Column | None = None, recent_prefix: str | None = None,
                key: str = KEY) -> DataFrame:
    """Share of the most frequent category per key (two-level aggregate: the
    first level is map-side combined, so a hot key never holds raw rows)."""
    cat = F.coalesce(F.col(category).cast("string"), F.lit("nan"))
    lvl = [F.count(F.lit(1)).alias("_n")]
    if recent is not None:
        lvl.append(F.count_if(recent).alias("_nr"))
    counts = frame.groupBy(key, cat.alias("_cat")).agg(*lvl)
    out = [(F.max("_n") / F.sum("_n")).alias(f"{prefix}_COMPLETED")]
    if recent is not None:
        out.append(F.when(F.sum("_nr") > 0, F.max("_nr") / F.sum("_nr"))
                   .alias(f"{recent_prefix}_COMPLETED"))
    return counts.groupBy(key).agg(*out)


def pos_features(pos: DataFrame, *, recent_months: int = 12, encode: bool = True) -> DataFrame:
    """POS monthly balance, all and last ``recent_months`` months."""
    frame = label_encode(pos, string_columns(pos)) if encode else pos.drop(*string_columns(pos))
    new = {}
    if "SK_DPD" in frame.columns:
        new["POS_DPD_FLAG"] = flag_gt("SK_DPD")
    if "SK_DPD_DEF" in frame.columns:
        new["POS_DPD_DEF_FLAG"] = flag_gt("SK_DPD_DEF")
    frame = frame.withColumns(new) if new else frame
    named = (("DPD_RATE", "POS_DPD_FLAG", "mean"),)
    exprs = _monthly_block(frame, "POS", None, named)
    recent = None
    if "MONTHS_BALANCE" in frame.columns:
        recent = F.col("MONTHS_BALANCE") >= -recent_months
        exprs += _monthly_block(frame, "POS_REC", recent, named)
    out = _group(frame, exprs)
    if "NAME_CONTRACT_STATUS" in frame.columns:
        share = modal_share(frame, "NAME_CONTRACT_STATUS", "POS", recent=recent,
                            recent_prefix="POS_REC")
        out = out.join(share, KEY, "left")
    return out


CARD_RATIOS = (
    RatioSpec("CC_UTIL_RATIO", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "ratio"),
    RatioSpec("CC_PAYMENT_RATIO", "AMT_PAYMENT_CURRENT", "AMT_INST_MIN_REGULARITY", "ratio"),
    RatioSpec("CC_DRAWING_RATIO", "AMT_DRAWINGS_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL", "ratio"),
)


def card_features(card: DataFrame, *, recent_months: int = 12, encode: bool = True) -> DataFrame:
    """Credit-card monthly balance, all and recent months."""
    frame = label_encode(card, string_columns(card)) if encode else card.drop(*string_columns(card))
    frame = ratio_columns(frame, CARD_RATIOS)
    if "SK_DPD" in frame.columns:
        frame = frame.withColumn("CC_DPD_FLAG", flag_gt("SK_DPD"))
    named = (("DPD_RATE", "CC_DPD_FLAG", "mean"), ("UTIL_MEAN", "CC_UTIL_RATIO", "mean"),
             ("UTIL_MAX", "CC_UTIL_RATIO", "max"), ("PAYMENT_MEAN", "CC_PAYMENT_RATIO", "mean"))
    exprs = _monthly_block(frame, "CC", None, named)
    if "MONTHS_BALANCE" in frame.columns:
        recent = F.col("MONTHS_BALANCE") >= -recent_months
        exprs += _monthly_block(frame, "CC_REC", recent, named)
    return _group(frame, exprs)


# ---------------------------------------------------------------- R11 - R15

def merge_blocks(blocks: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """Full outer join of per-key blocks.

    A block with a key that stands twice fails the job.  The check is one count per key on the
    block's own partitioning, which the join needs anyway.
    """
    blocks = [b for b in blocks if b is not None]
    if not blocks:
        raise RelationalError("no feature block to merge")
    if any(key not in b.columns for b in blocks):
        raise RelationalError(f"missing id column: {key}")
    out = unique_by(blocks[0], key)
    for b in blocks[1:]:
        out = out.join(unique_by(b, key), key, "full_outer")
    return out


def unique_by(block: DataFrame, key: str = KEY) -> DataFrame:
    """The block itself; running it raises if a key stands twice."""
    others = [c for c in block.columns if c != key]
    rows = block.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *(F.first(c).alias(c) for c in others))
    checked = F.when(F.col("_n") == 1, F.col(key)).otherwise(
        F.raise_error(F.concat(F.lit(f"duplicated {key}: "), F.col(key).cast("string"))).cast(block.schema[key].dataType))
    return rows.select(checked.alias(key), *others)


def relational_matrix(application: DataFrame, blocks: Sequence[DataFrame],
                      key: str = KEY) -> DataFrame:
    """Application rows LEFT JOIN every block.  Blocks leave their
    ``groupBy(key)`` hash-partitioned, so only the application side shuffles."""
    out = application
    for b in blocks:
        clash = [c for c in b.columns if c != key and c in out.columns]
        if clash:
            raise RelationalError(f"duplicate feature columns: {clash[:5]}")
        out = out.join(b, key, "left")
    return out


def bucketed(df: DataFrame, root: str, *, key: str = KEY, buckets: int | None = None, name: str | None = None,
             codec: str = "snappy") -> DataFrame:
    """``df`` written once below ``root``, bucketed and sorted by ``key``, and read back as the table ``name`` (default: a new one).

    With as many buckets as shuffle partitions (the default) a frame that leaves a ``groupBy(key)`` is
    written as it is dealt, one file a bucket; any other frame is dealt by ``key`` first, so that it is not written
    by the few tasks that scan it.  Frames bucketed alike join on ``key`` without another shuffle.
    Dictionaries are left out: sums and means of customers seldom repeat, and to look for repeats in hundreds
    of columns takes a large part of the writing.
    """
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(key).write.format("parquet").option("parquet.enable.dictionary", "false").option("compression", codec)
    writer.bucketBy(n, key).sortBy(key).option("path", f"{root.rstrip('/')}/{name}").saveAsTable(name)
    return spark.table(name)


def matrix_sides(applications: Sequence[DataFrame], blocks: Sequence[DataFrame], root: str, key: str = KEY) -> list[DataFrame]:
    """R12 for several sides (train, official test): each application frame LEFT JOIN every block.

    Blocks and applications are bucketed by ``key`` once; the joins of all sides read them without an exchange.
    Merge joins are asked for, so that no side is collected for a broadcast either.
    """
    stored = [bucketed(b, root, key=key) for b in blocks]
    return [relational_matrix(bucketed(a, root, key=key), [b.hint("merge") for b in stored], key) for a in applications]


def feature_columns(columns: Sequence[str], *, id_column: str = KEY, target: str = "TARGET",
                    sensitive: str | None = "CODE_GENDER",
                    include_sensitive: bool = False) -> list[str]:
    """Model features = every column except id / target (/ sensitive)."""
    excluded = {id_column, target}
    if sensitive and not include_sensitive:
        excluded.add(sensitive)
    cols = [c for c in columns if c not in excluded]
    if target in cols:
        raise RelationalError("target leaked into feature columns")
    return cols


def align_columns(train: DataFrame, test: DataFrame, features: Sequence[str], *,
                  id_column: str = KEY, target: str = "TARGET") -> tuple[DataFrame, DataFrame]:
    """Same ordered feature columns in train and test; missing test columns
    become NULL; non-finite doubles become NULL; target only in train."""
    if target in features:
        raise RelationalError("target cannot be a feature")
    feats = [c for c in features if c in train.columns]
    types = dict(train.dtypes)

    def fin(df: DataFrame, c: str) -> Column:
        if c not in df.columns:
            return F.lit(None).cast(types[c]).alias(c)
        if types[c] in ("double", "float"):
            x = F.col(c)
            return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None)).otherwise(x).alias(c)
        return F.col(c)

    tr = train.select(id_column, target, *[fin(train, c) for c in feats])
    te = test.select(id_column, *[fin(test, c) for c in feats])
    return tr, te


# Feature-name prefixes and the source they come from (first match wins).
SOURCE_PREFIXES = (
    ("BUR", "bureau"),
    ("PREV", "previous_application"),
    ("INST", "installments_payments"),
    ("POS", "pos_cash_balance"),
    ("CC", "credit_card_balance"),
)
ALL_SOURCES = ("application", "bureau", "previous_application", "installments_payments",
               "pos_cash_balance", "credit_card_balance")


def source_of(name: Column) -> Column:
    expr = None
    for prefix, src in SOURCE_PREFIXES:
        cond = name.startswith(prefix)
        expr = F.when(cond, F.lit(src)) if expr is None else expr.when(cond, F.lit(src))
    return expr.otherwise(F.lit("application"))


def source_summary(names: DataFrame, name_col: str = "feature") -> DataFrame:
    """Feature count per source, zero rows kept, from a DataFrame of names."""
    spark: SparkSession = names.sparkSession
    counts = names.groupBy(source_of(F.col(name_col)).alias("source")).agg(
        F.count(F.lit(1)).alias("n_features"))
    all_src = spark.createDataFrame([(s,) for s in ALL_SOURCES], "source string")
    return (all_src.join(counts, "source", "left")
            .select("source", F.coalesce("n_features", F.lit(0)).cast("bigint").alias("n_features")))
