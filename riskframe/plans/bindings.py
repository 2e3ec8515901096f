"""Bindings of the driver's test tables to the roles the library works on.

Each role is declared twice: as a Spark projection over the given parquet
tables (what the registered queries run) and as a DuckDB ``WITH`` item (what the
oracle SQL runs).  Both are pure row-wise projections or a single equi-join, so
the work of every query grows with the tables.  Derived values are built from
integer arithmetic on keys so both engines agree to the bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.exprs import days_between
from riskframe.sources.tables import read_table

# The date every relative day count is measured from.
REFERENCE_DATE = "2002-01-01"
# Sweep grid lambda -> integer score shift for the s = 1 group.
LAMBDA_SHIFTS = ((0.0, 0), (0.05, 4), (0.1, 7), (0.25, 16), (0.5, 27), (1.0, 40), (2.0, 53), (5.0, 67),
                 (10.0, 76))


def _days(c: str) -> Column:
    return days_between(F.col(c), REFERENCE_DATE)


def _ddays(c: str) -> str:
    return f"datediff('day', DATE '{REFERENCE_DATE}', CAST({c} AS DATE))"


# ------------------------------------------------------------------ application

def application(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")

    def ext(mult: int, mod: int) -> Column:
        return F.when(k % mod == 0, F.lit(None)).otherwise(
            ((k * mult) % 1000).cast("double") / 1000)

    return read_table(spark, d, "customer").select(
        k.alias("SK_ID_CURR"),
        (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
        F.when(k % 97 == 13, "XNA").when(k % 2 == 0, "F").otherwise("M").alias("CODE_GENDER"),
        F.when(k % 4 == 0, "Y").otherwise("N").alias("FLAG_OWN_CAR"),
        F.col("c_mktsegment").alias("NAME_SEGMENT"),
        F.col("c_nationkey").alias("REGION_CODE"),
        F.col("c_acctbal").alias("AMT_INCOME_TOTAL"),
        ((k * 7919) % 90000 + 10000).cast("double").alias("AMT_CREDIT"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(((k * 31) % 5000 + 500).cast("double"))
        .alias("AMT_ANNUITY"),
        ((k * 7919) % 90000 + 10000 - (k * 17) % 3000).cast("double").alias("AMT_GOODS_PRICE"),
        (k % 4).cast("int").alias("CNT_CHILDREN"),
        (k % 5 + 1).cast("int").alias("CNT_FAM_MEMBERS"),
        (-(7300 + (k * 37) % 18000)).cast("int").alias("DAYS_BIRTH"),
        F.when(k % 13 == 0, F.lit(365243)).otherwise(-((k * 53) % 9000)).cast("int")
        .alias("DAYS_EMPLOYED"),
        (-((k * 29) % 5000)).cast("int").alias("DAYS_ID_PUBLISH"),
        ext(7919, 5).alias("EXT_SOURCE_1"),
        ext(104729, 7).alias("EXT_SOURCE_2"),
        ext(1299709, 3).alias("EXT_SOURCE_3"),
        (k % 2).cast("int").alias("FLAG_DOCUMENT_2"),
        (k % 3 == 0).cast("int").alias("FLAG_DOCUMENT_3"),
        (k % 5 == 1).cast("int").alias("FLAG_PHONE"),
        (k % 7 == 2).cast("int").alias("FLAG_EMAIL"),
    )


APPLICATION_SQL = """
SELECT c_custkey AS SK_ID_CURR,
  CAST(c_acctbal < 0 AS INTEGER) AS TARGET,
  CASE WHEN c_custkey % 97 = 13 THEN 'XNA' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
  CASE WHEN c_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
  c_mktsegment AS NAME_SEGMENT,
  c_nationkey AS REGION_CODE,
  c_acctbal AS AMT_INCOME_TOTAL,
  CAST((c_custkey * 7919) % 90000 + 10000 AS DOUBLE) AS AMT_CREDIT,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST((c_custkey * 31) % 5000 + 500 AS DOUBLE) END AS AMT_ANNUITY,
  CAST((c_custkey * 7919) % 90000 + 10000 - (c_custkey * 17) % 3000 AS DOUBLE) AS AMT_GOODS_PRICE,
  CAST(c_custkey % 4 AS INTEGER) AS CNT_CHILDREN,
  CAST(c_custkey % 5 + 1 AS INTEGER) AS CNT_FAM_MEMBERS,
  CAST(-(7300 + (c_custkey * 37) % 18000) AS INTEGER) AS DAYS_BIRTH,
  CAST(CASE WHEN c_custkey % 13 = 0 THEN 365243 ELSE -((c_custkey * 53) % 9000) END AS INTEGER) AS DAYS_EMPLOYED,
  CAST(-((c_custkey * 29) % 5000) AS INTEGER) AS DAYS_ID_PUBLISH,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST((c_custkey * 7919) % 1000 AS DOUBLE) / 1000 END AS EXT_SOURCE_1,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST((c_custkey * 104729) % 1000 AS DOUBLE) / 1000 END AS EXT_SOURCE_2,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST((c_custkey * 1299709) % 1000 AS DOUBLE) / 1000 END AS EXT_SOURCE_3,
  CAST(c_custkey % 2 AS INTEGER) AS FLAG_DOCUMENT_2,
  CAST(c_custkey % 3 = 0 AS INTEGER) AS FLAG_DOCUMENT_3,
  CAST(c_custkey % 5 = 1 AS INTEGER) AS FLAG_PHONE,
  CAST(c_custkey % 7 = 2 AS INTEGER) AS FLAG_EMAIL
FROM customer"""


# ------------------------------------------------------------------ bureau

def bureau(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    price = F.col("o_totalprice")
    return read_table(spark, d, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        k.alias("SK_ID_BUREAU"),
        F.when(st == "O", "Active").otherwise("Closed").alias("CREDIT_ACTIVE"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
        _days("o_orderdate").alias("DAYS_CREDIT"),
        price.alias("AMT_CREDIT_SUM"),
        F.when(k % 4 == 0, F.lit(None)).when(st == "F", F.lit(0.0)).otherwise(price / 2)
        .alias("AMT_CREDIT_SUM_DEBT"),
        F.when(st == "P", price / 10).otherwise(F.lit(0.0)).alias("AMT_CREDIT_SUM_OVERDUE"),
        (k % 3).cast("int").alias("CNT_CREDIT_PROLONG"),
        F.when(k % 5 == 0, F.lit(None)).otherwise((k % 1000).cast("double"))
        .alias("AMT_CREDIT_MAX_OVERDUE"),
    )


BUREAU_SQL = f"""
SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
  CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Closed' END AS CREDIT_ACTIVE,
  o_orderpriority AS CREDIT_TYPE,
  CAST({_ddays('o_orderdate')} AS INTEGER) AS DAYS_CREDIT,
  o_totalprice AS AMT_CREDIT_SUM,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN CAST(0 AS DOUBLE) ELSE o_totalprice / 2 END AS AMT_CREDIT_SUM_DEBT,
  CASE WHEN o_orderstatus = 'P' THEN o_totalprice / 10 ELSE CAST(0 AS DOUBLE) END AS AMT_CREDIT_SUM_OVERDUE,
  CAST(o_orderkey % 3 AS INTEGER) AS CNT_CREDIT_PROLONG,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 1000 AS DOUBLE) END AS AMT_CREDIT_MAX_OVERDUE
FROM orders"""


def bureau_balance(spark: SparkSession, d: str) -> DataFrame:
    ln = F.col("l_linenumber")
    rf = F.col("l_returnflag")
    return read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-ln).cast("int").alias("MONTHS_BALANCE"),
        F.when(rf == "A", "X").when(rf == "R", (ln % 3 + 1).cast("string"))
        .when(F.col("l_linestatus") == "F", "C").otherwise("0").alias("STATUS"),
    )


BUREAU_BALANCE_SQL = """
SELECT l_orderkey AS SK_ID_BUREAU, CAST(-l_linenumber AS INTEGER) AS MONTHS_BALANCE,
  CASE WHEN l_returnflag = 'A' THEN 'X' WHEN l_returnflag = 'R' THEN CAST(l_linenumber % 3 + 1 AS VARCHAR)
       WHEN l_linestatus = 'F' THEN 'C' ELSE '0' END AS STATUS
FROM lineitem"""


# ------------------------------------------------------------------ previous applications

def previous(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    pr = F.col("o_orderpriority")
    price = F.col("o_totalprice")
    dec = _days("o_orderdate")
    return read_table(spark, d, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        k.alias("SK_ID_PREV"),
        F.when(pr.isin("1-URGENT", "2-HIGH"), "Approved").when(pr == "3-MEDIUM", "Canceled")
        .otherwise("Refused").alias("NAME_CONTRACT_STATUS"),
        price.alias("AMT_APPLICATION"),
        (price - (k % 1000).cast("double")).alias("AMT_CREDIT"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(price / 12).alias("AMT_ANNUITY"),
        (k % 500).cast("double").alias("AMT_DOWN_PAYMENT"),
        dec.alias("DAYS_DECISION"),
        F.when(k % 9 == 0, F.lit(365243)).otherwise(dec + 300).cast("int").alias("DAYS_TERMINATION"),
    )


PREVIOUS_SQL = f"""
SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Approved'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'Canceled' ELSE 'Refused' END AS NAME_CONTRACT_STATUS,
  o_totalprice AS AMT_APPLICATION,
  o_totalprice - CAST(o_orderkey % 1000 AS DOUBLE) AS AMT_CREDIT,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice / 12 END AS AMT_ANNUITY,
  CAST(o_orderkey % 500 AS DOUBLE) AS AMT_DOWN_PAYMENT,
  CAST({_ddays('o_orderdate')} AS INTEGER) AS DAYS_DECISION,
  CAST(CASE WHEN o_orderkey % 9 = 0 THEN 365243 ELSE {_ddays('o_orderdate')} + 300 END AS INTEGER) AS DAYS_TERMINATION
FROM orders"""


# ------------------------------------------------------------------ instalments

def instalments(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_shipdate")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    rk = F.col("l_orderkey") + F.col("l_linenumber")
    return j.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
        F.col("l_extendedprice").alias("AMT_INSTALMENT"),
        F.when(rk % 23 == 0, F.lit(None))
        .otherwise(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("AMT_PAYMENT"),
        _days("o_orderdate").alias("DAYS_INSTALMENT"),
        F.when(rk % 17 == 0, F.lit(None)).otherwise(_days("l_shipdate")).alias("DAYS_ENTRY_PAYMENT"),
    )


INSTALMENTS_SQL = f"""
SELECT o_custkey AS SK_ID_CURR, l_orderkey AS SK_ID_PREV, l_linenumber AS NUM_INSTALMENT_NUMBER,
  l_extendedprice AS AMT_INSTALMENT,
  CASE WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN NULL ELSE l_extendedprice * (1 - l_discount) END AS AMT_PAYMENT,
  CAST({_ddays('o_orderdate')} AS INTEGER) AS DAYS_INSTALMENT,
  CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN NULL ELSE CAST({_ddays('l_shipdate')} AS INTEGER) END AS DAYS_ENTRY_PAYMENT
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


# ------------------------------------------------------------------ monthly balances

def _month(c: str) -> Column:
    return (F.dayofmonth(F.col(c)) - 31).cast("int")


def pos_cash(spark: SparkSession, d: str) -> DataFrame:
    et = F.col("event_type")
    v = F.col("value")
    return read_table(spark, d, "events").select(
        F.col("user_id").alias("SK_ID_CURR"),
        F.col("event_id").alias("SK_ID_PREV"),
        _month("ts").alias("MONTHS_BALANCE"),
        v.alias("CNT_INSTALMENT"),
        F.when(et == "error", v).otherwise(F.lit(0.0)).alias("SK_DPD"),
        F.when((et == "error") & (v > 20), v - 20).otherwise(F.lit(0.0)).alias("SK_DPD_DEF"),
        et.alias("NAME_CONTRACT_STATUS"),
    )


POS_SQL = """
SELECT user_id AS SK_ID_CURR, event_id AS SK_ID_PREV,
  CAST(dayofmonth(ts) - 31 AS INTEGER) AS MONTHS_BALANCE,
  value AS CNT_INSTALMENT,
  CASE WHEN event_type = 'error' THEN value ELSE CAST(0 AS DOUBLE) END AS SK_DPD,
  CASE WHEN event_type = 'error' AND value > 20 THEN value - 20 ELSE CAST(0 AS DOUBLE) END AS SK_DPD_DEF,
  event_type AS NAME_CONTRACT_STATUS
FROM events"""


def credit_card(spark: SparkSession, d: str) -> DataFrame:
    et = F.col("event_type")
    v = F.col("value")
    k = F.col("event_id")
    return read_table(spark, d, "events").select(
        F.col("user_id").alias("SK_ID_CURR"),
        k.alias("SK_ID_PREV"),
        _month("ts").alias("MONTHS_BALANCE"),
        (v * 100).alias("AMT_BALANCE"),
        (1000 + (k % 7) * 500).cast("double").alias("AMT_CREDIT_LIMIT_ACTUAL"),
        F.when(et == "purchase", v * 10).alias("AMT_PAYMENT_CURRENT"),
        (k % 50).cast("double").alias("AMT_INST_MIN_REGULARITY"),
        F.when(et == "click", v).otherwise(F.lit(0.0)).alias("AMT_DRAWINGS_CURRENT"),
        F.when(et == "error", (k % 40).cast("int")).otherwise(F.lit(0)).alias("SK_DPD"),
    )


CARD_SQL = """
SELECT user_id AS SK_ID_CURR, event_id AS SK_ID_PREV,
  CAST(dayofmonth(ts) - 31 AS INTEGER) AS MONTHS_BALANCE,
  value * 100 AS AMT_BALANCE,
  CAST(1000 + (event_id % 7) * 500 AS DOUBLE) AS AMT_CREDIT_LIMIT_ACTUAL,
  CASE WHEN event_type = 'purchase' THEN value * 10 END AS AMT_PAYMENT_CURRENT,
  CAST(event_id % 50 AS DOUBLE) AS AMT_INST_MIN_REGULARITY,
  CASE WHEN event_type = 'click' THEN value ELSE CAST(0 AS DOUBLE) END AS AMT_DRAWINGS_CURRENT,
  CASE WHEN event_type = 'error' THEN CAST(event_id % 40 AS INTEGER) ELSE 0 END AS SK_DPD
FROM events"""


# ------------------------------------------------------------------ scored tables

def _scored_parts():
    y = (F.col("o_orderstatus") == "F").cast("int")
    s = (F.col("o_custkey") % 2).cast("int")
    p1000 = (F.col("o_orderkey") * 7919) % 700 + 200 * y + 80 * s
    return y, s, p1000


def scored(spark: SparkSession, d: str) -> DataFrame:
    """One model's scores: id, y, s, p (integer-built, many ties)."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    y, s, p1000 = _scored_parts()
    return o.select(F.col("o_orderkey").alias("id"), y.alias("y"), s.alias("s"),
                    (p1000.cast("double") / 1000).alias("p"))


SCORED_SQL = """
SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y, CAST(o_custkey % 2 AS INTEGER) AS s,
  CAST((o_orderkey * 7919) % 700 + 200 * CAST(o_orderstatus = 'F' AS INTEGER) + 80 * CAST(o_custkey % 2 AS INTEGER) AS DOUBLE) / 1000 AS p
FROM orders"""


def model_name(lam: float) -> str:
    return f"lam={lam:g}"


def scored_base(spark: SparkSession, d: str) -> DataFrame:
    """Rows that the sweep grid is laid over: (id, y, s, p1000), p1000 the score in thousandths at lambda 0."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    y, s, p1000 = _scored_parts()
    return o.select(F.col("o_orderkey").alias("id"), y.alias("y"), s.alias("s"), p1000.alias("p1000"))


def on_grid(base: DataFrame, *more: str) -> DataFrame:
    """``base`` (see ``scored_base``) under every lambda of the sweep grid: (model_id, lam, id, y, s, p, more...).
    The grid is a literal array exploded per row (no join)."""
    grid = F.array(*[F.struct(F.lit(model_name(lam)).alias("model_id"),
                              F.lit(lam).alias("lam"), F.lit(sh).alias("shift"))
                     for lam, sh in LAMBDA_SHIFTS])
    return base.select("id", "y", "s", "p1000", *more, F.inline(grid)).select(
        "model_id", "lam", "id", "y", "s",
        ((F.col("p1000") - F.col("shift") * F.col("s")).cast("double") / 1000).alias("p"), *more)


def scored_models(spark: SparkSession, d: str) -> DataFrame:
    """The scored table under every lambda of the sweep grid: (model_id, lam, id, y, s, p)."""
    return on_grid(scored_base(spark, d))


def _grid_values() -> str:
    return ", ".join(f"('{model_name(lam)}', {lam}, {sh})" for lam, sh in LAMBDA_SHIFTS)


SCORED_MODELS_SQL = f"""
SELECT g.model_id, CAST(g.lam AS DOUBLE) AS lam, o_orderkey AS id,
  CAST(o_orderstatus = 'F' AS INTEGER) AS y, CAST(o_custkey % 2 AS INTEGER) AS s,
  CAST((o_orderkey * 7919) % 700 + 200 * CAST(o_orderstatus = 'F' AS INTEGER) + 80 * CAST(o_custkey % 2 AS INTEGER)
       - g.shift * CAST(o_custkey % 2 AS INTEGER) AS DOUBLE) / 1000 AS p
FROM orders CROSS JOIN (VALUES {_grid_values()}) AS g(model_id, lam, shift)"""


def labelled_docs(spark: SparkSession, d: str) -> DataFrame:
    """Documents with their labels (left join): id, y = quality, s = toxic."""
    docs = read_table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = read_table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return docs.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("id"), "lang", "source", "n_chars",
        F.col("quality").alias("y"), F.col("toxic").alias("s"))


LABELLED_DOCS_SQL = """
SELECT d.doc_id AS id, d.lang, d.source, d.n_chars, l.quality AS y, l.toxic AS s
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


ROLE_SQL = {
    "application": APPLICATION_SQL,
    "bureau": BUREAU_SQL,
    "bureau_balance": BUREAU_BALANCE_SQL,
    "previous": PREVIOUS_SQL,
    "instalments": INSTALMENTS_SQL,
    "pos_cash": POS_SQL,
    "credit_card": CARD_SQL,
    "scored": SCORED_SQL,
    "scored_models": SCORED_MODELS_SQL,
    "labelled_docs": LABELLED_DOCS_SQL,
}
ROLE_DEPS: dict[str, list[str]] = {}


def with_roles(*roles: str, extra: str = "") -> str:
    """``WITH`` clause holding the DuckDB form of the given roles (and deps)."""
    order: list[str] = []
    for r in roles:
        for dep in ROLE_DEPS.get(r, []):
            if dep not in order:
                order.append(dep)
        if r not in order:
            order.append(r)
    items = [f"{r} AS ({ROLE_SQL[r]}\n)" for r in order]
    if extra:
        items.append(extra)
    return "WITH " + ",\n".join(items) + "\n"


# ------------------------------------------------------------------ path A: deterministic table

def deterministic(spark: SparkSession, d: str) -> DataFrame:
    """Application rows after the deterministic stage: supported gender only,
    sensitive code (F=0, M=1), missing flags + null count, employment sentinel,
    positive years, Y/N flag mapped."""
    from riskframe.operators import rows as D
    app = D.filter_supported(application(spark, d), "CODE_GENDER", ["F", "M"])
    app = D.map_binary(app, {"CODE_GENDER": {"F": 0, "M": 1}, "FLAG_OWN_CAR": {"N": 0, "Y": 1}})
    app = app.withColumnRenamed("CODE_GENDER", "SENSITIVE")
    app = D.missing_flags(app, ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"],
                          count_name="EXT_NULL_COUNT", flag_suffix="_WAS_MISSING")
    app = D.sentinel_to_null(app, ["DAYS_EMPLOYED"])
    app = app.withColumns({"AGE_YEARS": F.col("DAYS_BIRTH") / F.lit(-365.25),
                           "EMPLOYED_YEARS": F.col("DAYS_EMPLOYED") / F.lit(-365.25)})
    return app.select("SK_ID_CURR", "TARGET", "SENSITIVE", "FLAG_OWN_CAR", "NAME_SEGMENT",
                      "REGION_CODE", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY",
                      "AMT_GOODS_PRICE", "CNT_CHILDREN", "EXT_SOURCE_1", "EXT_SOURCE_2",
                      "EXT_SOURCE_3", "EXT_SOURCE_1_WAS_MISSING", "EXT_SOURCE_2_WAS_MISSING",
                      "EXT_SOURCE_3_WAS_MISSING", "EXT_NULL_COUNT", "DAYS_EMPLOYED_ANOM",
                      "AGE_YEARS", "EMPLOYED_YEARS")


DETERMINISTIC_SQL = """
SELECT SK_ID_CURR, TARGET, CASE CODE_GENDER WHEN 'F' THEN 0 WHEN 'M' THEN 1 END AS SENSITIVE,
  CASE FLAG_OWN_CAR WHEN 'N' THEN 0 WHEN 'Y' THEN 1 END AS FLAG_OWN_CAR, NAME_SEGMENT, REGION_CODE,
  AMT_INCOME_TOTAL, AMT_CREDIT, AMT_ANNUITY, AMT_GOODS_PRICE, CNT_CHILDREN,
  EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3,
  CAST(EXT_SOURCE_1 IS NULL AS INTEGER) AS EXT_SOURCE_1_WAS_MISSING,
  CAST(EXT_SOURCE_2 IS NULL AS INTEGER) AS EXT_SOURCE_2_WAS_MISSING,
  CAST(EXT_SOURCE_3 IS NULL AS INTEGER) AS EXT_SOURCE_3_WAS_MISSING,
  CAST(EXT_SOURCE_1 IS NULL AS INTEGER) + CAST(EXT_SOURCE_2 IS NULL AS INTEGER) + CAST(EXT_SOURCE_3 IS NULL AS INTEGER) AS EXT_NULL_COUNT,
  CAST(coalesce(DAYS_EMPLOYED = 365243, false) AS INTEGER) AS DAYS_EMPLOYED_ANOM,
  DAYS_BIRTH / CAST(-365.25 AS DOUBLE) AS AGE_YEARS,
  CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END / CAST(-365.25 AS DOUBLE) AS EMPLOYED_YEARS
FROM application WHERE CODE_GENDER IN ('F', 'M')"""

ROLE_SQL["deterministic"] = DETERMINISTIC_SQL
ROLE_DEPS["deterministic"] = ["application"]
