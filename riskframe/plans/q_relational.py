"""Registered relational queries (R1-R15, D-ops of the application table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import relational as R
from riskframe.operators import rows as D
from riskframe.operators.encode import label_encode, string_columns
from riskframe.plans import bindings as B
from riskframe.plans.registry import register
from riskframe.plans.sqlgen import (
    clip0, encode_ctes, flag_gt0, gate, ratio1, sql_block, sql_stat, val,
)

STATS5 = ("mean", "max", "min", "sum", "count")

# ---------------------------------------------------------------- oracle building blocks

BB_CTE = """bb AS (
  SELECT SK_ID_BUREAU, count(MONTHS_BALANCE) AS BB_MONTHS_COUNT, max(sn) AS BB_STATUS_MAX,
         avg(sn) AS BB_STATUS_MEAN, stddev_samp(sn) AS BB_STATUS_STD,
         min(MONTHS_BALANCE) AS BB_MONTHS_MIN, count(CASE WHEN sn > 0 THEN 1 END) AS BB_DPD_MONTHS
  FROM (SELECT *, CAST(CASE STATUS WHEN '0' THEN 0 WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3
                          WHEN '4' THEN 4 WHEN '5' THEN 5 WHEN 'C' THEN 0 END AS DOUBLE) AS sn
        FROM bureau_balance)
  GROUP BY SK_ID_BUREAU)"""

BUREAU_COLS = {"DAYS_CREDIT": "int", "AMT_CREDIT_SUM": "double", "AMT_CREDIT_SUM_DEBT": "double",
               "AMT_CREDIT_SUM_OVERDUE": "double", "CNT_CREDIT_PROLONG": "int",
               "AMT_CREDIT_MAX_OVERDUE": "double", "CREDIT_ACTIVE": "int", "CREDIT_TYPE": "int",
               "BB_MONTHS_COUNT": "int", "BB_STATUS_MAX": "double", "BB_STATUS_MEAN": "double",
               "BB_STATUS_STD": "double", "BB_MONTHS_MIN": "int", "BB_DPD_MONTHS": "int"}


def bureau_block_ctes() -> str:
    act, cls = "CREDIT_ACTIVE_BIN = 1", "CREDIT_ACTIVE_BIN = 0"
    exprs = (sql_block("BUR", BUREAU_COLS, STATS5) + sql_block("BUR_ACT", BUREAU_COLS, STATS5, act)
             + sql_block("BUR_CLS", BUREAU_COLS, STATS5, cls))
    exprs += [
        "count(SK_ID_BUREAU) AS BUR_N_CREDITS",
        "CAST(coalesce(sum(CREDIT_ACTIVE_BIN), 0) AS BIGINT) AS BUR_N_ACTIVE",
        "CAST(coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS DOUBLE) AS BUR_DEBT_TOTAL",
        "CAST(coalesce(sum(AMT_CREDIT_SUM), 0) AS DOUBLE) AS BUR_CREDIT_TOTAL",
        "CAST(coalesce(sum(AMT_CREDIT_SUM_OVERDUE), 0) AS DOUBLE) AS BUR_OVERDUE_TOTAL",
        "CAST(coalesce(sum(CNT_CREDIT_PROLONG), 0) AS BIGINT) AS BUR_PROLONG_TOTAL",
        "avg(AMT_CREDIT_SUM_DEBT) AS BUR_DEBT_RATIO",
        "max(AMT_CREDIT_MAX_OVERDUE) AS BUR_MAX_OVERDUE",
    ]
    return ",\n".join([
        BB_CTE,
        """bur0 AS (SELECT bureau.*, bb.* EXCLUDE (SK_ID_BUREAU),
             CAST(coalesce(CREDIT_ACTIVE = 'Active', false) AS INTEGER) AS CREDIT_ACTIVE_BIN
           FROM bureau LEFT JOIN bb USING (SK_ID_BUREAU))""",
        encode_ctes("cb", "bur0", ["CREDIT_ACTIVE", "CREDIT_TYPE"], "bur1"),
        f"""bur2 AS (SELECT SK_ID_CURR, {', '.join(exprs)} FROM bur1 GROUP BY SK_ID_CURR)""",
        f"""bureau_block AS (SELECT *, {ratio1('BUR_DEBT_TOTAL', 'BUR_CREDIT_TOTAL')} AS BUR_DEBT_CREDIT_RATIO FROM bur2)""",
    ])


PREV_COLS = {"NAME_CONTRACT_STATUS": "int", "AMT_APPLICATION": "double", "AMT_CREDIT": "double",
             "AMT_ANNUITY": "double", "AMT_DOWN_PAYMENT": "double", "DAYS_DECISION": "int",
             "DAYS_TERMINATION": "int", "PREV_CREDIT_DIFF": "double", "PREV_CREDIT_RATIO": "double",
             "PREV_DOWN_PAYMENT_RATIO": "double", "PREV_ANNUITY_RATIO": "double",
             "PREV_PAYMENT_LENGTH": "double"}


def previous_block_ctes() -> str:
    appr = "_APPROVED = 1"
    exprs = (sql_block("PREV", PREV_COLS, STATS5) + sql_block("PREV_APPR", PREV_COLS, STATS5, appr)
             + sql_block("PREV_REF", PREV_COLS, STATS5, "NOT (_APPROVED = 1)"))
    exprs += [
        "count(SK_ID_PREV) AS PREV_N_APPS",
        "CAST(coalesce(sum(_APPROVED), 0) AS BIGINT) AS PREV_N_APPROVED",
        "avg(_APPROVED) AS PREV_APPROVAL_RATE",
        "max(AMT_CREDIT) AS PREV_MAX_CREDIT",
        "avg(AMT_CREDIT) AS PREV_MEAN_CREDIT",
        "max(DAYS_DECISION) AS PREV_LAST_DAYS_DEC",
        "avg(PREV_CREDIT_DIFF) AS PREV_CREDIT_DIFF_MEAN",
        "avg(PREV_CREDIT_RATIO) AS PREV_CREDIT_RATIO_MEAN",
        "avg(PREV_ANNUITY_RATIO) AS PREV_ANNUITY_RATIO_MEAN",
        "avg(PREV_PAYMENT_LENGTH) AS PREV_PAYMENT_LEN_MEAN",
    ]
    return ",\n".join([
        """pv0 AS (SELECT * REPLACE (
              CASE WHEN DAYS_DECISION <> 365243 THEN DAYS_DECISION END AS DAYS_DECISION,
              CASE WHEN DAYS_TERMINATION <> 365243 THEN DAYS_TERMINATION END AS DAYS_TERMINATION),
            CAST(coalesce(NAME_CONTRACT_STATUS, 'nan') = 'Approved' AS INTEGER) AS _APPROVED
           FROM previous)""",
        f"""pv1 AS (SELECT *, AMT_APPLICATION - AMT_CREDIT AS PREV_CREDIT_DIFF,
              {ratio1('AMT_CREDIT', 'AMT_APPLICATION')} AS PREV_CREDIT_RATIO,
              {ratio1('AMT_DOWN_PAYMENT', 'AMT_APPLICATION')} AS PREV_DOWN_PAYMENT_RATIO,
              {ratio1('AMT_ANNUITY', 'AMT_APPLICATION')} AS PREV_ANNUITY_RATIO,
              {ratio1('AMT_CREDIT', 'AMT_ANNUITY')} AS PREV_PAYMENT_LENGTH FROM pv0)""",
        encode_ctes("cp", "pv1", ["NAME_CONTRACT_STATUS"], "pv2"),
        f"""previous_block AS (SELECT SK_ID_CURR, {', '.join(exprs)} FROM pv2 GROUP BY SK_ID_CURR)""",
    ])


INST_COLS = {c: "double" for c in R.INSTALMENT_STAT_COLS}


def _inst_block(prefix: str, cond: str | None) -> list[str]:
    out = sql_block(prefix, INST_COLS, ("mean", "max", "sum", "std"), cond)
    for name, src in (("LATE_RATE", "LATE_PAYMENT"), ("EARLY_RATE", "EARLY_PAYMENT"),
                      ("UNDER_RATE", "UNDERPAYMENT")):
        out.append(f"{gate(cond, f'avg({val(cond, src)})')} AS {prefix}_{name}")
    out.append(f"{gate(cond, f'count({val(cond, 'AMT_PAYMENT')})')} AS {prefix}_N_PAYMENTS")
    return out


def instalment_rows_cte() -> str:
    diff = "(AMT_INSTALMENT - AMT_PAYMENT)"
    dpd = clip0("(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT)")
    dbd = clip0("(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT)")
    return f"""inst_rows AS (SELECT *, {diff} AS PAYMENT_DIFF,
        {ratio1('AMT_PAYMENT', 'AMT_INSTALMENT')} AS PAYMENT_RATIO,
        {flag_gt0(diff)} AS UNDERPAYMENT, {dpd} AS DPD, {dbd} AS DBD,
        {flag_gt0(dpd)} AS LATE_PAYMENT, {flag_gt0(dbd)} AS EARLY_PAYMENT
      FROM instalments)"""


def instalment_block_ctes(recent_days: int = 365) -> str:
    exprs = _inst_block("INST", None) + _inst_block("INST_REC", f"DAYS_INSTALMENT >= -{recent_days}")
    return ",\n".join([
        instalment_rows_cte(),
        f"instalment_block AS (SELECT SK_ID_CURR, {', '.join(exprs)} FROM inst_rows GROUP BY SK_ID_CURR)",
    ])


POS_COLS = {"MONTHS_BALANCE": "int", "CNT_INSTALMENT": "double", "SK_DPD": "double",
            "SK_DPD_DEF": "double", "NAME_CONTRACT_STATUS": "int", "POS_DPD_FLAG": "int",
            "POS_DPD_DEF_FLAG": "int"}


def _monthly(prefix: str, cols, cond: str | None, named) -> list[str]:
    out = sql_block(prefix, cols, ("mean", "max", "min", "sum"), cond)
    out.append(f"{gate(cond, f'count({val(cond, 'MONTHS_BALANCE')})')} AS {prefix}_N_MONTHS")
    for name, src, stat in named:
        out.append(f"{gate(cond, sql_stat(stat, val(cond, src), 'double'))} AS {prefix}_{name}")
    return out


def pos_block_ctes(recent_months: int = 12) -> str:
    rec = f"MONTHS_BALANCE >= -{recent_months}"
    named = (("DPD_RATE", "POS_DPD_FLAG", "mean"),)
    exprs = _monthly("POS", POS_COLS, None, named) + _monthly("POS_REC", POS_COLS, rec, named)
    return ",\n".join([
        encode_ctes("cpos", "pos_cash", ["NAME_CONTRACT_STATUS"], "pos0"),
        f"""pos1 AS (SELECT *, {flag_gt0('SK_DPD')} AS POS_DPD_FLAG,
              {flag_gt0('SK_DPD_DEF')} AS POS_DPD_DEF_FLAG FROM pos0)""",
        f"pos_main AS (SELECT SK_ID_CURR, {', '.join(exprs)} FROM pos1 GROUP BY SK_ID_CURR)",
        f"""pos_cnt AS (SELECT SK_ID_CURR, NAME_CONTRACT_STATUS, count(*) AS n,
              count(CASE WHEN {rec} THEN 1 END) AS nr FROM pos1 GROUP BY SK_ID_CURR, NAME_CONTRACT_STATUS)""",
        """pos_share AS (SELECT SK_ID_CURR, max(n) / sum(n) AS POS_COMPLETED,
              CASE WHEN sum(nr) > 0 THEN max(nr) / sum(nr) END AS POS_REC_COMPLETED
            FROM pos_cnt GROUP BY SK_ID_CURR)""",
        "pos_block AS (SELECT * FROM pos_main LEFT JOIN pos_share USING (SK_ID_CURR))",
    ])


CARD_COLS = {"MONTHS_BALANCE": "int", "AMT_BALANCE": "double", "AMT_CREDIT_LIMIT_ACTUAL": "double",
             "AMT_PAYMENT_CURRENT": "double", "AMT_INST_MIN_REGULARITY": "double",
             "AMT_DRAWINGS_CURRENT": "double", "SK_DPD": "int", "CC_UTIL_RATIO": "double",
             "CC_PAYMENT_RATIO": "double", "CC_DRAWING_RATIO": "double", "CC_DPD_FLAG": "int"}


def card_block_ctes(recent_months: int = 12) -> str:
    rec = f"MONTHS_BALANCE >= -{recent_months}"
    named = (("DPD_RATE", "CC_DPD_FLAG", "mean"), ("UTIL_MEAN", "CC_UTIL_RATIO", "mean"),
             ("UTIL_MAX", "CC_UTIL_RATIO", "max"), ("PAYMENT_MEAN", "CC_PAYMENT_RATIO", "mean"))
    exprs = _monthly("CC", CARD_COLS, None, named) + _monthly("CC_REC", CARD_COLS, rec, named)
    return ",\n".join([
        f"""cc0 AS (SELECT *, {ratio1('AMT_BALANCE', 'AMT_CREDIT_LIMIT_ACTUAL')} AS CC_UTIL_RATIO,
              {ratio1('AMT_PAYMENT_CURRENT', 'AMT_INST_MIN_REGULARITY')} AS CC_PAYMENT_RATIO,
              {ratio1('AMT_DRAWINGS_CURRENT', 'AMT_CREDIT_LIMIT_ACTUAL')} AS CC_DRAWING_RATIO,
              {flag_gt0('SK_DPD')} AS CC_DPD_FLAG FROM credit_card)""",
        f"card_block AS (SELECT SK_ID_CURR, {', '.join(exprs)} FROM cc0 GROUP BY SK_ID_CURR)",
    ])


APP_BASE_COLS = ["SK_ID_CURR", "TARGET", "CODE_GENDER", "FLAG_OWN_CAR", "NAME_SEGMENT", "REGION_CODE",
                 "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_CHILDREN",
                 "CNT_FAM_MEMBERS", "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH", "EXT_SOURCE_1",
                 "EXT_SOURCE_2", "EXT_SOURCE_3", "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_PHONE",
                 "FLAG_EMAIL"]


def application_features_ctes(source: str = "application") -> str:
    """D5-D14 on the application role, as DuckDB CTEs ending in ``app_feat``."""
    e1, e2, e3 = "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"
    n = f"(CAST({e1} IS NOT NULL AS INTEGER) + CAST({e2} IS NOT NULL AS INTEGER) + CAST({e3} IS NOT NULL AS INTEGER))"
    s = f"(0.0 + coalesce({e1}, 0) + coalesce({e2}, 0) + coalesce({e3}, 0))"
    m = f"({s} / {n})"

    def sq(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN 0 ELSE ({c} - {m}) * ({c} - {m}) END"
    std = f"CASE WHEN {n} > 1 THEN sqrt(({sq(e1)} + {sq(e2)} + {sq(e3)}) / ({n} - 1)) END"
    mean = f"CASE WHEN {n} > 0 THEN {m} END"
    prods = [f"CAST({' * '.join(f'CAST({c} AS DOUBLE)' for c in cols)} AS DOUBLE) AS {name}"
             for name, cols in D.PRODUCTS]
    ratios = [f"{ratio1(a, b)} AS {nm}" for nm, a, b in D.APP_RATIOS_MONEY + D.APP_RATIOS_FAMILY
              if a in APP_BASE_COLS and b in APP_BASE_COLS]
    yrs = "(DAYS_BIRTH / CAST(-365.25 AS DOUBLE))"
    edges = D.AGE_EDGES
    bins = " ".join(f"WHEN {yrs} > {edges[i]} AND {yrs} <= {edges[i + 1]} THEN {i}"
                    for i in range(len(edges) - 1))
    days_ratios = [f"{ratio1(a, b)} AS {nm}" for nm, a, b in D.APP_RATIOS_DAYS
                   if a in APP_BASE_COLS and b in APP_BASE_COLS]
    feat_cols = (APP_BASE_COLS + ["DAYS_EMPLOYED_ANOM", "EXT_MEAN", "EXT_STD", "EXT_MIN", "EXT_MAX",
                                  "EXT_NANCOUNT", "EXT_RANGE"]
                 + [nm for nm, _ in D.PRODUCTS] + ["EXT_WEIGHTED"]
                 + [x.rsplit(" AS ", 1)[1] for x in ratios] + ["DOWN_PAYMENT", "DOWN_PAYMENT_RATIO",
                                                               "DAYS_BIRTH_YRS", "AGE_RANGE",
                                                               "DAYS_EMPLOYED_YRS"]
                 + [x.rsplit(" AS ", 1)[1] for x in days_ratios]
                 + ["DOCUMENT_COUNT", "FLAG_CONTACTS_SUM"])
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in feat_cols)
    return ",\n".join([
        f"""af0 AS (SELECT * REPLACE (CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END AS DAYS_EMPLOYED),
              CAST(coalesce(DAYS_EMPLOYED = 365243, false) AS INTEGER) AS DAYS_EMPLOYED_ANOM FROM {source})""",
        f"""af1 AS (SELECT *, {mean} AS EXT_MEAN, {std} AS EXT_STD,
              CAST(least({e1}, {e2}, {e3}) AS DOUBLE) AS EXT_MIN, CAST(greatest({e1}, {e2}, {e3}) AS DOUBLE) AS EXT_MAX,
              CAST({3} - {n} AS INTEGER) AS EXT_NANCOUNT,
              CAST(greatest({e1}, {e2}, {e3}) AS DOUBLE) - CAST(least({e1}, {e2}, {e3}) AS DOUBLE) AS EXT_RANGE,
              {', '.join(prods)},
              2 * {e2} + {e3} + 0.5 * {e1} AS EXT_WEIGHTED,
              {', '.join(ratios)},
              AMT_GOODS_PRICE - AMT_CREDIT AS DOWN_PAYMENT,
              {ratio1('AMT_GOODS_PRICE - AMT_CREDIT', 'AMT_GOODS_PRICE')} AS DOWN_PAYMENT_RATIO,
              {yrs} AS DAYS_BIRTH_YRS, CASE {bins} END AS AGE_RANGE,
              DAYS_EMPLOYED / CAST(-365.25 AS DOUBLE) AS DAYS_EMPLOYED_YRS,
              {', '.join(days_ratios)},
              CAST(coalesce(FLAG_DOCUMENT_2, 0) + coalesce(FLAG_DOCUMENT_3, 0) AS DOUBLE) AS DOCUMENT_COUNT,
              CAST(coalesce(FLAG_PHONE, 0) + coalesce(FLAG_EMAIL, 0) AS DOUBLE) AS FLAG_CONTACTS_SUM
            FROM af0)""",
        f"app_feat AS (SELECT *, CAST({nulls} AS INTEGER) AS APP_NULLS FROM af1)",
    ])


# ---------------------------------------------------------------- Spark queries

def _bureau_block(spark, d):
    return R.bureau_features(B.bureau(spark, d), B.bureau_balance(spark, d))


def _previous_block(spark, d):
    return R.previous_features(B.previous(spark, d))


def _instalment_block(spark, d):
    return R.instalment_features(B.instalments(spark, d))


def _pos_block(spark, d):
    return R.pos_features(B.pos_cash(spark, d))


def _card_block(spark, d):
    return R.card_features(B.credit_card(spark, d))


def application_block(spark, d, deal: bool = False):
    """Application rows (sentinel gender dropped) with engineered features and
    label-encoded categoricals; with ``deal`` the rows are dealt by customer before the features are built."""
    app = D.filter_not_sentinel(B.application(spark, d), "CODE_GENDER", "XNA")
    app = app.repartition(R.KEY) if deal else app
    feat = D.application_features(app)
    return label_encode(feat, string_columns(feat))


@register("agg_numeric", B.with_roles("bureau", extra=f"""x AS (SELECT SK_ID_CURR, {', '.join(
    sql_block('ORD', {'DAYS_CREDIT': 'int', 'AMT_CREDIT_SUM': 'double', 'AMT_CREDIT_SUM_DEBT': 'double',
                      'AMT_CREDIT_SUM_OVERDUE': 'double', 'CNT_CREDIT_PROLONG': 'int',
                      'AMT_CREDIT_MAX_OVERDUE': 'double'}, STATS5))} FROM bureau GROUP BY SK_ID_CURR)""")
    + "SELECT * FROM x")
def q_agg_numeric(spark, d):
    """R1 on the bureau role: every numeric column x 5 statistics per customer."""
    b = B.bureau(spark, d)
    return R.aggregate_numeric(b, "ORD", exclude=["SK_ID_BUREAU"])


@register("status_history", B.with_roles("bureau_balance", extra=BB_CTE) + "SELECT * FROM bb")
def q_status_history(spark, d):
    return R.status_history(B.bureau_balance(spark, d))


@register("bureau_features", B.with_roles("bureau", "bureau_balance", extra=bureau_block_ctes())
          + "SELECT * FROM bureau_block")
def q_bureau_features(spark, d):
    return _bureau_block(spark, d)


@register("bureau_totals", B.with_roles("bureau", "bureau_balance", extra=bureau_block_ctes())
          + """SELECT SK_ID_CURR, BUR_N_CREDITS, BUR_N_ACTIVE, BUR_DEBT_TOTAL, BUR_CREDIT_TOTAL,
                 BUR_OVERDUE_TOTAL, BUR_PROLONG_TOTAL, BUR_DEBT_RATIO, BUR_MAX_OVERDUE,
                 BUR_DEBT_CREDIT_RATIO FROM bureau_block""")
def q_bureau_totals(spark, d):
    return _bureau_block(spark, d).select(
        "SK_ID_CURR", "BUR_N_CREDITS", "BUR_N_ACTIVE", "BUR_DEBT_TOTAL", "BUR_CREDIT_TOTAL",
        "BUR_OVERDUE_TOTAL", "BUR_PROLONG_TOTAL", "BUR_DEBT_RATIO", "BUR_MAX_OVERDUE",
        "BUR_DEBT_CREDIT_RATIO")


@register("prev_features", B.with_roles("previous", extra=previous_block_ctes())
          + "SELECT * FROM previous_block")
def q_prev_features(spark, d):
    return _previous_block(spark, d)


@register("instalment_rows", B.with_roles("instalments", extra=instalment_rows_cte())
          + "SELECT * FROM inst_rows")
def q_instalment_rows(spark, d):
    return R.instalment_rows(B.instalments(spark, d))


@register("instalment_features", B.with_roles("instalments", extra=instalment_block_ctes())
          + "SELECT * FROM instalment_block")
def q_instalment_features(spark, d):
    return _instalment_block(spark, d)


@register("pos_features", B.with_roles("pos_cash", extra=pos_block_ctes()) + "SELECT * FROM pos_block")
def q_pos_features(spark, d):
    return _pos_block(spark, d)


@register("modal_share", B.with_roles("pos_cash", extra=pos_block_ctes())
          + "SELECT SK_ID_CURR, POS_COMPLETED, POS_REC_COMPLETED FROM pos_share")
def q_modal_share(spark, d):
    p = B.pos_cash(spark, d)
    return R.modal_share(p, "NAME_CONTRACT_STATUS", "POS",
                         recent=F.col("MONTHS_BALANCE") >= -12, recent_prefix="POS_REC")


@register("card_features", B.with_roles("credit_card", extra=card_block_ctes())
          + "SELECT * FROM card_block")
def q_card_features(spark, d):
    return _card_block(spark, d)


@register("merge_blocks", B.with_roles("instalments", "pos_cash", extra=",\n".join(
    [instalment_block_ctes(), pos_block_ctes()]))
    + "SELECT * FROM instalment_block FULL OUTER JOIN pos_block USING (SK_ID_CURR)")
def q_merge_blocks(spark, d):
    """Full outer merge of two blocks with different key sets."""
    return R.merge_blocks([_instalment_block(spark, d), _pos_block(spark, d)])


APP_ENCODE = ["CODE_GENDER", "FLAG_OWN_CAR", "NAME_SEGMENT"]


def _app_oracle_ctes() -> str:
    return ",\n".join([
        "app_f AS (SELECT * FROM application WHERE CODE_GENDER IS DISTINCT FROM 'XNA')",
        application_features_ctes("app_f"),
        encode_ctes("ca", "app_feat", APP_ENCODE, "app_block"),
    ])


@register("application_features", B.with_roles("application", extra=_app_oracle_ctes())
          + "SELECT * FROM app_block")
def q_application_features(spark, d):
    return application_block(spark, d)


@register("relational_matrix", B.with_roles(
    "application", "bureau", "bureau_balance", "previous", "instalments", "pos_cash", "credit_card",
    extra=",\n".join([_app_oracle_ctes(), bureau_block_ctes(), previous_block_ctes(),
                      instalment_block_ctes(), pos_block_ctes(), card_block_ctes()]))
    + """SELECT * FROM app_block
         LEFT JOIN bureau_block USING (SK_ID_CURR) LEFT JOIN previous_block USING (SK_ID_CURR)
         LEFT JOIN instalment_block USING (SK_ID_CURR) LEFT JOIN pos_block USING (SK_ID_CURR)
         LEFT JOIN card_block USING (SK_ID_CURR)""")
def q_relational_matrix(spark, d):
    """One wide row per customer: application features LEFT JOIN 5 blocks."""
    return R.relational_matrix(application_block(spark, d), [
        _bureau_block(spark, d), _previous_block(spark, d), _instalment_block(spark, d),
        _pos_block(spark, d), _card_block(spark, d)])
