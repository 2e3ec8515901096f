"""Registered split / fold / fit-on-train queries (P1-P9, F1-F11, D-ops of path A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import fit as FT
from riskframe.operators import relational as R
from riskframe.operators import rows as D
from riskframe.operators import split as P
from riskframe.operators.encode import label_encode
from riskframe.plans import bindings as B
from riskframe.plans.registry import register
from riskframe.sources import contract as C

SEED = 42
FOLD_SEEDS = P.repeat_seeds(SEED, 2)
K = 5
TEST, VAL = 0.15, 0.15
FIN = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE"]
SCALED = ["AGE_YEARS", "EMPLOYED_YEARS", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
          "EXT_NULL_COUNT", "REGION_CODE", "CNT_CHILDREN"]
BINARY = ["EXT_SOURCE_1_WAS_MISSING", "EXT_SOURCE_2_WAS_MISSING", "EXT_SOURCE_3_WAS_MISSING",
          "DAYS_EMPLOYED_ANOM", "FLAG_OWN_CAR"]
# The five market segments of the customer table (the declared one-hot categories).
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CATEG = {"NAME_SEGMENT": SEGMENTS}
KEEP = ["SK_ID_CURR", "TARGET", "SENSITIVE", "split"]
SPEC = FT.PreprocessSpec(FIN, SCALED, BINARY, CATEG, KEEP)


# ---------------------------------------------------------------- oracle pieces

def split_sql(src: str, id_col: str, strata: list[str], name: str, seed: int = SEED,
              test: float = TEST, val: float = VAL) -> str:
    st = " || '_' || ".join(f"CAST({c} AS VARCHAR)" for c in strata)
    return f"""{name}_r AS (SELECT *, row_number() OVER (PARTITION BY {st}
            ORDER BY md5(CAST({id_col} AS VARCHAR) || ':{seed}'), {id_col}) - 1 AS _r,
          count(*) OVER (PARTITION BY {st}) AS _n FROM {src}),
{name}_q AS (SELECT *, floor(CAST(_n AS DOUBLE) * CAST({test!r} AS DOUBLE) + 0.5) AS _nt FROM {name}_r),
{name}_v AS (SELECT *, floor((_n - _nt) * CAST({val / (1.0 - test)!r} AS DOUBLE) + 0.5) AS _nv FROM {name}_q),
{name} AS (SELECT * EXCLUDE (_r, _n, _nt, _nv),
          CASE WHEN _r < _nt THEN 'test' WHEN _r < _nt + _nv THEN 'validation' ELSE 'train' END AS split
        FROM {name}_v)"""


def det_split_ctes() -> str:
    return split_sql("deterministic", "SK_ID_CURR", ["TARGET", "SENSITIVE"], "dsp")


def med_cte(cols, src: str = "dsp", name: str = "med") -> str:
    return f"{name} AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.5) AS m_{c}" for c in cols) + f" FROM {src} WHERE split = 'train')"


def robust_ctes() -> str:
    imputed = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in SCALED)
    stats = ", ".join(f"quantile_cont({c}, 0.5) AS c_{c}, "
                      f"CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1 "
                      f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS w_{c}" for c in SCALED)
    return ",\n".join([
        med_cte(SCALED, name="smed"),
        f"simp AS (SELECT dsp.* REPLACE ({imputed}) FROM dsp, smed)",
        f"rob AS (SELECT {stats} FROM simp WHERE split = 'train')",
    ])


def mode_cte() -> str:
    parts = [f"""(SELECT v FROM (SELECT CAST({c} AS DOUBLE) AS v, count(*) AS n FROM dsp
                  WHERE split = 'train' AND {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v ASC LIMIT 1) AS md_{c}"""
             for c in BINARY]
    return "mode_t AS (SELECT " + ", ".join(parts) + ")"


def preprocess_select() -> str:
    fin = ", ".join(f"coalesce(simp_raw.{c}, m_{c}) AS {c}" for c in FIN)
    sc = ", ".join(f"(coalesce(simp_raw.{c}, m_{c}) - c_{c}) / w_{c} AS {c}" for c in SCALED)
    bi = ", ".join(f"coalesce({c}, CAST(md_{c} AS INTEGER)) AS {c}" for c in BINARY)
    oh = ", ".join(f"CAST(coalesce(NAME_SEGMENT, 'MISSING') = '{v}' AS INTEGER) AS NAME_SEGMENT_{v}"
                   for v in SEGMENTS)
    return (f"SELECT SK_ID_CURR, TARGET, SENSITIVE, split, EXT_NULL_COUNT_RAW, {fin}, {sc}, {bi}, {oh} "
            "FROM (SELECT *, EXT_NULL_COUNT AS EXT_NULL_COUNT_RAW FROM dsp) AS simp_raw, med, smed, rob, mode_t")


def _det_split(spark, d):
    return P.stratified_split(B.deterministic(spark, d), id_col="SK_ID_CURR",
                              strata=["TARGET", "SENSITIVE"], seed=SEED, test=TEST, val=VAL)


# ---------------------------------------------------------------- registered queries

@register("scan_project", B.with_roles("scored") + "SELECT id, p FROM scored WHERE p >= 0.5")
def q_scan_project(spark, d):
    """Scan with projection.  The score is derived, so only IsNotNull on its inputs reaches the scan."""
    return B.scored(spark, d).select("id", "p").filter(F.col("p") >= 0.5)


@register("strata_counts", B.with_roles("labelled_docs")
          + """SELECT CAST(y AS VARCHAR) || '_' || CAST(s AS VARCHAR) AS stratum, count(*) AS n
               FROM labelled_docs WHERE y IS NOT NULL GROUP BY 1""")
def q_strata_counts(spark, d):
    """P1 on the labelled documents (small joint cells); a document without a label has no stratum."""
    return P.strata_counts(B.labelled_docs(spark, d).filter(F.col("y").isNotNull()), ["y", "s"])


@register("strat_split", B.with_roles("scored", extra=split_sql("scored", "id", ["y", "s"], "ssp"))
          + "SELECT * FROM ssp")
def q_strat_split(spark, d):
    """Exact 70/15/15 hash split stratified on target x sensitive."""
    return P.stratified_split(B.scored(spark, d), id_col="id", strata=["y", "s"], seed=SEED)


@register("split_report", B.with_roles("scored", extra=split_sql("scored", "id", ["y", "s"], "ssp"))
          + """SELECT split, count(*) AS n, avg(CAST(y AS DOUBLE)) AS target_rate,
                 avg(CAST(s AS DOUBLE)) AS sensitive_rate,
                 count_if(y = 0 AND s = 0) AS n_y0_s0, count_if(y = 0 AND s = 1) AS n_y0_s1,
                 count_if(y = 1 AND s = 0) AS n_y1_s0, count_if(y = 1 AND s = 1) AS n_y1_s1
               FROM ssp GROUP BY split""")
def q_split_report(spark, d):
    return P.split_report(q_strat_split(spark, d))


@register("split_ids", B.with_roles("scored", extra=split_sql("scored", "id", ["y", "s"], "ssp"))
          + "SELECT split, id FROM ssp")
def q_split_ids(spark, d):
    """P5: (split, id) export table."""
    return q_strat_split(spark, d).select("split", "id")


@register("kfold_assign", B.with_roles("scored") + " UNION ALL ".join(
    f"""SELECT id, {s} AS seed, CAST((row_number() OVER (PARTITION BY CAST(y AS VARCHAR) || '_' || CAST(s AS VARCHAR)
          ORDER BY md5(CAST(id AS VARCHAR) || ':{s}'), id) - 1) % {K} AS INTEGER) AS fold FROM scored"""
    for s in FOLD_SEEDS))
def q_kfold_assign(spark, d):
    """Stratified K folds for two seeds (seed + 101 i)."""
    return P.kfold_assign(B.scored(spark, d), id_col="id", strata=["y", "s"], k=K, seeds=FOLD_SEEDS)


@register("sample_per_class", B.with_roles("scored")
          + f"""SELECT id, y, s, p FROM (SELECT *, row_number() OVER (PARTITION BY CAST(y AS VARCHAR)
                  ORDER BY md5(CAST(id AS VARCHAR) || ':{SEED}'), id) AS rn FROM scored) WHERE rn <= 1000""")
def q_sample_per_class(spark, d):
    """A fixed-size per-class sample (the limit is the feature)."""
    return P.sample_per_class(B.scored(spark, d), id_col="id", label="y", n=1000, seed=SEED)


@register("filter_supported", B.with_roles("application")
          + "SELECT * FROM application WHERE CODE_GENDER IN ('F', 'M')")
def q_filter_supported(spark, d):
    return D.filter_supported(B.application(spark, d), "CODE_GENDER", ["F", "M"])


@register("filter_not_sentinel", B.with_roles("application")
          + "SELECT * FROM application WHERE CODE_GENDER IS DISTINCT FROM 'XNA'")
def q_filter_not_sentinel(spark, d):
    return D.filter_not_sentinel(B.application(spark, d), "CODE_GENDER", "XNA")


@register("deterministic", B.with_roles("deterministic") + "SELECT * FROM deterministic")
def q_deterministic(spark, d):
    """Path A deterministic stage: D1, D3, D4, D5, D6 in one projection."""
    return B.deterministic(spark, d)


@register("impute_median", B.with_roles("deterministic", extra=",\n".join([det_split_ctes(), med_cte(FIN)]))
          + "SELECT SK_ID_CURR, split, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in FIN)
          + " FROM dsp, med")
def q_impute_median(spark, d):
    """exact train medians fill the money columns of every split."""
    df = _det_split(spark, d)
    med = FT.fit_medians(df, FIN)
    return FT.apply_impute(df, med).select("SK_ID_CURR", "split", *FIN)


@register("robust_scale", B.with_roles("deterministic", extra=",\n".join([det_split_ctes(), robust_ctes()]))
          + "SELECT SK_ID_CURR, split, " + ", ".join(f"({c} - c_{c}) / w_{c} AS {c}" for c in SCALED)
          + " FROM simp, rob")
def q_robust_scale(spark, d):
    """median impute then (x - median) / IQR, both fitted on train."""
    df = _det_split(spark, d)
    med = FT.fit_medians(df, SCALED)
    rob = FT.fit_robust(df, SCALED, impute=med)
    return FT.apply_robust(FT.apply_impute(df, med), rob).select("SK_ID_CURR", "split", *SCALED)


@register("impute_mode", B.with_roles("deterministic", extra=",\n".join([det_split_ctes(), mode_cte()]))
          + "SELECT SK_ID_CURR, split, " + ", ".join(f"coalesce({c}, CAST(md_{c} AS INTEGER)) AS {c}" for c in BINARY)
          + " FROM dsp, mode_t")
def q_impute_mode(spark, d):
    df = _det_split(spark, d)
    modes = FT.fit_modes(df, BINARY)
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in modes.items()}) \
             .select("SK_ID_CURR", "split", *BINARY)


@register("one_hot", B.with_roles("deterministic", extra=det_split_ctes())
          + "SELECT SK_ID_CURR, split, " + ", ".join(
              f"CAST(coalesce(NAME_SEGMENT, 'MISSING') = '{v}' AS INTEGER) AS NAME_SEGMENT_{v}" for v in SEGMENTS)
          + " FROM dsp")
def q_one_hot(spark, d):
    """declared categories -> 0/1 columns (others -> all zero)."""
    return FT.apply_one_hot(_det_split(spark, d), CATEG).select("SK_ID_CURR", "split", *[f"NAME_SEGMENT_{v}" for v in SEGMENTS])


@register("one_hot_drop_last", B.with_roles("deterministic") + "SELECT SK_ID_CURR, " + ", ".join(
    f"CAST(coalesce(NAME_SEGMENT, 'MISSING') = '{v}' AS INTEGER) AS NAME_SEGMENT_{v}" for v in SEGMENTS[:-1]) + " FROM deterministic")
def q_one_hot_drop_last(spark, d):
    """the last category has no column."""
    out = FT.apply_one_hot(B.deterministic(spark, d), CATEG, drop_last=True)
    return out.select("SK_ID_CURR", *[f"NAME_SEGMENT_{v}" for v in SEGMENTS[:-1]])


@register("one_hot_sparse", B.with_roles("deterministic", extra=det_split_ctes() + """,
    cat AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS i FROM (
              SELECT DISTINCT coalesce(NAME_SEGMENT, 'MISSING') AS v FROM dsp WHERE split = 'train'))""")
          + """SELECT SK_ID_CURR, CAST((SELECT count(*) FROM cat) AS INTEGER) AS size, i AS index
               FROM dsp LEFT JOIN cat ON coalesce(NAME_SEGMENT, 'MISSING') = v""")
def q_one_hot_sparse(spark, d):
    """F4 for any number of categories: size and index of the one-hot vector."""
    return FT.one_hot_sparse(_det_split(spark, d), "NAME_SEGMENT").select("SK_ID_CURR", "NAME_SEGMENT_VEC.size", "NAME_SEGMENT_VEC.index")


@register("split_60_20_20", B.with_roles("scored", extra=split_sql("scored", "id", ["y"], "s62", test=0.2, val=0.2))
          + "SELECT id, y, split FROM s62")
def q_split_60_20_20(spark, d):
    """60/20/20, stratified on the target alone."""
    return P.stratified_split(B.scored(spark, d), id_col="id", strata=["y"], seed=SEED, test=0.2, val=0.2).select("id", "y", "split")


@register("scaled_by_split", B.with_roles("deterministic", extra=",\n".join([det_split_ctes(), robust_ctes()])) + " UNION ALL ".join(
    f"""SELECT split, '{c}' AS feature, avg(({c} - c_{c}) / w_{c}) AS mean, stddev_samp(({c} - c_{c}) / w_{c}) AS std
        FROM simp, rob GROUP BY split""" for c in SCALED))
def q_scaled_by_split(spark, d):
    """Mean and std of every scaled column in every split."""
    df = _det_split(spark, d)
    out = FT.apply_preprocess(df, FT.fit_preprocess(df, SPEC))
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in SCALED])
    return out.select("split", F.inline(pairs)).groupBy("split", "feature").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))


@register("log_abs", B.with_roles("application") + """SELECT SK_ID_CURR, ln(1 + AMT_CREDIT) AS AMT_CREDIT_LOG,
          abs(DAYS_BIRTH) AS DAYS_BIRTH_ABS FROM application""")
def q_log_abs(spark, d):
    """Log of money and absolute days."""
    return D.log_abs(B.application(spark, d), ["AMT_CREDIT"], ["DAYS_BIRTH"]).select("SK_ID_CURR", "AMT_CREDIT_LOG", "DAYS_BIRTH_ABS")


def _pos(c: str) -> str:
    return f"CASE WHEN {c} < 0 THEN 0.0 ELSE CAST({c} AS DOUBLE) END"


@register("fin_ratios", B.with_roles("deterministic") + "SELECT SK_ID_CURR, " + ", ".join(
    f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL ELSE least(({_pos(a)}) / (({_pos(b)}) + 1.0), 10.0) END AS {n}"
    for n, a, b in D.FIN_RATIOS) + " FROM deterministic")
def q_fin_ratios(spark, d):
    """Clipped ratios of the financial columns."""
    return D.fin_ratios(B.deterministic(spark, d)).select("SK_ID_CURR", *[n for n, _, _ in D.FIN_RATIOS])


@register("gamma_transform", B.with_roles("deterministic")
          + f"SELECT SK_ID_CURR, pow(({_pos('AMT_INCOME_TOTAL')}) + 1e-6, 0.75) AS AMT_INCOME_TOTAL_G FROM deterministic")
def q_gamma_transform(spark, d):
    """A money column to a power."""
    return D.gamma_transform(B.deterministic(spark, d), ["AMT_INCOME_TOTAL"], 0.75, eps=1e-6, suffix="_G").select(
        "SK_ID_CURR", "AMT_INCOME_TOTAL_G")


ALIGNED = ["AMT_CREDIT", "AMT_ANNUITY", "EXT_SOURCE_2", "EXT_SOURCE_3"]


@register("align_columns", B.with_roles("deterministic", extra=det_split_ctes())
          + """SELECT SK_ID_CURR, AMT_CREDIT, AMT_ANNUITY, EXT_SOURCE_2, CAST(NULL AS DOUBLE) AS EXT_SOURCE_3
               FROM dsp WHERE split = 'test'""")
def q_align_columns(spark, d):
    """The test side gets the training side's columns in order, without the target."""
    df = _det_split(spark, d)
    train, test = (df.where(F.col("split") == x) for x in ("train", "test"))
    return R.align_columns(train, test.drop("EXT_SOURCE_3", "TARGET"), ALIGNED)[1]


@register("sigmoid_indices", B.with_roles("deterministic") + """SELECT SK_ID_CURR, 1 / (1 + exp(-(3.0 * (EXT_SOURCE_2 - 0.5)))) AS RISK_SAT,
          1 / (1 + exp(-(-1.0 + 2.0 * EXT_SOURCE_2 + -0.5 * EXT_SOURCE_3))) AS SCORE_INDEX FROM deterministic""")
def q_sigmoid_indices(spark, d):
    """Saturating risk and a weighted index of two scores."""
    out = D.sigmoid_indices(B.deterministic(spark, d), risk_col="EXT_SOURCE_2", alpha=3.0, theta=0.5,
                            weights={"EXT_SOURCE_2": 2.0, "EXT_SOURCE_3": -0.5}, bias=-1.0)
    return out.select("SK_ID_CURR", "RISK_SAT", "SCORE_INDEX")


@register("preprocess_full", B.with_roles("deterministic", extra=",\n".join(
    [det_split_ctes(), med_cte(FIN), robust_ctes(), mode_cte()])) + preprocess_select())
def q_preprocess_full(spark, d):
    """F5 + F6: fit every transformer on train, apply to all splits, keep the raw
    audit null count beside its scaled copy."""
    df = _det_split(spark, d)
    fitted = FT.fit_preprocess(df, SPEC)
    return FT.apply_preprocess(df, fitted, raw_copies={"EXT_NULL_COUNT": "EXT_NULL_COUNT_RAW"})


PREPROCESSED_SQL = B.with_roles("deterministic", extra=",\n".join(
    [det_split_ctes(), med_cte(FIN), robust_ctes(), mode_cte(), f"prepared AS ({preprocess_select()})"]))


@register("preprocess_nulls", PREPROCESSED_SQL + "SELECT " + ", ".join(
    f"count_if({c} IS NULL) AS {c}" for c in FIN + SCALED + BINARY) + " FROM prepared")
def q_preprocess_nulls(spark, d):
    """F6 check: values still missing in every model input after fitting on train and applying to all splits."""
    return FT.null_violations(q_preprocess_full(spark, d), FIN + SCALED + BINARY)


@register("finite_checks", PREPROCESSED_SQL + " UNION ALL ".join(
    f"SELECT '{t}.{c}' AS rule, count_if({c} IS NULL OR NOT isfinite(CAST({c} AS DOUBLE))) AS violations FROM {src}"
    for t, src in (("raw", "deterministic"), ("prepared", "prepared")) for c in FIN + SCALED))
def q_finite_checks(spark, d):
    """Rows whose model input is missing or not finite, before and after preprocessing."""
    def checks(df, name):
        return C.domain_checks(df, {f"{name}.{c}": C.finite_rule(c) for c in FIN + SCALED})
    return checks(B.deterministic(spark, d), "raw").unionByName(checks(q_preprocess_full(spark, d), "prepared"))


@register("class_weights", B.with_roles("deterministic", extra=det_split_ctes())
          + """SELECT TARGET AS label, count(*) AS n_c,
                 CAST(sum(count(*)) OVER () AS DOUBLE) / (2.0 * count(*)) AS weight
               FROM dsp WHERE split = 'train' GROUP BY TARGET""")
def q_class_weights(spark, d):
    """balanced class weights from the training rows."""
    df = _det_split(spark, d).filter(F.col("split") == "train")
    return FT.class_weights(df, "TARGET")


@register("standard_scale", B.with_roles("deterministic", extra=det_split_ctes()
                                         + ",\nst AS (SELECT " + ", ".join(
                                             f"avg({c}) AS a_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1 ELSE stddev_pop({c}) END AS s_{c}"
                                             for c in FIN) + " FROM dsp WHERE split = 'train')")
          + "SELECT SK_ID_CURR, split, " + ", ".join(f"({c} - a_{c}) / s_{c} AS {c}" for c in FIN)
          + " FROM dsp, st")
def q_standard_scale(spark, d):
    """F8: mean / population-std scaling fitted on train."""
    df = _det_split(spark, d)
    params = FT.fit_standard(df, FIN)
    return FT.apply_standard(df, params).select("SK_ID_CURR", "split", *FIN)


@register("target_encode", B.with_roles("deterministic", extra=det_split_ctes()
                                        + """,\ng AS (SELECT avg(CAST(TARGET AS DOUBLE)) AS g FROM dsp WHERE split = 'train'),
enc AS (SELECT NAME_SEGMENT, (count(*) * avg(CAST(TARGET AS DOUBLE)) + 20.0 * max(g)) / (count(*) + 20.0) AS te
        FROM dsp, g WHERE split = 'train' GROUP BY NAME_SEGMENT)""")
          + """SELECT dsp.SK_ID_CURR, dsp.split, dsp.NAME_SEGMENT, coalesce(enc.te, g.g) AS NAME_SEGMENT_TE
               FROM dsp LEFT JOIN enc USING (NAME_SEGMENT), g""")
def q_target_encode(spark, d):
    """smoothed target encoding fitted on train (unseen -> global rate)."""
    df = _det_split(spark, d)
    return FT.target_encode(df, "NAME_SEGMENT", "TARGET").select("SK_ID_CURR", "split", "NAME_SEGMENT",
                                                                 "NAME_SEGMENT_TE")


@register("label_encode", B.with_roles("application")
          + """, cg AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
                   FROM (SELECT DISTINCT coalesce(CODE_GENDER, 'nan') AS v FROM application)),
               cs AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
                   FROM (SELECT DISTINCT coalesce(NAME_SEGMENT, 'nan') AS v FROM application))
             SELECT SK_ID_CURR, cg.code AS CODE_GENDER, cs.code AS NAME_SEGMENT FROM application
             LEFT JOIN cg ON coalesce(CODE_GENDER, 'nan') = cg.v LEFT JOIN cs ON coalesce(NAME_SEGMENT, 'nan') = cs.v""")
def q_label_encode(spark, d):
    """sorted-vocabulary codes of string columns."""
    app = B.application(spark, d).select("SK_ID_CURR", "CODE_GENDER", "NAME_SEGMENT")
    return label_encode(app, ["CODE_GENDER", "NAME_SEGMENT"])


@register("debt_ratio", B.with_roles("deterministic", extra=",\n".join([det_split_ctes(), med_cte(["AMT_ANNUITY"])]))
          + """SELECT SK_ID_CURR, split, CASE WHEN r > 3 THEN CAST(3 AS DOUBLE) ELSE r END AS DEBT_RATIO FROM (
                 SELECT SK_ID_CURR, split, coalesce(AMT_ANNUITY, m_AMT_ANNUITY) / NULLIF(AMT_INCOME_TOTAL, 0) AS r
                 FROM dsp, med)""")
def q_debt_ratio(spark, d):
    """Annuity (train median fill) / income, capped at 3."""
    df = _det_split(spark, d)
    med = FT.fit_medians(df, ["AMT_ANNUITY"])["AMT_ANNUITY"]
    return D.debt_ratio(df, med).select("SK_ID_CURR", "split", "DEBT_RATIO")
