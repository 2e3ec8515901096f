import math

import numpy as np
from pyspark.sql import functions as F

from riskframe.operators import fit as FT
from riskframe.operators import split as P
from riskframe.operators.ranked import exact_quantiles


def base(spark, n=4000):
    return spark.range(n).select(F.col("id"), (F.col("id") % 7 == 0).cast("int").alias("y"),
                                 (F.col("id") % 2).cast("int").alias("s"))


def test_split_partitions_ids_with_exact_quotas(spark):
    df = base(spark)
    sp = P.stratified_split(df, id_col="id", strata=["y", "s"], seed=42)
    assert sp.count() == 4000 and sp.select("id").distinct().count() == 4000
    for r in sp.groupBy("y", "s").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
        assert r["t"] == math.floor(r["n"] * 0.15 + 0.5)
    again = P.stratified_split(df.repartition(7), id_col="id", strata=["y", "s"], seed=42)
    diff = sp.join(again.withColumnRenamed("split", "s2").select("id", "s2"), "id").filter("split <> s2").count()
    assert diff == 0


def test_split_matches_full_rank(spark):
    df = base(spark, 1000)
    sp = {r["id"]: r["split"] for r in P.stratified_split(df, id_col="id", strata=["y", "s"], seed=3).collect()}
    import hashlib
    pdf = df.toPandas()
    for (_, _), g in pdf.groupby(["y", "s"]):
        ids = sorted(g.id, key=lambda i: (hashlib.md5(f"{i}:3".encode()).hexdigest(), i))
        n = len(ids); nt = math.floor(n * .15 + .5); nv = math.floor((n - nt) * (.15 / .85) + .5)
        for r, i in enumerate(ids):
            want = "test" if r < nt else "validation" if r < nt + nv else "train"
            assert sp[i] == want


def test_split_config_validation():
    try:
        P.validate_fractions(0.6, 0.5)
    except P.SplitConfigError:
        return
    raise AssertionError("expected SplitConfigError")


def test_folds_balanced(spark):
    f = P.kfold_assign(base(spark), id_col="id", strata=["y", "s"], k=5, seeds=[42, 143])
    counts = [r["n"] for r in f.groupBy("seed", "fold").agg(F.count("*").alias("n")).collect()]
    assert len(counts) == 10 and max(counts) - min(counts) <= 4


def test_exact_quantiles_match_numpy(spark):
    vals = [float((i * 37) % 101) for i in range(503)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r["q"]: r["value"] for r in exact_quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.99]).collect()}
    arr = np.array([v for v in vals if v is not None])
    for q, v in got.items():
        assert math.isclose(v, float(np.quantile(arr, q)), rel_tol=1e-12)


def test_target_encode_and_class_weights(spark):
    rows = [("a", 1), ("a", 0), ("b", 0), ("b", 0), ("c", None)]
    df = spark.createDataFrame(rows, "cat string, y int").withColumn(
        "split", F.when(F.col("cat") == "c", "test").otherwise("train"))
    te = {r["cat"]: r["cat_TE"] for r in FT.target_encode(df, "cat", "y").collect()}
    assert math.isclose(te["a"], (2 * .5 + 20 * .25) / 22) and math.isclose(te["c"], .25)
    w = spark.createDataFrame([(1,)] * 2 + [(0,)] * 8, "y int")
    cw = {r["label"]: r["weight"] for r in FT.class_weights(w).collect()}
    assert math.isclose(cw[0], .625) and math.isclose(cw[1], 2.5)


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "f int").withColumn("split", F.lit("train"))
    assert FT.fit_modes(df, ["f"])["f"] == 0.0


def test_weighted_logit_learns_signal(spark):
    import __spark_entry__ as E
    rows = {r["split"]: r for r in E.queries()["score_logit"](spark, "/root/testdata/sf0.001").collect()}
    assert rows["train"]["auc"] > 0.5


def test_label_codes_of_a_large_vocabulary(spark):
    from riskframe.operators.encode import label_encode

    n = 25_000
    df = spark.range(n).selectExpr("id", "concat('v', lpad(cast((id * 7919) % 25000 as string), 5, '0')) as a", "cast(null as string) as b")
    got = label_encode(df, ["a", "b"])
    assert got.agg({"a": "max"}).first()[0] == n - 1
    assert got.where("a != (id * 7919) % 25000").count() == 0
    assert [r["b"] for r in got.select("b").distinct().collect()] == [0]


def test_label_codes_of_train_and_test_share_a_vocabulary(spark):
    from riskframe.operators.encode import apply_label_codes, fit_label_codes

    train = spark.createDataFrame([("b",), ("a",)], "c string")
    test = spark.createDataFrame([("c",), (None,)], "c string")
    codes = fit_label_codes([train, test], ["c"])
    assert sorted(r["c"] for r in apply_label_codes(test, ["c"], codes).collect()) == [2, 3]
    assert [r["c"] for r in apply_label_codes(test, ["c"], fit_label_codes([train], ["c"])).collect()] == [None, None]


def test_one_pass_fit_equals_imputed_quantiles(spark):
    import numpy as np

    from riskframe.operators import fit as FT

    r = np.random.default_rng(5)
    for n, nulls in ((7, 3), (40, 25), (101, 0), (64, 1)):
        v = r.integers(0, 12, n).astype(float)
        rows = [(float(x), "train") for x in v] + [(None, "train")] * nulls + [(99.0, "test")]
        df = spark.createDataFrame(rows, "x double, split string")
        got = FT.fit_preprocess(df, FT.PreprocessSpec(scaled=["x"], binary=["x"], keep=["split"]))
        med = np.median(v)
        full = np.concatenate((v, [med] * nulls))
        q25, q50, q75 = np.quantile(full, [.25, .5, .75])
        assert got.scaled_median["x"] == med and got.robust.median["x"] == q50
        assert abs(got.robust.iqr["x"] - ((q75 - q25) or 1.0)) < 1e-12
        values, counts = np.unique(v, return_counts=True)
        assert got.modes["x"] == values[counts.argmax()]


def test_codes_over_ranges_of_values_with_a_common_beginning(spark):
    from riskframe.operators.encode import dense_index

    values = [("a", f"https://host/user_{i * 7919 % 100003:06d}") for i in range(3000)] + [("b", "x"), ("b", ""), ("b", "Ä")]
    df = spark.createDataFrame(values, "column string, value string")
    want = {(k, v): i for k in "ab" for i, v in enumerate(sorted((x for c, x in values if c == k), key=str.encode))}
    for cell_rows in (50, 20_000):
        got = dense_index(df, "column", "value", cell_rows=cell_rows).collect()
        assert len(got) == len(values) and {(g["column"], g["value"]): g["code"] for g in got} == want
    assert dense_index(df.limit(0), "column", "value").count() == 0
