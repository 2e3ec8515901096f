import math

from riskframe.functions.exprs import clip_lower, flag_gt, ratio_plus_one
from riskframe.operators import rows as D


def test_ratio_den_minus_one_is_null(spark):
    df = spark.createDataFrame([(5.0, -1.0), (5.0, 4.0)], "n double, d double")
    out = [r[0] for r in df.select(ratio_plus_one("n", "d")).collect()]
    assert out[0] is None and out[1] == 1.0


def test_clip_keeps_null_and_flag_zero(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (2.0,)], "x double")
    rows = df.select(clip_lower("x").alias("c"), flag_gt(clip_lower("x")).alias("f")).collect()
    assert rows[0]["c"] is None and rows[0]["f"] == 0
    assert rows[1]["c"] == 0.0 and rows[2]["f"] == 1


def test_not_sentinel_keeps_null(spark):
    df = spark.createDataFrame([(None,), ("XNA",), ("F",)], "g string")
    kept = sorted([r[0] or "null" for r in D.filter_not_sentinel(df, "g").collect()])
    assert kept == ["F", "null"]


def test_row_stats(spark):
    df = spark.createDataFrame([(0.2, None, 0.6), (0.2, None, None)], "a double, b double, c double")
    r = D.row_stats(df, ["a", "b", "c"]).collect()
    assert math.isclose(r[0]["EXT_MEAN"], 0.4) and math.isclose(r[0]["EXT_STD"], 0.28284271, rel_tol=1e-7)
    assert math.isclose(r[0]["EXT_RANGE"], 0.4) and r[0]["EXT_NANCOUNT"] == 1
    assert r[1]["EXT_STD"] is None


def test_fixed_bins_right_closed(spark):
    df = spark.createDataFrame([(25.0,), (25.01,), (0.0,), (101.0,)], "x double")
    out = [r[0] for r in D.bin_fixed(df, "x", D.AGE_EDGES, "b").select("b").collect()]
    assert out == [0, 1, None, None]
