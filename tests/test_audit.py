import math

from pyspark.sql import functions as F

from riskframe.operators import audit as A


def scored(spark, y, p, s=None):
    s = s or [0] * len(y)
    return spark.createDataFrame(list(zip(range(len(y)), y, p, s)), "id long, y int, p double, s int")


def test_roc_auc_ties(spark):
    assert math.isclose(A.roc_auc(scored(spark, [1, 0, 1, 0], [.8, .8, .6, .1])).first()["auc"], .625)


def test_average_precision(spark):
    assert math.isclose(A.pr_auc(scored(spark, [1, 0, 1, 0], [.8, .8, .6, .1])).first()["ap"], .5 * .5 + .5 * 2 / 3)


def test_youden(spark):
    r = A.youden(scored(spark, [1, 0, 1, 0], [.8, .8, .6, .1])).first()
    assert r["threshold"] == .6 and math.isclose(r["youden_j"], .5)
    assert A.youden(scored(spark, [1, 0, 1, 0], [.9, .7, .5, .3])).first()["threshold"] == .9
    r = A.youden(scored(spark, [0, 1], [.9, .1])).first()
    assert r["threshold"] == 1.0 and r["youden_j"] == 0.0


def test_best_f1_tie_smallest(spark):
    r = A.best_f1(scored(spark, [1, 1], [.9, .4])).first()
    assert r["threshold"] == 0.0 and r["f1"] == 1.0


def test_constant_score_abs_rho_zero(spark):
    assert A.abs_rho(scored(spark, [0, 1, 0, 1], [.5] * 4, [0, 1, 1, 0])).first()["abs_rho"] == 0.0


def test_fairness(spark):
    df = spark.createDataFrame([(1, 1, 0), (0, 0, 0), (1, 0, 1), (0, 0, 1)], "y int, y_hat int, s int")
    r = A.fairness(df).first()
    assert r["dpd"] == .5 and r["eod"] == 1.0


def test_auc_symmetry_and_bucketing(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"),
                                  ((F.col("id") * 7919) % 1000 / 1000.0 + (F.col("id") % 3 == 0).cast("double") * .2)
                                  .alias("p"), F.lit(0).alias("s"))
    a = A.roc_auc(df).first()["auc"]
    b = A.roc_auc(df.withColumn("p", -F.col("p"))).first()["auc"]  # exact negation keeps ties
    c = A.roc_auc(df, n_buckets=1).first()["auc"]
    assert math.isclose(a + b, 1.0) and math.isclose(a, c)
    pdf = df.toPandas()
    pos, neg = pdf[pdf.y == 1].p.values, pdf[pdf.y == 0].p.values
    brute = sum(((x > neg).sum() + .5 * (x == neg).sum()) for x in pos) / (len(pos) * len(neg))
    assert math.isclose(a, brute)


def test_same_result_for_1_and_8_partitions(spark):
    df = scored(spark, [1, 0, 1, 0, 1, 1, 0, 0], [.8, .8, .6, .1, .3, .9, .2, .3])
    a = A.roc_auc(df.repartition(1)).first()["auc"]
    b = A.roc_auc(df.repartition(8)).first()["auc"]
    assert a == b


def test_auc_and_youden_of_ten_billion_rows(spark):
    from riskframe.operators import audit as A
    from riskframe.operators.ranked import with_cumulative

    big = 5 * 10**9
    df = spark.createDataFrame([(.9, big, 0), (.8, 0, big), (.7, big, 0)], "score double, pos bigint, neg bigint")
    rows = df.selectExpr("score as p", "explode(array(struct(1 as y, pos as w), struct(0 as y, neg as w))) as e").select("p", "e.*")
    assert abs(A.roc_auc(rows, [], weight="w").first()["auc"] - .5) < 1e-12
    assert with_cumulative(df, []).count() == 3


def test_large_ranges_are_cut_again(spark):
    import random

    from riskframe.operators.ranked import score_counts, with_cumulative

    r = random.Random(4)
    rows = [(m, r.choice([0.5, r.random(), 1e-9 * r.random()]), int(r.random() < .3)) for m in range(2) for _ in range(1500)]
    counts = score_counts(spark.createDataFrame(rows, "m int, p double, y int"), ["m"])
    want = {(m, p): (sum(1 for a, b, y in rows if a == m and b > p and y == 1), sum(1 for a, b, y in rows if a == m and b > p and y == 0))
            for m, p in {(a, b) for a, b, _ in rows}}
    for grid in (True, False):
        for bucket_rows in (5, 10**6):
            got = with_cumulative(counts, ["m"], n_buckets=8, bucket_rows=bucket_rows, grid=grid).collect()
            assert {(g["m"], g["score"]): (g["tp_above"], g["fp_above"]) for g in got} == want
            assert len(got) == len(want)


def test_scored_rows_are_never_broadcast(spark):
    """The rows of a model grid are more than the planner's estimate of them; only one row a model is broadcast."""
    rows = spark.range(400).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 2).cast("int").alias("s"),
                                   F.explode(F.array(F.lit("a"), F.lit("b"))).alias("model_id"))
    out = A.evaluate_models(rows.withColumn("p", F.col("id") / 400.0))
    assert "BuildLeft" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 2


def test_split_of_the_sweep_is_joined_without_a_broadcast(spark, tmp_path):
    from riskframe.plans import q_analysis as Q
    from riskframe.plans.q_checks import sweep_split
    spark.range(300).select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"),
                            F.when(F.col("id") % 3 == 0, "F").otherwise("O").alias("o_orderstatus")).write.parquet(f"{tmp_path}/orders.parquet")
    for rows, n in ((sweep_split(spark, str(tmp_path)), 300 * 9), (Q._seed_test_rows(spark, str(tmp_path)), None)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [id" not in plan and "SortMergeJoin [id" in plan
        assert n is None or rows.count() == n
