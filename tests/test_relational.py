import math


from riskframe.operators import relational as R

BUREAU = [(1, 10, "Active", 100.0, 200.0, 0.0, 0, 0.0), (1, 11, "Closed", 0.0, 150.0, 5.0, 1, 5.0),
          (2, 20, "Active", 50.0, 100.0, 0.0, 0, 0.0)]
BUREAU_S = ("SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, AMT_CREDIT_SUM_DEBT double, "
            "AMT_CREDIT_SUM double, AMT_CREDIT_SUM_OVERDUE double, CNT_CREDIT_PROLONG int, AMT_CREDIT_MAX_OVERDUE double")
BB = [(10, -1, "0"), (10, -2, "1"), (11, -1, "C"), (20, -1, "0")]
BB_S = "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string"


def test_bureau_named_totals_and_absent_subset(spark):
    out = R.bureau_features(spark.createDataFrame(BUREAU, BUREAU_S), spark.createDataFrame(BB, BB_S))
    rows = {r["SK_ID_CURR"]: r for r in out.collect()}
    assert set(rows) == {1, 2}
    c1, c2 = rows[1], rows[2]
    assert (c1["BUR_N_CREDITS"], c1["BUR_N_ACTIVE"], c1["BUR_DEBT_TOTAL"], c1["BUR_CREDIT_TOTAL"]) == (2, 1, 100.0, 350.0)
    assert (c1["BUR_OVERDUE_TOTAL"], c1["BUR_PROLONG_TOTAL"], c1["BUR_DEBT_RATIO"], c1["BUR_MAX_OVERDUE"]) == (5.0, 1, 50.0, 5.0)
    assert math.isclose(c1["BUR_DEBT_CREDIT_RATIO"], 100 / 351)
    assert math.isclose(c2["BUR_DEBT_CREDIT_RATIO"], 50 / 101)
    # Customer 2 has no closed credit -> the whole closed block is NULL, sums and counts included
    assert c2["BUR_CLS_AMT_CREDIT_SUM_SUM"] is None and c2["BUR_CLS_AMT_CREDIT_SUM_COUNT"] is None
    assert c1["BUR_CLS_AMT_CREDIT_SUM_SUM"] == 150.0


def test_status_history(spark):
    out = {r["SK_ID_BUREAU"]: r for r in R.status_history(spark.createDataFrame(BB, BB_S)).collect()}
    c10 = out[10]
    assert (c10["BB_MONTHS_COUNT"], c10["BB_STATUS_MAX"], c10["BB_STATUS_MEAN"], c10["BB_MONTHS_MIN"],
            c10["BB_DPD_MONTHS"]) == (2, 1.0, 0.5, -2, 1)
    assert math.isclose(c10["BB_STATUS_STD"], 0.70710678, rel_tol=1e-7)
    assert out[11]["BB_STATUS_STD"] is None


def test_all_null_group_sum_is_zero(spark):
    df = spark.createDataFrame([(9, None), (9, None), (8, 1.0)], "SK_ID_CURR long, x double")
    r = {x["SK_ID_CURR"]: x for x in R.aggregate_numeric(df, "P").collect()}
    assert r[9]["P_x_SUM"] == 0 and r[9]["P_x_MEAN"] is None and r[9]["P_x_COUNT"] == 0


def test_modal_share(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "SK_ID_CURR long, NAME_CONTRACT_STATUS string")
    r = R.modal_share(df, "NAME_CONTRACT_STATUS", "POS").first()
    assert math.isclose(r["POS_COMPLETED"], 2 / 3)


def test_minimal_pipeline_is_schema_adaptive(spark):
    app = spark.createDataFrame([(1, 0, "F"), (2, 1, "M")], "SK_ID_CURR long, TARGET int, CODE_GENDER string")
    bureau = spark.createDataFrame([(1, 10), (2, 20)], "SK_ID_CURR long, SK_ID_BUREAU long")
    bb = spark.createDataFrame([(10, -1, "0"), (20, -1, "1")], BB_S)
    prev = spark.createDataFrame([(1, 100), (2, 200)], "SK_ID_CURR long, SK_ID_PREV long")
    inst = spark.createDataFrame([(1, -10), (2, -20)], "SK_ID_CURR long, DAYS_INSTALMENT int")
    pos = spark.createDataFrame([(1, 100), (2, 200)], "SK_ID_CURR long, SK_ID_PREV long")
    blocks = [R.bureau_features(bureau, bb), R.previous_features(prev), R.instalment_features(inst),
              R.pos_features(pos), R.card_features(pos)]
    m = R.relational_matrix(app, blocks)
    feats = R.feature_columns(m.columns)
    assert "TARGET" not in feats
    tr, te = R.align_columns(m, m.drop("TARGET"), feats)
    assert tr.columns[2:] == te.columns[1:]
    assert m.count() == 2 and m.select("SK_ID_CURR").distinct().count() == 2


def test_ratio_spec_unknown_kind_raises(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    try:
        R.ratio_columns(df, [("x", "a", "b", "product")])
    except R.RelationalError:
        return
    raise AssertionError("expected RelationalError")


def test_merge_blocks_rejects_a_key_that_stands_twice(spark):
    import pytest

    from riskframe.operators import relational as R

    good = spark.createDataFrame([(1, 2.0), (2, 3.0)], "SK_ID_CURR long, a double")
    bad = spark.createDataFrame([(1, 2.0), (1, 3.0)], "SK_ID_CURR long, b double")
    assert R.merge_blocks([good, good.withColumnRenamed("a", "c")]).count() == 2
    with pytest.raises(Exception, match="duplicated SK_ID_CURR"):
        R.merge_blocks([good, bad]).collect()


def test_sides_join_bucketed_blocks_without_an_exchange(spark, tmp_path):
    from pyspark.sql import functions as F

    blocks = [spark.range(40).select((F.col("id") % 20).alias("SK_ID_CURR"), F.col("id").alias(f"v{i}")).groupBy("SK_ID_CURR")
              .agg(F.sum(f"v{i}").alias(f"B{i}")) for i in range(5)]
    train = spark.range(15).selectExpr("id as SK_ID_CURR", "cast(id % 2 as int) as TARGET")
    test = spark.range(10, 30).selectExpr("id as SK_ID_CURR")
    sides = R.matrix_sides([train, test], blocks, str(tmp_path))
    for side, plain in zip(sides, (train, test)):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan
        want = R.relational_matrix(plain, blocks)
        assert sorted(map(str, side.collect())) == sorted(map(str, want.select(side.columns).collect()))


def test_codes_are_broadcast_and_rows_grouped_where_their_key_is(spark):
    """Few values a column: rows are not shuffled by value; hundreds of aggregates: partial rows are not shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prev = spark.createDataFrame([(i % 5, i, "Approved" if i % 3 else None, float(i)) for i in range(60)],
                                     "SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_STATUS string, AMT_CREDIT double")
        out = R.previous_features(prev)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert plan.count("Exchange hashpartitioning(SK_ID_CURR") == 1 and "REPARTITION_BY_COL" in plan
        assert {r["SK_ID_CURR"]: r["PREV_N_APPS"] for r in out.collect()} == dict.fromkeys(range(5), 12)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_frame_of_one_task_is_bucketed_by_many_and_without_dictionaries(spark, tmp_path):
    import pyarrow.parquet as pq

    one = spark.range(0, 50_000, 1, 1).selectExpr("nullif(id % 25000, 7) as SK_ID_CURR", "cast(id % 3 as double) as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        table = R.bucketed(one, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = list(tmp_path.glob("*/*.parquet"))
    assert len({f.name[:10] for f in files}) > 1  # part-00000, part-00001, ...: the tasks that wrote
    encodings = {e for f in files for e in pq.ParquetFile(f).metadata.row_group(0).column(1).encodings}
    assert encodings and not any("DICTIONARY" in e for e in encodings)
    rows = "SK_ID_CURR, count(*) as n, sum(v) as s"
    one.createOrReplaceTempView("one_task")
    table.createOrReplaceTempView("dealt")
    got, want = (spark.sql(f"select {rows} from {t} group by SK_ID_CURR").collect() for t in ("dealt", "one_task"))
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 25_000


def test_whole_statistics_come_from_their_halves(spark):
    """Counts and extremes are kept for the halves only; a half or a column without values changes nothing."""
    from pyspark.sql import functions as F

    rows = [(1, 1, 4, 2.5), (1, 0, None, -1.0), (1, 0, 7, None), (2, 1, 3, None), (3, 0, None, None), (None, 1, 9, 0.5), (None, 1, 9, 0.5)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, f int, i int, x double")
    stats, half = ("mean", "max", "min", "sum", "count"), F.col("f") == 1
    plain = df.groupBy("SK_ID_CURR").agg(*R.numeric_block("A", ["i", "x"], stats))
    blocks = R.numeric_block("A", ["i", "x"], stats, halves=half) + R.numeric_block("P", ["i", "x"], stats, half) + R.numeric_block("Q", ["i", "x"], stats, ~half)
    both = df.groupBy("SK_ID_CURR").agg(*blocks)
    assert both.select(plain.columns).schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, both.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    # without halves: max(i), not only max of each half
    assert "max(i#" not in plan and "count(x#" not in plan
    prev = df.withColumn("NAME_CONTRACT_STATUS", F.when(half, "Approved")).withColumnsRenamed({"x": "AMT_CREDIT", "f": "SK_ID_PREV"})
    plan = R.previous_features(prev).select("SK_ID_CURR", "PREV_AMT_CREDIT_MAX")._jdf.queryExecution().optimizedPlan().toString()
    assert "max(AMT_CREDIT#" not in plan
