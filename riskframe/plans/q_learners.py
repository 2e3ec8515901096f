"""Registered runs of the boosted learners (W6, W7, W9, W12), error models on them (U2, U7) and replicates (U8)."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from riskframe.operators import audit as A
from riskframe.operators import oof as O
from riskframe.operators import relational as R
from riskframe.operators import split as P
from riskframe.operators import sweep as W
from riskframe.operators import uncertainty as U
from riskframe.plans import bindings as B
from riskframe.plans.q_prep import SEED, det_split_ctes
from riskframe.plans.registry import ORACLE, register
from riskframe.session import checkpoint_dir, cut_lineage, freed_shuffles, remove
from riskframe.sources.runs import read_run, write_run
from riskframe.sources.tables import read_csv_apart, read_table

ID, TARGET, STRATA = "SK_ID_CURR", "TARGET", ["TARGET", "SENSITIVE"]
TREE_FEATURES = ["AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AGE_YEARS",
                 "EMPLOYED_YEARS", "CNT_CHILDREN", "REGION_CODE", "EXT_NULL_COUNT"]
#: Folds and seeds of the boosted trees, as in the reference.
FOLDS, SEEDS = 5, (SEED, SEED + 101)
#: The learners with smaller least nodes: the test tables have some thousand customers, not hundreds of thousands.
LEARNERS = {"depth_wise": replace(O.DEPTH_WISE, min_weight=4), "leaf_wise": replace(O.LEAF_WISE, min_weight=4, min_rows=20)}
DEPTH_WISE = {"depth_wise": LEARNERS["depth_wise"]}
#: Over the many columns of the matrix: larger least nodes and steps.
WIDE = {"depth_wise": replace(O.DEPTH_WISE, min_weight=20, rate=0.4, patience=5)}
#: Refits of a bagged scorer.
REPLICATES = 20
TOP = 25


def _root(spark) -> str:
    """A new folder for runs below the cluster's shared one."""
    return f"{checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex}"


def _customers(spark, d):
    return B.deterministic(spark, d).select(ID, *STRATA, *TREE_FEATURES)


def _split_customers(spark, d):
    """(rows to learn from, test rows that no model sees): 85 / 15 by strata."""
    df = cut_lineage(P.stratified_split(_customers(spark, d), id_col=ID, strata=STRATA, seed=SEED))
    return df.where("split != 'test'"), df.where("split = 'test'")


def _parts(oof):
    """AUC of every fold, of every seed, and of the score averaged over seeds with its accuracy at 0.5, per learner."""
    oof = cut_lineage(oof.withColumnRenamed(TARGET, "y"))
    key = ["learner"]
    fold = A.roc_auc(oof, [*key, "seed", "fold"]).select(*key, F.concat_ws("/", F.lit("fold"), "seed", "fold").alias("part"), "auc")
    seed = A.roc_auc(oof, [*key, "seed"]).select(*key, F.concat_ws("/", F.lit("seed"), "seed").alias("part"), "auc")
    mean = W.oof_average(oof, id_col=ID, keys=key).withColumn("part", F.lit("mean"))
    accuracy = A.binary_metrics(A.apply_threshold(mean, 0.5), [*key, "part"]).select(*key, "part", "accuracy")
    rows = fold.unionByName(seed).withColumn("accuracy", F.lit(None).cast("double"))
    return rows.unionByName(A.roc_auc(mean, [*key, "part"]).join(accuracy, [*key, "part"]).select(*key, "part", "auc", "accuracy"))


@register("oof_gbt")
def q_oof_gbt(spark, d):
    """Depth-wise boosted trees per fold and seed; AUC of every fold, of every
    seed, and of the score averaged over seeds with its accuracy at 0.5."""
    run = O.run(_customers(spark, d), TREE_FEATURES, TARGET, id_col=ID, strata=STRATA, k=FOLDS, seeds=SEEDS, learners=DEPTH_WISE)
    return _parts(run.oof).drop("learner")


@register("oof_ab")
def q_oof_ab(spark, d):
    """Depth-wise against leaf-wise trees on the same folds, grown in the same passes."""
    return _parts(O.run(_customers(spark, d), TREE_FEATURES, TARGET, id_col=ID, strata=STRATA, k=FOLDS, seeds=SEEDS, learners=LEARNERS).oof)


@register("gbt_test_scores")
def q_gbt_test_scores(spark, d):
    """W6, test side: scores of rows that no model saw, averaged over all folds and seeds of a learner."""
    known, test = _split_customers(spark, d)
    run = O.run(known, TREE_FEATURES, TARGET, id_col=ID, strata=STRATA, k=FOLDS, seeds=SEEDS, learners=LEARNERS)
    return O.score_table(test, run.forest, [ID, TARGET])


def _matrix_importance(spark, d):
    """Importance over the relational matrix, averaged over the models of all folds and seeds.

    The blocks of the matrix are stored one after the other, each one's shuffles deleted before the next, and joined without
    a shuffle.  Those with the largest shuffles come first, while little is stored.
    """
    from riskframe.plans import q_relational as Q
    root, stored = _root(spark), {}
    blocks = {"instalment": Q._instalment_block, "bureau": Q._bureau_block, "previous": Q._previous_block,
              "application": lambda *at: Q.application_block(*at, deal=True), "card": Q._card_block, "pos": Q._pos_block}

    def release():
        for table in stored.values():
            spark.sql(f"DROP TABLE {table}")
        remove(spark, root)

    with freed_shuffles(spark):
        for name, block in blocks.items():
            stored[name] = f"matrix_{name}_{uuid.uuid4().hex}"
            R.bucketed(block(spark, d), root, name=stored[name], codec="zstd")
        m = R.relational_matrix(spark.table(stored["application"]), [
            spark.table(stored[name]).hint("merge") for name in ("bureau", "previous", "instalment", "pos", "card")])
        features = [c for c, t in m.dtypes if c not in (ID, TARGET) and t in ("int", "bigint", "double")]
        run = O.run(m, features, TARGET, id_col=ID, strata=[TARGET], k=FOLDS, seeds=SEEDS, learners=WIDE, release=release)
    return run.mean_importance()


@register("importance_by_source")
def q_importance_by_source(spark, d):
    """Importance of boosted trees over the relational matrix, summed per source table."""
    return W.importance_by_source(_matrix_importance(spark, d))


@register("importance_top")
def q_importance_top(spark, d):
    """The features with the largest importance (the limit is the feature)."""
    return W.top_n(_matrix_importance(spark, d), TOP, "importance", tiebreak="feature")


@register("top_features", f"SELECT * FROM ({ORACLE['fast_abs_corr']}) ORDER BY abs_corr_target DESC, feature LIMIT 5")
def q_top_features(spark, d):
    """The features that correlate most with the target (the limit is the feature)."""
    from riskframe.plans.q_analysis import q_fast_abs_corr
    return W.top_n(q_fast_abs_corr(spark, d), 5, "abs_corr_target", tiebreak="feature")


@register("ablation_gain")
def q_ablation_gain(spark, d):
    """Out-of-fold AUC of both learners with the compact and with the extended columns."""
    from riskframe.plans.q_relational import application_block
    base = cut_lineage(_customers(spark, d))
    block = application_block(spark, d)
    extra = [c for c, t in block.dtypes if c not in base.columns and t in ("int", "bigint", "double")]
    wide = cut_lineage(base.join(block.select(ID, *extra), ID))
    aucs = []
    for features in (TREE_FEATURES, TREE_FEATURES + extra):
        run = O.run(wide, features, TARGET, id_col=ID, strata=STRATA, k=FOLDS, seeds=SEEDS[:1], learners=LEARNERS)
        aucs.append(A.roc_auc(run.oof.withColumnRenamed(TARGET, "y"), ["learner"]).withColumnRenamed("learner", "model"))
    return W.ablation_gain(*aucs)


@register("experiment_table", f"""WITH m AS ({ORACLE['evaluate_models']}), f AS ({ORACLE['oof_metrics']})
    SELECT 'sweep' AS experiment, model_id, auc, ap, accuracy, abs_rho, NULL::DOUBLE AS fold_auc_mean, NULL::DOUBLE AS fold_auc_std,
           NULL::BIGINT AS n_folds FROM m
    UNION ALL SELECT 'folds', NULL, NULL, NULL, NULL, NULL, fold_auc_mean, fold_auc_std, n_folds FROM f""")
def q_experiment_table(spark, d):
    """One table of all experiments, the sweep's models and the fold summary; missing columns are null."""
    from riskframe.plans.q_analysis import q_oof_metrics
    from riskframe.plans.q_audit import q_evaluate_models
    sweep = q_evaluate_models(spark, d).select(F.lit("sweep").alias("experiment"), "model_id", "auc", "ap", "accuracy", "abs_rho")
    folds = q_oof_metrics(spark, d).select(F.lit("folds").alias("experiment"), "fold_auc_mean", "fold_auc_std", "n_folds")
    return W.experiment_table([sweep, folds])


@register("matrix_test_side", f"""WITH m AS ({ORACLE['relational_matrix']}),
    t AS ({B.with_roles("deterministic", extra=det_split_ctes())} SELECT SK_ID_CURR FROM dsp WHERE split = 'test')
    SELECT * EXCLUDE (TARGET) FROM m WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM t)""")
def q_matrix_test_side(spark, d):
    """R12 + R14, test side: the wide matrix of rows without a target, joined from the same bucketed blocks and with the same
    codes as the training side, its columns in the training side's order."""
    from riskframe.plans import q_relational as Q
    application = Q.application_block(spark, d, deal=True)  # codes are fitted on both sides together
    split = cut_lineage(P.stratified_split(B.deterministic(spark, d), id_col=ID, strata=STRATA, seed=SEED).select(ID, "split"))
    # a side's ids grow with the customers: they are not broadcast
    known = application.join(split.where("split != 'test'").hint("merge"), ID, "left_semi")
    test = application.join(split.where("split = 'test'").hint("merge"), ID, "left_semi").drop(TARGET)
    blocks = [Q._bureau_block(spark, d), Q._previous_block(spark, d), Q._instalment_block(spark, d), Q._pos_block(spark, d), Q._card_block(spark, d)]
    train, test = R.matrix_sides([known, test], blocks, _root(spark))
    return R.align_columns(train, test, R.feature_columns(train.columns, sensitive=None))[1]


def _errors(spark, d):
    """(errors of out-of-fold scores on the rows to learn from, with their features; test rows with the mean score)."""
    known, test = _split_customers(spark, d)
    run = O.run(known, TREE_FEATURES, TARGET, id_col=ID, strata=STRATA, k=FOLDS, seeds=SEEDS[:1], learners=DEPTH_WISE)
    rows = known.join(run.oof.select(ID, "fold", "p"), ID).withColumnRenamed(TARGET, "y")
    unseen = O.score_table(test, run.forest, [ID, *STRATA]).select(ID, F.col(TARGET).alias("y"), "SENSITIVE", "p")
    return U.error_target(rows), unseen.join(test.select(ID, *TREE_FEATURES), ID)


@register("oof_errors_gbt")
def q_oof_errors_gbt(spark, d):
    """|score - label| of every row that is learnt from, by the model that did not see it."""
    return _errors(spark, d)[0].select(F.col(ID).alias("id"), "y", F.col("SENSITIVE").alias("s"), "p", "abs_error", "fold")


def _uncertain(spark, d):
    errors, test = (cut_lineage(x) for x in _errors(spark, d))
    forest = O.fit_error(errors, TREE_FEATURES, id_col=ID)
    return errors, O.predict_error(test, forest, [ID, "y", "SENSITIVE", "p", "EXT_NULL_COUNT"])


@register("uncertainty_gbt")
def q_uncertainty_gbt(spark, d):
    """U2 + U4: an absolute-loss error model fitted on out-of-fold errors, applied to test rows that no model saw."""
    errors, rows = _uncertain(spark, d)
    threshold = A.youden(errors).first()["threshold"]
    return U.prediction_table(rows, id_col=ID, sensitive="SENSITIVE", threshold=threshold, null_count="EXT_NULL_COUNT")


@register("uncertainty_mae")
def q_uncertainty_mae(spark, d):
    """Mean absolute error of the predicted error on test rows, by the trees and by score bins."""
    errors, rows = _uncertain(spark, d)
    binned = U.apply_binned_error(rows, U.fit_binned_error(errors), out="binned")
    miss = lambda c: F.avg(F.abs(F.abs(F.col("p") - F.col("y")) - F.col(c)))
    return binned.agg(F.count(F.lit(1)).alias("n"), miss("uncertainty").alias("mae_trees"), miss("binned").alias("mae_bins"))


@register("bagged_variance")
def q_bagged_variance(spark, d):
    """U8: mean and variance of every test row's score over refits on bootstrap weights."""
    known, test = _split_customers(spark, d)
    forest = O.bagged(known, TREE_FEATURES, TARGET, id_col=ID, params=replace(DEPTH_WISE["depth_wise"], columns=1.0), replicates=REPLICATES, seed=SEED)
    return O.score_table(test, forest, [ID, TARGET]).select(
        F.col(ID).alias("id"), F.col(TARGET).alias("y"), F.col("p").alias("mean_p"), "var_p", F.col("n_models").alias("n_passes"))


@register("committed_run", ORACLE["evaluate_models"])
def q_committed_run(spark, d):
    """Sweep metrics and fold summary written as one committed run, the metrics read back by the manifest."""
    from riskframe.plans.q_analysis import q_oof_metrics
    from riskframe.plans.q_audit import q_evaluate_models
    root = _root(spark)
    write_run(spark, root, "sweep", {"metrics": q_evaluate_models(spark, d), "folds": q_oof_metrics(spark, d)}, {"seed": SEED})
    return read_run(spark, root, "sweep")["metrics"]


@register("csv_apart", """
SELECT c_nationkey, count(*) AS n_rows, sum(c_acctbal) AS balance, count(c_mktsegment) AS n_segments FROM customer
WHERE c_custkey % 10 NOT IN (1, 2, 3) GROUP BY c_nationkey
UNION ALL SELECT CAST(NULL AS INTEGER), count(*), CAST(NULL AS DOUBLE), CAST(0 AS BIGINT) FROM customer WHERE c_custkey % 10 IN (1, 2, 3)""")
def q_csv_apart(spark, d):
    """Customers written as CSV, some lines with a word for a number, a field too few or too many; totals of the
    rows that fit, and (without nation) the number of lines that do not."""
    path = f"{_root(spark)}/customer.csv"
    fields = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    kind, text = F.col("c_custkey") % 10, [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields.columns]
    line = F.when(kind == 1, F.concat_ws(",", F.lit("none"), *text[1:])).when(kind == 2, F.concat_ws(",", *text[:3]))
    line = line.when(kind == 3, F.concat_ws(",", *text, F.lit("more"))).otherwise(F.concat_ws(",", *text))
    fields.select(line.alias("value")).write.text(path)
    good, bad = read_csv_apart(spark, path, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string", header=False)
    whole = good.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("c_acctbal").alias("balance"),
                                            F.count("c_mktsegment").alias("n_segments"))
    return whole.unionByName(bad.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(None).cast("int").alias("c_nationkey"), "n_rows", F.lit(None).cast("double").alias("balance"),
        F.lit(0).cast("bigint").alias("n_segments")))


@register("gbt_run_tables")
def q_gbt_run_tables(spark, d):
    """All tables of an out-of-fold run of both learners, committed and read back; one row per table."""
    known, test = _split_customers(spark, d)
    run = O.run(known, TREE_FEATURES, TARGET, id_col=ID, strata=STRATA, k=FOLDS, seeds=SEEDS[:1], learners=LEARNERS)
    tables = O.result_tables(run, id_col=ID, label=TARGET, test=O.score_table(test, run.forest, [ID]))
    root = _root(spark)
    manifest = write_run(spark, root, "gbt", tables, {"folds": FOLDS, "seeds": list(SEEDS[:1])})
    read_run(spark, root, "gbt")
    return manifest.select("run_id", F.explode("tables").alias("table_name", "n_rows"))
