"""ML helpers: population-std scaling, exact stratified split, balanced weights,
classification report, MAE."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from marketlake.plans import ml as ML


def test_standardize_uses_population_std(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "x double")
    out = [r["x"] for r in ML.standardize(df, ["x"]).orderBy("x").collect()]
    std_pop = math.sqrt(1.25)  # 1..4: population std, not the sample std 1.291
    assert [round(v, 9) for v in out] == [round((v - 2.5) / std_pop, 9) for v in (1, 2, 3, 4)]


def test_stratified_split_exact_and_deterministic(spark):
    rows = [(i, 1 if i % 5 == 0 else 0) for i in range(1000)]  # 200 positives, 800 negatives
    df = spark.createDataFrame(rows, "k long, y int")
    a = ML.stratified_split(df, "y", "k")
    counts = {(r["y"], r["is_test"]): r["count"] for r in a.groupBy("y", "is_test").count().collect()}
    assert counts == {(1, 1): 40, (1, 0): 160, (0, 1): 160, (0, 0): 640}
    b = ML.stratified_split(df.repartition(7), "y", "k")
    assert a.filter("is_test = 1").select("k").exceptAll(b.filter("is_test = 1").select("k")).count() == 0


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "y int")
    w = {r["y"]: r["weight"] for r in ML.class_weights(df, "y").distinct().collect()}
    assert w == {0: 10 / (2 * 8), 1: 10 / (2 * 2)}


def test_classification_report_and_mae(spark):
    pred = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)],
                                 "label double, prediction double")
    rep = {r["class"]: r for r in ML.classification_report(pred).collect()}
    assert (rep["1"]["precision"], rep["1"]["recall"], rep["1"]["support"]) == (1.0, 0.5, 2)
    assert abs(rep["0"]["precision"] - 2 / 3) < 1e-12 and rep["accuracy"]["f1"] == 0.75
    m = ML.mae(pred.withColumn("prediction", F.col("prediction") + 0.5)).first()
    assert m["n_test"] == 4 and abs(m["mae"] - 0.5) < 1e-12  # |1-1.5|,|1-0.5|,|0-0.5|,|0-0.5|


def test_auc_rank_sum_against_all_pairs(spark):
    import random
    r = random.Random(4)
    rows = [(r.randrange(2), r.choice([0, 0, 0, 1, 2, 5, None])) for _ in range(300)]
    known = [x for x in rows if x[1] is not None]
    pairs = [(p, n) for y, p in known if y for z, n in known if not z]
    want = sum(1 if p > n else 0.5 if p == n else 0 for p, n in pairs) / len(pairs)
    got = ML.auc_rank_sum(spark.createDataFrame(rows, "y int, s int").repartition(5), "y", "s").first()
    assert (got.n_pos, got.n_neg) == (sum(y for y, _ in known), sum(1 - y for y, _ in known)) and abs(got.auc - want) < 1e-12
    one_class = ML.auc_rank_sum(spark.createDataFrame([(1, 2)], "y int, s int"), "y", "s").first()
    assert (one_class.n_pos, one_class.n_neg, one_class.auc) == (1, 0, None)


def test_stratified_members_are_the_smallest_digests(spark):
    import hashlib
    rows = [(i, i % 3) for i in range(500)]
    got = ML.stratified_split(spark.createDataFrame(rows, "k long, y int"), "y", "k")
    digest = lambda k: int(hashlib.md5(f"42|{k}".encode()).hexdigest()[:15], 16)
    want = {k for c in range(3) for k in sorted((k for k, y in rows if y == c), key=digest)[:math.ceil(0.2 * sum(y == c for _, y in rows))]}
    assert {r.k for r in got.where("is_test = 1").collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_too_many_classes_are_an_error(spark):
    import pytest
    with pytest.raises(ValueError, match="class label"):
        ML.class_weights(spark.range(2000).withColumnRenamed("id", "y"), "y")
    with pytest.raises(ValueError, match="class label"):
        ML.stratified_split(spark.createDataFrame([(1, None)], "k long, y int"), "y", "k")


def test_boosting_checkpoints_and_stops_on_the_held_out_fold(spark):
    from pyspark.ml.feature import VectorAssembler
    model = ML.boosted_trees(spark, 60)
    assert model.getCheckpointInterval() == ML.CHECKPOINT_ROUNDS and spark.sparkContext.getCheckpointDir()
    rows = [(float(i % 10), float(i % 10) * 2, i % 5 == 0) for i in range(200)]
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame(rows, "x double, sales double, held_out boolean"))
    fitted = model.setParams(labelCol="sales", validationIndicatorCol="held_out").fit(df)
    assert fitted.getNumTrees < 60
