"""Machine-learning jobs (ML-1..15) on ``pyspark.ml``.

The notebook's single-machine models are re-aimed at Spark's distributed
learners; tree libraries differ, so parity is on *procedure* (features,
split, weights, hyper-parameters, metrics), not on identical numbers.

* standardisation uses the **population** std (one aggregate pass, 2 scalars
  per feature to the driver);
* the stratified split is exact and deterministic: of each class the rows with the
  smallest seeded digests, up to a cut digest that counting passes find for all
  classes at once (``operators.quantiles``) — no rank, no per-class window (a class
  can hold half of all rows) and no ``randomSplit`` (approximate, partition-dependent);
* class weights ``n / (k * n_c)`` come from the per-class counts;
* the classification report comes from one confusion matrix, the AUC from exact
  rank sums over the distinct scores, the MAE from one aggregate; each model's
  predictions are written once and every metric reads them.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.forest import forest
from marketlake.operators.numbering import numbered, running_totals, staged
from marketlake.operators.quantiles import select_ranks
from marketlake.operators.series import add_lags, chronological_split, series_features
from marketlake.functions import dates as D
from marketlake.session import ensure_checkpoint_dir

SEED = 42


# ---------------------------------------------------------------- ML-1
def standardize(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """Centre and scale by the population std (a zero std scales by 1)."""
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = df
    for i, c in enumerate(cols):
        m, s = stats[f"m{i}"] or 0.0, stats[f"s{i}"] or 0.0
        out = out.withColumn(c + suffix, (F.col(c) - F.lit(m)) / F.lit(s if s > 0 else 1.0))
    return out


def standardize_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population std of each feature, long form."""
    wide = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                  *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', CAST(m{i} AS DOUBLE), CAST(s{i} AS DOUBLE)" for i, c in enumerate(cols))
    r9 = lambda c: F.floor(F.col(c) * 1e6 + 0.5) / 1e6
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (feature, mean, std_pop)") \
        .select("feature", r9("mean").alias("mean"), r9("std_pop").alias("std_pop"))


# ---------------------------------------------------------------- ML-2 / ML-3
MAX_CLASSES = 1000


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows of each class; an error for a label with more than ``MAX_CLASSES`` values or NULLs."""
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES or any(r[0] is None for r in rows):
        raise ValueError(f"{label!r} has NULLs or more than {MAX_CLASSES} values: not a class label")
    return {r[0]: r[1] for r in sorted(rows, key=lambda r: r[0])}


def split_digest(key: str, seed: int = SEED) -> Column:
    """60 bits of the MD5 of "seed|key", as any SQL engine computes them."""
    text = F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.2,
                     seed: int = SEED, name: str = "is_test") -> DataFrame:
    """Mark ``ceil(test_frac * n_c)`` rows of each class ``c`` as test: those with the smallest
    seeded digests of ``key`` (a unique BIGINT); the same rows on every run and partitioning.

    The input is written once; each class's cut digest is found by counting passes over it."""
    rows = staged(df.withColumn("_h", split_digest(key, seed)).withColumn("_key", F.col(key).cast("long")), "split")
    counts = class_counts(rows, label)
    of_class = {f"_h{i}": F.when(F.col(label) == F.lit(c), F.col("_h")) for i, c in enumerate(counts)}
    span = rows.agg(F.min("_key"), F.max("_key")).first()
    ranks = {h: [math.ceil(test_frac * n)] for h, n in zip(of_class, counts.values())}
    cuts = select_ranks(rows.withColumns(of_class), [h for h in ranks if ranks[h][0] > 0], "_key", ranks,
                        {"_key": tuple(span), **{h: (0, 16 ** 15 - 1) for h in of_class}})
    is_test = F.lit(0)
    for (h, _), (digest, at) in cuts.items():
        c = list(counts)[int(h[2:])]
        below = (F.col("_h") < digest) | ((F.col("_h") == digest) & (F.col("_key") <= at))
        is_test = F.when(F.col(label) == F.lit(c), below.cast("int")).otherwise(is_test)
    return rows.withColumn(name, is_test).drop("_h", "_key")


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` (k classes) as a column."""
    counts = class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    wmap = F.create_map(*[x for c, nc in counts.items() for x in (F.lit(c), F.lit(n / (k * nc)))])
    return df.withColumn(name, F.element_at(wmap, F.col(label)))


def split_summary(df: DataFrame, label: str, key: str, test_frac: float = 0.2) -> DataFrame:
    s = class_weights(stratified_split(df, label, key, test_frac), label)
    return s.groupBy(label, "is_test").agg(F.count(F.lit(1)).alias("n"),
                                           F.max("weight").alias("class_weight"))


# ---------------------------------------------------------------- ML-11..15
def classification_report(pred: DataFrame, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1, support, plus an accuracy row."""
    p = pred.select(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p"))
    # one pass over the predictions: the confusion matrix, a row per pair of classes
    matrix = p.groupBy("y", "p").agg(F.count(F.lit(1)).alias("n"))
    sides = matrix.select(F.inline(F.array(
        F.struct(F.col("y").alias("cls"), F.col("n").alias("support"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp"), F.lit(0).cast("long").alias("n_pred")),
        F.struct(F.col("p").alias("cls"), F.lit(0).cast("long").alias("support"), F.lit(0).cast("long").alias("tp"), F.col("n").alias("n_pred")))))
    j = sides.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("support", "tp", "n_pred")])
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    rows = j.select(F.col("cls").cast("string").alias("class"), prec.alias("precision"),
                    rec.alias("recall"), "support")
    rows = rows.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                        2 * F.col("precision") * F.col("recall")
                                        / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    share = F.sum("tp") / F.sum("support")
    acc = j.agg(F.lit("accuracy").alias("class"), share.alias("precision"), share.alias("recall"), F.sum("support").alias("support"), share.alias("f1"))
    return rows.select("class", "precision", "recall", "f1", "support") \
        .unionByName(acc.select("class", "precision", "recall", "f1", "support"))


def auc_rank_sum(scored: DataFrame, label: str, score: str) -> DataFrame:
    """ML-12: (n_pos, n_neg, auc), exact: the share of (positive, negative) pairs that the score
    puts in order, ties counting half (Mann-Whitney). ``label`` is 0 or 1; rows without score are left out.

    Rows are counted per distinct score; these are numbered in order and the negatives below each
    are a running total, so neither the scores nor a rank of all rows meet in one task."""
    pos = F.col(label).cast("int") == 1
    of_score = scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("_score")) \
        .agg(F.count_if(pos).alias("pos"), F.count_if(~pos).alias("neg"))
    at = numbered(of_score, ["_score"], "_nr")
    below = running_totals(at, "_nr", "neg", "below")
    whole = "decimal(38,0)"
    pairs = F.sum(F.col("pos").cast(whole) * (2 * F.col("below") + F.col("neg")).cast("decimal(19,0)"))
    total = at.join(below, "_nr").agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"), pairs.alias("pairs"))
    area = F.col("pairs").cast("double") / (2.0 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double"))
    return total.select("n_pos", "n_neg", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), area).alias("auc"))


def mae(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.agg(F.avg(F.abs(F.col(label) - F.col(prediction))).alias("mae"),
                    F.count(F.lit(1)).alias("n_test"))


def importances(spark, model, names: list[str]) -> DataFrame:
    """Feature importances, largest first (one small row per feature)."""
    vals = model.featureImportances.toArray().tolist()
    rows = sorted(zip(names, vals), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


# ---------------------------------------------------------------- model jobs
CHURN_FEATURES = ["lifetime_orders", "lifetime_value", "avg_order_value", "avg_review_score",
                  "avg_delivery_days"]
DELAY_FEATURES = ["total_items", "total_item_amount", "total_freight_amount", "total_payment_amount"]
GEO_FEATURES = ["item_price", "freight_value", "total_item_value", "same_state", "same_city",
                "diff_state", "diff_city", "cross_state"]
DAILY_FEATURES = ["sales_lag1", "sales_lag7", "sales_lag14", "sales_roll7", "sales_roll14",
                  "weekday", "month"]


def _split_frame(df: DataFrame, features: list[str], label: str, key: str) -> DataFrame:
    """Key, label, scaled features, is_test and class weight."""
    data = df.select(key, F.col(label).cast("double").alias("label"),
                     *[F.col(c).cast("double").alias(c) for c in features])
    data = standardize(data.na.fill(0.0, subset=features), features)
    return class_weights(stratified_split(data, "label", key), "label")


def _classify(df: DataFrame, features: list[str], label: str, key: str, trees: int, depth: int):
    data = _split_frame(df, features, label, key)
    train, test = data.filter("is_test = 0"), data.filter("is_test = 1")
    rf = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, weightCol="weight",
                                featuresCol="features", labelCol="label", cacheNodeIds=True)
    model = _fitted([VectorAssembler(inputCols=features, outputCol="features"), rf], train)
    return model, scored(model.transform(test), key), features


#: Training rows of a partition: a forest keeps a sample count and a node id of every tree with a row.
TRAIN_ROWS = 100_000


def dealt_out(train: DataFrame) -> DataFrame:
    """The training rows in partitions of about ``TRAIN_ROWS``, where there are more."""
    rows = train.count()
    return train.repartition(math.ceil(rows / TRAIN_ROWS)) if rows > TRAIN_ROWS else train


def _fitted(stages: list, train: DataFrame):
    """The fitted pipeline; its training rows are cached while it is fitted only."""
    train = dealt_out(train).persist()
    try:
        return Pipeline(stages=stages).fit(train)
    finally:
        train.unpersist()


def scored(pred: DataFrame, *keys: str) -> DataFrame:
    """Predictions written once: keys, label, prediction and p1, the probability of class 1."""
    p1 = vector_to_array("probability")[1].alias("p1")
    return staged(pred.select(*keys, "label", "prediction", p1), "scored")


def churn_model(w) -> dict:
    """ML-4: churn classifier — RF 100 trees, depth 10, balanced, scaled features."""
    from marketlake.plans.queries_adhoc import an_churn_label
    df = an_churn_label(w)
    model, pred, names = _classify(df, CHURN_FEATURES, "churn", "customer_sk", 100, 10)
    return {"model": model, "pred": pred, "names": names}


# The notebook grows these forests without a depth limit; 30 is the most Spark's trees allow. Nodes
# then grow with the rows, so the classifiers are grown by operators.forest, not held by the driver.
UNLIMITED_DEPTH = 30


def delay_model(w, max_depth: int = UNLIMITED_DEPTH) -> dict:
    """ML-5: order delay classifier — RF 100 trees, the deepest trees Spark grows."""
    data = _split_frame(w.fact_orders, DELAY_FEATURES, "is_delayed", "order_sk")
    model = forest(data, "order_sk", DELAY_FEATURES, {}, "weight", 100, max_depth, SEED)
    return {"model": model, "pred": staged(model.pred, "scored"), "names": DELAY_FEATURES}


def delay_geo_model(w, max_depth: int = UNLIMITED_DEPTH) -> dict:
    """ML-6/7: item delay classifier with geography flags and one-hot states, RF 200."""
    from marketlake.plans.queries_adhoc import geo_frame
    df = geo_frame(w).withColumn("is_delayed", F.coalesce("is_delayed", F.lit(0)))
    states = ["seller_state", "customer_state"]
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in states]
    data = df.select("order_item_sk", F.col("is_delayed").cast("double").alias("label"),
                     *[F.col(c).cast("double").alias(c) for c in GEO_FEATURES], *states).na.fill(0.0, subset=GEO_FEATURES)
    data = class_weights(stratified_split(data, "label", "order_item_sk"), "label")
    indexers = Pipeline(stages=idx).fit(data.filter("is_test = 0"))
    # one feature per slot: each state as the fitted indexers number it, last the unseen
    slots = {f"{c}_idx": len(m.labels) + 1 for c, m in zip(states, indexers.stages)}
    model = forest(indexers.transform(data), "order_item_sk", GEO_FEATURES, slots, "weight", 200, max_depth, SEED)
    names = [f"{c}_{s}" for c, m in zip(states, indexers.stages) for s in [*m.labels, "unseen"]]
    return {"model": model, "pred": staged(model.pred, "scored"), "names": GEO_FEATURES + names}


def _monthly_frame(w) -> DataFrame:
    f = w.plain_fact_items.select("product_sk", "purchase_date_sk", "total_item_value")
    m = (f.join(w.dim_product.select("product_sk", "product_category_name"), "product_sk")
         .join(F.broadcast(w.dim_date.select(F.col("date_sk").alias("purchase_date_sk"), "full_date")),
               "purchase_date_sk")
         .groupBy("product_category_name", D.month_start("full_date").alias("month"))
         .agg(F.sum("total_item_value").cast("double").alias("sales")))
    return add_lags(m, "product_category_name", "month", "sales", [1, 2, 3]).na.drop()


def monthly_model(w) -> dict:
    """ML-8/10: monthly category sales regressor on lags 1-3 — RF 100 with every
    feature considered at each split; chronological 80/20 split per category."""
    feats = ["sales_lag1", "sales_lag2", "sales_lag3"]
    data = chronological_split(_monthly_frame(w), "product_category_name", "month")
    asm = VectorAssembler(inputCols=feats, outputCol="features")
    rf = RandomForestRegressor(numTrees=100, maxDepth=UNLIMITED_DEPTH, seed=SEED, featureSubsetStrategy="all",
                               labelCol="sales")
    data = staged(data, "monthly")
    model = _fitted([asm, rf], data.filter("is_train = 1"))
    pred = model.transform(data.filter("is_train = 0"))
    return {"model": model, "pred": staged(pred.drop("features"), "monthly-pred"), "names": feats}


def _daily_frame(w) -> DataFrame:
    f = w.plain_fact_items.select("product_sk", "purchase_date_sk", "total_item_value")
    d = (f.join(w.dim_product.select("product_sk", "product_category_name"), "product_sk")
         .join(F.broadcast(w.dim_date.select(F.col("date_sk").alias("purchase_date_sk"),
                                             F.col("full_date").alias("day"))), "purchase_date_sk")
         .groupBy("product_category_name", "day").agg(F.sum("total_item_value").alias("sales")))
    d = series_features(d, "product_category_name", "day", "sales", lags=[1, 7, 14], rolling=[7, 14])
    d = d.withColumn("weekday", D.weekday_mon0("day")).withColumn("month", F.month("day"))
    return d.na.drop().select("product_category_name", "day",
                              F.col("sales").cast("double").alias("sales"),
                              *[F.col(c).cast("double").alias(c) for c in DAILY_FEATURES])


def daily_model(w, iterations: int = 300) -> dict:
    """ML-9/10: daily category sales — boosted trees (300 rounds, step 0.05, depth 5)."""
    data = staged(chronological_split(_daily_frame(w), "product_category_name", "day"), "daily")
    asm = VectorAssembler(inputCols=DAILY_FEATURES, outputCol="features")
    # the last tenth of each training series is held out: rounds that don't help it end the fit
    train = chronological_split(data.filter("is_train = 1"), "product_category_name", "day", 0.9, "_kept") \
        .withColumn("held_out", F.col("_kept") == 0)
    gbt = boosted_trees(w.spark, iterations).setParams(labelCol="sales", validationIndicatorCol="held_out")
    model = _fitted([asm, gbt], train)
    pred = model.transform(data.filter("is_train = 0"))
    return {"model": model, "pred": staged(pred.drop("features"), "daily-pred"), "names": DAILY_FEATURES}


#: Boosting rounds between two reliable checkpoints of the residuals.
CHECKPOINT_ROUNDS = 10


def boosted_trees(spark, iterations: int) -> GBTRegressor:
    """Boosted trees whose residuals are written to the shared checkpoint folder every
    ``CHECKPOINT_ROUNDS`` rounds: the lineage of round 300 is as short as that of round 10, and a
    lost executor costs the rounds since the last checkpoint."""
    ensure_checkpoint_dir(spark)
    return GBTRegressor(maxIter=iterations, stepSize=0.05, maxDepth=5, seed=SEED, checkpointInterval=CHECKPOINT_ROUNDS, validationTol=0.001)
