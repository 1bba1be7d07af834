"""Registered ML queries (ML-1..15).

Split sizes, class weights and feature statistics are deterministic and have
SQL oracles; model outputs (reports, AUC, MAE, importances, forecasts) depend
on the learner and get the driver's rows-only check. Each fitted model is
cached on the warehouse so its report, importances and forecast share one fit.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.plans import ml as ML
from marketlake.plans.queries_adhoc import an_churn_label
from marketlake.plans.queries_ops import WIN_LAG_SQL
from marketlake.plans.registry import register
from sqlcheck.fragments import compose


def _fit(w, name, fn):
    cache = w.__dict__.setdefault("_ml", {})
    if name not in cache:
        cache[name] = fn(w)
    return cache[name]


def _churn_features(w):
    return an_churn_label(w).na.fill(0.0, subset=ML.CHURN_FEATURES)


def _std_sql() -> str:
    base, parts = _churn_base(), []
    for f in ML.CHURN_FEATURES:
        x = f"COALESCE(CAST({f} AS DOUBLE), 0)"
        parts.append(f"SELECT '{f}' AS feature, floor(avg({x}) * 1e6 + 0.5) / 1e6 AS mean, "
                     f"floor(stddev_pop({x}) * 1e6 + 0.5) / 1e6 AS std_pop FROM churn_base")
    return base + "\n" + "\nUNION ALL\n".join(parts)


def _churn_base() -> str:
    from marketlake.plans.registry import ORACLE
    full = ORACLE["an_churn_label"]
    head, sep, tail = full.rpartition("\nSELECT c.customer_sk")
    return f"{head},\nchurn_base AS (SELECT c.customer_sk{tail})"


def _split_sql() -> str:
    return _churn_base() + """,
cls AS (SELECT churn, COUNT(*) AS n_c, CAST(ceil(0.2 * COUNT(*)) AS BIGINT) AS n_test
        FROM churn_base GROUP BY churn),
tot AS (SELECT SUM(n_c) AS n, COUNT(*) AS k FROM cls)
SELECT churn, 1 AS is_test, n_test AS n, CAST(n AS DOUBLE) / (k * n_c) AS class_weight FROM cls, tot
UNION ALL
SELECT churn, 0 AS is_test, n_c - n_test AS n, CAST(n AS DOUBLE) / (k * n_c) FROM cls, tot
WHERE n_c - n_test > 0"""


def _members_sql() -> str:
    return _churn_base() + """,
drawn AS (SELECT customer_sk, churn, ('0x' || substr(md5('42|' || customer_sk), 1, 15))::BIGINT AS h FROM churn_base)
SELECT customer_sk, churn,
       (row_number() OVER (PARTITION BY churn ORDER BY h, customer_sk) <= ceil(0.2 * count(*) OVER (PARTITION BY churn)))::INTEGER AS is_test
FROM drawn"""


# ---------------------------------------------------------------- ML-1 / 2 / 3
@register("ml_standardize", _std_sql())
def ml_standardize(w):
    """ML-1: mean and population std of the churn features (6 decimals)."""
    return ML.standardize_stats(_churn_features(w), ML.CHURN_FEATURES)


@register("ml_stratified_split", _split_sql())
def ml_stratified_split(w):
    """ML-2/3: exact stratified 80/20 split sizes per class, with balanced weights."""
    s = ML.split_summary(_churn_features(w), "churn", "customer_sk")
    return s.select(F.col("churn"), F.col("is_test"), F.col("n"), F.col("class_weight"))


@register("ml_split_members", _members_sql())
def ml_split_members(w):
    """ML-2: which customers the stratified split tests on."""
    return ML.stratified_split(_churn_features(w), "churn", "customer_sk").select("customer_sk", "churn", "is_test")


@register("ml_chrono_split", compose(f"""
SELECT product_category_name, CAST(floor(COUNT(*) * 0.8) AS BIGINT) AS n_train,
       COUNT(*) - CAST(floor(COUNT(*) * 0.8) AS BIGINT) AS n_test
FROM ({WIN_LAG_SQL}) t GROUP BY product_category_name"""))
def ml_chrono_split(w):
    """ML-10: chronological 80/20 split sizes per category series."""
    from marketlake.operators.series import chronological_split
    s = chronological_split(ML._monthly_frame(w), "product_category_name", "month")
    return s.groupBy("product_category_name").agg(
        F.sum("is_train").cast("long").alias("n_train"),
        F.sum(1 - F.col("is_train")).cast("long").alias("n_test"))


# ---------------------------------------------------------------- ML-4 / 5 / 6 (+ 11, 12, 14)
def _metrics(w, r):
    rep = ML.classification_report(r["pred"])
    auc = ML.auc_rank_sum(r["pred"], "label", "p1").select(
        F.lit("auc").alias("class"), F.col("auc").alias("precision"), F.col("auc").alias("recall"), F.col("auc").alias("f1"),
        F.lit(None).cast("long").alias("support"))
    return rep.unionByName(auc)


def _order_cents(w):
    """Orders with a score that any engine computes alike: freight per item value, in whole ten-thousandths."""
    cents = lambda c: (F.col(c) * 100).cast("long")
    score = F.call_function("div", cents("total_freight_amount") * 10000, F.greatest(cents("total_item_amount"), F.lit(1).cast("long")))
    return w.fact_orders.select("order_sk", "is_delayed", score.alias("score"))


_ORDER_SCORE = """
SELECT order_sk, is_delayed, (CAST(total_freight_amount * 100 AS BIGINT) * 10000) // greatest(CAST(total_item_amount * 100 AS BIGINT), 1) AS score
FROM g_fact_orders"""


@register("ml_auc_rank_sum", compose(f"""
WITH scored AS ({_ORDER_SCORE}),
ranked AS (SELECT is_delayed, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored),
sums AS (SELECT sum(is_delayed)::BIGINT AS n_pos, (count(*) - sum(is_delayed))::BIGINT AS n_neg, sum(r) FILTER (WHERE is_delayed = 1) AS r_pos FROM ranked)
SELECT n_pos, n_neg, CASE WHEN n_pos > 0 AND n_neg > 0 THEN (r_pos - n_pos * (n_pos + 1) / 2.0)::DOUBLE / (n_pos::DOUBLE * n_neg) END AS auc FROM sums"""))
def ml_auc_rank_sum(w):
    """ML-12: exact ROC area of a deterministic score for delayed orders."""
    return ML.auc_rank_sum(_order_cents(w), "is_delayed", "score")


@register("ml_report_rule", compose(f"""
WITH judged AS (SELECT is_delayed AS y, (score >= 1000)::INTEGER AS p FROM ({_ORDER_SCORE}) s),
cls AS (SELECT c, count(*) FILTER (WHERE y = c) AS support, count(*) FILTER (WHERE p = c) AS n_pred, count(*) FILTER (WHERE y = c AND p = c) AS tp
        FROM judged, (VALUES (0), (1)) v(c) GROUP BY c HAVING count(*) FILTER (WHERE y = c OR p = c) > 0),
rates AS (SELECT c, support, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM cls)
SELECT c::VARCHAR AS class, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1, support FROM rates
UNION ALL
SELECT 'accuracy', a, a, a, n FROM (SELECT avg((y = p)::INTEGER) AS a, count(*) AS n FROM judged) t WHERE n > 0"""))
def ml_report_rule(w):
    """ML-11: classification report of a fixed rule for delayed orders (the score at a threshold)."""
    judged = _order_cents(w).select(F.col("is_delayed").alias("label"), (F.col("score") >= 1000).cast("int").alias("prediction"))
    return ML.classification_report(judged)


@register("ml_mae_lag1", compose(f"""
SELECT avg(abs(sales - sales_lag1)) AS mae, count(*) AS n_test FROM (
  SELECT *, row_number() OVER (PARTITION BY product_category_name ORDER BY month) AS r, count(*) OVER (PARTITION BY product_category_name) AS n
  FROM ({WIN_LAG_SQL}) t) u WHERE r > floor(0.8 * n)"""))
def ml_mae_lag1(w):
    """ML-13: mean absolute error of "as last month" on the last fifth of each category's months."""
    data = ML.chronological_split(ML._monthly_frame(w), "product_category_name", "month").where("is_train = 0")
    return ML.mae(data, label="sales", prediction="sales_lag1")


@register("ml_churn_report")
def ml_churn_report(w):
    """ML-4/11/12: churn classifier report (per class, accuracy, AUC)."""
    return _metrics(w, _fit(w, "churn", ML.churn_model))


@register("ml_churn_importance")
def ml_churn_importance(w):
    """ML-14: churn feature importances."""
    r = _fit(w, "churn", ML.churn_model)
    return ML.importances(w.spark, r["model"].stages[-1], r["names"])


@register("ml_delay_report")
def ml_delay_report(w):
    """ML-5/11/12: order delay classifier report."""
    return _metrics(w, _fit(w, "delay", ML.delay_model))


@register("ml_delay_importance")
def ml_delay_importance(w):
    """ML-14: feature importances of the order delay classifier."""
    r = _fit(w, "delay", ML.delay_model)
    return ML.importances(w.spark, r["model"], r["names"])


@register("ml_delay_geo_report")
def ml_delay_geo_report(w):
    """ML-6/7/11/12: item delay classifier with geography and one-hot states."""
    return _metrics(w, _fit(w, "delay_geo", ML.delay_geo_model))


@register("ml_delay_geo_importance")
def ml_delay_geo_importance(w):
    """ML-14: importances of the item delay classifier, one row per feature and per state."""
    r = _fit(w, "delay_geo", ML.delay_geo_model)
    return ML.importances(w.spark, r["model"], r["names"])


# ---------------------------------------------------------------- ML-8 / 9 (+ 13, 14, 15)
@register("ml_monthly_forecast")
def ml_monthly_forecast(w):
    """ML-8/15: actual vs predicted monthly sales on each category's last 20%."""
    r = _fit(w, "monthly", ML.monthly_model)
    return r["pred"].select("product_category_name", "month", "sales", "prediction").orderBy("product_category_name", "month")


@register("ml_monthly_mae")
def ml_monthly_mae(w):
    """ML-13: mean absolute error of the monthly regressor."""
    return ML.mae(_fit(w, "monthly", ML.monthly_model)["pred"], label="sales")


@register("ml_daily_forecast")
def ml_daily_forecast(w):
    """ML-9/15: actual vs predicted daily sales (boosted trees)."""
    r = _fit(w, "daily", ML.daily_model)
    return r["pred"].select("product_category_name", "day", "sales", "prediction").orderBy("product_category_name", "day")


@register("ml_daily_mae")
def ml_daily_mae(w):
    """ML-13: mean absolute error of the daily regressor."""
    return ML.mae(_fit(w, "daily", ML.daily_model)["pred"], label="sales")


@register("ml_daily_importance")
def ml_daily_importance(w):
    """ML-14: daily regressor feature importances."""
    r = _fit(w, "daily", ML.daily_model)
    return ML.importances(w.spark, r["model"].stages[-1], r["names"])
