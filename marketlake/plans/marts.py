"""Marts over the star schema (MRT-1..9).

Conventions:

* money stays ``decimal`` until output; rounded means and rates use exact
  integer half-up division (``functions.numeric``), so results do not depend
  on partitioning or aggregation order;
* where the warehouse compares *unrounded* means in a CASE, the comparison is
  done exactly on sums and counts (``100*delayed >= 30*n`` rather than a float mean);
* every mart pre-aggregates its facts to its own grain before joining other
  marts, and avoids several ``COUNT(DISTINCT)`` in one group (each would
  multiply rows through an ``Expand``) by grouping in two levels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions import dates as D
from marketlake.functions.numeric import half_up_ratio, unscaled
from marketlake.operators.quantiles import global_ntiles
from marketlake.plans.gold import OrderLines


def _div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b)


def round_double(x: Column, scale: int = 2) -> Column:
    """Half-up rounding of a float mean, written with IEEE operations only
    (``floor(|x|*10^s + 0.5)``) so every engine rounds the same double alike."""
    f = float(10 ** scale)
    mag = F.floor(F.abs(x) * f + 0.5) / f
    return F.when(x < 0, -mag).otherwise(mag)


@dataclass(frozen=True)
class MartParams:
    """Segment thresholds (defaults = the warehouse's values)."""
    top_seller_revenue: float = 100000.0
    high_performer_revenue: float = 50000.0
    good_review: float = 4.0
    low_review: float = 3.0
    top_seller_max_delay: float = 10.0
    delay_risk: float = 30.0
    best_seller_revenue: float = 100000.0
    high_revenue: float = 50000.0
    fast_delay: float = 5.0
    good_delay: float = 10.0
    legacy_quantity: bool = False
    recency_order: str = "asc"


# ---------------------------------------------------------------- MRT-1
def customer_rfm(fact_orders: DataFrame, dim_date: DataFrame, as_of=None,
                 p: MartParams = MartParams()) -> DataFrame:
    """Recency / frequency / monetary with global quintiles.

    All three NTILEs are ascending by default (``recency_order="asc"``), so
    ``r_score`` 5 is the *least* recent quintile — the warehouse's
    convention; pass ``recency_order="desc"`` for the usual one. Ties are
    broken by ``customer_sk``. ``as_of`` defaults to the latest purchase date.
    """
    metrics = fact_orders.groupBy("customer_sk").agg(
        F.max("purchase_date_sk").alias("last_purchase_date_sk"),
        F.count(F.lit(1)).alias("frequency_orders"),
        F.sum("total_payment_amount").alias("monetary_value"))
    dates = F.broadcast(dim_date.select("date_sk", "full_date"))
    dated = metrics.join(dates, F.col("last_purchase_date_sk") == F.col("date_sk"))
    # default: the latest of the customers' last purchases, a scalar subquery of the plan
    latest = dated.agg(F.max("full_date")).scalar() if as_of is None else F.to_date(F.lit(as_of))
    base = (dated
            .select("customer_sk",
                    F.datediff(latest, F.col("full_date")).alias("recency_days"),
                    F.col("frequency_orders").cast("long").alias("frequency_orders"),
                    F.col("monetary_value").cast("decimal(18,2)").alias("monetary_value")))
    # the cuts of the three measures are found in the same passes
    scored = global_ntiles(base, {"r_score": ("recency_days", p.recency_order), "f_score": ("frequency_orders", "asc"),
                                  "m_score": ("monetary_value", "asc")}, 5, "customer_sk")
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.select(
        "customer_sk", "recency_days", "frequency_orders", "monetary_value", "r_score",
        "f_score", "m_score",
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_score"),
        F.when((r >= 4) & (f >= 4) & (m >= 4), "CHAMPIONS")
        .when((r >= 3) & (f >= 3) & (m >= 3), "LOYAL_CUSTOMERS")
        .when((r >= 4) & (f <= 2), "NEW_CUSTOMERS")
        .when((r <= 2) & (f >= 3), "AT_RISK")
        .when((r == 1) & (f == 1) & (m == 1), "LOST_CUSTOMERS")
        .otherwise("REGULAR").alias("rfm_segment"))


# ---------------------------------------------------------------- MRT-2
def cohort_retention(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Customers by first-purchase month x months since (boundary count).

    (customer, month) pairs are made distinct first, so counting rows per
    (cohort, month) equals counting distinct customers; the first-purchase
    month is a window ``min`` over at most one row per customer-month.
    """
    dates = F.broadcast(dim_date.select("date_sk", "full_date"))
    pairs = (fact_orders.select("customer_sk", "purchase_date_sk")
             .join(dates, F.col("purchase_date_sk") == F.col("date_sk"))
             .select("customer_sk", D.month_start("full_date").alias("order_month"))
             .distinct())
    firsts = pairs.groupBy("customer_sk").agg(F.min("order_month").alias("cohort_month"))
    counts = (pairs.join(firsts, "customer_sk")
              .select("cohort_month", D.month_diff("cohort_month", "order_month")
                      .alias("retention_month"))
              .groupBy("cohort_month", "retention_month")
              .agg(F.count(F.lit(1)).alias("retained_customers")))
    sizes = counts.filter(F.col("retention_month") == 0) \
        .select("cohort_month", F.col("retained_customers").alias("cohort_size"))
    return counts.join(sizes, "cohort_month").select(
        "cohort_month", F.col("retention_month").cast("int").alias("retention_month"),
        F.col("retained_customers").cast("long").alias("retained_customers"),
        F.col("cohort_size").cast("long").alias("cohort_size"),
        half_up_ratio("retained_customers", "cohort_size", 2, mult=100).alias("retention_rate"))


# ---------------------------------------------------------------- item-grain base
def _item_base(fact_order_items: DataFrame, fact_orders: DataFrame, cols: list[str]) -> DataFrame:
    """Items with order columns, joined on ``order_id``, in whose buckets the lake keeps both facts."""
    lines = fact_order_items if isinstance(fact_order_items, OrderLines) else OrderLines(fact_order_items)
    return lines.with_orders(fact_orders.select("order_id", *[c for c in cols if c in fact_orders.columns
                                                              and c not in lines.cold.columns]))


ITEM_BASE_ORDER_COLS = ["order_id", "customer_sk", "order_status", "avg_review_score",
                        "delivery_days", "is_delayed", "estimated_delivery_days"]


def item_order_base(fact_order_items: DataFrame, fact_orders: DataFrame,
                    dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Item fact widened with its order's columns, the buyer's repeat flag and
    the product category: the common input of the seller, product and delivery
    marts and the favourite category. Built (and, in the pipeline, written)
    once, so the largest fact is shuffled for this join once instead of per mart.
    Every join is row-preserving: each item has exactly one order, customer and
    product in the dimensions it was keyed from."""
    if {"is_repeat_customer", "product_category_name"} <= set(getattr(fact_order_items, "columns", ())):
        # the lines carry both columns from the joins that keyed them
        base = _item_base(fact_order_items, fact_orders, ITEM_BASE_ORDER_COLS)
        first, last = ("product_sk", "customer_sk", "order_id"), ("is_repeat_customer", "product_category_name")
        return base.select(*first, *[c for c in base.columns if c not in first + last], *last)
    return (_item_base(fact_order_items, fact_orders, ITEM_BASE_ORDER_COLS)
            .join(dim_customer.select("customer_sk", "is_repeat_customer"), "customer_sk")
            .join(dim_product.select("product_sk", "product_category_name"), "product_sk"))


def _mean_money(sum_col: str, n_col: str) -> Column:
    return half_up_ratio(unscaled(F.col(sum_col)), F.col(n_col), 2, num_scale=2)


# ---------------------------------------------------------------- MRT-3 / MRT-5
def seller_totals(base: DataFrame) -> DataFrame:
    """The sums per seller that the seller and the delivery mart are made of: one pass over
    :func:`item_order_base` for both."""
    gap = F.col("delivery_days") - F.col("estimated_delivery_days")
    return base.groupBy("seller_sk").agg(
        F.countDistinct("order_sk").alias("total_orders"),
        F.count("order_item_sk").alias("total_items_sold"),
        F.sum("total_item_value").alias("_rev"),
        F.count("total_item_value").alias("_n_rev"),
        F.sum("item_price").alias("_price"),
        F.count("item_price").alias("_n_price"),
        F.avg("avg_review_score").alias("_review"),
        F.sum("delivery_days").alias("_dd"),
        F.count("delivery_days").alias("_n_dd"),
        F.sum("is_delayed").alias("_delayed"),
        F.count("is_delayed").alias("_n_delayed"),
        F.sum("is_repeat_customer").alias("_repeat"),
        F.count("is_repeat_customer").alias("_n_repeat"),
        F.sum(F.when(F.col("order_status") == "delivered", 1).otherwise(0)).alias("delivered_orders"),
        F.sum(F.when(F.col("is_delayed") == 1, 1).otherwise(0)).alias("delayed_orders"),
        F.sum(gap).alias("_gap"), F.count(gap).alias("_n_gap"),
        F.sum("freight_value").alias("_freight"), F.count("freight_value").alias("_n_freight"))


def seller_performance(totals: DataFrame, p: MartParams = MartParams()) -> DataFrame:
    """Seller metrics at item grain from :func:`seller_totals` (means are weighted by items, as in
    the warehouse; ``avg_order_value`` is the mean *item* value)."""
    out = totals.select(
        "seller_sk", F.col("total_orders").cast("long").alias("total_orders"),
        F.col("total_items_sold").cast("long").alias("total_items_sold"),
        F.col("_rev").cast("decimal(18,2)").cast("double").alias("total_revenue"),
        _mean_money("_rev", "_n_rev").alias("avg_order_value"),
        _mean_money("_price", "_n_price").alias("avg_item_price"),
        round_double(F.col("_review")).alias("avg_review_score"),
        half_up_ratio("_dd", "_n_dd", 2).alias("avg_delivery_days"),
        half_up_ratio("_delayed", "_n_delayed", 2, mult=100).alias("delay_rate"),
        half_up_ratio("_repeat", "_n_repeat", 2, mult=100).alias("repeat_customer_rate"))
    rev, rv, dl = F.col("total_revenue"), F.col("avg_review_score"), F.col("delay_rate")
    return out.withColumn(
        "seller_segment",
        F.when((rev >= p.top_seller_revenue) & (rv >= p.good_review)
               & (dl <= p.top_seller_max_delay), "TOP_SELLER")
        .when(rev >= p.high_performer_revenue, "HIGH_PERFORMER")
        .when(rv < p.low_review, "LOW_REVIEW")
        .when(dl >= p.delay_risk, "DELAY_RISK")
        .otherwise("REGULAR"))


# ---------------------------------------------------------------- MRT-4
def product_sales(fact_order_items: DataFrame, fact_orders: DataFrame,
                  dim_product: DataFrame, p: MartParams = MartParams(),
                  base: DataFrame | None = None) -> DataFrame:
    """Product metrics; the segment CASE reads the *unrounded* values.

    ``total_quantity_sold`` counts item rows (the warehouse stored the
    constant 1; ``legacy_quantity=True`` restores that)."""
    if base is None:
        base = (_item_base(fact_order_items, fact_orders,
                           ["order_id", "avg_review_score", "delivery_days", "is_delayed"])
                .join(dim_product.select("product_sk", "product_category_name"), "product_sk"))
    # an order's lines of a product first, where the lines met their order: distinct orders are then rows,
    # and only the sums of products move
    sums = {"_rev": "total_item_value", "_price": "item_price", "_freight": "freight_value", "_review": "avg_review_score", "_dd": "delivery_days", "_delayed": "is_delayed"}
    counts = {"_n_price": "item_price", "_n_freight": "freight_value", "_n_review": "avg_review_score", "_n_dd": "delivery_days", "_n_delayed": "is_delayed"}
    of_order = base.groupBy("order_id", "order_sk", "product_sk").agg(
        F.max("product_category_name").alias("product_category_name"), F.count(F.lit(1)).alias("_items"),
        *[F.sum(x).alias(c) for c, x in sums.items()], *[F.count(x).alias(c) for c, x in counts.items()])
    m = of_order.groupBy("product_sk").agg(
        F.max("product_category_name").alias("product_category_name"), F.count("order_sk").alias("total_orders"),
        *[F.sum(c).alias(c) for c in ("_items", *sums, *counts)]) \
        .withColumn("_review", F.when(F.col("_n_review") > 0, F.col("_review") / F.col("_n_review"))) \
        .withColumns({c: F.col(c).cast("decimal(28,2)") for c in ("_rev", "_price", "_freight")})
    qty = F.lit(1) if p.legacy_quantity else F.col("_items")
    rev = F.col("_rev")
    review = F.col("_review")
    delayed_pct_ge = lambda t: F.col("_delayed") * 100 >= F.col("_n_delayed") * t
    return m.select(
        "product_sk", "product_category_name",
        F.col("total_orders").cast("long").alias("total_orders"),
        qty.cast("long").alias("total_quantity_sold"),
        rev.cast("double").alias("total_revenue"),
        _mean_money("_price", "_n_price").alias("avg_selling_price"),
        _mean_money("_freight", "_n_freight").alias("avg_freight_value"),
        half_up_ratio(unscaled(F.col("_freight")), unscaled(F.col("_price")), 2, mult=100)
        .alias("freight_ratio"),
        round_double(review).alias("avg_review_score"),
        half_up_ratio("_dd", "_n_dd", 2).alias("avg_delivery_days"),
        half_up_ratio("_delayed", "_n_delayed", 2, mult=100).alias("delay_rate"),
        F.when((rev >= p.best_seller_revenue) & (review >= p.good_review), "BEST_SELLER")
        .when(rev >= p.high_revenue, "HIGH_REVENUE")
        .when(review < p.low_review, "LOW_REVIEW")
        .when(delayed_pct_ge(p.delay_risk), "DELIVERY_RISK")
        .otherwise("REGULAR").alias("product_segment"))


# ---------------------------------------------------------------- MRT-5
def delivery_performance(totals: DataFrame, p: MartParams = MartParams()) -> DataFrame:
    """Seller delivery metrics from :func:`seller_totals`. ``delivered_orders`` / ``delayed_orders``
    count item rows (the warehouse's semantics); the gap is delivery minus estimated days."""
    pct_le = lambda t: F.col("_delayed") * 100 <= F.col("_n_delayed") * t
    pct_ge = lambda t: F.col("_delayed") * 100 >= F.col("_n_delayed") * t
    return totals.select(
        "seller_sk", F.col("total_orders").cast("long").alias("total_orders"),
        F.col("delivered_orders").cast("long").alias("delivered_orders"),
        F.col("delayed_orders").cast("long").alias("delayed_orders"),
        half_up_ratio("_dd", "_n_dd", 2).alias("avg_delivery_days"),
        half_up_ratio("_gap", "_n_gap", 2).alias("avg_estimated_gap_days"),
        half_up_ratio("_delayed", "_n_delayed", 2, mult=100).alias("delay_rate"),
        _mean_money("_freight", "_n_freight").alias("avg_freight_value"),
        round_double(F.col("_review")).alias("avg_review_score"),
        F.when(pct_le(p.fast_delay) & (F.col("_review") >= p.good_review), "FAST_RELIABLE")
        .when(pct_le(p.good_delay), "GOOD_DELIVERY")
        .when(pct_ge(p.delay_risk), "DELIVERY_RISK")
        .otherwise("REGULAR").alias("delivery_segment"))


# ---------------------------------------------------------------- MRT-6 / MRT-7
def _delivered_by_period(fact_orders: DataFrame, dim_date: DataFrame, dim_customer: DataFrame,
                         period: Column, period_name: str) -> DataFrame:
    """Two-level aggregate of delivered orders: (period, customer) then period.

    ``fact_orders`` has one row per order, so distinct orders per period is a
    row count; distinct (repeat) customers are the rows of the first level.
    """
    dates = F.broadcast(dim_date.select("date_sk", "full_date"))
    base = (fact_orders.filter(F.col("order_status") == "delivered")
            .select("purchase_date_sk", "customer_sk", "total_payment_amount",
                    "avg_review_score", "is_delayed")
            .join(dates, F.col("purchase_date_sk") == F.col("date_sk"))
            .join(dim_customer.select("customer_sk", "is_repeat_customer"), "customer_sk")
            .withColumn(period_name, period))
    per_customer = base.groupBy(period_name, "customer_sk").agg(
        F.max("full_date").alias("_fd"),
        F.max("is_repeat_customer").alias("_rep"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("total_payment_amount").alias("_gmv"),
        F.sum("avg_review_score").alias("_review"),
        F.sum("is_delayed").alias("_delayed"))
    return by_period(per_customer, period_name)


def by_period(per_customer: DataFrame, period_name: str) -> DataFrame:
    """Sums over a period from rows of one period and customer (``_fd, _rep, _n, _gmv, _review, _delayed``)."""
    return per_customer.groupBy(period_name).agg(
        F.max("_fd").alias("full_date"),
        F.sum("_n").alias("total_orders"),
        F.count(F.lit(1)).alias("total_customers"),
        F.sum(F.when(F.col("_rep") == 1, 1).otherwise(0)).alias("repeat_customers"),
        F.sum("_gmv").alias("total_gmv"),
        F.sum("_review").alias("_review_sum"),
        F.sum("_delayed").alias("_delayed"))


def executive_kpi(fact_orders: DataFrame, dim_date: DataFrame,
                  dim_customer: DataFrame) -> DataFrame:
    """MRT-6: daily KPIs of delivered orders (``avg_review_score`` unrounded)."""
    return daily_kpis(_delivered_by_period(fact_orders, dim_date, dim_customer, F.col("purchase_date_sk"), "date_sk"))


def daily_kpis(g: DataFrame) -> DataFrame:
    """The daily mart from its sums (:func:`by_period` of ``date_sk``)."""
    n = F.col("total_orders")
    return g.select(
        F.col("date_sk").cast("int").alias("date_sk"), "full_date",
        n.cast("long").alias("total_orders"),
        F.col("total_customers").cast("long").alias("total_customers"),
        F.col("repeat_customers").cast("long").alias("repeat_customers"),
        F.col("total_gmv").cast("double").alias("total_gmv"),
        half_up_ratio(unscaled(F.col("total_gmv")), n, 2, num_scale=2).alias("avg_order_value"),
        _div(F.col("_review_sum"), n).alias("avg_review_score"),
        half_up_ratio("_delayed", n, 2, mult=100).alias("delay_rate"))


def monthly_business_summary(fact_orders: DataFrame, dim_date: DataFrame,
                             dim_customer: DataFrame) -> DataFrame:
    """MRT-7: the same KPIs by ``yyyy-MM`` — recomputed from the facts, since
    distinct counts of days do not add up to months."""
    return monthly_kpis(_delivered_by_period(fact_orders, dim_date, dim_customer, D.year_month("full_date"), "year_month"))


def monthly_kpis(g: DataFrame) -> DataFrame:
    """The monthly mart from its sums (:func:`by_period` of ``year_month``)."""
    n = F.col("total_orders")
    return g.select(
        "year_month", n.cast("long").alias("total_orders"),
        F.col("total_customers").cast("long").alias("total_customers"),
        F.col("repeat_customers").cast("long").alias("repeat_customers"),
        F.col("total_gmv").cast("double").alias("total_gmv"),
        half_up_ratio(unscaled(F.col("total_gmv")), n, 2, num_scale=2).alias("avg_order_value"),
        round_double(_div(F.col("_review_sum"), n)).alias("avg_review_score"),
        half_up_ratio("_delayed", n, 2, mult=100).alias("delay_rate"))


# ---------------------------------------------------------------- MRT-8
def category_dashboard(product_mart: DataFrame) -> DataFrame:
    """Unweighted means of the per-product (rounded) values, per category.
    ``total_orders`` re-counts an order that holds several products."""
    cents = lambda c: unscaled(F.col(c).cast("decimal(18,2)"))
    g = product_mart.groupBy("product_category_name").agg(
        F.count(F.lit(1)).alias("total_products"),
        F.sum("total_orders").alias("total_orders"),
        F.sum(F.col("total_revenue").cast("decimal(18,2)")).alias("total_revenue"),
        F.sum(cents("avg_review_score")).alias("_rv"), F.count("avg_review_score").alias("_n_rv"),
        F.sum(cents("delay_rate")).alias("_dl"), F.count("delay_rate").alias("_n_dl"),
        F.sum(cents("freight_ratio")).alias("_fr"), F.count("freight_ratio").alias("_n_fr"))
    return g.select(
        "product_category_name", F.col("total_products").cast("long").alias("total_products"),
        F.col("total_orders").cast("long").alias("total_orders"),
        F.col("total_revenue").cast("double").alias("total_revenue"),
        half_up_ratio("_rv", "_n_rv", 2, num_scale=2).alias("avg_review_score"),
        half_up_ratio("_dl", "_n_dl", 2, num_scale=2).alias("avg_delay_rate"),
        half_up_ratio("_fr", "_n_fr", 2, num_scale=2).alias("avg_freight_ratio"))


# ---------------------------------------------------------------- MRT-9
def favorite_category(fact_order_items: DataFrame, fact_orders: DataFrame,
                      dim_product: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Most-bought category per customer (ties: smallest name) — WN-5 as an aggregate."""
    if base is None:
        base = (fact_order_items.select("order_sk", "product_sk")
                .join(fact_orders.select("order_sk", "customer_sk"), "order_sk")
                .join(dim_product.select("product_sk", "product_category_name"), "product_sk"))
    per = (base.select("customer_sk", "product_category_name")
           .groupBy("customer_sk", "product_category_name").agg(F.count(F.lit(1)).alias("cnt")))
    best = per.groupBy("customer_sk").agg(
        F.min(F.struct((-F.col("cnt")).alias("n"), F.col("product_category_name").alias("c")))
        .alias("w"))
    return best.select("customer_sk", F.col("w.c").alias("favorite_category"),
                       (-F.col("w.n")).alias("purchase_cnt"))


def customer_360(dim_customer: DataFrame, fact_orders: DataFrame, rfm: DataFrame,
                 fact_order_items: DataFrame, dim_product: DataFrame,
                 base: DataFrame | None = None) -> DataFrame:
    """One row per customer: lifetime values, review / delivery means, favourite
    category, RFM and customer segments. Orders are aggregated per customer
    first; every join is then 1:1 on ``customer_sk``."""
    fo = fact_orders.groupBy("customer_sk").agg(
        F.sum("avg_review_score").alias("_rv"), F.count("avg_review_score").alias("_n_rv"),
        F.sum("delivery_days").alias("_dd"), F.count("delivery_days").alias("_n_dd"))
    fav = favorite_category(fact_order_items, fact_orders, dim_product, base)
    j = (dim_customer.select("customer_sk", "lifetime_orders", "lifetime_value",
                             "customer_segment")
         .join(fo, "customer_sk", "left")
         .join(rfm.select("customer_sk", "rfm_segment"), "customer_sk", "left")
         .join(fav.select("customer_sk", "favorite_category"), "customer_sk", "left"))
    n = F.col("lifetime_orders")
    return j.select(
        "customer_sk", n.alias("lifetime_orders"),
        F.col("lifetime_value").cast("double").alias("lifetime_value"),
        F.when(n == 0, F.lit(0.0))
        .otherwise(half_up_ratio(unscaled(F.col("lifetime_value")), n, 2, num_scale=2))
        .alias("avg_order_value"),
        _div(F.col("_rv"), F.col("_n_rv")).alias("avg_review_score"),
        _div(F.col("_dd"), F.col("_n_dd")).alias("avg_delivery_days"),
        "favorite_category", "rfm_segment", "customer_segment")
