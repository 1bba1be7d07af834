"""Gold star schema: dimensions and facts (GLD-1..6).

Join strategy (what keeps this linear at scale):

* every N-side (payments, items, reviews) is aggregated to the join key
  *before* it meets its master table (JN-3) — no fan-out, and the partial
  aggregate combines map-side;
* customers are resolved to ``customer_sk`` once, at customer grain, and that
  small-width mapping is joined to orders (one shuffle of orders by
  ``customer_id`` instead of two);
* the date dimension is broadcast: its row count is the number of calendar
  days (a proven bound). Other dimensions grow with the data, so they are left
  to AQE, which broadcasts them only when their *measured* size is under the
  threshold and otherwise sort-merge joins (splitting skewed keys);
* surrogate keys come from a staged range sort, those of the items too (``operators.rank``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import dates as D
from marketlake.functions.numeric import half_up_ratio, money, unscaled
from marketlake.operators.dedupe import dedupe_rows
from marketlake.operators.rank import line_numbers, surrogate_key
from marketlake.sources.calendar import REFERENCE_END, REFERENCE_START, calendar_days
from marketlake.sources.calendar import dim_date as _dim_date

# Upper bound of the broadcast date dimension: 200 years of days (~73k rows).
MAX_CALENDAR_DAYS = 200 * 366


@dataclass(frozen=True)
class GoldParams:
    """Business thresholds and the calendar (defaults = the warehouse's values)."""
    cal_start: str = REFERENCE_START
    cal_end: str = REFERENCE_END
    vip_orders: int = 5
    vip_value: float = 1000.0
    loyal_orders: int = 3
    regular_orders: int = 2
    top_seller_sales: float = 100000.0
    high_value_price: float = 500.0

    def __post_init__(self):
        # the date dimension is broadcast; its size is the calendar length
        days = calendar_days(self.cal_start, self.cal_end)
        if not 0 < days <= MAX_CALENDAR_DAYS:
            raise ValueError(f"calendar of {days} days outside 1..{MAX_CALENDAR_DAYS}")


def calendar_params(orders: DataFrame, items: DataFrame) -> GoldParams:
    """Default thresholds and the calendar years that the purchase and shipping-limit dates span
    (one aggregate each; the warehouse's own years where there are no dates). Dates that would make
    the calendar longer than 200 years are an error: name the years then."""
    spans = [df.agg(F.min(F.to_date(c)), F.max(F.to_date(c))).first() for df, c in ((orders, "order_purchase_timestamp"), (items, "shipping_limit_date"))]
    days = [d for span in spans for d in span if d is not None]
    return GoldParams(cal_start=f"{min(days).year:04d}-01-01", cal_end=f"{max(days).year:04d}-12-31") if days else GoldParams()


def off_calendar(rows: DataFrame, date_col: str, dd: DataFrame, table: str) -> DataFrame:
    """(table_name, n_rows, n_off): rows whose date the calendar lacks, which its inner joins drop."""
    days = F.broadcast(dd.select(F.col("full_date").alias("_day"), F.lit(1).alias("_on")))
    return rows.select(F.to_date(date_col).alias("_at")).join(days, F.col("_at") == F.col("_day"), "left") \
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_on").isNull()).alias("n_off")) \
        .select(F.lit(table).alias("table_name"), "n_rows", "n_off")


def dim_date(spark: SparkSession, p: GoldParams = GoldParams()) -> DataFrame:
    """GLD-2."""
    return _dim_date(spark, p.cal_start, p.cal_end)


def _date_keys(dd: DataFrame) -> DataFrame:
    """(full_date, date_sk) pairs for the broadcast date join (bounded by calendar days)."""
    return F.broadcast(dd.select("full_date", "date_sk"))


def payment_totals(payments: DataFrame) -> DataFrame:
    """Per-order payment aggregate (JN-3)."""
    return payments.groupBy("order_id").agg(
        F.sum(money("payment_value")).alias("total_payment_amount"),
        F.count(F.lit(1)).alias("payment_count"),
        F.avg(F.col("payment_installments").cast("double")).alias("avg_installments"))


def dim_customer(customers: DataFrame, orders: DataFrame, payments: DataFrame,
                 p: GoldParams = GoldParams(), pay_totals: DataFrame | None = None) -> DataFrame:
    """GLD-1: one row per person with lifetime metrics and a segment. ``pay_totals``: the
    :func:`payment_totals` of ``payments``, where they are there already."""
    pay = (payment_totals(payments) if pay_totals is None else pay_totals).select("order_id", "total_payment_amount")
    per_order = (orders.select("order_id", "customer_id", "order_purchase_timestamp")
                 .join(pay, "order_id", "left"))
    joined = customers.select("customer_id", "customer_unique_id", "customer_city",
                              "customer_state").join(per_order, "customer_id", "inner")
    n = F.countDistinct("order_id")
    ltv = F.coalesce(F.sum("total_payment_amount"), F.lit(0).cast("decimal(28,2)"))
    m = joined.groupBy("customer_unique_id").agg(
        F.min("customer_city").alias("customer_city"),
        F.min("customer_state").alias("customer_state"),
        F.min(F.to_date("order_purchase_timestamp")).alias("first_order_date"),
        F.max(F.to_date("order_purchase_timestamp")).alias("last_order_date"),
        n.alias("lifetime_orders"),
        ltv.alias("lifetime_value"))
    orders_n, value = F.col("lifetime_orders"), F.col("lifetime_value")
    out = m.select(
        "customer_unique_id", "customer_city", "customer_state", "first_order_date",
        "last_order_date", orders_n.alias("lifetime_orders"),
        value.cast("decimal(18,2)").alias("lifetime_value"),
        F.coalesce(half_up_ratio(unscaled(value), orders_n, 2, num_scale=2), F.lit(0.0))
        .cast("decimal(18,2)").alias("avg_order_value"),
        (orders_n > 1).cast("int").alias("is_repeat_customer"),
        F.when((orders_n >= p.vip_orders) & (value >= p.vip_value), "VIP")
        .when(orders_n >= p.loyal_orders, "LOYAL")
        .when(orders_n >= p.regular_orders, "REGULAR")
        .otherwise("NEW").alias("customer_segment"))
    return surrogate_key(out, ["customer_unique_id"], "customer_sk").select(
        F.col("customer_sk"), *out.columns)


def customer_keys(customers: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """customer_id -> customer_sk, at customer grain."""
    return (customers.select("customer_id", "customer_unique_id")
            .join(dim_cust.select("customer_unique_id", "customer_sk"), "customer_unique_id")
            .select("customer_id", "customer_sk"))


@dataclass(frozen=True)
class OrderLines:
    """Order items in the layout of the lake: ``cold`` lies in buckets of ``order_id``; the lines of
    the orders in ``hot_ids``, each of which would fill much of a bucket, lie apart in ``hot``. There
    are few such orders by construction (:func:`hot_orders`), so what belongs to them is broadcast."""
    cold: DataFrame
    hot: DataFrame | None = None
    hot_ids: DataFrame | None = None

    def all(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.union(self.hot)

    def with_orders(self, orders: DataFrame, how: str = "inner") -> DataFrame:
        """The lines with the columns of ``orders`` (one row per ``order_id``): buckets meet buckets,
        hot lines meet the few hot orders where they are."""
        out = self.cold.join(orders, "order_id", how)
        if self.hot is None:
            return out
        few = orders.join(F.broadcast(self.hot_ids), "order_id", "left_semi")
        return out.union(self.hot.join(F.broadcast(few), "order_id", how))

    def per_order(self, *aggregates) -> DataFrame:
        out = self.cold.groupBy("order_id").agg(*aggregates)
        return out if self.hot is None else out.union(self.hot.groupBy("order_id").agg(*aggregates))


def hot_orders(items: DataFrame, buckets: int) -> DataFrame:
    """Ids of the orders with more than a quarter of a bucket's share of ``items``: 4 * ``buckets`` at
    most, whatever the data."""
    counts = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.where(4 * buckets * F.col("n") > total).select("order_id")


def order_keys(orders: DataFrame, customers: DataFrame, dim_cust: DataFrame, dd: DataFrame) -> DataFrame:
    """(order_id, order_sk, customer_sk, purchase_date_sk) of the orders that have a customer, a person
    and a calendar day: the inner joins of the order fact at their narrowest, numbered by order_id.
    Orders off the calendar are counted by ``dq_off_calendar``."""
    narrow = orders.select("order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("_pd")) \
        .join(customer_keys(customers, dim_cust), "customer_id") \
        .join(_date_keys(dd), F.col("_pd") == F.col("full_date")) \
        .select("order_id", "customer_sk", F.col("date_sk").alias("purchase_date_sk"))
    return surrogate_key(narrow, ["order_id"], "order_sk")


def keyed_orders(orders: DataFrame, keys: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(order_id, order_purchase_timestamp, order_keys): one row per silver order with the list of its
    :func:`order_keys` - none for an order without customer or calendar day - and what ``carry`` names."""
    listed = keys.groupBy("order_id").agg(F.collect_list(F.struct("order_sk", "customer_sk", "purchase_date_sk", *[c for c in carry if c in keys.columns])).alias("order_keys"))
    return orders.select("order_id", "order_purchase_timestamp").join(listed, "order_id", "left")


def met_items(items: DataFrame, met: DataFrame) -> DataFrame:
    """Silver items with the columns of :func:`keyed_orders`, from the valid items before copies are
    removed: copies share their order, so rows meet it first and copies go where they met. The items
    move once for both."""
    return dedupe_rows(items.join(met, "order_id", "left"))


def fact_orders(orders: DataFrame, items: DataFrame | OrderLines, payments: DataFrame, reviews: DataFrame,
                keys: DataFrame, pay_totals: DataFrame | None = None) -> DataFrame:
    """GLD-3: one row per order with its keys (:func:`order_keys`) and its pre-aggregated items,
    payments and reviews. All inputs are keyed by ``order_id``: in the lake's buckets of it, nothing moves.

    Missing aggregates become 0 — including ``avg_review_score``, as in the
    warehouse. ``approval_minutes`` holds the approval time in minutes (the
    warehouse stored it in a column called *approval_days*); ``approval_days``
    is the day-boundary count. ``pay_totals`` as in :func:`dim_customer`.
    """
    items = items if isinstance(items, OrderLines) else OrderLines(items)
    item_agg = items.per_order(
        F.count(F.lit(1)).alias("total_items"),
        F.sum(money("price")).alias("total_item_amount"),
        F.sum(money("freight_value")).alias("total_freight_amount"))
    pay_agg = (payment_totals(payments) if pay_totals is None else pay_totals).select("order_id", "total_payment_amount")
    rev_agg = reviews.groupBy("order_id").agg(
        F.avg(F.col("review_score").cast("double")).alias("avg_review_score"))

    base = (orders.join(keys, "order_id")
            .join(item_agg, "order_id", "left")
            .join(pay_agg, "order_id", "left")
            .join(rev_agg, "order_id", "left"))
    zero = F.lit(0).cast("decimal(18,2)")
    d, e = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return base.select(
        "order_sk", "order_id", "customer_sk", "purchase_date_sk", "order_status",
        F.coalesce(F.col("total_items"), F.lit(0)).cast("long").alias("total_items"),
        F.coalesce(F.col("total_item_amount"), zero).cast("decimal(18,2)").alias("total_item_amount"),
        F.coalesce(F.col("total_freight_amount"), zero).cast("decimal(18,2)")
        .alias("total_freight_amount"),
        F.coalesce(F.col("total_payment_amount"), zero).cast("decimal(18,2)")
        .alias("total_payment_amount"),
        F.coalesce(F.col("avg_review_score"), F.lit(0.0)).alias("avg_review_score"),
        "is_delivered", "delivery_days",
        D.day_diff("order_purchase_timestamp", e).alias("estimated_delivery_days"),
        F.when(d.isNull(), 0).when(d > e, 1).otherwise(0).alias("is_delayed"),
        "delivery_delay_days",
        F.col("approval_time").alias("approval_minutes"),
        D.day_diff("order_purchase_timestamp", "order_approved_at").alias("approval_days"))


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """GLD-4: products with their English category (left join: misses stay NULL)."""
    t = translation.select("product_category_name",
                           F.col("product_category_name_english").alias("product_category_english"))
    out = products.join(t, "product_category_name", "left").select(
        "product_id", "product_category_name", "product_category_english",
        F.col("product_name_length").cast("int").alias("product_name_length"),
        F.col("product_description_length").cast("int").alias("product_description_length"),
        F.col("product_photos_qty").cast("int").alias("product_photos_qty"),
        F.col("product_weight_g").cast("int").alias("product_weight_g"),
        F.col("product_length_cm").cast("int").alias("product_length_cm"),
        F.col("product_height_cm").cast("int").alias("product_height_cm"),
        F.col("product_width_cm").cast("int").alias("product_width_cm"),
        F.col("product_volume").cast("int").alias("product_volume_cm3"),
        "product_density", "product_size_category")
    keyed = surrogate_key(out, ["product_id"], "product_sk")
    return keyed.select(F.col("product_sk"), *out.columns)


def keyed_sellers(sellers: DataFrame) -> DataFrame:
    """The sellers and their ``seller_sk``: what the seller dimension has without the sales metrics."""
    return surrogate_key(sellers, ["seller_id"], "seller_sk").select("seller_sk", *sellers.columns)


def dim_seller(sellers: DataFrame, items: DataFrame | OrderLines, orders: DataFrame,
               p: GoldParams = GoldParams()) -> DataFrame:
    """GLD-5: sellers with sales metrics.

    Items are aggregated per seller *before* the join with the seller master,
    so a seller holding a third of all items is combined map-side instead of
    skewing a left-outer join (whose preserved side cannot be split). A seller
    without items keeps the warehouse's ``COUNT(*)`` over an outer join: 1.
    :func:`met_items` have met their orders, :func:`keyed_sellers` have their number already.
    """
    items = items if isinstance(items, OrderLines) else OrderLines(items)
    met = "order_purchase_timestamp" in items.cold.columns
    sold = (items.all() if met else items.with_orders(orders.select("order_id", "order_purchase_timestamp"), "left")) \
        .select("order_id", "seller_id", "price", "order_purchase_timestamp")
    agg = sold.groupBy("seller_id").agg(
        F.min("order_purchase_timestamp").alias("_first"),
        F.max("order_purchase_timestamp").alias("_last"),
        F.countDistinct("order_id").alias("_orders"),
        F.count(F.lit(1)).alias("_items"),
        F.sum(money("price")).alias("_sales"),
        F.count("price").alias("_priced"))
    j = sellers.join(agg, "seller_id", "left")
    sales = F.col("_sales")
    out = j.select(
        "seller_id",
        F.col("seller_zip_code_prefix").cast("int").alias("seller_zip_code_prefix"),
        "seller_city", "seller_state",
        F.to_date("_first").alias("first_sale_date"),
        F.to_date("_last").alias("last_sale_date"),
        F.coalesce(F.col("_orders"), F.lit(0)).cast("long").alias("total_orders"),
        F.coalesce(F.col("_items"), F.lit(1)).cast("long").alias("total_items_sold"),
        F.coalesce(sales, F.lit(0)).cast("decimal(18,2)").alias("total_sales_amount"),
        F.coalesce(half_up_ratio(unscaled(sales), F.col("_priced"), 2, num_scale=2), F.lit(0.0))
        .cast("decimal(18,2)").alias("avg_item_price"),
        F.coalesce((sales >= p.top_seller_sales).cast("int"), F.lit(0)).alias("is_top_seller"),
        *[c for c in ("seller_sk",) if c in sellers.columns])
    if "seller_sk" in out.columns:
        return out.select("seller_sk", *[c for c in out.columns if c != "seller_sk"])
    keyed = surrogate_key(out, ["seller_id"], "seller_sk")
    return keyed.select(F.col("seller_sk"), *out.columns)


def fact_order_items(items: DataFrame | OrderLines, keys: DataFrame, d_product: DataFrame,
                     d_seller: DataFrame, dd: DataFrame,
                     p: GoldParams = GoldParams(), carry: tuple[str, ...] = (), number: bool = True) -> DataFrame:
    """GLD-6: one row per item, keyed to all dimensions (JN-5/6/7).

    The order, customer and purchase-date keys come from :func:`order_keys` (or a fact that holds
    them), which applied the order→customer→person→date inner joins; the
    shipping-limit date is a second, role-playing join on the broadcast
    calendar. Relies on ``customer_id`` being unique in silver customers
    (a key of its load contract). ``carry`` names further columns of ``keys`` or ``d_product`` that
    the lines take along, so that nobody joins these tables to the lines again. :func:`met_items`
    hold the keys of their order. ``number=False`` leaves out ``order_item_sk`` and the sort for it.
    """
    items = items if isinstance(items, OrderLines) else OrderLines(items)
    if "order_keys" in items.cold.columns:
        ordered = items.all().select(*[c for c in items.cold.columns if c not in ("order_purchase_timestamp", "order_keys")], F.inline("order_keys"))
    else:
        ordered = items.with_orders(keys.select("order_id", "order_sk", "customer_sk", "purchase_date_sk", *[c for c in carry if c in keys.columns]))
    ship_keys = _date_keys(dd).withColumnRenamed("full_date", "_ship_full") \
        .withColumnRenamed("date_sk", "shipping_limit_date_sk")
    base = (ordered.withColumn("_ship", F.to_date("shipping_limit_date"))
            .join(ship_keys, F.col("_ship") == F.col("_ship_full"), "inner")
            .join(d_seller.select("seller_id", "seller_sk"), "seller_id", "inner")
            .join(d_product.select("product_id", "product_sk", *[c for c in carry if c in d_product.columns]), "product_id", "inner"))
    # what the lines are told apart by travels once: product_sk and seller_sk number the products and
    # sellers by their ids, order_sk the orders, so this is the order by (order_id, order_item_id,
    # product_id, seller_id, ...); (order_id, order_item_id) can repeat
    narrow = base.select(
        "order_id", F.col("order_item_id").cast("int").alias("order_item_id"), "order_sk",
        "customer_sk", "product_sk", "seller_sk", "purchase_date_sk", "shipping_limit_date_sk",
        *carry, "shipping_limit_date", "price", "freight_value")
    keyed = line_numbers(narrow, "order_sk", "order_item_id", ["product_sk", "seller_sk", "shipping_limit_date", "price", "freight_value"], "order_item_sk") \
        if number else narrow
    price, freight = money("price"), money("freight_value")
    return keyed.select(
        *(["order_item_sk"] if number else []), "order_id", "order_item_id", "order_sk", "customer_sk", "product_sk", "seller_sk",
        "purchase_date_sk", "shipping_limit_date_sk",
        price.alias("item_price"), freight.alias("freight_value"),
        (price + freight).cast("decimal(18,2)").alias("total_item_value"),
        (F.col("freight_value") == 0).cast("int").alias("is_freight_free"),
        (F.col("price") >= p.high_value_price).cast("int").alias("high_value_item_flag"), *carry)
