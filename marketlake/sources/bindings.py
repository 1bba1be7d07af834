"""Bronze-shaped views over the driver's TPC-H-like tables.

The driver tables carry no NULLs, dirty text, sentinels, duplicates or order
lifecycle dates. These bindings derive every bronze input with deterministic
column expressions (the same ones the SQL oracle uses), injecting exactly the
defects the silver layer is meant to repair. Every binding is a narrow
projection of one scan, so the column pruning reaches the Parquet reader.

``k`` below is the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.dates import add_days, add_minutes
from marketlake.functions.nulls import LONG_MIN_SENTINEL

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Calendar covering the driver's order and ship dates.


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# The driver tables the bronze bindings read.
BOUND_TABLES = ("customer", "orders", "lineitem", "part", "supplier")


def bound_paths(sf_dir: str) -> list[str]:
    return [table_path(sf_dir, t) for t in BOUND_TABLES]


def _s(c) -> F.Column:
    return F.col(c).cast("string")


def b_customers(spark, sf_dir) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        _s("c_custkey").alias("customer_id"),
        (k - k % 2).cast("string").alias("customer_unique_id"),
        F.lpad((F.lit(1000) + (k * 37) % 99000).cast("string"), 5, "0")
        .alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("customer_city"),
        F.concat(F.lit("n"), _s("c_nationkey")).alias("customer_state"),
    )


def b_orders(spark, sf_dir) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = (F.when(F.col("o_orderstatus") == "F", "delivered")
              .when(F.col("o_orderstatus") == "O", "shipped")
              .when(k % 2 == 0, "canceled").otherwise("processing"))
    purchase = add_minutes("o_orderdate", k % 1440)
    carrier = F.when((status == "canceled") | (k % 53 == 0), F.lit(None)) \
        .otherwise(add_minutes(purchase, (k * 13) % 7200 + 2500))
    return o.select(
        _s("o_orderkey").alias("order_id"),
        _s("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        F.when(k % 97 == 0, F.lit(None))
        .otherwise(add_minutes(purchase, (k * 7) % 2880)).alias("order_approved_at"),
        carrier.alias("order_delivered_carrier_date"),
        F.when((status != "delivered") | (k % 89 == 0), F.lit(None))
        .otherwise(add_days(carrier, k % 21 - 1)).alias("order_delivered_customer_date"),
        add_days("o_orderdate", F.lit(14)).alias("order_estimated_delivery_date"),
    )


def b_order_items(spark, sf_dir) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    rows = li.select(
        _s("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("order_item_id"),
        _s("l_partkey").alias("product_id"),
        _s("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_tax") == 0, F.lit(0.0)).otherwise(F.col("l_quantity"))
        .alias("freight_value"),
        F.col("l_orderkey").alias("_k"),
    )
    dup = rows.filter(F.col("_k") % 50 == 0)
    return rows.unionByName(dup).drop("_k")


def b_order_payments(spark, sf_dir) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    rf = F.col("l_returnflag")
    return li.select(
        _s("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("payment_sequential"),
        F.when(rf == "R", " Credit_Card ").when(rf == "A", "BOLETO")
        .when(rf == "N", "voucher").alias("payment_type"),
        (F.col("l_quantity").cast("int") % 12).alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )


def b_order_reviews(spark, sf_dir) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        # every tenth review has lost its id and is dropped by the silver rule (SIL-5)
        F.when(k % 10 != 0, F.concat(F.lit("r"), _s("o_orderkey"))).alias("review_id"),
        _s("o_orderkey").alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.concat(F.col("o_orderpriority"), F.lit(" ")).alias("review_comment_message"),
        F.col("o_orderdate").alias("review_creation_date"),
        add_days("o_orderdate", k % 5 - 1).alias("review_answer_timestamp"),
    )


def b_products(spark, sf_dir) -> DataFrame:
    p = load(spark, sf_dir, "part")
    k = F.col("p_partkey")
    size = F.col("p_size").cast("long")
    return p.select(
        _s("p_partkey").alias("product_id"),
        F.when(k % 50 == 0, F.lit(None)).otherwise(F.concat(F.col("p_type"), F.lit(" ")))
        .alias("product_category_name"),
        F.when(k % 41 == 0, F.lit(LONG_MIN_SENTINEL).cast("long"))
        .otherwise(F.length("p_name").cast("long")).alias("product_name_lenght"),
        F.lit(None).cast("long").alias("product_description_lenght"),
        F.lit(None).cast("long").alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size % 20).alias("product_height_cm"),
        (size % 15).alias("product_width_cm"),
    )


def b_sellers(spark, sf_dir) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    return s.select(
        _s("s_suppkey").alias("seller_id"),
        (F.lit(1000) + F.col("s_suppkey") % 90000).cast("string").alias("seller_zip_code_prefix"),
        F.concat(F.lit("São "), F.col("s_name")).alias("seller_city"),
        F.concat(F.lit("n"), _s("s_nationkey")).alias("seller_state"),
    )


def b_category_translation(spark, sf_dir) -> DataFrame:
    p = load(spark, sf_dir, "part")
    t = F.lower(F.col("p_type"))
    # one category is misspelt in the translation, so its products find none
    return (p.select(F.when(F.col("p_type") == "ECONOMY", F.lit("econmy")).otherwise(t).alias("product_category_name"),
                    F.concat(F.lit("en_"), t).alias("product_category_name_english"))
            .distinct())


def b_geolocation(spark, sf_dir) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.lpad(_s("c_nationkey"), 5, "0").alias("geolocation_zip_code_prefix"),
        (k % 180 - 90).cast("double").alias("geolocation_lat"),
        (k % 360 - 180).cast("double").alias("geolocation_lng"),
        F.when(k % 3 == 0, "são paulo").when(k % 3 == 1, "sao paulo")
        .otherwise("Brasília").alias("geolocation_city"),
        F.concat(F.lit("n"), _s("c_nationkey")).alias("geolocation_state"),
    )


BRONZE_BINDINGS = {
    "customers": b_customers,
    "geolocation": b_geolocation,
    "order_items": b_order_items,
    "order_payments": b_order_payments,
    "order_reviews": b_order_reviews,
    "orders": b_orders,
    "products": b_products,
    "sellers": b_sellers,
    "category_translation": b_category_translation,
}


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All nine bronze inputs bound to the driver tables under ``sf_dir``."""
    return {name: fn(spark, sf_dir) for name, fn in BRONZE_BINDINGS.items()}
