"""Silver layer: one cleaning job per bronze table (SIL-1..9).

Each job is a pure ``DataFrame -> DataFrame`` function whose output columns
follow the silver DDL (audit column excluded; see ``sources.files.with_audit``).
Filters always read the *raw* bronze columns, before any column is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import dates as D
from marketlake.functions.nulls import null_if_negative, null_if_nonpositive, null_if_sentinel
from marketlake.functions.text import (default_unknown, fold_accents, text_len, trim_lower,
                                       trim_upper)
from marketlake.operators.dedupe import dedupe_by_key, dedupe_rows, majority_row

ORDER_STATUSES = ("approved", "canceled", "created", "shipped", "unavailable", "processing",
                  "invoiced", "delivered")
NON_DELIVERED = ("approved", "canceled", "created", "shipped", "unavailable", "processing",
                 "invoiced")

PRODUCT_LONG_COLS = ("product_name_lenght", "product_description_lenght", "product_photos_qty",
                     "product_weight_g", "product_length_cm", "product_height_cm",
                     "product_width_cm")

# Product size buckets by volume in cm3.
SMALL_VOLUME_LT = 1000
MEDIUM_VOLUME_LT = 10000

# Payments of an order that are dealt to one task.
PAYMENTS = 64

# Lexical bounds of a valid seller zip prefix.
ZIP_LOW, ZIP_HIGH = "1000", "99999"


def customers(b: DataFrame) -> DataFrame:
    """SIL-1: trim ids, lower city, upper state. No filter, no dedupe."""
    return b.select(
        F.trim("customer_id").alias("customer_id"),
        F.trim("customer_unique_id").alias("customer_unique_id"),
        F.col("customer_zip_code_prefix"),
        trim_lower("customer_city").alias("customer_city"),
        trim_upper("customer_state").alias("customer_state"),
    )


def geolocation(b: DataFrame) -> DataFrame:
    """SIL-2: one row per zip prefix — the (folded city, state) group with most
    rows, carrying that group's mean coordinates."""
    keyed = b.withColumn("geolocation_city", fold_accents("geolocation_city"))
    best = majority_row(keyed, "geolocation_zip_code_prefix",
                        ["geolocation_city", "geolocation_state"],
                        {"geolocation_lat": F.avg("geolocation_lat"),
                         "geolocation_lng": F.avg("geolocation_lng")})
    return best.select("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                       "geolocation_city", "geolocation_state")


def valid_items(b: DataFrame) -> DataFrame:
    """The items with required keys and non-negative amounts (SIL-3 before the copies are removed)."""
    return b.filter((F.col("price") >= 0) & (F.col("freight_value") >= 0)
                    & F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull()
                    & F.col("product_id").isNotNull() & F.col("seller_id").isNotNull())


def order_items(b: DataFrame) -> DataFrame:
    """SIL-3: required keys, non-negative amounts, exact-copy removal, item value."""
    return dedupe_rows(valid_items(b)).withColumn("total_item_value",
                                                  F.col("price") + F.col("freight_value"))


def order_payments(b: DataFrame) -> DataFrame:
    """SIL-4: normalised payment type, non-negative values, exact-copy removal."""
    kept = (b.withColumn("payment_type", trim_lower("payment_type"))
            .filter(F.col("order_id").isNotNull() & F.col("payment_type").isNotNull()
                    & (F.col("payment_sequential") >= 0) & (F.col("payment_installments") >= 0)
                    & (F.col("payment_value") >= 0)))
    # copies meet where the first PAYMENTS of their order do, so totals per order move one row an order;
    # an order of very many payments is spread over several tasks
    run = F.call_function("div", F.col("payment_sequential"), F.lit(PAYMENTS)).cast("long")
    return dedupe_rows(kept.withColumn("_run", run).repartition("order_id", "_run")).drop("_run")


def order_reviews(b: DataFrame) -> DataFrame:
    """SIL-5: score 1..5, created no later than answered, exact-copy removal, text length."""
    kept = b.filter(F.col("review_id").isNotNull() & F.col("order_id").isNotNull()
                    & F.col("review_score").between(1, 5)
                    & (F.col("review_creation_date") <= F.col("review_answer_timestamp")))
    return dedupe_rows(kept).select(
        "review_id", "order_id", "review_score", "review_comment_title",
        "review_comment_message",
        text_len("review_comment_message").alias("review_comment_message_length"),
        "review_creation_date", "review_answer_timestamp")


def _order_time_filter() -> F.Column:
    """Raw-column lifecycle rules of SIL-6 (FIL-7, FIL-8, FIL-10).

    Strict date order applies only to delivered orders; every order must
    also keep purchase <= carrier, approved <= carrier and carrier <= delivered
    whenever the later date exists (NULL comparisons drop the row).
    """
    s = F.col("order_status")
    p, a = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    c, d = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    strict = (s == "delivered") & (p <= a) & (a <= c) & (a <= d) & (c <= d)
    return ((s.isin(*NON_DELIVERED) | strict)
            & (c.isNull() | (p <= c))
            & (c.isNull() | (a <= c))
            & (d.isNull() | (c <= d)))


def orders(b: DataFrame) -> DataFrame:
    """SIL-6: one row per order, lifecycle filter, repaired carrier date, derived times."""
    one = dedupe_by_key(b, ["order_id"])
    s = F.col("order_status")
    p, a = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    c, d = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    e = F.col("order_estimated_delivery_date")
    delivered = (s == "delivered") & d.isNotNull()
    carrier = (F.when(s.isin("canceled", "unavailable"), F.lit(None))
               .when(s == "created", p)
               .when(s.isin("approved", "processing", "invoiced", "shipped") & c.isNull(), a)
               .otherwise(c))
    return one.filter(_order_time_filter()).select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at",
        carrier.alias("order_delivered_carrier_date"),
        F.when(delivered, d).alias("order_delivered_customer_date"),
        F.when((s == "delivered") & e.isNotNull(), e).alias("order_estimated_delivery_date"),
        delivered.cast("int").alias("is_delivered"),
        D.minute_diff(p, a).cast("int").alias("approval_time"),
        F.when(delivered, D.day_diff(p, d)).alias("delivery_days"),
        F.when(delivered & e.isNotNull(), D.day_diff(e, d)).alias("delivery_delay_days"),
    )


def products(b: DataFrame) -> DataFrame:
    """SIL-7: sentinel -> NULL (before any arithmetic), one row per product,
    'unknown' category, range-clamped measures, volume, density, size bucket."""
    raw = b.select("product_id",
                   trim_lower("product_category_name").alias("product_category_name"),
                   *[null_if_sentinel(c).alias(c) for c in PRODUCT_LONG_COLS])
    one = dedupe_by_key(raw.filter(F.col("product_id").isNotNull()), ["product_id"])
    w, ln = F.col("product_weight_g"), F.col("product_length_cm")
    h, wd = F.col("product_height_cm"), F.col("product_width_cm")
    raw_volume = ln * h * wd
    dims_ok = (ln > 0) & (h > 0) & (wd > 0)
    return one.select(
        "product_id",
        default_unknown("product_category_name").alias("product_category_name"),
        null_if_negative("product_name_lenght").alias("product_name_length"),
        null_if_negative("product_description_lenght").alias("product_description_length"),
        null_if_negative("product_photos_qty").alias("product_photos_qty"),
        null_if_negative(w).alias("product_weight_g"),
        null_if_nonpositive(ln).alias("product_length_cm"),
        null_if_nonpositive(h).alias("product_height_cm"),
        null_if_nonpositive(wd).alias("product_width_cm"),
        F.when(dims_ok, raw_volume).alias("product_volume"),
        F.when((w > 0) & dims_ok, F.round(w.cast("double") / raw_volume, 2))
        .alias("product_density"),
        F.when(raw_volume < SMALL_VOLUME_LT, "small").when(raw_volume < MEDIUM_VOLUME_LT, "medium")
        .otherwise("large").alias("product_size_category"),
    )


def sellers(b: DataFrame) -> DataFrame:
    """SIL-8: lexical zip range, normalised city/state, one row per seller, folded city."""
    kept = (b.filter(F.col("seller_zip_code_prefix").between(ZIP_LOW, ZIP_HIGH))
            .select("seller_id", "seller_zip_code_prefix",
                    trim_lower("seller_city").alias("seller_city"),
                    trim_upper("seller_state").alias("seller_state")))
    one = dedupe_by_key(kept, ["seller_id"])
    return one.select("seller_id", "seller_zip_code_prefix",
                      fold_accents("seller_city").alias("seller_city"), "seller_state")


def category_translation(b: DataFrame) -> DataFrame:
    """SIL-9: normalised names, one row per category, folded name, 'unknown' English."""
    kept = (b.filter(F.col("product_category_name").isNotNull())
            .select(trim_lower("product_category_name").alias("product_category_name"),
                    trim_lower("product_category_name_english")
                    .alias("product_category_name_english")))
    one = dedupe_by_key(kept, ["product_category_name"])
    return one.select(fold_accents("product_category_name").alias("product_category_name"),
                      default_unknown("product_category_name_english")
                      .alias("product_category_name_english"))


SILVER_JOBS = {
    "customers": customers,
    "geolocation": geolocation,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "orders": orders,
    "products": products,
    "sellers": sellers,
    "category_translation": category_translation,
}


def build_silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: job(bronze[name]) for name, job in SILVER_JOBS.items()}
