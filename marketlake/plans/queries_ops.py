"""Registered operator-family queries: filters, cleaning, data quality, joins,
aggregates and windows (SURVEY §2.2-2.8), each over the bound driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.functions import dates as D
from marketlake.functions.numeric import half_up_ratio, unscaled
from marketlake.functions.nulls import LONG_MIN_SENTINEL, null_if_sentinel
from marketlake.functions.text import fold_accents, trim_lower
from marketlake.operators import quality as Q
from marketlake.operators import stats as ST
from marketlake.operators.dedupe import dedupe_by_key, dedupe_rows, majority_row
from marketlake.operators.rank import global_ntile, global_row_number
from marketlake.operators.series import add_lags, series_features
from marketlake.plans import silver as S
from marketlake.plans.marts import favorite_category
from marketlake.plans.registry import register
from sqlcheck.fragments import cents, compose, fold, ratio

ORDER_TS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date"]


def _union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ================================================================ FIL
@register("fil_null_any", compose("""
SELECT order_id, order_status FROM b_orders
WHERE order_approved_at IS NULL OR order_delivered_carrier_date IS NULL
   OR order_delivered_customer_date IS NULL"""))
def fil_null_any(w):
    """FIL-1: orders with any lifecycle date missing."""
    from marketlake.sources.files import any_null
    b = w.bronze["orders"]
    return b.filter(any_null(["order_approved_at", "order_delivered_carrier_date",
                              "order_delivered_customer_date"])).select("order_id", "order_status")


@register("fil_required", compose("""
SELECT order_id, order_status FROM b_orders
WHERE order_approved_at IS NOT NULL AND order_delivered_carrier_date IS NOT NULL
  AND order_delivered_customer_date IS NOT NULL"""))
def fil_required(w):
    """FIL-2: orders with every lifecycle date present (``na.drop(subset)``)."""
    return w.bronze["orders"].na.drop(subset=["order_approved_at", "order_delivered_carrier_date",
                                              "order_delivered_customer_date"]) \
        .select("order_id", "order_status")


@register("fil_lexical_zip", compose("""
SELECT customer_id, customer_zip_code_prefix FROM b_customers
WHERE customer_zip_code_prefix BETWEEN '1000' AND '99999'"""))
def fil_lexical_zip(w):
    """FIL-4: zip prefixes in the *lexical* range '1000'..'99999' ('05000' is out)."""
    return w.bronze["customers"].filter(
        F.col("customer_zip_code_prefix").between(S.ZIP_LOW, S.ZIP_HIGH)) \
        .select("customer_id", "customer_zip_code_prefix")


@register("fil_time_order", compose("""
SELECT order_id FROM b_orders
WHERE order_purchase_timestamp <= order_approved_at
  AND order_approved_at <= order_delivered_carrier_date
  AND order_delivered_carrier_date <= order_delivered_customer_date"""))
def fil_time_order(w):
    """FIL-7: strict lifecycle order across columns (a NULL drops the row)."""
    c = F.col
    return w.bronze["orders"].filter(
        (c("order_purchase_timestamp") <= c("order_approved_at"))
        & (c("order_approved_at") <= c("order_delivered_carrier_date"))
        & (c("order_delivered_carrier_date") <= c("order_delivered_customer_date"))) \
        .select("order_id")


@register("fil_status_conditional", compose("""
SELECT order_status, count(*) AS n
FROM (SELECT *, list_filter([order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
                             order_delivered_customer_date], lambda x: x IS NOT NULL) AS stamps FROM b_orders)
JOIN b_status USING (order_status)
WHERE if(must_arrive, len(stamps) = 4 AND stamps = list_sort(stamps),
      if(order_delivered_carrier_date IS NULL, order_delivered_customer_date IS NULL,
         order_approved_at IS NOT NULL AND order_delivered_carrier_date >= greatest(order_purchase_timestamp, order_approved_at)
         AND coalesce(order_delivered_carrier_date <= order_delivered_customer_date, true)))
GROUP BY order_status"""))
def fil_status_conditional(w):
    """FIL-8/10: the silver lifecycle rule (strict order only for delivered), counted by status."""
    return (w.bronze["orders"].filter(S._order_time_filter())
            .groupBy("order_status").agg(F.count(F.lit(1)).alias("n")))


@register("fil_outliers", compose("""
SELECT product_id FROM b_products
WHERE product_weight_g < 0 OR product_length_cm <= 0 OR product_height_cm <= 0
   OR product_width_cm <= 0"""))
def fil_outliers(w):
    """FIL-12: products with an out-of-range measure."""
    c = F.col
    return w.bronze["products"].filter(
        (c("product_weight_g") < 0) | (c("product_length_cm") <= 0)
        | (c("product_height_cm") <= 0) | (c("product_width_cm") <= 0)).select("product_id")


# ================================================================ CLN
@register("cln_trim_case", compose("""
SELECT payment_type AS raw_type, lower(trim(payment_type)) AS payment_type, COUNT(*) AS n
FROM b_order_payments GROUP BY payment_type"""))
def cln_trim_case(w):
    """CLN-1/2: raw vs normalised payment types."""
    return (w.bronze["order_payments"].groupBy(F.col("payment_type").alias("raw_type"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("raw_type", trim_lower("raw_type").alias("payment_type"), "n"))


@register("cln_accent_fold", compose(f"""
SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS n_chars_text,
       md5({fold('text')}) AS folded_md5,
       CAST(length(text) - length(replace({fold('text')}, 'a', '')) AS INTEGER) AS n_a
FROM documents"""))
def cln_accent_fold(w):
    """CLN-3 on whole document texts: fingerprint of the folded text and the
    count of plain 'a' after folding (accented a-variants become 'a')."""
    d = w.table("documents")
    folded = fold_accents("text")
    return d.select("doc_id", "lang", F.length("text").alias("n_chars_text"),
                    F.md5(folded).alias("folded_md5"),
                    (F.length("text") - F.length(F.replace(folded, F.lit("a"), F.lit(""))))
                    .alias("n_a"))


_SENT_COLS = list(S.PRODUCT_LONG_COLS)


@register("cln_sentinel", compose(_union_sql([
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) AS BIGINT) AS n_rows, "
    f"CAST(SUM(CASE WHEN {c} = (-9223372036854775807 - 1) THEN 1 ELSE 0 END) AS BIGINT) AS n_sentinel, "
    f"CAST(SUM(CASE WHEN {c} IS NULL OR {c} = (-9223372036854775807 - 1) THEN 1 ELSE 0 END) AS BIGINT) AS n_null_after "
    f"FROM b_products" for c in _SENT_COLS])))
def cln_sentinel(w):
    """CLN-6: min-bigint sentinels per column, and NULLs after replacing them."""
    b = w.bronze["products"]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(_SENT_COLS):
        is_sent = F.col(c) == F.lit(LONG_MIN_SENTINEL).cast("long")
        aggs.append(F.sum(F.when(is_sent, 1).otherwise(0)).alias(f"_s{i}"))
        aggs.append(F.sum(F.when(null_if_sentinel(c).isNull(), 1).otherwise(0)).alias(f"_z{i}"))
    wide = b.agg(*aggs)
    pairs = ", ".join(f"'{c}', CAST(_s{i} AS BIGINT), CAST(_z{i} AS BIGINT)"
                      for i, c in enumerate(_SENT_COLS))
    return wide.selectExpr("_n AS n_rows",
                           f"stack({len(_SENT_COLS)}, {pairs}) AS (column_name, n_sentinel, n_null_after)") \
        .select("column_name", "n_rows", "n_sentinel", "n_null_after")


@register("cln_dedupe_row", compose("SELECT DISTINCT * FROM b_order_items"))
def cln_dedupe_row(w):
    """CLN-9: exact-copy removal."""
    return dedupe_rows(w.bronze["order_items"])


@register("cln_dedupe_key", compose("""
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, order_item_id ORDER BY
              product_id NULLS FIRST, seller_id NULLS FIRST, shipping_limit_date NULLS FIRST,
              price NULLS FIRST, freight_value NULLS FIRST) AS rn
      FROM b_order_items) t WHERE rn = 1"""))
def cln_dedupe_key(w):
    """CLN-10: one row per (order, line) key, deterministic winner."""
    return dedupe_by_key(w.bronze["order_items"], ["order_id", "order_item_id"])


@register("cln_majority", compose("""
SELECT order_id, payment_type, cnt
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY cnt DESC, payment_type) AS rn
      FROM (SELECT order_id, payment_type, COUNT(*) AS cnt FROM s_order_payments
            GROUP BY order_id, payment_type) g) r
WHERE rn = 1"""))
def cln_majority(w):
    """CLN-11 / WN-2: most frequent payment type per order (ties: smallest name)."""
    return majority_row(w.silver["order_payments"], "order_id", ["payment_type"], {})


@register("cln_size_density", compose(f"""
SELECT product_size_category, COUNT(*) AS n_products, COUNT(product_volume) AS n_with_volume,
       {ratio(f"SUM(CAST(round(product_density * 100) AS BIGINT))", 'COUNT(product_density)', 4, 1, 2)}
         AS avg_density
FROM s_products GROUP BY product_size_category"""))
def cln_size_density(w):
    """CLN-13..15: size buckets with their volume coverage and mean density."""
    p = w.silver["products"]
    return p.groupBy("product_size_category").agg(
        F.count(F.lit(1)).alias("n_products"), F.count("product_volume").alias("n_with_volume"),
        F.sum(F.round(F.col("product_density") * 100).cast("long")).alias("_d"),
        F.count("product_density").alias("_nd")) \
        .select("product_size_category", "n_products", "n_with_volume",
                half_up_ratio("_d", "_nd", 4, num_scale=2).alias("avg_density"))


@register("cln_order_lifecycle", compose(f"""
SELECT order_status, is_delivered, COUNT(*) AS n,
       {ratio('SUM(approval_time)', 'COUNT(approval_time)')} AS avg_approval_minutes,
       {ratio('SUM(delivery_days)', 'COUNT(delivery_days)')} AS avg_delivery_days,
       {ratio('SUM(delivery_delay_days)', 'COUNT(delivery_delay_days)')} AS avg_delay_days,
       COUNT(order_delivered_carrier_date) AS n_carrier
FROM s_orders GROUP BY order_status, is_delivered"""))
def cln_order_lifecycle(w):
    """CLN-7/8/17-19: repaired dates and derived durations, summarised by status."""
    o = w.silver["orders"]
    return o.groupBy("order_status", "is_delivered").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("approval_time").alias("_a"), F.count("approval_time").alias("_na"),
        F.sum("delivery_days").alias("_d"), F.count("delivery_days").alias("_nd"),
        F.sum("delivery_delay_days").alias("_l"), F.count("delivery_delay_days").alias("_nl"),
        F.count("order_delivered_carrier_date").alias("n_carrier")) \
        .select("order_status", "is_delivered", "n",
                half_up_ratio("_a", "_na").alias("avg_approval_minutes"),
                half_up_ratio("_d", "_nd").alias("avg_delivery_days"),
                half_up_ratio("_l", "_nl").alias("avg_delay_days"), "n_carrier")


# ================================================================ DQ
def _checks_sql(table: str, rules: list[tuple[str, str]], extra_cols: str = "") -> str:
    return _union_sql([
        f"SELECT {extra_cols}'{name}' AS rule, CAST(COUNT(*) AS BIGINT) AS n_rows, "
        f"CAST(COALESCE(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_bad FROM {table}"
        for name, cond in rules])


_REQUIRED = ["order_id", "customer_id", "order_status"] + ORDER_TS


@register("dq_nulls", compose(_checks_sql("b_orders",
                                          [(f"null:{c}", f"{c} IS NULL") for c in _REQUIRED])))
def dq_nulls(w):
    """DQ-3: NULL count per required column, one pass."""
    return Q.checks(w.bronze["orders"], Q.null_rules(_REQUIRED))


_UNTRIM_CUST = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]


@register("dq_untrimmed", compose(
    _checks_sql("b_customers", [(f"untrimmed:{c}", f"{c} <> trim({c})") for c in _UNTRIM_CUST],
                "'customers' AS table_name, ")
    + "\nUNION ALL\n"
    + _checks_sql("b_order_payments", [("untrimmed:payment_type", "payment_type <> trim(payment_type)")],
                  "'order_payments' AS table_name, ")))
def dq_untrimmed(w):
    """DQ-4: values with leading/trailing blanks."""
    a = Q.checks(w.bronze["customers"], Q.untrimmed_rules(_UNTRIM_CUST)) \
        .select(F.lit("customers").alias("table_name"), "*")
    b = Q.checks(w.bronze["order_payments"], Q.untrimmed_rules(["payment_type"])) \
        .select(F.lit("order_payments").alias("table_name"), "*")
    return a.unionByName(b)


@register("dq_duplicates", compose("""
SELECT order_id, order_item_id, COUNT(*) AS n FROM b_order_items
GROUP BY order_id, order_item_id HAVING COUNT(*) >= 2"""))
def dq_duplicates(w):
    """DQ-1/2: (order, line) keys that occur more than once."""
    return Q.duplicate_keys(w.bronze["order_items"], ["order_id", "order_item_id"])


@register("dq_domain", compose("""
SELECT 'order_status' AS column_name, order_status AS value, COUNT(*) AS n FROM b_orders
GROUP BY order_status
UNION ALL
SELECT 'payment_type', payment_type, COUNT(*) FROM b_order_payments GROUP BY payment_type
UNION ALL
SELECT 'geolocation_city', geolocation_city, COUNT(*) FROM s_geolocation GROUP BY geolocation_city"""))
def dq_domain(w):
    """DQ-5/6: low-cardinality domains (raw status and payment type, folded city)."""
    def dom(df, c):
        return Q.domain(df, c).select(F.lit(c).alias("column_name"), F.col(c).alias("value"), "n")
    return (dom(w.bronze["orders"], "order_status")
            .unionByName(dom(w.bronze["order_payments"], "payment_type"))
            .unionByName(dom(w.silver["geolocation"], "geolocation_city")))


_RANGES_SQL = [
    ("weight<0", "product_weight_g < 0"), ("length<=0", "product_length_cm <= 0"),
    ("height<=0", "product_height_cm <= 0"), ("width<=0", "product_width_cm <= 0"),
    ("name_length<0", "product_name_lenght < 0")]


@register("dq_range", compose(_checks_sql("b_products", _RANGES_SQL)))
def dq_range(w):
    """DQ-8: measures outside their valid range (the sentinel counts as negative)."""
    rules = [Q.range_rule("weight<0", "product_weight_g", lo=0),
             Q.range_rule("length<=0", "product_length_cm", lo=1),
             Q.range_rule("height<=0", "product_height_cm", lo=1),
             Q.range_rule("width<=0", "product_width_cm", lo=1),
             Q.range_rule("name_length<0", "product_name_lenght", lo=0)]
    return Q.checks(w.bronze["products"], rules)


_PAIRS = [("order_purchase_timestamp", "order_delivered_carrier_date"),
          ("order_approved_at", "order_delivered_carrier_date"),
          ("order_approved_at", "order_delivered_customer_date"),
          ("order_approved_at", "order_estimated_delivery_date"),
          ("order_delivered_carrier_date", "order_delivered_customer_date"),
          ("order_delivered_carrier_date", "order_estimated_delivery_date"),
          ("order_delivered_customer_date", "order_estimated_delivery_date")]


@register("dq_time_order", compose(
    _checks_sql("b_orders", [(f"{a}>{b}", f"{a} > {b}") for a, b in _PAIRS], "'bronze' AS layer, ")
    + "\nUNION ALL\n"
    + _checks_sql("s_orders", [(f"{a}>{b}", f"{a} > {b}") for a, b in _PAIRS], "'silver' AS layer, ")))
def dq_time_order(w):
    """DQ-9/13: each lifecycle-order violation counted, before and after the silver load."""
    a = Q.checks(w.bronze["orders"], Q.order_rules(_PAIRS)).select(F.lit("bronze").alias("layer"), "*")
    b = Q.checks(w.silver["orders"], Q.order_rules(_PAIRS)).select(F.lit("silver").alias("layer"), "*")
    return a.unionByName(b)


@register("dq_cardinality", compose("""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT customer_id) AS n_distinct_customer_id,
       COUNT(DISTINCT customer_unique_id) AS n_distinct_customer_unique_id FROM s_customers"""))
def dq_cardinality(w):
    """DQ-10: records vs distinct ids vs distinct persons."""
    return Q.key_cardinality(w.silver["customers"], ["customer_id", "customer_unique_id"])


@register("dq_fd", compose(f"""
SELECT geolocation_zip_code_prefix, COUNT(DISTINCT {fold('geolocation_city')}) AS city_cnt
FROM b_geolocation GROUP BY geolocation_zip_code_prefix
HAVING COUNT(DISTINCT {fold('geolocation_city')}) > 1"""))
def dq_fd(w):
    """DQ-11: zip prefixes mapped to more than one (folded) city."""
    return Q.fd_violations(w.bronze["geolocation"], "geolocation_zip_code_prefix",
                           fold_accents("geolocation_city"), "city_cnt")


@register("dq_fd_state", compose("""
SELECT geolocation_zip_code_prefix, len(list_distinct(list(geolocation_state))) AS state_cnt
FROM b_geolocation GROUP BY ALL HAVING state_cnt > 1"""))
def dq_fd_state(w):
    """DQ-11: zip prefixes mapped to more than one state."""
    return Q.fd_violations(w.bronze["geolocation"], "geolocation_zip_code_prefix", "geolocation_state", "state_cnt")


@register("dq_geo_range", compose(_checks_sql("b_geolocation", [
    ("lat", "abs(geolocation_lat) > 90"), ("lng", "abs(geolocation_lng) > 180")])))
def dq_geo_range(w):
    """DQ-8: coordinates off the globe."""
    return Q.checks(w.bronze["geolocation"], [Q.range_rule("lat", "geolocation_lat", lo=-90, hi=90),
                                              Q.range_rule("lng", "geolocation_lng", lo=-180, hi=180)])


_BRONZE_TABLES = ["customers", "geolocation", "order_items", "order_payments", "order_reviews", "orders", "products",
                  "sellers", "category_translation"]


def _copies_sql(layer: str, prefix: str, tables: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS n_rows, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {prefix}{t})) AS n_copies FROM {prefix}{t}" for t in tables)


def _copies(tables: dict, layer: str):
    """Rows and surplus full-row copies of each table, one aggregate over its distinct rows."""
    out = None
    for name in _BRONZE_TABLES:
        df = tables[name]
        part = df.groupBy(*df.columns).count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"),
                                                   F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_copies")) \
            .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows", "n_copies")
        out = part if out is None else out.unionByName(part)
    return out


@register("dq_full_row_duplicates", compose(_copies_sql("bronze", "b_", _BRONZE_TABLES) + "\nUNION ALL\n"
                                            + _copies_sql("silver", "s_", _BRONZE_TABLES)))
def dq_full_row_duplicates(w):
    """DQ-2/13: full-row copies of all nine tables, before and after the silver load."""
    return _copies(w.bronze, "bronze").unionByName(_copies(w.silver, "silver"))


_AMOUNT_RULES = [("order_items", "price<0", "price < 0"), ("order_items", "freight<0", "freight_value < 0"),
                 ("order_payments", "value<0", "payment_value < 0"), ("order_payments", "installments<0", "payment_installments < 0"),
                 ("order_payments", "sequential<0", "payment_sequential < 0"), ("order_reviews", "score", "review_score NOT BETWEEN 1 AND 5"),
                 ("order_reviews", "answered before", "review_answer_timestamp < review_creation_date"),
                 ("order_reviews", "no id", "review_id IS NULL"), ("customers", "untrimmed", "customer_city <> trim(customer_city)"),
                 ("products", "no category", "product_category_name IS NULL"), ("sellers", "zip", "seller_zip_code_prefix NOT BETWEEN '1000' AND '99999'")]


@register("dq_suite", compose("\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, '{t}' AS table_name, '{label}' AS rule, count_if({rule}) AS n_bad FROM {p}{t}"
    for layer, p in (("bronze", "b_"), ("silver", "s_")) for t, label, rule in _AMOUNT_RULES)))
def dq_suite(w):
    """DQ-7/8/13, FIL-12: the value rules of all tables, before and after the silver load;
    one aggregate per table and layer over its rules."""
    out = None
    for layer, tables in (("bronze", w.bronze), ("silver", w.silver)):
        for name in dict.fromkeys(t for t, _, _ in _AMOUNT_RULES):
            rules = [(label, rule) for t, label, rule in _AMOUNT_RULES if t == name]
            counted = tables[name].agg(F.array(*[F.struct(F.lit(label).alias("rule"), F.count_if(F.expr(rule)).alias("n_bad"))
                                                 for label, rule in rules]).alias("_r"))
            part = counted.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.inline("_r"))
            out = part if out is None else out.unionByName(part)
    return out


@register("dq_orphans", compose("""
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price
FROM s_order_items i WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = i.order_id)"""))
def dq_orphans(w):
    """DQ-12: silver items whose order did not survive the silver load (``left_anti``). Copies of a
    row share its order, so they are removed from the orphans only: the items move once."""
    return dedupe_rows(Q.orphans(S.valid_items(w.bronze["order_items"]), w.silver["orders"], "order_id")) \
        .select("order_id", "order_item_id", "product_id", "seller_id", "price")


_PROFILE_TYPES = {"order_id": "string", "customer_id": "string", "order_status": "string",
                  **{c: "timestamp_ntz" for c in ORDER_TS}}


@register("dq_profile", compose(_union_sql([
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null, "
    f"COUNT(*) - COUNT({c}) AS n_null FROM b_orders" for c, t in _PROFILE_TYPES.items()])))
def dq_profile(w):
    """DQ-14: type, non-null and null count per column, one pass."""
    return Q.profile(w.bronze["orders"])


# ================================================================ JN
@register("jn_preagg", compose("""
SELECT c.customer_id, COUNT(o.order_id) AS fanout_orders,
       COUNT(DISTINCT o.order_id) AS lifetime_orders,
       CAST(COALESCE(SUM(CAST(p.payment_value AS DECIMAL(18,2))), 0) AS DOUBLE) AS lifetime_value
FROM s_customers c LEFT JOIN s_orders o ON c.customer_id = o.customer_id
LEFT JOIN s_order_payments p ON o.order_id = p.order_id
GROUP BY c.customer_id"""))
def jn_preagg(w):
    """JN-3 vs JN-4: orders per customer counted correctly (pre-aggregated payments)
    and as the fan-out join counts them (one row per payment)."""
    s = w.silver
    pay = s["order_payments"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_np"), F.sum(F.col("payment_value").cast("decimal(18,2)")).alias("_v"))
    per_order = s["orders"].select("order_id", "customer_id").join(pay, "order_id", "left")
    agg = per_order.groupBy("customer_id").agg(
        F.sum(F.coalesce("_np", F.lit(1))).alias("fanout_orders"),
        F.count(F.lit(1)).alias("lifetime_orders"),
        F.sum("_v").alias("_v"))
    return (s["customers"].select("customer_id").join(agg, "customer_id", "left")
            .select("customer_id",
                    F.coalesce("fanout_orders", F.lit(0)).cast("long").alias("fanout_orders"),
                    F.coalesce("lifetime_orders", F.lit(0)).cast("long").alias("lifetime_orders"),
                    F.coalesce(F.col("_v"), F.lit(0)).cast("double").alias("lifetime_value")))


@register("jn_role_dates", compose("""
SELECT dp.year_num AS purchase_year, ds.year_num AS shipping_year, COUNT(*) AS n_items
FROM g_fact_order_items f JOIN g_dim_date dp ON f.purchase_date_sk = dp.date_sk
JOIN g_dim_date ds ON f.shipping_limit_date_sk = ds.date_sk
GROUP BY dp.year_num, ds.year_num"""))
def jn_role_dates(w):
    """JN-5: the date dimension in two roles (purchase, shipping limit)."""
    dd = w.dim_date
    p = F.broadcast(dd.select(F.col("date_sk").alias("_p"), F.col("year_num").alias("purchase_year")))
    s = F.broadcast(dd.select(F.col("date_sk").alias("_s"), F.col("year_num").alias("shipping_year")))
    return (w.plain_fact_items.join(p, F.col("purchase_date_sk") == F.col("_p"))
            .join(s, F.col("shipping_limit_date_sk") == F.col("_s"))
            .groupBy("purchase_year", "shipping_year").agg(F.count(F.lit(1)).alias("n_items")))


@register("jn_star", compose("""
SELECT p.product_category_name, s.seller_state, c.customer_segment, d.year_num,
       COUNT(*) AS n_items, CAST(SUM(f.total_item_value) AS DOUBLE) AS revenue
FROM g_fact_order_items f JOIN g_dim_product p ON f.product_sk = p.product_sk
JOIN g_dim_seller s ON f.seller_sk = s.seller_sk
JOIN g_dim_customer c ON f.customer_sk = c.customer_sk
JOIN g_dim_date d ON f.purchase_date_sk = d.date_sk
GROUP BY p.product_category_name, s.seller_state, c.customer_segment, d.year_num"""))
def jn_star(w):
    """JN-7: star query over the item fact and four dimensions."""
    f = w.plain_fact_items
    return (f.join(w.dim_product.select("product_sk", "product_category_name"), "product_sk")
            .join(w.keyed_sellers.select("seller_sk", "seller_state"), "seller_sk")
            .join(w.dim_customer.select("customer_sk", "customer_segment"), "customer_sk")
            .join(F.broadcast(w.dim_date.select(F.col("date_sk").alias("purchase_date_sk"), "year_num")),
                  "purchase_date_sk")
            .groupBy("product_category_name", "seller_state", "customer_segment", "year_num")
            .agg(F.count(F.lit(1)).alias("n_items"),
                 F.sum("total_item_value").cast("double").alias("revenue")))


# ================================================================ AGG
@register("agg_conditional_distinct", compose("""
SELECT fo.order_status, COUNT(*) AS n_orders, COUNT(DISTINCT fo.customer_sk) AS n_customers,
       COUNT(DISTINCT CASE WHEN dc.is_repeat_customer = 1 THEN fo.customer_sk END) AS n_repeat_customers
FROM g_fact_orders fo JOIN g_dim_customer dc ON fo.customer_sk = dc.customer_sk
GROUP BY fo.order_status"""))
def agg_conditional_distinct(w):
    """AG-2/3: distinct and conditional-distinct customers per status, two-level
    (customer first) so no ``Expand`` multiplies the rows."""
    base = w.fact_orders.select("order_status", "customer_sk") \
        .join(w.dim_customer.select("customer_sk", "is_repeat_customer"), "customer_sk")
    per = base.groupBy("order_status", "customer_sk").agg(
        F.count(F.lit(1)).alias("_n"), F.max("is_repeat_customer").alias("_r"))
    return per.groupBy("order_status").agg(
        F.sum("_n").alias("n_orders"), F.count(F.lit(1)).alias("n_customers"),
        F.sum(F.when(F.col("_r") == 1, 1).otherwise(0)).cast("long").alias("n_repeat_customers"))


@register("agg_rates", compose(f"""
SELECT payment_type, COUNT(*) AS n_payments,
       {ratio('SUM(payment_installments)', 'COUNT(payment_installments)')} AS avg_installments,
       {ratio('SUM(CASE WHEN payment_installments > 1 THEN 1 ELSE 0 END)', 'COUNT(*)', 2, 100)}
         AS pct_installments,
       CAST(SUM(CAST(payment_value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
       {ratio(cents('SUM(CAST(payment_value AS DECIMAL(18,2)))'), 'COUNT(payment_value)', 2, 1, 2)}
         AS avg_value
FROM s_order_payments GROUP BY payment_type"""))
def agg_rates(w):
    """AG-4/5/6/14: sums, conditional sums, means and a percentage per payment type."""
    p = w.silver["order_payments"]
    g = p.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("n_payments"),
        F.sum("payment_installments").alias("_i"), F.count("payment_installments").alias("_ni"),
        F.sum(F.when(F.col("payment_installments") > 1, 1).otherwise(0)).alias("_m"),
        F.sum(F.col("payment_value").cast("decimal(18,2)")).alias("_v"),
        F.count("payment_value").alias("_nv"))
    return g.select("payment_type", "n_payments",
                    half_up_ratio("_i", "_ni").alias("avg_installments"),
                    half_up_ratio("_m", "n_payments", 2, mult=100).alias("pct_installments"),
                    F.col("_v").cast("double").alias("total_value"),
                    half_up_ratio(unscaled(F.col("_v")), "_nv", 2, num_scale=2).alias("avg_value"))


@register("agg_int_avg", compose(f"""
SELECT CAST(SUM(recency_days) // COUNT(recency_days) AS INTEGER) AS avg_recency_days,
       CAST(SUM(frequency_orders) // COUNT(frequency_orders) AS INTEGER) AS avg_frequency_orders,
       {ratio(cents('SUM(monetary_value)'), 'COUNT(monetary_value)', 6, 1, 2)} AS avg_monetary_value
FROM m_customer_rfm"""))
def agg_int_avg(w):
    """AG-7 / QRY-6: mean RFM; an integer mean truncates (recency, frequency are
    non-negative here, so truncation is the floor)."""
    r = w.customer_rfm
    g = r.agg(F.sum("recency_days").alias("_r"), F.count("recency_days").alias("_nr"),
              F.sum("frequency_orders").alias("_f"), F.count("frequency_orders").alias("_nf"),
              F.sum("monetary_value").alias("_m"), F.count("monetary_value").alias("_nm"))
    div = lambda a, b: F.call_function("div", F.col(a), F.col(b))
    return g.select(div("_r", "_nr").cast("int").alias("avg_recency_days"),
                    div("_f", "_nf").cast("int").alias("avg_frequency_orders"),
                    half_up_ratio(unscaled(F.col("_m")), "_nm", 6, num_scale=2)
                    .alias("avg_monetary_value"))


def _retention_months(w) -> list[int]:
    """Columns of the retention matrix: every month offset the calendar allows."""
    from datetime import date
    s, e = date.fromisoformat(w.gp.cal_start), date.fromisoformat(w.gp.cal_end)
    return list(range((e.year * 12 + e.month) - (s.year * 12 + s.month) + 1))


_PIVOT_MONTHS = list(range(84))  # binding calendar 1995-01 .. 2001-12


@register("agg_pivot", compose(
    "SELECT cohort_month, "
    + ", ".join(f"MAX(CASE WHEN retention_month = {m} THEN retention_rate END) AS m{m}"
                for m in _PIVOT_MONTHS)
    + " FROM m_cohort_retention GROUP BY cohort_month"))
def agg_pivot(w):
    """AG-18 / AN-4: cohort x months-since retention matrix (explicit columns)."""
    return ST.pivot_counts(w.cohort_retention, "cohort_month", "retention_month",
                           _retention_months(w), F.col("retention_rate"))


_CORR_COLS = ["total_orders", "delivered_orders", "delayed_orders", "avg_delivery_days",
              "avg_estimated_gap_days", "delay_rate", "avg_freight_value", "avg_review_score"]


def _corr_sql() -> str:
    from itertools import combinations
    parts = []
    for a, b in combinations(_CORR_COLS, 2):
        expr = f"floor(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) * 1000000000.0 + 0.5) / 1000000000.0"
        parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {expr} AS corr FROM m_delivery_performance")
        parts.append(f"SELECT '{b}', '{a}', {expr} FROM m_delivery_performance")
    for c in _CORR_COLS:
        parts.append(f"SELECT '{c}', '{c}', CAST(1.0 AS DOUBLE)")
    return _union_sql(parts)


@register("agg_corr", compose(_corr_sql()))
def agg_corr(w):
    """AG-19 / AN-7: correlation matrix of the delivery mart (9 decimals)."""
    return ST.correlation_matrix(w.delivery_performance, _CORR_COLS)


@register("agg_histogram", compose("""
WITH v AS (SELECT CAST(lifetime_value * 100 AS BIGINT) AS u FROM g_dim_customer),
     mm AS (SELECT min(u) AS lo, max(u) AS hi FROM v)
SELECT CAST(b AS INTEGER) AS bin,
       (lo + CAST((b - 1) * (hi - lo) AS DOUBLE) / 50) / 100.0 AS bin_low,
       (lo + CAST(b * (hi - lo) AS DOUBLE) / 50) / 100.0 AS bin_high, COUNT(*) AS n
FROM (SELECT least(50, (u - lo) * 50 // greatest(hi - lo, 1) + 1) AS b, lo, hi FROM v, mm) t
GROUP BY b, lo, hi"""))
def agg_histogram(w):
    """AG-20 / AN-3: 50 equal-width bins of customer lifetime value."""
    return ST.equal_width_histogram(w.dim_customer, "lifetime_value", 50)


@register("agg_revenue_histogram", compose("""
WITH cents AS (SELECT CAST(CAST(total_revenue AS DECIMAL(18,2)) * 100 AS BIGINT) AS u FROM m_seller_performance),
placed AS (SELECT least(100, 1 + (u - min(u) OVER ()) * 100 // greatest(1, max(u) OVER () - min(u) OVER ())) AS bin,
                  min(u) OVER () AS low, max(u) OVER () - min(u) OVER () AS span FROM cents)
SELECT bin::INTEGER AS bin, (low + ((bin - 1) * span)::DOUBLE / 100) / 100.0 AS bin_low,
       (low + (bin * span)::DOUBLE / 100) / 100.0 AS bin_high, count(*) AS n
FROM placed GROUP BY bin, low, span"""))
def agg_revenue_histogram(w):
    """AN-3: 100 equal-width bins of seller revenue."""
    revenue = w.seller_performance.select(F.col("total_revenue").cast("decimal(18,2)").alias("total_revenue"))
    return ST.equal_width_histogram(revenue, "total_revenue", 100)


@register("agg_value_counts", compose("""
SELECT customer_segment, COUNT(*) AS n FROM g_dim_customer GROUP BY customer_segment"""))
def agg_value_counts(w):
    """AG-16: customer segment frequencies."""
    return ST.value_counts(w.dim_customer, "customer_segment")


# ================================================================ WN
@register("win_surrogate_key", compose("""
SELECT order_id, order_item_id, product_id, seller_id, price,
       ROW_NUMBER() OVER (ORDER BY order_id, order_item_id, product_id, seller_id,
                          shipping_limit_date, price, freight_value) AS rn
FROM s_order_items"""))
def win_surrogate_key(w):
    """WN-3: global row number by the item tuple: places in sorted partitions plus the counts before."""
    order = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
    out = global_row_number(w.silver["order_items"].select(*order), order)
    return out.select("order_id", "order_item_id", "product_id", "seller_id", "price", "rn")


@register("win_ntile", compose("""
SELECT order_sk, CAST(total_payment_amount AS DOUBLE) AS total_payment_amount,
       CAST(NTILE(10) OVER (ORDER BY total_payment_amount, order_sk) AS INTEGER) AS decile
FROM g_fact_orders"""))
def win_ntile(w):
    """WN-4: global NTILE(10) of order value (tie-break: order key) by exact cuts, no rank."""
    f = w.fact_orders.select("order_sk", "total_payment_amount")
    return global_ntile(f, 10, ["total_payment_amount", "order_sk"], "decile")


def _monthly_category_sales(w):
    f = w.plain_fact_items.select("product_sk", "purchase_date_sk", "total_item_value")
    return (f.join(w.dim_product.select("product_sk", "product_category_name"), "product_sk")
            .join(F.broadcast(w.dim_date.select(F.col("date_sk").alias("purchase_date_sk"), "full_date")),
                  "purchase_date_sk")
            .groupBy("product_category_name", D.month_start("full_date").alias("month"))
            .agg(F.sum("total_item_value").alias("sales")))


_SALES_BASE = """
SELECT p.product_category_name, {period} AS {pname}, SUM(f.total_item_value) AS sales
FROM g_fact_order_items f JOIN g_dim_product p ON f.product_sk = p.product_sk
JOIN g_dim_date d ON f.purchase_date_sk = d.date_sk
GROUP BY p.product_category_name, {period}"""


WIN_LAG_SQL = f"""
SELECT product_category_name, month, CAST(sales AS DOUBLE) AS sales,
       CAST(sales_lag1 AS DOUBLE) AS sales_lag1, CAST(sales_lag2 AS DOUBLE) AS sales_lag2,
       CAST(sales_lag3 AS DOUBLE) AS sales_lag3
FROM (SELECT *, LAG(sales, 1) OVER w AS sales_lag1, LAG(sales, 2) OVER w AS sales_lag2,
             LAG(sales, 3) OVER w AS sales_lag3
      FROM ({_SALES_BASE.format(period="CAST(date_trunc('month', d.full_date) AS DATE)", pname="month")}) s
      WINDOW w AS (PARTITION BY product_category_name ORDER BY month)) t
WHERE sales_lag1 IS NOT NULL AND sales_lag2 IS NOT NULL AND sales_lag3 IS NOT NULL"""


@register("win_lag", compose(WIN_LAG_SQL))
def win_lag(w):
    """WN-6 / AN-10: monthly category sales with row lags 1..3, rows with a
    missing lag dropped (per category, not one chosen category)."""
    s = add_lags(_monthly_category_sales(w), "product_category_name", "month", "sales", [1, 2, 3])
    return s.na.drop(subset=["sales_lag1", "sales_lag2", "sales_lag3"])


@register("win_rolling", compose(f"""
SELECT product_category_name, day, CAST(sales AS DOUBLE) AS sales,
       CAST(sales_lag1 AS DOUBLE) AS sales_lag1, CAST(sales_lag7 AS DOUBLE) AS sales_lag7,
       CAST(sales_lag14 AS DOUBLE) AS sales_lag14,
       CASE WHEN n7 = 7 THEN CAST(s7 AS DOUBLE) / 7 END AS sales_roll7,
       CASE WHEN n14 = 14 THEN CAST(s14 AS DOUBLE) / 14 END AS sales_roll14,
       CAST(isodow(day) - 1 AS INTEGER) AS weekday, CAST(month(day) AS INTEGER) AS month
FROM (SELECT *, LAG(sales, 1) OVER w AS sales_lag1, LAG(sales, 7) OVER w AS sales_lag7,
             LAG(sales, 14) OVER w AS sales_lag14,
             SUM(sales) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS s7,
             COUNT(sales) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n7,
             SUM(sales) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS s14,
             COUNT(sales) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS n14
      FROM ({_SALES_BASE.format(period="d.full_date", pname="day")}) s
      WINDOW w AS (PARTITION BY product_category_name ORDER BY day)) t
WHERE sales_lag1 IS NOT NULL AND sales_lag7 IS NOT NULL AND sales_lag14 IS NOT NULL
  AND n7 = 7 AND n14 = 14"""))
def win_rolling(w):
    """WN-7 / AN-11: daily category sales with lags 1/7/14, rolling 7/14 means
    (current row included, NULL until full), weekday (Mon=0) and month."""
    f = w.plain_fact_items.select("product_sk", "purchase_date_sk", "total_item_value")
    daily = (f.join(w.dim_product.select("product_sk", "product_category_name"), "product_sk")
             .join(F.broadcast(w.dim_date.select(F.col("date_sk").alias("purchase_date_sk"),
                                                 F.col("full_date").alias("day"))), "purchase_date_sk")
             .groupBy("product_category_name", "day").agg(F.sum("total_item_value").alias("sales")))
    s = series_features(daily, "product_category_name", "day", "sales", lags=[1, 7, 14], rolling=[7, 14])
    s = s.withColumn("weekday", D.weekday_mon0("day")).withColumn("month", F.month("day"))
    return s.na.drop().select(
        "product_category_name", "day", *[F.col(c).cast("double").alias(c) for c in
                                          ("sales", "sales_lag1", "sales_lag7", "sales_lag14",
                                           "sales_roll7", "sales_roll14")],
        "weekday", "month")


@register("win_mode", compose("""
SELECT DISTINCT ON (customer_sk) customer_sk, product_category_name AS favorite_category, purchase_cnt
FROM (SELECT customer_sk, product_category_name, count(*) AS purchase_cnt FROM g_item_order_base GROUP BY ALL)
ORDER BY customer_sk, purchase_cnt DESC, product_category_name"""))
def win_mode(w):
    """WN-5: favourite category per customer (ties: smallest name)."""
    return favorite_category(w.plain_fact_items, w.fact_orders, w.dim_product, base=w.plain_item_base)


@register("win_first_purchase", compose("""
SELECT fo.order_id, fo.customer_sk,
       MIN(dd.full_date) OVER (PARTITION BY fo.customer_sk) AS first_purchase_date
FROM g_fact_orders fo JOIN g_dim_date dd ON fo.purchase_date_sk = dd.date_sk"""))
def win_first_purchase(w):
    """WN-8 / JN-8: each order with its customer's first purchase date. The first
    date is a per-customer aggregate (combined map-side) joined back with an inner
    join — a customer holding a third of all orders is split by AQE's skew join
    instead of filling one window task."""
    f = w.fact_orders.select("order_id", "customer_sk", "purchase_date_sk") \
        .join(F.broadcast(w.dim_date.select(F.col("date_sk").alias("purchase_date_sk"), "full_date")),
              "purchase_date_sk")
    firsts = f.groupBy("customer_sk").agg(F.min("full_date").alias("first_purchase_date"))
    return f.select("order_id", "customer_sk").join(firsts, "customer_sk")

