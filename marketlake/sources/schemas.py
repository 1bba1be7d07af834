"""Explicit schemas for the bronze inputs and the silver/gold outputs.

Bronze column names keep the source spelling (``product_name_lenght``);
silver and gold use the corrected spelling.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS, DT = T.TimestampNTZType(), T.DateType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


BRONZE = {
    "customers": _schema(("customer_id", S), ("customer_unique_id", S),
                         ("customer_zip_code_prefix", S), ("customer_city", S),
                         ("customer_state", S)),
    "geolocation": _schema(("geolocation_zip_code_prefix", S), ("geolocation_lat", D),
                           ("geolocation_lng", D), ("geolocation_city", S),
                           ("geolocation_state", S)),
    "order_items": _schema(("order_id", S), ("order_item_id", I), ("product_id", S),
                           ("seller_id", S), ("shipping_limit_date", TS), ("price", D),
                           ("freight_value", D)),
    "order_payments": _schema(("order_id", S), ("payment_sequential", I),
                              ("payment_type", S), ("payment_installments", I),
                              ("payment_value", D)),
    "order_reviews": _schema(("review_id", S), ("order_id", S), ("review_score", D),
                             ("review_comment_title", S), ("review_comment_message", S),
                             ("review_creation_date", TS), ("review_answer_timestamp", TS)),
    "orders": _schema(("order_id", S), ("customer_id", S), ("order_status", S),
                      ("order_purchase_timestamp", TS), ("order_approved_at", TS),
                      ("order_delivered_carrier_date", TS),
                      ("order_delivered_customer_date", TS),
                      ("order_estimated_delivery_date", TS)),
    "products": _schema(("product_id", S), ("product_category_name", S),
                        ("product_name_lenght", L), ("product_description_lenght", L),
                        ("product_photos_qty", L), ("product_weight_g", L),
                        ("product_length_cm", L), ("product_height_cm", L),
                        ("product_width_cm", L)),
    "sellers": _schema(("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S),
                       ("seller_state", S)),
    "category_translation": _schema(("product_category_name", S),
                                    ("product_category_name_english", S)),
}

# Golden export layouts (tab separated, header; trailing load timestamp ignored).
EXPORTS = {
    "cohort_retention": _schema(("cohort_month", DT), ("retention_month", I),
                                ("retained_customers", I), ("cohort_size", I),
                                ("retention_rate", D), ("dwh_create_date", S)),
    "monthly_business_summary": _schema(("year_month", S), ("total_orders", I),
                                        ("total_customers", I), ("repeat_customers", I),
                                        ("total_gmv", D), ("avg_order_value", D),
                                        ("avg_review_score", D), ("delay_rate", D),
                                        ("dwh_create_date", S)),
    "category_dashboard_mart": _schema(("product_category_name", S), ("total_products", I),
                                       ("total_orders", I), ("total_revenue", D),
                                       ("avg_review_score", D), ("avg_delay_rate", D),
                                       ("avg_freight_ratio", D), ("dwh_create_date", S)),
}
