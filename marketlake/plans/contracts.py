"""Load contracts of the silver, gold and mart tables (SRC-8): declared columns, required ones,
value rules and the keys that a load checks. Keys that a load makes unique itself (surrogate keys,
groups) are not checked again."""

from __future__ import annotations

from marketlake.sources.contracts import Contract, _table

_RATE = "BETWEEN 0 AND 100"
_ORDER_DATES = ("order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
                "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
_KPIS = ("total_orders bigint, total_customers bigint, repeat_customers bigint, total_gmv double, avg_order_value double, "
         "avg_review_score double, delay_rate double")
_KPI_RULES = {"orders": "total_orders >= total_customers", "repeat": "repeat_customers BETWEEN 0 AND total_customers", "delay": f"delay_rate {_RATE}"}
_MONEY = {"price": "item_price >= 0", "freight": "freight_value >= 0", "total": "total_item_value = item_price + freight_value"}
_LINE = ("order_item_sk bigint, order_id string, order_item_id int, order_sk bigint, customer_sk bigint, product_sk bigint, seller_sk bigint, "
         "purchase_date_sk int, shipping_limit_date_sk int, item_price decimal(18,2), freight_value decimal(18,2), total_item_value decimal(18,2), "
         "is_freight_free int, high_value_item_flag int")

CONTRACTS: dict[str, Contract] = {
    # a person's record per customer_id: repeats would fan out the order fact
    "silver/customers": _table("customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
                               "customer_id customer_unique_id", {"trimmed": "customer_city = trim(customer_city)", "state": "customer_state = upper(customer_state)"}, "customer_id"),
    "silver/geolocation": _table("geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
                                 "geolocation_zip_code_prefix", {"latitude": "geolocation_lat BETWEEN -90 AND 90", "longitude": "geolocation_lng BETWEEN -180 AND 180"}),
    "silver/order_items": _table("order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp_ntz, price double, "
                                 "freight_value double, total_item_value double", "order_id order_item_id product_id seller_id",
                                 {"price": "price >= 0", "freight": "freight_value >= 0"}),
    "silver/order_payments": _table("order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
                                    "order_id payment_type", {"value": "payment_value >= 0", "installments": "payment_installments >= 0", "sequence": "payment_sequential >= 0"}),
    "silver/order_reviews": _table("review_id string, order_id string, review_score double, review_comment_title string, review_comment_message string, "
                                   "review_comment_message_length int, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz",
                                   "review_id order_id", {"score": "review_score BETWEEN 1 AND 5", "answered": "review_answer_timestamp >= review_creation_date"}),
    "silver/orders": _table(f"order_id string, customer_id string, order_status string, {_ORDER_DATES}, is_delivered int, approval_time int, delivery_days int, "
                            "delivery_delay_days int", "order_id customer_id",
                            {"flag": "is_delivered IN (0, 1)", "undelivered": "order_delivered_customer_date IS NULL OR order_status = 'delivered'"}),
    "silver/products": _table("product_id string, product_category_name string, product_name_length bigint, product_description_length bigint, product_photos_qty bigint, "
                              "product_weight_g bigint, product_length_cm bigint, product_height_cm bigint, product_width_cm bigint, product_volume bigint, "
                              "product_density double, product_size_category string", "product_id product_category_name product_size_category",
                              {"size": "product_size_category IN ('small', 'medium', 'large')", "length": "product_length_cm > 0", "weight": "product_weight_g >= 0"}),
    "silver/sellers": _table("seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string", "seller_id",
                             {"zip": "seller_zip_code_prefix BETWEEN '1000' AND '99999'"}),
    "silver/category_translation": _table("product_category_name string, product_category_name_english string", "product_category_name",
                                          {"folded": "product_category_name = lower(product_category_name)"}),
    "gold/dim_customer": _table("customer_sk bigint, customer_unique_id string, customer_city string, customer_state string, first_order_date date, last_order_date date, "
                                "lifetime_orders bigint, lifetime_value decimal(18,2), avg_order_value decimal(18,2), is_repeat_customer int, customer_segment string",
                                "customer_sk customer_unique_id lifetime_orders customer_segment",
                                {"dates": "last_order_date >= first_order_date", "orders": "lifetime_orders >= 1", "repeat": "is_repeat_customer IN (0, 1)"}),
    "gold/dim_date": _table("date_sk int, full_date date, year_num int, quarter_num int, month_num int, month_name string, day_num int, day_name string, week_num int, "
                            "is_weekend int", "date_sk full_date", {"quarter": "quarter_num BETWEEN 1 AND 4", "week": "week_num BETWEEN 1 AND 54"}),
    "gold/dim_product": _table("product_sk bigint, product_id string, product_category_name string, product_category_english string, product_name_length int, "
                               "product_description_length int, product_photos_qty int, product_weight_g int, product_length_cm int, product_height_cm int, "
                               "product_width_cm int, product_volume_cm3 int, product_density double, product_size_category string", "product_sk product_id"),
    "gold/dim_seller": _table("seller_sk bigint, seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string, first_sale_date date, "
                              "last_sale_date date, total_orders bigint, total_items_sold bigint, total_sales_amount decimal(18,2), avg_item_price decimal(18,2), is_top_seller int",
                              "seller_sk seller_id", {"items": "total_items_sold >= total_orders", "dates": "last_sale_date >= first_sale_date"}),
    "gold/order_keys": _table("order_id string, customer_sk bigint, purchase_date_sk int, order_sk bigint", "order_id customer_sk purchase_date_sk order_sk"),
    "gold/fact_orders": _table("order_sk bigint, order_id string, customer_sk bigint, purchase_date_sk int, order_status string, total_items bigint, "
                               "total_item_amount decimal(18,2), total_freight_amount decimal(18,2), total_payment_amount decimal(18,2), avg_review_score double, "
                               "is_delivered int, delivery_days int, estimated_delivery_days int, is_delayed int, delivery_delay_days int, approval_minutes int, approval_days int",
                               "order_sk order_id customer_sk purchase_date_sk total_items total_payment_amount avg_review_score is_delayed",
                               {"review": "avg_review_score BETWEEN 0 AND 5", "delayed": "is_delayed IN (0, 1)"}),
    "gold/fact_order_items": _table(_LINE, "order_item_sk order_sk customer_sk product_sk seller_sk purchase_date_sk shipping_limit_date_sk", _MONEY),
    "gold/item_order_base": _table(f"{_LINE}, order_status string, avg_review_score double, delivery_days int, is_delayed int, estimated_delivery_days int, "
                                   "is_repeat_customer int, product_category_name string", "order_item_sk order_sk customer_sk product_sk seller_sk", _MONEY),
    "marts/customer_rfm": _table("customer_sk bigint, recency_days int, frequency_orders bigint, monetary_value decimal(18,2), r_score int, f_score int, m_score int, "
                                 "rfm_score string, rfm_segment string", "customer_sk r_score f_score m_score rfm_segment",
                                 {"recency": "recency_days >= 0", "scores": "least(r_score, f_score, m_score) >= 1 AND greatest(r_score, f_score, m_score) <= 5"}),
    "marts/cohort_retention": _table("cohort_month date, retention_month int, retained_customers bigint, cohort_size bigint, retention_rate double",
                                     "cohort_month retention_month", {"size": "retained_customers <= cohort_size", "rate": f"retention_rate {_RATE}"}),
    "marts/seller_performance_mart": _table("seller_sk bigint, total_orders bigint, total_items_sold bigint, total_revenue double, avg_order_value double, "
                                            "avg_item_price double, avg_review_score double, avg_delivery_days double, delay_rate double, repeat_customer_rate double, "
                                            "seller_segment string", "seller_sk seller_segment", {"delay": f"delay_rate {_RATE}", "repeat": f"repeat_customer_rate {_RATE}"}),
    "marts/product_sales_mart": _table("product_sk bigint, product_category_name string, total_orders bigint, total_quantity_sold bigint, total_revenue double, "
                                       "avg_selling_price double, avg_freight_value double, freight_ratio double, avg_review_score double, avg_delivery_days double, "
                                       "delay_rate double, product_segment string", "product_sk product_segment", {"delay": f"delay_rate {_RATE}", "revenue": "total_revenue >= 0"}),
    "marts/delivery_performance_mart": _table("seller_sk bigint, total_orders bigint, delivered_orders bigint, delayed_orders bigint, avg_delivery_days double, "
                                              "avg_estimated_gap_days double, delay_rate double, avg_freight_value double, avg_review_score double, delivery_segment string",
                                              "seller_sk delivery_segment", {"delay": f"delay_rate {_RATE}"}),
    "marts/executive_kpi_mart": _table(f"date_sk int, full_date date, {_KPIS}", "date_sk full_date total_orders", _KPI_RULES),
    "marts/monthly_business_summary": _table(f"year_month string, {_KPIS}", "year_month total_orders", _KPI_RULES),
    "marts/category_dashboard_mart": _table("product_category_name string, total_products bigint, total_orders bigint, total_revenue double, avg_review_score double, "
                                            "avg_delay_rate double, avg_freight_ratio double", "total_products", {"delay": f"avg_delay_rate {_RATE}"}),
    "marts/customer_360_mart": _table("customer_sk bigint, lifetime_orders bigint, lifetime_value double, avg_order_value double, avg_review_score double, "
                                      "avg_delivery_days double, favorite_category string, rfm_segment string, customer_segment string", "customer_sk",
                                      {"orders": "lifetime_orders >= 1"}),
}
