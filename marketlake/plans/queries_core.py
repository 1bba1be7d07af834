"""Registered queries: silver tables, gold star schema and marts."""

from __future__ import annotations

from marketlake.plans.registry import register
from sqlcheck.fragments import compose


# decimal (money) columns per CTE; the oracle returns them as DOUBLE like to_output()
DECIMALS = {
    "g_dim_customer": ["lifetime_value", "avg_order_value"],
    "g_fact_orders": ["total_item_amount", "total_freight_amount", "total_payment_amount"],
    "g_dim_seller": ["total_sales_amount", "avg_item_price"],
    "g_fact_order_items": ["item_price", "freight_value", "total_item_value"],
    "m_customer_rfm": ["monetary_value"],
    "g_item_order_base": ["item_price", "freight_value", "total_item_value"],
}


def _all(cte_name: str) -> str:
    dec = DECIMALS.get(cte_name)
    if dec:
        rep = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in dec)
        return compose(f"SELECT * REPLACE ({rep}) FROM {cte_name}")
    return compose(f"SELECT * FROM {cte_name}")


# ---------------------------------------------------------------- silver (SIL-1..9)
for _t in ("customers", "geolocation", "order_items", "order_payments", "order_reviews",
           "orders", "products", "sellers", "category_translation"):
    def _make(t):
        @register(f"sil_{t}", _all(f"s_{t}"))
        def _q(w):
            return w.silver[t]
        _q.__doc__ = f"Silver {t} table."
    _make(_t)


# ---------------------------------------------------------------- gold (GLD-1..6)
@register("gld_dim_date", _all("g_dim_date"))
def gld_dim_date(w):
    return w.dim_date


@register("gld_dim_customer", _all("g_dim_customer"))
def gld_dim_customer(w):
    return w.dim_customer


@register("gld_fact_orders", _all("g_fact_orders"))
def gld_fact_orders(w):
    return w.fact_orders


@register("gld_dim_product", _all("g_dim_product"))
def gld_dim_product(w):
    return w.dim_product


@register("gld_dim_seller", _all("g_dim_seller"))
def gld_dim_seller(w):
    return w.dim_seller


@register("gld_fact_order_items", _all("g_fact_order_items"))
def gld_fact_order_items(w):
    return w.fact_order_items


@register("gld_item_order_base", _all("g_item_order_base"))
def gld_item_order_base(w):
    """Shared item-grain base of the item-level marts (items + order columns +
    repeat flag + category)."""
    return w.item_base


# ---------------------------------------------------------------- marts (MRT-1..9)
@register("mrt_customer_rfm", _all("m_customer_rfm"))
def mrt_customer_rfm(w):
    return w.customer_rfm


@register("mrt_cohort_retention", _all("m_cohort_retention"))
def mrt_cohort_retention(w):
    return w.cohort_retention


@register("mrt_seller_performance", _all("m_seller_performance"))
def mrt_seller_performance(w):
    return w.seller_performance


@register("mrt_product_sales", _all("m_product_sales"))
def mrt_product_sales(w):
    return w.product_sales


@register("mrt_delivery_performance", _all("m_delivery_performance"))
def mrt_delivery_performance(w):
    return w.delivery_performance


@register("mrt_executive_kpi", _all("m_executive_kpi"))
def mrt_executive_kpi(w):
    return w.executive_kpi


@register("mrt_monthly_business_summary", _all("m_monthly_business_summary"))
def mrt_monthly_business_summary(w):
    return w.monthly_business_summary


@register("mrt_category_dashboard", _all("m_category_dashboard"))
def mrt_category_dashboard(w):
    return w.category_dashboard


@register("mrt_customer_360", _all("m_customer_360"))
def mrt_customer_360(w):
    return w.customer_360
