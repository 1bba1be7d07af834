"""Registered source/sink queries (SRC-1/2/10/12) and the remaining filter and
quality families (FIL-9, DQ-7)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketlake.operators import quality as Q
from marketlake.plans import silver as S
from marketlake.plans.registry import register
from marketlake.plans.warehouse import Warehouse
from marketlake.session import ensure_checkpoint_dir
from marketlake.sources import schemas as SC
from marketlake.sources.calendar import calendar_covering, date_columns
from marketlake.sources.files import read_csv, read_tsv, write_tsv
from sqlcheck.fragments import DATE_COLS, compose


def _export_dir(w, name: str) -> str:
    """A fresh folder under the cluster's checkpoint directory (shared storage)."""
    return f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/exports-{uuid.uuid4().hex[:8]}/{name}"


@register("src_calendar", compose(f"""
SELECT {DATE_COLS}
FROM (SELECT CAST(unnest(generate_series(CAST(min(order_purchase_timestamp) AS DATE),
                                         CAST(max(order_purchase_timestamp) AS DATE),
                                         INTERVAL 1 DAY)) AS DATE) AS dt
      FROM b_orders) c"""))
def src_calendar(w):
    """SRC-12: one row per day spanning the orders' purchase dates, with the
    date-dimension attributes (generated from one aggregate row)."""
    return date_columns(calendar_covering(w.bronze["orders"], "order_purchase_timestamp"))


_MONTHLY_SCHEMA = ("year_month string, total_orders int, total_customers int, "
                   "repeat_customers int, total_gmv double, avg_order_value double, "
                   "avg_review_score double, delay_rate double")


@register("src_tsv_roundtrip", compose("SELECT * FROM m_monthly_business_summary"))
def src_tsv_roundtrip(w):
    """SRC-2/10: the monthly mart exported as TSV with header and read back
    (the exported files are written by the executors, not the driver)."""
    from pyspark.sql.types import _parse_datatype_string
    path = _export_dir(w, "monthly_business_summary")
    out = w.monthly_business_summary
    write_tsv(out, path)
    return read_tsv(w.spark, path, _parse_datatype_string(_MONTHLY_SCHEMA))


@register("src_csv_roundtrip", compose("SELECT * FROM s_customers"))
def src_csv_roundtrip(w):
    """SRC-1/3/4: silver customers written as comma CSV and scanned back with the
    bronze schema (zip prefixes stay text, headers are normalised)."""
    path = _export_dir(w, "customers")
    (w.silver["customers"].write.mode("overwrite").option("header", True)
     .option("escape", '"').csv(path))
    return read_csv(w.spark, path, SC.BRONZE["customers"])


@register("src_csv_to_mart", compose("SELECT * FROM m_monthly_business_summary"))
def src_csv_to_mart(w):
    """SRC-13: the nine sources written as CSV files, read back by header name, and built into
    silver, gold and the monthly mart."""
    tables = {}
    for name, schema in SC.BRONZE.items():
        path = _export_dir(w, name)
        # written in reverse column order: the reader goes by name
        df = w.bronze[name]
        df.select(*reversed(df.columns)).write.option("header", True).option("escape", '"') \
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("ignoreLeadingWhiteSpace", False) \
            .option("ignoreTrailingWhiteSpace", False).csv(path)
        tables[name] = read_csv(w.spark, path, schema)
    built = Warehouse(w.spark, w.sf_dir, w.gp, w.mp)
    built.bronze = tables
    return built.monthly_business_summary


@register("fil_date_bounds", compose("""
SELECT review_id, review_creation_date, review_answer_timestamp FROM b_order_reviews
WHERE review_creation_date > TIMESTAMP '2030-01-01 00:00:00'
   OR review_creation_date < TIMESTAMP '2000-01-01 00:00:00'
   OR review_answer_timestamp > TIMESTAMP '2030-01-01 00:00:00'
   OR review_answer_timestamp < TIMESTAMP '2000-01-01 00:00:00'"""))
def fil_date_bounds(w):
    """FIL-9: review dates outside the literal plausibility window."""
    lo = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")
    c, a = F.col("review_creation_date"), F.col("review_answer_timestamp")
    return w.bronze["order_reviews"].filter((c > hi) | (c < lo) | (a > hi) | (a < lo)) \
        .select("review_id", "review_creation_date", "review_answer_timestamp")


_PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]


@register("dq_domain_violation", compose(f"""
SELECT 'order_status' AS rule, COUNT(*) AS n_rows,
       CAST(SUM(CASE WHEN order_status NOT IN ({", ".join(f"'{x}'" for x in S.ORDER_STATUSES)})
                     THEN 1 ELSE 0 END) AS BIGINT) AS n_bad FROM b_orders
UNION ALL
SELECT 'payment_type', COUNT(*),
       CAST(SUM(CASE WHEN payment_type NOT IN ({", ".join(f"'{x}'" for x in _PAYMENT_TYPES)})
                     THEN 1 ELSE 0 END) AS BIGINT) FROM s_order_payments
UNION ALL
SELECT 'product_size_category', COUNT(*),
       CAST(SUM(CASE WHEN product_size_category NOT IN ('small', 'medium', 'large')
                     THEN 1 ELSE 0 END) AS BIGINT) FROM s_products"""))
def dq_domain_violation(w):
    """DQ-7: values outside their allowed set, per column."""
    a = Q.checks(w.bronze["orders"], [Q.domain_rule("order_status", "order_status",
                                                    list(S.ORDER_STATUSES))])
    b = Q.checks(w.silver["order_payments"], [Q.domain_rule("payment_type", "payment_type",
                                                            _PAYMENT_TYPES)])
    c = Q.checks(w.silver["products"], [Q.domain_rule("product_size_category",
                                                      "product_size_category",
                                                      ["small", "medium", "large"])])
    return a.unionByName(b).unionByName(c)
