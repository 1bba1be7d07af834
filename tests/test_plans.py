"""Silver/gold/mart semantics on hand rows, invariants on the bound tables,
source round-trips, and the driver entry points."""

from __future__ import annotations

import csv
import datetime as dt
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from marketlake.plans import gold as G
from marketlake.plans import marts as M
from marketlake.plans import silver as S
from marketlake.sources import schemas as SC
from marketlake.sources.files import read_csv, read_tsv, rejected_rows, write_tsv

TS = dt.datetime


def _orders(spark, rows):
    return spark.createDataFrame(rows, SC.BRONZE["orders"])


def test_carrier_repair_and_delivered_filter(spark):
    p = TS(2017, 1, 1, 10, 0)
    a = TS(2017, 1, 1, 11, 0)
    rows = [
        ("o1", "c", "canceled", p, a, TS(2017, 1, 2), None, TS(2017, 1, 9)),
        ("o2", "c", "created", p, None, None, None, TS(2017, 1, 9)),
        ("o3", "c", "shipped", p, a, None, None, TS(2017, 1, 9)),
        ("o4", "c", "delivered", p, None, TS(2017, 1, 2), TS(2017, 1, 3), TS(2017, 1, 9)),
        ("o5", "c", "delivered", p, a, TS(2017, 1, 2), TS(2017, 1, 12), TS(2017, 1, 9)),
    ]
    out = {r["order_id"]: r for r in S.orders(_orders(spark, rows)).collect()}
    assert out["o1"]["order_delivered_carrier_date"] is None
    assert out["o2"]["order_delivered_carrier_date"] == p
    assert out["o3"]["order_delivered_carrier_date"] == a
    assert "o4" not in out  # delivered with NULL approval is dropped
    o5 = out["o5"]
    assert (o5["is_delivered"], o5["delivery_days"], o5["delivery_delay_days"]) == (1, 11, 3)
    assert o5["approval_time"] == 60


def test_size_bucket_and_sentinel(spark):
    s = -9223372036854775808
    rows = [("p1", "a", 5, None, None, 100, 9, 111, 1),      # 999
            ("p2", "a", 5, None, None, 100, 10, 10, 10),     # 1000
            ("p3", "a", 5, None, None, 100, 9999, 1, 1),     # 9999
            ("p4", "a", 5, None, None, 100, 100, 10, 10),    # 10000
            ("p5", None, s, None, None, 100, s, 10, 10)]     # NULL volume
    df = spark.createDataFrame(rows, SC.BRONZE["products"])
    out = {r["product_id"]: r for r in S.products(df).collect()}
    assert [out[k]["product_size_category"] for k in ("p1", "p2", "p3", "p4", "p5")] == \
        ["small", "medium", "medium", "large", "large"]
    assert out["p5"]["product_name_length"] is None and out["p5"]["product_category_name"] == "unknown"


def test_customer_segments(spark):
    # (orders, value): (5,1000) (5,999) (3,0) (2,0) (1,9999)
    cases = [(5, 1000.0), (5, 999.0), (3, 0.0), (2, 0.0), (1, 9999.0)]
    cust, orders, pays = [], [], []
    for i, (n, v) in enumerate(cases):
        cust.append((f"c{i}", f"u{i}", "01000", "x", "Y"))
        for j in range(n):
            oid = f"o{i}_{j}"
            orders.append((oid, f"c{i}", "shipped", TS(2017, 1, 1 + j), None, None, None, None))
            pays.append((oid, 1, "voucher", 1, v if j == 0 else 0.0))
    dc = G.dim_customer(spark.createDataFrame(cust, SC.BRONZE["customers"]),
                        spark.createDataFrame(orders, SC.BRONZE["orders"]),
                        spark.createDataFrame(pays, SC.BRONZE["order_payments"]))
    got = [r["customer_segment"] for r in dc.orderBy("customer_unique_id").collect()]
    assert got == ["VIP", "LOYAL", "LOYAL", "REGULAR", "NEW"]
    assert [r["customer_sk"] for r in dc.orderBy("customer_unique_id").collect()] == [1, 2, 3, 4, 5]


def test_seller_without_items_counts_one(spark):
    sellers = spark.createDataFrame([("s1", "1000", "a", "B"), ("s2", "2000", "c", "D")],
                                    SC.BRONZE["sellers"])
    items = spark.createDataFrame([("o1", 1, "p", "s1", TS(2017, 1, 2), 10.0, 1.0, 11.0)],
                                  "order_id string, order_item_id int, product_id string, "
                                  "seller_id string, shipping_limit_date timestamp_ntz, price double, "
                                  "freight_value double, total_item_value double")
    orders = spark.createDataFrame([("o1", TS(2017, 1, 1))],
                                   "order_id string, order_purchase_timestamp timestamp_ntz")
    out = {r["seller_id"]: r for r in G.dim_seller(S.sellers(sellers), items, orders).collect()}
    assert (out["s2"]["total_items_sold"], float(out["s2"]["total_sales_amount"])) == (1, 0.0)
    assert out["s1"]["total_orders"] == 1 and out["s1"]["first_sale_date"] == dt.date(2017, 1, 1)


def test_rfm_segments(spark):
    """customer_rfm over 25 customers whose measures spread over all quintiles."""
    rng = __import__("random").Random(2)
    f = [20 + rng.randrange(5) for _ in range(25)]
    rows = [(k, f"o{k}-{j}", 20000101 + rng.randrange(28), float(rng.randrange(1, 500))) for k in range(25) for j in range(f[k])]
    orders = spark.createDataFrame(rows, "customer_sk long, order_id string, purchase_date_sk int, total_payment_amount double") \
        .withColumn("total_payment_amount", F.col("total_payment_amount").cast("decimal(18,2)"))
    days = G.dim_date(spark, G.GoldParams(cal_start="2000-01-01", cal_end="2000-01-31"))
    got = {r.customer_sk: r for r in M.customer_rfm(orders, days).collect()}
    last = {k: max(r[2] for r in rows if r[0] == k) for k in range(25)}
    measures = {"r_score": {k: max(last.values()) - last[k] for k in last},
                "f_score": {k: f[k] for k in range(25)}, "m_score": {k: sum(r[3] for r in rows if r[0] == k) for k in range(25)}}
    for score, by in measures.items():
        order = sorted(by, key=lambda k: (by[k], k))
        assert {k: got[k][score] for k in got} == {k: 1 + i // 5 for i, k in enumerate(order)}
    for r in got.values():
        s = (r.r_score, r.f_score, r.m_score)
        want = ("CHAMPIONS" if min(s) >= 4 else "LOYAL_CUSTOMERS" if min(s) == 3 else "NEW_CUSTOMERS" if s[0] >= 4 and s[1] <= 2
                else "AT_RISK" if s[0] <= 2 and s[1] >= 3 else "LOST_CUSTOMERS" if max(s) == 1 else "REGULAR")
        assert r.rfm_segment == want and r.rfm_score == "%d%d%d" % s
    assert M.customer_rfm(orders.limit(0), days).count() == 0


def test_warehouse_invariants(spark):
    from marketlake.plans.warehouse import warehouse
    w = warehouse(spark, SF001)
    fo, foi, dc = w.fact_orders, w.fact_order_items, w.dim_customer
    assert fo.count() == fo.select("order_sk").distinct().count()
    assert foi.count() == foi.select("order_item_sk").distinct().count()
    n = dc.count()
    assert dc.agg(F.min("customer_sk"), F.max("customer_sk")).first() == (1, n)
    # no review -> avg_review_score 0, never NULL
    assert fo.filter(F.col("avg_review_score").isNull()).count() == 0
    # retention month 0 is 100 %
    assert {r[0] for r in w.cohort_retention.filter("retention_month = 0")
            .select("retention_rate").distinct().collect()} == {100.0}
    # segment counts add up to the customers
    assert w.customer_rfm.count() == fo.select("customer_sk").distinct().count()
    # JN-3 differs from the fan-out count JN-4 whenever an order has several payments
    from marketlake.plans.queries_ops import jn_preagg
    j = jn_preagg(w).agg(F.sum("fanout_orders"), F.sum("lifetime_orders")).first()
    assert j[0] > j[1]


def test_export_file_with_bom_crlf_and_no_final_newline(spark, tmp_path):
    """A tab-separated export as the warehouse writes it, read as data."""
    lines = ["cohort_month\tretention_month\tretained_customers\tcohort_size\tretention_rate\tdwh_create_date",
             "2001-01-01\t0\t40\t40\t100.0\t2024-01-01 00:00:00", "2001-01-01\t1\t3\t40\t7.5\t2024-01-01 00:00:00",
             "2001-02-01\t0\t7\t7\t100.0\t2024-01-01 00:00:00"]
    path = tmp_path / "cohort.tsv"
    path.write_bytes(b"\xef\xbb\xbf" + "\r\n".join(lines).encode())
    coh = read_tsv(spark, str(path), SC.EXPORTS["cohort_retention"])
    assert coh.count() == 3 and coh.agg(F.sum("cohort_size")).first()[0] == 87
    off = coh.filter(F.abs(F.col("retention_rate") - F.round(F.col("retained_customers") * 100.0 / F.col("cohort_size"), 2)) > 1e-9)
    assert off.count() == 0


def test_csv_columns_go_by_name_and_bad_rows_are_counted(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_city, SELLER_STATE,extra,seller_zip_code_prefix,seller_id\nx,SP,1,01000,s1\ny,RJ,2,02000,s2\n")
    rows = read_csv(spark, str(path), SC.BRONZE["sellers"]).orderBy("seller_id").collect()
    assert [tuple(r) for r in rows] == [("s1", "01000", "x", "SP"), ("s2", "02000", "y", "RJ")]
    bad = tmp_path / "items.csv"
    bad.write_text(",".join(f.name for f in SC.BRONZE["order_payments"].fields) + "\no1,1,card,2,3.5\no2,one,card,2,3.5\n")
    kept = read_csv(spark, str(bad), SC.BRONZE["order_payments"], rejected="raw")
    assert [tuple(r) for r in rejected_rows(kept, "raw", "order_payments").collect()] == [("order_payments", 2, 1)]
    with pytest.raises(Exception):
        read_csv(spark, str(bad), SC.BRONZE["order_payments"]).collect()
    with pytest.raises(ValueError):
        read_csv(spark, str(path), SC.BRONZE["customers"])


def test_csv_and_tsv_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    src = os.path.join(d, "in.csv")
    with open(src, "w", newline="", encoding="utf-8-sig") as fh:
        w = csv.writer(fh)
        w.writerow(["Customer_ID ", "customer_unique_id", "customer_zip_code_prefix",
                    "customer_city", "customer_state"])
        w.writerow(["c1", "u1", "01234", "são paulo", "SP"])
        w.writerow(["c2", "u2", "", "multi\nline", "RJ"])
    df = read_csv(spark, src, SC.BRONZE["customers"])
    rows = {r["customer_id"]: r for r in df.collect()}
    assert rows["c1"]["customer_zip_code_prefix"] == "01234"      # leading zero kept
    assert rows["c2"]["customer_zip_code_prefix"] is None         # empty -> NULL
    assert rows["c2"]["customer_city"] == "multi\nline"
    write_tsv(df, os.path.join(d, "out"))
    back = read_tsv(spark, os.path.join(d, "out"), SC.BRONZE["customers"], multiline=True)
    assert back.count() == 2


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 98
    # only learner-dependent ML outputs lack an oracle
    assert all(re.match(r"ml_|op\d+_|pipeline$", k) for k in set(q) - set(o))


def test_size_shuffle_partitions_raises_never_lowers(spark):
    from marketlake.session import input_bytes, size_shuffle_partitions
    from marketlake.sources.bindings import bound_paths
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert size_shuffle_partitions(spark, 3 * (1 << 30)) == 8  # small input: kept
        assert size_shuffle_partitions(spark, 100 * (1 << 40)) == 102_400  # 100 TiB
        assert spark.conf.get("spark.sql.shuffle.partitions") == "102400"
        assert size_shuffle_partitions(spark, 1 << 30) == 102_400  # never lowered
        n = input_bytes(spark, bound_paths(SF001))
        assert 0 < n < (1 << 30)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
