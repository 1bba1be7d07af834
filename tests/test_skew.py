"""Hot keys: one customer with a third of the orders, one seller with a third
of the items, one product in a third of the items, and a large group of exact
copies. The full layer pipeline runs on hand-built bronze inputs and is
checked against brute-force Python counts."""

from __future__ import annotations

import datetime as dt
import glob
import tempfile
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from marketlake.plans import gold as G
from marketlake.plans.pipeline import BY_ORDER, WITH_HOT, run_layers
from marketlake.plans.warehouse import LayerWarehouse, Warehouse
from marketlake.sources import schemas as SC


def _bronze(spark):
    customers = [(f"c{i}", f"u{i}", f"{1000 + i:05d}", "sao paulo", "SP") for i in range(30)]
    orders, items, pays, reviews = [], [], [], []
    for k in range(300):
        cust = "c0" if k % 3 == 0 else f"c{1 + k % 29}"
        p = dt.datetime(2017, 1, 1) + dt.timedelta(days=k % 200, minutes=k)
        a, c = p + dt.timedelta(hours=1), p + dt.timedelta(days=1)
        d, e = p + dt.timedelta(days=3 + k % 9), p + dt.timedelta(days=7)
        orders.append((f"o{k:03d}", cust, "delivered", p, a, c, d, e))
        pays.append((f"o{k:03d}", 1, "voucher", 1, 100.0 + k))
        reviews.append((f"r{k}", f"o{k:03d}", float(1 + k % 5), None, "ok", p, p + dt.timedelta(days=1)))
        for j in range(3):
            seller = "s0" if (k * 3 + j) % 3 == 0 else f"s{1 + (k + j) % 4}"
            prod = "p0" if j == 0 else f"p{1 + (k + j) % 9}"
            items.append((f"o{k:03d}", j + 1, prod, seller, p + dt.timedelta(days=2),
                          10.0 + j, 0.0 if j == 2 else 1.5))
    copies = [items[0]] * 450  # a group of exact copies as large as half the items
    products = [(f"p{i}", "cama_mesa", 10, None, None, 500, 10, 10, 10) for i in range(10)]
    sellers = [(f"s{i}", f"{2000 + i}", "rio", "RJ") for i in range(5)]
    geo = [("01000", -23.5, -46.6, "São Paulo", "SP")] * 50 + [("01000", -23.5, -46.6, "sp", "SP")]
    mk = lambda rows, t: spark.createDataFrame(rows, SC.BRONZE[t])
    return {
        "customers": mk(customers, "customers"), "orders": mk(orders, "orders"),
        "order_items": mk(items + copies, "order_items"), "order_payments": mk(pays, "order_payments"),
        "order_reviews": mk(reviews, "order_reviews"), "products": mk(products, "products"),
        "sellers": mk(sellers, "sellers"),
        "category_translation": mk([("cama_mesa", "bed_table")], "category_translation"),
        "geolocation": mk(geo, "geolocation"),
    }, items


def test_pipeline_with_hot_keys(spark):
    bronze, items = _bronze(spark)
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    res = run_layers(spark, "", out_dir=out, bronze=bronze,
                     gp=G.GoldParams(cal_start="2016-01-01", cal_end="2018-12-31"))
    w = LayerWarehouse(spark, "", res["root"])
    read = w._read
    # hash-partitioned before the bucketed write: one file per bucket at most
    buckets, state = int(spark.conf.get("spark.sql.shuffle.partitions")), res["lake"].manifest()
    for table in BY_ORDER:
        assert len(glob.glob(f"{res['root']}/{table}/{state[table]['version']}/*.parquet")) <= buckets
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = G.OrderLines(w._one("silver/order_items"))
        orders, pays, reviews, keys = (w._one(t) for t in ("silver/orders", "silver/order_payments", "silver/order_reviews", "gold/order_keys"))
        plans = [w._one("gold/fact_order_items").join(w.fact_orders.select("order_id", "order_status"), "order_id"),
                 G.fact_orders(orders, lines, pays, reviews, keys), lines.with_orders(keys), G.fact_orders(orders, lines, pays, reviews, keys).repartition(buckets, "order_id")]
        for df in plans:
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
        # the seller dimension moves rows by seller only
        plan = G.dim_seller(w._one("silver/sellers"), lines, orders)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(order_id" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    # exact copies collapse to one row
    assert read("silver/order_items").count() == len(set(items))

    # dim_seller: items and distinct orders per seller, brute force
    per_seller_items = Counter(i[3] for i in items)
    per_seller_orders = defaultdict(set)
    for i in items:
        per_seller_orders[i[3]].add(i[0])
    ds = {r["seller_id"]: r for r in read("gold/dim_seller").collect()}
    for s, n in per_seller_items.items():
        assert ds[s]["total_items_sold"] == n
        assert ds[s]["total_orders"] == len(per_seller_orders[s])

    # dim_customer: the hot person holds a third of the orders
    dc = {r["customer_unique_id"]: r for r in read("gold/dim_customer").collect()}
    assert dc["u0"]["lifetime_orders"] == 100
    assert sorted(r["customer_sk"] for r in dc.values()) == list(range(1, 31))

    # item fact keeps every item; item keys are a dense 1..N
    foi = read("gold/fact_order_items")
    n = foi.count()
    assert n == len(set(items))
    assert foi.agg(F.min("order_item_sk"), F.max("order_item_sk"),
                   F.countDistinct("order_item_sk")).first() == (1, n, n)

    # product mart: the hot product's orders and items
    ps = read("marts/product_sales_mart").join(read("gold/dim_product").select("product_sk", "product_id"),
                                               "product_sk")
    hot = ps.filter("product_id = 'p0'").first()
    assert hot["total_orders"] == 300 and hot["total_quantity_sold"] == 300

    # geolocation: majority city wins for the hot zip
    geo = read("silver/geolocation").first()
    assert geo["geolocation_city"] == "sao paulo"


def test_a_hot_order_lies_apart(spark):
    """One order with more lines than all others: no bucket holds it, and no row is lost."""
    bronze, items = _bronze(spark)
    p = dt.datetime(2017, 1, 1) + dt.timedelta(days=2)
    hot = [("o000", 10 + j, f"p{j % 10}", f"s{j % 5}", p, 5.0, 1.0) for j in range(1200)]
    bronze["order_items"] = bronze["order_items"].unionByName(
        spark.createDataFrame(hot, SC.BRONZE["order_items"]))
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    res = run_layers(spark, "", out_dir=out, bronze=bronze, buckets=8, gp=G.GoldParams(cal_start="2016-01-01", cal_end="2018-12-31"))
    w = LayerWarehouse(spark, "", res["root"])
    n = len(set(items)) + len(hot)
    for table in WITH_HOT:
        assert w._one(f"{table}_hot").select("order_id").distinct().collect() == [("o000",)]
        assert w._one(table).where("order_id = 'o000'").count() == 0
        assert w._read(table).count() == n and w._read(table).where("order_id = 'o000'").count() == 3 + len(hot)
    assert w.fact_order_items.agg(F.min("order_item_sk"), F.max("order_item_sk"), F.countDistinct("order_item_sk")).first() == (1, n, n)
    fo = w.fact_orders.where("order_id = 'o000'").first()
    assert fo.total_items == 3 + len(hot) and fo.order_sk == 1
    assert w.dim_seller.agg(F.sum("total_items_sold")).first()[0] == n
    # the same marts as with everything in one task's reach
    plain = Warehouse(spark, "", G.GoldParams(cal_start="2016-01-01", cal_end="2018-12-31"))
    plain.bronze = bronze
    for mart in ("seller_performance", "product_sales", "customer_360"):
        a, b = getattr(w, mart), getattr(plain, mart)
        assert sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect()))


def test_hot_orders_are_few_at_any_size(spark):
    for n, share in ((0, 1), (10, 1), (4000, 1), (4000, 50)):
        df = spark.range(n).select((F.col("id") / share).cast("int").cast("string").alias("order_id"))
        assert G.hot_orders(df, 8).count() <= 32
