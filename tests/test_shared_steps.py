"""Steps that many queries share: written once, moved once, in bounded partitions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_skew import _bronze

from marketlake.operators import numbering
from marketlake.operators.numbering import staged
from marketlake.operators.rank import line_numbers
from marketlake.plans import gold as G
from marketlake.plans import ml as ML
from marketlake.plans import silver as S
from marketlake.plans.queries_ops import dq_orphans
from marketlake.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def hand(spark):
    bronze, items = _bronze(spark)
    # orders without a silver row keep their items, one of them twice
    lost = spark.createDataFrame([("gone", 1, "p0", "s0", items[0][4], 5.0, 1.0)] * 2 + [("gone", 2, "p1", "s1", items[0][4], 5.0, 1.0)], bronze["order_items"].schema)
    bronze["order_items"] = bronze["order_items"].unionByName(lost)
    w = Warehouse(spark, "", G.GoldParams(cal_start="2016-01-01", cal_end="2018-12-31"))
    w.bronze = bronze
    return w, items


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_readers_find_the_facts_written(hand):
    w, items = hand
    for df in (w.fact_order_items, w.fact_orders, w.kept_orders, w.kept_items, w.pay_totals):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    n = len(set(items))
    assert w.fact_order_items.agg(F.min("order_item_sk"), F.max("order_item_sk"), F.countDistinct("order_item_sk")).first() == (1, n, n)


def test_item_base_meets_orders_only(hand):
    w, items = hand
    on = [line for line in _plan(w.item_base).splitlines() if "Join Inner" in line]
    assert any("order_id" in line for line in on) and not any("customer_sk" in line or "product_sk" in line for line in on)
    plain = w.fact_order_items.join(w.dim_customer.select("customer_sk", "is_repeat_customer"), "customer_sk") \
        .join(w.dim_product.select("product_sk", "product_category_name"), "product_sk")
    keys = ("order_item_sk", "is_repeat_customer", "product_category_name")
    assert sorted(map(str, w.item_base.select(*keys).collect())) == sorted(map(str, plain.select(*keys).collect()))
    assert w.item_base.columns[:3] == ["product_sk", "customer_sk", "order_id"] and w.item_base.columns[-2:] == list(keys[1:])


def test_item_keys_follow_the_ids(hand):
    w, _ = hand
    ids = w.fact_order_items.join(w.dim_product.select("product_sk", "product_id"), "product_sk") \
        .orderBy("order_item_sk").select("order_id", "order_item_id", "product_id").collect()
    assert ids == sorted(ids)


def test_lines_are_numbered_once(spark):
    lines = spark.createDataFrame([(g, i, str(i % 3)) for g in (1, 2) for i in range(50)], "g long, line int, p string")
    plan = line_numbers(lines.repartition(4), "g", "line", ["p"], "sk")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan


def test_orphans_move_once(hand):
    w, _ = hand
    out = dq_orphans(w)
    assert sorted(map(tuple, out.select("order_id", "order_item_id").collect())) == [("gone", 1), ("gone", 2)]
    # copies are removed from what the anti-join leaves, not before it
    lines = [line for line in _plan(out).splitlines() if "Join LeftAnti" in line or "Aggregate" in line]
    assert "Aggregate" in lines[0] and any("LeftAnti" in line for line in lines[1:])


def test_items_meet_their_order_and_lose_copies_in_one_move(spark, hand):
    w, items = hand
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        met = G.met_items(S.valid_items(w.bronze["order_items"]), G.keyed_orders(w.kept_orders, w.order_keys).localCheckpoint())
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # the items; the orders lie by order
        plan = S.order_payments(w.bronze["order_payments"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # every silver item is there once, those without a silver order too
    cols = ["order_id", "order_item_id", "product_id", "seller_id", "price"]
    assert sorted(map(tuple, met.select(cols).collect())) == sorted(map(tuple, w.silver["order_items"].select(cols).collect()))
    assert met.where("order_id = 'gone'").agg(F.count("order_purchase_timestamp"), F.count("order_keys")).first() == (0, 0)


def test_lines_are_numbered_for_readers_of_the_number_only(hand):
    w, items = hand
    new = Warehouse(w.spark, "", w.gp)
    new.bronze = w.bronze
    lines, sales, best = new.plain_fact_items, new.product_sales, new.plain_item_base
    assert "item_lines" not in new.__dict__ and "dim_seller" not in new.__dict__ and "order_item_sk" not in lines.columns
    want = w.fact_order_items.drop("order_item_sk")
    assert sorted(map(str, lines.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, best.collect())) == sorted(map(str, w.item_base.select(best.columns).collect()))
    plain = w.item_base.groupBy("product_sk").agg(F.countDistinct("order_sk"), F.count("order_item_sk"), F.sum("total_item_value").cast("double"))
    got = sales.select("product_sk", "total_orders", "total_quantity_sold", "total_revenue")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    new.item_lines
    assert new.plain_lines.columns == [c for c in new.item_lines.columns if c != "order_item_sk"]


def test_sellers_keep_their_numbers_and_sales(hand):
    w, _ = hand
    old = G.dim_seller(w.silver["sellers"], w.silver["order_items"], w.silver["orders"], w.gp)
    assert sorted(map(str, w.dim_seller.select(old.columns).collect())) == sorted(map(str, old.collect()))
    assert old.columns == w.dim_seller.columns


def test_shuffle_files_of_a_written_table_go(spark):
    seen = []
    before = {k: spark.conf.get(k) for k in numbering.WRITING}

    class Kept:
        def __init__(self, df):
            self.df = df

        def parquet(self, *a, **k):
            seen.append({c: spark.conf.get(c) for c in numbering.WRITING})
            return self.df.parquet(*a, **k)

    class Table:
        sparkSession = spark  # noqa: N815
        schema = spark.range(1).schema
        write = Kept(spark.range(1).write)

    staged(Table, "t")
    assert seen == [numbering.WRITING] and before == {k: spark.conf.get(k) for k in numbering.WRITING}


def test_training_rows_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(ML, "TRAIN_ROWS", 100)
    rows = spark.range(1000).coalesce(1)
    sizes = [r["count"] for r in ML.dealt_out(rows).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) <= 150
    few = spark.range(90).coalesce(1)
    assert ML.dealt_out(few) is few
