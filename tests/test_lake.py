"""Versioned layers, load contracts, metrics of loads, incremental refresh."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from marketlake.plans.incremental import KpiState
from marketlake.sources import contracts as C
from marketlake.sources.lake import Lake, LoadError

ITEMS = C.Contract(C.columns("id int, price decimal(18,2), day date"), ("id",), (("price", "price >= 0"),))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_contract_marks_every_broken_rule(spark):
    df = spark.createDataFrame([("1", "2.50", "2024-01-02", "x"), ("one", "-1", "2024-01-02", "x"), (None, None, None, "x"), ("4", "1", "not a day", None)],
                               "id string, price string, day string, extra string")
    got = [tuple(r) for r in ITEMS.mark(df).select("id", C.RULES).collect()]
    assert sorted(got, key=str) == sorted([(1, []), (None, ["type:id", "price"]), (None, ["null:id"]), (4, ["type:day"])], key=str)
    counts = {r.rule: (r.n_rows, r.n_bad) for r in C.rejects(df, ITEMS, "items").collect()}
    assert counts == {"type:id": (4, 1), "type:price": (4, 0), "type:day": (4, 1), "null:id": (4, 1), "price": (4, 1)}
    with pytest.raises(ValueError, match="no column price"):
        ITEMS.mark(df.drop("price"))
    assert ITEMS.mark(df.limit(0)).count() == 0


def test_contract_keeps_one_row_of_a_repeated_key(spark):
    contract = C.Contract(C.columns("k string, v int"), (), (), ("k",))
    rows = [("a", 1), ("b", 5), ("b", 3), ("b", 3), (None, 1), (None, 2), ("c", None)] + [("hot", 7)] * 50
    marked = contract.mark(spark.createDataFrame(rows, "k string, v int").repartition(4)).collect()
    assert sorted([(r.k, r.v) for r in marked if not r[C.RULES]], key=str) == sorted([("a", 1), ("b", 3), (None, 1), ("c", None), ("hot", 7)], key=str)
    assert sum(r[C.RULES] == ["key"] for r in marked) == len(rows) - 5


def test_rejects_metrics_and_audit_of_a_load(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    df = spark.createDataFrame([("1", "2.50", "2024-01-02"), ("2", "-1", "2024-01-02"), (None, "-3", None)], "id string, price string, day string")
    out = lake.load("silver/items", df, ITEMS, audit="dwh_create_date")
    assert rows_of(out.select("id", "day")) == [(1, dt.date(2024, 1, 2))] and "dwh_create_date" not in out.columns
    lake.publish()
    assert "dwh_create_date" in lake.table("silver/items").columns
    assert sorted((r.id, sorted(r.rules)) for r in lake.rejects("silver/items").fillna(-1).collect()) == [(-1, ["null:id", "price"]), (2, ["price"])]
    history = {r.rule: (r.layer, r.table_name, r.n_rows, r.n_bad) for r in lake.quality_history().collect()}
    assert history["price"] == ("silver", "items", 3, 2) and history["null:id"] == ("silver", "items", 3, 1)
    lake.load("silver/items", df.limit(1), ITEMS)
    lake.publish()
    assert lake.rejects("silver/items") is None and lake.quality_history().where("rule = 'price'").count() == 2


def test_the_load_scans_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    df = spark.range(100).select(F.col("id").cast("int").alias("id"), F.lit(1).cast("decimal(18,2)").alias("price"), F.current_date().alias("day"))

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    Lake(spark, str(tmp_path / "lake")).load("silver/items", df.mapInArrow(touch, df.schema), ITEMS)
    assert seen.value == 100


def test_names_are_swapped_together_and_old_readers_finish(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for name in ("silver/a", "gold/b"):
        lake.load(name, spark.range(3), bucket_by="id" if name == "gold/b" else None, buckets=2)
    assert lake.manifest() == {}  # nothing is seen before the publish
    lake.publish()
    views = lake.attach()
    old = lake.table("silver/a")
    assert {t: spark.table(v).count() for t, v in views.items()} == {"silver/a": 3, "gold/b": 3}
    lake.load("silver/a", spark.range(5))
    lake.load("gold/b", spark.range(5), bucket_by="id", buckets=2)
    assert spark.table(views["silver/a"]).count() == 3
    lake.publish()
    assert {t: spark.table(v).count() for t, v in views.items()} == {"silver/a": 5, "gold/b": 5}
    assert old.count() == 3 and lake.table("silver/a", 1).count() == 3
    assert lake.vacuum(keep=2) == []
    lake.load("silver/a", spark.range(6))
    lake.publish()
    gone = lake.vacuum(keep=1)
    assert len(gone) == 3 and lake.table("silver/a").count() == 6 and lake.table("gold/b").count() == 5
    # another session's handle sees the same state
    assert Lake(spark, str(tmp_path / "lake")).manifest() == lake.manifest()


def test_two_publishers_do_not_overwrite_each_other(spark, tmp_path):
    one, two = (Lake(spark, str(tmp_path / "lake")) for _ in range(2))
    one.load("silver/a", spark.range(1))
    two.load("silver/a", spark.range(2))
    numbers = one._manifests()
    one.publish()
    two._manifests = lambda: numbers  # it looked before the other published
    with pytest.raises(LoadError, match="another load"):
        two.publish()
    assert one.table("silver/a").count() == 1


def test_a_run_killed_midway_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    from marketlake.plans import marts
    from marketlake.plans import pipeline
    out = str(tmp_path / "out")
    first = pipeline.run_layers(spark, SF001, out_dir=out)
    views = first["lake"].attach()
    tables = lambda: {f"{d}.{t.name}" for d in sorted({v.split(".")[0] for v in views.values()}) for t in spark.catalog.listTables(d)}
    before, names = {t: spark.table(v).count() for t, v in views.items()}, tables()
    assert {t.split("/")[0] for t in views} == {"silver", "gold", "marts"} and len(views) > 25

    def dies(*a, **kw):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(marts, "cohort_retention", dies)
        with pytest.raises(RuntimeError, match="killed"):
            pipeline.run_layers(spark, SF001, out_dir=out)
    assert first["lake"]._manifests() == [1] and tables() == names
    assert {t: spark.table(v).count() for t, v in views.items()} == before
    second = pipeline.run_layers(spark, SF001, out_dir=out)
    assert second["manifest"] == 2 and second["lake"].attach() == views and tables() == names
    assert {t: spark.table(v).count() for t, v in views.items()} == before


def test_refresh_takes_new_rows_once_and_survives_a_crash(spark, tmp_path, monkeypatch):
    at = lambda h: dt.datetime(2024, 2, 1, h)
    rows = [(f"o{i}", i % 4, 20240101 + i % 3, "delivered" if i % 5 else "canceled", float(i), float(i % 5), i % 2, at(i % 3)) for i in range(60)]
    schema = "order_id string, customer_sk long, purchase_date_sk int, order_status string, total_payment_amount double, avg_review_score double, is_delayed int, dwh_create_date timestamp"
    orders = spark.createDataFrame(rows, schema).withColumn("total_payment_amount", F.col("total_payment_amount").cast("decimal(18,2)"))
    slices, whole = KpiState(spark, str(tmp_path / "slices")), KpiState(spark, str(tmp_path / "whole"))
    assert whole.refresh(orders) == 60 and whole.refresh(orders) == 0
    assert slices.refresh(orders.where(F.col("dwh_create_date") <= F.lit(at(0)))) == 20
    with monkeypatch.context() as m:  # dies after the partials, before the control table
        write = KpiState._write
        m.setattr(KpiState, "_write", lambda self, df, name, *p: write(self, df, name, *p) if name == "daily" else (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            slices.refresh(orders.where(F.col("dwh_create_date") <= F.lit(at(1))))
    assert slices.executive_kpi().agg(F.sum("total_orders")).first()[0] == sum(r[3] == "delivered" for r in rows if r[7] == at(0))
    assert slices.refresh(orders.where(F.col("dwh_create_date") <= F.lit(at(1)))) == 20
    assert slices.refresh(orders) == 20
    assert rows_of(slices.executive_kpi()) == rows_of(whole.executive_kpi())
    assert rows_of(slices.monthly_business_summary()) == rows_of(whole.monthly_business_summary())
    want = {d: sum(r[3] == "delivered" for r in rows if r[2] == d) for d in (20240101, 20240102, 20240103)}
    assert {r.date_sk: r.total_orders for r in whole.executive_kpi().collect()} == want
    assert KpiState(spark, str(tmp_path / "none")).executive_kpi().collect() == []
