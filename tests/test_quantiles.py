"""Exact cuts and NTILE against sorted Python lists."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlake.operators import quantiles
from marketlake.operators.quantiles import global_ntiles, tile_ends


def ntile(rows, n):
    """{row: tile} as SQL deals sorted rows."""
    q, r = divmod(len(rows), n)
    out, at = {}, 0
    for t in range(n):
        for row in rows[at:at + q + (t < r)]:
            out[row] = t + 1
        at += q + (t < r)
    return out


@pytest.mark.parametrize("rows", [0, 1, 3, 4, 5, 11, 700])
@pytest.mark.parametrize("finish", [0, 50])
def test_ntiles_of_three_measures(spark, monkeypatch, rows, finish):
    monkeypatch.setattr(quantiles, "FINISH", finish)
    monkeypatch.setattr(quantiles, "SPLIT", 7)
    r = random.Random(rows)
    data = [(k, r.choice([1, 1, 1, 1, 2, 3, 9]), Decimal(r.randrange(-10**6, 10**6)) / 100, dt.date(1995, 1, 1) + dt.timedelta(days=r.randrange(900)))
            for k in r.sample(range(-5000, 5000), rows)]
    df = spark.createDataFrame(data, "k long, few int, money decimal(18,2), day date").repartition(3)
    got = global_ntiles(df, {"a": ("few", "asc"), "b": ("money", "desc"), "c": ("day", "asc"), "d": ("few", "desc")}, 5, "k").collect()
    for name, col, reverse in (("a", 1, False), ("b", 2, True), ("c", 3, False), ("d", 1, True)):
        want = ntile([x[0] for x in sorted(data, key=lambda x: (x[col], x[0]), reverse=reverse)], 5)
        assert {x.k: x[name] for x in got} == want


def test_extreme_values_and_one_hot_value(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FINISH", 0)
    big = 2**62
    data = [(i, 0) for i in range(300)] + [(1000, -big), (1001, big), (1002, big - 1)]
    df = spark.createDataFrame(data, "k long, v long")
    want = ntile([k for k, _ in sorted(data, key=lambda x: (x[1], x[0]))], 10)
    assert {x.k: x.t for x in global_ntiles(df, {"t": ("v", "asc")}, 10, "k").collect()} == want


def test_null_and_repeated_tuples_are_errors(spark):
    with pytest.raises(ValueError, match="NULL"):
        global_ntiles(spark.createDataFrame([(1, 1), (2, None)], "k long, v long"), {"t": ("v", "asc")}, 2, "k")
    for finish in (0, 100):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(quantiles, "FINISH", finish)
            with pytest.raises(ValueError, match="equal"):
                global_ntiles(spark.createDataFrame([(1, 1)] * 4, "k long, v long"), {"t": ("v", "asc")}, 2, "k")
    with pytest.raises(TypeError):
        global_ntiles(spark.createDataFrame([(1, "x")], "k long, v string"), {"t": ("v", "asc")}, 2, "k")


def test_no_row_is_shuffled(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    plan = global_ntiles(df, {"t": ("v", "asc")}, 5, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_tile_ends_match_sql(spark):
    for total, n in ((0, 5), (3, 5), (7, 5), (10, 5), (11, 4)):
        rows = spark.range(total).selectExpr("id", f"ntile({n}) over (order by id) as t").collect()
        assert tile_ends(total, n) == [sum(x.t <= t for x in rows) for t in range(1, n)]
