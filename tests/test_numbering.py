"""Dense numbers and running totals against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marketlake.operators.numbering import numbered, running_totals


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_numbered_is_the_sorted_place(spark, n):
    r = random.Random(3)
    rows = [(r.choice([None, "hot", "hot", "hot", "x", "é"]), i) for i in r.sample(range(10 * n + 1), n)]
    df = spark.createDataFrame(rows, "a string, b long").repartition(7)
    got = numbered(df, [F.col("a").asc_nulls_last(), "b"], "nr").collect()
    want = sorted(rows, key=lambda x: (x[0] is None, (x[0] or "").encode(), x[1]))
    assert [(x.a, x.b) for x in sorted(got, key=lambda x: x.nr)] == want
    assert sorted(x.nr for x in got) == list(range(1, n + 1))


@pytest.mark.parametrize("n", [0, 1, 8, 9, 700])
def test_running_totals_over_several_levels(spark, n):
    r = random.Random(n)
    values = [r.randrange(5) for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(values, 1)), "k long, v long").repartition(5)
    got = {x.k: x.t for x in running_totals(df, "k", "v", "t", fan=8).collect()}
    assert got == {k: sum(values[:k - 1]) for k in range(1, n + 1)}


def test_running_totals_plan_has_no_one_task_window(spark):
    df = spark.range(1, 100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    plan = running_totals(df, "k", "v", "t", fan=8)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
