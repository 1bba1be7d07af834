"""Hand-written edge rows per column function (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketlake.functions import dates as D
from marketlake.functions.nulls import eq_flag, ne_flag, null_if_sentinel
from marketlake.functions.numeric import half_up_ratio, money_mean
from marketlake.functions.text import fold_accents, text_len


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first()["x"]


def test_accent_fold(spark):
    assert one(spark, fold_accents("s"), "s string", ("São João ÁÇ",)) == "sao joao ac"


def test_text_len_ignores_trailing_blanks(spark):
    assert one(spark, text_len("s"), "s string", ("a ",)) == 1


def test_minute_boundary(spark):
    a, b = dt.datetime(2020, 1, 1, 0, 0, 59), dt.datetime(2020, 1, 1, 0, 1, 1)
    assert one(spark, D.minute_diff("a", "b"), "a timestamp_ntz, b timestamp_ntz", (a, b)) == 1


def test_day_boundary(spark):
    a, b = dt.datetime(2020, 1, 1, 23, 59, 59), dt.datetime(2020, 1, 2, 0, 0, 1)
    assert one(spark, D.day_diff("a", "b"), "a timestamp_ntz, b timestamp_ntz", (a, b)) == 1


def test_month_boundary(spark):
    a, b = dt.date(2020, 1, 31), dt.date(2020, 2, 1)
    assert one(spark, D.month_diff("a", "b"), "a date, b date", (a, b)) == 1


def test_us_week_and_weekend(spark):
    days = [dt.date(2016, 1, 1), dt.date(2016, 1, 2), dt.date(2016, 1, 3), dt.date(2017, 1, 1),
            dt.date(2017, 1, 8), dt.date(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(D.us_week("d")).collect()]
    assert got == [1, 1, 2, 1, 2, 53]
    wk = spark.createDataFrame([(dt.date(2016, 1, 2),), (dt.date(2016, 1, 4),)], "d date")
    assert [r[0] for r in wk.select(D.is_weekend("d")).collect()] == [1, 0]
    assert one(spark, D.weekday_mon0("d"), "d date", (dt.date(2016, 1, 4),)) == 0


def test_date_key(spark):
    assert one(spark, D.date_key("d"), "d date", (dt.date(2016, 1, 2),)) == 20160102


def test_sentinel(spark):
    assert one(spark, null_if_sentinel("v"), "v bigint", (-9223372036854775808,)) is None
    assert one(spark, null_if_sentinel("v"), "v bigint", (7,)) == 7


def test_null_flags(spark):
    schema = "a string, b string"
    assert one(spark, eq_flag("a", "b"), schema, (None, "SP")) == 0
    assert one(spark, ne_flag("a", "b"), schema, (None, "SP")) == 1


def test_half_up_ratio_exact(spark):
    # 18 of 3582 retained = 0.50 %
    assert one(spark, half_up_ratio("n", "d", 2, mult=100), "n long, d long", (18, 3582)) == 0.5
    # 1.005 is not representable in binary; exact integer rounding gives 1.01
    from decimal import Decimal
    assert one(spark, money_mean("s", "n"), "s decimal(18,2), n long", (Decimal("2.01"), 2)) == 1.01
    assert one(spark, half_up_ratio("n", "d", 2), "n long, d long", (-5, 2)) == -2.5
    assert one(spark, half_up_ratio("n", "d", 0), "n long, d long", (-5, 2)) == -3.0
    assert one(spark, half_up_ratio("n", "d", 2), "n long, d long", (1, 0)) is None
