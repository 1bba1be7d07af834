"""Property tests: column functions against plain-Python definitions.

Each hypothesis example is a batch of rows evaluated in one Spark job.
"""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.functions import dates as D
from marketlake.functions.numeric import half_up_ratio

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

dates = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2035, 12, 31))
stamps = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2035, 12, 31))


def _half_up(num: int, den: int, scale: int, mult: int) -> float:
    q = (Decimal(num) * mult / Decimal(den)).quantize(Decimal(1).scaleb(-scale),
                                                      rounding=ROUND_HALF_UP)
    return float(q)


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)),
                min_size=1, max_size=200),
       st.sampled_from([(0, 1), (2, 1), (2, 100), (6, 1)]))
def test_half_up_ratio_matches_decimal(spark, rows, scale_mult):
    scale, mult = scale_mult
    df = spark.createDataFrame(rows, "n long, d long")
    got = [r[0] for r in df.select(half_up_ratio("n", "d", scale, mult=mult)).collect()]
    assert got == [_half_up(n, d, scale, mult) for n, d in rows]


def _us_week(d: dt.date) -> int:
    jan1 = dt.date(d.year, 1, 1)
    offset = jan1.isoweekday() % 7  # Sunday = 0
    return (d.timetuple().tm_yday - 1 + offset) // 7 + 1


@SETTINGS
@given(st.lists(st.tuples(dates, dates), min_size=1, max_size=200))
def test_calendar_functions(spark, rows):
    df = spark.createDataFrame(rows, "a date, b date")
    out = df.select(D.us_week("a"), D.month_diff("a", "b"), D.day_diff("a", "b"),
                    D.date_key("a"), D.is_weekend("a"), D.weekday_mon0("a")).collect()
    for (a, b), r in zip(rows, out):
        assert r[0] == _us_week(a)
        assert r[1] == (b.year * 12 + b.month) - (a.year * 12 + a.month)
        assert r[2] == (b - a).days
        assert r[3] == int(a.strftime("%Y%m%d"))
        assert r[4] == (1 if a.weekday() >= 5 else 0)
        assert r[5] == a.weekday()


@SETTINGS
@given(st.lists(st.tuples(stamps, stamps), min_size=1, max_size=200))
def test_minute_boundaries(spark, rows):
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(D.minute_diff("a", "b")).collect()]
    floor_min = lambda t: (t - dt.datetime(1970, 1, 1)) // dt.timedelta(minutes=1)
    assert got == [floor_min(b) - floor_min(a) for a, b in rows]


@SETTINGS
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=300), st.integers(1, 12))
def test_ntile_formula_matches_spark(spark, values, n):
    from pyspark.sql import Window

    from marketlake.operators.rank import global_ntile
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, k long")
    ours = global_ntile(df, n, ["v", "k"], "q")
    ref = df.withColumn("q_ref", F.ntile(n).over(Window.orderBy("v", "k")))
    assert ours.join(ref, ["v", "k"]).filter("q != q_ref").count() == 0
