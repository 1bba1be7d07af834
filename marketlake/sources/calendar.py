"""Calendar generator (SRC-12) and the date dimension columns (GLD-2).

One row per day is produced by ``explode(sequence(start, end))``: a single
generator row fans out inside one task, so the row count is exactly the
number of days in the range — a proven bound that makes the date
dimension safe to broadcast.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import dates as D

# The calendar range of the warehouse's date dimension.
REFERENCE_START = "2016-01-01"
REFERENCE_END = "2020-12-31"


def calendar(spark: SparkSession, start: str = REFERENCE_START,
             end: str = REFERENCE_END) -> DataFrame:
    """``full_date`` for every day in ``[start, end]``."""
    return (spark.range(1)
            .select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                                         F.expr("interval 1 day"))).alias("full_date")))


def calendar_days(start: str, end: str) -> int:
    s = _dt.date.fromisoformat(start)
    e = _dt.date.fromisoformat(end)
    return max(0, (e - s).days + 1)


def calendar_covering(df: DataFrame, col: str) -> DataFrame:
    """``full_date`` for every day between the first and last date of ``df[col]``,
    derived lazily: one aggregate row is exploded (no driver round trip)."""
    bounds = df.agg(F.min(F.to_date(col)).alias("_lo"), F.max(F.to_date(col)).alias("_hi"))
    return bounds.filter(F.col("_lo").isNotNull()).select(
        F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias("full_date"))


def date_columns(days: DataFrame) -> DataFrame:
    """Date-dimension attributes of a ``full_date`` column (GLD-2)."""
    d = F.col("full_date")
    return days.select(
        D.date_key(d).alias("date_sk"),
        d,
        F.year(d).alias("year_num"),
        F.quarter(d).alias("quarter_num"),
        F.month(d).alias("month_num"),
        D.month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day_num"),
        D.day_name(d).alias("day_name"),
        D.us_week(d).alias("week_num"),
        D.is_weekend(d).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = REFERENCE_START,
             end: str = REFERENCE_END) -> DataFrame:
    return date_columns(calendar(spark, start, end))
