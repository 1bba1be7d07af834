"""Top-k reports (SO-1..4).

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task keeps
its own k best rows and only k rows per task move — no full sort, no global
shuffle. Callers pass a unique tie-break as the last key so the report is
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)


def ranked_top_k(df: DataFrame, k: int, order: list[Column], label: str,
                 label_col: str = "ranking") -> DataFrame:
    """Top-k with its rank (1..k) and a label, so several reports can be unioned."""
    top = df.orderBy(*order).limit(k)
    rk = F.row_number().over(_w(order))
    return top.withColumn("rank", rk).withColumn(label_col, F.lit(label))


def _w(order: list[Column]):
    from pyspark.sql import Window
    return Window.orderBy(*order)


def tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Last ``n`` rows by the ascending ``order`` columns (pandas ``tail``): a top-n
    on the reversed order, so only n rows per task move."""
    return df.orderBy(*[F.col(c).desc_nulls_first() for c in order]).limit(n)
