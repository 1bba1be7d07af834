"""Global ranks without a one-task window (WN-3 surrogate keys, WN-4 NTILE).

* :func:`global_row_number` and :func:`surrogate_key` sort over range partitions, write the sorted
  rows once and add to each row's place the count of the partitions before its own
  (:mod:`marketlake.operators.numbering`). No bound, offset or sample is part of the plan, and
  nothing of the rows reaches the driver beyond what Spark's own range sort samples.
* :func:`line_numbers` numbers the lines of many groups whose own numbers are known, by the same
  sort: lines move once and are written once, numbered.
* :func:`global_ntile` compares rows with exact cut tuples (:mod:`marketlake.operators.quantiles`);
  rows are not ranked or moved at all.

NULL in an order column is an error. Rows that tie get different numbers, fixed once written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.numbering import numbered
from marketlake.operators.quantiles import global_ntiles

#: No longer read: the sort splits a group of very many lines by itself.
LINE_BLOCK = 4096


def global_row_number(df: DataFrame, order_cols: list[str], name: str = "rn", descending: bool = False) -> DataFrame:
    """Adds ``name`` = 1..N in the order of ``order_cols`` (all descending with ``descending``)."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in order_cols])
    first = F.when(missing, F.raise_error(F.lit(f"NULL in the order columns of {name}"))).otherwise(F.col(order_cols[0]))
    keys = [first, *(F.col(c) for c in order_cols[1:])]
    return numbered(df, [k.desc() if descending else k.asc() for k in keys], name)


def surrogate_key(df: DataFrame, order_cols: list[str], name: str) -> DataFrame:
    """Dense 1..N surrogate key by natural-key order."""
    return global_row_number(df, order_cols, name)


def line_numbers(lines: DataFrame, group_key: str, line_col: str, order_cols: list[str], name: str) -> DataFrame:
    """Adds ``name`` = 1..N over all lines by (``group_key``, ``line_col``, ``order_cols``).

    The lines are sorted over range partitions and written once with their numbers, so every reader
    finds them numbered; a group of very many lines is split by the later columns of the order."""
    return numbered(lines, [group_key, line_col, *order_cols], name)


def ntile_expr(rn: Column, total: int, n: int) -> Column:
    """``NTILE(n)`` from a 1-based global row number over ``total`` rows."""
    q, r = divmod(total, n)
    if q == 0:
        return rn.cast("int")
    big = r * (q + 1)
    rn = rn.cast("long")
    div = lambda a, b: F.call_function("div", a, F.lit(b).cast("long"))
    return F.when(rn <= big, div(rn - 1, q + 1) + 1) \
        .otherwise(div(rn - big - 1, q) + r + 1).cast("int")


def global_ntile(df: DataFrame, n: int, order_cols: list[str], name: str, descending: bool = False) -> DataFrame:
    """Add ``name`` = NTILE(n) OVER (ORDER BY order_cols): a measure and its tie-break."""
    measure, tie = order_cols
    return global_ntiles(df, {name: (measure, "desc" if descending else "asc")}, n, tie)
