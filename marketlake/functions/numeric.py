"""Exact money and rate arithmetic.

Money is held as ``decimal(18,2)`` (the warehouse's type), so sums are exact
and independent of how rows are split across partitions. Means and
percentages are rounded half away from zero with *integer* division on the
unscaled values, which makes them bit-identical no matter the engine or the
aggregation order (a float mean of 1.00 and 1.01 would round either way).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
WHOLE = "decimal(38,0)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Cast a float amount to ``decimal(18,2)`` (half-up on the shortest decimal form)."""
    return _c(c).cast(MONEY)


def unscaled(c, scale: int = 2) -> Column:
    """Decimal with ``scale`` places as its integer count of 10^-scale units (``decimal(38,0)``,
    so that sums past 9e16 units hold)."""
    return (_c(c) * (10 ** scale)).cast(WHOLE)


def _idiv(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def half_up_ratio(num, den, scale: int = 2, mult: int = 1, num_scale: int = 0) -> Column:
    """``round(num * mult / den, scale)`` exactly, half away from zero, as double.

    ``num`` is an integral column already scaled by 10^num_scale (use
    :func:`unscaled` for money sums); ``den`` a positive integral count.
    NULL when ``den`` is 0 or NULL.
    """
    num, den = _c(num).cast(WHOLE), _c(den).cast(WHOLE)
    # value = num * mult / (den * 10^num_scale); keep `scale` digits
    up = 10 ** scale

    def times(c: Column, k: int) -> Column:
        return (c * F.lit(k)).cast(WHOLE) if k != 1 else c

    scaled_num = times(F.abs(num), 2 * mult * 10 ** max(0, scale - num_scale))
    scaled_den = times(den, 10 ** max(0, num_scale - scale))
    q = _idiv((scaled_num + scaled_den).cast(WHOLE), times(scaled_den, 2))
    signed = F.when(num < 0, -q).otherwise(q)
    return F.when(den > 0, signed.cast("double") / up)


def money_mean(sum_money, count) -> Column:
    """Mean of a money column from its exact decimal sum and row count, 2 places."""
    return half_up_ratio(unscaled(sum_money), count, scale=2, num_scale=2)
