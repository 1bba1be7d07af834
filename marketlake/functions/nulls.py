"""NULL-handling expressions (CLN-5, CLN-6, SC-22, SC-23)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the "missing" marker a bigint source column may carry.
LONG_MIN_SENTINEL = -9223372036854775808


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_sentinel(c, sentinel: int = LONG_MIN_SENTINEL) -> Column:
    """NULL where the value is the min-bigint sentinel. Apply before any arithmetic:
    multiplying the sentinel overflows."""
    return F.when(_c(c) != F.lit(sentinel).cast("long"), _c(c))


def null_if_negative(c) -> Column:
    return F.when(_c(c) >= 0, _c(c))


def null_if_nonpositive(c) -> Column:
    return F.when(_c(c) > 0, _c(c))


def eq_flag(a, b) -> Column:
    """1 where ``a == b``; a NULL operand counts as not equal (0)."""
    return F.coalesce(_c(a) == _c(b), F.lit(False)).cast("int")


def ne_flag(a, b) -> Column:
    """1 where ``a != b``; a NULL operand counts as different (1)."""
    return F.coalesce(_c(a) != _c(b), F.lit(True)).cast("int")
