"""Descriptive statistics (AG-16..20, DQ-14 helpers).

Everything is an aggregate that Spark combines map-side; the only values
that reach the driver are O(1) scalars (a min and a max for the histogram).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """AG-16: frequency of each value, most frequent first (ties by value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(col).asc_nulls_first()))


def equal_width_histogram(df: DataFrame, col: str, bins: int, scale: int = 2) -> DataFrame:
    """AG-20: equal-width bins over [min, max]; the maximum falls in the last bin.

    Values are fixed-point with ``scale`` decimals (money), so the bin index
    is computed exactly with integer division: ``1 + (v-min)*bins div (max-min)``,
    clamped to ``bins``. Output: bin, lower edge, upper edge, count.
    """
    values = df.select((F.col(col) * (10 ** scale)).cast("long").alias("_u")).filter(F.col("_u").isNotNull())
    # the two bounds are scalar subqueries of the same lazy plan
    lo, hi = values.agg(F.min("_u")).scalar(), values.agg(F.max("_u")).scalar()
    at = F.call_function("div", (F.col("_u") - F.col("_lo")) * bins, F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1)))
    counted = values.withColumn("_lo", lo).withColumn("_hi", hi) \
        .withColumn("bin", F.least(F.lit(bins).cast("long"), at + 1)) \
        .groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    f = float(10 ** scale)
    edge = lambda k: (F.col("_lo") + (k * (F.col("_hi") - F.col("_lo"))).cast("double") / bins) / f
    return counted.select(F.col("bin").cast("int").alias("bin"), edge(F.col("bin") - 1).alias("bin_low"),
                          edge(F.col("bin")).alias("bin_high"), "n")


def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    """AG-19: Pearson correlation of every column pair (pairwise-complete: a
    row counts for a pair when both values are non-NULL), one aggregate pass.
    Long form: col_a, col_b, corr (diagonal = 1)."""
    pairs = list(combinations(cols, 2))
    aggs = [F.corr(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)]
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).agg(*aggs)
    rows = [f"'{a}', '{b}', _c{i}" for i, (a, b) in enumerate(pairs)]
    rows += [f"'{b}', '{a}', _c{i}" for i, (a, b) in enumerate(pairs)]
    rows += [f"'{c}', '{c}', CAST(1.0 AS DOUBLE)" for c in cols]
    long = wide.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (col_a, col_b, corr)")
    f = float(10 ** digits)
    rounded = F.floor(F.col("corr") * f + 0.5) / f
    return long.select("col_a", "col_b", rounded.alias("corr"))


def pivot_counts(df: DataFrame, row: str, col: str, values: list, value: Column,
                 prefix: str = "m") -> DataFrame:
    """AG-18: ``row`` x ``col`` matrix of ``first(value)`` with explicit column values
    (so the plan does not need a distinct-values job and the schema is stable)."""
    out = df.groupBy(row).pivot(col, values).agg(F.first(value))
    return out.select(row, *[F.col(str(v)).alias(f"{prefix}{v}") for v in values])
