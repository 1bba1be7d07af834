"""Data-quality rules (DQ-1..14).

A rule is a named boolean "bad row" predicate; :func:`checks` evaluates any
number of them in **one** aggregate pass (``count_if`` per rule) and returns
one row per rule: ``rule, n_rows, n_bad``. Grouped checks (duplicate keys,
functional dependencies, orphans) are their own small aggregates/joins.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.text import untrimmed


@dataclass(frozen=True)
class Rule:
    name: str
    bad: Column


def checks(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One pass over ``df``: rows and violating rows per rule, as rows (unpivoted with ``stack``)."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.sum(F.when(r.bad, 1).otherwise(0)).alias(f"_r{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{r.name}', CAST(_r{i} AS BIGINT)" for i, r in enumerate(rules))
    return wide.selectExpr("_n AS n_rows", f"stack({len(rules)}, {pairs}) AS (rule, n_bad)") \
        .select("rule", "n_rows", F.coalesce("n_bad", F.lit(0)).alias("n_bad"))


def null_rules(cols: list[str]) -> list[Rule]:
    """DQ-3: one rule per required column."""
    return [Rule(f"null:{c}", F.col(c).isNull()) for c in cols]


def untrimmed_rules(cols: list[str]) -> list[Rule]:
    """DQ-4."""
    return [Rule(f"untrimmed:{c}", untrimmed(c)) for c in cols]


def range_rule(name: str, col: str, lo=None, hi=None) -> Rule:
    """DQ-8 / FIL-12: value below ``lo`` or above ``hi``."""
    c = F.col(col)
    conds = []
    if lo is not None:
        conds.append(c < lo)
    if hi is not None:
        conds.append(c > hi)
    return Rule(name, reduce(lambda a, b: a | b, conds))


def order_rules(pairs: list[tuple[str, str]]) -> list[Rule]:
    """DQ-9: ``a > b`` violations for each (earlier, later) pair; NULLs do not count."""
    return [Rule(f"{a}>{b}", F.col(a) > F.col(b)) for a, b in pairs]


def domain_rule(name: str, col: str, allowed: list) -> Rule:
    """DQ-7: value outside the allowed set (NULL is not a violation)."""
    return Rule(name, ~F.col(col).isin(*allowed))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """DQ-1/DQ-2: keys occurring at least twice, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 2)


def key_cardinality(df: DataFrame, cols: list[str]) -> DataFrame:
    """DQ-10: total rows and distinct (non-NULL) values of each column.

    Several ``countDistinct`` in one aggregate plan as an ``Expand`` that copies
    every row once per column before the shuffle. Instead each column is its own
    ``distinct`` (combined map-side, so a hot value costs one row per task) that
    reads only that Parquet column; the one-row results are folded together."""
    parts = [df.agg(F.lit("n_rows").alias("_m"), F.count(F.lit(1)).alias("_v"))]
    for c in cols:
        parts.append(df.filter(F.col(c).isNotNull()).select(c).distinct()
                     .agg(F.lit(f"n_distinct_{c}").alias("_m"), F.count(F.lit(1)).alias("_v")))
    names = ["n_rows"] + [f"n_distinct_{c}" for c in cols]
    return reduce(DataFrame.unionByName, parts) \
        .agg(*[F.max(F.when(F.col("_m") == m, F.col("_v"))).alias(m) for m in names])


def fd_violations(df: DataFrame, determinant: str, dependent: Column, name: str = "n_values") -> DataFrame:
    """DQ-11: determinant values mapped to more than one dependent value."""
    return (df.groupBy(determinant).agg(F.countDistinct(dependent).alias(name))
            .filter(F.col(name) > 1))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """DQ-12: child rows whose key has no parent row (``left_anti``)."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def domain(df: DataFrame, col: str) -> DataFrame:
    """DQ-5/DQ-6: the distinct values of a (low-cardinality) column with counts."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame) -> DataFrame:
    """DQ-14: per column — type, non-null count, null count — in one aggregate pass."""
    fields = df.schema.fields
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count(F.col(f.name)).alias(f"_c{i}") for i, f in enumerate(fields)])
    pairs = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', _c{i}"
                      for i, f in enumerate(fields))
    return (wide.selectExpr("_n", f"stack({len(fields)}, {pairs}) AS (column_name, data_type, non_null)")
            .select("column_name", "data_type", F.col("non_null").cast("long").alias("non_null"),
                    (F.col("_n") - F.col("non_null")).cast("long").alias("n_null")))
