"""Deduplication and canonicalisation (CLN-9, CLN-10, CLN-11, WN-1, WN-2).

Key dedupe and majority selection are written as aggregations over a
``struct`` (``min(struct(...))``) rather than a ``row_number`` window:
the aggregate combines map-side before the shuffle, so one key that holds
a third of all rows collapses to one row per task instead of landing in a
single sort-and-scan task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Keep one copy of rows equal on ``cols`` (default: every column). NULLs compare equal."""
    return df.dropDuplicates(cols) if cols else df.dropDuplicates()


def dedupe_by_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order_by`` (default: all other
    columns, ascending, NULLs first), so the winner is deterministic."""
    others = [c for c in df.columns if c not in keys]
    order = order_by or others
    carry = order + [c for c in others if c not in order]
    picked = (df.groupBy(*keys)
              .agg(F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                                  *[F.col(c) for c in carry[len(order):]])).alias("_w")))
    return picked.select(*keys, *[F.col(f"_w._o{i}").alias(c) for i, c in enumerate(order)],
                         *[F.col(f"_w.{c}") for c in carry[len(order):]]).select(*df.columns)


def majority_row(df: DataFrame, key: str, group_cols: list[str], aggs: dict[str, Column],
                 count_name: str = "cnt") -> DataFrame:
    """Group by ``key`` + ``group_cols`` with ``aggs`` and a row count, then keep, per
    ``key``, the group with the largest count (ties: smallest ``group_cols``)."""
    grouped = df.groupBy(key, *group_cols).agg(F.count(F.lit(1)).alias(count_name),
                                                *[v.alias(k) for k, v in aggs.items()])
    payload = [F.col(c) for c in group_cols] + [F.col(k) for k in aggs] + [F.col(count_name)]
    best = grouped.groupBy(key).agg(
        F.min(F.struct((-F.col(count_name)).alias("_neg"), *payload)).alias("_w"))
    return best.select(key, *[F.col(f"_w.{c}") for c in group_cols + list(aggs) + [count_name]])
