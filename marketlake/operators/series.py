"""Per-series window features (WN-6, WN-7, ML-10) that split long series.

The rows of all series are sorted by (series, order) over range partitions and numbered; runs of
``block`` rows are the unit of work. A row's lags and rolling means reach back a known number of
rows, so the last rows of a run travel to the next one too as *halo* rows: windows see them, the
result doesn't. A series as long as all others together is as many tasks as it has runs, and
short series share them. Lags are row-based (the k-th previous *row*), as a pandas ``shift``.

Rows of a series that tie in ``order`` keep the order they were written in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.numbering import numbered

#: Rows of a run.
BLOCK = 100_000


def series_features(df: DataFrame, key: str, order: str, col: str, lags: Sequence[int] = (), rolling: Sequence[int] = (),
                    include_current: bool = True, lag_prefix: str | None = None, roll_prefix: str | None = None, block: int = BLOCK) -> DataFrame:
    """Adds ``{col}_lag{k}`` for each of ``lags`` and ``{col}_roll{n}``, the mean of the last n rows,
    for each of ``rolling``: NULL until the series has that many rows, as pandas ``rolling(n).mean()``.
    ``include_current=False`` ends the means one row before (no target leakage)."""
    last = 0 if include_current else -1
    reach = max([0, *lags, *(n - 1 - last for n in rolling)])
    block = max(block, reach)
    at = numbered(df, [F.col(key).asc_nulls_first(), order], "_nr")
    run, place = F.call_function("div", F.col("_nr") - 1, F.lit(block).cast("long")), (F.col("_nr") - 1) % block
    rows = at.withColumn("_run", run).withColumn("_halo", F.lit(False))
    halo = at.where(place >= block - reach).withColumn("_run", run + 1).withColumn("_halo", F.lit(True))
    w = Window.partitionBy(key, "_run").orderBy("_nr")
    new = {f"{lag_prefix or f'{col}_lag'}{k}": F.lag(col, k).over(w) for k in lags}
    for n in rolling:
        frame = w.rowsBetween(1 - n + last, last)
        # sum / n (an exact decimal sum for money) rather than avg, whose decimal
        # result would be rounded to a fixed scale first
        new[f"{roll_prefix or f'{col}_roll'}{n}"] = F.when(F.count(col).over(frame) == n, F.sum(col).over(frame).cast("double") / n)
    return rows.union(halo).select("*", *[c.alias(name) for name, c in new.items()]).where("not _halo").drop("_nr", "_run", "_halo")


def add_lags(df: DataFrame, key: str, order: str, col: str, lags: Sequence[int], prefix: str | None = None) -> DataFrame:
    return series_features(df, key, order, col, lags=lags, lag_prefix=prefix)


def add_rolling_means(df: DataFrame, key: str, order: str, col: str, sizes: Sequence[int],
                      include_current: bool = True, prefix: str | None = None) -> DataFrame:
    return series_features(df, key, order, col, rolling=sizes, include_current=include_current, roll_prefix=prefix)


def chronological_split(df: DataFrame, key: str | None, order: str, train_frac: float = 0.8,
                        name: str = "is_train") -> DataFrame:
    """ML-10: the first ``floor(train_frac * n)`` rows of each series (by ``order``) train; without a
    ``key`` the whole frame is one series. A row's place is its number over all series less the
    first number of its own."""
    series = F.lit(0) if key is None else F.col(key)
    at = numbered(df.withColumn("_series", series), [F.col("_series").asc_nulls_first(), order], "_nr")
    spans = at.groupBy("_series").agg(F.min("_nr").alias("_first"), F.count(F.lit(1)).alias("_n")).withColumnRenamed("_series", "_of")
    cut = F.col("_nr") - F.col("_first") < F.floor(F.col("_n") * train_frac)
    return at.join(spans, F.col("_series").eqNullSafe(F.col("_of"))).withColumn(name, cut.cast("int")) \
        .drop("_series", "_of", "_nr", "_first", "_n")
