"""Dense numbers and running totals without a one-task window.

:func:`numbered` sorts once over Spark's range partitions and writes the sorted rows; a row's
number is the count of rows in earlier partitions plus its place in its own. The counts, one per
partition, are added up once and joined as a small table.

:func:`running_totals` adds up a value over a dense integer key by a tree of partial sums: keys
fall into blocks of ``fan`` neighbours, block totals into blocks of blocks, until one block is
left. No task sees more than ``fan`` rows of a block, and nothing but the row count of a level
reaches the driver.
"""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import ensure_checkpoint_dir, held_settings

#: monotonically_increasing_id() keeps the row's place in the low 33 bits, the partition above.
_PLACE_BITS = 33


#: While a table is written: the shuffle files of its plan go as soon as it is there, and a skewed
#: join is split even where the step after it must then be dealt out anew.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back (cuts the lineage). What its
    plan shuffled is not needed any more and goes."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    with held_settings(df.sparkSession, WRITING):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """Adds ``name`` = 1..N in the order of ``order`` (rows that tie get numbers in any order).

    NULLs come where ``order`` puts them. The rows are written once, sorted; hot leading values
    are split by the later order columns."""
    at = staged(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    at = at.withColumn("_part", F.shiftrightunsigned("_at", _PLACE_BITS))
    # one number per partition of the sort, at most spark.sql.shuffle.partitions of them
    parts = sorted((r[0], r[1]) for r in at.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).collect())
    before = accumulate((rows for _, rows in parts), initial=0)
    starts = df.sparkSession.createDataFrame([(part, start) for (part, _), start in zip(parts, before)], "_part long, _start long")
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return at.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + place + 1).drop("_part", "_at", "_start")


def running_totals(df: DataFrame, key: str, value: str, name: str, fan: int = 4096) -> DataFrame:
    """(``key``, ``name``): the sum of ``value`` over all smaller keys. ``key`` is a unique dense
    BIGINT, or nearly so: gaps only make blocks smaller."""
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(value).cast("long").alias("v"))
    block = F.call_function("div", F.col("k"), F.lit(fan)).cast("long")
    before = Window.partitionBy("b").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    level = staged(rows.withColumn("b", block).withColumn("s", F.coalesce(F.sum("v").over(before), F.lit(0))), f"{name}-level")
    out = level.select("k", "b", "s")
    totals = level.groupBy("b").agg(F.sum("v").alias("v"))
    if totals.count() > 1:
        upper = running_totals(totals, "b", "v", name, fan).withColumnRenamed(name, "_above")
        out = out.join(upper, "b").withColumn("s", F.col("s") + F.col("_above"))
    return out.select(F.col("k").alias(key), F.col("s").alias(name))
