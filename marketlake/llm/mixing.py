"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

A source's size is the number of words of its documents. The sources share the corpus total (or
``budget`` words) in proportion to their weights; a source that would get more than ``epochs``
times its size is clamped there and its excess goes to the others by weight, until no source is
above its clamp. The clamped set only grows, so a round is one aggregate over the source table
with the numbers of the round before; a handful of rounds reach the end.

A target is met by whole repetitions of every document of the source, then by one repetition
more of some: documents in the order of a seeded digest, as many as fill the rest. The digest at
which the rest is full is found digit by digit: words per leading digit of each source are summed,
the digit where the sum passes the rest is kept, and only its documents are looked at again. So
no source, however large, is sorted or windowed in one task. The document that the border runs
through is taken if that comes nearer to the target: a source is off by half a document at most.

Defined results: a null text has no words; null is a source of its own, the last; sources of
size 0 get target 0; documents without words are taken 0 times. Rows that repeat an id are
documents of their own, and of rows equal in id, text and size any may be the one that a
fractional repetition takes, so reruns give the same rows. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import SPACE_CLASS, staged
from marketlake.operators.numbering import numbered

#: Hex digits of the order key looked at per pass: 4096 sums a source.
DIGITS = 3
#: The key: 32 hex digits of the seeded digest, then 16 of the row's number for equal rows.
KEY_DIGITS = 48
_WHOLE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    single = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+", " "))
    blanks = F.length(single) - F.length(F.replace(single, F.lit(" "), F.lit("")))
    return F.when(single == "", 0).otherwise(blanks + 1).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), epochs: int = 3, budget: int | None = None) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row a source.

    Sources in code-point order, null last, weigh ``weights``, repeating. ``budget``: words to
    share; None for the total of all sizes. A budget above ``epochs`` times the total clamps all."""
    named = numbered(sizes, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long")
    rows = staged(named.select("source", "source_size", weight.alias("weight")), "mix-sources")
    cap = F.col("source_size").cast("decimal(18,0)") * epochs
    seen = rows.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total = (seen["size"] or 0) if budget is None else budget
    clamped, left = 0, seen["weight"] or 0
    while True:
        # above the clamp: (total - clamped) / left * weight > cap, in whole numbers
        above = F.lit(total - clamped).cast("decimal(19,0)") * F.col("weight").cast("decimal(18,0)") > cap.cast("decimal(19,0)") * F.lit(left).cast("decimal(18,0)")
        now = rows.agg(F.sum(F.when(above, cap)).alias("clamped"), F.sum(F.when(~above, F.col("weight"))).alias("left")).first()
        state = int(now["clamped"] or 0), int(now["left"] or 0)
        if state == (clamped, left) or not state[1]:
            break
        clamped, left = state
    share = F.lit(float(total - clamped)) / F.lit(float(left or 1)) * F.col("weight").cast("double")
    return rows.withColumn("target", F.when(above, cap.cast("double")).otherwise(share))


def _borders(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, border, with_border): documents of a source whose key is below the border get the
    fractional repetition, and the one at the border if ``with_border``. ``rest`` in ``plan`` is
    what the fractional repetitions of a source have to fill, in words."""
    open_, done = staged(plan.select("source", "rest", F.lit("").alias("border"), F.lit(0).cast("long").alias("before")), "mix-open"), []
    for at in range(1, KEY_DIGITS + 1, DIGITS):
        side = open_.select(F.col("source").alias("s"), "rest", "border", F.col("before").alias("base"))
        here = rows.join(side, F.col("source").eqNullSafe(F.col("s"))).where(F.substring("key", 1, at - 1) == F.col("border"))
        cells = here.groupBy("source", "rest", "border", "base", F.substring("key", at, DIGITS).alias("digit")) \
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("digit"))  # 4096 rows a source at most
        passed = cells.withColumn("before", F.col("base") + upto - F.col("words")) \
            .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))) \
            .select("source", "rest", F.concat("border", "digit").alias("border"), "before", "words", "docs")
        passed = staged(passed, "mix-cells")
        done.append(passed.where("docs = 1").select("source", "border", (2 * (F.col("rest") - F.col("before")) >= F.col("words")).alias("with_border")))
        open_ = passed.where("docs > 1").select("source", "rest", "border", "before")
        if open_.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), epochs: int = 3, seed: str = "mix", budget: int | None = None,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: id, size, source_size, target (of its source) and taken, the words the
    mix takes of it: its size times its repetitions (0 to ``epochs``)."""
    text = F.col(text_col)
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string"), text).cast("binary"))
    number = F.lpad(F.lower(F.hex(F.monotonically_increasing_id())), KEY_DIGITS - 32, "0")
    rows = staged(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text).alias("size"),
                              F.concat(digest, number).alias("key")), "mix-rows")
    targets = staged(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs, budget), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long")
    plan = targets.withColumn("whole", whole).withColumn(
        "rest", F.when(F.col("whole") < epochs, F.col("target") - F.col("whole") * F.col("source_size")).otherwise(0.0))
    borders = _borders(rows, plan).withColumnRenamed("source", "s")
    plan = plan.join(borders, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("of"), "source_size", "target", "whole",
        # no document passes the rest: it is nothing, or all of the source
        F.coalesce("border", F.when(F.col("rest") > 0, F.lit("g")).otherwise(F.lit(""))).alias("border"),
        F.coalesce("with_border", F.lit(False)).alias("with_border"))
    plan = staged(plan, "mix-plan")
    head = F.substring(F.col("key"), F.lit(1), F.length("border"))
    once_more = (head < F.col("border")) | ((head == F.col("border")) & F.col("with_border"))
    return rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * (F.col("whole") + once_more.cast("long"))).alias("taken"))


ORACLE = r"""
WITH rows_ AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat_ws('|', 'mix', doc_id, text)) AS key FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM rows_ GROUP BY source),
-- sources by how soon the water reaches their cap: those capped come first
filling AS (
  SELECT *, (SELECT sum(source_size) FROM sources) AS total,
         coalesce(sum(3 * source_size) OVER before_, 0) AS capped, sum(weight) OVER rest_ AS open_weight
  FROM sources
  WINDOW before_ AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest_ AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
judged AS (SELECT *, (total - capped)::HUGEINT * weight > 3 * source_size::HUGEINT * open_weight AS is_capped FROM filling),
level AS (SELECT max(total) AS total, coalesce(sum(CASE WHEN is_capped THEN 3 * source_size END), 0) AS capped,
                 sum(CASE WHEN NOT is_capped THEN weight END) AS open_weight FROM judged),
targets AS (
  SELECT source, source_size, CASE WHEN is_capped THEN (3 * source_size)::DOUBLE
         ELSE (level.total - level.capped)::DOUBLE / level.open_weight::DOUBLE * weight::DOUBLE END AS target
  FROM judged, level),
quotas AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size)) ELSE 0 END AS whole FROM targets),
rests AS (SELECT *, CASE WHEN whole < 3 THEN target - whole * source_size ELSE 0 END AS rest FROM quotas),
placed AS (
  SELECT rows_.*, rests.* EXCLUDE (source),
         sum(size) OVER (PARTITION BY rows_.source ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto
  FROM rows_ JOIN rests ON rows_.source IS NOT DISTINCT FROM rests.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN upto <= rest OR (upto - size <= rest AND 2 * (rest - upto + size) >= size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
