"""Exact quantile cuts and NTILE by counting passes (WN-4, MRT-1).

``NTILE(n) OVER (ORDER BY v, tie)`` needs no rank: with N rows, tile t ends at a rank known from
N alone, so n - 1 cut tuples decide every row's tile. The tuple at a rank is found by selection,
many ranks and many measures at once: every open rank has a range of values that holds it; a pass
counts the rows of each range in ``SPLIT`` equal parts and keeps the part with the rank. Once a
range is one value, the rows with that value are narrowed by the tie column in the same way. When
few rows are left in all ranges together (``FINISH``, a bound and not a share of the data), these
are read and the ranks picked. Each pass is one aggregate without a shuffle of rows; what reaches
the driver is ``SPLIT`` counts a range. 64-bit values need seven passes at most, usually two.

Ordered columns are whole numbers, decimals of up to 18 digits, dates or timestamps; NULL is an
error, as is a cut that falls between rows equal in value and tie.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.numbering import staged

SPLIT = 1024
FINISH = 20_000


def ordered_long(df: DataFrame, name: str) -> Column:
    """A BIGINT in the same order as column ``name``."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (c.cast(f"decimal(38,{kind.scale})") * F.lit(10 ** kind.scale).cast("decimal(19,0)")).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    raise TypeError(f"{name}: no exact cuts over {kind.simpleString()}")


@dataclass(frozen=True)
class _Open:
    """A rank being looked for: the ``left``-th row (from 1) of those with low <= x <= high, where x
    is the measure, or the tie column among rows whose measure is ``value``."""
    measure: str
    rank: int
    left: int
    low: int
    high: int
    value: int | None = None

    @property
    def width(self) -> int:
        return -(-(self.high - self.low + 1) // SPLIT)


def select_ranks(df: DataFrame, measures: list[str], tie: str, ranks: dict[str, list[int]], spans: dict[str, tuple[int, int]]) -> dict[tuple[str, int], tuple[int, int]]:
    """{(measure, rank): (measure value, tie value)} of BIGINT columns, ranks from 1 by (measure, tie)
    among the rows whose measure is not NULL.
    ``spans`` has the least and greatest value of every column."""
    open_ = [_Open(m, r, r, *spans[m]) for m in measures for r in ranks[m]]
    found: dict[tuple[str, int], tuple[int, int]] = {}
    while open_:
        # ranks that share a range share its counts
        ranges = sorted({(o.measure, o.value is not None, o.value or 0, o.low, o.high, o.width) for o in open_})
        parts = []
        for i, (m, fixed, value, low, high, width) in enumerate(ranges):
            x = F.col(tie) if fixed else F.col(m)
            inside = x.between(low, high) & (F.col(m) == value) if fixed else x.between(low, high)
            # the distance can pass BIGINT
            x, low, width = (c.cast("decimal(20,0)") if high - low >= 2**63 else c.cast("long") for c in (x, F.lit(low), F.lit(width)))
            parts.append(F.when(inside, F.struct(F.lit(i).alias("i"), F.call_function("div", x - low, width).cast("int").alias("p"))))
        cells = df.select(F.explode(F.filter(F.array(*parts), lambda s: s.isNotNull())).alias("s")).groupBy("s.i", "s.p").count().collect()
        counts: dict[int, list[tuple[int, int]]] = {}
        for c in cells:
            counts.setdefault(c["i"], []).append((c["p"], c["count"]))
        narrowed, rows_left = [], 0
        for o in open_:
            low, left = o.low, o.left
            for p, n in sorted(counts[ranges.index((o.measure, o.value is not None, o.value or 0, o.low, o.high, o.width))]):
                if left <= n:
                    low = o.low + p * o.width
                    break
                left -= n
            rows_left += n
            o = replace(o, left=left, low=low, high=min(o.high, low + o.width - 1))
            if o.low < o.high:
                narrowed.append(o)
            elif o.value is None:  # one value is left: its rows by the tie column
                narrowed.append(replace(o, value=o.low, low=spans[tie][0], high=spans[tie][1]))
            elif n > 1:
                raise ValueError(f"a cut of {o.measure!r} falls between rows that are equal in it and in {tie!r}")
            else:
                found[o.measure, o.rank] = o.value, o.low
        open_ = narrowed
        if open_ and rows_left <= FINISH:
            found |= _picked(df, open_, tie)
            break
    return found


def _picked(df: DataFrame, open_: list[_Open], tie: str) -> dict[tuple[str, int], tuple[int, int]]:
    """The rows of all open ranges (few) and the ranks among them."""
    def inside(o: _Open) -> Column:
        return F.col(o.measure).between(o.low, o.high) if o.value is None else (F.col(o.measure) == o.value) & F.col(tie).between(o.low, o.high)

    want = F.lit(False)
    for o in open_:
        want = want | inside(o)
    columns = sorted({o.measure for o in open_} | {tie})
    rows, found = df.where(want).select(*columns).collect(), {}
    for o in open_:
        here = sorted((r[o.measure], r[tie]) for r in rows if r[o.measure] is not None
                      and (o.low <= r[o.measure] <= o.high if o.value is None else r[o.measure] == o.value and o.low <= r[tie] <= o.high))
        found[o.measure, o.rank] = here[o.left - 1]
        if o.left < len(here) and here[o.left - 1] == here[o.left]:
            raise ValueError(f"a cut of {o.measure!r} falls between rows that are equal in it and in {tie!r}")
    return found


def tile_ends(total: int, n: int) -> list[int]:
    """Rank of the last row of each tile but the last, as NTILE deals ``total`` rows."""
    q, r = divmod(total, n)
    return [t * q + min(t, r) for t in range(1, n)]


def global_ntiles(df: DataFrame, tiles: dict[str, tuple[str, str]], n: int, tie: str) -> DataFrame:
    """Adds for each name of ``tiles`` = {name: (column, "asc" | "desc")} NTILE(n) OVER (ORDER BY column,
    tie), both descending for "desc". The input is written once; its rows are never shuffled."""
    cols = {c: f"_o{i}" for i, c in enumerate(dict.fromkeys([tie, *(c for c, _ in tiles.values())]))}
    keyed = staged(df.select("*", *[ordered_long(df, c).alias(o) for c, o in cols.items()]), "ntile")
    seen = keyed.agg(F.count(F.lit(1)).alias("n"), *[f(o).alias(f"{o}{k}") for o in cols.values() for k, f in (("n", F.count), ("a", F.min), ("b", F.max))]).first()
    total, spans = seen["n"], {o: (seen[f"{o}a"], seen[f"{o}b"]) for o in cols.values()}
    missing = [c for c, o in cols.items() if seen[f"{o}n"] < total]
    if missing:
        raise ValueError(f"NULL in the order columns {', '.join(missing)}")
    ends = tile_ends(total, n)
    # the first rows of a descending order are the last of the ascending one
    wanted = {name: [e if way == "asc" else total - e for e in ends if e < total] for name, (_, way) in tiles.items()}
    ranks: dict[str, list[int]] = {}
    for name, (c, _) in tiles.items():
        ranks[cols[c]] = sorted({*ranks.get(cols[c], []), *(w for w in wanted[name] if w > 0)})
    cuts = select_ranks(keyed, list(ranks), cols[tie], ranks, spans)
    out, t = keyed, F.col(cols[tie])
    for name, (c, way) in tiles.items():
        v, tile = F.col(cols[c]), F.lit(1)
        for rank in (w for w in wanted[name] if w > 0):
            cv, ck = (F.lit(x).cast("long") for x in cuts[cols[c], rank])
            above = (v > cv) | ((v == cv) & (t > ck))
            tile = tile + (above if way == "asc" else ~above).cast("int")
        out = out.withColumn(name, tile.cast("int"))
    return out.drop(*cols.values())
