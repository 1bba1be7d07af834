"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into segments: whole items up to ``segment`` characters, else windows of
that length every half of it; and dense windows of ``quote`` characters every ``quote_step``, so
that an exact quote of quote + quote_step - 1 characters holds one wherever it starts. A place in a document within e edits of a segment of length m
shares at least m + 1 - q * (e + 1) of its character q-grams, and all of them on diagonals
(place in the document minus place in the segment) that differ by at most e. So q-gram hits
are counted in overlapping bands of diagonals; a band that reaches the bound marks a region, and
only regions are aligned, by banded dynamic programming, to find the edits. Within the budget
the document holds the segment. The lemma is exact, so no place within the budget of a segment is missed.

Both sides are compared in lower case with every run of white space as one blank. Items with
fewer than ``2 * q`` characters match without edits only and not inside a longer word (Chinese,
Japanese and Korean have no blanks, so there they match anywhere).

The benchmark is the query set: it is taken in blocks of at most ``block_chars`` characters,
each small enough to broadcast, and every block is held against all documents in one pass
without a shuffle. Null texts match nothing; null items are skipped; repeated rows of documents
give repeated results, repeated items one result each; other columns are ignored; empty tables
give empty results.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import map_batches, window_hash


@dataclass(frozen=True)
class Budget:
    q: int = 10
    rate: float = 0.08  # edits per character of a segment
    segment: int = 160
    block_chars: int = 2_000_000
    quote: int = 60
    quote_step: int = 10

    def edits(self, m: int) -> int:
        """Edits allowed in a segment of length m: at the rate, and so that the bound is at least 1."""
        return max(0, min(int(self.rate * m), m // self.q - 1))

    def bound(self, m: int) -> int:
        return m + 1 - self.q * (self.edits(m) + 1)


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def segments(text: str, budget: Budget) -> Iterator[str]:
    """The windows of a normalised item; the last one of each length ends with the item."""
    n, sizes = len(text), [(budget.segment, budget.segment // 2), (budget.quote, budget.quote_step)]
    if n <= budget.segment:
        yield text
    for size, step in sizes:
        for at in [*range(0, n - size, step), n - size] if n > size else ():
            yield text[at:at + size]


class Index:
    """q-grams of a block of segments, sorted by hash, with a bit table in front."""

    def __init__(self, rows: list[tuple[object, str]], budget: Budget):
        self.budget = budget
        self.items, self.codes = [], []
        self.short: dict[str, list[object]] = defaultdict(list)
        for item, text in rows:
            text = normalised(text)
            if 0 < len(text) < 2 * budget.q:
                self.short[text].append(item)
            for s in segments(text, budget) if len(text) >= 2 * budget.q else ():
                self.items.append(item)
                self.codes.append(code_points(s))
        grams = [window_hash(c, budget.q) for c in self.codes]
        self.size = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.array([budget.edits(m) for m in self.size], np.int64)
        self.bound = np.array([budget.bound(m) for m in self.size], np.int64)
        self.least = int(self.bound.min()) if len(self.bound) else 1
        h = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.segment = np.concatenate([np.full(len(g), k, np.int64) for k, g in enumerate(grams)])[order] if grams else np.empty(0, np.int64)
        self.place = np.concatenate([np.arange(len(g)) for g in grams])[order] if grams else np.empty(0, np.int64)
        bits = max(16, math.ceil(math.log2(16 * len(h) + 1)))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(h >> self.shift).astype(np.int64)] = True

    def regions(self, doc: np.ndarray) -> list[tuple[int, int]]:
        """(segment, first diagonal) of the bands that meet the bound. A band of a segment spans
        2e + 1 diagonals from a multiple of e + 1 - so the e + 1 neighbours of any match lie in one."""
        h = window_hash(doc, self.budget.q)
        at = np.flatnonzero(self.table[(h >> self.shift).astype(np.int64)])
        if not len(at):
            return []
        low = np.searchsorted(self.hash, h[at], "left")
        n = np.searchsorted(self.hash, h[at], "right") - low
        if n.sum() < self.least:
            return []
        which = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        seg, place = self.segment[which], np.repeat(at, n)
        # a q-gram that the segment repeats counts once for a place and band
        diagonal, width = place - self.place[which], self.edits[seg] + 1
        block = np.floor_divide(diagonal, width)
        out = []
        span = len(doc) + int(self.size.max()) + 2
        offset = int(self.size.max()) + 1  # diagonals start at minus the segment's length
        keys = np.concatenate([seg * span + block + offset, seg * span + block - 1 + offset])
        places = np.concatenate([place, place])
        found, counts = _distinct_per_key(keys, places)
        s = found // span
        for k in np.flatnonzero(counts >= self.bound[s]):
            out.append((int(s[k]), int(found[k] % span - offset) * int(self.edits[s[k]] + 1)))
        return out


def _distinct_per_key(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys, and the number of distinct values of each."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    start = np.concatenate([[True], keys[1:] != keys[:-1]])
    new = start | np.concatenate([[True], values[1:] != values[:-1]])
    at = np.flatnonzero(start)
    return keys[at], np.add.reduceat(new.astype(np.int64), at)


def align(patterns: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each pattern (length m) to a part of its text (length m + K), and the
    offset of the part's end, by dynamic programming in a band of K + 1 diagonals: cell k of
    row i stands for pattern[:i] against a part that ends at text place i + k."""
    r, m = patterns.shape
    wide = texts.shape[1] - m + 1
    steps = np.arange(wide, dtype=np.int32)
    row = np.zeros((r, wide), np.int32)
    far = np.full((r, 1), 1 << 20, np.int32)
    for i in range(m):
        change = row + (texts[:, i:i + wide] != patterns[:, i:i + 1])
        left_out = np.concatenate([row[:, 1:], far], axis=1) + 1
        row = np.minimum.accumulate(np.minimum(change, left_out) - steps, axis=1) + steps
    best = row.argmin(axis=1)
    return row[np.arange(r), best], best + m


_JOINED = regex.compile(r"[\p{L}\p{M}\p{N}--[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]]", regex.V1)


def held_whole(short: str, text: str) -> int:
    """Where the normalised text holds the short item, not as part of a longer word; -1: nowhere."""
    first, last = (_JOINED.match(c) is not None for c in (short[0], short[-1]))
    at = text.find(short)
    while at >= 0:
        end = at + len(short)
        if not (first and at and _JOINED.match(text[at - 1])) and not (last and end < len(text) and _JOINED.match(text[end])):
            return at
        at = text.find(short, at + 1)
    return -1


def matches(text: str | None, index: Index) -> dict[object, tuple[int, int, int, int]]:
    """Items the text holds: fewest edits in a segment, its end and length, number of segments."""
    plain = normalised(text) if text else ""
    whole = {item: (0, at + len(s), len(s), 1) for s, items in index.short.items() if (at := held_whole(s, plain)) >= 0 for item in items}
    doc = code_points(plain)
    if len(doc) < index.budget.q or not len(index.hash):
        return whole
    by_size = defaultdict(list)
    for seg, diagonal in index.regions(doc):
        by_size[int(index.size[seg])].append((seg, diagonal))
    best: dict[object, tuple[int, int, int, int]] = {}
    held: dict[object, set[int]] = defaultdict(set)
    for m, found in by_size.items():
        e = index.budget.edits(m)
        wide = 2 * (e + 1) + 2 * e  # the band, and e on either side
        for some in (found[i:i + 2000] for i in range(0, len(found), 2000)):
            starts = np.array([d - e for _, d in some])
            places = starts[:, None] + np.arange(m + wide)
            inside = (places >= 0) & (places < len(doc))
            texts = np.where(inside, doc[np.clip(places, 0, len(doc) - 1)], np.uint32(0xFFFFFFFF))
            edits, ends = align(np.stack([index.codes[s] for s, _ in some]), texts)
            for (s, _), d, end, start in zip(some, edits, ends, starts):
                if d <= e:
                    item = index.items[s]
                    held[item].add(s)
                    got = (int(d), int(start + end), m)
                    best[item] = min(best.get(item, got), got)
    return whole | {item: (*v, len(held[item])) for item, v in best.items()}


def blocks(benchmark: DataFrame, budget: Budget, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """The benchmark as indexes of bounded size. Long items are cut on the executors, so a block
    is bounded even if one item is huge."""
    step = budget.block_chars // 8
    # single blanks first: a piece of a long item must not shrink to a short one
    rows = benchmark.select(F.col(id_col).alias("item"), F.trim(F.regexp_replace(F.col(text_col), r"(?U)\s+", " ")).alias("t")).where(F.length("t") > 0)
    # pieces overlap by a segment, so every window of an item lies in one of its pieces
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("t") - budget.segment), F.lit(step)))
    pieces = rows.select("item", "t", at.alias("at")).select("item", F.substring("t", F.col("at"), F.lit(step + budget.segment)).alias("t")).distinct()
    total = pieces.agg(F.sum(F.length("t"))).first()[0] or 0
    dense = 2 + budget.quote / budget.quote_step  # characters indexed for each one of an item
    n = math.ceil(total * dense / budget.block_chars)
    for k in range(n):
        # about half of block_chars each by hash; one block goes to the driver at a time
        got = pieces.where(F.pmod(F.xxhash64("item", "t"), F.lit(n)) == k).orderBy("item", "t").collect()
        yield Index([(r["item"], r["t"]) for r in got], budget)


def find(docs: DataFrame, benchmark: DataFrame, budget: Budget | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document and item that it holds: doc id, item_id, edits, char_start and
    char_end (of the best segment, in the normalised text; the start assumes equal lengths),
    segments (how many of the item's)."""
    budget = budget or Budget()
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, item_id long, edits int, char_start int, char_end int, segments int"
    out = None
    for index in blocks(benchmark, budget):
        shared = spark.sparkContext.broadcast(index)

        def work(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch | None:
            rows = [(i, item, d, max(0, end - m), end, n) for i, t in zip(batch.column(id_col), batch.column(text_col).to_pylist())
                    for item, (d, end, m, n) in matches(t, shared.value).items()]
            if not rows:
                return None
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array([x.as_py() for x in cols[0]], batch.column(id_col).type), pa.array(cols[1], pa.int64()),
                 *(pa.array(c, pa.int32()) for c in cols[2:])], names=[id_col, "item_id", "edits", "char_start", "char_end", "segments"])

        part = map_batches(docs.select(id_col, text_col), work, schema)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, budget: Budget | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    spark, out = docs.sparkSession, docs
    for index in blocks(benchmark, budget or Budget()):
        shared = spark.sparkContext.broadcast(index)

        def work(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            # text by text: a list of all would be another copy of the batch
            return batch.filter(pa.array((not matches(t.as_py(), shared.value) for t in batch.column(text_col)), pa.bool_()))

        out = map_batches(out, work, docs.schema)
    return out
