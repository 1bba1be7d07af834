"""Ranked lexical search over a K2-treap of the term-document grid.

The index cuts the corpus into blocks of documents. A block is a grid of its terms (rows) and
documents (columns) with a point where a term occurs, weighted by its impact there, kept as a
quadtree: a cell that holds points has one bit for each quadrant, breadth first, and the highest
impact inside. The bit vector is the whole tree: the child behind a set bit is the cell whose
number is the count of set bits up to there, so no pointers are stored.

A search walks all term rows of an item down the quadtree together. A state is a range of
documents with the cell of every term row over that range; the highest impacts of these cells,
times the weights of the terms, add up to a bound for every document of the range. The ranges
with the best bounds are halved next; at single documents the bound is the score. Ranges whose
bound is under the item's 20th score so far are never opened. A task carries these scores on from
block to block, so most of a later block is closed at its root.

All numbers of the index are exact integers: score = sum over the item's terms of weight * impact,
impact = (10^9 * tf) div (1000 * tf + 12 * m), m = 75 + (25 * n * N) div L. Impacts need N and L of
the corpus, hence two steps: :func:`grids` (term frequencies; one pass over the texts) and
:func:`index` (treaps). Both are tables that any later query set can be searched in.

Items are searched in blocks of bounded size, each sent to the executors; a task keeps the best
documents of each item, so what is shuffled is one short list per task and item.

Defined results: null and empty texts have no terms; they are in no list and don't count in N.
Rows that repeat an id are documents of their own; documents without id are ranked like any
other, before others of equal score. Items without terms, and empty tables, give no rows. Rows
that repeat an item are one item if they agree in id and text; an id with several texts gets a
list for each of them, ranked by itself.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import LARGE_ROWS, staged, tidy
from marketlake.session import held_settings

TOP = 20
#: Tokens of a block of documents, and characters of a block of items sent to the executors.
BLOCK_TOKENS = 500_000
ITEM_CHARS = 2_000_000
#: Settings for the pass over the texts.
TEXT_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
#: Ranges opened in one step, and cells that a search keeps at most for one strip of documents.
BATCH = 256
STRIP_CELLS = 1 << 22

#: Terms are runs of bytes that are ASCII letters, digits or not ASCII; A-Z become a-z.
_BLANKED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_BLANKED).split()


# ---- grid: term frequencies of a block of documents -------------------------------------

def _packed(values: np.ndarray) -> bytes:
    """Non-negative integers in the fewest bytes that hold the largest; the first byte says how many."""
    size = next(s for s in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * s)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _unpacked(data: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(kind)


class _Block:
    """Term frequencies of the documents added so far; terms are numbered as they come."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.points, self.tf, self.lengths, self.distinct, self.tokens = array("q"), array("q"), array("q"), array("q"), 0

    def add(self, terms: list[bytes]) -> None:
        number, counts = self.number, Counter(terms)
        self.points.extend(number.setdefault(t, len(number)) for t in counts)
        self.tf.extend(counts.values())
        self.lengths.append(len(terms))
        self.distinct.append(len(counts))
        self.tokens += len(terms)


_GRID = "n_docs long, n_terms long, lengths binary, terms binary, df binary, points binary, tf binary"


def grids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per block of documents: ids, n_docs (with a term), n_terms, lengths (terms of each
    document), terms (distinct, one a line), df (documents of each), and for each document the
    numbers of its terms (points, ``df`` many in all) with their tf."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, block = [], _Block()
        for batch in batches:
            start, n = 0, batch.num_rows
            for i, text in enumerate(batch.column(text_col)):  # one text at a time
                block.add(terms_of(text.as_py() or ""))
                if block.tokens >= BLOCK_TOKENS:
                    yield packed(pa.concat_arrays([*ids, batch.column(id_col).slice(start, i + 1 - start)]), block)
                    ids, start, block = [], i + 1, _Block()
            if start < n:
                ids.append(pa.concat_arrays([batch.column(id_col).slice(start)]))
        if ids:
            yield packed(pa.concat_arrays(ids), block)
        tidy()

    def packed(ids: pa.Array, made: _Block) -> pa.RecordBatch:
        number = made.number
        points, tf, lengths, distinct = (np.frombuffer(x, np.int64) for x in (made.points, made.tf, made.lengths, made.distinct))
        values = [int((lengths > 0).sum()), int(lengths.sum()), _packed(lengths), b"\n".join(number), _packed(np.bincount(points, minlength=len(number))),
                  _packed(points), _packed(tf)]
        listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        distinct_docs = pa.array([_packed(distinct)], pa.binary())
        return pa.RecordBatch.from_arrays([listed, distinct_docs, *(pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for v in values)],
                                          names=["ids", "distinct_terms", "n_docs", "n_terms", "lengths", "terms", "df", "points", "tf"])

    return docs.select(id_col, text_col).mapInArrow(run, f"ids array<{kind}>, distinct_terms binary, {_GRID}")


# ---- K2-treap ---------------------------------------------------------------------------

def impact(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Saturated term frequency in whole numbers; grows with tf, falls with the length n."""
    m = 75 + (25 * n * n_docs) // max(1, n_terms)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _interleaved(rows: np.ndarray, cols: np.ndarray, levels: int) -> np.ndarray:
    code = np.zeros(len(rows), np.int64)
    for b in range(levels):
        code |= ((rows >> b) & 1) << (2 * b + 1) | ((cols >> b) & 1) << (2 * b)
    return code


def treap(rows: np.ndarray, cols: np.ndarray, weights: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(quadrant bits, maxima) of the quadtree over distinct points of a grid with side
    2 ** levels, breadth first; the root is cell 0 and cells of one point's size have no bits."""
    code = _interleaved(rows, cols, levels)
    order = np.argsort(code, kind="stable")
    code, best = code[order], weights[order].astype(np.int32)  # impacts are at most 10^6
    maxima, bits = [best], []
    for _ in range(levels):
        above = code >> np.int64(2)
        first = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
        held = np.zeros((len(first), 4), bool)
        held[np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(code)])), code & 3] = True
        code, best = above[first], np.maximum.reduceat(best, first)
        bits.append(held.ravel())
        maxima.append(best)
    return np.concatenate(bits[::-1]) if bits else np.empty(0, bool), np.concatenate(maxima[::-1])


def differences(bits: np.ndarray, maxima: np.ndarray) -> np.ndarray:
    """What each cell's maximum lacks to that of the cell above; the root's as it is."""
    less = np.repeat(maxima[:len(bits) // 4], bits.reshape(-1, 4).sum(1, dtype=np.int64))
    return np.concatenate([maxima[:1], np.subtract(less, maxima[1:], out=less)])


def index(grid: DataFrame) -> DataFrame:
    """The treaps of all blocks: ids, terms, df, levels, bits, maxima (as differences to the cell above, the root's as it is)."""
    n_docs, n_terms = (int(x or 0) for x in grid.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    ids = grid.schema["ids"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = {c: batch.column(c)[i].as_py() for c in ("distinct_terms", "lengths", "terms", "points", "tf")}
                if not at["terms"]:
                    continue
                distinct, lengths, rows, tf = (_unpacked(at[c]) for c in ("distinct_terms", "lengths", "points", "tf"))
                cols = np.repeat(np.arange(len(lengths)), distinct)
                levels = max(int(rows.max()), len(lengths) - 1).bit_length()
                bits, maxima = treap(rows, cols, impact(tf, lengths[cols], n_docs, n_terms), levels)
                less = differences(bits, maxima)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(i, 1), batch.column("terms").slice(i, 1), batch.column("df").slice(i, 1), pa.array([levels], pa.int32()),
                     pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()), pa.array([_packed(less)], pa.binary())],
                    names=["ids", "terms", "df", "levels", "bits", "maxima"])
        tidy()

    cols = grid.select("ids", "distinct_terms", "lengths", "terms", "df", "points", "tf")
    return cols.mapInArrow(run, f"ids {ids}, terms binary, df binary, levels int, bits binary, maxima binary")


# ---- search -----------------------------------------------------------------------------

class Treap:
    """A block's quadtree for walking, on its bit vector: the child behind a set bit is the cell whose
    number is the rank of that bit, from counts per 64-bit word."""

    def __init__(self, levels: int, bits: bytes, maxima: bytes, n_docs: int) -> None:
        self.levels, self.n_docs = levels, n_docs
        self.words = np.frombuffer(bits + bytes(-len(bits) % 8), "<u8")
        counts = np.bitwise_count(self.words)
        self.before = np.cumsum(counts, dtype=np.int32) - counts  # set bits of the words before
        self.best = _unpacked(maxima, np.int32)
        # from differences to the cell above, a level at a time
        held = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        start, end = 0, 1
        for _ in range(levels):
            parent = np.flatnonzero(held[4 * start:4 * end]) // 4 + start
            start, end = end, end + len(parent)
            self.best[start:end] = self.best[parent] - self.best[start:end]
        self.best = np.append(self.best, np.int32(0))  # cell -1: nothing there

    def child(self, cells: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The cell in a quadrant of each cell, -1 if it is empty or the cell is -1."""
        at = np.maximum(4 * cells.astype(np.int64) + quadrant, 0)
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        here = self.words[word]
        upto = here & ((np.uint64(2) << bit) - np.uint64(1))
        found = self.before[word] + np.bitwise_count(upto)
        return np.where((cells >= 0) & ((here >> bit) & np.uint64(1) > 0), found, -1).astype(np.int32)

    def top(self, rows: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(documents, scores) with a score of at least the bound last sent (``least`` at first),
        the most promising ranges first. ``rows``, ``weights``: the item's terms in this block."""
        sent = yield np.empty(0, np.int64), np.empty(0, np.int64)
        least = least if sent is None else sent
        # strips of documents, so that states times terms stay bounded
        depth = min(self.levels, max(0, self.levels + 1 - max(1, STRIP_CELLS // max(1, len(rows))).bit_length()))
        at, cells = np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int32)
        for level in range(depth):
            at, cells = self._halved(at, cells, np.full(len(at), level), rows)
            good = self.best[cells] @ weights >= least
            at, cells = at[good], cells[good]
        bounds = self.best[cells] @ weights
        for s in np.argsort(-bounds, kind="stable"):
            if bounds[s] < least:
                break
            where, lv, cell, bound = at[s:s + 1], np.full(1, depth), cells[s:s + 1], bounds[s:s + 1]
            while len(where):
                # the best ranges are opened, the others wait
                pick = np.argpartition(-bound, BATCH - 1)[:BATCH] if len(bound) > BATCH else np.arange(len(bound))
                wait = np.ones(len(bound), bool)
                wait[pick] = False
                done = lv[pick] == self.levels
                if done.any():
                    sent = yield where[pick[done]], bound[pick[done]]
                    least = least if sent is None else sent
                open_ = pick[~done]
                new_at, new_cells = self._halved(where[open_], cell[open_], lv[open_], rows)
                new_bound, new_lv = self.best[new_cells] @ weights, np.repeat(lv[open_] + 1, 2)
                where, lv, cell, bound = (np.concatenate([x[wait], y]) for x, y in ((where, new_at), (lv, new_lv), (cell, new_cells), (bound, new_bound)))
                good = bound >= least
                where, lv, cell, bound = where[good], lv[good], cell[good], bound[good]

    def _halved(self, at: np.ndarray, cells: np.ndarray, level: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of each document range, with the cell of every term row over them."""
        down = (rows[None, :] >> (self.levels - 1 - level)[:, None]) & 1
        child = np.stack([self.child(cells, 2 * down + half) for half in (0, 1)], axis=1)
        return (2 * at[:, None] + np.arange(2)).ravel(), child.reshape(-1, cells.shape[1])


class Best:
    """The best documents of an item so far: (-score, no id, id), ascending."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []

    @property
    def least(self) -> int:
        """Scores under this are out; equal ones may still come in by their id."""
        return -self.rows[-1][0] if len(self.rows) >= self.k else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        fresh = [(-int(s), i is not None, i if i is not None else 0) for s, i in zip(scores, ids)]
        self.rows = sorted(self.rows + fresh)[:self.k]


@dataclass(frozen=True)
class Query:
    item: object
    counts: dict[bytes, int]


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[Query]]:
    """Items in blocks of about ``ITEM_CHARS``; one block at a time is on the driver."""
    rows = items.select(F.col(id_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).distinct()
    n = max(1, math.ceil((rows.agg(F.sum(F.length("t"))).first()[0] or 0) / ITEM_CHARS))
    for k in range(n):
        got = rows.where(F.pmod(F.xxhash64("item", "t"), F.lit(n)) == k).orderBy("item", "t").collect()
        yield [Query(r["item"], dict(c)) for r in got if (c := Counter(terms_of(r["t"])))]


def document_frequencies(blocks: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """In how many documents each of ``terms`` occurs."""
    wanted = blocks.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for words, df in zip(batch.column("terms").to_pylist(), batch.column("df").to_pylist()):
                here = words.split(b"\n") if words else []
                counts = _unpacked(df)
                seen.update({w: int(counts[i]) for i, w in enumerate(here) if w in wanted.value})
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["term", "df"])

    counted = blocks.select("terms", "df").mapInArrow(run, "term binary, df long")
    with held_settings(blocks.sparkSession, LARGE_ROWS):
        return {bytes(r["term"]): r["df"] for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def search(treaps: DataFrame, n_docs: int, items: DataFrame, k: int = TOP, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank from 1, doc id and score (> 0)."""
    spark = treaps.sparkSession
    item_kind, kind = items.schema[item_col].dataType.simpleString(), treaps.schema["ids"].dataType.elementType.simpleString()
    schema = f"{item_col} {item_kind}, part int, {id_col} {kind}, score long"
    out = None
    for queries in _item_blocks(items, item_col, text_col):
        df = document_frequencies(treaps, {t for q in queries for t in q.counts})
        weights = [{t: c * term_weight(n_docs, df[t]) for t, c in q.counts.items() if t in df} for q in queries]
        shared = spark.sparkContext.broadcast((weights, set(df)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            weights, vocabulary = shared.value
            best, ids_type = [Best(k) for _ in weights], None
            for batch in batches:
                for b in range(batch.num_rows):
                    row = {c: batch.column(c)[b].as_py() for c in ("terms", "levels", "bits", "maxima")}
                    ids = batch.column("ids")[b].values
                    ids_type = ids.type
                    number = {t: i for i, t in enumerate(row["terms"].split(b"\n")) if t in vocabulary}
                    block = Treap(row["levels"], row["bits"], row["maxima"], len(ids))
                    for held, wanted in zip(best, weights):
                        here = [(number[t], w) for t, w in wanted.items() if t in number and w]
                        if not here:
                            continue
                        rows, w = (np.array(x, np.int64) for x in zip(*here))
                        walk = block.top(rows, w, held.least)
                        next(walk)
                        try:
                            while True:
                                docs, scores = walk.send(held.least)
                                keep = scores >= held.least
                                held.add(scores[keep], ids.take(pa.array(docs[keep])).to_pylist())
                        except StopIteration:
                            pass
            rows = [(q, i if has else None, -s) for q, held in enumerate(best) for s, has, i in held.rows]
            if rows:
                qs, found, scores = zip(*rows)
                tidy()
                yield pa.RecordBatch.from_arrays([pa.array(qs, pa.int32()), pa.array(found, ids_type), pa.array(scores, pa.int64())], names=["part", id_col, "score"])

        found = treaps.select("ids", "terms", "levels", "bits", "maxima").mapInArrow(run, f"part int, {id_col} {kind}, score long")
        with held_settings(spark, LARGE_ROWS):
            found = staged(found, "search-found")  # at most k rows for each task and item
        names = spark.createDataFrame([(i, q.item) for i, q in enumerate(queries)], f"part int, {item_col} {item_kind}")
        part = found.join(F.broadcast(names), "part").select(item_col, "part", id_col, "score")  # names: one block of items
        place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("score"), F.col(id_col).asc_nulls_first()))
        part = part.withColumn("rank", place).where(F.col("rank") <= k).select(item_col, "rank", id_col, "score")
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema).select(item_col, F.lit(1).alias("rank"), id_col, "score") if out is None else out


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Index all of ``docs`` and search every item: item_id, rank, doc_id, score."""
    with held_settings(docs.sparkSession, TEXT_ROWS):
        grid = staged(grids(docs, id_col, text_col), "search-grids", large_rows=True)
    with held_settings(docs.sparkSession, LARGE_ROWS):
        treaps = staged(index(grid), "search-treaps", large_rows=True)
    n_docs = grid.agg(F.sum("n_docs")).first()[0] or 0
    return search(treaps, n_docs, items, k, id_col, item_col, text_col)


ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
corpus AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM lengths),
postings AS (SELECT term, doc_id, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, corpus GROUP BY term),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), corpus GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""
