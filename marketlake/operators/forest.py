"""Random forest of deep trees for two classes, grown and applied on the executors.

The procedure is that of ``pyspark.ml``'s RandomForestClassifier: features in at most ``BINS`` bins,
a Poisson(1) bootstrap of rows for each tree, the square root of the number of features drawn for each
node, the cut with the largest loss of weighted Gini impurity, sibling leaves of one class joined,
votes weighted by the leaves' class shares. There the driver holds all trees, and every batch of
nodes is a pass over all rows for all trees, so time and driver memory grow with rows x nodes. Here:

* rows that agree in all bins and in class are one *cell* with a count (the sum of n Poisson(1) draws
  is a Poisson(n) draw, so the bootstrap is that of rows). Cells are dealt to blocks by a hash;
* nodes with more than ``limit`` cells are split level by level: blocks send histograms, one row for
  each tree and partition, and the driver gets the chosen cut of each such node;
* a smaller node's cells meet in one group, which grows the whole subtree below it in memory, sends
  the test cells it is given through it, and keeps nothing but their class shares and the sums for
  the importances. The driver holds no more than the tops of the trees;
* where the roots are that small already, as they are once bins have few values, every task gets the
  cells once (a broadcast of at most ``limit`` of them), grows whole trees over its own draws and
  adds up their votes, so nothing is moved for each tree.

Draws are seeded by tree and block or node, so neither partitions nor the order of rows matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.numbering import staged

BINS = 32
#: Cells of a group that grows a subtree, and of a block. A cell takes about 100 bytes while a tree grows.
LIMIT, BLOCK = 4_000_000, 25_000
#: Test cells of a block: the group that adds up their votes holds one for each tree.
TEST_BLOCK = 10_000
_LEAST_GAIN = 1e-14  # what rounding leaves of none
#: Shares of class 1 are added up as whole numbers of this size, so that no order of adding matters.
_SHARE = float(1 << 52)
MESSAGE = "tree int, node int, block int, payload binary"
_BATCH = 16 << 20


# ---- features ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Features:
    """Feature f reads code ``column[f]``: its bin, or with ``value[f]`` >= 0 whether it is that value."""

    column: np.ndarray
    value: np.ndarray
    dtype: type

    @classmethod
    def of_columns(cls, cuts: list[list[float]], categories: list[int]) -> Features:
        """Ordered columns with their cuts, then categories of so many values, a feature for each value."""
        n = len(cuts)
        column = [*range(n), *(n + j for j, size in enumerate(categories) for _ in range(size))]
        value = [-1] * n + [v for size in categories for v in range(size)]
        return cls(np.array(column), np.array(value), np.uint8 if max([BINS, *categories]) <= 256 else np.uint32)

    @property
    def drawn(self) -> int:
        return math.ceil(math.sqrt(len(self.column)))

    def bins(self, codes: np.ndarray, f: np.ndarray) -> np.ndarray:
        """The bin of feature f[i] in row i."""
        got, value = codes[np.arange(len(codes)), self.column[f]].astype(np.int64), self.value[f]
        return np.where(value < 0, got, got == value)

    def right(self, f: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """To the right of each cut go the codes from ``low`` to ``low + span``: the bins above it, or the one value."""
        one = self.value[f] >= 0
        low = np.where(one, self.value[f], cut + 1)
        span = np.where(one, 0, np.iinfo(self.dtype).max - low)
        return low.astype(self.dtype), span.astype(self.dtype)

    def draw(self, rng: np.random.Generator, nodes: int) -> np.ndarray:
        """Distinct features for each node, in the order of Spark's reservoir: of equal cuts the first counts."""
        n, m = len(self.column), self.drawn
        out = np.tile(np.arange(m), (nodes, 1))
        for k in range(m, n):
            at = (rng.random(nodes) * (k + 1)).astype(np.int64)
            taken = np.flatnonzero(at < m)
            out[taken, at[taken]] = k
        return out


def cut_points(values: np.ndarray, weights: np.ndarray) -> list[float]:
    """Cuts between weighted values: all, if there are fewer than ``BINS``, else about equal weights apart."""
    values, at = np.unique(values, return_inverse=True)
    counts = np.bincount(at, weights)
    middle = ((values[1:] + values[:-1]) / 2).tolist()
    if len(values) <= BINS:
        return middle
    stride, out, have = counts.sum() / BINS, [], counts[0]
    target = stride
    for k in range(1, len(values)):
        before, have = have, have + counts[k]
        if abs(before - target) < abs(have - target):
            out.append(middle[k - 1])
            target += stride
    return out[:BINS - 1]


def class_cuts(train: DataFrame, columns: list[str], weights: dict[int, float]) -> list[list[float]]:
    """Cut points of each column from quantiles of each class, weighted as the class is."""
    steps = [k / 1000 for k in range(1001)]
    rows = {r[0]: r[1] for r in train.groupBy("label").count().collect()}
    points = [(weights[c] * n, train.where(F.col("label") == c).approxQuantile(columns, steps, 0.0005)) for c, n in sorted(rows.items())]
    each = np.concatenate([np.full(len(steps), share) for share, _ in points])
    return [cut_points(np.concatenate([q[j] for _, q in points]), each) for j in range(len(columns))]


# ---- trees in memory ----------------------------------------------------------------------
@dataclass
class Nodes:
    """Children are ``left`` and ``left + 1`` (-1: a leaf) and come after their parent; rows whose
    bin of ``feature`` is at most ``cut`` go left. ``counts``: drawn rows of each class."""

    left: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    counts: np.ndarray

    @classmethod
    def leaves(cls, counts: np.ndarray) -> Nodes:
        n = counts.shape[1]
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), counts)

    def split(self, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, left: np.ndarray, first: int) -> Nodes:
        """Splits the nodes ``at``; returns the children, numbered from ``first``."""
        self.left[at], self.feature[at], self.cut[at], self.gain[at] = first + 2 * np.arange(len(at)), feature, cut, gain
        return Nodes.leaves(np.stack([left, self.counts[:, at] - left], axis=2).reshape(2, -1))

    @classmethod
    def joined(cls, parts: list[Nodes]) -> Nodes:
        return cls(*(np.concatenate([getattr(p, c) for p in parts], axis=-1) for c in ("left", "feature", "cut", "gain", "counts")))

    def share(self, weights: np.ndarray) -> np.ndarray:
        """Weighted share of class 1."""
        w = self.counts * weights[:, None]
        return w[1] / np.maximum(w.sum(axis=0), 1e-300)

    def prune(self, weights: np.ndarray, levels: list[int]) -> None:
        """Join sibling leaves of one class, deepest level first; ``levels``: where each level begins."""
        one = self.counts[1] * weights[1] > self.counts[0] * weights[0]
        for a, b in reversed(list(zip(levels, [*levels[1:], len(self.left)]))):
            at = a + np.flatnonzero(self.left[a:b] >= 0)
            low = self.left[at]
            self.left[at[(self.left[low] < 0) & (self.left[low + 1] < 0) & (one[low] == one[low + 1])]] = -1

    def route(self, codes: np.ndarray, features: Features) -> np.ndarray:
        """The leaf of each row."""
        out, moving = np.zeros(len(codes), np.int64), np.arange(len(codes) if self.left[0] >= 0 else 0)
        if not len(moving):
            return out
        flat, width, column = np.ascontiguousarray(codes).reshape(-1), codes.shape[1], features.column[self.feature]
        low, span = features.right(self.feature, self.cut)
        at = out[moving]
        while len(moving):
            at = self.left[at] + (flat[moving * width + column[at]] - low[at] <= span[at])
            ends = self.left[at] < 0
            out[moving[ends]] = at[ends]
            moving, at = moving[~ends], at[~ends]
        return out

    def importance(self, features: Features, weights: np.ndarray) -> np.ndarray:
        """Gain times weight by feature, of the inner nodes that the root reaches."""
        reached = np.zeros(len(self.left), bool)
        level = np.zeros(1, np.int64)
        while len(level):
            level = level[self.left[level] >= 0]
            reached[level] = True
            level = np.concatenate([self.left[level], self.left[level] + 1])
        value = self.gain * (self.counts * weights[:, None]).sum(axis=0)
        return np.bincount(self.feature[reached], value[reached], len(features.column))


def gains(left: np.ndarray, whole: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The loss of weighted Gini impurity, if ``left`` of the rows ``whole`` (2 x cuts) go left."""
    whole, low = whole * weights[:, None], left * weights[:, None]
    high = whole - low
    low_sum, high_sum, total = low[0] + low[1], high[0] + high[1], whole[0] + whole[1]
    square = lambda x: x[0] * x[0] + x[1] * x[1]
    with np.errstate(divide="ignore", invalid="ignore"):  # nothing on one side: no cut
        return (square(low) / low_sum + square(high) / high_sum) / total - square(whole) / total ** 2


def best_cuts(group: np.ndarray, bins: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each group 0, 1, ...: the largest gain (-1: no cut), its bin and the counts up to it. The
    runs, counts by class, come in order of group and bin."""
    start = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1])
    end = np.concatenate([start[1:], [len(group)]]) - 1
    left = np.cumsum(counts, axis=1)
    left -= (left[:, start] - counts[:, start])[:, group]
    gain = gains(left, left[:, end][:, group], weights)
    gain[end] = -1
    top = np.maximum.reduceat(gain, start)
    at = np.flatnonzero(gain == top[group])
    at = at[np.searchsorted(group[at], np.arange(len(start)))]
    return top, bins[at], left[:, at]


#: Drawn rows of class 1 count this much beside those of class 0, where both are added up in one pass.
_ONE = float(1 << 26)


def _counts(key: np.ndarray, bag: np.ndarray, size: int) -> np.ndarray:
    """Drawn rows of each class by key (2 x ``size``). ``bag`` has a row for each class, or both in one
    number (fewer than 2 ** 26 rows in all, so the sums are exact)."""
    if bag.ndim == 2:
        return np.stack([np.bincount(key, b, size) for b in bag])
    both = np.bincount(key, bag, size)
    ones = np.floor(both / _ONE)
    return np.stack([both - ones * _ONE, ones])


def _runs(key: np.ndarray, bag: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the counts of each."""
    if size > 4 * len(key):
        distinct, key = np.unique(key, return_inverse=True)
        return distinct, _counts(key, bag, len(distinct))
    counts = _counts(key, bag, size)
    at = np.flatnonzero(counts.any(axis=0))
    return at, counts[:, at]


class _Cuts:
    """The best cut of each drawn feature of each node of a level."""

    def __init__(self, features: Features, drawn: np.ndarray, whole: np.ndarray, weights: np.ndarray):
        self.features, self.drawn, self.whole, self.weights = features, drawn, whole, weights
        self.gain, self.at = np.full(drawn.shape, -1.0), np.zeros(drawn.shape, np.int64)
        self.left = np.zeros((2, *drawn.shape))
        self.of_feature = [np.nonzero(drawn == f) for f in range(len(features.column))]

    def ordered(self, some: np.ndarray, columns: np.ndarray, node: np.ndarray, bag: np.ndarray) -> None:
        """Of up to 8 ordered features: counts by bin of the nodes that drew each."""
        drew = np.zeros(len(self.drawn) + 1, np.uint8)
        for bit, f in enumerate(some):
            drew[self.of_feature[f][0]] |= np.uint8(1 << bit)
        drew = drew[node]
        for bit, f in enumerate(some):
            if len(self.of_feature[f][0]):
                self._ordered(f, columns[self.features.column[f]], np.flatnonzero(drew & np.uint8(1 << bit)), node, bag)

    def _ordered(self, f: int, codes: np.ndarray, mine: np.ndarray, node: np.ndarray, bag: np.ndarray) -> None:
        nodes, slots = self.of_feature[f]
        place = np.zeros(len(self.drawn), np.int64)
        place[nodes] = np.arange(len(nodes))
        key, counts = _runs(place[node[mine]] * BINS + codes[mine], bag[..., mine], len(nodes) * BINS)
        self.gain[nodes, slots], self.at[nodes, slots], self.left[:, nodes, slots] = best_cuts(key // BINS, key % BINS, counts, self.weights)

    def one_of(self, of: list[int], codes: np.ndarray, node: np.ndarray, bag: np.ndarray) -> None:
        """Of the features that are one value each of a category: one table of nodes and values serves them all."""
        nodes, slots = (np.concatenate(x) for x in zip(*(self.of_feature[f] for f in of)))
        value, size = self.features.value[self.drawn[nodes, slots]], len(of)
        key, counts = _runs(node * size + codes, bag, (len(self.drawn) + 1) * size)
        want = nodes * size + value
        at = np.minimum(np.searchsorted(key, want), len(key) - 1)
        right = np.where(key[at] == want, counts[:, at], 0.0)
        left = self.whole[:, nodes] - right
        real = np.flatnonzero(left.any(axis=0) & right.any(axis=0))
        nodes, slots, left = nodes[real], slots[real], left[:, real]
        self.gain[nodes, slots], self.left[:, nodes, slots] = gains(left, self.whole[:, nodes], self.weights), left

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Gain, feature, cut and counts to the left; of equal gains the feature drawn first."""
        slot, node = self.gain.argmax(axis=1), np.arange(len(self.drawn))
        return self.gain[node, slot], self.drawn[node, slot], self.at[node, slot], self.left[:, node, slot]


def grow(codes: np.ndarray, bag: np.ndarray, features: Features, weights: np.ndarray, depth: int, rng: np.random.Generator) -> Nodes:
    """A tree of at most ``depth`` levels below its root over cells with drawn counts by class (2 x cells)."""
    parts, levels = [Nodes.leaves(bag.sum(axis=1, keepdims=True))], [0]
    if bag.sum() < _ONE:
        bag = bag[0] + bag[1] * _ONE
    ordered = np.flatnonzero(features.value < 0)
    categories = [np.flatnonzero((features.column == c) & (features.value >= 0)).tolist() for c in np.unique(features.column[features.value >= 0])]
    columns = np.ascontiguousarray(codes.T)
    node = np.zeros(len(codes), np.int64)
    for _ in range(depth):
        level, first = parts[-1], levels[-1] + len(parts[-1].left)
        mixed = np.flatnonzero((level.counts > 0).all(axis=0))
        n = len(mixed)
        if not n:
            break
        # cells of other nodes wait at place n until a fourth of all cells waits
        place = np.full(len(level.left) + 1, n)
        place[mixed] = np.arange(n)
        node = place[node]
        here = node < n
        if 4 * np.count_nonzero(here) <= 3 * len(node):
            columns, bag, node = columns[:, here], bag[..., here], node[here]
        cuts = _Cuts(features, features.draw(rng, n), level.counts[:, mixed], weights)
        for k in range(0, len(ordered), 8):
            cuts.ordered(ordered[k:k + 8], columns, node, bag)
        for of in categories:
            cuts.one_of(of, columns[features.column[of[0]]], node, bag)
        gain, feature, cut, left = cuts.best()
        at = np.flatnonzero(gain > _LEAST_GAIN)
        if not len(at):
            break
        parts.append(level.split(mixed[at], feature[at], cut[at], gain[at], left[:, at], first))
        levels.append(first)
        child = np.full(n + 1, 2 * len(at))
        child[at] = 2 * np.arange(len(at))
        low, span = (np.append(x, x[:1]) for x in features.right(feature, cut))
        start = np.append(features.column[feature] * len(node), 0)
        mine = columns.reshape(-1)[start[node] + np.arange(len(node))]
        right = (mine - low[node] <= span[node]) & (child < 2 * len(at))[node]
        node = child[node] + right
    out = Nodes.joined(parts)
    out.prune(weights, levels)
    return out


# ---- blocks and messages ---------------------------------------------------------------
def _pack(*arrays: np.ndarray) -> bytes:
    return np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def _unpack(payload: bytes, *kinds: type) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(payload, np.int64, len(kinds), 8), 8 * (len(kinds) + 1), []
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(payload, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _batches(rows: Iterator[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Messages in batches of about ``_BATCH`` bytes."""
    kept, size = [], 0
    for row in rows:
        kept.append(row)
        size += len(row[3])
        if size > _BATCH:
            yield _batch(kept)
            kept, size = [], 0
    if kept:
        yield _batch(kept)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names=["tree", "node", "block", "payload"])


def _rows(table: pa.Table | pa.RecordBatch) -> list[tuple]:
    return list(zip(*(table.column(c).to_pylist() for c in ("tree", "node", "block", "payload"))))


def coded(rows: DataFrame, key: str, ordered: list[str], categories: list[str], cuts: list[list[float]], features: Features) -> DataFrame:
    """key, label, is_test and the codes of each row: bins of the ordered columns, then the categories."""
    edges = [np.array(c) for c in cuts]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # at a cut is left of it
            cols = [np.searchsorted(e, b.column(c).to_numpy(zero_copy_only=False), "left") for c, e in zip(ordered, edges)]
            codes = np.stack([*cols, *(b.column(c).to_numpy(zero_copy_only=False) for c in categories)], axis=1).astype(features.dtype)
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(codes.itemsize * codes.shape[1]), len(codes), [None, pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("label"), b.column("is_test"), packed.cast(pa.binary())], names=[key, "label", "is_test", "codes"])

    narrow = rows.select(key, F.col("label").cast("int").alias("label"), "is_test", *ordered, *categories)
    return staged(narrow.mapInArrow(work, f"{key} {rows.schema[key].dataType.simpleString()}, label int, is_test int, codes binary"), "forest-rows")


def blocks_of(cells: DataFrame, size: int, dtype: type, name: str) -> tuple[DataFrame, int]:
    """Cells (codes, label, n) packed, about ``size`` in a block, in order of codes and label; and their number."""
    cells = staged(cells, f"{name}-cells")
    total = cells.count()
    n = max(1, math.ceil(total / size))

    def pack(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("codes", "label", "n"))))
        codes, label, count = zip(*rows)
        payload = _pack(np.frombuffer(b"".join(codes), dtype), np.array(label, np.uint8), np.array(count, np.int64))
        return pa.Table.from_batches([_batch([(0, 0, table.column("block")[0].as_py(), payload)])])

    block = F.pmod(F.xxhash64("codes"), F.lit(n)).cast("int").alias("block")
    return staged(cells.select(block, "codes", "label", "n").repartition(n, "block").groupBy("block").applyInArrow(pack, MESSAGE), name), total


def _cells(payload: bytes, features: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes, label, n = _unpack(payload, features.dtype, np.uint8, np.int64)
    return codes.reshape(len(label), -1), label, n


def _drawn(seed: int, tree: int, block: int, n: np.ndarray) -> np.ndarray:
    return np.random.default_rng([seed, 1, tree, block]).poisson(n)


def _by_node(at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Nodes and the places of their rows."""
    order = np.argsort(at, kind="stable")
    nodes, start = np.unique(at[order], return_index=True)
    yield from zip(nodes.tolist(), np.split(order, start[1:]))


@dataclass
class Forest:
    """What the driver keeps: importances by feature, and the scores of the test rows as a table."""

    featureImportances: DenseVector  # noqa: N815 - as pyspark.ml's models call it
    pred: DataFrame


class Grower:
    """Trees over blocks of cells: ``tops`` are split here until no node has more than ``limit`` cells."""

    def __init__(self, train: DataFrame, features: Features, weights: np.ndarray, cells: int, trees: int, depth: int, seed: int, limit: int):
        self.train, self.features, self.weights, self.depth, self.seed, self.limit = train, features, weights, depth, seed, limit
        self.tops = [Nodes.leaves(np.zeros((2, 1))) for _ in range(trees)]
        self.levels = [[0] for _ in range(trees)]
        self.size = [np.array([cells]) for _ in range(trees)]  # at most, of the root

    def split_tops(self) -> None:
        for _ in range(self.depth):
            large = {t: a + np.flatnonzero(self.size[t][a:] > self.limit) for t, a in ((t, levels[-1]) for t, levels in enumerate(self.levels))}
            large = {t: at for t, at in large.items() if len(at)}
            if not large:
                return
            self._split(large)
        for levels, size in zip(self.levels, self.size):
            if len(levels) > self.depth:
                size[levels[self.depth]:] = 0  # leaves by depth

    def _split(self, large: dict[int, np.ndarray]) -> None:
        """Split these nodes of the last level, where a cut gains."""
        tops, features, weights, seed = self.tops, self.features, self.weights, self.seed
        drawn = {t: np.concatenate([features.draw(np.random.default_rng([seed, 2, t, int(k)]), 1) for k in at]) for t, at in large.items()}

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for _, _, block, payload in (r for b in batches for r in _rows(b)):
                codes, label, n = _cells(payload, features)
                for t, at in large.items():
                    bag = _drawn(seed, t, block, n)
                    place = np.full(len(tops[t].left), -1)
                    place[at] = np.arange(len(at))
                    here = place[tops[t].route(codes, features)]
                    here[bag == 0] = -1
                    mine = np.flatnonzero(here >= 0)
                    some, m, size = codes[mine], features.drawn, len(at) * features.drawn * BINS
                    key = np.concatenate([(here[mine] * m + s) * BINS + features.bins(some, drawn[t][here[mine], s]) for s in range(m)])
                    kind = np.tile(label[mine].astype(np.int64), m)
                    counts = np.bincount(kind * size + key, np.tile(bag[mine], m), 2 * size)
                    got = np.concatenate([counts, np.bincount(key, minlength=size)]).reshape(3, size)
                    sums[t] = sums[t] + got if t in sums else got
            for t, got in sums.items():
                filled = np.flatnonzero(got[2])  # one-hot features fill two bins
                yield _batch([(t, 0, 0, _pack(filled.astype(np.int64), got[:, filled].ravel()))])

        def cuts(table: pa.Table) -> pa.Table:
            rows = _rows(table)
            t = rows[0][0]
            got = np.zeros((3, len(large[t]) * features.drawn * BINS))
            for row in rows:
                filled, counts = _unpack(row[3], np.int64, np.float64)
                got[:, filled] += counts.reshape(3, -1)
            at = np.flatnonzero(got[2])
            groups = at // BINS
            gain, cut, left = best_cuts(groups, at % BINS, got[:2, at], weights)
            best = gain.reshape(len(large[t]), -1).argmax(axis=1) + np.arange(len(large[t])) * features.drawn
            group, below = np.repeat(best, BINS), np.tile(np.arange(BINS), len(best)) <= np.repeat(cut[best], BINS)
            cells = got[2].reshape(-1, BINS)
            low = (cells[best] * below.reshape(-1, BINS)).sum(axis=1)
            both = got.reshape(3, len(large[t]), features.drawn, BINS)[:, :, 0].sum(axis=2)
            out = np.concatenate([[gain[best], drawn[t].ravel()[best], cut[best], low], left[:, best], both])
            return pa.Table.from_batches([_batch([(t, 0, 0, _pack(out.ravel()))])])

        n = min(len(large), 200)
        found = self.train.mapInArrow(histograms, MESSAGE).repartition(n, "tree").groupBy("tree").applyInArrow(cuts, MESSAGE).collect()
        for row in found:
            t = row["tree"]
            gain, feature, cut, low, l0, l1, n0, n1, cells = _unpack(row["payload"], np.float64)[0].reshape(9, -1)
            top, at = self.tops[t], large[t]
            top.counts[:, at], self.size[t][at] = (n0, n1), cells
            # a node that turned out small goes on as a group; a large one without gain is a leaf
            good = (gain > _LEAST_GAIN) & (cells > self.limit)
            self.size[t][at[~good & (cells > self.limit)]] = 0
            self.levels[t].append(len(top.left))
            if good.any():
                child = top.split(at[good], feature[good].astype(np.int64), cut[good].astype(np.int64), gain[good], np.stack([l0, l1])[:, good], len(top.left))
                self.tops[t] = Nodes.joined([top, child])
                self.size[t] = np.concatenate([self.size[t], np.stack([low, cells - low], axis=1)[good].ravel()])

    def sent(self, blocks: DataFrame, of_test: bool) -> DataFrame:
        """A message from each block to each open node of each tree: codes, and label and drawn count of
        train cells or place of test cells."""
        tops, features, seed, size = self.tops, self.features, self.seed, self.size

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for _, _, block, payload in (r for b in batches for r in _rows(b)):
                codes, label, n = _cells(payload, features)
                for t, top in enumerate(tops):
                    bag = None if of_test else _drawn(seed, t, block, n)
                    at = top.route(codes, features)
                    for node, mine in _by_node(at):
                        if not size[t][node]:
                            continue
                        if of_test:
                            yield t, node, block, _pack(codes[mine], mine.astype(np.uint32))
                        elif len(mine := mine[bag[mine] > 0]):
                            yield t, node, block, _pack(codes[mine], label[mine], bag[mine].astype(np.uint32))

        return blocks.mapInArrow(lambda batches: _batches(rows(batches)), MESSAGE)

    def grown(self, test: DataFrame) -> DataFrame:
        """From each open node: a message to block -1 (is it a leaf, its counts, importances), and to
        each test block the places of its cells there with their shares of class 1."""
        features, weights, depth, seed = self.features, self.weights, self.depth, self.seed
        begins = self.levels
        n_codes = len(set(features.column.tolist()))

        def work(train: pa.Table, test: pa.Table) -> pa.Table:
            rows = _rows(train)
            if not rows:
                return pa.Table.from_batches([_batch([])])
            t, node = rows[0][:2]
            codes, label, bag = (np.concatenate(c) for c in zip(*(_unpack(r[3], features.dtype, np.uint8, np.uint32) for r in rows)))
            del rows, train
            above = int(np.searchsorted(begins[t], node, "right")) - 1
            by_class = np.stack([bag * (label == c) for c in (0, 1)]).astype(np.float64)
            tree = grow(codes.reshape(len(label), n_codes), by_class, features, weights, depth - above, np.random.default_rng([seed, 3, t, node]))
            share = tree.share(weights)
            head = np.concatenate([[tree.left[0] < 0], tree.counts[:, 0], tree.importance(features, weights)])
            out = [(t, node, -1, _pack(head))]
            for _, _, block, payload in _rows(test):
                codes, place = _unpack(payload, features.dtype, np.uint32)
                out.append((t, node, block, _pack(place, share[tree.route(codes.reshape(len(place), n_codes), features)])))
            return pa.Table.from_batches([_batch(out)])

        # as many tasks as groups, so that a task holds about one
        n = min(2000, max(1, int(sum(((top.left < 0) & (size > 0)).sum() for top, size in zip(self.tops, self.size)))))
        sides = [self.sent(self.train, False), self.sent(test, True)]
        a, b = (s.repartition(n, "tree", "node").groupBy("tree", "node") for s in sides)
        return staged(a.cogroup(b).applyInArrow(work, MESSAGE), "forest-grown")

    def whole(self, test: DataFrame) -> DataFrame:
        """Trees whose root is open, each grown by one task: a message for each tree to block -1 as
        :meth:`grown` sends it, and from each task to each test block the sums of its trees' shares."""
        features, weights, depth, seed = self.features, self.weights, self.depth, self.seed
        spark, trees = self.train.sparkSession, len(self.tops)
        kept = [sorted((r["block"], bytes(r["payload"])) for r in df.select("block", "payload").toLocalIterator()) for df in (self.train, test)]
        shared = spark.sparkContext.broadcast(kept)
        del kept

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            cells, asked = ([(block, *_cells(payload, features)) for block, payload in side] for side in shared.value)
            codes, label = (np.concatenate(c) for c in list(zip(*cells))[1:3])
            sums = [np.zeros(len(label), np.int64) for _, _, label, _ in asked]
            for t in (t for b in batches for t in b.column(0).to_pylist()):
                bag = np.concatenate([_drawn(seed, t, block, n) for block, _, _, n in cells])
                mine = bag > 0
                by_class = np.stack([bag[mine] * (label[mine] == c) for c in (0, 1)]).astype(np.float64)
                tree = grow(codes[mine], by_class, features, weights, depth, np.random.default_rng([seed, 3, t, 0]))
                share = np.rint(tree.share(weights) * _SHARE).astype(np.int64)
                for (_, some, _, _), total in zip(asked, sums):
                    total += share[tree.route(some, features)]
                yield t, 0, -1, _pack(np.concatenate([[tree.left[0] < 0], tree.counts[:, 0], tree.importance(features, weights)]))
            for (block, *_), total in zip(asked, sums):
                yield 0, 0, block, total.tobytes()

        tasks = min(trees, 3 * spark.sparkContext.defaultParallelism)
        return staged(spark.range(0, trees, 1, tasks).mapInArrow(lambda batches: _batches(rows(batches)), MESSAGE), "forest-grown")

    def totals(self, grown: DataFrame, test: DataFrame) -> DataFrame:
        """codes and p1 of every test cell, from the sums that :meth:`whole` sends."""
        features, trees = self.features, len(self.tops)

        def work(got: pa.Table, own: pa.Table) -> pa.Table:
            codes, _, _ = _cells(_rows(own)[0][3], features)
            total = sum(np.frombuffer(payload, np.int64) for payload in got.column("payload").to_pylist())
            return pa.table([pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(total / _SHARE / trees)], names=["codes", "p1"])

        sides = grown.where("block >= 0").groupBy("block"), test.groupBy("block")
        return sides[0].cogroup(sides[1]).applyInArrow(work, "codes binary, p1 double")

    def finish(self, grown: DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
        """Importances; the tops with the counts of the nodes below, pruned, and which of their nodes
        answer for test cells themselves."""
        features, weights = self.features, self.weights
        single = [top.left < 0 for top in self.tops]
        inner = [np.zeros((len(top.left), len(features.column))) for top in self.tops]
        for r in grown.where("block = -1").collect():
            got = _unpack(r["payload"], np.float64)[0]
            self.tops[r["tree"]].counts[:, r["node"]] = got[1:3]
            single[r["tree"]][r["node"]] = got[0] > 0
            inner[r["tree"]][r["node"]] = got[3:]
        total = np.zeros(len(features.column))
        for t, top in enumerate(self.tops):
            # a node with a subtree is no leaf: it and what is above it stay
            closed = np.flatnonzero((top.left < 0) & ~single[t])
            kept = top.left.copy()
            top.left[closed] = len(top.left)  # stands for the subtree while leaves are joined
            for a, b in reversed(list(zip(self.levels[t], [*self.levels[t][1:], len(top.left)]))):
                one = top.counts[1] * weights[1] > top.counts[0] * weights[0]
                for k in range(a, b):
                    low = int(kept[k])
                    if low >= 0 and top.left[low] < 0 and top.left[low + 1] < 0 and one[low] == one[low + 1]:
                        top.left[k], single[t][k] = -1, True
            top.left[closed] = -1
            mine = inner[t].sum(axis=0) + top.importance(features, weights)
            total += mine / mine.sum() if mine.sum() > 0 else 0
        return total / total.sum() if total.sum() > 0 else total, single

    def votes(self, grown: DataFrame, test: DataFrame, single: list[np.ndarray]) -> DataFrame:
        """codes and p1, the mean of the trees' shares, of every test cell."""
        tops, features, weights = self.tops, self.features, self.weights

        def work(got: pa.Table, own: pa.Table) -> pa.Table:
            codes, label, _ = _cells(_rows(own)[0][3], features)
            shares: dict[int, np.ndarray] = {}
            # leaves of the tops answer first; a message from below one of them is not asked
            for t, top in enumerate(tops):
                at = top.route(codes, features)
                shares[t] = np.where(single[t][at], top.share(weights)[at], np.nan)
            for t, _, _, payload in _rows(got):
                place, share = _unpack(payload, np.uint32, np.float64)
                shares[t][place] = np.where(np.isnan(shares[t][place]), share, shares[t][place])
            mean = sum(shares.values()) / len(tops)
            return pa.table([pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(mean)], names=["codes", "p1"])

        sides = grown.where("block >= 0").groupBy("block"), test.groupBy("block")
        return sides[0].cogroup(sides[1]).applyInArrow(work, "codes binary, p1 double")


def forest(rows: DataFrame, key: str, ordered: list[str], categories: dict[str, int], weight: str, trees: int, depth: int, seed: int,
           limit: int = LIMIT, block: int = BLOCK, test_block: int = TEST_BLOCK) -> Forest:
    """Fit on the rows with ``is_test`` 0 and score those with 1. ``label`` is 0 or 1, ``weight`` one
    value for each label; ``categories`` gives the number of values of each, which are 0, 1, ...

    ``pred`` has key, label, prediction and p1, the probability of class 1."""
    train = rows.where("is_test = 0")
    of_class = {int(r[0]): r[1] for r in train.groupBy("label").agg(F.max(weight)).collect()}
    if not of_class or set(of_class) - {0, 1}:
        raise ValueError(f"labels of the training rows must be 0 and 1, not {sorted(of_class)}")
    weights = np.array([of_class.get(c, 1.0) for c in (0, 1)])
    cuts = class_cuts(train, ordered, of_class)
    features = Features.of_columns(cuts, list(categories.values()))
    table = coded(rows, key, ordered, list(categories), cuts, features)
    cells = table.where("is_test = 0").groupBy("codes", "label").agg(F.count(F.lit(1)).alias("n"))
    asked = table.where("is_test = 1").select("codes").distinct().select("codes", F.lit(0).alias("label"), F.lit(1).cast("long").alias("n"))
    train, n_cells = blocks_of(cells, block, features.dtype, "forest-train")
    test, n_asked = blocks_of(asked, test_block, features.dtype, "forest-test")
    work = Grower(train, features, weights, n_cells, trees, depth, seed, limit)
    if max(n_cells, n_asked) <= limit:
        grown = work.whole(test)
        importances, _ = work.finish(grown)
        votes = work.totals(grown, test)
    else:
        work.split_tops()
        grown = work.grown(test)
        importances, single = work.finish(grown)
        votes = work.votes(grown, test, single)
    pred = table.where("is_test = 1").join(votes, "codes").select(
        key, F.col("label").cast("double").alias("label"), (F.col("p1") > 0.5).cast("double").alias("prediction"), "p1")
    return Forest(Vectors.dense(importances), pred)
