"""The forest of operators.forest: exact cuts, pruned leaves, pyspark.ml's scores within noise, and
the same rows for any partitioning and split between driver and groups."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators import forest as fo


def _rows(spark, n=3000, seed=5):
    r = np.random.default_rng(seed)
    x, z, c = r.normal(size=n), r.integers(0, 4, n), r.integers(0, 5, n)
    y = (x + (c == 2) + 0.7 * r.normal(size=n) > 0.6).astype(int)
    w = {k: n / (2 * (y == k).sum()) for k in (0, 1)}
    rows = [(i, float(y[i]), int(i % 4 == 0), float(x[i]), float(z[i]), float(c[i]), float(w[y[i]])) for i in range(n)]
    return spark.createDataFrame(rows, "k long, label double, is_test int, x double, z double, c double, weight double")


def _forest(df, **more):
    return fo.forest(df, "k", ["x", "z"], {"c": 6}, "weight", **{"trees": 20, "depth": 30, "seed": 7, **more})


def _scores(f):
    return {r.k: (r.label, r.prediction, r.p1) for r in f.pred.collect()}


def test_cut_points_are_midpoints_of_few_values_and_even_weights_of_many():
    assert fo.cut_points(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4)) == [1.5, 2.5]
    many = fo.cut_points(np.arange(3200.0), np.ones(3200))
    assert len(many) == 31 and all(abs(b - a - 100) <= 1 for a, b in zip(many, many[1:]))


def test_best_cut_against_all_cuts():
    r = np.random.default_rng(1)
    w = np.array([0.7, 2.5])
    counts = r.integers(0, 9, (2, 12)).astype(float) + 1
    group, bins = np.repeat([0, 1], 6), np.tile(np.arange(6), 2)

    def gini(c):
        p = c * w / (c * w).sum()
        return 1 - (p * p).sum()

    gain, cut, left = fo.best_cuts(group, bins, counts, w)
    for g in (0, 1):
        own = counts[:, group == g]
        total = (own.sum(axis=1) * w).sum()
        part = lambda c: (c * w).sum() / total * gini(c)
        want = [gini(own.sum(axis=1)) - part(own[:, :b + 1].sum(axis=1)) - part(own[:, b + 1:].sum(axis=1)) for b in range(5)]
        assert abs(gain[g] - max(want)) < 1e-12 and cut[g] == int(np.argmax(want))
        assert (left[:, g] == own[:, :cut[g] + 1].sum(axis=1)).all()


def test_sibling_leaves_of_one_class_are_joined_and_depth_is_kept():
    features = fo.Features.of_columns([[0.5], [0.5]], [])
    codes = np.array([[0, 0], [0, 1], [1, 0], [1, 1]], np.uint8)
    bag = np.array([[9.0, 8, 1, 1], [1, 2, 9, 9]])
    one = np.ones(2)
    tree = fo.grow(codes, bag, features, one, 30, np.random.default_rng(0))
    assert (tree.left >= 0).sum() == 1  # the second level tells no classes apart
    assert tree.share(one)[tree.route(codes, features)].tolist() == [3 / 20, 3 / 20, 18 / 20, 18 / 20]
    assert fo.grow(codes, bag, features, one, 0, np.random.default_rng(0)).left.tolist() == [-1]


def test_rows_that_agree_are_drawn_as_rows():
    n = np.full(20000, 7)
    drawn = fo._drawn(42, 3, 5, n)
    assert abs(drawn.mean() - 7) < 0.1 and abs(drawn.var() - 7) < 0.3 and (drawn == fo._drawn(42, 3, 5, n)).all()


def test_scores_do_not_depend_on_partitions(spark):
    df = _rows(spark)
    a, b = _forest(df, trees=5), _forest(df.repartition(7, "x"), trees=5)
    assert _scores(a) == _scores(b) and a.featureImportances == b.featureImportances
    assert set(_scores(a)) == {i for i in range(0, 3000, 4)}


@pytest.mark.parametrize("limit", [150, 100_000])
def test_scores_are_those_of_spark_within_noise(spark, limit):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    df = _rows(spark)
    rf = RandomForestClassifier(numTrees=20, maxDepth=30, seed=7, weightCol="weight")
    one_hot = [F.when(F.col("c") == v, 1.0).otherwise(0.0).alias(f"c{v}") for v in range(6)]
    wide = df.select("*", *one_hot)
    model = Pipeline(stages=[VectorAssembler(inputCols=["x", "z", *(f"c{v}" for v in range(6))], outputCol="features"), rf]).fit(wide.where("is_test = 0"))
    want = {r.k: r.p for r in model.transform(wide.where("is_test = 1")).select("k", vector_to_array("probability")[1].alias("p")).collect()}
    found = _forest(df, limit=limit, block=500, test_block=200)
    got = _scores(found)
    assert got.keys() == want.keys()
    keys = sorted(got)
    mine, theirs = np.array([got[k][2] for k in keys]), np.array([want[k] for k in keys])
    assert np.corrcoef(mine, theirs)[0, 1] > 0.9 and abs(mine.mean() - theirs.mean()) < 0.03
    right = lambda p: np.mean([(x > 0.5) == got[k][0] for k, x in zip(keys, p)])
    assert abs(right(mine) - right(theirs)) < 0.04
    assert np.abs(found.featureImportances.toArray() - model.stages[-1].featureImportances.toArray()).max() < 0.06


def test_the_driver_holds_only_the_tops(spark):
    """Large nodes are split by histograms, every open node then has at most ``limit`` cells."""
    df = _rows(spark)
    weights = np.array([1.0, 2.0])
    cuts = fo.class_cuts(df, ["x", "z"], {0: 1.0, 1: 2.0})
    features = fo.Features.of_columns(cuts, [6])
    cells = fo.coded(df, "k", ["x", "z"], ["c"], cuts, features).groupBy("codes", "label").agg(F.count(F.lit(1)).alias("n"))
    blocks, n = fo.blocks_of(cells, 100, features.dtype, "t")
    work = fo.Grower(blocks, features, weights, n, 4, 30, 1, 150)
    work.split_tops()
    for top, size in zip(work.tops, work.size):
        assert len(top.left) > 1 and size[top.left < 0].max() <= 150
        inner = top.left >= 0
        assert (top.counts[:, inner] == top.counts[:, top.left[inner]] + top.counts[:, top.left[inner] + 1]).all()


def test_tiny_and_one_class_inputs(spark):
    one = spark.createDataFrame([(i, 0.0, int(i > 6), float(i), 0.0, 0.0, 1.0) for i in range(9)],
                                "k long, label double, is_test int, x double, z double, c double, weight double")
    assert {(p, s) for _, p, s in _scores(_forest(one, trees=3)).values()} == {(0.0, 0.0)}
    assert _forest(one.where("is_test = 0"), trees=3).pred.count() == 0
    with pytest.raises(ValueError, match="labels"):
        _forest(one.withColumn("label", F.lit(2.0)))


def _plain(codes, bag, features, weights, depth, rng):
    """(feature, cut, left) of every split, a node at a time in the order of their levels."""
    out, level = [], [np.arange(len(codes))]
    for _ in range(depth):
        level = [rows for rows in level if (bag[:, rows].sum(axis=1) > 0).all()]
        if not level:
            return out
        children = []
        for rows, drawn in zip(level, features.draw(rng, len(level))):
            best = (-1.0, 0, 0, None)
            for f in drawn.tolist():
                b = features.bins(codes[rows], np.full(len(rows), f))
                counts = np.stack([np.bincount(b, w[rows], fo.BINS) for w in bag])
                some = np.flatnonzero(counts.any(axis=0))
                gain, cut, _ = fo.best_cuts(np.zeros(len(some), int), some, counts[:, some], weights)
                if gain[0] > best[0]:
                    best = (gain[0], f, int(cut[0]), rows[b <= cut[0]], rows[b > cut[0]])
            if best[0] > fo._LEAST_GAIN:
                out.append((best[1], best[2], bag[:, best[3]].sum(axis=1).tolist()))
                children += best[3:]
        level = children
    return out


def _grown(codes, bag, features, weights, monkeypatch, one):
    monkeypatch.setattr(fo, "_ONE", one)
    monkeypatch.setattr(fo.Nodes, "prune", lambda *_: None)
    tree = fo.grow(codes, bag, features, weights, 12, np.random.default_rng(3))
    inner = np.flatnonzero(tree.left >= 0)
    return [(int(tree.feature[k]), int(tree.cut[k]), tree.counts[:, tree.left[k]].tolist()) for k in inner]


@pytest.mark.parametrize("one", [float(1 << 26), 1.0])  # both classes added up in one number, or each by itself
@pytest.mark.parametrize("ordered", [3, 11])
def test_levels_grow_as_node_by_node(monkeypatch, one, ordered):
    r = np.random.default_rng(9)
    features = fo.Features.of_columns([[k + 0.5 for k in range(5 + j)] for j in range(ordered)], [4, 7])
    codes = np.stack([*(r.integers(0, 6 + j, 900) for j in range(ordered)), r.integers(0, 4, 900), r.integers(0, 7, 900)], axis=1).astype(np.uint8)
    bag, weights = r.integers(0, 3, (2, 900)).astype(float), np.array([0.6, 2.5])
    bag[0, bag.sum(axis=0) == 0] = 1
    want = _plain(codes, bag, features, weights, 12, np.random.default_rng(3))
    assert len(want) > 100 and _grown(codes, bag, features, weights, monkeypatch, one) == want


def test_small_roots_are_grown_without_moving_cells_for_each_tree(spark, monkeypatch):
    """Where all cells fit a group, trees are grown from one copy of the cells; votes are those of the moved cells."""
    df = _rows(spark, 400)
    whole = _forest(df, trees=6)
    monkeypatch.setattr(fo.Grower, "whole", lambda self, test: self.grown(test))
    monkeypatch.setattr(fo.Grower, "totals", lambda self, grown, test: self.votes(grown, test, [top.left < -1 for top in self.tops]))
    moved = _forest(df, trees=6)
    assert whole.featureImportances == moved.featureImportances
    a, b = _scores(whole), _scores(moved)
    assert a.keys() == b.keys() and max(abs(a[k][2] - b[k][2]) for k in a) < 1e-12
    sent = []
    monkeypatch.undo()
    monkeypatch.setattr(fo.Grower, "sent", lambda self, *_: sent.append(1))
    _forest(df, trees=2)
    assert not sent
