"""Quality classifier: a sparse rule ensemble.

Shallow trees are grown over text statistics; every path from a root to a node becomes a rule,
a conjunction of threshold conditions. A logistic regression with lasso penalty over the rules
keeps a few of them with weights, and the result is compiled into one Spark column expression:
``1 / (1 + exp(-(bias + sum of the weights of the rules that hold)))``.

Labels are learned only from rows outside the held-out fold (crc32(id) mod 3 is not 1), from at
most about ``fit_rows`` of them (by a hash of the id; the bound is this parameter). Statistics
are computed from whole texts for all documents and staged once.

Null texts count as empty; their statistics are 0 and they get a score like any other. Null ids
belong to no fold (held_out null) and are never learned from; repeated rows get equal scores. If
the learning rows hold no label or one class only, every score is that class's share (0.5
without labels). Further columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import crc_mod, map_batches, mix, staged, texts_of, window_hash

STATS = ["n_chars", "n_words", "mean_word", "longest_word", "distinct_words", "n_lines", "mean_line", "repeat_lines",
         "letters", "uppers", "digits", "blanks", "sentence_marks", "symbols", "pipes", "non_ascii", "top_word", "repeat_grams"]
_UPPER, _LOWER, _DIGIT, _BLANK, _STOP, _SYMBOL, _PIPE, _HIGH = range(8)
_CLASS = np.full(256, 8, np.int64)
for _chars, _k in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), (b"abcdefghijklmnopqrstuvwxyz", _LOWER), (b"0123456789", _DIGIT),
                   (b" \t\n\x0b\x0c\r", _BLANK), (b".,;:!?", _STOP), (b"#*$%&<>@^~_=+\\/{}[]", _SYMBOL), (b"|", _PIPE)):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = _HIGH


def text_stats(text: str) -> list[float]:
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, w = len(raw), len(words)
    if not n:
        return [0.0] * len(STATS)
    c = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9) / n
    counts = Counter(words)
    grams = window_hash(mix(np.fromiter(map(hash, words), np.int64, w).view(np.uint64)), 4)
    return [float(len(text)), float(w), sum(map(len, words)) / max(1, w), float(max(map(len, words), default=0)),
            len(counts) / max(1, w), float(len(lines)), n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
            c[_UPPER] + c[_LOWER] + c[_HIGH], c[_UPPER], c[_DIGIT], c[_BLANK], c[_STOP], c[_SYMBOL], c[_PIPE], c[_HIGH],
            max(counts.values(), default=0) / max(1, w), 1 - len(np.unique(grams)) / max(1, len(grams))]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([text_stats(t) for t in texts_of(batch, text_col)]).reshape(-1, len(STATS))
        return pa.RecordBatch.from_arrays([batch.column(id_col), *(pa.array(rows[:, k]) for k in range(len(STATS)))], names=[id_col, *STATS])

    return map_batches(docs.select(id_col, text_col), work, f"{id_col} {kind}, " + ", ".join(f"{s} double" for s in STATS))


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, whether at most, threshold); all must hold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, at_most, bound in self.conditions:
            out = out & (F.col(name) <= F.lit(bound) if at_most else F.col(name) > F.lit(bound))
        return out


_NODE = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)$")


def tree_rules(described: str) -> list[Rule]:
    """A rule for every node below the root, from a tree's printed form."""
    path: list[tuple[int, tuple[str, bool, float]]] = []
    out = []
    for line in described.splitlines():
        if m := _NODE.match(line):
            depth = len(m[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (STATS[int(m[3])], m[4] == "<=", float(m[5]))))
            bounds: dict[tuple[str, bool], float] = {}  # the tightest bound of each kind
            for _, (name, at_most, bound) in path:
                key = (name, at_most)
                bounds[key] = (min if at_most else max)(bounds.get(key, bound), bound)
            out.append(Rule(tuple(sorted((n, a, b) for (n, a), b in bounds.items()))))
    return out


@dataclass(frozen=True)
class RuleEnsemble:
    bias: float
    weights: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.weights:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", fit_rows: int = 40_000,
        trees: int = 16, depth: int = 3, penalty: float = 0.0005) -> RuleEnsemble:
    """Grow trees, extract rules, fit lasso weights. ``labels`` may repeat an id; rows with
    conflicting labels all count."""
    rows = stats.where(crc_mod(id_col, 3) != 1).join(
        labels.where(F.col(label).isNotNull()).select(F.col(id_col), F.col(label).cast("double").alias("label")), id_col)
    n = rows.groupBy("label").count().collect()  # a row per class
    total = sum(r["count"] for r in n)
    if len(n) < 2:
        share = 0.5 if not n else min(max(n[0]["label"], 1e-6), 1 - 1e-6)
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    chosen = rows.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < F.lit(min(1.0, fit_rows / total) * (1 << 30)))
    table = chosen.select("label", *STATS).coalesce(6).persist()
    try:
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, minInstancesPerNode=5, subsamplingRate=0.8) \
            .fit(table.select("label", array_to_vector(F.array(*STATS)).alias("features")))
        rules = list(dict.fromkeys(r for t in forest.trees for r in tree_rules(t.toDebugString)))
        held = F.array(*(r.column().cast("double") for r in rules))
        lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60) \
            .fit(table.select("label", array_to_vector(held).alias("features")))
    finally:
        table.unpersist()
    weights = lasso.coefficients.toArray()
    return RuleEnsemble(float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-9))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fitting) -> DataFrame:
    """Per document: id, held_out, score and predicted."""
    stats = staged(statistics(docs, id_col, text_col), "quality-stats")
    model = fit(stats, labels, id_col=id_col, **fitting)
    return stats.select(id_col, (crc_mod(id_col, 3) == 1).alias("held_out"), model.column().alias("score")) \
        .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
