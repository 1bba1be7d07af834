"""op13: water-filling and repetitions against a plain round-by-round version."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest

from conftest import SF001
from llm.conftest import DOCS
from marketlake.llm import mixing
from marketlake.llm.queries import QUERIES
from tools.check_oracle import _digest


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(1, 2, 3), epochs=3):
    """Redistribution round by round, in exact fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, clamped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(epochs * sizes[s] for s in clamped)
        free = [s for s in names if s not in clamped]
        for s in free:
            target[s] = Fraction(left * weight[s], sum(weight[x] for x in free))
        over = {s for s in free if target[s] > epochs * sizes[s]}
        if not over:
            return target
        clamped |= over
        target.update({s: Fraction(epochs * sizes[s]) for s in over})


def plain_mix(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += words(text)
    targets, out = plain_targets(sizes), []
    of = defaultdict(list)
    for i, text, source in rows:
        key = hashlib.md5("|".join(["mix", *([] if i is None else [str(i)]), *([] if text is None else [text])]).encode()).hexdigest()
        of[source].append((key, i, words(text)))
    for source, docs in of.items():
        whole = min(3, targets[source] // sizes[source]) if sizes[source] else 0
        rest, upto = (targets[source] - whole * sizes[source]) if whole < 3 else 0, 0
        for _, i, n in sorted(docs, key=lambda x: (x[0], x[1] or 0)):
            more = upto + n <= rest or (upto <= rest and 2 * (rest - upto) >= n)
            upto += n
            out.append((i, n, sizes[source], round(float(targets[source]), 6), n * (whole + more)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


@pytest.fixture
def tables(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, 1, "clash") for i, t, s in rows], DOCS).withColumnRenamed("n_tokens", "size").repartition(3)
    return make


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_against_the_plain_version(tables, seed):
    r = random.Random(seed)
    names = [None, "a", "b", "B", "é", "z", "src10", "src2"]
    rows = [(i, " ".join("w" * r.randrange(1, 4) for _ in range(r.choice([0, 1, 3, 40, 300]))), "hot" if r.random() < .4 else r.choice(names))
            for i in range(400)]
    assert result(mixing.mix(tables(rows))) == plain_mix(rows)


def test_mix_edges(tables):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t\x0b ", "b"), (4, "one", "b"), (None, "no id here", None), (None, None, None),
            (7, "same words", "c"), (7, "same words", "c"), (7, "other words too", "c"), (8, "x " * 50_000, "d"), (9, "a b", "c")]
    got = result(mixing.mix(tables(rows)))
    assert got == plain_mix(rows)
    assert all(0 <= taken <= 3 * n for _, n, _, _, taken in got)
    assert mixing.mix(tables([])).collect() == []
    assert result(mixing.mix(tables([(1, None, "a"), (2, " ", None)]))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_equal_rows_are_split_and_targets_met(tables):
    """A third of all rows are one document repeated: the border runs through equal rows."""
    rows = [(None, "copy of copies", "hot")] * 700 + [(i, "word " * (1 + i % 30), f"s{i % 9}") for i in range(900)]
    got = mixing.mix(tables(rows)).collect()
    by_source = defaultdict(lambda: [0, 0, 0])
    for r in got:
        at = by_source["hot" if r.doc_id is None else r.doc_id % 9]
        at[:] = at[0] + r.taken, r.target, max(at[2], r["size"])
    assert len(by_source) == 10
    assert all(abs(taken - target) <= largest / 2 + 1e-6 for taken, target, largest in by_source.values())
    assert result(mixing.mix(tables(rows))) == result(mixing.mix(tables(rows)))


def test_budget_weights_and_epochs(tables):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(100)]
    taken = Counter()
    for r in mixing.mix(tables(rows), weights=(1, 4), epochs=2, budget=250).collect():
        taken[r.target] += r.taken
    assert taken == {50.0: 50, 200.0: 200}
    assert all(r.taken == 20 for r in mixing.mix(tables(rows), epochs=2, budget=10 ** 9).collect())


def test_mix_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    df = QUERIES["op13_mixing"](spark, SF001)
    res = con.execute(mixing.ORACLE)
    assert _digest([tuple(r) for r in df.collect()], df.columns)[0] == _digest(res.fetchall(), [d[0] for d in res.description])[0]


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op13_mixing"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
