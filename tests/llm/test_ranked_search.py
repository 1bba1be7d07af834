"""op11: the treap search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from conftest import SF001
from llm.conftest import EDGES
from marketlake.llm import ranked_search
from marketlake.llm.common import staged
from marketlake.llm.queries import QUERIES
from marketlake.session import held_settings
from tools.check_oracle import _digest

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=20):
    counts = [(i, Counter(terms(t))) for i, t, *_ in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in {(i, t or "") for i, t in items}:
        scores = []
        for i, c in counts:
            m = 75 + (25 * c.total() * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(i, t, "clash") for i, t in rows], "item_id long, text string, rank string")


def result(docs, items, **kw):
    return sorted(map(tuple, ranked_search.ranked(docs, items, **kw).collect()), key=str)


def made(r, n_docs, n_items, vocabulary):
    text = lambda most: " ".join(r.choice(vocabulary[:r.choice([5, 50, len(vocabulary)])]) for _ in range(r.randrange(most)))
    return [(i, text(60)) for i in r.sample(range(10 * n_docs), n_docs)], [(i, text(25)) for i in range(n_items)]


@pytest.mark.parametrize("seed", [1, 2])
def test_search_against_plain(docs, items, monkeypatch, seed):
    r = random.Random(seed)
    monkeypatch.setattr(ranked_search, "BLOCK_TOKENS", 700)  # many blocks
    monkeypatch.setattr(ranked_search, "ITEM_CHARS", 1500)   # several query blocks
    monkeypatch.setattr(ranked_search, "BATCH", 8)
    monkeypatch.setattr(ranked_search, "STRIP_CELLS", 60)
    d, q = made(r, 400, 30, [f"W{i}" if i % 3 else f"é{i}" for i in range(300)])
    assert result(docs(d), items(q)) == plain(d, q)


def test_edges(docs, items):
    q = [(1, None), (2, ""), (3, "...!"), (4, "same TEXT same"), (5, "漢字 σίσυφος Σίσυφος naïve"), (6, "word long many unseen"), (6, "word long many unseen"),
         (6, "other text of the same id"), (None, "twice no id"), (7, "a" * 60_000), (8, "words-many;of\tthe endoftext " * 3_000)]
    assert result(docs(EDGES), items(q)) == plain(EDGES, q)
    assert result(docs([]), items(q)) == [] and result(docs(EDGES), items([])) == [] and result(docs([(1, None)]), items(q)) == []
    assert result(docs([(3, "one")]), items([(1, "ONE one")])) == plain([(3, "one")], [(1, "ONE one")])


def test_ties_go_to_the_smaller_id_across_blocks(docs, items, monkeypatch):
    """A third of all documents are one text; ids are shuffled over the blocks."""
    monkeypatch.setattr(ranked_search, "BLOCK_TOKENS", 40)
    d = [(i, "the same copy") for i in random.Random(5).sample(range(1000), 300)] + [(2000 + i, f"other text {i}") for i in range(600)]
    q = [(1, "same copy"), (2, "text 17")]
    assert result(docs(d), items(q)) == plain(d, q)
    assert result(docs(d), items(q), k=3) == plain(d, q, 3)


@pytest.mark.parametrize("shape", [(1, 1), (1, 9), (300, 5), (64, 64)])
def test_treap_cells_hold_the_maxima_below(shape):
    r = np.random.default_rng(shape[0])
    rows, cols = np.divmod(r.choice(shape[0] * shape[1], size=max(1, shape[0] * shape[1] // 3), replace=False), shape[1])
    weights = r.integers(1, 10**6, len(rows))
    levels = max(int(rows.max()), int(cols.max())).bit_length()
    bits, maxima = ranked_search.treap(rows, cols, weights, levels)
    less = ranked_search.differences(bits, maxima)
    block = ranked_search.Treap(levels, np.packbits(bits, bitorder="little").tobytes(), ranked_search._packed(less), shape[1])
    assert (block.best[:-1] == maxima).all() and len(maxima) == 1 + bits.sum()
    for row, col, w in zip(rows, cols, weights):
        cell = 0
        for b in reversed(range(levels)):
            assert block.best[cell] >= w
            cell = int(block.child(np.array([cell]), np.array([2 * ((row >> b) & 1) + ((col >> b) & 1)]))[0])
        assert block.best[cell] == w


def test_search_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = QUERIES["op11_ranked_search"](spark, SF001)
    res = con.execute(ranked_search.ORACLE)
    assert _digest([tuple(r) for r in df.collect()], df.columns)[0] == _digest(res.fetchall(), [d[0] for d in res.description])[0]


def test_blocks_run_over_batches(spark, docs):
    """Batches are small, blocks are not: rows of the grid don't multiply with the batches."""
    df = docs([(i, f"common word{i}") for i in range(40)]).coalesce(1)
    with held_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        found = ranked_search.grids(df).select("ids", "n_docs").collect()
    assert [sorted(r.ids) for r in found] == [list(range(40))] and found[0].n_docs == 40


def test_large_rows_are_read_and_written_few_at_a_time(spark, docs, items, monkeypatch):
    wide = spark.createDataFrame([(i, random.Random(i).randbytes(3 << 20)) for i in range(8)], "id long, x binary").coalesce(1)
    at = staged(wide, "wide", large_rows=True)
    files = [f for f in at.inputFiles() if f.endswith(".parquet")]
    assert sum(pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).num_row_groups for f in files) > 1
    seen = []
    monkeypatch.setattr(ranked_search, "staged", lambda df, name, *a, **k: (seen.append((name, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))), staged(df, name, *a, **k))[1])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert result(docs([(1, "alpha beta"), (2, "beta")]), items([(7, "alpha")]))
    assert seen == [("search-grids", "1000"), ("search-treaps", "1"), ("search-found", "1")]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
