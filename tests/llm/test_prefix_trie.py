"""op12: the trie against one grown turn by turn in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from conftest import SF001
from marketlake.llm import prefix_trie
from marketlake.llm.queries import QUERIES, trie_of
from tools.check_oracle import _digest

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs int"


def rebuilt(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            convs[c].append(((turn is not None, turn or 0), tie, (role, text)))
    own = {c: [t for *_, t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5 * (1 if c > 0 else -1)
        out[c] = own.get(c - rest, [])[:h] + own[c][h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for prefix, held in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        has_child = {p[:-1] for p in members if p}
        ends = ",".join(str(c) for c in sorted(held) if len(convs[c]) == len(prefix))
        out.append((min(held), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(held),
                    sum(len(p) == len(prefix) + 1 for p in below), sum(p not in has_child for p in below),
                    sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows):
    table = spark.createDataFrame([(*r, "clash", 0) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, trie_of(table).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_plain(spark, seed):
    r = random.Random(seed)
    texts = ["hello", "", None, "naïve 漢字", "long " * 50]
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(texts)) for c in range(-7, 40) if r.random() < .8
            for t in range(r.choice([0, 1, 2, 3, 8, 13]))]
    assert result(spark, rows) == plain_trie(rebuilt(rows))


def test_edges(spark):
    rows = [(None, 0, "user", "no id"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", "tie"), (1, 0, "user", "tie"),
            (2, 5, "user", "x"), (3, 5, "user", "x"), (5, 1, "user", "base"), (6, 1, "user", "y"), (9, 1, "user", "a" * 100_000),
            (10 ** 12, 1, "user", "big"), (10 ** 12 + 1, 1, "user", "big"), (-1, 1, "user", "x"), (-6, 2, "user", "x")]
    assert result(spark, rows) == plain_trie(rebuilt(rows))
    assert result(spark, []) == []
    assert result(spark, [(None, 0, "user", "no id")]) == []
    # id 1 has h > 1 and no base: nothing of it is left, the root has a member without turns
    assert [(x[0], x[1], x[3]) for x in result(spark, [(1, 0, "user", "only")])] == [(1, 0, 1)]


def test_copies_and_one_very_long_conversation(spark):
    """A third of the conversations are copies; one conversation holds a third of all turns."""
    rows = [(5 * c, t, "user", f"copy {t}") for c in range(1, 60) for t in range(3)]
    rows += [(5 * c, t, "user", f"{c % 7} {t}") for c in range(100, 160) for t in range(3)]
    rows += [(1000, t, "user", f"turn {t % 3}") for t in range(130)]
    assert result(spark, rows) == plain_trie(rebuilt(rows))


def test_member_list_in_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", 2)
    rows = [(5 * c, 0, "user", "same") for c in range(-20, 40)]
    assert result(spark, rows) == plain_trie(rebuilt(rows))


def test_trie_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF001}/conversations.parquet')")
    df = QUERIES["op12_prefix_trie"](spark, SF001)
    res = con.execute(prefix_trie.ORACLE)
    assert _digest([tuple(r) for r in df.collect()], df.columns)[0] == _digest(res.fetchall(), [d[0] for d in res.description])[0]
