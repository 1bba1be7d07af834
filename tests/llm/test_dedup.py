"""op1, op2 and op4 against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from conftest import SF001
from llm.conftest import EDGES
from marketlake.llm import decontaminate, minhash, repeats

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_groups(rows):
    """Smallest id reachable from each id, by comparing all pairs."""
    sets = [(i, plain_set(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10_000)}"
    return " ".join(words)


@pytest.fixture
def near_copies():
    """Families of edited copies around the threshold, a shared passage, short and upper-case texts."""
    rng = random.Random(3)
    rows, vocabulary = [], [f"v{k}" for k in range(3000)]
    for family in range(4):
        words = rng.choices(vocabulary, k=rng.choice([12, 60, 150]))
        rows += [edited(rng, words, rng.randrange(0, 6)) for _ in range(30)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    rows += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.randrange(0, 60))) for _ in range(60)]
    rows += ["one two", "ONE two", "one", "One Two Three Four Five", "one two three four five"]
    rng.shuffle(rows)
    return [(1000 - 3 * k, t) for k, t in enumerate(rows)]


def check_groups(got, want):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_against_all_pairs(docs, near_copies):
    check_groups(minhash.near_duplicates(docs(near_copies)).collect(), plain_groups(near_copies))


def test_near_duplicates_with_long_lists_in_blocks(docs, near_copies, monkeypatch):
    """Lists over SHORT are dealt out in blocks; nothing is lost at their borders."""
    monkeypatch.setattr(minhash, "SHORT", 2)
    monkeypatch.setattr(minhash, "BLOCK", 5)
    check_groups(minhash.near_duplicates(docs(near_copies)).collect(), plain_groups(near_copies))


def test_near_duplicates_edges(docs):
    rows = minhash.near_duplicates(docs(EDGES)).collect()
    assert len(rows) == len(EDGES)
    by = {r.doc_id: r for r in rows}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0
    assert [by[k].component_id for k in (1, 2, 3, 4)] == [1, 2, 3, 4]
    assert by[5].kept and not by[6].kept and by[6].component_id == 5
    assert all(r.kept for r in rows if r.doc_id in (7, None))
    assert minhash.near_duplicates(docs([])).collect() == []


def test_components_of_paths_and_hubs(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r.cid: r.component for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 30)}


def test_sketch_never_needs_more_than_linked_sets_share():
    """least_shared() against random pairs at the threshold."""
    rng = np.random.default_rng(1)
    for n in (8, 40, 48, 60, 100, 400):
        for _ in range(200):
            common = int(np.ceil(0.75 * n))
            union = int(common / 0.75)
            h = rng.permutation(10 * union)[:union]
            a, b = np.sort(h[:common + (union - common) // 2]), np.sort(np.concatenate([h[:common], h[common + (union - common) // 2:]]))
            shared = len(np.intersect1d(a[:minhash.K], b[:minhash.K]))
            for m in (len(a), len(b)):
                need = min(np.ceil(0.75 * m), minhash.K - m // 3) if m <= minhash.K else max(minhash.K - m // 3, minhash.LIKELY)
                assert shared >= max(1, need)


def plain_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_decontamination_against_full_alignment(docs, spark):
    rng, budget = random.Random(11), decontaminate.Budget()
    items = [(k, "".join(rng.choices("abcdefgh é", k=rng.choice([25, 60, 150, 330])))) for k in range(12)] + [(50, None), (51, "short"), (52, "")]
    texts = []
    for k in range(80):
        s = list(rng.choice(items[:12])[1])
        for _ in range(rng.randrange(0, 14)):
            p = rng.randrange(len(s))
            rng.choice([lambda: s.__setitem__(p, "x"), lambda: s.insert(p, "y"), lambda: s.pop(p)])()
        texts.append((k, "".join(rng.choices("klmnop ", k=80)) + "".join(s).upper() + "".join(rng.choices("klmnop ", k=80))))
    want = {}
    for d, t in texts:
        for i, b in items[:12]:
            best = min(plain_edits(s, decontaminate.normalised(t)) - budget.edits(len(s)) for s in decontaminate.segments(decontaminate.normalised(b), budget))
            if best <= 0:
                want[d, i] = True
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find(docs(texts), table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == set(want) and len(got) == len(want)
    blocks = decontaminate.Budget(block_chars=2000)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(docs(texts), table, blocks).collect()} == set(want)
    left = {r.doc_id for r in decontaminate.clean(docs(texts), table, blocks).collect()}
    assert left == {d for d, _ in texts} - {d for d, _ in want}


def test_decontamination_edges(docs, spark):
    table = spark.createDataFrame([(1, "same text here and some more of it"), (1, "same text here and some more of it")], "item_id long, text string")
    rows = EDGES + [(20, "x " * 500 + "SAME  text\nhere and some more of it"), (20, "Same text here and some more of it.")]
    assert sorted((r.doc_id, r.item_id, r.edits) for r in decontaminate.find(docs(rows), table).collect()) == [(20, 1, 0), (20, 1, 0)]
    assert decontaminate.clean(docs(rows), table).count() == len(EDGES)
    assert decontaminate.find(docs([]), table).collect() == []
    assert decontaminate.find(docs(rows), table.limit(0)).collect() == []
    assert decontaminate.clean(docs(rows), table.limit(0)).count() == len(rows)


def plain_repeats(rows, length=50):
    first, out = {}, {}
    for i, t in rows:
        b = t.encode()
        for s in range(len(b) - length + 1):
            first[b[s:s + length]] = min(i, first.get(b[s:s + length], i))
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < i:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def found(df, **options):
    return {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans) // 2, r.kept_sha256) for r in repeats.find_repeats(df, **options).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_repeats_against_every_string(docs, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choices("ab cé", k=400)) for _ in range(5)] + ["z" * 300, "xy" * 150]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.randrange(0, 6)):
            x = rng.choice(base)
            a = rng.randrange(len(x) - 40)
            text += x[a:a + rng.randrange(30, 140)] + "".join(rng.choices("pqrs ", k=rng.randrange(0, 40)))
        rows.append((7 * i - 50, text))
    assert found(docs(rows), block_bytes=2000, part_bytes=5000) == plain_repeats(rows)


def test_repeats_in_pieces(docs, monkeypatch):
    """Texts longer than a piece are parsed in overlapping pieces with equal results."""
    monkeypatch.setattr(repeats, "PIECE", 256)
    rng = random.Random(9)
    base = "".join(rng.choices("abcdef ", k=900))
    rows = [(k, "".join(rng.choices("uvw", k=rng.randrange(0, 300))) + base[rng.randrange(300):][:rng.randrange(40, 800)]) for k in range(12)]
    texts = [t.encode() for _, t in rows]
    whole = repeats.Phrases(texts, 50, 16)
    n = sum(max(0, len(t) - 49) for t in texts)
    assert int((whole.last - whole.first + 1).sum()) == n
    assert plain_repeats(rows) == {i: v for i, v in found_local(rows).items()}


def found_local(rows):
    """The steps of find_repeats without Spark: one block, one part."""
    import pyarrow as pa

    table = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows], "block": pa.array([0] * len(rows), pa.int32())})
    answers = None
    for step in ("ask_triggers", "ask_dictionary", "ask_suffixes"):
        answers = repeats._answer(repeats._messages(getattr(repeats.Block(table, answers, 50, 16, 1), step)()))
    return {i: (n, gone, len(spans) // 2, sha) for i, n, gone, spans, sha in repeats.Block(table, answers, 50, 16, 1, "none").removed(50)}


def test_repeats_edges(docs):
    rows = found(docs([(i, t) for i, t in EDGES if i != 7]))
    assert rows[1] == rows[2] == (0, 0, 0, hashlib.sha256(b"").hexdigest())
    assert rows[9][1] == 0 and rows[8][1] == 0  # repeats inside one document stay
    assert len(repeats.find_repeats(docs(EDGES)).collect()) == len(EDGES)
    twice = "a passage that is longer than fifty bytes, for certain it is"
    got = repeats.find_repeats(docs([(7, twice), (7, twice), (None, twice), (8, "x" + twice)])).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_removed) for r in got) == [((False, 7), 0), ((False, 7), 0), ((False, 8), len(twice)), ((True, 0), 0)]
    assert repeats.find_repeats(docs([])).collect() == []


def test_repeats_on_documents(spark):
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    assert found(table) == plain_repeats([(r.doc_id, r.text or "") for r in table.collect()])


def test_quotes_and_short_items_are_found():
    """Exact quotes of 70 characters and more, at every offset, and whole items under 20 characters."""
    rng, budget = random.Random(21), decontaminate.Budget()
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(400)]
    for size in (130, 180, 233, 394):
        item = decontaminate.normalised(" ".join(rng.choices(words, k=90)))[:size].strip()
        index = decontaminate.Index([(1, item)], budget)
        for share in (0.3, 0.4, 0.5, 0.7, 0.9):
            quote = max(70, int(share * size))
            for at in range(0, len(item) - quote + 1):
                assert decontaminate.matches("zz 1 " * 9 + item[at:at + quote] + " 2 yy" * 9, index)
        assert not decontaminate.matches(" ".join(rng.choices(words, k=300)), index)
    index = decontaminate.Index([(1, "什么是光合作用？"), (2, "Who wrote Emma?"), (3, "art")], budget)
    assert set(decontaminate.matches("问题：什么是光合作用？答案", index)) == {1}
    assert set(decontaminate.matches("Now,  who wrote\nEMMA? A party.", index)) == {2}
    assert set(decontaminate.matches("Modern art.", index)) == {3}


def test_repeats_spread_what_blocks_know_over_the_parts(monkeypatch):
    """Found spans are as much as the input: no part passes on those of all blocks."""
    import numpy as np
    import pyarrow as pa

    from marketlake.llm import repeats
    monkeypatch.setattr(repeats, "_POWER", {})  # other tests change the size of pieces
    r, parts, blocks = np.random.default_rng(3), 3, 6
    word = lambda n: "".join(map(chr, r.integers(97, 123, n)))
    shared = word(200)
    texts = {i: word(149) + chr(65 + i) + shared + chr(65 + i) + word(149) for i in range(2 * blocks)}
    docs = {b: pa.table({"doc_id": [i for i in texts if i % blocks == b], "text": [texts[i] for i in texts if i % blocks == b],
                         "block": pa.array([b, b], pa.int32())}) for b in range(blocks)}
    answers, sent = {b: None for b in docs}, []
    for step, parse in (("ask_triggers", "triggers"), ("ask_dictionary", "all"), ("ask_suffixes", "all")):
        sent = [row for b in docs for row in getattr(repeats.Block(docs[b], answers[b], 50, 16, parts, parse), step)()]
        back = [row for p in range(parts) for row in repeats._rows(repeats._answer(repeats._messages([x for x in sent if x[1] == p])))]
        answers = {b: repeats._messages([x for x in back if x[0] == b]) for b in docs}
    spans = [p for _, p, kind, _ in sent if kind == repeats.CARRIED + repeats.SPANS]
    assert sorted(spans) == [0, 0, 1, 1, 2, 2]
    got = {row[0]: row[1:4] for b in docs for row in repeats.Block(docs[b], answers[b], 50, 16, parts, "none").removed(50)}
    assert got[0] == (500, 0, []) and all(got[i] == (500, 200, [150, 350]) for i in range(1, 2 * blocks))
