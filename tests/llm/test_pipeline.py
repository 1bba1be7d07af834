"""The pipeline, stage by stage, against brute force on a small corpus."""

from __future__ import annotations

import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF001
from llm.test_dedup import plain_groups


def test_stages_on_a_small_corpus(spark, tmp_path):
    rng = random.Random(4)
    words = {"en": "the river and a house with many windows near that old green forest".split(),
             "fr": "la rivière et une maison avec beaucoup de fenêtres près du bois vert".split()}
    texts = [(k, " ".join(rng.choices(words[("en", "fr")[k % 2]], k=60)), ("en", "fr")[k % 2]) for k in range(60)]
    item = " ".join(rng.choices(words["en"], k=20))
    texts += [(100, texts[3][1], "fr"), (101, texts[4][1].upper(), "en"), (102, f"{texts[5][1]} {item} more", "fr"), (103, "12 ## 34", "en"), (104, None, "en"),
              (105, "", "en"), (106, f"{texts[6][1]} write to someone@mail.example.com", "en")]
    docs = [(i, t, lang, "s", len(t or "")) for i, t, lang in texts]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [(i, t) for i, t, _ in texts if i not in (103, 104, 105)]
    groups = plain_groups(left)
    left = [(i, t) for i, t in left if groups[i][1] == i and i != 102]
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(rows) == {i for i, _ in left}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t in left:
        if i != 106:
            assert rows[i].n_tokens == len(library.encode(t, add_special_tokens=False).ids)


def test_stage_contract(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF001).columns == docs.columns
    assert corpus_pipeline.run(spark, SF001).count() > 0


def test_an_id_with_two_texts_of_two_groups(spark):
    """(5, A) and (5, B) with near copies (7, A') and (3, B'): one row of each group stays."""
    rng = random.Random(9)
    a, b, c = (" ".join(f"{w}{rng.randrange(99)}" for w in "some words of this text that go on and on for a while longer".split() * 5) for _ in range(3))
    rows = [(5, a), (5, b), (7, a + " end"), (3, b + " end"), (8, c), (8, c), (None, c), (None, a), (11, "short one"), (11, "other short one"), (12, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(5, a), (3, b + " end"), (8, c), (None, c), (None, a), (11, "short one"), (11, "other short one"), (12, "")], key=str)


def test_documents_in_other_languages_go(docs):
    from marketlake.llm import language
    sample = {"en": "the cat and the dog are in the house with a friend", "de": "der hund und die katze sind in dem haus mit einem freund",
              "fr": "le chat et le chien sont dans la maison avec un ami"}
    rows = [(100 + 3 * k + j, f"{t} {k}", lang) for k in range(40) for j, (lang, t) in enumerate(sample.items())]
    model = language.fit(docs(rows))
    mixed = docs([(1, sample["en"], "fr"), (2, sample["de"], None), (3, sample["fr"], "fr"), (4, "12 34", "en"), (5, None, "en")])
    assert sorted((r.doc_id, r.lang) for r in language.with_language(mixed, model).collect()) == [(1, "en"), (2, "de"), (3, "fr")]
    only = language.with_language(mixed, model, wanted=["en"])
    assert [r.doc_id for r in only.collect()] == [1]
    plan = only._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # each text is read once


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = [n.split("_")[0] for n in entry.queries() if n.startswith("op")]
    assert sorted(names) == sorted(f"op{k}" for k in range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
