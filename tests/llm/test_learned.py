"""op7 and op9: held-out accuracy, what is learned from, and edge rows."""

from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from llm.conftest import EDGES
from marketlake.llm import language, rule_ensemble


def test_language_held_out_accuracy(spark):
    table = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = language.identify(table, language.fit(table)).join(table.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_learns_only_from_its_folds(spark):
    table = spark.read.parquet(f"{SF01}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    spoiled = table.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    a, b = (language.fit(t, fit_rows=60) for t in (table, spoiled))
    assert a.languages == b.languages and (a.pair_weights == b.pair_weights).all()


def test_language_families_and_edges(docs):
    sample = {"en": "the cat and the dog are in the house with a friend", "de": "der hund und die katze sind in dem haus mit einem freund",
              "fr": "le chat et le chien sont dans la maison avec un ami", "es": "el gato y el perro están en la casa con un amigo"}
    rows = [(100 + 4 * k + j, f"{t} {k}", lang) for k in range(40) for j, (lang, t) in enumerate(sample.items())]
    model = language.fit(docs(rows))
    assert set(model.families) == {"germanic", "romance"}
    got = {r.doc_id: r for r in language.identify(docs(rows + [(9000 + i, t) for i, t in enumerate(sample.values())]), model).collect()}
    assert [got[9000 + i].lang_pred for i in range(4)] == list(sample)
    out = language.identify(docs(EDGES), model).collect()
    assert len(out) == len(EDGES)
    assert all(r.lang_pred == "und" and r.score == 0 for r in out if r.doc_id in (1, 2, 3))
    assert all(r.held_out is None for r in out if r.doc_id is None)
    assert language.with_language(docs(EDGES), model).columns == docs(EDGES).columns
    assert {r.doc_id for r in language.with_language(docs(EDGES), model).collect()} == {4, 5, 6, 7, None, 8, 9, 10}


def test_language_without_learning_rows(docs):
    assert language.identify(docs([]), language.fit(docs([]))).collect() == []
    assert [r.lang_pred for r in language.identify(docs([(1, "text")]), language.fit(docs([(1, "text")]))).collect()] == ["und"]


def test_language_driver_holds_the_features_once(docs):
    words = {"en": "the cat and dog are in house with friend".split(), "de": "der hund und die katze sind dem haus".split()}
    rows = [(2 * k + j, " ".join(w[(k >> b) % len(w)] for b in range(12)), lang) for k in range(800) for j, (lang, w) in enumerate(words.items())]
    learned = sum(zlib.crc32(str(r[0]).encode()) % 5 != 0 for r in rows)
    table = docs(rows)
    language.fit(table, fit_rows=10)  # imports
    tracemalloc.start()
    model = language.fit(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.languages == (("de", "en"),)
    assert peak < 1.5 * learned * 4 * model.dims  # was 3.7 times


def test_language_features_survive_packing_and_machines_copy_no_rows():
    texts = ["the cat and the dog", "", "a", "le chat et le chien " * 9000, "naïve İstanbul 漢字", "der hund und die katze"]
    counts = [language.trigrams(t, 256) for t in texts]
    assert max(c.max() for c in counts) > 65535 // 8 and len(language.pack(counts[0])) < 1024 // 3
    x = language.unpacked(map(language.pack, counts), len(texts), 256)
    assert (x == np.array([np.append(language.features(t, 256), np.float32(1)) for t in texts])).all()
    rows, y = np.array([5, 0, 3, 4]), np.array([1.0, -1.0, 1.0, -1.0])
    assert (language.linear_svm(x, rows, y) == language.linear_svm(x[rows].copy(), np.arange(4), y)).all()


def test_quality_held_out_accuracy_and_compiled_rules(spark):
    table, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = rule_ensemble.classify(table, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_quality_edges_and_single_class(docs, spark):
    labels = spark.createDataFrame([(4, 1), (5, None), (6, 1)], "doc_id long, quality int")
    rows = rule_ensemble.classify(docs(EDGES), labels).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    assert rule_ensemble.classify(docs([]), labels).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in rule_ensemble.classify(docs(EDGES), none).collect()} == {0.5}


def test_tree_rules_are_conjunctions_of_the_tightest_bounds():
    described = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5
  If (feature 0 <= 10.0)
   If (feature 0 <= 4.0)
    Predict: 0.0
   Else (feature 0 > 4.0)
    Predict: 1.0
  Else (feature 0 > 10.0)
   Predict: 1.0
"""
    names = [r.conditions for r in rule_ensemble.tree_rules(described)]
    s = rule_ensemble.STATS[0]
    assert names == [((s, True, 10.0),), ((s, True, 4.0),), ((s, False, 4.0), (s, True, 10.0)), ((s, False, 10.0),)]
