"""The registered queries of the corpus operators: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import bpe_stream, decontaminate, fertility, language, minhash, mixing, pii, prefix_trie, ranked_search, repeats, rule_ensemble, token_counts, warc
from marketlake.llm.common import staged

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: The key of the surrogates; an owner of real data passes a secret one to ``pii.replace_entities``.
PII_KEY = "corpus-surrogates"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it holds."""
    return decontaminate.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document by prefix tables; limit_bytes: what 2048 tokens cover."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.find_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"), "kept_sha256")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(_table(spark, sf_dir, "pages"))


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates in place of personal data and secrets."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, PII_KEY, count_col="n_entities")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def op8_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality_rules(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def trie_of(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations with the openings they share in families of five ids."""
    turns, convs = prefix_trie.ordered_turns(conversations)
    turns = turns.transform(staged, "trie-ordered")
    return prefix_trie.prefix_trie(prefix_trie.with_shared_openings(turns, convs), convs.select("conv"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per distinct prefix of the rebuilt conversations."""
    return trie_of(_table(spark, sf_dir, "conversations"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix takes of every document: sources weigh 1, 2, 3, three epochs at most."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                 ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
smallest AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN smallest USING (doc_id)
"""

OP4_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
starts AS (SELECT doc_id, unnest(range(0, n - 49)) AS p, h FROM d WHERE n >= 50),
strings AS (SELECT doc_id, p, hash(substr(h, 2 * p + 1, 100)) AS s1, md5_number(substr(h, 2 * p + 1, 100)) AS s2 FROM starts),
firsts AS (SELECT s1, s2, min(doc_id) AS first_doc FROM strings GROUP BY ALL HAVING count(*) > 1),
hits AS (SELECT doc_id, p FROM strings JOIN firsts USING (s1, s2) WHERE first_doc < doc_id),
runs AS (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM hits),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM runs),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY ALL),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER w, 0) AS from_, lead(a) OVER w IS NULL AS last_ FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
kept AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
           string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)) || CASE WHEN last_ THEN substr(h, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS rest
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

QUERIES = {f.__name__: f for f in (op1_minhash, op2_decontamination, op3_token_counts, op4_repeats, op5_warc, op6_surrogates, op7_language, op8_bpe_stream, op9_quality, op10_fertility,
                                 op11_ranked_search, op12_prefix_trie, op13_mixing)}
ORACLE: dict[str, str] = {"op1_minhash": OP1_SQL, "op4_repeats": OP4_SQL, "op5_warc": warc.ORACLE, "op11_ranked_search": ranked_search.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE,
                          "op13_mixing": mixing.ORACLE}
