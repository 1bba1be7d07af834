"""Training-data pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns
a DataFrame; ``run`` writes it as Parquet into the shared folder and rereads it for the next.
All stages but the last return the columns of ``documents``.

Null, empty and letterless texts end at the language stage. Rows without id pass all stages; of
repeated rows one stays, and rows that repeat an id are decided each by its own text; empty
tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import bpe_stream, decontaminate, language, minhash, pii
from marketlake.llm.common import staged
from marketlake.llm.queries import PII_KEY, WORD_BPE


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows, which becomes their lang; those without text or letters go."""
    return language.with_language(docs, language.fit(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return minhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced; n_chars follows the new text."""
    replaced = pii.replace_entities(docs, PII_KEY)
    return replaced.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else replaced


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of what they decode to."""
    return bpe_stream.encode_decode(docs, public_tokenizers.path(WORD_BPE))


STAGES = [("language", known_language), ("near_duplicates", one_of_each_group), ("decontamination", without_benchmark),
          ("surrogates", with_surrogates), ("encoding", token_ids)]

#: Models, edit distances and tokenizers are beyond SQL; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
