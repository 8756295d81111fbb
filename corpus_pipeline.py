"""The corpus pipeline: known languages, one of each near-duplicate, no benchmark text, a mix of sources, token ids.

STAGES are applied in order. Each gets the rows that its predecessor kept, as a written and reread table, and all but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontamination, language, mixing, simhash, tokens
from tidewell.llm.common import written

TOKENIZER = "word_bpe_49k.json"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled rows' languages; texts without letters, in foreign scripts or of no one language go."""
    return language.known_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id. Groups are op2's: fingerprints 3 bits apart."""
    return simhash.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in passages of the benchmark."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, a row for each time that one is taken; a source's last one ends at its target."""
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else mixed


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's documents, read back: doc_id, start, n_tokens, ids_crc32."""
    return tokens.round_trip(docs, public_tokenizers.path(TOKENIZER))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", no_benchmark),
    ("mixing", mix),
    ("tokens", token_ids),
]

#: Language models, hashes and tokenizers have no SQL form; the stages' operators are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
