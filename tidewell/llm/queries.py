"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import decontamination, fingerprints, language, mixing, pii, quality, secrets, simhash, sql, tokens, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hit_spans")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.cross_fitted(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "spans")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def queries() -> dict[str, Query]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_simhash": op2_simhash,
        "op3_tokens": op3_tokens,
        "op4_quality": op4_quality,
        "op5_decontamination": op5_decontamination,
        "op6_warc": op6_warc,
        "op7_secrets": op7_secrets,
        "op8_language": op8_language,
        "op9_pii": op9_pii,
        "op10_mixing": op10_mixing,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": sql.OP5_SQL, "op6_warc": sql.OP6_SQL, "op7_secrets": sql.OP7_SQL}
