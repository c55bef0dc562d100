"""The registered queries opN_<name>: each operator over its whole table with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from . import decontam, embdup, langid, neardup, piece, quality, secretscan, sql, substrdup, toxicity, urlfilter
from .common import table

TOKENIZER_VARIABLE = "TICKLOOM_PIECE_MODEL"


def piece_model() -> str:
    """Path of the SentencePiece model: an environment variable, or the installed public tokenizer."""
    if path := os.environ.get(TOKENIZER_VARIABLE):
        return path
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents", dealt=True), table(spark, sf_dir, "labels"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.digest(table(spark, sf_dir, "pages"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digest(table(spark, sf_dir, "documents", dealt=True))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(table(spark, sf_dir, "documents", dealt=True))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents", dealt=True))


def op6_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrdup.remove_repeats(table(spark, sf_dir, "documents", dealt=True))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece.tokenize(table(spark, sf_dir, "documents", dealt=True), piece_model(), ["doc_id"], ids=None, digests=True)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.find_hits(table(spark, sf_dir, "documents", dealt=True), table(spark, sf_dir, "benchmark"), ["doc_id"]))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents", dealt=True), table(spark, sf_dir, "labels"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdup.near_duplicates(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k[:2] == "op" and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    """By brute force; the others are compared in tests: classifiers on held-out rows, the rest with plain code."""
    return {"op2_url_filter": urlfilter.SQL, "op5_near_duplicates": sql.NEAR_DUPLICATES, "op8_decontamination": sql.DECONTAMINATION, "op10_embedding_dedup": sql.EMBEDDINGS}
