"""A training-data pipeline over ``documents``: quality, near duplicates, contamination, secrets, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
Rows without text pass the stages that have nothing to say about them; the last stage gives them begin and end ids only.
Further columns of ``documents`` go through all stages but the last as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import decontam, neardup, piece, quality, secretscan
from tickloom.llm.common import boxed, stored, table
from tickloom.llm.queries import piece_model


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on the labelled ones, does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(boxed(docs, "text"), model, ["row"]).where("predicted = 1").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every group of near duplicates, and all that are in no group."""
    gone = neardup.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    rows = boxed(docs, "doc_id")
    return rows.join(gone.hint("merge"), rows["doc_id"] == gone["gone"], "left_anti").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    hits = decontam.find_hits(boxed(docs, "text"), table(spark, sf_dir, "benchmark"), ["row"])
    return decontam.judged(hits).where(~F.col("contaminated")).select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked and the length counted anew where one was."""
    clean = boxed(secretscan.redact(docs, secretscan.train(docs)), "text", "n_chars")
    n = F.when(F.contains("text", F.lit(secretscan.MASK)), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.select(F.col("row").withField("n_chars", n).alias("row")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document with the text they decode to."""
    return piece.tokenize(docs, piece_model(), ["doc_id", "lang", "source"], decoded="decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_scan),
    ("sentencepiece", tokens),
]

#: No SQL states the classifier, the tokenizer or the joins over shingles; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
