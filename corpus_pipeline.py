"""The corpus pipeline: documents in, cleaned and tokenized documents out.

Each stage is one of the operators of ``partflow.llm``, applied to what the stage before
it kept. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm import decontaminate, pieces, quality, similar, surrogates
from partflow.llm.common import materialise, table
from partflow.llm.queries import PIECE_BPE, SURROGATE_KEY


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels of these documents, does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 0.8 or more of their five-word shingles in common.

    Fingerprints of five-word shingles are compared bit-sliced within a radius wide enough
    for that, among texts that min-hash bands bring together, and verified exactly."""
    return similar.drop_similar(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"), whole=True)


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data and secrets; ``n_chars`` follows the text."""
    replaced = surrogates.replace_personal_data(docs, SURROGATE_KEY).drop("n_entities")
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the text they decode to."""
    return pieces.encode(docs, PIECE_BPE)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("PII surrogates", with_surrogates),
    ("SentencePiece", encoded),
]

#: SQL has neither XXH64 nor the tokenizer; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each to what the one before it kept, written and read again between them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
