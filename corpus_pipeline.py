"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

``STAGES`` lists ``(name, function)``. A function takes ``(spark, docs, sf_dir)``
and gives a frame; all but the last give the columns of ``documents``. The
operators behind the stages define what happens to nulls, empty and very long
texts, repeated rows and empty tables; a stage carries further columns along. Of
ties the lowest document id comes first: its line stays, and it stays of a class;
in training order equal positions go by source, then by the hash of the id. A text
of which line dedup has taken all lines is empty and stays a row, as empty texts are
copies of nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import encoding, line_dedup, mixing, ngram_join, quality
from gristmill.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand before elsewhere go; a document stays, if need be with an empty text."""
    done = line_dedup.dedup_lines(docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the lowest id stays."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order: sources above their demand end early, others come again."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every row."""
    return encoding.encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mixing", mix),
    ("bpe_encoding", encode),
]
#: Fuzzy joins, expectation-maximisation and BPE are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
