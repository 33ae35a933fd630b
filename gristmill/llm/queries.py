"""Queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import encoding, fingerprints, html_extract, line_dedup, mixing, ngram_join, quality, token_counts, toxicity, url_filters


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode_documents(_read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_lexicon(docs, _read(spark, sf_dir, "labels")))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return url_filters.filter_urls(pages, url_filters.default_events(spark), url_filters.fetch_date(F.col("page_id")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_read(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.sketch_documents(_read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_read(spark, sf_dir, "documents")).select("doc_id", "text")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_classes(_read(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return html_extract.extract_pages(pages, html_extract.train(pages))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_url_filters": op4_url_filters,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_fingerprints": op7_fingerprints,
    "op8_line_dedup": op8_line_dedup,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_html_extraction": op10_html_extraction,
}

ORACLE = {
    "op4_url_filters": url_filters.url_oracle(),
    "op5_mixing": mixing.mix_oracle(),
    "op7_fingerprints": fingerprints.sketch_oracle(),
}
