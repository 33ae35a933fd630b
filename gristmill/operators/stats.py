"""Counts of documents by reason, language and state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filter_stats(docs: DataFrame, by: tuple[str, ...] = (), reason: str = "filter") -> DataFrame:
    """``(*by, filter, count, pct)``: documents of each reason, and their share as a text with two decimals."""
    counts = docs.groupBy(*by, F.col(reason).alias("filter")).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1)))
    return counts.withColumn("pct", F.format_string("%.2f%%", F.col("count") / total * 100))


def stats_table(stats: DataFrame, lang: str = "lang", reasons: tuple[str, ...] | None = None) -> DataFrame:
    """A row a language and a column a reason, ``keep`` first, the others in order; blank where missing."""
    if reasons is None:
        reasons = tuple(r["filter"] for r in stats.select("filter").distinct().collect())  # a handful of names
    ordered = ["keep", *sorted(r for r in reasons if r != "keep")]
    wide = stats.groupBy(lang).pivot("filter", ordered).agg(F.first("pct"))
    return wide.na.fill("", ordered)


def run_counters(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: documents before, kept and removed, and the share that was kept."""
    a, b = before.agg(F.count("*").alias("total")), after.agg(F.count("*").alias("kept"))
    return a.crossJoin(b).select("total", "kept", (F.col("total") - F.col("kept")).alias("removed"), F.round(F.col("kept") / F.nullif("total", F.lit(0)) * 100, 2).alias("kept_pct"))


def size_totals(docs: DataFrame, *by: str, text_col: str = "text") -> DataFrame:
    return docs.groupBy(*by).agg(F.sum(F.octet_length(text_col)).alias("bytes"), F.count("*").alias("docs"))


def status(batches: Column, deduped: Column, dedup_open: Column, annotated: Column, annotate_open: Column) -> Column:
    """How far a collection has come, from its finished and unfinished files."""
    return (
        F.when(batches == 0, "none")
        .when((deduped == 0) | (dedup_open != 0), "batched")
        .when((annotated == 0) | (annotate_open != 0), "deduped")
        .otherwise("annotated")
    )
