"""Merging crawl metadata, text and language predictions, and taking in other collections.

Defined results: rows without a key join nothing; a key that repeats joins each way,
as files have a line once; a null text counts as empty and goes in ``merge_sources``,
stays a segment of its own (empty) in ``group_segments``, and stays in
``take_external``, where nothing is wrong with it; other columns are carried along;
empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REPLACEMENT = "�"


def merge_sources(meta: DataFrame, text: DataFrame, lang: DataFrame, collection: str | Column, min_prob: float = 0.5, on: tuple[str, ...] | None = None) -> DataFrame:
    """The three line-aligned parts joined on file and line; empty or doubtful documents go.

    ``text`` has ``t`` and perhaps ``x`` and ``htmllang``; ``lang`` has ``lang``
    and ``prob`` arrays, which take the place of fields of that name in ``meta``.
    Lines are told apart by ``on``: by default ``part`` (the set of three files, see
    ``readers.numbered_lines``) and ``line_no`` where all three have a ``part``.
    """
    if on is None:
        on = ("part", "line_no") if all("part" in x.columns for x in (meta, text, lang)) else ("line_no",)
    renamed = text
    for old, new in (("t", "text"), ("x", "xml"), ("htmllang", "html_lang")):
        if old in text.columns:
            renamed = renamed.withColumnRenamed(old, new)
    others = [c for c in renamed.columns if c not in on]
    meta = meta.drop(*{"lang", "prob", "crawl_id", *others})
    joined = meta.join(renamed, list(on)).join(lang.select(*on, "lang", "prob"), list(on))
    kept = joined.where((F.size("lang") > 0) & (F.length("text") > 0) & (F.get("prob", F.lit(0)) > min_prob))
    return kept.withColumn("crawl_id", F.lit(collection) if isinstance(collection, str) else collection)


def group_segments(segments: DataFrame, key: str, order: str, text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row a key: its segments joined by line ends in order, other columns as arrays."""
    rows = segments.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, text, *carry))).alias("rows"))
    return rows.select(key, F.array_join(F.col(f"rows.{text}"), "\n", "").alias("text"), *[F.col(f"rows.{c}").alias(f"{c}s") for c in carry])


def take_external(docs: DataFrame, text: str = "text", own_prefix: str = "own-", id_col: str = "id", excluded_files: str = "literature_contemporary") -> DataFrame:
    """Rows that decode, aren't ours already and aren't from an excluded file."""
    kept = docs.where(~F.coalesce(F.contains(F.col(text), F.lit(REPLACEMENT)), F.lit(False)))
    if id_col in docs.columns:
        kept = kept.where(~F.coalesce(F.startswith(F.col(id_col), F.lit(own_prefix)), F.lit(False)))
    if "file" in docs.columns:
        kept = kept.where(~F.contains(F.lower("file"), F.lit(excluded_files)))
    return kept


def select_rows(docs: DataFrame, numbers: list[int], id_col: str = "doc_id") -> DataFrame:
    return docs.where(F.col(id_col).isin(*numbers))


def union_collections(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def seeded_order(key: Column, seed: int = 42) -> Column:
    """A shuffling that depends on the key and the seed alone."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def seeded_sample(docs: DataFrame, n: int, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    return docs.orderBy(seeded_order(F.col(id_col), seed), id_col).limit(n)


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def number_documents(docs: DataFrame, *order: str) -> DataFrame:
    """Consecutive numbers from 0 in a global order.

    Rows are numbered inside range partitions, and only the partitions' sizes are
    added up, so no task sees all rows.
    """
    ranged = docs.repartitionByRange(*order).withColumn("__p", F.spark_partition_id())
    return number_within(ranged, order)


def number_within(ranged: DataFrame, order: tuple[str, ...]) -> DataFrame:
    from gristmill.session import materialize

    kept = materialize(ranged, "ranged")  # partitions must not be drawn anew between the two uses
    sizes = kept.groupBy("__p").agg(F.count("*").alias("__n"))
    base = sizes.withColumn("__base", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    own = F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1
    return kept.withColumn("__i", own).join(base, "__p").withColumn("line_no", F.col("__base") + F.col("__i")).drop("__p", "__i", "__base")
