"""Keeping one of equal or nearly equal documents.

Defined results: of rows that share an id, all stay or all go with it; rows without
an id are nobody's copy and stay; a null or empty text is a value like any other for
exact dedup, and equal to others of its kind; other columns are carried along,
whatever their names, texts of any length are compared by digests, and an empty
table gives an empty result. Of equal documents the lowest id stays, one row of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.operators.components import connected_components
from gristmill.session import materialize


def cluster_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count("*").alias("cluster_size"))


def near_dedup(docs: DataFrame, components: DataFrame, duplicates_only: bool = False, add_cluster_size: bool = False, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without (or with only) those that aren't the first of their component.

    ``components`` has a row for each id; an id that isn't there, or null, is alone.
    Only ids are joined: rows pass by, and losers are fewer than documents.
    """
    slim = components.select(F.col(id_col).alias("__id"), F.col("component").alias("__component")).distinct()
    own = F.col(f"`{id_col}`") == F.col("__id")
    losers = slim.where("__id <> __component").select("__id")
    kept = docs.join(losers, own, "left_semi" if duplicates_only else "left_anti")
    if not add_cluster_size:
        return kept
    sizes = slim.groupBy("__component").agg(F.count("*").alias("__size"))
    if duplicates_only:
        sizes = slim.join(sizes, "__component").select("__id", "__size")
    else:
        sizes = sizes.where("__size > 1").withColumnRenamed("__component", "__id")
    return kept.drop("cluster_size").join(sizes, own, "left").withColumn("cluster_size", F.coalesce("__size", F.lit(1).cast("long"))).drop("__id", "__size")


def merge_clusterings(*parts: DataFrame) -> DataFrame:
    """Several ``(doc_id, component)`` frames, such as one for each band, as one."""
    edges = parts[0]
    for part in parts[1:]:
        edges = edges.unionByName(part)
    joined = connected_components(edges, "doc_id", "component").select(F.col("node").alias("doc_id"), "component")
    return edges.select("doc_id").distinct().join(joined, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def exact_dedup(docs: DataFrame, key: str = "text", order: str = "doc_id") -> DataFrame:
    """The first row of each value.

    Digests and ids alone are shuffled, with a partial minimum, so neither a long
    text nor a value that many rows share weighs on one task; then those go that
    aren't first.
    """
    digest = F.coalesce(F.sha2(F.col(f"`{key}`").cast("binary"), 256), F.lit(""))
    slim = materialize(docs.select(digest.alias("__digest"), F.col(f"`{order}`").alias("__id")).where("__id is not null"), "digests")
    first = slim.groupBy("__digest").agg(F.min("__id").alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    # (id, digest) of rows that go; several rows of the first id are one row too many each
    pairs = slim.groupBy("__digest", "__id").agg(F.count("*").alias("__m")).join(first.select("__digest", "__first"), "__digest")
    losers = pairs.where("__id <> __first").select("__digest", "__id")
    marked = docs.withColumn("__own", digest)
    kept = marked.join(losers, (F.col("__own") == F.col("__digest")) & (F.col(f"`{order}`") == F.col("__id")), "left_anti")
    again = pairs.where("__id = __first and __m > 1").select("__digest", "__id")
    if not again.isEmpty():
        repeated = (F.col("__own") == F.col("__digest")) & (F.col(f"`{order}`") == F.col("__id"))
        # equal in id and value, so any of the rows may stand for them
        once = kept.join(again, repeated, "left_semi").dropDuplicates(["__own", order])
        kept = kept.join(again, repeated, "left_anti").unionByName(once)
    return kept.drop("__own")


def exact_dup_report(docs: DataFrame, key: str = "text") -> DataFrame:
    """``(digest, copies)`` of values that occur more than once, trailing white space aside."""
    digest = F.sha2(F.regexp_replace(F.col(key), r"\s+$", "").cast("binary"), 256)
    return docs.groupBy(digest.alias("digest")).agg(F.count("*").alias("copies")).where("copies > 1")
