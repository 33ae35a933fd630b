"""Batches of bounded size.

Defined results: a null size or text counts nothing; a null group is a group; rows
without an order key come first in their group; rows that share group and order key
share what that key gets, the batch of the first of them; other columns are carried
along, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gristmill.session import materialize

#: Kilobytes of a merged file.
PACK_CAP = 10_000_000


def assign_batches(docs: DataFrame, max_bytes: int, by: str, order: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``batch`` from 1: by the bytes that stand before a document in its group.

    A document that begins below a multiple of the bound belongs to that batch, so
    a batch overshoots by a document at most. Keys and sizes alone are sorted: they
    are range-partitioned, and the partitions' totals of each group are added up,
    so a large group is spread over many tasks. Batches are then joined back by key.
    """
    slim = docs.select(F.col(f"`{by}`").alias("__by"), F.col(f"`{order}`").alias("__order"), F.coalesce(F.octet_length(F.col(f"`{text_col}`")).cast("long"), F.lit(0).cast("long")).alias("__size"))
    slim = slim.groupBy("__by", "__order").agg(F.sum("__size").alias("__size"))
    # partitions must not be drawn anew between the two uses
    ranged = materialize(slim.repartitionByRange("__by", "__order").withColumn("__p", F.spark_partition_id()), "sizes")
    earlier = Window.partitionBy("__by").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    base = ranged.groupBy("__by", "__p").agg(F.sum("__size").alias("__sum")).withColumn("__base", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).select(F.col("__by").alias("__b"), F.col("__p").alias("__q"), "__base")
    inside = Window.partitionBy("__by", "__p").orderBy("__order").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("__before", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    placed = placed.join(base, F.col("__by").eqNullSafe(F.col("__b")) & (F.col("__p") == F.col("__q")))
    batches = placed.select("__by", "__order", (F.floor((F.col("__before") + F.col("__base")) / F.lit(max_bytes)).cast("long") + 1).alias("__batch"))
    return _with_batches(docs, batches, by, order)


def _with_batches(docs: DataFrame, batches: DataFrame, by: str, order: str) -> DataFrame:
    own = F.col(f"`{by}`").eqNullSafe(F.col("__by")) & F.col(f"`{order}`").eqNullSafe(F.col("__order"))
    return docs.drop("batch").join(batches, own).withColumnRenamed("__batch", "batch").drop("__by", "__order")


def pack_files(files: DataFrame, by: str, order: str, size: str, cap: int = PACK_CAP) -> DataFrame:
    """``files`` with ``batch``: filled in order, a new one where a file would pass the cap."""
    return _fold(files, by, order, size, cap, False)


def rotate_batches(docs: DataFrame, by: str, order: str, size: str, cap: int) -> DataFrame:
    """``docs`` with ``batch``: a new one once the bytes written have passed the cap, counted anew each time."""
    return _fold(docs, by, order, size, cap, True)


def _fold(rows: DataFrame, by: str, order: str, size: str, cap: int, overshoot: bool) -> DataFrame:
    # what a batch begins with depends on all before it, so a group is folded in one
    # task; only its keys and sizes go there, as they come sorted and in pieces
    slim = rows.select(F.col(f"`{by}`").alias("__by"), F.col(f"`{order}`").alias("__order"), F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0).cast("long")).alias("__size"))
    slim = slim.groupBy("__by", "__order").agg(F.sum("__size").alias("__size"))
    schema = StructType([StructField("__by", rows.schema[by].dataType), StructField("__order", rows.schema[order].dataType), StructField("__batch", LongType())])

    def fold(batches):
        group, batch, held, begun = None, 0, 0, False
        for part in batches:
            groups, sizes, out = part.column(0).to_pylist(), part.column(2).to_pylist(), []
            for own, n in zip(groups, sizes):
                if not begun or own != group:
                    group, batch, held, begun = own, 1, 0, True
                elif held > cap if overshoot else held + n > cap:
                    batch, held = batch + 1, 0
                held += n
                out.append(batch)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.int64())], schema.fieldNames())

    # a group lies in one partition; sorted there, it streams through with no more than a batch in memory
    found = slim.repartition("__by").sortWithinPartitions("__by", "__order").mapInArrow(fold, schema)
    return _with_batches(rows, found, by, order)
