"""The record-at-a-time stages over streams, and exact dedup within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gristmill.operators.annotate import annotate, clean


def read_documents(spark: SparkSession, path: str, schema: StructType, format: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(format).load(path)


def annotate_stream(docs: DataFrame, lang: str = "lang", min_score: float = 0.0) -> DataFrame:
    """Annotated documents that pass cleaning; no state is kept."""
    return clean(annotate(docs, lang), min_score)


def dedup_stream(docs: DataFrame, time: str, delay: str, text_col: str = "text") -> DataFrame:
    """The first of equal texts that arrive within ``delay`` of each other; state is bounded by the watermark."""
    keyed = docs.withColumn("__digest", F.sha2(F.col(text_col).cast("binary"), 256)).withWatermark(time, delay)
    return keyed.dropDuplicatesWithinWatermark(["__digest"]).drop("__digest")


def reason_counts(docs: DataFrame, time: str, window: str, delay: str, reason: str = "filter") -> DataFrame:
    """Documents of each reason by event-time window."""
    return docs.withWatermark(time, delay).groupBy(F.window(time, window).alias("window"), F.col(reason).alias("filter")).agg(F.count("*").alias("count"))


def write_documents(docs: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """All that is there now, as files; what was written survives a restart exactly once."""
    return docs.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
