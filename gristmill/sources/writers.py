"""Writers; a write is committed as a whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of strings that a task writes of one language, on average.
TASK_BYTES = 256 << 20


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder was committed."""
    jvm = spark._jvm
    mark = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def write_stage(df: DataFrame, path: str, skip_existing: bool = True, format: str = "parquet") -> None:
    """A stage's output; one that is complete already is left alone, one that a crash left unfinished is written anew."""
    if skip_existing:
        if not is_complete(df.sparkSession, path):
            df.write.mode("overwrite").format(format).save(path)
    else:
        df.write.mode("errorifexists").format(format).save(path)


def write_by_language(df: DataFrame, path: str, column: str = "label", max_records: int = 0, format: str = "parquet", mode: str = "errorifexists", task_bytes: int = TASK_BYTES, **options) -> None:
    """A directory a language; ``options`` go to the writer (``compression``, say).

    Rows are spread by language and a hash of their slim columns, over as many tasks
    as the language's bytes ask for: a frequent language is written by many tasks
    and a rare one by one.
    """
    strings = [c for c, t in df.dtypes if t == "string" and c != column]
    size = sum((F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)).cast("long") for c in strings), F.lit(16).cast("long"))
    # a row a language, of which there are some hundreds
    fans = df.groupBy(F.col(column).alias("__label")).agg(F.ceil(F.sum(size) / F.lit(task_bytes)).cast("long").alias("__fan"))
    slim = [c for c, t in df.dtypes if not t.startswith("map")]
    spread = df.join(F.broadcast(fans), F.col(column).eqNullSafe(F.col("__label"))).drop("__label")
    spread = spread.withColumn("__turn", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in slim]), F.col("__fan"))).repartition(F.col(column), F.col("__turn")).drop("__fan", "__turn")
    spread.write.mode(mode).options(**options).option("maxRecordsPerFile", max_records).partitionBy(column).format(format).save(path)


def write_batches(df: DataFrame, path: str, by: str, mode: str = "errorifexists", compression: str = "gzip") -> None:
    """JSON lines, a directory for each batch of each group; ``df`` has ``batch``."""
    df.repartition(by, "batch").write.mode(mode).partitionBy(by, "batch").option("compression", compression).json(path)


def write_clusters(components: DataFrame, path: str, mode: str = "errorifexists") -> None:
    components.select("doc_id", "component").write.mode(mode).parquet(path)


def write_sidecar(df: DataFrame, path: str, column: str = "allowed", order: str = "line_no", mode: str = "errorifexists") -> None:
    """JSON lines of one column, a line for each row in order, so that they stand beside the rows of the input."""
    df.orderBy(order).select(column).write.mode(mode).json(path, ignoreNullFields=False)
