"""Readers of the formats in which corpora come."""

from __future__ import annotations

import gzip
import io
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, MapType, StringType, StructField, StructType

_LANGID = StructType([StructField("lang", ArrayType(StringType())), StructField("prob", ArrayType(DoubleType()))])
_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
#: A document with all that the stages add.
DOCUMENT = StructType(
    [StructField(n, StringType()) for n in ("id", "text", "xml", "md", "f", "u", "c", "ts", "de", "crawl_id", "filter")]
    + [StructField(n, LongType()) for n in ("o", "s", "rs", "cluster_size")]
    + [StructField(n, ArrayType(StringType())) for n in ("html_lang", "lang", "seg_langs")]
    + [StructField(n, ArrayType(DoubleType())) for n in ("prob", "doc_scores")]
    + [StructField(n, _LANGID) for n in ("openlid_v2", "glotlid_v3", "openlid_v3")]
    + [StructField("allowed", BooleanType()), StructField("pii", ArrayType(_SPAN)), StructField("web_register", MapType(StringType(), DoubleType()))]
)
ALIASES = {"openlid-v2": "openlid_v2", "glotlid-v3": "glotlid_v3", "openlid-v3": "openlid_v3", "seg-langs": "seg_langs", "htmllang": "html_lang", "web-register": "web_register", "collection": "crawl_id"}


def read_jsonl(spark: SparkSession, path: str, schema: StructType | None = DOCUMENT) -> DataFrame:
    """JSON lines, plain or compressed (zst, gz, bz2); fields under an older name are taken under the new one."""
    if schema is None:
        return spark.read.json(path)
    olds = [StructField(old, schema[new].dataType) for old, new in ALIASES.items() if new in schema.fieldNames()]
    raw = spark.read.schema(StructType(schema.fields + olds)).json(path)
    new_of = {new: [old for old in ALIASES if ALIASES[old] == new] for new in schema.fieldNames()}
    return raw.select(*[F.coalesce(F.col(f"`{n}`"), *[F.col(f"`{o}`") for o in new_of[n]]).alias(n) for n in schema.fieldNames()])


#: Splits of files up to which their numbers of lines are broadcast.
FEW_SPLITS = 100_000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(part, line_no, value)``: lines numbered from 0 in each file; ``part`` is the folder the file is in.

    Files that belong together line by line lie in one folder. No line is moved: a
    split's lines are counted, and what stands before it in its file is added to the
    places within it. Compressed files are a split each.
    """
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__from")]
    raw = spark.read.text(path).select("value", *place).withColumn("__at", F.monotonically_increasing_id())
    splits = raw.groupBy("__file", "__from").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("__file").orderBy("__from").rowsBetween(Window.unboundedPreceding, -1)
    base = splits.select("__file", "__from", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    if base.limit(FEW_SPLITS + 1).count() <= FEW_SPLITS:
        base = F.broadcast(base)
    found = raw.join(base, ["__file", "__from"])
    return found.select(F.regexp_replace("__file", "/[^/]*$", "").alias("part"), (F.col("__base") + F.col("__at") - F.col("__first")).alias("line_no"), "value")


def numbered_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """``(part, line_no, ...)``: JSON lines with their numbers; a line that can't be read is left out, and counts."""
    lines = numbered_lines(spark, path).where(~F.contains("value", F.lit("\ufffd")))
    parsed = lines.withColumn("__x", F.from_json("value", schema)).where("__x is not null")
    return parsed.select("part", "line_no", "__x.*")


def read_external(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the file they are from."""
    return spark.read.json(path).withColumn("file", F.input_file_name())


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """Files that hold an array each; ``content`` becomes ``text``."""
    found = spark.read.option("multiLine", True).json(path)
    return found.withColumnRenamed("content", "text") if "content" in found.columns else found


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """``(u, pattern, allowed, rule_idx)`` of tab-separated rule files; another flag than 0 or 1 is an error."""
    lines = spark.read.text(path, wholetext=True).withColumn("u", F.input_file_name())
    lines = lines.select("u", F.posexplode(F.split("value", "\n", -1)).alias("rule_idx", "line")).where("line <> ''")
    flag = F.element_at(F.split("line", "\t", -1), 2)
    allowed = F.when(flag.isin("0", "1"), flag == "1").otherwise(F.raise_error(F.concat(F.lit("no flag in rule: "), "line")).cast("boolean"))
    return lines.select("u", F.element_at(F.split("line", "\t", -1), 1).alias("pattern"), allowed.alias("allowed"), "rule_idx")


def read_lines(spark: SparkSession, path: str, name: str = "domain") -> DataFrame:
    """A list file: a stripped entry a line."""
    return spark.read.text(path).select(F.trim("value").alias(name)).where(F.col(name) != "").distinct()


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, component)`` of cluster files; several vectors, one for each band, lie in one frame as edges.

    Lines of digits alone are headers.
    """
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^[0-9]+$") & (F.trim("value") != ""))
    return lines.select(F.posexplode(F.split(F.trim("value"), " ")).alias("doc_id", "parent")).select(F.col("doc_id").cast("long"), F.col("parent").cast("long").alias("component"))


def read_crawl_names(spark: SparkSession, path: str) -> DataFrame:
    """``(crawl, names)`` of a tab-separated list."""
    rows = spark.read.csv(path, sep="\t", schema="crawl string, name string")
    return rows.groupBy("crawl").agg(F.array_sort(F.collect_list("name")).alias("names"))


def _records(raw: bytes):
    """Target URL and body of the responses of a WARC file; what is cut off at the end is left out."""
    data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    stream = io.BytesIO(data)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        body = stream.read(int(headers.get("content-length", 0) or 0))
        if headers.get("warc-type") == "response":
            head, _, page = body.partition(b"\r\n\r\n")
            if re.match(rb"HTTP/\S+ 200", head):
                yield headers.get("warc-target-uri", "").strip("<>"), page


def read_robots_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(u, p)``: robots.txt bodies of WARC files, which are read whole, one a task row."""

    def work(batches):
        for batch in batches:
            for raw in batch["content"]:
                found = [(u, p.decode("utf-8", "replace")) for u, p in _records(raw) if u.split("?")[0].endswith("/robots.txt")]
                yield pd.DataFrame(found, columns=["u", "p"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(work, "u string, p string")
