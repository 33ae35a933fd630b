import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

pytest.importorskip("gristmill.llm")

LONG = " ".join(f"word{i % 997} and the of" for i in range(20_000))
TEXT = "The first line has quite a few words in it.\nA second line follows with some more of the words.\nThe end of this text."
#: (doc_id, text, lang, source, n_chars): nulls everywhere, empty and very long texts, ties, repeated rows.
ROWS = [
    (1, TEXT, "en", "src0", 1), (2, TEXT, "en", "src0", 1), (2, TEXT, "en", "src0", 1), (3, "", "en", None, 0), (4, None, None, "src1", None), (None, TEXT, "en", "src1", 1),
    (None, None, None, None, None), (5, LONG, "en", "src1", 9), (6, "   \n\n ", "de", "src2", 5), (7, "one", "de", "src2", 3), (7, "another text under the same id, which is allowed here", "de", "src2", 3),
]
#: Names that operators use inside.
CLASHING = ["id", "key", "node", "component", "text2", "z", "pattern", "c0", "count", "size", "position", "epoch", "toxic", "score", "__s", "n", "html"]


def frame(spark, rows):
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())])
    schema = StructType(schema.fields + [StructField(c, StringType()) for c in CLASHING])
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema)


@pytest.fixture(scope="session")
def messy(spark):
    return frame(spark, ROWS)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
