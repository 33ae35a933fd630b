"""Routing documents by language.

Defined results: no language, or a null one, is ``unk`` (an error when strict), and so
is a confidence below the bound; a missing confidence doesn't count against a
document; a code that is listed twice has its first label in order; rows repeat as they
were and keep their other columns, but for a ``label`` of their own; empty tables give
empty results, or ``unk``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def route_language(docs: DataFrame, labels: DataFrame, min_prob: float = 0.5, lang_col: str = "lang", prob_col: str = "prob", strict: bool = False) -> DataFrame:
    """``docs`` with ``label``: the canonical one of the first language, ``unk`` below the confidence.

    ``labels`` has ``flores_code`` and ``canonical``. A code that it lacks gives
    ``unk``, or an error at run time when ``strict``.
    """
    first, prob = F.get(F.col(lang_col), F.lit(0)), F.get(F.col(prob_col), F.lit(0))
    known = labels.groupBy(F.col("flores_code").alias("__code")).agg(F.min("canonical").alias("__label"))
    joined = docs.withColumn("__code", first).join(known, "__code", "left")
    missing = F.when(F.col("__label").isNull(), F.raise_error(F.concat(F.lit("unknown language "), F.coalesce("__code", F.lit("null"))))) if strict else F.lit("unk")
    label = F.when(prob < min_prob, F.lit("unk")).otherwise(F.coalesce("__label", missing))
    return joined.withColumn("label", label).drop("__code", "__label")


def parse_predictions(raw: DataFrame, col: str = "value") -> DataFrame:
    """First language and confidence from raw JSON lines, where two languages and three confidences are named."""
    lang = F.regexp_extract(F.col(col), r'"lang": ?\["([a-z]{3}_[A-Z][a-z]{3})", ?"[a-z]{3}_[A-Z][a-z]{3}"', 1)
    prob = F.regexp_extract(F.col(col), r'"prob": ?\[([0-9]+\.[0-9]+), ?[0-9]+\.[0-9]+, ?[0-9]+\.[0-9]+\]', 1)
    return raw.withColumn("lang_first", F.when(lang != "", lang)).withColumn("prob_first", F.when(prob != "", prob).cast("double"))
