"""Web registers: labels of documents by a model that the caller brings.

Defined results: rows are labelled each, repeated ones alike; the model sees a null text
as an empty one; a ``web_register`` of the documents' own is replaced, other columns
stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType

from gristmill.functions.langs import has_registers
from gristmill.operators.annotate import marker_count

#: Registers, and words that speak for them in the baseline.
BASELINE = {"narrative": ("was", "had", "then"), "opinion": ("not", "should", "think"), "informational": ("is", "are", "of"), "howto": ("you", "your", "use")}


def web_registers(docs: DataFrame, model: Callable[[], Callable[[list[str]], list[dict[str, float]]]], text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """``docs`` with ``web_register``: label to probability, rounded to 3 places.

    ``model`` is called once a worker and gives the function that labels a batch.
    With ``lang_col``, other languages than the model's get null.
    """
    held: list = []

    @F.pandas_udf(MapType(StringType(), DoubleType()))
    def label(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(model())
        return pd.Series([{k: round(v, 3) for k, v in row.items()} for row in held[0](texts.fillna("").tolist())], dtype=object)

    found = label(F.col(text_col))
    return docs.withColumn("web_register", F.when(has_registers(F.col(lang_col)), found) if lang_col else found)


def baseline_registers(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same column by expressions alone: a logistic function of the share of marker words."""
    words = F.split(F.lower(text_col), r"[^\p{L}]+", -1)
    total = F.size(words)
    columns = []
    for name, marks in BASELINE.items():
        share = marker_count(words, marks) / total
        columns += [F.lit(name), F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(2.0) - F.lit(40.0) * share)), 3)]
    return docs.withColumn("web_register", F.create_map(*columns))
