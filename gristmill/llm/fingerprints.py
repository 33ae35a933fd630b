"""Operator 7: threshold-scaled sketches of documents.

Of all word shingles of a document, the hashes below a fixed fraction of the
hash range are kept. Sketches of the same fraction merge by union, and the
share of one sketch that lies in another estimates containment, however unequal
the documents are.

Defined results: a null text has a null sketch and null counts, an empty or
blank text an empty sketch; a text below ``n`` words has one shingle of all its
words; repeated rows are sketched each; other columns are ignored; null ids are
carried along; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from gristmill.llm.arrow import cut, list_array, map_arrow
from gristmill.llm.words import MEMO

PRIME = 2147483647
FACTORS = (48271, 1812433253)
N = 5
#: One shingle hash in SCALE is kept.
SCALE = 16


class _Digests(dict):
    """word -> the two 28-bit numbers of its MD5, in one integer."""

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO:
            self.clear()
        x = hashlib.md5(word.encode("utf-8", "surrogatepass")).hexdigest()
        value = self[word] = int(x[:7], 16) << 32 | int(x[8:15], 16)
        return value


def shingle_values(words: np.ndarray, n: int) -> np.ndarray:
    """62-bit hashes of the shingles; the upper 31 bits decide what is kept."""
    n = min(n, len(words))
    m = len(words) - n + 1
    out = np.zeros(m, np.int64)
    for part, factor in zip((words >> 32, words & 0xFFFFFFFF), FACTORS):
        h = part[:m]
        for k in range(1, n):
            h = (h * factor + part[k : k + m]) % PRIME
        out = (out << 31) | h
    return out


def sketch_documents(docs: DataFrame, n: int = N, scale: int = SCALE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_shingles, sketch)``; one scan, no shuffle.

    ``n_shingles`` counts distinct shingles and ``sketch`` is sorted. Words are
    lower-cased runs without white space.
    """
    limit = (PRIME // scale) << 31
    memo = _Digests()

    def work(batch):
        for part in cut(batch, 1):
            words, distinct, kept = [], [], []
            for text in part.column(1).to_pylist():
                if text is None:
                    words.append(None), distinct.append(None), kept.append(None)
                    continue
                own = text.lower().split()
                values = np.fromiter(map(memo.__getitem__, own), np.int64, len(own))
                values = np.unique(shingle_values(values, n)) if own else values
                words.append(len(own)), distinct.append(len(values)), kept.append(values[values < limit])
            flat = list_array(np.concatenate([k for k in kept if k is not None] or [np.zeros(0, np.int64)]), [0 if k is None else len(k) for k in kept], pa.int64())
            mask = pa.array([k is None for k in kept])
            sketch = pa.ListArray.from_arrays(flat.offsets, flat.values, mask=mask)
            yield [part.column(0), pa.array(words, pa.int64()), pa.array(distinct, pa.int64()), sketch]

    schema = StructType([docs.schema[id_col], StructField("n_words", LongType()), StructField("n_shingles", LongType()), StructField("sketch", ArrayType(LongType()))])
    return map_arrow(docs.select(id_col, text_col), work, schema)


def merge_sketches(sketches: Column) -> Column:
    """Aggregate: the sketch of the union of the grouped documents."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(sketches))))


def containment(part: Column, whole: Column) -> Column:
    """Share of ``part``'s shingles that ``whole`` has; null when ``part``'s sketch is empty."""
    return F.size(F.array_intersect(part, whole)) / F.nullif(F.size(part), F.lit(0))


def sketch_oracle(n: int = N, scale: int = SCALE) -> str:
    """The same sketches in DuckDB."""
    limit = (PRIME // scale) << 31

    def poly(values: str, factor: int) -> str:
        return f"list_reduce(list_slice({values}, i, i + least({n}, len({values})) - 1), lambda h, x: (h * {factor} + x) % {PRIME})"

    return f"""
WITH w AS (
  SELECT doc_id, text IS NULL AS missing,
         list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS words
  FROM documents),
d AS (
  SELECT doc_id, missing, words,
         list_transform(words, lambda x: CAST('0x' || substr(md5(x), 1, 7) AS BIGINT)) AS a,
         list_transform(words, lambda x: CAST('0x' || substr(md5(x), 9, 7) AS BIGINT)) AS b
  FROM w),
s AS (
  SELECT doc_id, missing, len(words) AS n_words,
         list_sort(list_distinct(list_transform(
           range(1, CASE WHEN len(words) = 0 THEN 1 ELSE len(words) - least({n}, len(words)) + 2 END),
           lambda i: {poly('a', FACTORS[0])} * 2147483648 + {poly('b', FACTORS[1])}))) AS v
  FROM d)
SELECT doc_id,
       CASE WHEN missing THEN NULL ELSE n_words END AS n_words,
       CASE WHEN missing THEN NULL ELSE len(v) END AS n_shingles,
       CASE WHEN missing THEN NULL ELSE list_filter(v, lambda x: x < {limit}) END AS sketch
FROM s"""
