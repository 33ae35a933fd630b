"""MinHash signatures, LSH bands and near duplicates.

Defined results: a text without tokens, empty or null, has a null signature, no
band and so no near duplicate; rows that share an id are one document here, which
meets others by any of its texts; rows without an id meet nothing; long texts are
hashed in pieces; other columns, whatever their names, are not looked at; an empty
table gives an empty result. Ties go to the lowest id.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from gristmill.batches import cut, release
from gristmill.functions.texts import char_tokens, token_hash, whitespace_tokens
from gristmill.operators.components import connected_components
from gristmill.session import discard, materialize

PRIME = 2147483647
BANDS, ROWS, WINDOW = 17, 15, 3
BUCKETS = 1 << 20
#: Tokens whose hashes a worker remembers, and characters up to which it does; a cache only.
MEMO, MEMO_CHARS = 1 << 17, 64
#: Tokens by permutations that are reckoned at once; what they take stays in the cache of a core.
CELLS = 1 << 15
#: Bytes of text and rows that a worker signs at once.
SLICE, SIGNED = 1 << 20, 500
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def coefficients(n: int, seed: int = 20240) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(n)]


def tokens(text: Column, tokenizer: str = "whitespace", window: int = WINDOW) -> Column:
    if tokenizer == "char":
        return char_tokens(text, window)
    if tokenizer in ("whitespace", "vectorizer"):
        return whitespace_tokens(text)
    raise ValueError(f"no tokenizer {tokenizer}")


def hashed_tokens(text: Column, tokenizer: str = "whitespace", window: int = WINDOW) -> Column:
    values = F.transform(tokens(text, tokenizer, window), token_hash)
    return F.transform(values, lambda h: h % BUCKETS) if tokenizer == "vectorizer" else values


class Signer:
    """Signatures of texts; equals ``hashed_tokens`` and the permutations ``(a * h + b) mod PRIME``, least of each."""

    def __init__(self, permutations: int, tokenizer: str, window: int):
        if tokenizer not in ("whitespace", "vectorizer", "char"):
            raise ValueError(f"no tokenizer {tokenizer}")
        self.a, self.b = (np.array(x, np.uint64) for x in zip(*coefficients(permutations)))
        self.tokenizer, self.window, self.memo = tokenizer, window, {}

    def hashes(self, text: str) -> np.ndarray:
        if self.tokenizer == "char":
            parts = {text[i : i + self.window] for i in range(0, len(text), self.window)}
        else:
            parts = set(_SPACES.split(text.lower()))
            parts.discard("")
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        out = []
        for part in parts:
            h = memo.get(part)
            if h is None:
                h = int.from_bytes(hashlib.md5(part.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()[:4], "big") % PRIME
                h = h % BUCKETS if self.tokenizer == "vectorizer" else h
                if len(part) <= MEMO_CHARS:
                    memo[part] = h
            out.append(h)
        return np.array(out, np.uint64)

    def __call__(self, text: str | None) -> np.ndarray | None:
        values = self.hashes(text) if text else ()
        if not len(values):
            return None
        low = np.full(len(self.a), PRIME, np.uint32)
        step = max(1, CELLS // len(self.a))
        prime, bits, least = np.uint64(PRIME), np.uint64(31), np.uint32(PRIME)
        for at in range(0, len(values), step):
            x = values[at : at + step, None] * self.a
            x += self.b  # below 2 ** 62
            y = x >> bits  # 2 ** 31 is 1 modulo the prime, so halves add up, to less than twice the prime
            x &= prime
            y += x
            y = y.astype(np.uint32)
            np.minimum(low, y.min(0), out=low)
            y -= least  # what was below the prime is above all others now
            np.minimum(low, y.min(0), out=low)
        return low.astype(np.int64)


def _pieces(batches):
    """Slices of batches ``(id, text, ...)`` of about ``SLICE`` bytes of text and ``SIGNED`` rows at most."""
    for batch in batches:
        for part in cut(batch, 1, SLICE):
            for at in range(0, part.num_rows, SIGNED):
                yield part.slice(at, SIGNED)
    release()


def minhash_signature(docs: DataFrame, permutations: int = BANDS * ROWS, tokenizer: str = "whitespace", window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, sig)`` for every row. A text without tokens has a null signature."""
    Signer(permutations, tokenizer, window)

    def work(batches):
        sign = Signer(permutations, tokenizer, window)
        for part in _pieces(batches):
            found = [sign(t) for t in part.column(1).to_pylist()]
            none = np.array([x is None for x in found] + [False])
            ends = np.concatenate([[0], np.cumsum(~none[:-1])]) * permutations
            values = np.concatenate([x for x in found if x is not None]) if len(found) > none.sum() else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=none), pa.array(values))], [id_col, "sig"])

    slim = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return slim.mapInArrow(work, StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("sig", ArrayType(LongType()))]))


def lsh_params(threshold: float, permutations: int = BANDS * ROWS) -> tuple[int, int]:
    """``(bands, rows)`` with ``bands * rows`` up to ``permutations`` whose curve is the steepest nearest to ``threshold``.

    A pair of similarity ``s`` meets in a band with probability ``1 - (1 - s ** rows) ** bands``;
    the areas of misses above the threshold and of false meetings below it are weighed equally.
    """
    grid = (np.arange(1000) + 0.5) / 1000
    above = grid >= threshold
    best = None
    for rows in range(1, permutations + 1):
        bands = permutations // rows
        meet = 1 - (1 - grid**rows) ** bands
        cost = float((1 - meet[above]).sum() + meet[~above].sum())
        if best is None or cost < best[0] - 1e-9:
            best = cost, bands, rows
    return best[1], best[2]


def _band_keys(docs: DataFrame, bands: int, rows: int, tokenizer: str, window: int, band_id: int | None, id_col: str, text_col: str, scope: str | None) -> DataFrame:
    """``(id, band, key, scope)`` straight from texts, with keys of eight bytes."""
    wanted = list(range(bands)) if band_id is None else [band_id]
    kind = docs.schema[id_col].dataType
    about = F.col(f"`{scope}`").cast("string") if scope else F.lit(None).cast("string")

    def work(batches):
        sign = Signer(bands * rows, tokenizer, window)
        for batch in _pieces(batches):
            index, band, key = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = sign(text)
                if own is not None:
                    for k in wanted:
                        index.append(i), band.append(k), key.append(hashlib.blake2b(own[k * rows : (k + 1) * rows].tobytes(), digest_size=12).digest())
            at = pa.array(index, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(band, pa.int32()), pa.array(key, pa.binary()), batch.column(2).take(at)], ["id", "band", "key", "scope"])

    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), about.alias("scope")).where("id is not null")
    schema = StructType([StructField("id", kind), StructField("band", IntegerType()), StructField("key", BinaryType()), StructField("scope", docs.select(about.alias("x")).schema["x"].dataType)])
    return slim.mapInArrow(work, schema)


def band_keys(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, tokenizer: str = "whitespace", window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, band, key)`` straight from texts, for ``near_dup_edges``; documents meet as they do by ``lsh_bands``."""
    return _band_keys(docs, bands, rows, tokenizer, window, None, id_col, text_col, None).select(F.col("id").alias(id_col), "band", "key")


def lsh_bands(signatures: DataFrame, bands: int = BANDS, rows: int = ROWS, band_id: int | None = None, id_col: str = "doc_id") -> DataFrame:
    """``(id, band, key)``; a single band if ``band_id`` is given."""
    wanted = range(bands) if band_id is None else [band_id]
    keys = F.array(*[F.struct(F.lit(k).alias("band"), F.md5(F.array_join(F.slice("sig", k * rows + 1, rows), ",").cast("binary")).alias("key")) for k in wanted])
    return signatures.where("sig is not null").select(id_col, F.explode(keys).alias("x")).select(id_col, "x.band", "x.key")


def near_dup_edges(bands: DataFrame, id_col: str = "doc_id", scope: str | None = None) -> DataFrame:
    """``(src, dst)``: each document of a bucket with the lowest one in it.

    Both sides of the join read the bands, so these are written once, not reckoned twice.
    """
    keys = ["band", "key"] + ([scope] if scope else [])
    bands = materialize(bands.select(id_col, *keys), "bands")
    low = bands.groupBy(*keys).agg(F.min(id_col).alias("dst"), F.count("*").alias("n")).where("n > 1").drop("n")
    return bands.join(low, keys).where(F.col(id_col) != F.col("dst")).select(F.col(id_col).alias("src"), "dst").distinct()


def verified_edges(edges: DataFrame, signatures: DataFrame, threshold: float, id_col: str = "doc_id") -> DataFrame:
    """Edges whose signatures agree in a share ``threshold`` of places."""
    left = signatures.select(F.col(id_col).alias("src"), F.col("sig").alias("sig_a"))
    right = signatures.select(F.col(id_col).alias("dst"), F.col("sig").alias("sig_b"))
    same = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda x: x)) / F.size("sig_a")
    return edges.join(left, "src").join(right, "dst").where(same >= threshold).select("src", "dst")


def components(docs: DataFrame, edges: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, component)`` for every id of ``docs``, once."""
    found = connected_components(edges).select(F.col("node").alias("__node"), F.col("component").alias("__component"))
    ids = docs.select(F.col(f"`{id_col}`").alias("__id")).where("__id is not null").distinct()
    return ids.join(found, F.col("__id") == F.col("__node"), "left").select(F.col("__id").alias(id_col), F.coalesce("__component", "__id").alias("component"))


def find_components(
    docs: DataFrame, tokenizer: str = "whitespace", bands: int = BANDS, rows: int = ROWS, window: int = WINDOW, band_id: int | None = None,
    scope: str | None = None, threshold: float | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Near duplicates from texts to ``(id, component)``; ``threshold`` also holds signatures against each other.

    Signatures are reckoned once; what is shuffled are band keys of twelve bytes,
    written to the shared folder because both sides of the star join read them.
    """
    if threshold is not None:  # signatures are needed beside the bands
        signatures = materialize(minhash_signature(docs, bands * rows, tokenizer, window, id_col, text_col).where(F.col(id_col).isNotNull()), "signatures")
        keyed = lsh_bands(signatures, bands, rows, band_id, id_col)
        if scope:
            keyed = keyed.join(docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{scope}`").alias("scope")), id_col)
        edges = verified_edges(near_dup_edges(keyed, id_col, "scope" if scope else None), signatures, threshold, id_col)
        found = materialize(components(docs, edges, id_col), "components")
        discard(signatures)
        return found
    keyed = materialize(_band_keys(docs, bands, rows, tokenizer, window, band_id, id_col, text_col, scope), "bands")
    low = keyed.groupBy("band", "key", "scope").agg(F.min("id").alias("dst"), F.max("id").alias("top")).where("dst <> top").drop("top")
    met = keyed.alias("x").join(low.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.key") == F.col("y.key")) & F.col("x.scope").eqNullSafe(F.col("y.scope")))
    edges = met.where("x.id <> y.dst").select(F.col("x.id").alias("src"), F.col("y.dst").alias("dst"))
    found = materialize(components(docs, edges, id_col), "components")
    discard(keyed)
    return found
