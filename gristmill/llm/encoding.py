"""Operator 1: BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of their bytes says so, which puts the same
cuts into the same passages wherever they stand. A chunk that occurs in more
than one document is encoded once, in the document with the lowest id that has
it, and its tokens are handed to all others. Where chunks meet, the tokens on
both sides of the join are encoded again over a window that grows until it
agrees with the tokens that both chunks have outside it.

Defined results: a null text gives null tokens, an empty text no tokens;
repeated rows and repeated ids are encoded each; rows without an id are encoded
too, but aren't chosen to encode for others; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from gristmill.llm.arrow import cut, list_array, map_arrow
from gristmill.llm.bpe import DEFAULT_VOCAB, Encoder, read_vocab
from gristmill.session import materialize

#: Mean, least and greatest bytes of a chunk.
MEAN, LEAST, MOST = 1024, 128, 8192
WINDOW = 16
_GEAR = np.random.default_rng(20231).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Where any scan of the text starts a pre-token: a space after a visible ASCII character.
_SAFE = re.compile(rb"[!-~] ")
_BLOCK = 1 << 18


def cut_points(data: np.ndarray) -> np.ndarray:
    """Positions at which the hash of the ``WINDOW`` bytes before is below the mark."""
    found = []
    mask = np.uint32((MEAN - 1) << 16)
    for at in range(0, len(data), _BLOCK):
        begin = max(0, at - WINDOW)
        h = _GEAR[data[begin : at + _BLOCK]]
        step = 1
        while step < WINDOW:  # h[i] sums GEAR[byte] << age over ever longer windows
            h[step:] += h[:-step] << np.uint32(step)
            step *= 2
        hit = np.flatnonzero((h & mask) == 0) + begin + 1
        found.append(hit[hit > at])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def all_edges(texts: list[bytes]) -> list[list[int]]:
    """``chunk_edges`` of many texts, hashed at once; cuts depend on no other text, as none lies before LEAST."""
    points = cut_points(np.frombuffer(b"".join(texts), np.uint8))
    starts = np.cumsum([0, *map(len, texts)])
    spans = np.searchsorted(points, starts)
    return [chunk_edges(text, (points[spans[i] : spans[i + 1]] - starts[i]).tolist()) for i, text in enumerate(texts)]


def chunk_edges(text: bytes, points: list[int] | None = None) -> list[int]:
    """Edges of the chunks of one text, 0 and its length among them; never inside a character."""
    size = len(text)
    if size <= LEAST:
        return [0, size]
    if points is None:
        points = cut_points(np.frombuffer(text, np.uint8)).tolist()
    edges, last = [0], 0
    for point in [*points, size]:
        while point - last > MOST:
            last += MOST
            while last < size and text[last] & 0xC0 == 0x80:
                last += 1
            edges.append(last)
        if point < size and (point - last < LEAST or text[point] & 0xC0 == 0x80):
            continue
        if point > last:
            edges.append(last := point)
    return edges


def chunk_key(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _safe_after(chunk: bytes, at: int) -> int:
    m = _SAFE.search(chunk, at)
    return m.start() + 1 if m else -1


def _safe_before(chunk: bytes, at: int) -> int:
    j = chunk.rfind(b" ", 0, at)
    while j > 0 and not 0x21 <= chunk[j - 1] <= 0x7E:
        j = chunk.rfind(b" ", 0, j)
    return j if j > 0 else -1


class Segment:
    """A run of bytes with the tokens it has when encoded by itself."""

    def __init__(self, data: bytes, tokens: np.ndarray, lengths: np.ndarray):
        self.data, self.tokens = data, tokens
        self.ends = np.cumsum(lengths[tokens])

    def index(self, at: int) -> int | None:
        """Number of tokens before byte ``at``; None if a token lies across it."""
        if at == 0:
            return 0
        k = int(np.searchsorted(self.ends, at))
        return k + 1 if k < len(self.ends) and self.ends[k] == at else None


def join_segments(segments: list[Segment], encode) -> np.ndarray:
    """Tokens of the joined segments, exactly as the joined bytes are encoded.

    Of the left side, the window takes the bytes from the last but one safe
    point on; of the right side, those up to the second. The tokens between two
    safe points of one side are the agreement: they must come out as the side
    has them. If they don't, or a side lacks the points, the window grows.
    """
    if not segments:
        return np.zeros(0, np.int64)
    left, out = segments[0], []
    for right in segments[1:]:
        found = None
        a, b = _safe_before(left.data, len(left.data)), _safe_after(right.data, 0)
        while a > 0 and b > 0:
            a0, b0 = _safe_before(left.data, a), _safe_after(right.data, b)
            if a0 < 0 or b0 < 0:
                break
            ia0, ia, jb, jb0 = left.index(a0), left.index(a), right.index(b), right.index(b0)
            if None not in (ia0, ia, jb, jb0):
                window = encode(left.data[a0:] + right.data[:b0])
                head, tail = left.tokens[ia0:ia], right.tokens[jb:jb0]
                if np.array_equal(window[: len(head)], head) and np.array_equal(window[len(window) - len(tail) :], tail) and len(head) + len(tail) <= len(window):
                    found = ia0, window, jb0
                    break
            a, b = a0, b0
        if found:
            ia0, window, jb0 = found
            out += [left.tokens[:ia0], window]
            # what is left of the right side is final up to its own next join
            done = int(right.ends[jb0 - 1]) if jb0 else 0
            left = _rest(right, done, jb0)
        else:
            left = _whole(left, right, encode)
    out.append(left.tokens)
    return np.concatenate(out)


def _rest(segment: Segment, byte: int, token: int) -> Segment:
    new = object.__new__(Segment)
    new.data, new.tokens, new.ends = segment.data[byte:], segment.tokens[token:], segment.ends[token:] - byte
    return new


def _whole(left: Segment, right: Segment, encode) -> Segment:
    """No window agreed: both sides are encoded as one."""
    new = object.__new__(Segment)
    new.data = left.data + right.data
    new.tokens = encode(new.data)
    new.ends = np.cumsum(encode.lengths[new.tokens])
    return new


def encode_with(text: bytes, shared: dict[bytes, bytes], encode: Encoder) -> np.ndarray:
    """Tokens of a text of which some chunks' tokens are given; the others are encoded in runs."""
    if not shared:
        return encode(text)
    edges = chunk_edges(text)
    segments, start = [], 0
    for a, b in zip(edges, edges[1:]):
        got = shared.get(chunk_key(text[a:b]))
        if got is None:
            continue
        if a > start:
            segments.append(Segment(text[start:a], encode(text[start:a]), encode.lengths))
        segments.append(Segment(text[a:b], encode.tokens(got), encode.lengths))
        start = b
    if start < len(text):
        segments.append(Segment(text[start:], encode(text[start:]), encode.lengths))
    return join_segments(segments, encode)


def _hold(held: list, shared) -> Encoder:
    if not held:
        held.append(Encoder(shared.value))
    return held[0]


def encode_documents(docs: DataFrame, vocab_path: str = DEFAULT_VOCAB, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, token_ids, n_tokens, n_shared, round_trip)`` for every row.

    ``n_shared`` counts the distinct chunks whose tokens came from elsewhere or
    went elsewhere; ``round_trip`` says that decoding gives the text back.
    Chunk keys are shuffled (16 bytes a chunk), the texts once, compressed;
    tokens only of chunks that documents share.
    """
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(read_vocab(vocab_path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    base = rows.where("id is not null")
    # ids and keys are declared not null, or the joins would filter each use of a
    # shuffle in its own way and it would be made once for each
    kind = StructField("id", rows.schema["id"].dataType, False)

    def chunk_rows(batch):
        for part in cut(batch, 1):
            keys = []
            texts = [(text or "").encode() for text in part.column(1).to_pylist()]
            for raw, edges in zip(texts, all_edges(texts)):
                keys.append(list({chunk_key(raw[a:b]) for a, b in zip(edges, edges[1:]) if b - a >= LEAST}))
            yield [part.column(0), pa.array(keys, pa.list_(pa.binary()))]

    def pack(batch):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for part in cut(batch, 1):
            yield [part.column(0), pa.array([None if t is None else squeeze(t.encode()) for t in part.column(1).to_pylist()], pa.binary())]

    keyed = map_arrow(base, chunk_rows, StructType([kind, StructField("keys", ArrayType(BinaryType(), False), False)]))
    # written, so that the join below may be split where documents without number share a chunk
    chunks = materialize(keyed.select("id", F.explode("keys").alias("key")), "chunks")
    owners = chunks.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("owner")).where("n > 1")
    duties = owners.groupBy("owner").agg(F.collect_list("key").alias("duty")).withColumnRenamed("owner", "id")
    packed = map_arrow(base, pack, StructType([kind, StructField("z", BinaryType())])).repartition("id")

    held: list[Encoder] = []

    def encode_duties(batch):
        encode, unzip = _hold(held, vocab), zstandard.ZstdDecompressor().decompress
        for part in cut(batch, 0, 2 << 20):
            keys, tokens = [], []
            for z, duty in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if z is None:
                    continue
                text, left = unzip(z), set(duty)
                edges = chunk_edges(text)
                for a, b in zip(edges, edges[1:]):
                    if (key := chunk_key(text[a:b])) in left:
                        left.discard(key)
                        keys.append(key)
                        tokens.append(encode(text[a:b]).tobytes())
            yield [pa.array(keys, pa.binary()), pa.array(tokens, pa.binary())]

    encoded = map_arrow(packed.join(duties, "id").select("z", "duty"), encode_duties, StructType([StructField("key", BinaryType()), StructField("tokens", BinaryType())]))
    encoded = encoded.groupBy("key").agg(F.first("tokens").alias("tokens"))
    given = chunks.join(encoded, "key").groupBy("id").agg(F.collect_list(F.struct("key", "tokens")).alias("given"))

    def finish(batch):
        encode, unzip = _hold(held, vocab), zstandard.ZstdDecompressor().decompress
        for part in cut(batch, 1, 2 << 20):
            tokens, shared, trips = [], [], []
            for z, given in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                if z is None:
                    tokens.append(None), shared.append(None), trips.append(None)
                    continue
                text, own = unzip(z), {x["key"]: x["tokens"] for x in given or ()}
                got = encode_with(text, own, encode)
                tokens.append(got), shared.append(len(own)), trips.append(encode.decode(got) == text)
            flat = list_array(np.concatenate([t for t in tokens if t is not None] or [np.zeros(0)]).astype(np.int32), [0 if t is None else len(t) for t in tokens], pa.int32())
            yield [
                part.column(0),
                pa.ListArray.from_arrays(flat.offsets, flat.values, mask=pa.array([t is None for t in tokens])),
                pa.array([None if t is None else len(t) for t in tokens], pa.int64()),
                pa.array(shared, pa.int64()),
                pa.array(trips, pa.bool_()),
            ]

    schema = StructType([StructField(id_col, kind.dataType), StructField("token_ids", ArrayType(IntegerType())), StructField("n_tokens", LongType()), StructField("n_shared", LongType()), StructField("round_trip", BooleanType())])
    done = map_arrow(packed.join(given, "id", "left").select("id", "z", "given"), finish, schema)
    nameless = map_arrow(rows.where("id is null"), pack, StructType([StructField("id", kind.dataType), StructField("z", BinaryType())]))
    alone = map_arrow(nameless.withColumn("given", F.lit(None).cast(given.schema["given"].dataType)), finish, schema)
    return done.unionByName(alone)


def decode_documents(encoded: DataFrame, vocab_path: str = DEFAULT_VOCAB, id_col: str = "doc_id", tokens_col: str = "token_ids") -> DataFrame:
    """``(id, text)`` from token numbers; null tokens give null, bytes that aren't UTF-8 give U+FFFD."""
    vocab = encoded.sparkSession.sparkContext.broadcast(read_vocab(vocab_path))
    held: list[Encoder] = []

    def work(batch):
        encode = _hold(held, vocab)
        texts = [None if t is None else encode.decode(np.asarray(t, np.int64)).decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
        yield [batch.column(0), pa.array(texts, pa.string())]

    return map_arrow(encoded.select(id_col, tokens_col), work, StructType([encoded.schema[id_col], StructField("text", StringType())]))
