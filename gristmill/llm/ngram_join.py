"""Operator 9: n-gram Jaccard join as a blocked sparse matrix product.

The incidence matrix of documents by word n-grams is cut into column blocks.

1. Each column block drops the n-grams of a single document: they overlap with
   nothing. What is left goes back to the rows.
2. A document of ``s`` n-grams needs an overlap of at least ``t * s`` with any
   partner, so one with fewer shared n-grams than that is dropped for good.
   The others are few: copies, and texts made mostly of common passages.
3. Of each row left, all but ``t * s - 1`` of its n-grams, the rarest first, are
   sent to column blocks again. Two rows with a Jaccard of ``t`` meet in one of
   them; within a block, rows are linked along their sizes where
   ``min >= t * max``. Linked rows form groups.
4. In a group, rows are put in tiles by size; tiles whose sizes allow a partner
   are multiplied, overlaps accumulate over column chunks, and pairs below the
   bound ``t / (1 + t) * (size a + size b)`` are discarded. What is left is counted
   for each row, weighted by the documents of the other, and the links that
   connect the rows give the classes; so the result grows with the documents,
   not with the pairs.

The result is exact but for 64-bit hash collisions. Documents with the same
n-gram set are one row of the matrix throughout.

An n-gram may be in any share of all documents. One that ``HOT`` documents of a
chunk have goes to its column block once for the chunk, with their number. For
links, of the rows of a pack that share a hot n-gram only some are sent, so many
that each of the others has one within reach; the rest are linked at once.

Defined results: words are lower-cased and parted at white space and ASCII
punctuation; a text below ``n`` words has one n-gram of all its words; a null,
empty or wordless text has no n-grams and pairs with nothing; rows without an id
pair with nothing and have no row in the result; rows that share an id are one
document, whose numbers are the sums over its different n-gram sets, and each of
which counts for others; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from gristmill.llm.arrow import cut, freeing, map_arrow, release
from gristmill.llm.words import fold, hash_words, shingles
from gristmill.operators.components import connected_components
from gristmill.session import discard, materialize

N = 5
THRESHOLD = 0.4
#: Incidences of a column block, on average; incidences and documents a task packs at once; rows of a tile.
BLOCK, PACK, PACK_DOCS, TILE = 1_500_000, 1_500_000, 50_000, 256
#: Rows of a chunk or pack from which on an n-gram that they share is hot; the index that stands for all of them.
HOT, ALL = 32, 65_535
_COLUMNS = 4096


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _spread(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _pack_grams(gram: np.ndarray, index: np.ndarray, *more: np.ndarray) -> bytes:
    """Sorted by gram, so that the upper halves nearly vanish."""
    order = np.argsort(gram)
    gram = gram[order]
    return _squeeze((gram >> np.uint64(32)).astype(np.uint32), gram.astype(np.uint32), index[order].astype(np.uint16), *(m[order] for m in more))


def _unpack_grams(blob: bytes, *more) -> list[np.ndarray]:
    high, low, index, *rest = _spread(blob, np.uint32, np.uint32, np.uint16, *more)
    return [high.astype(np.uint64) << np.uint64(32) | low, index, *rest]


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(values)))


def least_overlap(size, threshold: float):
    """Overlap without which no partner of any size reaches the threshold."""
    return np.ceil(np.asarray(size) * threshold - 1e-9).astype(np.int64)


def document_grams(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes and the text each is of, sorted by text and hash."""
    gram, owner = shingles(*hash_words([fold(t) for t in texts]), n)
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    fresh = np.ones(len(gram), bool)
    fresh[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    return gram[fresh], owner[fresh]


def _incidence(docs: DataFrame, n: int, blocks: int) -> DataFrame:
    """Column-block rows of the matrix, and with one of them each chunk's table of documents."""
    schema = StructType([
        StructField("block", IntegerType()), StructField("chunk", StringType()), StructField("data", BinaryType()),
        StructField("ids", ArrayType(docs.schema["id"].dataType)), StructField("rows", BinaryType()), StructField("hot", BinaryType()),
    ])
    names = schema.fieldNames()

    def run(batches):
        task, turn = TaskContext.get().partitionId(), 0
        grams, owners, ids, keys, nodes, sizes, held = [], [], [], [], [], [], 0

        def flush():
            nonlocal turn, held
            gram, owner = np.concatenate(grams), np.concatenate(owners)
            chunk, turn = f"{task}-{turn}", turn + 1
            order = np.argsort(gram, kind="stable")
            gram, owner = gram[order], owner[order]
            starts, count = _runs(gram)
            hot = np.repeat(count >= HOT, count)
            local = _pack_grams(gram[hot], owner[hot]) if hot.any() else None
            weight = np.concatenate([np.ones(int((~hot).sum()), np.uint16), count[count >= HOT].astype(np.uint16)])
            gram, owner = np.concatenate([gram[~hot], gram[starts[count >= HOT]]]), np.concatenate([owner[~hot], np.full(int((count >= HOT).sum()), ALL)])
            block = ((gram & np.uint64(0xFFFFFFFF)) % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            rows = []
            for a, n in zip(*(x.tolist() for x in _runs(block[order]))):  # those blocks alone that something goes to
                own = order[a : a + n]
                rows.append((int(block[own[0]]), _pack_grams(gram[own], owner[own], weight[own])))
            rows = rows or [(0, None)]
            all_ids = pa.concat_arrays(ids)
            tables = [i == turn % len(rows) for i in range(len(rows))]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(all_ids) if own else 0 for own in tables)]), pa.int32()), all_ids, mask=pa.array([not own for own in tables]))
            table = _squeeze(np.frombuffer(b"".join(nodes), "V16"), np.concatenate(sizes).astype(np.int32), np.concatenate(keys))
            for part in (grams, owners, ids, keys, nodes, sizes):
                part.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([chunk] * len(rows)), pa.array([d for _, d in rows], pa.binary()), lists, pa.array([table if own else None for own in tables], pa.binary()), pa.array([local if own else None for own in tables], pa.binary())], names)

        for batch in batches:
            for part in cut(batch, 1):
                for at in range(0, part.num_rows, PACK_DOCS // 2):
                    rows = part.slice(at, PACK_DOCS // 2)
                    if held + rows.num_rows > PACK_DOCS:
                        yield flush()
                    gram, owner = document_grams(rows.column(1).to_pylist(), n)
                    size = np.bincount(owner, minlength=rows.num_rows)
                    ends = np.cumsum(size)
                    nodes += [xxhash.xxh3_128_digest(gram[e - s : e].tobytes()) for s, e in zip(size.tolist(), ends.tolist())]
                    grams.append(gram), owners.append(owner + held), sizes.append(size), ids.append(rows.column(0)), keys.append(np.array(rows.column(2)))
                    held += rows.num_rows
                    if sum(map(len, grams)) > PACK:
                        yield flush()
        if held:
            yield flush()
        release()

    return docs.mapInArrow(run, schema)


def _shared_grams(matrix: DataFrame) -> DataFrame:
    """Column blocks: incidences of n-grams that more than one document has, back by chunk."""
    schema = StructType([matrix.schema["chunk"], matrix.schema["data"], matrix.schema["ids"], matrix.schema["rows"], matrix.schema["hot"]])

    def work(table: pa.Table) -> pa.Table:
        chunks = table.column("chunk").to_pylist()
        blobs = table.column("data").to_pylist()
        parts = [(i, *_unpack_grams(b, np.uint16)) for i, b in enumerate(blobs) if b is not None]
        data: list[bytes | None] = [None] * len(chunks)
        if parts:
            gram = np.concatenate([p[1] for p in parts])
            index = np.concatenate([p[2] for p in parts])
            weight = np.concatenate([p[3] for p in parts]).astype(np.int64)
            source = np.repeat(np.array([p[0] for p in parts], np.int32), [len(p[1]) for p in parts])
            parts = blobs = None
            order = np.argsort(gram)
            gram = gram[order]
            starts, size = _runs(gram)
            count = np.repeat(np.add.reduceat(weight[order], starts), size)
            keep = count > 1
            order, gram, count = order[keep], gram[keep], count[keep]
            rare = np.minimum(8 * np.log2(count), 255).astype(np.uint8)
            source, index = source[order], index[order]
            turn = np.argsort(source, kind="stable")
            for a, n in zip(*(x.tolist() for x in _runs(source[turn]))):
                own = turn[a : a + n]
                data[int(source[own[0]])] = _pack_grams(gram[own], index[own], rare[own])
        keep = pa.array([d is not None or r for d, r in zip(data, table.column("rows").is_valid().to_pylist())])
        return pa.table([table.column("chunk"), pa.array(data, pa.binary()), table.column("ids"), table.column("rows"), table.column("hot")], ["chunk", "data", "ids", "rows", "hot"]).filter(keep)

    return matrix.groupBy("block").applyInArrow(freeing(work), schema)


def _rows(shared: DataFrame, threshold: float) -> DataFrame:
    """Chunks: the documents whose shared n-grams suffice, each with them, rarest first."""
    schema = StructType([StructField("id", shared.schema["ids"].dataType.elementType), StructField("tkey", LongType()), StructField("node", BinaryType()), StructField("size", IntegerType()), StructField("prefix", IntegerType()), StructField("grams", BinaryType())])

    def work(table: pa.Table) -> pa.Table:
        at = table.column("rows").is_valid().to_pylist().index(True)
        ids = table.column("ids").combine_chunks()
        ids = (ids.chunk(at) if isinstance(ids, pa.ChunkedArray) else ids)[at].values
        node, size, tkey = _spread(table.column("rows")[at].as_py(), "V16", np.int32, np.int64)
        parts = [_unpack_grams(b, np.uint8) for b in table.column("data").to_pylist() if b is not None]
        gram = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
        index = np.concatenate([p[1] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
        rare = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.uint8)
        local = table.column("hot")[at].as_py()
        if local is not None:  # the chunk's documents that have a hot n-gram
            hot = index == ALL
            order = np.argsort(gram[hot])
            own_gram, own_index = _unpack_grams(local)
            own_rare = rare[hot][order][np.searchsorted(gram[hot][order], own_gram)]
            gram, index, rare = np.concatenate([gram[~hot], own_gram]), np.concatenate([index[~hot], own_index.astype(np.int64)]), np.concatenate([rare[~hot], own_rare])
        count = np.bincount(index, minlength=len(size))
        need = least_overlap(size, threshold)
        stays = (size > 0) & (count >= need)
        own = stays[index]
        gram, index, rare = gram[own], index[own], rare[own]
        order = np.lexsort((gram, rare, index))
        gram = gram[order]
        kept = np.flatnonzero(stays)
        ends = np.cumsum(count[kept])
        blobs = [gram[e - c : e].tobytes() for e, c in zip(ends.tolist(), count[kept].tolist())]
        return pa.table([ids.take(pa.array(kept)), pa.array(tkey[kept]), pa.array([node[i].tobytes() for i in kept], pa.binary()), pa.array(size[kept], pa.int32()), pa.array((count - need + 1)[kept], pa.int32()), pa.array(blobs, pa.binary())], schema.fieldNames())

    return shared.groupBy("chunk").applyInArrow(freeing(work), schema)


def forest(size: int, pairs: np.ndarray) -> np.ndarray:
    """Those of the pairs, each ``a * size + b``, that connect something new."""
    parent = list(range(size))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x, y in zip((pairs // max(1, size)).tolist(), (pairs % max(1, size)).tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[ry] = rx
            out.append((x, y))
    return np.array(out, np.int64).reshape(-1, 2)


def thin(gram: np.ndarray, size: np.ndarray, threshold: float, hot: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """What of the incidences, sorted by n-gram and size, to send, and the places whose row is linked with the next at once.

    Of a hot n-gram's rows so many are sent that the sizes of two that follow each
    other are within the threshold wherever the rows' own are: any other row
    between the two is then within it as well.
    """
    keep, joined = np.ones(len(gram), bool), []
    starts, count = _runs(gram)
    for a, n in zip(starts[count >= hot].tolist(), count[count >= hot].tolist()):
        own = size[a : a + n]
        near = np.flatnonzero(own[:-1] >= threshold * own[1:] - 1e-9)
        joined.append(a + near)
        keep[a : a + n] = False
        k = 0
        while True:
            keep[a + k] = True
            if k == n - 1:
                break
            k = max(k + 1, int(np.searchsorted(own, (own[k] + 1e-9) / threshold, "right")) - 1)
    return np.flatnonzero(keep), np.concatenate(joined) if joined else np.zeros(0, np.int64)


def _links(rows: DataFrame, threshold: float, blocks: int) -> DataFrame:
    """Edges that connect all rows which may be partners."""
    packed = StructType([StructField("block", IntegerType()), StructField("data", BinaryType()), StructField("nodes", BinaryType()), StructField("edges", BinaryType())])

    def pack(batch):
        for at in range(0, batch.num_rows, PACK_DOCS):
            part = batch.slice(at, PACK_DOCS)
            grams = [np.frombuffer(g, np.uint64)[:p] for g, p in zip(part.column(3).to_pylist(), part.column(2).to_pylist())]
            nodes, sizes = np.array(part.column(0).to_pylist(), "V16"), np.array(part.column(1).to_pylist(), np.int32)
            index = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
            gram = np.concatenate(grams)
            order = np.lexsort((sizes[index], gram))
            gram, index = gram[order], index[order]
            sent, joined = thin(gram, sizes[index], threshold)
            edges = forest(len(nodes), np.unique(np.minimum(index[joined], index[joined + 1]) * np.int64(len(nodes)) + np.maximum(index[joined], index[joined + 1])))
            gram, index = gram[sent], index[sent]
            block = ((gram & np.uint64(0xFFFFFFFF)) % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            found = []
            for a, n in zip(*(x.tolist() for x in _runs(block[order]))):
                own = order[a : a + n]
                used, local = np.unique(index[own], return_inverse=True)
                found.append((int(block[own[0]]), _pack_grams(gram[own], local), _squeeze(nodes[used], sizes[used]), None))
            if len(edges):
                found.append((int.from_bytes(nodes[0].tobytes()[:4], "little") % blocks, None, None, _squeeze(nodes[edges[:, 0]], nodes[edges[:, 1]])))
            yield [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))]

    def link(table: pa.Table) -> pa.Table:
        grams, rows, nodes, sizes, base = [], [], [], [], 0
        src, dst = [], []
        for data, table_of, edges in zip(*(table.column(c).to_pylist() for c in ("data", "nodes", "edges"))):
            if edges is not None:
                a, b = _spread(edges, "V16", "V16")
                src += [x.tobytes() for x in a]
                dst += [x.tobytes() for x in b]
                continue
            node, size = _spread(table_of, "V16", np.int32)
            gram, index = _unpack_grams(data)
            grams.append(gram), rows.append(index.astype(np.int64) + base), nodes.append(node), sizes.append(size)
            base += len(node)
        if grams:
            gram, row, node, size = map(np.concatenate, (grams, rows, nodes, sizes))
            order = np.lexsort((row, size[row], gram))
            gram, row = gram[order], row[order]
            near = (gram[1:] == gram[:-1]) & (size[row[:-1]] >= threshold * size[row[1:]] - 1e-9)
            for a, b in forest(len(node), np.unique(row[:-1][near] * np.int64(len(node)) + row[1:][near])).tolist():
                src.append(node[a].tobytes()), dst.append(node[b].tobytes())
        return pa.table([pa.array(src, pa.binary()), pa.array(dst, pa.binary())], ["src", "dst"])

    sent = map_arrow(rows.select("node", "size", "prefix", "grams"), pack, packed)
    return sent.groupBy("block").applyInArrow(freeing(link), "src binary, dst binary")


def overlaps(grams: list[np.ndarray], split: int | None = None) -> np.ndarray:
    """Overlap counts of all rows, or of the rows before ``split`` with those after."""
    row = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    _, column, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    own = shared[column]
    row, column = row[own], number[column[own]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((split or len(grams), len(grams) - (split or 0)), np.float32)
    for at in range(0, int(shared.sum()), _COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + _COLUMNS])
        part = np.zeros((len(grams), _COLUMNS), np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        total += part[:split] @ part[split:].T if split else part @ part.T
    return total.astype(np.int64)


def _multiply(tiles: DataFrame, threshold: float, docs_of: bool) -> DataFrame:
    """Of pairs of rows at the threshold or above: ``(node, links, other)``, each row's number of
    documents on the other side, and pairs that connect all; or, without ``docs_of``, ``(node_a, node_b, overlap)``."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("tile", "ascending"), ("size", "ascending"), ("node", "ascending")])
        tile, size = np.array(table.column("tile")), np.array(table.column("size")).astype(np.int64)
        node = table.column("node").to_pylist()
        grams = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
        cross = table.column("ta")[0].as_py() != table.column("tb")[0].as_py()
        split = int(np.searchsorted(tile, tile[-1])) if cross else None
        found = overlaps(grams, split)
        first, second = (size[:split], size[split:]) if cross else (size, size)
        reach = found * (1 + threshold) >= threshold * (first[:, None] + second[None, :]) - 1e-9
        a, b = np.nonzero(reach if cross else np.triu(reach, 1))
        over = found[a, b]
        b = b + (split or 0)
        if not docs_of:
            return pa.table([pa.array([node[i] for i in a], pa.binary()), pa.array([node[i] for i in b], pa.binary()), pa.array(over, pa.int64())], ["node_a", "node_b", "overlap"])
        docs = np.array(table.column("docs"))
        links = np.zeros(len(node), np.int64)
        np.add.at(links, a, docs[b])
        np.add.at(links, b, docs[a])
        edges = forest(len(node), a * np.int64(len(node)) + b)
        some = np.flatnonzero(links)
        names = [node[i] for i in some.tolist()] + [node[i] for i in edges[:, 0].tolist()]
        return pa.table([
            pa.array(names, pa.binary()), pa.array(np.concatenate([links[some], np.zeros(len(edges), np.int64)])),
            pa.array([None] * len(some) + [node[i] for i in edges[:, 1].tolist()], pa.binary()),
        ], ["node", "links", "other"])

    schema = "node binary, links long, other binary" if docs_of else "node_a binary, node_b binary, overlap long"
    return tiles.groupBy("component", "ta", "tb").applyInArrow(freeing(work), schema)


def _candidates(docs: DataFrame, n: int, threshold: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows ``(id, tkey, node)`` of documents that may have partners, their n-gram sets, and the tiles to multiply."""
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("tkey")).where("id is not null")
    volume = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(volume / 7 / BLOCK))
    rows = materialize(_rows(_shared_grams(_incidence(base, n, blocks)), threshold), "rows")
    sets = materialize(
        rows.groupBy("node").agg(F.min(F.struct("id", "tkey")).alias("least"), F.count("*").alias("docs"), F.first("size").alias("size"), F.first("prefix").alias("prefix"), F.first("grams").alias("grams")), "sets"
    )
    slim = materialize(rows.select("id", "tkey", "node"), "rows")
    discard(rows)
    parts = connected_components(_links(sets, threshold, max(1, math.ceil(blocks / 4))))
    order = Window.partitionBy("component").orderBy("size", "node")
    placed = materialize(
        sets.select("node", "size", "docs").join(parts.select("node", "component"), "node").withColumn("tile", F.floor((F.row_number().over(order) - 1) / TILE).cast("int")), "tiles"
    )
    spans = placed.groupBy("component", "tile").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    a, b = spans.alias("a"), spans.alias("b")
    tasks = a.join(b, (F.col("a.component") == F.col("b.component")) & (F.col("a.tile") <= F.col("b.tile")) & (F.col("a.high") >= F.col("b.low") * F.lit(threshold) - F.lit(1e-9)))
    tasks = tasks.select(F.col("a.component").alias("component"), F.col("a.tile").alias("ta"), F.col("b.tile").alias("tb"))
    wanted = tasks.select("component", "ta", "tb", F.explode(F.array_distinct(F.array("ta", "tb"))).alias("tile"))
    tiles = wanted.join(placed, ["component", "tile"]).join(sets.select("node", "grams"), "node")
    return slim, sets, tiles.select("component", "ta", "tb", "tile", "node", "size", "docs", "grams")


def ngram_join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All pairs of different n-gram sets with a Jaccard of ``threshold`` or more.

    ``(doc_a, doc_b, size_a, size_b, overlap, jaccard)``, each set under its lowest
    document; ``ngram_classes`` has every document.
    """
    _, sets, tiles = _candidates(docs, n, threshold, id_col, text_col)
    pairs = _multiply(tiles, threshold, False)
    left = sets.select(F.col("node").alias("node_a"), F.col("least.id").alias("id_a"), F.col("size").alias("size_x"))
    right = sets.select(F.col("node").alias("node_b"), F.col("least.id").alias("id_b"), F.col("size").alias("size_y"))
    swap = F.col("id_a") > F.col("id_b")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    found = pairs.join(left, "node_a").join(right, "node_b").select(
        pick("id_a", "id_b").alias("doc_a"), pick("id_b", "id_a").alias("doc_b"), pick("size_x", "size_y").alias("size_a"), pick("size_y", "size_x").alias("size_b"), "overlap"
    )
    return found.withColumn("jaccard", F.col("overlap") / (F.col("size_a") + F.col("size_b") - F.col("overlap")))


def _classes(docs: DataFrame, n: int, threshold: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows ``(id, tkey, node)``, and for each set ``(node, least, docs, links, first)``, the last of which is its class."""
    rows, sets, tiles = _candidates(docs, n, threshold, id_col, text_col)
    found = materialize(_multiply(tiles, threshold, True), "links")
    links = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("other is not null"), "node", "other")
    whole = sets.select("node", "least", "docs").join(links, "node", "left").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = materialize(whole.withColumn("links", F.coalesce("links", F.lit(0).cast("long"))), "classes")
    first = whole.groupBy("component").agg(F.min("least").alias("first"))
    discard(found), discard(sets)
    return rows, whole.join(first, "component").select("node", "least", "docs", "links", "first")


def ngram_classes(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, class_id, n_copies, n_links)``, a row for every id.

    ``class_id`` is the lowest id of the documents that pairs of a Jaccard of
    ``threshold`` or more connect; ``n_copies`` counts other documents with the same
    n-gram set, ``n_links`` those with another set at the threshold or above.
    """
    rows, sets = _classes(docs, n, threshold, id_col, text_col)
    own = rows.select("id", "node").distinct().join(sets, "node").groupBy("id").agg(
        F.min("first.id").alias("class"), (F.sum("docs") - F.count("*")).alias("copies"), F.sum("links").alias("links")
    )
    ids = docs.select(F.col(f"`{id_col}`").alias("id")).where("id is not null").distinct()
    zero = F.lit(0).cast("long")
    return ids.join(own, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("class", "id").alias("class_id"), F.coalesce("copies", zero).alias("n_copies"), F.coalesce("links", zero).alias("n_links")
    )


def keep_one(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class: the one with the lowest id.

    Rows go by id and text, so that another text under a lost id stays. Of rows
    that share an id and a text one stays; rows without an id all stay.
    """
    rows, sets = _classes(docs, n, threshold, id_col, text_col)
    gone = rows.join(sets.select("node", "first"), "node").where(F.struct("id", "tkey") != F.col("first")).select(F.col("id").alias("__id"), F.col("tkey").alias("__tkey")).distinct()
    text = F.xxhash64(F.col(f"`{text_col}`"))
    kept = docs.join(gone, (F.col(f"`{id_col}`") == F.col("__id")) & (text == F.col("__tkey")), "left_anti")
    repeated = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col)
    if repeated.isEmpty():
        return kept
    repeated = materialize(repeated, "repeated")
    once = kept.join(repeated, id_col, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(repeated, id_col, "left_anti").unionByName(once).select(*docs.columns)
