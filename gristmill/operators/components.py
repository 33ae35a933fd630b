"""Connected components: one task for few edges, alternating large-star and small-star rounds for many."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gristmill.session import discard, materialize

#: Edges up to which a single task finds the components (some 100 MB); the result is the same either way.
FEW_EDGES = 1_000_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over (u, v): every neighbour is hung on the smallest node around u."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = F.least(F.min("v").over(Window.partitionBy("u")), F.col("u"))
    hung = both.withColumn("low", low)
    if large:
        out = hung.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        own = hung.select("u", F.col("low").alias("v"))
        out = hung.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(own)
    return out.where(F.col("u") != F.col("v")).distinct()


def _solve_numbers(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and their components. The larger root of an edge is hung on the smaller until there is one a component."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while ((up := root[root]) != root).any():
            root = up
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return nodes, nodes[root]


def _solve(table: pa.Table) -> pa.Table:
    """Components of all edges of a table."""
    if pa.types.is_integer(table.schema.field("u").type):  # arrays take a tenth of what Python's objects take
        return pa.table(list(_solve_numbers(table.column("u").to_numpy(), table.column("v").to_numpy())), ["node", "component"])
    parent: dict = {}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for u, v in zip(table.column("u").to_pylist(), table.column("v").to_pylist()):
        parent.setdefault(u, u), parent.setdefault(v, v)
        u, v = root(u), root(v)
        if u != v:
            parent[max(u, v)] = min(u, v)
    kind = table.schema.field("u").type
    return pa.table([pa.array(list(parent), kind), pa.array([root(x) for x in parent], kind)], ["node", "component"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, few: int = FEW_EDGES) -> DataFrame:
    """``(node, component)`` for every node of an undirected edge list.

    The component is the smallest node in it. Null ends and self loops are
    ignored, repeated edges count once, an empty list gives an empty frame, and
    other columns of ``edges`` are not looked at. Up to ``few`` edges are solved in
    one task; beyond, each round is written to the shared folder, so a lost
    executor costs a task and not the history.
    """
    now = materialize(
        edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    if now.count() <= few:
        kind = now.schema["u"].dataType
        return now.groupBy(F.lit(0).alias("all")).applyInArrow(_solve, StructType([StructField("node", kind), StructField("component", kind)]))
    mark = None
    for _ in range(max_rounds):
        seen = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if seen == mark:
            break
        mark = seen
        before, now = now, materialize(_star(_star(now, True), False), "edges")
        discard(before)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
