"""Operator 5: mixing sources to target weights that change over training.

Each source has a target share of the training tokens at each knot of training
progress, linear in between; the shares of all sources add up to one throughout.
A source that the schedule names has the share it says, whatever its supply. The
others divide what is left; the schedule says how far they have moved from shares
in proportion to their supply to shares in proportion to its square root, by which
a source that has most of the tokens fades and small ones grow, whatever they are
called. A named source that isn't there leaves its part to the others. The integral of a source's share, times the token budget, is its
cumulative demand. A document that begins at token ``c`` of its source, in an
order shuffled by hash, is trained on at the progress at which that demand
reaches ``c``: the demand is inverted in closed form. Sources with more tokens
than demanded end early, sources with fewer go round again (``epoch``).

Documents are counted within hash buckets, and only the buckets' totals are
added up across, so the hot source is spread like any other. The result is
range-sorted by position.

Defined results: a null source is a source of its own; a null text and an empty
one count one token; rows that share an id follow each other by
tokens; repeated rows are all placed; rows without an id are placed under an
empty id. Shares that add up to more than one are an error. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from gristmill.llm.arrow import cut, map_arrow

#: Knots of training progress, as parts of 1000, and each named source's target
#: share there, in parts of 1000; under None, how far in parts of 1000 the other
#: sources have moved from the shares of their supply to those of its square root.
KNOTS = (0, 500, 1000)
SCHEDULE: dict[str | None, tuple[int, ...]] = {"src3": (50, 100, 200), None: (0, 400, 1000)}
SEED = 17
#: Documents of a bucket, on average over all sources.
BUCKET_DOCS = 5_000


def token_estimate(text: Column) -> Column:
    """A fourth of the bytes, at least one."""
    return F.greatest(F.lit(1).cast("long"), F.coalesce(F.ceil(F.octet_length(text) / F.lit(4)), F.lit(1)).cast("long"))


def bucket_bits(n_docs: int) -> int:
    """Buckets a source are two to this power: more documents, more buckets."""
    return min(28, max(2, math.ceil(math.log2(max(1, n_docs / BUCKET_DOCS)))))


def plan_sources(supply: DataFrame, schedule: dict, knots: tuple[int, ...], total_tokens: int | None) -> DataFrame:
    """Per source ``__s``: supply, demand, budget, and the cumulative share at each knot with the share there.

    What is summed over sources are whole numbers, so their order doesn't matter.
    """
    named = {name: row for name, row in schedule.items() if name is not None}
    moved = schedule.get(None, (0,) * len(knots))
    if any(sum(row[k] for row in named.values()) > 1000 for k in range(len(knots))):
        raise ValueError("target shares add up to more than 1000")
    own = F.col("__s").isin(*named) if named else F.lit(False)
    plan = supply.select("__s", "__supply", own.alias("__named"), F.when(own, F.lit(0).cast("long")).otherwise(F.col("__supply")).alias("__o"))
    plan = plan.withColumn("__q", F.floor(F.sqrt(F.col("__o").cast("double")) * F.lit(1000.0)).cast("long"))
    parts = []
    for k in range(len(knots)):
        part = F.lit(0)
        for name, row in named.items():
            part = F.when(F.col("__s") == name, F.lit(row[k])).otherwise(part)
        parts.append(part.cast("long").alias(f"__p{k}"))
    plan = plan.select("*", *parts)
    sums = [F.sum("__supply").alias("__all"), F.sum("__o").alias("__others"), F.sum("__q").alias("__roots"), *[F.sum(f"__p{k}").alias(f"__t{k}") for k in range(len(knots))]]
    plan = plan.crossJoin(plan.agg(*sums))  # with the one row of totals
    budget = F.lit(total_tokens).cast("long") if total_tokens is not None else F.col("__all")
    share = []
    for k in range(len(knots)):
        alone = F.col("__others") == 0
        target = F.col(f"__p{k}").cast("double") / F.when(alone, F.nullif(F.col(f"__t{k}"), F.lit(0))).otherwise(F.lit(1000)).cast("double")
        left = F.lit(1.0) - F.col(f"__t{k}").cast("double") / F.lit(1000.0)
        natural = F.col("__o").cast("double") / F.nullif(F.col("__others"), F.lit(0)).cast("double")
        rooted = F.col("__q").cast("double") / F.nullif(F.col("__roots"), F.lit(0)).cast("double")
        rest = left * (F.lit((1000 - moved[k]) / 1000.0) * natural + F.lit(moved[k] / 1000.0) * rooted)
        share.append(F.coalesce(F.when(F.col("__named"), target).otherwise(rest), F.lit(0.0)))
    plan = plan.select("__s", "__supply", budget.alias("__budget"), *[x.alias(f"__w{k}") for k, x in enumerate(share)])
    area = F.lit(0.0)
    columns = [area.alias("__d0")]
    for k in range(1, len(knots)):
        width = (knots[k] - knots[k - 1]) / 1000.0
        area = area + F.lit(width) * (F.col(f"__w{k - 1}") + F.col(f"__w{k}")) / F.lit(2.0)
        columns.append(area.alias(f"__d{k}"))
    return plan.select("*", *columns).withColumn("__demand", F.round(F.col(f"__d{len(knots) - 1}") * F.col("__budget").cast("double")).cast("long"))


def mix_sources(
    docs: DataFrame,
    schedule: dict[str | None, tuple[int, ...]] = SCHEDULE,
    knots: tuple[int, ...] = KNOTS,
    total_tokens: int | None = None,
    seed: int = SEED,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    extra: tuple[str, ...] = (),
    pack: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``(id, source, *extra, n_tokens, epoch, position)`` sorted by position.

    ``position`` counts tokens of training: floor(progress * budget). The
    budget is ``total_tokens``, by default all tokens there are. ``extra`` names
    columns to carry; result columns take the place of equally named ones.
    ``pack`` is applied to the rows before they are shuffled; there the ``i``-th
    of these columns is ``__x{i}``.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("__id"), F.col(f"`{source_col}`").alias("__source"), F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("\u0000")).alias("__s"),
        token_estimate(F.col(f"`{text_col}`")).alias("__n"),
        *[F.col(f"`{c}`").alias(f"__x{i}") for i, c in enumerate(extra)],
    )
    bits = bucket_bits(docs.count())
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__id").cast("string"), F.lit(""))).cast("binary"))
    rows = rows.withColumn("__h", shuffled).withColumn("__b", F.shiftright(F.conv(F.substring("__h", 1, 7), 16, 10).cast("int"), 28 - bits))
    buckets = rows.groupBy("__s", "__b").agg(F.sum("__n").alias("__m"))
    plan = plan_sources(buckets.groupBy("__s").agg(F.sum("__m").alias("__supply")), schedule, knots, total_tokens)
    before = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("__s", "__b", F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__from")).join(plan, "__s")
    inside = Window.partitionBy("__s", "__b").orderBy("__h", "__n").rowsBetween(Window.unboundedPreceding, -1)
    placed = (pack(rows) if pack else rows).withColumn("__c", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(offsets, ["__s", "__b"])
    start = F.col("__from") + F.col("__c")
    rounds = F.ceil((F.col("__demand") - start).cast("double") / F.col("__supply").cast("double")).cast("int")
    used = placed.withColumn("__start", start).where(F.col("__start") < F.col("__demand"))
    used = used.withColumn("epoch", F.explode(F.sequence(F.lit(0), rounds - 1)))
    y = (F.col("__start") + F.col("epoch").cast("long") * F.col("__supply")).cast("double") / F.col("__budget").cast("double")
    used = used.withColumn("__y", y)
    progress = None
    for k in reversed(range(len(knots) - 1)):
        a, width = F.col(f"__w{k}"), (knots[k + 1] - knots[k]) / 1000.0
        slope = (F.col(f"__w{k + 1}") - a) / F.lit(width)
        rest = F.col("__y") - F.col(f"__d{k}")
        root = F.sqrt(F.greatest(F.lit(0.0), a * a + F.lit(2.0) * slope * rest))
        here = F.lit(knots[k] / 1000.0) + F.when(rest <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * rest / (a + root))
        progress = here if progress is None else F.when(F.col("__y") < F.col(f"__d{k + 1}"), here).otherwise(progress)
    position = F.floor(progress * F.col("__budget").cast("double"))
    used = used.withColumn("position", position)
    results = {id_col: F.col("__id"), source_col: F.col("__source"), **{c: F.col(f"__x{i}") for i, c in enumerate(extra)}, "n_tokens": F.col("__n"), "epoch": F.col("epoch"), "position": F.col("position")}
    ordered = used.orderBy("position", "__s", "__h", "epoch")
    return ordered.select(*[c.alias(name) for name, c in results.items()])


def mix_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", **how) -> DataFrame:
    """The rows of ``docs`` in the order of training, once for each epoch; texts are shuffled compressed."""
    names = docs.columns
    extra = tuple(c for c in names if c not in (id_col, source_col))
    spot = f"__x{extra.index(text_col)}"

    def recode(rows: DataFrame, column: str, kind, work) -> DataFrame:
        at = rows.columns.index(column)
        fields = [StructField(f.name, kind if f.name == column else f.dataType) for f in rows.schema.fields]

        def run(batch):
            for part in cut(batch, at, 2 << 20):
                columns = list(part.columns)
                columns[at] = work(columns[at].to_pylist())
                yield columns

        return map_arrow(rows, run, StructType(fields))

    def squeeze(texts):
        z = zstandard.ZstdCompressor(level=1).compress
        return pa.array([None if t is None else z(t.encode("utf-8", "surrogatepass")) for t in texts], pa.binary())

    def unzip(blobs):
        z = zstandard.ZstdDecompressor().decompress
        return pa.array([None if b is None else z(b).decode("utf-8", "surrogatepass") for b in blobs], pa.string())

    # the columns of the result are numbered, as those of ``docs`` may have any name
    flat = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{source_col}`").alias("s"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(extra)])
    text = f"c{extra.index(text_col)}"
    mixed = mix_sources(flat, id_col="i", source_col="s", text_col=text, extra=tuple(f"c{k}" for k in range(len(extra))), pack=lambda rows: recode(rows, spot, BinaryType(), squeeze), **how)
    full = recode(mixed.drop("n_tokens", "epoch", "position"), text, StringType(), unzip)
    place = {id_col: "i", source_col: "s"} | {c: f"c{k}" for k, c in enumerate(extra)}
    return full.select(*[F.col(place[c]).alias(c) for c in names])


def mix_oracle(n_docs: str = "(SELECT count(*) FROM documents)", table: str = "documents") -> str:
    """The same placement in DuckDB, for the default schedule and budget."""
    named = {name: row for name, row in SCHEDULE.items() if name is not None}
    names = "(" + ", ".join(f"'{n}'" for n in named) + ")"
    part = lambda k: "CASE s " + " ".join(f"WHEN '{n}' THEN {row[k]}" for n, row in named.items()) + " ELSE 0 END"
    share = lambda k: (
        f"CASE WHEN s IN {names} THEN CAST(p{k} AS DOUBLE) / CAST(CASE WHEN others = 0 THEN t{k} ELSE 1000 END AS DOUBLE) "
        f"ELSE (CAST(1 AS DOUBLE) - CAST(t{k} AS DOUBLE) / CAST(1000 AS DOUBLE)) * (CAST({(1000 - SCHEDULE[None][k]) / 1000.0} AS DOUBLE) * (CAST(o AS DOUBLE) / CAST(others AS DOUBLE)) "
        f"+ CAST({SCHEDULE[None][k] / 1000.0} AS DOUBLE) * (CAST(q AS DOUBLE) / CAST(roots AS DOUBLE))) END"
    )
    w0, w1 = (KNOTS[1] - KNOTS[0]) / 1000.0, (KNOTS[2] - KNOTS[1]) / 1000.0

    def here(k: int, width: float) -> str:
        slope = f"((w{k + 1} - w{k}) / CAST({width} AS DOUBLE))"
        rest = f"(y - d{k})"
        root = f"sqrt(greatest(CAST(0 AS DOUBLE), w{k} * w{k} + CAST(2 AS DOUBLE) * {slope} * {rest}))"
        return f"CAST({KNOTS[k] / 1000.0} AS DOUBLE) + CASE WHEN {rest} <= 0 THEN CAST(0 AS DOUBLE) ELSE CAST(2 AS DOUBLE) * {rest} / (w{k} + {root}) END"

    return f"""
WITH r AS (
  SELECT doc_id, source, coalesce(source, chr(0)) AS s,
         greatest(1, coalesce(CAST(ceil(strlen(text) / 4.0) AS BIGINT), 1)) AS n,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM {table}),
p AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY s ORDER BY h, n ROWS UNBOUNDED PRECEDING) - n AS BIGINT) AS start FROM r),
u AS (SELECT s, CAST(sum(n) AS BIGINT) AS supply FROM r GROUP BY s),
v AS (SELECT s, supply, CASE WHEN s IN {names} THEN 0 ELSE supply END AS o, {', '.join(f'{part(k)} AS p{k}' for k in range(3))} FROM u),
x AS (SELECT *, CAST(floor(sqrt(CAST(o AS DOUBLE)) * CAST(1000 AS DOUBLE)) AS BIGINT) AS q FROM v),
t AS (SELECT CAST(sum(supply) AS BIGINT) AS budget, CAST(sum(o) AS BIGINT) AS others, CAST(sum(q) AS BIGINT) AS roots, {', '.join(f'CAST(sum(p{k}) AS BIGINT) AS t{k}' for k in range(3))} FROM x),
w AS (SELECT s, supply, budget, {', '.join(f'{share(k)} AS w{k}' for k in range(3))} FROM x, t),
d AS (SELECT *, CAST(0 AS DOUBLE) AS d0, CAST(0 AS DOUBLE) + CAST({w0} AS DOUBLE) * (w0 + w1) / CAST(2 AS DOUBLE) AS d1 FROM w),
e AS (SELECT *, d1 + CAST({w1} AS DOUBLE) * (w1 + w2) / CAST(2 AS DOUBLE) AS d2 FROM d),
f AS (SELECT *, CAST(round(d2 * CAST(budget AS DOUBLE)) AS BIGINT) AS demand FROM e),
g AS (
  SELECT p.doc_id, p.source, p.n, p.start, f.*,
         unnest(range(0, CAST(ceil(CAST(demand - start AS DOUBLE) / CAST(supply AS DOUBLE)) AS BIGINT))) AS epoch
  FROM p JOIN f ON p.s = f.s WHERE start < demand),
y AS (SELECT *, CAST(start + epoch * supply AS DOUBLE) / CAST(budget AS DOUBLE) AS y FROM g)
SELECT doc_id, source, n AS n_tokens, CAST(epoch AS INTEGER) AS epoch,
       CAST(floor((CASE WHEN y < d1 THEN {here(0, w0)} ELSE {here(1, w1)} END) * CAST(budget AS DOUBLE)) AS BIGINT) AS position
FROM y"""
