"""Operator 4: URL filters by a temporal list join.

A block list is a log of dated additions and removals. Each entry's log becomes
validity intervals, from an addition up to the next removal, and a capture is
held against the entries that were active when it was fetched. Entries name a
host with all hosts below it (a top-level domain too), or a host with a path
prefix of whole segments. A capture's host is expanded to its suffixes and its
path to its prefixes, as deep as any entry of the list goes, so that the join is
on equal keys with the interval as a further condition: nothing is compared with
the whole list, and the list may be of any size.

Defined results: hosts are compared without regard to case, paths with it; empty
segments (doubled slashes, one at the end) don't count, in entries and URLs
alike; entries that are then equal are one, and are returned in that form; events
of an entry at the same date apply additions first;
repeated additions and removals change nothing; an entry never removed stays
active. A null or hostless URL, or a null fetch time, is kept, with no reason.
Several active entries: the one with the most specific key counts, then the one
added last, then the category first in order. Rows repeat as in the input, and
an empty table or list gives an empty result or no blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: (entry, category, action, date): hosts and paths of the crawled pages' spam, gambling and adult sites.
LIST_EVENTS = (
    ("cheap-pills.example.com", "spam", "add", "2024-01-10"),
    ("cheap-pills.example.com", "spam", "remove", "2024-05-01"),
    ("cheap-pills.example.com", "spam", "add", "2024-08-15"),
    ("free-bets.example.com", "gambling", "add", "2024-03-01"),
    ("adult-x.example.net", "adult", "add", "2023-12-01"),
    ("adult-x.example.net", "adult", "remove", "2024-10-01"),
    ("tionsh.example.net", "spam", "add", "2024-06-01"),
    ("tionsh.example.net", "spam", "remove", "2024-07-01"),
    ("tionsh.example.net/de", "malware", "add", "2024-02-01"),
    ("ththan.example.net/en", "phishing", "add", "2024-04-01"),
    ("ththan.example.net/en", "phishing", "remove", "2024-09-01"),
    ("therti.example.org/en", "phishing", "add", "2024-05-20"),
    ("org", "embargo", "add", "2024-11-01"),
    ("org", "embargo", "remove", "2024-11-08"),
    ("Thther.Example.org/fr/", "spam", "add", "2024-02-10"),
    ("thther.example.org/FR", "scam", "add", "2024-02-10"),
    ("thther.example.org//fr", "scam", "add", "2024-02-10"),
    ("ththhe.example.com/a/b/c/d/e", "spam", "add", "2024-01-01"),
)


def default_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LIST_EVENTS), "entry string, category string, action string, at string").withColumn("at", F.to_date("at"))


def fetch_date(page_id: Column) -> Column:
    """The pages carry no fetch time; a page's number stands for its day in 2024."""
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(page_id * 37, F.lit(366)).cast("int"))


def validity_intervals(events: DataFrame) -> DataFrame:
    """``(entry, category, valid_from, valid_to)``; ``valid_to`` is null while an entry is active."""
    ordered = Window.partitionBy("entry", "category").orderBy("at", "action")
    known = events.where("entry is not null and at is not null and action in ('add', 'remove')").select(
        normal_entry(F.col("entry")).alias("entry"), F.coalesce("category", F.lit("")).alias("category"), "action", "at"
    )
    turns = known.withColumn("was", F.lag("action").over(ordered)).where("was is null and action = 'add' or was <> action")
    return turns.select("entry", "category", "action", F.col("at").alias("valid_from"), F.lead("at").over(ordered).alias("valid_to")).where(
        "action = 'add' and (valid_to is null or valid_to > valid_from)"
    ).drop("action")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^@/?#]*@)?([^:/?#]+)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)", 1)


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != "")


def normal_entry(entry: Column) -> Column:
    """Host in lower case, and the path's segments as they are."""
    host = F.substring_index(entry, "/", 1)
    parts = _segments(F.substring(entry, F.length(host) + 1, F.length(entry)))
    return F.concat(F.lower(host), F.array_join(F.transform(parts, lambda x: F.concat(F.lit("/"), x)), ""))


def url_keys(url: Column, depth: int) -> Column:
    """All entries of up to ``depth`` segments that would cover a URL: host suffixes, each with path prefixes."""
    labels = F.split(host_of(url), r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.slice(_segments(path_of(url)), 1, depth) if depth else F.array().cast("array<string>")
    paths = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def filter_urls(pages: DataFrame, events: DataFrame, fetched: Column, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, url, fetched, blocked, entry, category, valid_from)`` for every row of ``pages``."""
    # a row key tells repeated rows apart only by their values, which then also decide alike
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), fetched.alias("fetched"))
    spans = validity_intervals(events)
    depth = spans.agg(F.max(F.size(F.split("entry", "/")) - 1)).first()[0] or 0
    keyed = rows.where("url is not null and fetched is not null").dropDuplicates(["url", "fetched"]).select("url", "fetched", F.explode(url_keys(F.col("url"), depth)).alias("entry"))
    active = keyed.join(spans, "entry").where("valid_from <= fetched and (valid_to is null or fetched < valid_to)")
    order = F.struct((-F.length("entry")).alias("a"), (-F.unix_date("valid_from")).alias("b"), "category", "entry", "valid_from")
    best = active.groupBy("url", "fetched").agg(F.min(order).alias("hit"))
    out = rows.join(best, ["url", "fetched"], "left")
    return out.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "fetched", F.col("hit").isNotNull().alias("blocked"),
        F.col("hit.entry").alias("entry"), F.col("hit.category").alias("category"), F.col("hit.valid_from").alias("valid_from"),
    )


def url_oracle() -> str:
    values = ", ".join(f"('{e}', '{c}', '{a}', DATE '{d}')" for e, c, a, d in LIST_EVENTS)
    trim = lambda path: f"regexp_replace(regexp_replace({path}, '/+', '/', 'g'), '/$', '')"
    return f"""
WITH raw(given, category, action, happened) AS (VALUES {values}),
ev AS (SELECT lower(split_part(given, '/', 1)) || {trim("substr(given, length(split_part(given, '/', 1)) + 1)")} AS entry, category, action, happened FROM raw),
turns AS (
  SELECT * FROM (SELECT *, lag(action) OVER (PARTITION BY entry, category ORDER BY happened, action) AS was FROM ev)
  WHERE (was IS NULL AND action = 'add') OR was <> action),
iv AS (
  SELECT entry, category, happened AS valid_from, lead(happened) OVER (PARTITION BY entry, category ORDER BY happened, action) AS valid_to, action FROM turns),
act AS (SELECT * FROM iv WHERE action = 'add' AND (valid_to IS NULL OR valid_to > valid_from)),
p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INTEGER) AS fetched,
         lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^@/?#]*@)?([^:/?#]+)', 1)) AS host,
         {trim("regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)', 1)")} AS path
  FROM pages),
m AS (
  SELECT p.page_id, a.entry, a.category, a.valid_from,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(a.entry) DESC, a.valid_from DESC, a.category, a.entry) AS rn
  FROM p JOIN act a
    ON (host = split_part(a.entry, '/', 1) OR ends_with(host, '.' || split_part(a.entry, '/', 1)))
   AND starts_with(path || '/', substr(a.entry, length(split_part(a.entry, '/', 1)) + 1) || '/')
   AND a.valid_from <= fetched AND (a.valid_to IS NULL OR fetched < a.valid_to))
SELECT p.page_id, p.url, p.fetched, m.entry IS NOT NULL AS blocked, m.entry, m.category, m.valid_from
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.rn = 1"""
