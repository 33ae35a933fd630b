"""robots.txt: parsing, patterns, and the URLs that rules forbid.

Defined results: a null body or URL gives no rules; repeated rows of a robots.txt give
their rules once, two bodies under one URL each their own; a null URL of a document
is allowed; of rules with equal numbers one counts; documents repeat as they were
and keep their other columns, but for an ``allowed`` of their own; bodies and URLs of
any length are read whole; empty tables give empty results, or allow all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.urls import robots_domain, strip_prefix

AGENTS = ("ia_archiver", "ccbot", "*")
_AGENT = r"(?i)^User-agent: ?([^#]+?)\s*(?:#.*)?$"
_RULE = r"(?i)^((?:Dis)?Allow): ?(/.*?)(?:#.*)?$"


def parse_robots(docs: DataFrame, agents: tuple[str, ...] = AGENTS, url: str = "u", body: str = "p") -> DataFrame:
    """``(u, host, rule_idx, pattern, allowed)`` for the rules that hold for ``agents``.

    User-agent lines in a row, comment lines aside, share what follows them. A
    blank line ends a group that concerns us. Spaces and line ends after an agent's
    name don't matter. Bodies without ``disallow:`` give nothing.
    """
    bodies = docs.select(F.col(f"`{url}`").alias("u"), F.col(f"`{body}`").alias("p")).where(F.contains(F.lower("p"), F.lit("disallow:")) & F.col("u").isNotNull())
    lines = bodies.withColumn("which", F.xxhash64("p")).dropDuplicates(["u", "which"]).select(
        "u", "which", robots_domain(F.col("u")).alias("host"), F.posexplode(F.split("p", "\n", -1)).alias("no", "raw")
    )
    lines = lines.where(~F.startswith("raw", F.lit("#"))).withColumn("line", F.regexp_replace("raw", r"\s+$", ""))
    agent = F.regexp_extract("line", _AGENT, 1)
    order = Window.partitionBy("u", "which").orderBy("no")
    marked = lines.select("u", "which", "host", "no", "line", F.nullif(F.lower(agent), F.lit("")).alias("agent"))
    is_agent = F.col("agent").isNotNull()
    marked = marked.withColumn("start", is_agent & ~F.coalesce(F.lag(is_agent).over(order), F.lit(False)))
    marked = marked.withColumn("group", F.sum(F.col("start").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    group = Window.partitionBy("u", "which", "group")
    so_far = group.orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    judged = marked.where("group > 0").select(
        "*",
        F.max(F.coalesce(F.col("agent").isin(*agents), F.lit(False))).over(group).alias("ours"),
        F.max((F.col("line") == "").cast("int")).over(so_far).alias("ended"),
    )
    kind, path = F.lower(F.regexp_extract("line", _RULE, 1)), F.regexp_extract("line", _RULE, 2)
    rules = judged.where(F.col("ours") & (F.col("ended") == 0) & (kind != ""))
    pattern = F.replace(F.trim(F.concat("host", path)), F.lit("\t"), F.lit(""))
    return rules.select("u", "host", F.col("no").alias("rule_idx"), pattern.alias("pattern"), (kind == "allow").alias("allowed"))


def pattern_to_regex(pattern: Column) -> Column:
    """A Java regular expression that a whole URL has to match."""
    plain = F.regexp_replace(pattern, r"[\^$]", "")
    escaped = F.replace(F.regexp_replace(plain, r"([\\.+?()|\[\]{}#&~-])", r"\\$1"), F.lit("*"), F.lit(".*"))
    return F.concat(F.lit("^(?:"), escaped, F.when(pattern.rlike(r"[$*]$"), F.lit("")).otherwise(F.lit(".*")), F.lit(r")\z"))


def _host(url: Column) -> Column:
    return F.regexp_extract(strip_prefix(url), r"^([^/]*)", 1)


def disallowed_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """``(url)``: keys (URLs without prefix) that the last matching rule of some robots.txt forbids.

    ``rules`` has ``u`` (which robots.txt), ``pattern``, ``allowed`` and
    ``rule_idx``. URLs and rules meet on the host, which every pattern begins with.
    """
    keys = urls.select(strip_prefix(F.col(url_col)).alias("url")).distinct().withColumn("host", F.regexp_extract("url", r"^([^/]*)", 1))
    named = rules.select(F.col("u").alias("file"), "rule_idx", "allowed", pattern_to_regex(F.col("pattern")).alias("regex"), _host(F.col("pattern")).alias("host"))
    met = keys.join(named, "host").where(F.rlike("url", F.col("regex")))
    last = met.groupBy("url", "file").agg(F.max_by("allowed", "rule_idx").alias("allowed"))
    return last.where(~F.col("allowed")).select("url").distinct()


def annotate_robots(docs: DataFrame, disallowed: DataFrame, url_col: str = "url") -> DataFrame:
    """``docs`` with ``allowed``; the join is on the URL without prefix, and rows repeat as they were."""
    hit = disallowed.select(F.col("url").alias("__key")).distinct().withColumn("__hit", F.lit(True))
    keyed = docs.drop("allowed").withColumn("__key", strip_prefix(F.col(url_col)))
    return keyed.join(hit, "__key", "left").withColumn("allowed", F.col("__hit").isNull()).drop("__key", "__hit")


def filter_disallowed(docs: DataFrame, disallowed: DataFrame, url_col: str = "url") -> DataFrame:
    hit = disallowed.select(F.col("url").alias("__key"))
    return docs.withColumn("__key", strip_prefix(F.col(url_col))).join(hit, "__key", "left_anti").drop("__key")
