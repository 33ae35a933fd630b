"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOST = r"(?i)^(?:https?://)?(?:[^@/\n]+@)?(?:www\.)?([^:/\n]+).*$"
#: Substrings of a URL that the extended adult filter looks for, case-sensitively.
ADULT_PATTERNS = ("porn", "sex", "tube", "cams", "camgirls", "mature")


def strip_prefix(url: Column) -> Column:
    """Without the scheme and ``www.``; case-sensitive."""
    return F.regexp_replace(url, r"^(https?://)?(www\.)?", "")


def host(url: Column) -> Column:
    """The host without scheme, user and ``www.``; a URL that has none is given back whole."""
    return F.regexp_replace(url, HOST, "$1")


def drop_label(name: Column) -> Column:
    """Without the first label; a name without a dot stays."""
    return F.regexp_replace(name, r"^[^.]*\.", "")


def robots_domain(url: Column) -> Column:
    """The host part of a robots.txt's own URL."""
    return F.regexp_replace(url, r"(https?://)?(www.)?([^/]*)(/.*)", "$3")


def adult_pattern(url: Column) -> Column:
    hit = F.lit(False)
    for word in ADULT_PATTERNS:
        hit = hit | F.contains(url, F.lit(word))
    return hit


def strip_zeros(path: Column) -> Column:
    """Batch names without padding: ``batch_007`` gives ``7``."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(path, "_0+", "_"), "/0+", "/"), "batch_", "")


def crawl_name(file: Column) -> Column:
    """The crawl a WARC file belongs to, from its name; null if it can't be told."""
    cc = F.regexp_extract(file, r"^(CC-MAIN-[0-9]{4})", 1)
    return (
        F.when(file.rlike("^(GO_JP|GOV_AR)"), "wide00006").when(file.rlike("^WIDE"), "wide").when(cc != "", cc).when(file.rlike("^archivebot"), "archivebot")
    )
