"""Text expressions: segments, tokenizers, fixing, personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Segments of this length or more aren't fixed.
FIX_BELOW = 50_000
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP = r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b"
PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?\(?\b[0-9]{3}\)?[ .-][0-9]{3}[ .-]?[0-9]{3,4}\b"
PII = {"EMAIL": EMAIL, "IP": IP, "PHONE": PHONE}
#: UTF-8 read as Latin-1, and typographic characters, with what they stand for.
MOJIBAKE = (("Ã©", "é"), ("Ã¨", "è"), ("Ã¼", "ü"), ("Ã¶", "ö"), ("Ã¤", "ä"), ("Ã±", "ñ"), ("Ã³", "ó"), ("â€™", "'"), ("â€œ", '"'), ("â€“", "-"), ("Â ", " "))
PLAIN_FROM, PLAIN_TO = "‘’‚“”„«»–—… ​", "'''\"\"\"\"\"--. "
SECRET = r"(?:token|api_key|secret|password)\s*=\s*\"([^\"\s]+)\""


def segments(text: Column) -> Column:
    """Lines, empty ones too."""
    return F.split(text, "\n", -1)


def segment_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def words_total(text: Column) -> Column:
    """Words of all segments, as ``split(' ')`` counts them: one more than the blanks of each."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + segment_count(text)


def chars_total(text: Column) -> Column:
    return F.length(text) - (segment_count(text) - 1)


def whitespace_tokens(text: Column) -> Column:
    """Distinct lower-cased words."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"(?U)\s+", -1), lambda x: x != ""))


def char_tokens(text: Column, window: int = 3) -> Column:
    """Distinct windows side by side, case kept; the last may be shorter."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{window}}}"), F.lit(0)))


def token_hash(token: Column) -> Column:
    """A number below 2**31 - 1 from MD5."""
    return F.conv(F.substring(F.md5(token.cast("binary")), 1, 8), 16, 10).cast("long") % 2147483647


def fix_text(text: Column) -> Column:
    """Each shorter segment without mojibake, typographic variants and HTML tags; long segments stay."""

    def fix(segment: Column) -> Column:
        fixed = segment
        for bad, good in MOJIBAKE:
            fixed = F.replace(fixed, F.lit(bad), F.lit(good))
        fixed = F.translate(fixed, PLAIN_FROM, PLAIN_TO)
        return F.regexp_replace(fixed, r"</?[A-Za-z][^<>]*>", "")

    return F.array_join(F.transform(segments(text), lambda s: F.when(F.length(s) < FIX_BELOW, fix(s)).otherwise(s)), "\n")


def pii_values(text: Column) -> Column:
    """Array of (kind, value)."""

    def tagged(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    return F.concat(*[tagged(k, p) for k, p in PII.items()])


def spans_of(text: Column, pattern: str) -> Column:
    """Half-open code-point spans of all matches, by cutting the text at them.

    The pieces between matches and the matches themselves alternate; their lengths
    add up to the places, however often a matched value stands elsewhere.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["piece"])
        end = begin + F.length(pair["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end")))).alias("out"))

    # a text that begins with a match has an empty piece before it, so pieces are one more than matches
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(values))
    return F.aggregate(F.zip_with(pieces, values, lambda p, v: F.struct(p.alias("piece"), v.alias("value"))), start, step, lambda acc: acc["out"])


def pii_spans(text: Column) -> Column:
    """Sorted spans of addresses, hosts' numbers and phone numbers."""
    return F.array_sort(F.concat(*[spans_of(text, p) for p in PII.values()]))


def document_id(file: Column, url: Column, time: Column) -> Column:
    return F.md5(F.concat(file, url, time).cast("binary"))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
