"""Annotation and cleaning of documents.

Defined results: rows are judged each by themselves, so repeated rows and ids get
equal results, null ids are carried along, and nothing is dropped but by ``clean`` and
``drop_secrets``; a null text has no segments, spans or score, is kept by the filter
and goes in ``clean`` for want of a score; a null URL is on no list; an empty text is one empty
segment; texts of any length are taken whole; columns keep their values whatever
their names, but those that a function names as its result are replaced; empty tables
and empty lists give empty results and no hits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.batches import cut, release
from gristmill.functions import texts, urls
from gristmill.functions.langs import is_cjk
from gristmill.session import materialize

MIN_LENGTH, MIN_AVG_WORDS, MIN_AVG_CHARS, MIN_SCORE = 500, 5, 10, 5.0
#: Rows up to which a list is broadcast.
BROADCAST_ROWS = 100_000
#: Characters of a secret that are looked for at first, and bytes of text that are looked through at once.
BEGINNING, SLICE = 8, 1 << 20


def _small(frame: DataFrame) -> DataFrame:
    """Broadcast if its rows are few, counted first; else Catalyst joins by shuffling."""
    return F.broadcast(frame) if frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else frame


def mark_adult(docs: DataFrame, domains: DataFrame, extended: bool = False, url_col: str = "url") -> DataFrame:
    """``docs`` with ``is_adult``: the host, or it without one or two labels, is listed; or a pattern is in the URL."""
    listed = _small(domains.select(F.col("domain").alias("__domain")).distinct().withColumn("__hit", F.lit(True)))
    host = urls.host(F.col(url_col))
    names = [host, urls.drop_label(host), urls.drop_label(urls.drop_label(host))]
    out, hit = docs, urls.adult_pattern(F.col(url_col)) if extended else F.lit(False)
    for i, name in enumerate(names):
        one = listed.select(F.col("__domain").alias(f"__d{i}"), F.col("__hit").alias(f"__h{i}"))
        out = out.withColumn(f"__d{i}", name).join(one, f"__d{i}", "left")
        hit = hit | F.col(f"__h{i}").isNotNull()
    return out.withColumn("is_adult", F.coalesce(hit, F.lit(False))).drop(*[f"__{x}{i}" for i in range(3) for x in "dh"])


def filter_reason(text: Column, cjk: Column, adult: Column | None = None, avg_words: bool = True, minimum: bool = True) -> Column:
    """Why a document goes: adult site, short segments, short text, in this order; else ``keep``."""
    reason = F.when(adult if adult is not None else F.lit(False), "adult_ut1")
    n = texts.segment_count(text)
    if avg_words:
        reason = reason.when(cjk & (texts.chars_total(text) <= MIN_AVG_CHARS * n), f"char_avg_{MIN_AVG_CHARS}")
        reason = reason.when(~cjk & (texts.words_total(text) <= MIN_AVG_WORDS * n), f"word_avg_{MIN_AVG_WORDS}")
    if minimum:
        reason = reason.when(F.length(text) <= MIN_LENGTH, f"length_{MIN_LENGTH}")
    return reason.otherwise("keep")


def lang_ratio(segment_langs: Column, lang: Column) -> Column:
    """Share of segments in the document's language, scripts aside."""
    own = F.filter(segment_langs, lambda s: F.substring_index(s, "_", 1) == F.substring_index(lang, "_", 1))
    return F.size(own) / F.size(segment_langs)


def list_secrets(docs: DataFrame, pattern: str = texts.SECRET, least: int = 10, text_col: str = "text") -> DataFrame:
    """Distinct secrets of more than ``least`` characters."""
    return docs.select(F.explode(F.regexp_extract_all(text_col, F.lit(pattern), F.lit(1))).alias("secret")).where(F.length("secret") > least).distinct()


def drop_secrets(docs: DataFrame, secrets: DataFrame, text_col: str = "text", most: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` without those that contain a secret.

    Each worker looks for the beginnings of the secrets by Aho-Corasick, one pass over a
    text however long the list is, and for whole ones where a beginning stands. Of a list of more than ``most`` secrets as many are sent at a time,
    and what the documents lose by them is written before the next.
    """
    known = materialize(secrets.select("secret").where("secret <> ''").distinct(), "secrets")
    turns = -(-known.count() // most)
    for turn in range(turns):
        own = [r["secret"] for r in known.where(F.pmod(F.xxhash64("secret"), F.lit(turns)) == turn).collect()]
        if own:
            docs = _without(docs, own, text_col)
            if turn < turns - 1:
                docs = materialize(docs, "unsecret")
    return docs


class Finder:
    """Tells whether a text contains any of some words; the automaton has their beginnings alone, as a node takes more than a character."""

    def __init__(self, words: list[str]):
        import ahocorasick

        self.words: set[str] = set(words)
        sizes: dict[str, set[int]] = {}
        for word in self.words:
            sizes.setdefault(word[:BEGINNING], set()).add(len(word))
        self.machine = ahocorasick.Automaton()
        known: dict[tuple[int, ...], tuple[int, ...]] = {}
        for begin, own in sizes.items():
            own = tuple(sorted(own))
            self.machine.add_word(begin, (len(begin), known.setdefault(own, own)))
        self.machine.make_automaton()

    def __call__(self, text: str) -> bool:
        for end, (length, sizes) in self.machine.iter(text):
            at = end + 1 - length
            if any(text[at : at + n] in self.words for n in sizes):
                return True
        return False


def _without(docs: DataFrame, words: list[str], text_col: str) -> DataFrame:
    import pyarrow as pa
    import pyarrow.compute as pc

    shared = docs.sparkSession.sparkContext.broadcast(words)
    at = docs.columns.index(text_col)

    def work(batches):
        finder = None
        for batch in batches:
            finder = finder or Finder(shared.value)
            for part in cut(batch, at, SLICE):
                clean = [t is None or not finder(t) for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([pc.filter(c, pa.array(clean, pa.bool_())) for c in part.columns], schema=part.schema)
        del finder
        release()

    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return flat.mapInArrow(work, flat.schema).toDF(*docs.columns)


#: Words by which the baseline tells a segment's language.
MARKERS = {
    "eng_Latn": ("the", "and", "of", "to", "is", "that", "was"),
    "fra_Latn": ("le", "la", "les", "des", "et", "que", "est"),
    "deu_Latn": ("der", "die", "das", "und", "nicht", "ist", "mit"),
    "spa_Latn": ("el", "los", "las", "y", "por", "una", "con"),
}


def marker_count(words: Column, marks: tuple[str, ...]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*marks)))


def baseline_langid(segment: Column) -> Column:
    """The language with the most marker words, the first of equals; ``und`` without any."""
    words = F.split(F.lower(segment), r"[^\p{L}]+", -1)
    counts = [marker_count(words, m) for m in MARKERS.values()]
    top = F.greatest(*counts)
    label = F.when(top == 0, "und")
    for name, count in zip(MARKERS, counts):
        label = label.when(count == top, name)
    return label


def segment_langs(text: Column, identify: Callable[[Column], Column] = baseline_langid) -> Column:
    """One label a line; a line end at the end of the text gives no further line."""
    lines = texts.segments(F.regexp_replace(F.regexp_replace(text, "\r\n", "\n"), r"\n\z", ""))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.transform(lines, identify))


def baseline_score(text: Column) -> Column:
    """A stand-in for the external quality scorer, 0 to 10: words a segment, distinct words, and letters."""
    n = texts.words_total(text)
    breadth = F.least(F.lit(1.0), n / texts.segment_count(text) / F.lit(20.0))
    letters = F.length(F.regexp_replace(text, r"[^A-Za-zÀ-ÿ]", "")) / F.greatest(F.length(text), F.lit(1))
    length = F.least(F.lit(1.0), F.length(text) / F.lit(1000.0))
    return F.round(F.lit(10.0) * (breadth * 0.4 + letters * 0.3 + length * 0.3), 3)


def clean(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Kept by the filter, not disallowed, and scored well; a missing score goes, a missing ``allowed`` stays."""
    ok = (F.col("filter") == "keep") & (F.get("doc_scores", F.lit(0)) >= min_score)
    if "allowed" in docs.columns:
        ok = ok & F.coalesce("allowed", F.lit(True))
    return docs.where(ok)


def annotate(docs: DataFrame, lang: str = "lang", text_col: str = "text", adult: Column | None = None, domains: DataFrame | None = None, extended: bool = False, url_col: str = "u") -> DataFrame:
    """Fixed text, segment languages (of the text as it was), filter reason, spans and score.

    Adult sites are told by ``adult``, or by ``domains`` (see ``readers.read_lines``) and, if ``extended``, patterns in ``url_col``.
    """
    marked = docs if domains is None else mark_adult(docs, domains, extended, url_col)
    if domains is not None:
        adult = F.col("is_adult") if adult is None else adult | F.col("is_adult")
    done = (
        marked.withColumn("seg_langs", segment_langs(F.col(text_col)))
        .withColumn(text_col, texts.fix_text(F.col(text_col)))
        .withColumn("filter", filter_reason(F.col(text_col), is_cjk(F.col(lang)), adult))
        .withColumn("pii", texts.pii_spans(F.col(text_col)))
        .withColumn("doc_scores", F.array(baseline_score(F.col(text_col))))
    )
    return done if domains is None else done.drop("is_adult")
