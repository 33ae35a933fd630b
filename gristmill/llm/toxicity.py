"""Operator 3: toxicity by a weighted lexicon, matched by Aho-Corasick.

Texts are folded first: lower case, one space between words, look-alike letters
of other scripts, styled letters and accents to plain letters, invisible
characters gone. Where a digit or sign stands in a word it is also read as the
letter that it resembles. A term counts where a word begins; a whole-word term
also needs the word's end, a stem doesn't. Of several terms that begin at one
place the longest counts. A match inside an exception phrase doesn't count. The
score is the sum of the weights, divided by the words plus ``PRIOR_WORDS``.

The lexicon has a fixed part and a part that is learned from labelled documents:
words and stems with a high log-odds ratio of being in toxic ones. At most
``SAMPLE`` labelled documents of each class are taken, those with the lowest
hash of their id; of documents with the same least shingle hash one counts, so
that copies don't vote twice. Scoring covers every document and the whole text.

Defined results: a null text has null figures and isn't toxic, an empty text
scores 0; repeated rows are scored each; rows without an id are scored too, but
not learned from; labels without an id or a verdict are ignored, and where none
are left only the fixed lexicon counts. Other columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from gristmill.llm.arrow import cut, map_arrow
from gristmill.llm.sample import lowest_hashes
from gristmill.llm.words import hash_words, shingles

#: Weights are natural log-odds ratios.
BASE_LEXICON = {
    "trash": 6.0, "pathetic": 6.0, "idiot": 7.0, "worthless": 6.0, "disgusting": 6.0, "stupid": 6.0, "clown": 6.0, "scum": 7.0,
    "loser": 6.0, "moron": 7.0, "idiots": 7.0, "morons": 7.0, "losers": 6.0, "clowns": 6.0, "idiotic": 6.0, "moronic": 6.0,
    "imbecile": 6.0, "imbeciles": 6.0, "scumbag": 7.0, "scumbags": 7.0, "dumbass": 7.0, "retard": 7.0, "retards": 7.0, "subhuman": 7.0,
    "vermin": 4.0, "degenerate": 4.0, "crap": 4.0, "crappy": 4.0, "bastard": 6.0, "bastards": 6.0, "bitch": 6.0, "asshole": 7.0, "assholes": 7.0,
}
EXCEPTIONS = (
    "trash can", "trash cans", "trash bag", "trash bags", "trash bin", "trash bins", "trash collection", "clown fish", "clown car", "circus clown",
    "class clown", "sore loser", "pathetic fallacy", "stupid question", "degenerate case", "degenerate matter", "vermin control",
)
#: Labelled documents of each class that are learned from, at most.
SAMPLE = 1500
#: Toxic documents of the sample that must have a learned term, and the least weight of one.
SUPPORT, LEAST_WEIGHT = 8, 2.0
#: Lengths of stems; a stem is left out if one word makes up this share of its documents.
STEMS, ALONE = (5, 6, 7), 0.8
PRIOR_WORDS = 40
THRESHOLD = 0.025

#: A letter, and the one that it looks like.
_LOOKALIKES = {ord(x[0]): x[1] for x in "аa вb гr еe ёe зe іi їi јj кk мm нh оo рp сc тt уy хx ѕs һh ԁd ԛq ԝw ьb αa βb γy εe ηn ιi κk νv οo ρp τt υu χx ωw ɑa ɡg ɩi ıi øo łl đd ßs ℓl ւu օo ցg հh սu".split()}
#: Letters that digits and signs stand for; i and l are one, as 1 stands for either.
_DIGITS = str.maketrans("013457@$!|+l", "oieastasiiti")
_SIGN_OUTSIDE = re.compile(r"[@$!|+](?![a-z0-9@$!|+])")
_MIXED = re.compile(r"[a-z][013457@$!|+]|[013457@$!|+][a-z]")


class _Fold(dict):
    def __missing__(self, code: int) -> str:
        plain = "".join(x for x in unicodedata.normalize("NFKD", chr(code).lower()) if not unicodedata.combining(x) and unicodedata.category(x) != "Cf")
        value = self[code] = plain.lower().translate(_LOOKALIKES)
        return value


_FOLD = _Fold()


def fold_text(text: str) -> str:
    return " ".join(text.lower().translate(_FOLD).split())


def fold_digits(folded: str) -> str:
    """The same places, with digits and signs in words as letters."""
    return _SIGN_OUTSIDE.sub(" ", folded).translate(_DIGITS)


class Lexicon:
    """Terms with weights; ``stems`` need no word end."""

    def __init__(self, words: dict[str, float], stems: dict[str, float] | None = None, exceptions: tuple[str, ...] = EXCEPTIONS):
        self.words, self.stems, self.exceptions = dict(words), dict(stems or {}), tuple(exceptions)
        self._plain = self._build(fold_text)
        self._read = self._build(lambda x: fold_text(x).translate(_DIGITS))

    def __reduce__(self):
        return Lexicon, (self.words, self.stems, self.exceptions)

    def _build(self, fold):
        entries: dict[str, list] = {}
        for place, terms in enumerate((self.words, self.stems, dict.fromkeys(self.exceptions, True))):
            for term, value in terms.items():
                if key := fold(term):
                    own = entries.setdefault(key, [len(key), None, None, False])
                    own[place + 1] = value if not own[place + 1] else max(value, own[place + 1])
        if not entries:
            return None
        machine = ahocorasick.Automaton()
        for key, own in entries.items():
            machine.add_word(key, tuple(own))
        machine.make_automaton()
        return machine

    def _scan(self, machine, text: str, found: dict[int, tuple[int, float]], safe: list[tuple[int, int]]) -> None:
        last = len(text) - 1
        for end, (size, word, stem, exception) in machine.iter(text):
            start = end - size + 1
            if start and text[start - 1].isalpha():
                continue
            closed = end == last or not text[end + 1].isalpha()
            if exception and closed:
                safe.append((start, end))
            weight = word if closed and word is not None else stem
            if weight and (start not in found or found[start][0] <= end):
                found[start] = end, weight

    def matches(self, text: str) -> tuple[int, list[tuple[str, float]]]:
        """Words of the text, and its matches as they stand in the folded text."""
        folded = fold_text(text)
        if not folded:
            return 0, []
        if self._plain is None:
            return folded.count(" ") + 1, []
        found: dict[int, tuple[int, float]] = {}
        safe: list[tuple[int, int]] = []
        self._scan(self._plain, folded, found, safe)
        if _MIXED.search(folded):
            self._scan(self._read, fold_digits(folded), found, safe)
        safe.sort()
        starts, ends = [x for x, _ in safe], list(itertools.accumulate((y for _, y in safe), max))
        hits = []
        for a, (b, w) in sorted(found.items()):
            k = bisect.bisect_right(starts, a)  # of the phrases that begin no later, the farthest reaching
            if not k or ends[k - 1] < b:
                hits.append((a, b, w))
        return folded.count(" ") + 1, [(folded[a : b + 1], w) for a, b, w in hits]

    def score(self, text: str) -> tuple[int, int, float, list[str]]:
        words, hits = self.matches(text)
        return words, len(hits), sum(w for _, w in hits) / (words + PRIOR_WORDS), sorted({x for x, _ in hits})


def terms_of(folded: str) -> list[str]:
    """Words, marked by a blank at the end, and stems of longer words; each once."""
    found = set()
    for word in {w for w in re.findall(r"[^\W\d_]+", folded) if len(w) >= 4}:
        found.add(word + " ")
        found.update(word[:k] for k in STEMS if len(word) > k)
    return list(found)


def learn_terms(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with weights, from at most ``sample`` labelled documents of each class."""
    verdicts = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("long").alias("toxic")).where("id is not null and toxic in (0, 1)")
    verdicts = verdicts.groupBy("id").agg(F.max("toxic").alias("toxic"))
    chosen = [r for t in (0, 1) for r in lowest_hashes(verdicts.where(F.col("toxic") == t), "id", sample).select("id", "toxic").collect()]
    if not any(r["toxic"] for r in chosen) or all(r["toxic"] for r in chosen):
        return {}, {}
    spark = docs.sparkSession
    picked = spark.createDataFrame(chosen, StructType([StructField("id", docs.schema[id_col].dataType), StructField("toxic", LongType())]))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    # at most twice SAMPLE ids of both classes are broadcast, whatever the corpus
    rows = texts.join(F.broadcast(picked), "id").select("toxic", "text")

    def work(batch):
        for part in cut(batch, 1):
            folded = [fold_text(t) for t in part.column(1).to_pylist()]
            value, owner = shingles(*hash_words([t.encode() for t in folded]), 3)
            least = np.full(len(folded), np.iinfo(np.uint64).max, np.uint64)
            np.minimum.at(least, owner, value)
            yield [part.column(0), pa.array(least.astype(np.int64)), pa.array([terms_of(t) for t in folded], pa.list_(pa.string()))]

    schema = StructType([StructField("toxic", LongType()), StructField("least", LongType()), StructField("terms", ArrayType(StringType()))])
    apart = map_arrow(rows, work, schema).groupBy("least").agg(F.max(F.struct("toxic", "terms")).alias("x")).select("x.*")
    sizes = {r["toxic"]: r["count"] for r in apart.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return {}, {}
    counts = apart.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    odds = F.log((F.col("a") - F.sqrt("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    kept = counts.where(F.col("a") >= SUPPORT).withColumn("w", F.round(odds, 4)).where(F.col("w") >= LEAST_WEIGHT).collect()
    words = {r["term"][:-1]: r for r in kept if r["term"].endswith(" ")}
    # a stem that hardly occurs but in one word says no more than the word
    support = {r["term"]: r["a"] for r in kept}
    alone = {w[:k] for w, r in words.items() for k in STEMS if r["a"] >= ALONE * support.get(w[:k], math.inf)}
    stems = {r["term"]: r["w"] for r in kept if not r["term"].endswith(" ") and r["term"] not in alone}
    return {w: r["w"] for w, r in words.items()}, stems


def fit_lexicon(docs: DataFrame, labels: DataFrame | None, **how) -> Lexicon:
    words, stems = learn_terms(docs, labels, **how) if labels is not None else ({}, {})
    return Lexicon(words | {w: max(v, words.get(w, v)) for w, v in BASE_LEXICON.items()}, stems)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_hits, score, terms, toxic)`` for every row; one scan, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work(batch):
        own = shared.value
        for part in cut(batch, 1):
            rows = [(None,) * 4 if t is None else own.score(t) for t in part.column(1).to_pylist()]
            words, hits, scores, terms = zip(*rows)
            yield [
                part.column(0), pa.array(words, pa.int64()), pa.array(hits, pa.int64()), pa.array([None if s is None else round(s, 9) for s in scores], pa.float64()),
                pa.array(terms, pa.list_(pa.string())), pa.array([s is not None and not math.isnan(s) and s >= threshold for s in scores], pa.bool_()),
            ]

    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType), StructField("n_words", LongType()), StructField("n_hits", LongType()),
        StructField("score", DoubleType()), StructField("terms", ArrayType(StringType())), StructField("toxic", BooleanType()),
    ])
    return map_arrow(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), work, schema)
