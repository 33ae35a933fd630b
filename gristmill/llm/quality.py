"""Operator 6: quality rules as weak supervision.

Each rule votes that a document is good or bad, or abstains. The votes of a
document make a pattern; patterns are counted over the whole corpus, and
expectation-maximisation finds from the counts how often each rule votes each
way on good and on bad documents, and what share is good (a two-class naive
Bayes mixture whose sufficient statistics are the pattern counts). A document's
posterior probability of being good decides, not whether it passes every rule.

There are at most ``3 ** len(RULES)`` patterns however large the corpus is, so
the driver iterates over a small table; the documents are read once to count and
once to judge.

Rules know no language but by a table: a document whose ``lang`` (its first two
letters) has no list of stop words gets no bad vote for lack of them, nor does one
without a language. In scripts without spaces each character counts as a word.
However rare a bad vote is among good documents, it isn't held to be rarer than
``LEAST_BAD``, so a single one doesn't outweigh many good ones.

Defined results: a null or wordless text has no votes and a null quality, and is
rejected because it holds nothing. Repeated rows are judged each and count each;
null ids are carried along; other columns are ignored, and kept as they are by
``keep_good``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from gristmill.llm.arrow import cut, map_arrow
from gristmill.session import materialize

GOOD, BAD, ABSTAIN = 1, 0, 2
KEEP = 0.5
#: Rounds of expectation-maximisation at most, and the change of the likelihood per document that ends it.
ROUNDS, SETTLED = 500, 1e-10
#: What is believed beforehand, with the weight of a share ``PRIOR`` of each class's
#: votes: most documents are good; a fault shows to few of the rules, so a bad
#: document gets a bad vote from one rule in four, a good one hardly any.
PRIOR, GOOD_SHARE, BAD_VOTES_OF_BAD, BAD_VOTES_OF_GOOD = 0.02, 0.85, 0.25, 0.005
#: The least chance of a bad vote that a good document is given.
LEAST_BAD = 0.02

#: By language; what isn't here abstains.
STOP_WORDS = {
    "en": frozenset("the be to of and that have with a is in it for was on are this from an as at by or not you".split()),
    "fr": frozenset("le la les de des du et que une dans est un en au pour qui avec sur par pas il ne se".split()),
    "de": frozenset("der die und das ist nicht von zu den mit ein eine dem sich des auf im für auch als".split()),
    "es": frozenset("el la de que en los las del y una por con para es lo su al más como se no".split()),
}
_ANY_STOP_WORDS = frozenset().union(*STOP_WORDS.values())
#: Characters of scripts without spaces between words.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua4cf\uf900-\ufaff\U00020000-\U0003ffff]")
_MARKS = frozenset("#$%&*<>{}[]|\\^~=_+@")
_MARK = re.compile(r"[#$%&*<>{}\[\]\\^~=_+@]{2,}")
_END = (".", "!", "?", ":", ";", '"', "'", ")", "…", "»", "”", "“", "’", "。", "！", "？", "：", "；", "」", "』", "）", "।", "؟", "۔", "։", "።")


class Facts:
    """What the rules look at, of one text with words."""

    __slots__ = ("words", "n", "lines", "text", "distinct", "counts", "unspaced", "lang")

    def __init__(self, text: str, words: list[str], lang: str | None = None):
        self.unspaced = False
        if not text.isascii() and _UNSPACED.search(text):
            inside = len(_UNSPACED.findall(text))
            if inside > 0.3 * len(text.replace(" ", "")):
                self.unspaced, words = True, _UNSPACED.sub(lambda m: f" {m.group()} ", text).split()
        self.text, self.words, self.n, self.lang = text, words, len(words), lang
        self.lines = [x for x in (line.strip() for line in text.split("\n")) if x]
        self.counts = Counter(words)
        self.distinct = len(self.counts)


def _vote(value: float, good: float, bad: float) -> int:
    """Good up to ``good``, bad from ``bad`` on."""
    return BAD if value >= bad else GOOD if value <= good else ABSTAIN


def word_length(f: Facts) -> int:
    if f.n < 5 or f.unspaced:
        return ABSTAIN
    mean = (len(f.text) - f.text.count(" ")) / f.n
    return BAD if mean < 2.5 or mean > 14 else GOOD if 3 <= mean <= 11 else ABSTAIN


def capitals(f: Facts) -> int:
    if f.n < 5:
        return ABSTAIN
    upper = sum(map(str.isupper, f.words))
    return _vote(upper / f.n, 0.15, 0.5)


def marks(f: Facts) -> int:
    """Words that carry runs of signs."""
    return _vote(len(_MARK.findall(f.text)) / f.n, 0.02, 0.2)


def exclamations(f: Facts) -> int:
    return _vote(f.text.count("!") / f.n, 0.05, 0.4)


def stutter(f: Facts) -> int:
    """Words that repeat the word before."""
    if f.n < 5:
        return ABSTAIN
    again = sum(map(str.__eq__, f.words, f.words[1:]))
    return _vote(again / f.n, 0.05, 0.25)


def repeated_lines(f: Facts) -> int:
    if len(f.lines) < 3:
        return ABSTAIN
    return _vote(1 - len(set(f.lines)) / len(f.lines), 0.15, 0.4)


def vocabulary(f: Facts) -> int:
    """Distinct words against the number that running text of this length has."""
    if f.n < 20:
        return ABSTAIN
    share = f.distinct / min(f.n, f.n**0.8 + 5)
    return BAD if share < 0.3 else GOOD if share > 0.5 else ABSTAIN


def commonest(f: Facts) -> int:
    if f.n < 20:
        return ABSTAIN
    return _vote(max(f.counts.values()) / f.n, 0.12, 0.3)


def stop_words(f: Facts) -> int:
    if f.n < 20 or f.unspaced:
        return ABSTAIN
    own = STOP_WORDS.get(f.lang[:2].lower()) if f.lang else None
    known = own or _ANY_STOP_WORDS
    found = sum(c for w, c in f.counts.items() if w in known or w.lower() in known)
    return GOOD if found / f.n >= 0.06 else BAD if own and found / f.n < 0.01 else ABSTAIN


def sentences(f: Facts) -> int:
    """Lines that end like sentences."""
    if f.n < 10:
        return ABSTAIN
    done = sum(line.endswith(_END) for line in f.lines)
    share = done / len(f.lines)
    return GOOD if share >= 0.5 else BAD if share < 0.1 else ABSTAIN


def bars(f: Facts) -> int:
    """Words that are separators of tables and menus."""
    lone = sum(c for w, c in f.counts.items() if len(w) == 1 and w in _MARKS)
    return _vote(lone / f.n, 0.05, 0.3)


RULES = (word_length, capitals, marks, exclamations, stutter, repeated_lines, vocabulary, commonest, stop_words, sentences, bars)


def votes_of(text: str | None, lang: str | None = None) -> list[int] | None:
    """The votes of all rules on a text, or None if it has no words."""
    words = text.split() if text else []
    if not words:
        return None
    facts = Facts(text, words, lang)
    return [rule(facts) for rule in RULES]


def pattern_of(text: str | None, lang: str | None = None) -> int:
    """The votes as digits to base 3; -1 for a text without words."""
    votes = votes_of(text, lang)
    return -1 if votes is None else sum(v * 3**i for i, v in enumerate(votes))


def unpack(patterns: np.ndarray, rules: int = len(RULES)) -> np.ndarray:
    """Votes of patterns, one row for each."""
    return patterns[:, None] // 3 ** np.arange(rules) % 3


def fit(patterns: np.ndarray, counts: np.ndarray, rules: int = len(RULES)) -> tuple[np.ndarray, np.ndarray]:
    """``(share, table)``: the classes' shares, and P(vote | class, no abstention) as ``table[class, rule, vote]``."""
    votes = unpack(patterns, rules)
    hot = (votes[:, :, None] == np.arange(2)).astype(float)  # pattern, rule, vote; an abstention says nothing
    total = counts.sum()
    belief = np.empty((2, rules, 2))
    for c, bad in ((GOOD, BAD_VOTES_OF_GOOD), (BAD, BAD_VOTES_OF_BAD)):
        belief[c, :, BAD], belief[c, :, GOOD] = bad, 1 - bad
    believed = np.array([1 - GOOD_SHARE, GOOD_SHARE])
    share, table, before = believed.copy(), belief.copy(), -np.inf
    for _ in range(ROUNDS):
        joint = np.log(share) + np.einsum("prv,crv->pc", hot, np.log(table))
        top = joint.max(1, keepdims=True)
        likely = np.exp(joint - top)
        mass = likely.sum(1, keepdims=True)
        now = float((counts * (top + np.log(mass))[:, 0]).sum() / total)
        post = likely / mass * counts[:, None]
        sizes = post.sum(0)
        table = np.einsum("pc,prv->crv", post, hot) + (PRIOR * (sizes + 1))[:, None, None] * belief
        table /= table.sum(2, keepdims=True)
        share = (sizes + PRIOR * total * believed) / (total * (1 + PRIOR))
        if abs(now - before) < SETTLED:
            break
        before = now
    table[GOOD, :, BAD] = np.maximum(table[GOOD, :, BAD], LEAST_BAD)
    table[GOOD, :, GOOD] = 1 - table[GOOD, :, BAD]
    return share, table


def posterior(patterns: np.ndarray, share: np.ndarray, table: np.ndarray) -> np.ndarray:
    """P(good | votes) of each pattern."""
    votes = unpack(patterns, table.shape[1])
    full = np.concatenate([np.log(table), np.zeros((*table.shape[:2], 1))], axis=2)
    joint = np.log(share) + np.stack([full[c, np.arange(votes.shape[1]), votes].sum(1) for c in (0, 1)], 1)
    return 1 / (1 + np.exp(joint[:, BAD] - joint[:, GOOD]))


def _with_language(docs: DataFrame, text_col: str, lang_col: str):
    """Text and language columns; a table without the latter has none."""
    lang = F.col(f"`{lang_col}`").cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    return F.col(f"`{text_col}`").alias("text"), lang.alias("lang")


def _patterns(part: pa.RecordBatch, at: int) -> pa.Array:
    return pa.array(list(map(pattern_of, part.column(at).to_pylist(), part.column(at + 1).to_pylist())), pa.int64())


def posteriors(counts: DataFrame) -> dict[int, float]:
    """Posterior of every pattern that occurs; ``counts`` has 3 ** rules rows at most."""
    rows = [(r["pattern"], r["n"]) for r in counts.where("pattern >= 0").collect()]
    if not rows:
        return {}
    patterns, numbers = np.array(sorted(rows), np.int64).T
    return dict(zip(patterns.tolist(), posterior(patterns, *fit(patterns, numbers.astype(float))).tolist()))


def letters(pattern: int) -> str:
    return "".join("bg-"[pattern // 3**i % 3] for i in range(len(RULES))) if pattern >= 0 else "-" * len(RULES)


def judge(docs: DataFrame, keep_at: float = KEEP, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, votes, quality, keep)`` for every row.

    ``votes`` has a letter for each of ``RULES``: g good, b bad, - abstains. The
    rules are applied once; their patterns (a number for each row) are written to
    the shared folder, counted, and then looked up.
    """

    def work(batch):
        for part in cut(batch, 1):
            yield [part.column(0), _patterns(part, 1)]

    kind = docs.schema[id_col].dataType
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), *_with_language(docs, text_col, lang_col))
    rows = materialize(map_arrow(slim, work, StructType([StructField("id", kind), StructField("pattern", LongType())])), "votes")
    chances = docs.sparkSession.sparkContext.broadcast(posteriors(rows.groupBy("pattern").agg(F.count("*").alias("n"))))

    def look_up(batch):
        known = chances.value
        patterns = batch.column(1).to_pylist()
        quality = [known.get(p) for p in patterns]
        keep = [q is not None and q >= keep_at for q in quality]
        yield [batch.column(0), pa.array(list(map(letters, patterns)), pa.string()), pa.array(quality, pa.float64()), pa.array(keep, pa.bool_())]

    return map_arrow(rows, look_up, StructType([StructField(id_col, kind), StructField("votes", StringType()), StructField("quality", DoubleType()), StructField("keep", BooleanType())]))


def keep_good(docs: DataFrame, keep_at: float = KEEP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rejected rows; all columns as they are, nothing is shuffled but pattern counts.

    The rules are applied once: rows are written to the shared folder with their patterns.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    flat = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], *_with_language(docs, text_col, lang_col))
    last = len(names)

    def work(batch):
        for part in cut(batch, last):
            yield [*part.columns[:last], _patterns(part, last)]

    rows = materialize(map_arrow(flat, work, StructType([*flat.schema.fields[:last], StructField("pattern", LongType())])), "judged")
    chances = posteriors(rows.groupBy("pattern").agg(F.count("*").alias("n")))
    good = [(p,) for p, chance in chances.items() if chance >= keep_at]
    known = docs.sparkSession.createDataFrame(good, "good long")  # 3 ** rules at most
    return rows.join(F.broadcast(known), rows["pattern"] == known["good"], "left_semi").select(*names).toDF(*docs.columns)
