"""Operator 2: token counts by rank-synchronous array merging.

Pre-tokens are held as one flat symbol array with sequence starts. Every step
finds each sequence's lowest-ranked adjacent pair and applies it in all
sequences at once; when no pair has a rank, the symbols left are the count.

Defined results: a null text counts null, an empty text 0; repeated rows are
counted each; columns other than the id and the text are ignored; an empty
table gives an empty result. Null ids are carried along.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from gristmill.llm.arrow import cut, map_arrow
from gristmill.llm.bpe import DEFAULT_VOCAB, MEMO, parse_ranks, pieces, pretokens, read_vocab

NONE = np.int64(1 << 40)


class RankMerger:
    """Counts what byte-pair merging leaves of each of many byte strings."""

    def __init__(self, ranks: dict[bytes, int]):
        self.first = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.base = max(ranks.values()) + 1
        keys, values = [], []
        for word, rank in ranks.items():
            for i in range(1, len(word)):
                left, right = ranks.get(word[:i]), ranks.get(word[i:])
                if left is not None and right is not None:
                    keys.append(left * self.base + right)
                    values.append(rank)
        order = np.argsort(keys)
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int64)[order]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the vocabulary lacks it."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        left = np.array([len(w) for w in words], np.int64)
        out = left.copy()
        live = np.flatnonzero(left > 1)
        if not len(live):
            return out
        sym = self.first[np.frombuffer(b"".join(words[i] for i in live), np.uint8)]
        size = left[live]
        pair = np.full(len(sym), NONE)  # rank of the pair that starts here
        ends = np.cumsum(size) - 1
        pair[:-1] = self.rank(sym[:-1], sym[1:])
        pair[ends] = NONE
        while len(live):
            starts = np.cumsum(size) - size
            low = np.minimum.reduceat(pair, starts)
            done = low == NONE
            if done.any():
                out[live[done]] = size[done]
                keep = np.repeat(~done, size)
                sym, pair, live, size, low = sym[keep], pair[keep], live[~done], size[~done], low[~done]
                continue
            seq = np.repeat(np.arange(len(live)), size)
            at = np.flatnonzero(pair == low[seq])
            first = np.ones(len(at), bool)
            first[1:] = seq[at[1:]] != seq[at[:-1]]
            # of overlapping occurrences every other one, from the left
            fresh = np.ones(len(at), bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            take = (np.arange(len(at)) - run) % 2 == 0
            merged = self._merge(sym, pair, seq, at[take], low)
            # a new pair that ranks no higher goes before the later occurrences
            early = merged[2][merged[3]] <= low[merged[1][merged[3]]]
            if early.any():
                held = np.zeros(len(live), bool)
                held[merged[1][merged[3]][early]] = True
                take &= first | ~held[seq[at]]
                merged = self._merge(sym, pair, seq, at[take], low)
            sym, seq, pair, _ = merged
            size = np.bincount(seq, minlength=len(live))
        return out

    def _merge(self, sym, pair, seq, at, low):
        """Symbols, sequences and pair ranks after merging at ``at``, and where ranks are new."""
        sym2 = sym.copy()
        sym2[at] = low[seq[at]]  # a token's number is its rank
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        sym2, seq2, pair2 = sym2[keep], seq[keep], pair[keep]
        spot = place[at]
        new = np.unique(np.concatenate([spot, np.maximum(spot - 1, 0)]))
        right = np.minimum(new + 1, len(sym2) - 1)
        inside = (right > new) & (seq2[right] == seq2[new])
        pair2[new] = np.where(inside, self.rank(sym2[new], sym2[right]), NONE)
        return sym2, seq2, pair2, new


class TokenCounter:
    """Counts tokens of texts; what each distinct piece costs is found once per worker."""

    def __init__(self, raw: bytes):
        self.merger = RankMerger(parse_ranks(raw))
        self.full: dict[str, int] = {}
        self.spaced: dict[str, int] = {}

    def _learn(self, parts: set[str], lead: str) -> dict[str, int]:
        split = {part: [p.encode("utf-8", "surrogatepass") for p in pretokens(lead + part)] for part in parts}
        names = list(set(chain.from_iterable(split.values())))
        costs = dict(zip(names, self.merger.counts(names).tolist()))
        return {part: sum(map(costs.__getitem__, own)) for part, own in split.items()}

    def counts(self, texts: list[str | None]) -> list[int | None]:
        """Tokens of each text; pieces not met before are merged together, in one batch."""
        parted = [None if t is None else pieces(t) if t else ("", []) for t in texts]
        costs: list[list | None] = []
        full, spaced = set(), set()
        for x in parted:
            if x is None:
                costs.append(None)
                continue
            first, rest = x
            memo, wanted = (self.full, full) if first is None else (self.spaced, spaced)
            found = list(map(memo.get, rest))
            if None in found:
                wanted.update(part for part, cost in zip(rest, found) if cost is None)
            if first is not None:
                found.append(self.full.get(first))
                if found[-1] is None:
                    full.add(first)
            costs.append(found)
        fresh_full, fresh_spaced = self._learn(full, ""), self._learn(spaced, " ")
        for i, (x, found) in enumerate(zip(parted, costs)):
            if found is not None and None in found:
                first, rest = x
                fresh = fresh_full if first is None else fresh_spaced
                found[: len(rest)] = [fresh[part] if cost is None else cost for part, cost in zip(rest, found)]
                if first is not None and found[-1] is None:
                    found[-1] = fresh_full[first]
        for memo, fresh in ((self.full, fresh_full), (self.spaced, fresh_spaced)):
            if len(memo) + len(fresh) > MEMO:
                memo.clear()
            memo.update(fresh)
        return [None if found is None else sum(found) for found in costs]


def count_tokens(docs: DataFrame, vocab_path: str = DEFAULT_VOCAB, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens)`` for every row; the scan is the only stage, nothing is shuffled.

    The vocabulary file (below 1 MB) travels to the workers with the task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocab(vocab_path))
    held: list[TokenCounter] = []

    def work(batch):
        if not held:
            held.append(TokenCounter(shared.value))
        for part in cut(batch, 1):
            yield [part.column(0), pa.array(held[0].counts(part.column(1).to_pylist()), pa.int64())]

    schema = StructType([docs.schema[id_col], StructField("n_tokens", LongType())])
    return map_arrow(docs.select(id_col, text_col), work, schema)
