"""Operator 8: fuzzy line dedup by SimHash blocks and edit similarity.

Lines are normalised (lower case, words parted by single spaces, ASCII
punctuation gone). Equal normalised lines are one kind, whatever their length.
Kinds of ``MIN_WORDS`` words or more meet in buckets of two sorts:

- SimHash: the 128 bits of a kind's SimHash are cut into ``BLOCKS`` blocks; kinds
  that agree in a whole block meet. By the pigeonhole principle all pairs that
  differ in fewer bits than there are blocks do so.
- A few changed words turn many bits of a line, so kinds also meet by what is
  left whole of their words (see ``line_keys``); this is the pigeonhole
  principle again, with words in the place of bits.

Neither depends on what else is in the table or on its size. In a bucket,
pairs are held against a bound that edit similarity can't pass (the difference
of the numbers of letters); what is left is verified by edit similarity. Similar
kinds form connected groups. Of all lines of a group, the first occurrence
(lowest document id, then lowest line number) stays.

Without chance, kinds meet that differ in one word (changed, added, missing or
parted) up to ``ONE_OUT`` words, and in two up to ``TWO_OUT``; that differ in three words
in their places up to ``ONE_OUT``; and longer ones if one part of six to twelve of the line is
whole. Other pairs meet with a probability (README has figures).

A bucket of more than ``WIDE`` kinds of which many are close is not paired but
verified as a crowd. Crowds that share kinds are one family, cut into tiles. Within
a tile what is connected already isn't compared again; across tiles only kinds
outside of the family's largest connected set are compared, with all that lengths
allow. No bucket, group, crowd or family is cut short.

Defined results: lines of fewer than ``MIN_WORDS`` words are compared for equality
alone; a character of a script without spaces counts as a word, and blanks
between two such characters don't count. Lines without words stay. Documents
keep their rows whatever is left of them: a text of which all lines went is
empty. A null or empty text stays as it is, and so does a row without an id.
Rows that share an id are told apart by their text; repeated rows (same id and
text) are one document and all get the same result. Other columns are kept as
they are, and an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, IntegralType, LongType, StringType, StructField, StructType

from gristmill.llm.arrow import cut, freeing, map_arrow, release
from gristmill.llm.words import _SEPARATES, fold, mix
from gristmill.operators.components import connected_components
from gristmill.session import discard, materialize

#: Lines with fewer words are held against equal lines only.
MIN_WORDS = 5
SIMILARITY = 0.9
#: Blocks of 32 bits of a SimHash.
BLOCKS = 4
#: Lines up to ``TWO_OUT`` words (and one more) have keys with one and with any two words left out; from
#: ``PAIRED`` up to ``ONE_OUT`` words keys of two of five parts; longer ones keys of single parts of
#: ``PART_WORDS`` words or more, ``PARTS`` at most.
TWO_OUT, PAIRED, ONE_OUT, PARTS = 12, 10, 25, 12
PART_WORDS = np.array([4] + [int(6 * 1.5**i) for i in range(40)], np.int64)
#: Buckets of letters in a profile.
LETTERS = 12
#: Kinds of a bucket up to which all close ones are paired, and pairs a kind of larger ones up to which they still are.
WIDE, SPARSE = 64, 32
#: Kinds of a larger bucket up to which its pairs are looked at, kinds of a tile, and of those kinds that all tiles of a family have.
PROBED, TILE, ANCHORS = 2048, 512, 16
#: Pairs of a group up to which a task verifies it as a whole, and pairs of a call, on average.
GROUP, CALL = 200_000, 20_000
#: Keys reckoned for a line, and entries of a bucket range.
KEYS, RANGE = 25, 400_000
#: Bytes of text that are parsed at once, and entries that a task packs at once.
SLICE, PACK = 2 << 20, 2_000_000
#: Places of lines that a task holds before it folds those of one kind.
FOLD = 1_000_000
_SPACE = bytes(b if not _SEPARATES[b] else 32 for b in range(256))
_LINE = bytes(10 if b == 10 else _SPACE[b] for b in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Thai, Lao, Burmese, Khmer, kana, Chinese and Yi characters.
_UNSPACED = re.compile("([฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿ꀀ-꓏豈-﫿\U00020000-\U0003ffff])")
#: The least byte that characters of these begin with.
_HIGH = 0xE0


def normalise(line: str) -> str:
    return b" ".join(fold(line).translate(_SPACE).split()).decode("utf-8", "surrogatepass")


def lines_of(text: str) -> list[tuple[int, bytes]]:
    """Numbers and normalised forms of the lines that have words."""
    out = []
    for no, own in enumerate(map(bytes.split, fold(text).translate(_LINE).split(b"\n"))):
        if own:
            out.append((no, b" ".join(own)))
    return out


def document_key(text: str | bytes) -> int:
    return xxhash.xxh3_64_intdigest(text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")) - (1 << 63)


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_LONG_WORD = 64


def _hash_runs(data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the given runs of bytes; ``data`` goes on for eight bytes at least after the last."""
    raw = np.ndarray((len(data) - 7,), np.dtype("<u8"), data, 0, (1,))
    size = end - begin
    value = mix((raw[begin] & _MASKS[np.minimum(size, 8)]) + size.astype(np.uint64) * _STEP)
    rest, at = np.flatnonzero(size > 8), 8
    while len(rest) and at < _LONG_WORD:
        value[rest] = mix(value[rest] * _STEP + (raw[begin[rest] + at] & _MASKS[np.minimum(size[rest] - at, 8)]))
        at += 8
        rest = rest[size[rest] > at]
    for i in rest.tolist():
        value[i] = xxhash.xxh3_64_intdigest(data[begin[i] : end[i]])
    return value


_powers: list[np.ndarray] = []


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < size:
        _powers[:] = []
        for factor in (0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)):
            row = np.full(max(size, 1 << 20), factor, np.uint64)
            row[0] = 1
            _powers.append(np.multiply.accumulate(row))
    return _powers[0], _powers[1]


def _edges(parts: list[bytes]) -> np.ndarray:
    """Where each part begins among all, with a byte between two."""
    lengths = np.array([len(p) + 1 for p in parts], np.int64)
    return np.cumsum(lengths) - lengths


def _sums(values: np.ndarray) -> np.ndarray:
    """Sums of the values before each place, and of all; they wrap."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


class Lines:
    """The lines with words of some texts, as arrays.

    ``doc`` and ``no`` tell where a line is; ``node`` (64 bits) and ``bag`` (a further 64) are
    hashes of its words; ``value`` has the hashes of all words, of which a line has ``size`` from ``start`` on.
    """

    def __init__(self, texts: list[str | None]):
        parts = [fold(text).translate(_LINE) for text in texts]
        blob = b"\n".join([*parts, b"       "])
        data = np.frombuffer(blob, np.uint8)
        edges = _edges(parts)
        high, marked = np.flatnonzero(data >= _HIGH), False
        for k in np.unique(np.searchsorted(edges, high, "right") - 1).tolist():
            if _UNSPACED.search(own := parts[k].decode("utf-8", "surrogatepass")):
                parts[k], marked = _UNSPACED.sub("\x1f\\1\x1f", own).encode("utf-8", "surrogatepass"), True
        if marked:
            blob = b"\n".join([*parts, b"       "])
            data, edges = np.frombuffer(blob, np.uint8), _edges(parts)
        self.data = data
        ends = self.ends = np.flatnonzero(data == 10)  # of lines, whether or not they have words
        gap = data <= 32
        turns = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(data) and not gap[0]:
            turns = np.concatenate([[0], turns])
        begin, end = np.ascontiguousarray(turns[::2]), np.ascontiguousarray(turns[1::2])
        self.begin, self.end = begin, end
        upto = np.concatenate([[0], np.searchsorted(begin, ends), [len(begin)]])  # words before each line and after the last
        count = np.diff(upto)
        line = np.flatnonzero(count)
        first = self.start = upto[line]
        self.size = count[line]
        self.doc = np.searchsorted(edges, begin[first], "right") - 1
        before = np.searchsorted(ends, edges)  # lines before a text's first
        self.no = line - before[self.doc]
        self.value = _hash_runs(blob, begin, end)
        power, inverse = _power_tables(len(begin) + 1)
        self.total = _sums(mix(self.value ^ _STEP))  # of words in any order
        inorder = _sums(self.value * power[: len(begin)])
        last = first + self.size
        self.node = mix((inorder[last] - inorder[first]) * inverse[first] + self.size.astype(np.uint64))
        self.bag = self.total[last] - self.total[first]

    def __len__(self) -> int:
        return len(self.start)

    def profiles(self) -> np.ndarray:
        """Characters of each line by bucket, ``LETTERS`` bytes; one of which a bucket doesn't fit into a byte has 255 throughout.

        An edit adds one to one bucket at most and takes one from one at most. The blanks
        between words are in the first bucket, so that the sum is the length.
        """
        n = len(self)
        line = np.full(len(self.ends) + 1, n, np.int64)  # lines without words share a row that is dropped
        line[np.searchsorted(self.ends, self.begin[self.start])] = np.arange(n)
        kind = np.repeat(line * (LETTERS + 1), np.diff(np.concatenate([[0], self.ends + 1, [len(self.data)]])))
        kind += np.frombuffer(self.data.tobytes().translate(_LETTER), np.uint8)
        wide = np.flatnonzero(self.data >= 0xC0)
        kind[wide] += _WIDE_LETTER[self.data[wide], self.data[wide + 1]]
        count = np.bincount(kind, minlength=(n + 1) * (LETTERS + 1)).reshape(n + 1, LETTERS + 1)[:n, :LETTERS]
        blank = np.cumsum(np.concatenate([[0], self.data == 32])) if (self.data == 31).any() else None
        inner = np.ones(len(self.begin), bool)
        if blank is not None:  # gaps that the marks around a character made are none
            inner[1:] = blank[self.begin[1:]] > blank[self.end[:-1]]
        inner[self.start] = False
        count[:, 0] += np.add.reduceat(inner.astype(np.int64), self.start) if n else 0
        count[(count > 254).any(1)] = 255
        return count.astype(np.uint8)

    def simhash(self, rows: np.ndarray) -> np.ndarray:
        """SimHashes of ``BLOCKS * 32`` bits of the lines ``rows``, as blocks; a word counts once in a line."""
        size, words = self.size[rows], BLOCKS // 2
        at = np.repeat(self.start[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        tagged = np.repeat(np.arange(len(rows), dtype=np.uint64) << np.uint64(40), size) | self.value[at] >> np.uint64(24)
        tagged.sort()
        fresh = np.ones(len(tagged), bool)
        fresh[1:] = tagged[1:] != tagged[:-1]
        tagged = tagged[fresh]
        owner = (tagged >> np.uint64(40)).astype(np.int64)
        value = tagged & np.uint64((1 << 40) - 1)
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sizes = np.diff(np.append(starts, len(owner)))
        seeds = np.array([(w + 1) * int(_STEP) & (1 << 64) - 1 for w in range(words)], np.uint64)
        out = np.empty((len(rows), words), np.uint64)
        step = max(1, 8192 * len(rows) // max(1, len(value)))
        for k in range(0, len(rows), step):  # a slice at a time stays in the cache
            n, first = sizes[k : k + step], starts[k : k + step]
            a, b = first[0], first[-1] + n[-1]
            lanes = np.unpackbits(mix(value[a:b, None] + seeds).view(np.uint8), bitorder="little").view(np.uint64).reshape(b - a, 8 * words)
            if n.max() <= 255:
                ones = np.add.reduceat(lanes, first - a, axis=0).view(np.uint8)
            else:  # a byte holds 255 words
                turns = (n + 254) // 255
                head = np.cumsum(turns) - turns
                pieces = np.repeat(first - a, turns) + 255 * (np.arange(turns.sum()) - np.repeat(head, turns))
                ones = np.add.reduceat(np.add.reduceat(lanes, pieces, axis=0).view(np.uint8).astype(np.int32), head, axis=0)
            out[k : k + step] = np.packbits(ones > (n // 2)[:, None], axis=1, bitorder="little").view(np.uint64)
        return out.view(np.uint32)


#: The bucket of a character: frequent letters have their own; further bytes of a character have none (``LETTERS``).
_LETTER = bytearray(LETTERS if b & 0xC0 == 0x80 or b in (10, 31, 32) else 0 if b >= 0xC0 else b % LETTERS for b in range(256))
for _group, _letters in enumerate(("", "e", "tz", "ax", "iq", "nj", "owv", "sk", "rp", "lhb", "dyfg", "ucm")):
    for _letter in _letters:
        _LETTER[ord(_letter)] = _group
_LETTER = bytes(_LETTER)
_WIDE_LETTER = np.array([[(lead * 5 + follow) % LETTERS for follow in range(256)] for lead in range(256)], np.int64)


def _part_key(total: np.ndarray, number: int, words) -> np.ndarray:
    return mix(total + _STEP * (np.atleast_1d(words).astype(np.uint64) * np.uint64(64) + np.uint64(number)))


def line_keys(lines: Lines, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the lines ``rows``, and for each key the position in ``rows`` of its line.

    Words count whatever their order, but for parts, which are counted from the
    line's front or end. Parts of five have two lengths where two words more
    would make them longer, so that lines of unequal length have one in common.
    """
    found, owners = [], []
    size = lines.size[rows]

    def add(key, own, left):
        key = mix(key + np.uint64(int(_STEP) * (left + 1) & (1 << 64) - 1))
        if key.shape[1] > 1 and left < 1 << 20:  # equal words give equal keys
            key.sort(axis=1)
            new = np.ones(key.shape, bool)
            new[:, 1:] = key[:, 1:] != key[:, :-1]
            found.append(key[new]), owners.append(np.broadcast_to(own[:, None], key.shape)[new])
        else:
            found.append(key.ravel()), owners.append(np.repeat(own, key.shape[1]))

    for n in np.unique(size[size <= ONE_OUT + 1]).tolist():
        own = np.flatnonzero(size == n)
        at = lines.start[rows[own]]
        whole = (lines.total[at + n] - lines.total[at])[:, None]
        add(whole, own, n)
        if n <= TWO_OUT + 1:
            word = lines.total[at[:, None] + np.arange(1, n + 1)] - lines.total[at[:, None] + np.arange(n)]
            add(whole - word, own, n - 1)
            i, j = np.triu_indices(n, 1)
            add(whole - word[:, i] - word[:, j], own, n - 2)
        if n >= PAIRED:
            for words in sorted({n // 5, (n + 2) // 5}):
                places = [(k, k * words) for k in range(3)] + [(PARTS + k, n - (k + 1) * words) for k in range(2)]
                parts = [_part_key(lines.total[at + p + words] - lines.total[at + p], number, words) for number, p in places]
                add(np.stack([a * _STEP + b for k, a in enumerate(parts) for b in parts[:k]], 1), own, 1 << 21)
    long = np.flatnonzero(size >= ONE_OUT - 1)
    if len(long):
        at, n = lines.start[rows[long]], size[long]
        words = PART_WORDS[np.maximum(np.searchsorted(PART_WORDS, n // PARTS, "right") - 1, 0)]
        parts = np.minimum(PARTS, n // words)
        front = (parts + 1) // 2
        for k in range(PARTS):
            for number, own, begin in ((k, np.flatnonzero(k < front), k * words), (PARTS + k, np.flatnonzero(k < parts - front), n - (k + 1) * words)):
                if len(own):
                    p = at[own] + begin[own]
                    add(_part_key(lines.total[p + words[own]] - lines.total[p], number, words[own])[:, None], long[own], 1 << 20)
    for k, block in enumerate(lines.simhash(rows).T if len(rows) else []):
        add(block.astype(np.uint64)[:, None], np.arange(len(rows)), (1 << 23) + k)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or some number above ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    i, least = 0, min(len(a), len(b))
    while i < least and a[i] == b[i]:
        i += 1
    j = 0
    while j < least - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for k, c in enumerate(b):
        eq = at.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | ~(xh | plus) & full, plus & xh
        score += bool(ph & top) - bool(mh & top)
        if score - (len(b) - 1 - k) > most:
            return most + 1
        ph, mh = (ph << 1 | 1) & full, mh << 1 & full
        plus, minus = mh | ~(xv | ph) & full, ph & xv
    return score


#: Words of one line and of the other that a difference between them may take up, in the order tried.
_SHIFTS = sorted(((s, t) for s in range(5) for t in range(5) if s or t), key=lambda x: (max(x), abs(x[0] - x[1])))


def _at_most(a: str, b: str, most: int) -> bool:
    """Whether lining up the words greedily shows that the distance is ``most`` or less; False says nothing."""
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and sum(max(len(v), len(w)) for v, w in zip(x, y) if v != w) <= most:
        return True
    i = j = cost = 0
    apart = []
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        for s, t in _SHIFTS:
            if x[i + s : i + s + 2] == y[j + t : j + t + 2]:
                break
        else:
            return False
        own = max(sum(map(len, x[i : i + s])) + s, sum(map(len, y[j : j + t])) + t)
        cost += own
        if cost > 2 * most:
            return False
        if s and t:
            apart.append((own, i, i + s, j, j + t))
        i, j = i + s, j + t
    cost += sum(map(len, x[i:])) + len(x[i:]) + sum(map(len, y[j:])) + len(y[j:])
    if cost > 2 * most:
        return False
    for own, i, k, j, m in apart:  # what takes the other's place may be alike in part
        if cost <= most:
            break
        cost += edit_distance(" ".join(x[i:k]), " ".join(y[j:m]), own) - own
    return cost <= most


#: Words of 64 bits of a band up to which many pairs are worked on at once, pairs at once, and pairs from which that pays.
BAND_WORDS, LANES, FEW = 16, 512, 64
#: Different characters of a batch up to which their places are kept as bits.
SYMBOLS = 128
#: Buckets of pairs of neighbouring characters.
BIGRAMS = 512


def _band(pairs: list[tuple[str, str]], most: np.ndarray, words: int) -> np.ndarray:
    """Whether each pair's distance is at most ``most``, which is below 32 times ``words``.

    Hyyrö's bit-parallel algorithm in a band around the diagonal, for all pairs
    at once. The first of a pair is the longer one, and longer than the band reaches.
    """
    reach, width, lanes = 32 * words - 1, 64 * words, len(pairs)
    size_a, size_b = (np.array([len(p[k]) for p in pairs], np.int64) for k in (0, 1))
    flat = [np.frombuffer("".join(p[k] for p in pairs).encode("utf-32-le", "surrogatepass"), np.uint32) for k in (0, 1)]
    known, coded = np.unique(np.concatenate(flat), return_inverse=True)
    coded = (coded + 1).astype(np.uint8 if len(known) < 255 else np.uint32)
    steps = int(size_b.max())
    # the top of the window is ``reach`` rows below the diagonal
    a = np.zeros((lanes, max(int(size_a.max()), steps + reach) + width), coded.dtype)
    b = np.zeros((lanes, steps), coded.dtype)
    row = np.repeat(np.arange(lanes), size_a)
    before = width - reach - 1
    a[row, before + np.arange(len(flat[0])) - np.repeat(np.cumsum(size_a) - size_a, size_a)] = coded[: len(flat[0])]
    row = np.repeat(np.arange(lanes), size_b)
    b[row, np.arange(len(flat[1])) - np.repeat(np.cumsum(size_b) - size_b, size_b)] = coded[len(flat[0]) :]
    b = np.ascontiguousarray(b.T)
    if tabled := len(known) <= SYMBOLS:  # the places of each symbol as bits, so that a window is a shift
        across = (a.shape[1] + 63) // 64 + words + 2
        table = np.zeros((len(known) + 1, lanes, 8 * across), np.uint8)
        for k in range(1, len(known) + 1):
            bits = np.packbits(a == k, axis=1, bitorder="little")
            table[k, :, : bits.shape[1]] = bits
        table, a = table.view(np.uint64).ravel(), np.zeros((lanes, 0), np.uint8)
        b = (b.astype(np.int64) * lanes + np.arange(lanes)) * across
        reach_of = np.arange(words + 1)
    else:
        b[b == 0] = len(known) + 2
    plus = np.zeros((lanes, words), np.uint64)
    full = ~np.uint64(0)
    start = [(((1 << reach + 1) - 1) << (width - reach - 1)) >> 64 * w & (1 << 64) - 1 for w in range(words)]
    plus[:] = np.array(start, np.uint64)
    minus = np.zeros_like(plus)
    score = np.full(lanes, reach, np.int64)
    one, top = np.uint64(1), np.uint64(63)
    alive, lowest, ends = np.arange(lanes), int(size_a.min()) - reach, set(size_b.tolist())
    out = np.full(lanes, 1 << 40, np.int64)
    for j in range(steps):
        if tabled:
            found = table[(b[j] + (j >> 6))[:, None] + reach_of]
            match = found[:, :-1] if not j & 63 else found[:, :-1] >> np.uint64(j & 63) | found[:, 1:] << np.uint64(64 - (j & 63))
        else:
            match = np.packbits(a[:, j : j + width] == b[j][:, None], axis=1, bitorder="little").view(np.uint64)
        x = match & plus
        total = x + plus
        if words > 1:
            carry = total < x
            for w in range(1, words):
                came = carry[:, w - 1]
                total[:, w] += came
                carry[:, w] |= came & (total[:, w] == 0)
        diagonal = (total ^ plus) | match | minus
        more = minus | ~(diagonal | plus)
        less = diagonal & plus
        down = diagonal >> one
        if words > 1:
            down[:, :-1] |= diagonal[:, 1:] << top
        plus = less | ~(down | more)
        minus = down & more
        # along the lower edge of the band until the last row, and then along that
        score += 1 - (diagonal[:, -1] >> top).astype(np.int64)
        if j >= lowest:
            low = np.flatnonzero((size_a - reach - j <= 0) & (j < size_b))  # a pair that is done may wait for others far beyond its window
            bit = size_a[low] - reach - j + width - 2
            at, shift = bit >> 6, (bit & 63).astype(np.uint64)
            side = (more[low, at] >> shift & one).astype(np.int64) - (less[low, at] >> shift & one).astype(np.int64)
            score[low] += side - 1 + (diagonal[low, -1] >> top).astype(np.int64)
        ended = j + 1 in ends
        if ended:
            done = size_b == j + 1
            out[alive[done]] = score[done]
        if ended or (j & 63) == 63:
            # a score may still fall by one a step along the last row
            left = (size_b - j - 1 > 0) & (score <= most + np.maximum(0, size_b - np.maximum(j + 1, size_a - reach)))
            if (j & 63) == 63:  # every way goes through this column, whose lowest row is one above the window's: its least value must be in reach
                steps_up = np.unpackbits(plus.view(np.uint8), axis=1, bitorder="little").view(np.int8) - np.unpackbits(minus.view(np.uint8), axis=1, bitorder="little").view(np.int8)
                least = score - np.cumsum(steps_up[:, -2::-1], axis=1, dtype=np.int16).max(1).clip(0)
                left &= (least <= most) | (size_a - reach - j <= 1)
            if left.mean() < 0.8:
                a, plus, minus, score, alive, size_a, size_b, most = (v[left] for v in (a, plus, minus, score, alive, size_a, size_b, most))
                b = np.ascontiguousarray(b[:, left])
                if not len(score):
                    break
    return out


def distances_within(pairs: list[tuple[str, str]], most: list[int]) -> list[bool]:
    """Whether the edit distance of each pair is at most the number given for it."""
    out = [False] * len(pairs)
    banded: dict[int, list] = {}
    for k, ((a, b), m) in enumerate(zip(pairs, most)):
        if abs(len(a) - len(b)) > m:
            continue
        if len(a) < len(b):
            a, b = b, a
        words = m // 32 + 1
        if words > BAND_WORDS or len(a) < 32 * words or not b:
            out[k] = edit_distance(a, b, m) <= m
        else:
            banded.setdefault(words, []).append((len(b), k, a, b))
    for words, own in banded.items():
        own.sort()
        for at in range(0, len(own), LANES):
            some = own[at : at + LANES]
            if len(some) < FEW:  # a step of the band takes as long for one pair as for many
                for _, k, a, b in some:
                    out[k] = edit_distance(a, b, most[k]) <= most[k]
                continue
            limit = np.array([most[k] for _, k, _, _ in some], np.int64)
            found = _band([(a, b) for _, _, a, b in some], limit, words)
            for (_, k, _, _), fits in zip(some, (found <= limit).tolist()):
                out[k] = fits
    return out


def similar(a: str, b: str, similarity: float) -> bool:
    return bool(connecting([(0, 1)], (a, b), Union(), similarity))


def _close(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether profiles (rows of two tables) allow edit similarity."""
    a, b = a.astype(np.int16), b.astype(np.int16)
    gap = a - b
    more, less = np.maximum(gap, 0).sum(1), np.maximum(-gap, 0).sum(1)
    longest = np.maximum(a.sum(1), b.sum(1))
    return (np.maximum(more, less) <= np.floor(longest * (1 - similarity) + 1e-9)) | (a[:, 0] == 255) | (b[:, 0] == 255)


class Union:
    """Disjoint sets of any keys."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        if x not in parent:
            parent[x] = x
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, x, y) -> bool:
        """Whether this connects something new."""
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.parent[y] = x
        return True


def _entries(docs: DataFrame, ranges: int) -> DataFrame:
    """Entries (key, kind, profile) of all lines, packed by range of keys; of a task's equal lines one has them."""
    names = ["bucket", "data"]

    def pack(keys, owners, nodes, own):
        squeeze = zstandard.ZstdCompressor(level=1)
        key, owner, node = np.concatenate(keys), np.concatenate(owners), np.concatenate(nodes)
        profile = np.ascontiguousarray(np.concatenate(own).T)
        bucket = ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket.astype(np.uint16) if ranges <= 1 << 16 else bucket, kind="stable")
        key, owner, bucket = key[order], owner[order], bucket[order]
        # six bytes of a key keep apart what meets; of the upper two the bucket knows most
        low, high, node = key.astype(np.uint32), (key >> np.uint64(32)).astype(np.uint16), node[owner]
        heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        blobs = []
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(key)]):
            blobs.append(squeeze.compress(low[a:b].tobytes() + high[a:b].tobytes() + node[a:b].tobytes() + np.take(profile, owner[a:b], axis=1).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(bucket[heads], pa.int64()), pa.array(blobs, pa.binary())], names)

    def run(batches):
        keys, owners, nodes, own, held, kinds = [], [], [], [], 0, 0
        seen: set = set()
        for batch in batches:
            for part in cut(batch, 0, SLICE):
                lines = Lines(part.column(0).to_pylist())
                rows = np.flatnonzero(lines.size >= MIN_WORDS)
                rows = rows[np.unique(lines.node[rows], return_index=True)[1]]
                fresh = np.array([k not in seen for k in lines.node[rows].tolist()], bool)
                rows = rows[fresh]
                if not len(rows):
                    continue
                seen.update(lines.node[rows].tolist())
                key, line = line_keys(lines, rows)
                keys.append(key), owners.append((line + kinds).astype(np.int32)), nodes.append(lines.node[rows]), own.append(lines.profiles()[rows])
                held, kinds = held + len(key), kinds + len(rows)
                if held >= PACK:
                    yield pack(keys, owners, nodes, own)
                    keys, owners, nodes, own, held, kinds = [], [], [], [], 0, 0
                    seen.clear()
        if held:
            yield pack(keys, owners, nodes, own)
        del keys, owners, nodes, own
        release()

    return docs.select("text").mapInArrow(run, "bucket long, data binary")


def _meetings(entries: DataFrame, similarity: float) -> DataFrame:
    """``(crowd, a, b)``: close pairs of kinds that share a key, with no crowd; and in ``a`` the kinds of large crowds."""

    def meet(table: pa.Table) -> pa.Table:
        unzip = zstandard.ZstdDecompressor()
        keys, nodes, profiles = [], [], []
        for blob in table.column("data"):
            raw = unzip.decompress(blob.as_py())
            n = len(raw) // (14 + LETTERS)
            key = np.frombuffer(raw, np.uint32, n) | np.frombuffer(raw, np.uint16, n, 4 * n).astype(np.uint64) << np.uint64(32)
            keys.append(key), nodes.append(np.frombuffer(raw, np.int64, n, 6 * n))
            profiles.append(np.frombuffer(raw, np.uint8, LETTERS * n, 14 * n).reshape(LETTERS, n).T)
        key = np.concatenate(keys)
        order = np.argsort(key)
        key = key[order]
        met = np.zeros(len(key), bool)
        met[1:] = key[1:] == key[:-1]
        met[:-1] |= met[1:].copy()
        order, key = order[met], key[met]
        node, own = np.concatenate(nodes)[order], np.concatenate(profiles)[order]
        turn = np.lexsort((node, key))  # the same kind may come from several tasks
        key, node, own = key[turn], node[turn], own[turn]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node, own = key[fresh], node[fresh], own[fresh]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(heads, len(key)))
        src, dst, crowds, members = [], [], [], []

        def crowd(first, n):
            who = node[first : first + n]
            crowds.append(np.full(n, xxhash.xxh3_64_intdigest(who.tobytes()) - (1 << 63))), members.append(who)

        for n in np.unique(size[size > 1]).tolist():  # all buckets of one size at once
            first = heads[size == n]
            if n > PROBED:
                for x in first.tolist():
                    crowd(x, n)
                continue
            i, j = np.triu_indices(n, 1)
            step = max(1, 400_000 // len(i))
            for at in range(0, len(first), step):
                some = first[at : at + step]
                a, b = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
                near = np.concatenate([_close(own[a[k : k + 500_000]], own[b[k : k + 500_000]], similarity) for k in range(0, len(a), 500_000)])
                if n > WIDE:  # one bucket or a few
                    dense = near.reshape(len(some), -1).sum(1) > SPARSE * n
                    for x in some[dense].tolist():
                        crowd(x, n)
                    near &= ~np.repeat(dense, len(i))
                src.append(node[a[near]]), dst.append(node[b[near]])
        pairs = np.stack([np.concatenate(src), np.concatenate(dst)], 1) if src else np.zeros((0, 2), np.int64)
        if len(pairs):
            pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
            pairs = pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(1)])]
        crowds, members = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (crowds, members))
        none = np.zeros(len(members), bool)
        return pa.table([
            pa.array(np.concatenate([np.zeros(len(pairs), np.int64), crowds]), mask=np.concatenate([np.ones(len(pairs), bool), none])),
            pa.array(np.concatenate([pairs[:, 0], members])), pa.array(np.concatenate([pairs[:, 1], members])),
        ], ["crowd", "a", "b"])

    return entries.groupBy("bucket").applyInArrow(freeing(meet), "crowd long, a long, b long").distinct()


def _lost_pairs(lines: list[str], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For each pair of lines, the pairs of neighbouring characters that one has more often; an edit changes two at most."""
    table = np.empty((len(lines), BIGRAMS), np.int16)
    for at in range(0, len(lines), 2048):
        some = lines[at : at + 2048]
        codes = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array(list(map(len, some)), np.int64)
        owner = np.repeat(np.arange(len(some)), size)
        both = (codes[:-1] * np.uint32(0x9E3779B1) + codes[1:]) * np.uint32(0x85EBCA77) >> np.uint32(12) & np.uint32(BIGRAMS - 1)
        inside = owner[1:] == owner[:-1]
        count = np.bincount((owner[:-1] * BIGRAMS + both)[inside], minlength=len(some) * BIGRAMS)
        table[at : at + 2048] = np.minimum(count, 32767).reshape(len(some), BIGRAMS)
    out = np.empty(len(first), np.int64)
    for at in range(0, len(first), 4096):
        gap = table[first[at : at + 4096]] - table[second[at : at + 4096]]
        out[at : at + 4096] = np.maximum(np.maximum(gap, 0).sum(1, dtype=np.int64), np.maximum(-gap, 0).sum(1, dtype=np.int64))
    return out


def connecting(pairs: list[tuple], line_of, known: Union, similarity: float) -> list[int]:
    """Numbers of pairs of kinds that are similar and connect what no other pair has connected; the most alike go first."""
    if not pairs:
        return []
    kinds = list(dict.fromkeys(x for pair in pairs for x in pair))
    number = {x: k for k, x in enumerate(kinds)}
    lines = [line_of[x] for x in kinds]
    first, second = (np.array([number[pair[k]] for pair in pairs], np.int64) for k in (0, 1))
    size = np.array(list(map(len, lines)), np.int64)
    most = (np.maximum(size[first], size[second]) * (1 - similarity) + 1e-9).astype(np.int64)
    lost = _lost_pairs(lines, first, second)
    may = np.flatnonzero((np.abs(size[first] - size[second]) <= most) & (lost <= 2 * most))
    order = may[np.argsort(lost[may] / np.maximum(1, most[may]), kind="stable")]
    found, open_ = [], []
    for k in order.tolist():
        x, y = pairs[k]
        if known.root(x) == known.root(y):
            continue
        if _at_most(line_of[x], line_of[y], int(most[k])):
            known.join(x, y)
            found.append(k)
        else:
            open_.append(k)
    at, many = 0, LANES
    while at < len(open_):
        some = []
        while at < len(open_) and len(some) < many:
            x, y = pairs[open_[at]]
            if known.root(x) != known.root(y):
                some.append(open_[at])
            at += 1
        for k, fits in zip(some, distances_within([(line_of[pairs[k][0]], line_of[pairs[k][1]]) for k in some], [int(most[k]) for k in some])):
            if fits and known.join(*pairs[k]):
                found.append(k)
        many = min(8 * LANES, 2 * many)
    return found


def _verify_pairs(pairs: DataFrame, similarity: float) -> DataFrame:
    """Edges among ``(a, b, line_a, line_b)``; what a batch has connected isn't compared again."""

    def work(batch):
        known = Union()
        for part in cut(batch, 2, SLICE):
            a, b, x, y = (c.to_pylist() for c in part.columns)
            keep = pa.array(connecting(list(zip(a, b)), dict(zip(a, x)) | dict(zip(b, y)), known, similarity), pa.int64())
            yield [part.column(0).take(keep), part.column(1).take(keep)]

    return map_arrow(pairs, work, StructType([StructField("src", LongType()), StructField("dst", LongType())]))


def _verify_groups(pairs: DataFrame, lines: DataFrame, similarity: float, calls: int) -> DataFrame:
    """Edges among pairs ``(component, a, b)`` of lines ``(component, node, line)``, groups taken as a whole; many share a call."""

    def work(pairs: pa.Table, lines: pa.Table) -> pa.Table:
        line_of = dict(zip(lines.column("node").to_pylist(), lines.column("line").to_pylist()))
        both = pairs.select(["a", "b"]).sort_by([("a", "ascending"), ("b", "ascending")])
        keep = pa.array(connecting(list(zip(both.column("a").to_pylist(), both.column("b").to_pylist())), line_of, Union(), similarity), pa.int64())
        return both.take(keep).rename_columns(["src", "dst"])

    def by_turn(df):  # a fixed number of partitions, as a few MB keep a task busy for long
        turn = F.pmod(F.xxhash64("component"), F.lit(calls)).alias("turn")
        return df.toDF(*df.columns).select("*", turn).repartition(calls, "turn").groupBy("turn")

    return by_turn(pairs).cogroup(by_turn(lines)).applyInArrow(work, "src long, dst long")


def _letters(lines: list[str]) -> np.ndarray:
    """Characters of each line by 64 buckets, and in a last column its length."""
    out = np.zeros((len(lines), 65), np.int32)
    for i, line in enumerate(lines):
        out[i, :64] = np.bincount(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32) % 64, minlength=64)
        out[i, 64] = len(line)
    return out


def _near(letters: np.ndarray, i: int, others: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs of line ``i`` with those of ``others`` that lengths and letters allow to be similar."""
    size = letters[others, 64]
    bound = np.floor(np.maximum(size, letters[i, 64]) * (1 - similarity) + 1e-9)
    fits = np.abs(size - letters[i, 64]) <= bound
    others, bound = others[fits], bound[fits]
    gap = letters[others, :64] - letters[i, :64]
    return [(i, j) for j in others[np.maximum(np.maximum(gap, 0).sum(1), np.maximum(-gap, 0).sum(1)) <= bound].tolist()]


def connect(lines: list[str], similarity: float) -> list[tuple[int, int]]:
    """Pairs of similar lines that connect all that are.

    The lines of a crowd mostly hang together. So all are held against one in the
    middle first, then what is apart against some of the largest set, and at last
    against all lines of other sets; lines of one set need no look at each other.
    """
    if not lines:
        return []
    letters, known, found = _letters(lines), Union(), []

    def sets():
        own = np.array([known.root(i) for i in range(len(lines))])
        roots, count = np.unique(own, return_counts=True)
        return own, own == roots[count.argmax()]

    def look(pairs):
        found.extend(pairs[k] for k in connecting(pairs, lines, known, similarity))

    everything = np.arange(len(lines))
    middle = int(np.abs(letters - np.median(letters, 0)).sum(1).argmin())
    look(_near(letters, middle, everything[everything != middle], similarity))
    _, main = sets()
    inside, apart = np.flatnonzero(main), np.flatnonzero(~main)
    some = inside[np.unique(np.linspace(0, len(inside) - 1, ANCHORS).astype(np.int64))]
    look([pair for i in some.tolist() for pair in _near(letters, i, apart, similarity)])
    own, main = sets()
    look([pair for i in np.flatnonzero(~main).tolist() for pair in _near(letters, i, everything[(own != own[i]) & (main | (everything > i))], similarity)])
    return found


def _connect_tiles(table: pa.Table, similarity: float) -> pa.Table:
    """Edges between the lines of side 0, all outside of their family's largest set, and those of side 1, of other sets."""
    table = table.sort_by([("side", "ascending"), ("node", "ascending")])
    node, root, tile, rest, side = (np.array(table.column(c)) for c in ("node", "root", "tile", "rest", "side"))
    lines, split = table.column("line").to_pylist(), int(np.searchsorted(side, 1))
    letters, known, first = _letters(lines), Union(), {}
    for i, x in enumerate(root.tolist()):
        known.join(first.setdefault(x, i), i)
    others, pairs = np.arange(split, len(lines)), []
    for i in range(split):
        # those of a tile have met; of two outside of the largest set one alone looks at the other
        fresh = (root[split:] != root[i]) & (tile[split:] != tile[i]) & ~(rest[split:] & (node[split:] < node[i]))
        pairs += _near(letters, i, others[fresh], similarity)
    pairs = np.array([pairs[k] for k in connecting(pairs, lines, known, similarity)], np.int64).reshape(-1, 2)
    return pa.table([pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], ["src", "dst"])


def _verify_crowds(crowds: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """Edges within the crowds ``(crowd, node)``, given ``(node, line)``. Crowds that share kinds are one family.

    Tiles of a family are connected by themselves, with some lines that all tiles
    have. Then only kinds outside of the family's largest set are left to look at,
    against all of other sets; a kind is in one family, however many crowds it is in.
    """
    families = connected_components(crowds, "crowd", "node").withColumnRenamed("component", "family")
    order = Window.partitionBy("family").orderBy(F.xxhash64("node"), "node")
    placed = materialize(
        families.join(lines.dropDuplicates(["node"]), "node")
        .withColumn("spot", F.row_number().over(order) - 1)
        .withColumn("tile", F.floor(F.col("spot") / F.lit(TILE)).cast("int")),
        "crowds",
    )
    wide = placed.groupBy("family").agg(F.max("tile").alias("last")).where("last > 0")
    shared = placed.where(F.col("spot") < ANCHORS).drop("tile").join(wide, "family").withColumn("tile", F.explode(F.sequence(F.lit(0), "last"))).where(F.floor(F.col("spot") / F.lit(TILE)) != F.col("tile"))

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        pairs = np.array(connect(table.column("line").to_pylist(), similarity), np.int64).reshape(-1, 2)
        node = np.array(table.column("node"))
        return pa.table([pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], ["src", "dst"])

    names, edge = ["family", "tile", "node", "line"], "src long, dst long"
    within = materialize(placed.select(names).unionByName(shared.select(names)).groupBy("family", "tile").applyInArrow(freeing(work), edge), "within")
    if wide.isEmpty():
        return within
    roots = connected_components(within)
    sets = placed.join(wide, "family").join(roots, "node", "left").select(*names, F.coalesce("component", "node").alias("root"), F.length("line").alias("chars"))
    largest = sets.groupBy("family", "root").count().groupBy("family").agg(F.max(F.struct("count", "root")).alias("most"))
    sets = sets.join(largest, "family").withColumn("rest", F.col("root") != F.col("most.root")).drop("most")
    by_length = [F.floor((F.row_number().over(Window.partitionBy(*own).orderBy("chars", "node")) - 1) / F.lit(TILE)).alias(name) for own, name in ((["family"], "b"), (["family", "rest"], "a"))]
    sets = materialize(sets.select("*", *by_length), "sets")
    span = [F.min("chars").alias("low"), F.max("chars").alias("high")]
    a, b = sets.where("rest").groupBy("family", "a").agg(*span).alias("x"), sets.groupBy("family", "b").agg(*span).alias("y")
    reach = lambda x, y: F.col(f"{x}.high") >= F.col(f"{y}.low") * F.lit(similarity) - F.lit(1e-9)
    tasks = a.join(b, (F.col("x.family") == F.col("y.family")) & reach("x", "y") & reach("y", "x")).select("x.family", "a", "b")
    own = ["family", "ta", "tb", "side", "node", "line", "root", "tile", "rest"]
    tasks = tasks.toDF("family", "ta", "tb")
    left = tasks.join(sets.where("rest").withColumn("ta", F.col("a")), ["family", "ta"]).withColumn("side", F.lit(0)).select(own)
    right = tasks.join(sets.withColumn("tb", F.col("b")), ["family", "tb"]).withColumn("side", F.lit(1)).select(own)
    across = left.unionByName(right).groupBy("family", "ta", "tb").applyInArrow(freeing(lambda table: _connect_tiles(table, similarity)), edge)
    return within.unionByName(across)


def _listed(column: pa.Array) -> tuple[list[list], np.ndarray]:
    """The fields of a column of lists of structs, over all rows, and where each row's begin and end."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return [x.to_pylist() for x in column.flatten().flatten()], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text of each document less the lines that stand elsewhere before.

    Besides the columns of ``docs`` nothing is returned; see ``removed_lines`` for the decisions.
    """
    removed = removed_lines(docs, similarity, id_col, text_col)
    gone = removed.groupBy(F.col("id").alias("__id")).agg(F.collect_list(F.struct("dkey", "no")).alias("__gone"))
    others = [f for f in docs.schema.fields if f.name != text_col]
    place = docs.columns.index(text_col)
    unpacked = [StructField(f"c{i}", f.dataType) for i, f in enumerate(others)] + [StructField("text", docs.schema[text_col].dataType)]

    def rebuild(batch):
        for part in cut(batch, len(others), SLICE):
            texts, (dkeys, numbers), edges = part.column(len(others)), *_listed(part.column(len(others) + 1))
            touched = np.diff(edges) > 0
            rows, new = np.flatnonzero(touched), []
            for text, a, b in zip(texts.take(pa.array(rows)).cast(pa.binary()).to_pylist(), edges[rows].tolist(), edges[rows + 1].tolist()):
                if text:
                    key = document_key(text)
                    drop = {no for no, dkey in zip(numbers[a:b], dkeys[a:b]) if dkey == key}
                    if drop:
                        text = b"\n".join([x for no, x in enumerate(text.split(b"\n")) if no not in drop])
                new.append(text)
            yield [*part.columns[: len(others)], pc.replace_with_mask(texts, pa.array(touched), pa.array(new, pa.binary()).cast(texts.type)) if new else texts]

    flat = docs.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(others)], F.col(f"`{text_col}`").alias("text"))
    at = [f.name for f in others].index(id_col)
    # a hash table of line numbers, so that the texts needn't be sorted
    joined = flat.join(gone.hint("shuffle_hash"), flat[f"c{at}"] == gone["__id"], "left").select(*flat.columns, "__gone")
    done = map_arrow(joined, rebuild, StructType(unpacked))
    names = [f.name for f in others]
    names.insert(place, text_col)
    order = [f"c{i}" for i in range(len(others))]
    order.insert(place, "text")
    return done.select(*[F.col(c).alias(n) for c, n in zip(order, names)])


def _occurrences(docs: DataFrame) -> DataFrame:
    """(id, dkey, no, node, bag) of all lines with words."""

    def work(batch):
        for part in cut(batch, 1, SLICE):
            texts = part.column(1).to_pylist()
            lines = Lines(texts)
            dkeys = np.array([document_key(t) for t in texts], np.int64)
            yield [part.column(0).take(pa.array(lines.doc)), pa.array(dkeys[lines.doc]), pa.array(lines.no, pa.int32()), pa.array(lines.node.view(np.int64)), pa.array(lines.bag.view(np.int64))]

    return map_arrow(docs, work, StructType([docs.schema["id"], StructField("dkey", LongType()), StructField("no", IntegerType()), StructField("node", LongType()), StructField("bag", LongType())]))


def _kinds(found: DataFrame) -> DataFrame:
    """``(node, bag, place, n)``: the kinds of lines, each with its first place and the number of its places."""
    kind = found.schema["id"].dataType
    if not isinstance(kind, IntegralType) and kind != StringType():  # Spark alone knows the order of all types
        return found.groupBy("node", "bag").agg(F.min(F.struct("id", "dkey", "no")).alias("place"), F.count("*").alias("n"))
    place = ["id", "dkey", "no"]

    def folded(tables: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(tables).combine_chunks()
        node, bag, n = (table.column(c).to_numpy() for c in ("node", "bag", "n"))
        order = np.lexsort((bag, node))
        node, bag = node[order], bag[order]
        new = np.ones(len(order), bool)
        new[1:] = (node[1:] != node[:-1]) | (bag[1:] != bag[:-1])
        heads = np.flatnonzero(new)
        first, size = order[heads], np.diff(np.append(heads, len(order)))
        many = np.repeat(size > 1, size)
        if many.any():
            some = table.select(place).take(pa.array(order[many]))
            some = some.append_column("kind", pa.array((np.cumsum(new) - 1)[many])).append_column("row", pa.array(order[many]))
            some = some.sort_by([(c, "ascending") for c in ("kind", *place)])
            own = some.column("kind").to_numpy()
            first[size > 1] = some.column("row").to_numpy()[np.concatenate([[True], own[1:] != own[:-1]])]
        return table.take(pa.array(first)).set_column(table.num_columns - 1, "n", pa.array(np.add.reduceat(n[order], heads)))

    def run(batches):
        held, rows, most = [], 0, FOLD
        for batch in batches:
            if batch.num_rows:
                held.append(pa.Table.from_batches([batch]).append_column("n", pa.array(np.ones(batch.num_rows, np.int64))))
                rows += batch.num_rows
            if rows > most:
                held = [folded(held)]
                rows = held[0].num_rows
                most = max(FOLD, 2 * rows)
        for batch in folded(held).to_batches(max_chunksize=100_000) if held else ():
            first = pa.StructArray.from_arrays([batch.column(c) for c in place], place)
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("bag"), first, batch.column("n")], ["node", "bag", "place", "n"])
        del held
        release()

    first = StructType([found.schema[c] for c in place])
    return found.repartition("node", "bag").mapInArrow(run, StructType([found.schema["node"], found.schema["bag"], StructField("place", first), StructField("n", LongType())]))


def _texts_of(base: DataFrame, members: DataFrame) -> DataFrame:
    """``(node, line)``: the normalised lines of ``members`` ``(node, place)``, picked out of their documents."""
    wanted = members.groupBy(F.col("place.id").alias("id")).agg(F.collect_list(F.struct("node", F.col("place.dkey").alias("dkey"), F.col("place.no").alias("no"))).alias("wanted"))

    def pick(batch):
        for part in cut(batch, 0, SLICE):
            nodes, lines = [], []
            (kinds, dkeys, numbers), edges = _listed(part.column(1))
            for text, a, b in zip(part.column(0).cast(pa.binary()).to_pylist(), edges.tolist(), edges[1:].tolist()):
                key, own = document_key(text), None
                for node, dkey, no in zip(kinds[a:b], dkeys[a:b], numbers[a:b]):
                    if dkey == key:
                        own = own or text.split(b"\n")
                        nodes.append(node)
                        lines.append(normalise(own[no].decode("utf-8", "surrogatepass")))
            yield [pa.array(nodes, pa.int64()), pa.array(lines, pa.string())]

    texts = base.join(wanted.hint("shuffle_hash"), "id").select("text", "wanted")
    # repeated rows give their lines repeatedly, which does no harm
    return map_arrow(texts, pick, StructType([StructField("node", LongType()), StructField("line", base.schema["text"].dataType)]))


def similar_kinds(base: DataFrame, kinds: DataFrame, similarity: float) -> DataFrame:
    """``(node, root)`` of the kinds that others are connected with."""
    ranges = max(1, math.ceil(kinds.count() * KEYS / RANGE))
    met = materialize(_meetings(_entries(base, ranges), similarity), "met")
    pairs, crowds = met.where("crowd is null").select("a", "b"), met.where("crowd is not null").select("crowd", F.col("a").alias("node"))
    nodes = met.select(F.explode(F.array_distinct(F.array("a", F.coalesce("b", "a")))).alias("node")).distinct()
    lines = materialize(_texts_of(base, kinds.join(nodes, "node").select("node", "place")), "lines")
    # pairs go where their group is; the pairs of groups that are too large for a task go by themselves
    groups = materialize(connected_components(pairs, "a", "b"), "groups")
    count = pairs.count()
    parts = pairs.join(groups.select(F.col("node").alias("a"), "component"), "a")
    large = materialize(parts.groupBy("component").count().where(F.col("count") > GROUP).select("component"), "large")
    some_large = not large.isEmpty()
    small, own = parts, lines.join(groups, "node")
    if some_large:
        small, own = small.join(large, "component", "left_anti"), own.join(large, "component", "left_anti")
    edges = _verify_groups(small.select("component", "a", "b"), own.select("component", "node", "line"), similarity, math.ceil(count / CALL) or 1)
    if some_large:
        first = parts.join(large, "component", "left_semi").join(lines.select(F.col("node").alias("a"), F.col("line").alias("line_a")), "a")
        edges = edges.unionByName(_verify_pairs(first.join(lines.select(F.col("node").alias("b"), F.col("line").alias("line_b")), "b").select("a", "b", "line_a", "line_b"), similarity))
    if not crowds.isEmpty():
        edges = edges.unionByName(_verify_crowds(crowds, lines, similarity))
    roots = materialize(connected_components(edges).withColumnRenamed("component", "root"), "roots")
    for frame in (met, lines, groups, large):
        discard(frame)
    return roots


def removed_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, dkey, no)``: the lines that go, by document id, hash of its text, and line number from 0.

    Where rows repeat, so do these.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("id is not null and text is not null")
    found = materialize(_occurrences(base), "found")
    place = F.struct("id", "dkey", "no")
    kinds = materialize(_kinds(found), "kinds")
    roots = similar_kinds(base, kinds, similarity)
    # of a kind that nothing is similar to, the whole hash is the group's; else the root is
    grouped = kinds.join(roots, "node", "left").select("node", "bag", "place", "n", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNull(), F.col("bag")).otherwise(F.lit(0)).alias("apart"))
    single = grouped.where("n > 1 and apart <> 0").select("node", "bag", F.col("place").alias("keep"))
    joint = grouped.where("apart = 0")
    keep = joint.groupBy("root").agg(F.min("place").alias("keep"))
    verdicts = single.unionByName(joint.join(keep, "root").select("node", "bag", "keep"))
    gone = found.join(verdicts, ["node", "bag"]).where(~(place == F.col("keep"))).select("id", "dkey", "no")
    out = materialize(gone, "gone")
    discard(found), discard(kinds), discard(roots)
    return out
