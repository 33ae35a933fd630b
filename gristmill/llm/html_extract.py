"""Operator 10: HTML extraction by minimum-cut labelling.

A page is cut into text blocks. A logistic classifier gives each block a cost of
being content and one of being boilerplate; these are the capacities of its
edges from the source and to the sink. Blocks that follow each other, and blocks
that are near in the DOM, are joined by smoothness edges, the stronger the fewer
levels of the tree lie between them. The minimum cut between source and sink is
the labelling with the least total cost; the content side, in order, is the text.

The classifier sees words, links, punctuation, tags and class names of blocks. It
is trained on at most ``TRAIN_PAGES`` pages, those with the lowest hash of their
id, with what the pages themselves say as labels: blocks in ``article`` or
``main`` against those in ``nav``, ``header``, ``footer``, ``aside`` or ``form``.
These five and two names aren't features, so pages without them can be read too.

Defined results: a null html gives null text and null counts; empty html, or
html without text, gives an empty text and no blocks; broken html is read as far
as it goes, and in time that grows with its length; repeated rows are extracted each; null ids are carried along, but not
learned from; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from gristmill.llm.arrow import cut, map_arrow
from gristmill.llm.sample import key_hash, lowest_hashes

#: Pages that the classifier is trained on, at most.
TRAIN_PAGES = 1000
#: Greatest strength of a smoothness edge; greatest terminal capacity.
SMOOTH, STEEPEST = 0.8, 6.0
RIDGE = 1.0

_START = re.compile(r"<(?:(/?)([a-zA-Z][a-zA-Z0-9:-]*)|[!?])")
_RAW = frozenset("script style noscript template textarea svg iframe title".split())
_RAW_ENDS = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in _RAW}
_ATTRIBUTES = re.compile(r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>""")
_QUOTES = re.compile(r"""[>"']""")
_CLASS = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
_INLINE = frozenset("a b i u s em strong span small big code sub sup mark abbr cite q font label tt kbd var time del ins bdi bdo".split())
_CONTENT, _BOILER = frozenset(("article", "main")), frozenset(("nav", "header", "footer", "aside", "form"))
#: A start tag that ends the open tag of the same group.
_ENDS = {"p": ("p",), "li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
_HINTS = (
    re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|menu|nav\w*|breadcrumb\w*|sidebar|footer|header|cookie\w*|share|social|related|comment\w*|widget|popup|subscribe|newsletter)(?=$|[\s_-])", re.I),
    re.compile(r"(?:^|[\s_-])(?:content|article|post|entry|story|body|text|main)(?=$|[\s_-])", re.I),
)
_PUNCT = re.compile(r"[.,;:!?…]")
_CAPITAL = re.compile(r"(?:^| )[A-ZÀ-ÖØ-Þ]")
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
FEATURES = ("bias", "log_words", "link_share", "punctuation", "sentence_end", "mean_word", "p", "heading", "li", "bad_hint", "good_hint", "copyright", "capitals")


class Block:
    __slots__ = ("text", "node", "tree", "tag", "linked", "bad", "good", "side")

    def __init__(self, text, node, tree, tag, linked, bad, good, side):
        self.text, self.node, self.tree, self.tag, self.linked, self.bad, self.good, self.side = text, node, tree, tag, linked, bad, good, side


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Places of ``>`` and quotes, and for each where a tag that goes on there ends, or -1; quotes go in pairs."""
    after: dict[str, int] = {}
    found = [m.start() for m in _QUOTES.finditer(page)]
    end = [-1] * (len(found) + 1)
    for i in range(len(found) - 1, -1, -1):
        sign = page[found[i]]
        if sign == ">":
            end[i] = found[i]
        else:
            close = after.get(sign)
            end[i] = end[close + 1] if close is not None else -1
            after[sign] = i
    return found, end


def _tokens(page: str):
    """``(start, end, kind, tag, closing, attributes)`` of the markup in order; kind is tag, raw, cdata or skip.

    What has no end is text, but for comments and raw elements, which go on to the
    page's end. The page is gone over a few times at most, whatever stands in it.
    """
    at, size, last, ends = 0, len(page), page.rfind(">"), None
    cdata = page.rfind("]]>")
    while True:
        start = page.find("<", at)
        if start < 0 or start > last and not page.startswith("<!--", start):
            # without a further end only a comment can still begin
            start = page.find("<!--", max(start, at)) if start >= 0 else -1
            if start < 0:
                return
        m = _START.match(page, start)
        if m is None:
            at = start + 1
            continue
        tag = m.group(2)
        if tag is None:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = size if end < 0 else end + 3
                yield start, at, "skip", "", "", ""
            elif cdata > start and page.startswith("<![CDATA[", start):
                at = page.find("]]>", start + 9) + 3
                yield start, at, "cdata", "", "", ""
            else:
                at = page.find(">", start) + 1
                yield start, at, "skip", "", "", ""
            continue
        tag = tag.lower()
        whole = re.split("[:-]", tag, maxsplit=1)[0]
        if whole in _RAW and not m.group(1):
            opened = page.find(">", m.end()) + 1
            close = _RAW_ENDS[whole].search(page, opened)
            at = close.end() if close else size
            yield start, at, "raw", whole, "", ""
            continue
        if ends is None:
            found = _ATTRIBUTES.match(page, m.end())
            if found:
                at = found.end()
                yield start, at, "tag", tag, m.group(1), page[m.end() : at - 1]
                continue
            ends = _tag_ends(page)  # quotes that don't close: look up from now on, or each tag would search the rest
        stop = ends[1][bisect.bisect_left(ends[0], m.end())]
        if stop < 0:
            at = start + 1
            continue
        at = stop + 1
        yield start, at, "tag", tag, m.group(1), page[m.end() : stop]


def blocks_of(page: str) -> list[Block]:
    """Text blocks in order; a block ends where a block-level tag starts or ends."""
    out: list[Block] = []
    # open elements: (tag, number, bad hint, good hint, side)
    stack: list[tuple[str, int, int, int, int]] = []
    opened: Counter = Counter()
    # each element's parent and depth; the page itself is element 0
    tree: tuple[list[int], list[int]] = ([0], [0])
    parts: list[str] = []
    linked = number = in_link = at = 0
    top = root = ("", 0, 0, 0, 0)

    def flush():
        nonlocal linked
        text = "".join(parts)
        parts.clear()
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            out.append(Block(text, top[1], tree, top[0], min(linked, len(text)), top[2], top[3], top[4]))
        linked = 0

    def pop():
        opened[stack.pop()[0]] -= 1

    for start, end, kind, tag, closing, attributes in _tokens(page):
        if start > at:
            parts.append(page[at:start])
            if in_link:
                linked += len(parts[-1].strip())
        at = end
        if kind == "raw":
            if parts:
                flush()
            continue
        if kind == "cdata":
            parts.append(page[start + 9 : end - 3])
            continue
        if kind == "skip":
            continue
        if tag == "a":
            in_link = 0 if closing else 1
            continue
        if tag in _INLINE:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if parts:
            flush()
        if closing:  # an end tag closes the elements inside it; one that isn't open is ignored
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
                in_link = 0
        elif tag in _VOID or attributes.endswith("/"):
            continue
        else:
            for same in _ENDS.get(tag, ()):
                if stack and stack[-1][0] == same:
                    pop()
            if tag not in _ENDS:
                while stack and stack[-1][0] == "p":  # a block ends an open paragraph
                    pop()
            number += 1
            _, parent, bad, good, side = stack[-1] if stack else root
            tree[0].append(parent), tree[1].append(len(stack) + 1)
            if attributes:
                names = " ".join(x or y or z for x, y, z in _CLASS.findall(attributes))
                if names:
                    bad, good = bad or int(bool(_HINTS[0].search(names))), good or int(bool(_HINTS[1].search(names)))
            side = -1 if tag in _BOILER else 1 if tag in _CONTENT and side == 0 else side
            stack.append((tag, number, bad, good, side))
            opened[tag] += 1
        top = stack[-1] if stack else root
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def features_of(blocks: list[Block]) -> np.ndarray:
    rows = []
    for b in blocks:
        text, tag = b.text, b.tag
        words, size = text.split(" "), len(text)
        n = len(words)
        rows.append((
            1, n, b.linked / size, min(1.0, 4 * len(_PUNCT.findall(text)) / n), text[-1] in '.!?…"”',
            min(2.0, size / n / 6), tag == "p", tag in _HEADINGS, tag == "li", b.bad, b.good,
            "©" in text or "ll rights reserved" in text, min(1.0, 3 * len(_CAPITAL.findall(text)) / n) if n > 3 else 0.5,
        ))
    found = np.array(rows, float).reshape(-1, len(FEATURES))
    found[:, 1] = np.log1p(found[:, 1])
    return found


#: What is believed beforehand: long, punctuated, unlinked text in paragraphs is content.
DEFAULT_MODEL = np.array([-2.0, 0.9, -4.0, 1.0, 1.0, 0.0, 1.0, 0.5, -0.8, -4.0, 0.5, -2.5, 0.0])


def fit_classifier(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, drawn towards ``DEFAULT_MODEL``; both classes weigh the same."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = DEFAULT_MODEL.copy()
    ridge = np.full(x.shape[1], RIDGE)
    ridge[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * (w - DEFAULT_MODEL)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = TRAIN_PAGES) -> np.ndarray:
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").alias("html")).where("id is not null and html is not null")
    chosen = [r["__h"] for r in lowest_hashes(rows.select("id"), "id", sample).collect()]
    if not chosen:
        return DEFAULT_MODEL
    width = len(FEATURES)

    def work(batch):
        for part in cut(batch, 0):
            found, side = [], []
            for page in part.column(0).to_pylist():
                own = [b for b in blocks_of(page) if b.side]
                if own:
                    found.append(features_of(own))
                    side += [int(b.side > 0) for b in own]
            flat = np.concatenate(found) if found else np.zeros((0, width))
            yield [pa.array(side, pa.int32()), pa.array([r.tobytes() for r in flat], pa.binary())]

    # the bound on pages bounds what comes to the driver: a row of features a block, equal ones once
    seen = map_arrow(rows.where(key_hash(F.col("id")) <= chosen[-1]).select("html"), work, StructType([StructField("y", IntegerType()), StructField("x", BinaryType())]))
    counted = seen.groupBy("y", "x").count().collect()
    if len({r["y"] for r in counted}) < 2:
        return DEFAULT_MODEL
    counted.sort(key=lambda r: (r["y"], bytes(r["x"])))
    x = np.stack([np.frombuffer(bytes(r["x"])) for r in counted])
    # an often repeated block counts as the root of its number, or one template would decide
    times = np.maximum(1, np.sqrt([r["count"] for r in counted]).astype(int))
    return np.round(fit_classifier(np.repeat(x, times, axis=0), np.repeat([r["y"] for r in counted], times)), 6)


def smooth_edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges (i, j, capacity) of blocks that are adjacent, or the nearest of the same parent."""
    edges: dict[tuple[int, int], float] = {}

    def link(i: int, j: int):
        a, b = blocks[i].node, blocks[j].node
        parent, depth = blocks[i].tree
        apart = 0  # a block is no farther from the one before than there are tags between them
        while a != b:
            if depth[a] >= depth[b]:
                a = parent[a]
            else:
                b = parent[b]
            apart += 1
        edges[i, j] = SMOOTH / (1 + apart)

    last: dict[int, int] = {}
    for j, block in enumerate(blocks):
        if j:
            link(j - 1, j)
        parent = block.tree[0][block.node]
        i = last.get(parent)
        if i is not None and i != j - 1:
            link(i, j)
        last[parent] = j
    return [(i, j, c) for (i, j), c in edges.items()]


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Who is on the source's side of a minimum cut.

    ``gain`` is a node's capacity from the source (above 0) or, negated, to the
    sink. Of several minimum cuts the one with the fewest nodes on the source's
    side is taken. Dinic's algorithm.
    """
    n = len(gain)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, there: float, back: float):
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, g in enumerate(gain):
        if g > 0:
            add(source, i, g, 0.0)
        elif g < 0:
            add(i, sink, -g, 0.0)
    for i, j, c in edges:
        add(i, j, c, c)
    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > least and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        while True:  # one augmenting path a time, without recursion
            path, a = [], source
            while a != sink:
                while turn[a] < len(out[a]):
                    e = out[a][turn[a]]
                    if room[e] > least and level[to[e]] == level[a] + 1:
                        break
                    turn[a] += 1
                else:
                    if a == source:
                        break
                    e = path.pop()
                    a = to[e ^ 1]
                    turn[a] += 1
                    continue
                path.append(e)
                a = to[e]
            if a != sink:
                break
            flow = min(room[e] for e in path)
            for e in path:
                room[e] -= flow
                room[e ^ 1] += flow


def label_blocks(blocks: list[Block], model: np.ndarray) -> tuple[list[bool], np.ndarray, list[tuple[int, int, float]]]:
    """Content or not, the classifier's log-odds, and the smoothness edges."""
    gain = np.clip(features_of(blocks) @ model, -STEEPEST, STEEPEST)
    edges = smooth_edges(blocks)
    # who is surer than all its edges together can't be turned; only the rest needs the flow
    pull = np.zeros(len(blocks))
    for i, j, c in edges:
        pull[i] += c
        pull[j] += c
    sure = np.abs(gain) > pull
    label = (gain > 0).tolist()
    open_nodes = np.flatnonzero(~sure)
    if len(open_nodes):
        number = {int(i): k for k, i in enumerate(open_nodes)}
        rest = [float(g) for g in gain[open_nodes]]
        inner = []
        for i, j, c in edges:
            a, b = number.get(i), number.get(j)
            if a is not None and b is not None:
                inner.append((a, b, c))
            elif a is not None:
                rest[a] += c if label[j] else -c
            elif b is not None:
                rest[b] += c if label[i] else -c
        for i, side in zip(open_nodes.tolist(), min_cut(rest, inner)):
            label[i] = side
    return label, gain, edges


def extract(page: str, model: np.ndarray) -> tuple[str, int, int, float]:
    """Text, number of blocks, blocks of content, and the cut's cost."""
    blocks = blocks_of(page)
    if not blocks:
        return "", 0, 0, 0.0
    label, gain, edges = label_blocks(blocks, model)
    cost = sum(abs(g) for g, own in zip(gain.tolist(), label) if (g > 0) != own and g) + sum(c for i, j, c in edges if label[i] != label[j])
    return "\n".join(b.text for b, own in zip(blocks, label) if own), len(blocks), sum(label), cost


def extract_pages(pages: DataFrame, model: np.ndarray, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(id, text, n_blocks, n_content, cost)`` for every row; one scan, no shuffle."""
    weights = np.asarray(model, float)

    def work(batch):
        for part in cut(batch, 1):
            rows = [(None,) * 4 if p is None else extract(p, weights) for p in part.column(1).to_pylist()]
            text, total, content, cost = zip(*rows)
            yield [part.column(0), pa.array(text, pa.string()), pa.array(total, pa.int64()), pa.array(content, pa.int64()), pa.array([None if c is None else round(c, 6) for c in cost], pa.float64())]

    schema = StructType([StructField(id_col, pages.schema[id_col].dataType), StructField("text", StringType()), StructField("n_blocks", LongType()), StructField("n_content", LongType()), StructField("cost", DoubleType())])
    return map_arrow(pages.select(F.col(f"`{id_col}`"), F.col(f"`{html_col}`")), work, schema)
