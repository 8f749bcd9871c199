"""Main text of web pages by a minimum cut over their text blocks.

A page becomes blocks of text, and landmarks: elements whose tag, role or class says that they hold the article or
something else. A logistic model of a block's shape and its neighbours' (length, links, punctuation; no tag of a landmark
and no class word) gives the cost of calling the block content or boilerplate: its terminal capacities. It is fitted on a
bounded sample of pages, where blocks inside article or main are content and those inside nav, footer, aside and the like
are not. Neighbours in page order, blocks that hang near each other in the tree, and blocks and their landmark are tied by
smoothness edges; how strongly neighbours are tied is measured on the same sample. The maximum flow gives the minimum cut,
the labelling of least total cost; its content side, in page order, is the text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import carried_id

#: Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head title svg math iframe object select option textarea button canvas audio video".split())
BLOCK = frozenset("address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
ALWAYS_HIDDEN = frozenset("script style title head option textarea".split())  # the others only if their end tag comes
HEAD_ONLY = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog header".split())
CONTENT_TAGS = frozenset("article main".split())
CLOSED_BY = {"p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}
CLOSED_BY |= {"option": BLOCK | {"option", "optgroup"}, "optgroup": BLOCK | {"optgroup"}, "select": BLOCK | {"select", "input", "textarea"}}
BOILER_WORDS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|comment-?list|respond|replies|cookies?|consent|copyright|disclaimer|disqus|footer|header|masthead|menu|modal|nav\w*|newsletter|notice\w*|pagination|pager|popup|promo\w*|related|recommend\w*|share|sharing|sidebar|skip|social|sponsor\w*|subscribe|subscription|tags?|toolbar|widget|gdpr|login|signup|search)(?:$|[\s_-])", re.IGNORECASE)
CONTENT_WORDS = re.compile(r"(?:^|[\s_-])(?:article|content|entry|main|post|story|body|text)(?:$|[\s_-])", re.IGNORECASE)
LAYOUT_WORDS = re.compile(r"(?:^|(?<=[\s_-]))(?:with|has|no|without)[_-]\w+", re.IGNORECASE)  # with-sidebar says nothing of the block
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
READER = re.compile(r"(?:^|\s)(?:comment|reply|teaser|promo)(?:$|[\s_-])", re.IGNORECASE)  # articles that are not the page's own

COMMENT_END = re.compile("--!?>")

FREE, MAYBE, CONTENT, BOILER = range(4)  # what encloses a block: nothing known, an element named like content, the article, anything else
#: Costs of the landmarks themselves, and how strongly a block is tied to its own. A block's shape costs at most MOST_SHAPE.
LANDMARK_COST = {MAYBE: 4.0, CONTENT: 1e6, BOILER: -1e6}
LANDMARK_TIE = {MAYBE: 1.0, CONTENT: 3.0, BOILER: 3.0}
MOST_SHAPE, MOST_TIE = 2.5, 1.5
SAMPLE_PAGES, SAMPLE_BLOCKS = 400, 200

FEATURES = ("bias", "log_words", "link_density", "sentence_end", "commas", "word_length", "capitals", "digits", "heading", "list_item", "log_words_before", "links_before", "log_words_after", "links_after")


@dataclass(frozen=True)
class BlockModel:
    """Log odds of being content by FEATURES, and the ties of neighbours by where they hang in the tree."""

    weights: tuple[float, ...]
    same_parent: float
    same_grandparent: float
    apart: float


#: What a fit starts from, and what it stays at without labelled blocks.
DEFAULT = BlockModel((-1.4, 0.5, -2.5, 0.6, 0.0, 0.0, 0.0, 0.0, 0.3, -0.6, 0.05, -0.3, 0.05, -0.3), 0.7, 0.4, 0.15)


@dataclass
class Block:
    text: str
    parent: int  # the block element around the one that the text stands in
    grandparent: int
    landmark: int  # -1 if none
    label: int | None  # 1 or 0 if tags alone tell content from boilerplate
    shape: list[float]


class _Lenient(HTMLParser):
    """A parser that takes any page in time that grows with its length.

    What starts like a declaration and is none is a comment up to the next '>'; so is a comment that never ends. A tag that
    the page ends in is dropped with what follows it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.last_comment_end: int | None = None

    def _cut_off(self, i: int) -> bool:
        return self.rawdata.find(">", i) < 0

    def parse_comment(self, i: int, report: bool = True) -> int:
        if self.last_comment_end is None:
            self.last_comment_end = max(self.rawdata.rfind("-->"), self.rawdata.rfind("--!>"))
        if i + 2 <= self.last_comment_end:
            return COMMENT_END.search(self.rawdata, i + 2).end()
        return self.parse_html_declaration(i)

    def parse_html_declaration(self, i: int) -> int:
        end = self.rawdata.find(">", i + 2)
        return end + 1 if end >= 0 else len(self.rawdata)

    def parse_starttag(self, i: int) -> int:
        return len(self.rawdata) if self._cut_off(i) else super().parse_starttag(i)

    def parse_endtag(self, i: int) -> int:
        return len(self.rawdata) if self._cut_off(i) else super().parse_endtag(i)

    def parse_pi(self, i: int) -> int:
        return len(self.rawdata) if self._cut_off(i) else super().parse_pi(i)


class _Unclosed(_Lenient):
    """The places, among all start tags, of hidden elements whose end tag never comes."""

    def __init__(self) -> None:
        super().__init__()
        self.seen = 0
        self.left: dict[str, list[int]] = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.seen += 1
        if tag in HIDDEN:
            self.left.setdefault(tag, []).append(self.seen)

    def handle_endtag(self, tag: str) -> None:
        if self.left.get(tag):
            self.left[tag].pop()


class _Element:
    __slots__ = ("tag", "hidden", "state", "by_tag", "landmark", "block_at", "own", "parent", "grandparent")

    def __init__(self, tag: str, hidden: bool, state: int, by_tag: int, landmark: int, block_at: int, own: int, parent: int, grandparent: int) -> None:
        self.tag, self.hidden, self.state, self.by_tag, self.landmark, self.block_at = tag, hidden, state, by_tag, landmark, block_at
        self.own, self.parent, self.grandparent = own, parent, grandparent  # numbers of the nearest block elements


_OUTSIDE = _Element("", False, FREE, FREE, -1, -1, -1, -1, -1)


class _Blocks(_Lenient):
    """Cuts a page into blocks; unclosed and misnested elements are closed as far as their ancestors say.

    An element inherits all that its ancestors settle, so that the work does not grow with depth.
    """

    def __init__(self, unclosed: frozenset[int] = frozenset()) -> None:
        super().__init__()
        self.unclosed, self.seen = unclosed, 0
        self.open: list[_Element] = []
        self.depth: Counter[str] = Counter()
        self.blocks: list[Block] = []
        self.landmarks: list[int] = []
        self.parts: list[str] = []
        self.linked = self.count = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            inner = self.open[-1] if self.open else _OUTSIDE
            tags = [e.tag for e in self.open[-3:]]
            label = {CONTENT: 1, BOILER: 0}.get(inner.by_tag) if inner.by_tag == inner.state else None
            shape = _shape(text, self.linked, not HEADINGS.isdisjoint(tags[-2:]), "li" in tags)
            self.blocks.append(Block(text, inner.parent, inner.grandparent, inner.landmark, label, shape))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.seen += 1
        if self.open and (tag == "body" or self.open[-1].tag == "head" and tag not in HEAD_ONLY):
            self._end_head()
        while self.open and tag in CLOSED_BY.get(self.open[-1].tag, ()):
            self._close()
        if tag in BLOCK:
            if tag in CLOSED_BY["p"] and self.open and (at := self.open[-1].block_at) >= 0 and self.open[at].tag == "p":
                while len(self.open) > at:  # an open paragraph ends even if inline elements in it were left open
                    self._close()
            self.flush()
        if tag in VOID:
            return
        self.open.append(self._opened(tag, {k: v or "" for k, v in attrs}, self.open[-1] if self.open else _OUTSIDE))
        self.depth[tag] += 1

    def _opened(self, tag: str, names: dict[str, str], outer: _Element) -> _Element:
        role = names.get("role", "").lower()
        label = LAYOUT_WORDS.sub(" ", f"{names.get('class', '')} {names.get('id', '')}") if "class" in names or "id" in names else ""
        by_tag, state, landmark = outer.by_tag, outer.state, outer.landmark
        if tag in BOILER_TAGS and not (tag == "header" and outer.state == CONTENT) or role in BOILER_ROLES:
            by_tag = BOILER
        elif (tag in CONTENT_TAGS or role in ("main", "article")) and outer.by_tag != BOILER:
            by_tag = CONTENT
        if state != BOILER:
            own = tag in ("html", "body", "article", "main")
            if by_tag == BOILER or (READER if own else BOILER_WORDS).search(label):
                state = BOILER
            elif by_tag == CONTENT:
                state = CONTENT
            elif state == FREE and CONTENT_WORDS.search(label):
                state = MAYBE
            if state != outer.state:
                landmark = len(self.landmarks)
                self.landmarks.append(state)
        hidden = outer.hidden or tag in HIDDEN and (tag in ALWAYS_HIDDEN or self.seen not in self.unclosed) or "hidden" in names or "display:none" in names.get("style", "").replace(" ", "").lower() or names.get("aria-hidden") == "true"
        if tag not in BLOCK:
            return _Element(tag, hidden, state, by_tag, landmark, outer.block_at, outer.own, outer.parent, outer.grandparent)
        self.count += 1
        return _Element(tag, hidden, state, by_tag, landmark, len(self.open), self.count, outer.own, outer.parent)

    def _end_head(self) -> None:
        """The end tag of a head may be left out."""
        if self.depth["head"] and not self.depth["template"]:
            while self.depth["head"]:
                self._close()

    def _close(self) -> None:
        if self.open[-1].tag in BLOCK:
            self.flush()
        self.depth[self.open.pop().tag] -= 1

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.flush()
        if self.depth[tag]:
            while self.open[-1].tag != tag:
                self._close()
            self._close()

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1].tag == "head" and data.strip():
            self._end_head()
        if self.open and self.open[-1].hidden:
            return
        self.parts.append(data)
        if self.depth["a"]:
            self.linked += len(data.strip())


def _shape(text: str, linked: int, heading: bool, list_item: bool) -> list[float]:
    words, size = text.count(" ") + 1, len(text)
    capitals = sum(w[0].isupper() for w in text.split(" "))
    digits = sum(map(text.count, "0123456789"))
    return [1.0, math.log2(1 + words), min(1.0, linked / size), float(text[-1] in ".!?…\"'”»"), min(1.0, text.count(",") / words), min(2.0, (size + 1 - words) / words / 6), capitals / words, min(1.0, digits / size), float(heading), float(list_item)]


@dataclass
class Page:
    blocks: list[Block]
    landmarks: list[int]

    def features(self) -> np.ndarray:
        """FEATURES of all blocks: their shapes and those of the blocks before and after."""
        own = np.array([b.shape for b in self.blocks], float).reshape(len(self.blocks), -1)
        around = np.zeros((len(own) + 2, 2))
        around[1:-1] = own[:, 1:3]
        return np.hstack([own, around[:-2], around[2:]])


def parsed(html: str) -> Page:
    lower, unclosed = html.lower(), frozenset()
    if any(lower.count("<" + tag) > lower.count("</" + tag) for tag in HIDDEN - ALWAYS_HIDDEN):
        ends = _Unclosed()
        ends.feed(html)
        ends.close()
        unclosed = frozenset(at for places in ends.left.values() for at in places)
    parser = _Blocks(unclosed)
    parser.feed(html)
    parser.close()
    while parser.open:
        parser._close()
    parser.flush()
    return Page(parser.blocks, parser.landmarks)


def shape_costs(page: Page, model: BlockModel) -> list[float]:
    """Log odds of each block by its shape alone, within MOST_SHAPE."""
    return np.clip(page.features() @ np.array(model.weights), -MOST_SHAPE, MOST_SHAPE).tolist()


def smoothness_edges(page: Page, model: BlockModel) -> list[tuple[int, int, float]]:
    """Edges between blocks, and from blocks to landmarks, which are numbered after the blocks."""
    edges: list[tuple[int, int, float]] = []
    last: dict[tuple[str, int], int] = {}
    n = len(page.blocks)
    for i, block in enumerate(page.blocks):
        near = None
        for kind, at, weight in (("parent", block.parent, model.same_parent), ("grandparent", block.grandparent, model.same_grandparent)):
            if at >= 0:
                if near is None and (near := last.get((kind, at))) is not None:
                    edges.append((near, i, weight))
                last[kind, at] = i
        if i and near != i - 1:
            edges.append((i - 1, i, model.apart))
        if block.landmark >= 0:
            edges.append((n + block.landmark, i, LANDMARK_TIE[page.landmarks[block.landmark]]))
    return edges


def minimum_cut(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling x that minimises the sum of |unary| over nodes labelled against its sign plus the cut edges' weights.

    unary[i] > 0 ties node i to the source with that capacity, unary[i] < 0 to the sink. Flow is sent in phases: nodes are
    levelled by their distance from the source, and paths along rising levels are filled until none is left. After the
    last phase, nodes that the source still reaches are True. Capacities are whole millionths, so that phases end.
    """
    n, scale = len(unary), 1e6
    ends: list[list[int]] = [[] for _ in range(n)]  # edge numbers; an edge and its reverse are a pair 2k, 2k + 1
    to, room = [], []
    for a, b, w in edges:
        ends[a].append(len(to))
        ends[b].append(len(to) + 1)
        to += (b, a)
        room += (round(w * scale),) * 2
    excess = [round(u * scale) for u in unary]  # above 0: still to come from the source; below: still to go to the sink
    while True:
        level = [0 if e > 0 else -1 for e in excess]
        queue = [i for i in range(n) if not level[i]]
        sources, met = queue[:], False
        for i in queue:
            ahead = level[i] + 1
            for e in ends[i]:
                j = to[e]
                if room[e] and level[j] < 0:
                    level[j] = ahead
                    queue.append(j)
                    met |= excess[j] < 0
        if not met:
            return [at >= 0 for at in level]
        tried = [0] * n
        for source in sources:
            path, i = [], source
            while excess[source] > 0:
                if excess[i] < 0:
                    flow = min(excess[source], -excess[i], *(room[e] for e in path))
                    excess[source] -= flow
                    excess[i] += flow
                    full = len(path)
                    for at in range(len(path) - 1, -1, -1):
                        e = path[at]
                        room[e] -= flow
                        room[e ^ 1] += flow
                        if not room[e]:
                            full = at
                    if full < len(path):  # on from where the path is full
                        i = to[path[full] ^ 1]
                        del path[full:]
                    continue
                out, ahead = ends[i], level[i] + 1
                while tried[i] < len(out) and not (room[out[tried[i]]] and level[to[out[tried[i]]]] == ahead):
                    tried[i] += 1
                if tried[i] < len(out):
                    path.append(out[tried[i]])
                    i = to[path[-1]]
                elif path:
                    i = to[path.pop() ^ 1]
                    tried[i] += 1
                else:
                    break


def labelled(page: Page, model: BlockModel = DEFAULT) -> list[bool]:
    """Which blocks are content."""
    costs = shape_costs(page, model) + [LANDMARK_COST[state] for state in page.landmarks]
    return minimum_cut(costs, smoothness_edges(page, model))[: len(page.blocks)]


def main_text(html: str | None, model: BlockModel = DEFAULT) -> str:
    """The content blocks of a page in page order, joined by one space; empty if there are none."""
    page = parsed(html or "")
    if not page.blocks:
        return ""
    return " ".join(b.text for b, k in zip(page.blocks, labelled(page, model), strict=True) if k)


# --- fitting ----------------------------------------------------------------------------------------------------


def evidence(page: Page, most: int = SAMPLE_BLOCKS) -> tuple[np.ndarray, list[int]]:
    """(label and features of at most `most` labelled blocks, evenly spread; how often neighbours differ and agree).

    The counts stand for neighbours with one parent, with one grandparent, and others: differing, agreeing for each.
    """
    at = [i for i, b in enumerate(page.blocks) if b.label is not None]
    at = at[:: max(1, -(-len(at) // most))]
    rows = np.hstack([np.array([[page.blocks[i].label] for i in at], float).reshape(-1, 1), page.features()[at]]) if at else np.empty((0, 1 + len(FEATURES)))
    pairs = [0] * 6
    for a, b in zip(page.blocks, page.blocks[1:], strict=False):
        if a.label is not None and b.label is not None:
            kind = 0 if a.parent == b.parent else 1 if a.grandparent == b.grandparent else 2
            pairs[2 * kind + (a.label == b.label)] += 1
    return rows, pairs


def fit_blocks(rows: np.ndarray, pairs: list[int], start: BlockModel = DEFAULT, strength: float = 5.0) -> BlockModel:
    """The model most probable after the sample, with normal priors around `start`; both labels weigh the same in total."""
    weights = np.array(start.weights)
    y, x = rows[:, 0], rows[:, 1:]
    if 0 < y.sum() < len(y):
        weigh = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            slope = x.T @ (weigh * (y - p)) - strength * (weights - start.weights)
            bend = (x * (weigh * p * (1 - p))[:, None]).T @ x + strength * np.eye(len(weights))
            move = np.linalg.solve(bend, slope)
            weights = weights + move
            if np.abs(move).max() < 1e-6:
                break
    ties = []
    for kind, tie in enumerate((start.same_parent, start.same_grandparent, start.apart)):
        differ, agree = pairs[2 * kind], pairs[2 * kind + 1]
        prior = 20 / (1 + math.exp(tie))  # twenty pairs whose log odds are the tie to start from
        ties.append(min(MOST_TIE, max(0.0, math.log((agree + 20 - prior) / (differ + prior)))))
    return BlockModel(tuple(weights.tolist()), *ties)


def fit_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample_pages: int = SAMPLE_PAGES, sample_blocks: int = SAMPLE_BLOCKS) -> BlockModel:
    """A model fitted on at most `sample_pages` pages, picked by a hash of id and url, and `sample_blocks` blocks of each.

    Pages are parsed in tasks; only labels and features of blocks reach the driver.
    """
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(url_col).cast("string"))
    picked = [row["key"] for row in pages.select(key.alias("key")).distinct().orderBy("key").limit(sample_pages).collect()]

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [evidence(parsed(html or ""), sample_blocks) for html in batch["html"]]
            yield pd.DataFrame({"key": batch["key"], "rows": [r.tobytes() for r, _ in found], "pairs": [p for _, p in found]})

    chosen = pages.select(key.alias("key"), F.col(html_col).alias("html")).where(F.col("key").isin(picked)).groupBy("key").agg(F.min("html").alias("html"))
    found = chosen.mapInPandas(gather, "key long, rows binary, pairs array<long>").collect()
    found.sort(key=lambda row: row["key"])
    rows = np.frombuffer(b"".join(bytes(row["rows"]) for row in found)).reshape(-1, 1 + len(FEATURES))
    return fit_blocks(rows, [sum(each) for each in zip(*(row["pairs"] for row in found), strict=True)] or [0] * 6)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: BlockModel | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of `pages`, by a model fitted on a sample of them unless one is given.

    Whole pages are read. A null or empty page has an empty text; malformed markup is read as far as it goes, and what only
    starts like a declaration (`<![foo[x]]>`) is a comment up to the next '>', or to the end; repeated rows are judged each
    on their own; an empty table gives an empty result; other columns are not looked at. Narrow but for the sample: no
    shuffle. The work on a page grows about in proportion to its length, whatever its depth.
    """
    (page_id, kind), url = carried_id(pages, id_col), pages.schema[url_col].dataType.simpleString()
    model = model or fit_pages(pages, id_col, url_col, html_col)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(html, model) for html in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    wanted = pages.select(page_id.alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    out = wanted.mapInPandas(extract, f"page_id {kind}, url {url}, text string, n_chars long")
    return out.withColumn("page_id", F.col("page_id").cast(pages.schema[id_col].dataType))
