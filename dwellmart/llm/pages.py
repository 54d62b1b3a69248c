"""Main text of web pages by a tree-structured graphical model.

The nodes are a page's elements and its text blocks, each content or not. A node shows a symbol (its
tag, or the kind of thing its class, id or role names; a block its length and share of linked text),
and parent and child have a common potential. Messages passed from the leaves up and from the root
down (sum-product) give each block's exact marginal; blocks with one half or more are the text.

Training counts, over all pages that mark their main region (article, main, or the role), how often
a symbol stands for content, and how a child's state goes with its parent's. Spark sums the counts;
the symbols are few (tags and fixed kinds, others share one). An element whose class, id or role as a
whole names a kind ("sidebar", "site-footer") and boilerplate tags get a few prior counts, so kinds that no
labelled page shows are not unknown, and keep fixed least odds. A name that has such a word among
others ("has-sidebar", "entry-header"), and those of kinds that stand in articles too ("share", "tags"), are
evidence learned like that of a tag, in main regions as much as outside. The odds of these hints, of other
tags and of a text's length are bounded: structure decides.

Nulls and ties: null or empty html, or a page without content, gives the empty text. Unclosed and
stray tags are closed or ignored as browsers do roughly. Repeated rows have equal results. Nothing
is cut; script, style and head never are text. Very long pages are parsed in linear time.
"""

from __future__ import annotations

import collections
import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How tags behave, and what names in classes, ids and roles mean.
VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "select", "title", "object", "canvas"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "br",
}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_TAGS = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "head", "fieldset"}
KINDS = {
    "ad": {"ad", "ads", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion"},
    "notice": {"cookie", "cookies", "consent", "notice", "gdpr", "popup", "modal", "alert", "newsletter", "subscribe", "signup", "login"},
    "menu": {"nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "toolbar", "skip"},
    "side": {"sidebar", "aside", "related", "recommended", "widget", "complementary"},
    "edge": {"footer", "header", "copyright", "masthead", "contentinfo", "legal", "disclaimer"},
    "comments": {"comment", "comments", "reply", "replies", "disqus", "respond"},
}
MIXED = {"share", "social", "tags"}  # kinds of things that articles hold, too
NEUTRAL = {
    "site", "page", "top", "bottom", "left", "right", "box", "bar", "list", "container", "wrapper", "wrap", "inner",
    "outer", "slot", "section", "area", "block", "unit", "item", "links",
}
PRIOR, SMOOTHING, LEAST = 20.0, 0.5, 0.5
NAMED_ODDS, TEXT_ODDS, TAG_ODDS, TURN = 50.0, 0.75, 1.0, 0.02  # log odds: least of a named kind, most of a text and of a tag; least chance of a turn
_KNOWN = INLINE | VOID | BOILERPLATE_TAGS | CONTENT_TAGS | set(CLOSES) | {
    "html", "body", "div", "section", "ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "blockquote", "pre",
    "figure", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "address", "details", "summary", "caption", "center",
}
_name = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_delimiter = re.compile(r"[>\"']")
_attribute = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_split = re.compile(r"[^a-z0-9]+")


def _kind(attributes: str) -> str | None:
    """The kind that a class, id or role names; "hint" if such a word is one among others."""
    if "=" not in attributes:
        return None
    hint = None
    for found in _attribute.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").lower().split():
            parts = {x for x in _split.split(name) if x and not x.isdigit()}
            kinds = [kind for kind, known in KINDS.items() if parts & known]
            if kinds and parts <= NEUTRAL.union(*KINDS.values()):
                return kinds[0]
            if kinds or parts & MIXED:
                hint = "hint"
    return hint


class _Tags:
    """Where the tags of a page end. Places from which no end was found are remembered, so that all
    searches together take linear time."""

    def __init__(self, source: str):
        self._source = source
        self._last = {c: source.rfind(c) for c in ">\"'"}
        self.last = self._last[">"]
        self._dead: set[int] = set()
        self._next = -1

    def end(self, at: int) -> int:
        """Place behind the ">" of the tag whose name ends at ``at``, outside quotes; -1 if there is none."""
        if at > self._last[">"]:
            return -1
        if self._next < at:
            found = _delimiter.search(self._source, at)
            self._next = found.start() if found else len(self._source)
        place, seen = self._next, []
        while place < len(self._source) and place not in self._dead:
            sign = self._source[place]
            if sign == ">":
                return place + 1
            seen.append(place)
            if self._last[sign] == place:
                break
            found = _delimiter.search(self._source, self._source.find(sign, place + 1) + 1)
            place = found.start() if found else len(self._source)
        self._dead.update(seen)
        return -1


class Page:
    """Nodes in page order (a parent before its children) with their symbols, parents and texts."""

    def __init__(self, source: str):
        self.symbols, self.parents, self.tags, self.texts = ["root"], [0], ["root"], [None]
        self._stack, self._parts, self._linked, self._links = [0], [], 0, 0
        self._open: collections.Counter[str] = collections.Counter()
        self._parse(source)

    def _node(self, symbol: str, tag: str, text: str | None = None) -> int:
        self.symbols.append(symbol)
        self.parents.append(self._stack[-1])
        self.tags.append(tag)
        self.texts.append(text)
        return len(self.symbols) - 1

    def _flush(self) -> None:
        text = " ".join(html.unescape("".join(self._parts)).split())
        if text:
            size = "short" if len(text) < 25 else "medium" if len(text) < 120 else "long"
            linked = "linked" if self._linked > 0.5 * len(text) else "plain"
            self._node(f"text-{size}-{linked}", "text", text)
        self._parts, self._linked = [], 0

    def _words(self, text: str) -> None:
        self._parts.append(text)
        if self._links:
            self._linked += len(text.strip())

    def _close(self, index: int) -> None:
        self._flush()
        self._open.subtract(self.tags[node] for node in self._stack[index:])
        del self._stack[index:]

    def _parse(self, source: str) -> None:
        at, end, tags = 0, len(source), _Tags(source)
        while at < end:
            opened = source.find("<", at)
            if opened < 0:
                break
            if opened > at:
                self._words(source[at:opened])
            if source.startswith("<!--", opened):
                closed = source.find("-->", opened + 4)
                at = end if closed < 0 else closed + 3
                continue
            if source[opened + 1 : opened + 2] in ("!", "?"):
                closed = source.find(">", opened)
                at = end if closed < 0 else closed + 1
                continue
            found = _name.match(source, opened) if opened < tags.last else None
            closed = tags.end(found.end()) if found else -1
            if closed < 0:
                self._words("<")
                at = opened + 1
                continue
            at, attributes = closed, source[found.end() : closed - 1]
            tag = found[2].lower()
            if found[1]:
                self._end(tag)
            elif tag in RAW:
                if not attributes.endswith("/"):
                    closed = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(source, at)
                    at = closed.end() if closed else end
            else:
                self._start(tag, attributes)
        if at < end:
            self._words(source[at:])
        self._flush()

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._parts.append(" ")
        if tag == "a":
            self._links += 1
        kind = _kind(attributes)
        if tag in INLINE and kind in (None, "hint"):
            return
        self._flush()
        closes = CLOSES.get(tag, {"p"} if tag not in INLINE else set())
        for i in range(len(self._stack) - 1, 0, -1):
            if self.tags[self._stack[i]] in closes:
                self._close(i)
                break
            if self.tags[self._stack[i]] not in ("p", *INLINE):
                break
        if kind == "hint" and tag in CONTENT_TAGS:
            kind = None
        if tag not in VOID:
            self._stack.append(self._node(kind or (tag if tag in _KNOWN else "other"), tag))
            self._open[tag] += 1

    def _end(self, tag: str) -> None:
        if tag == "a" and self._links:
            self._links -= 1
        if not self._open[tag]:
            return
        for i in range(len(self._stack) - 1, 0, -1):
            if self.tags[self._stack[i]] == tag:
                self._close(i)
                return
            if tag in INLINE and self.tags[self._stack[i]] not in INLINE:
                return

    def labels(self) -> list[int] | None:
        """Known states of a page that marks its main region, else None."""
        if not any(t in CONTENT_TAGS for t in self.tags):
            return None
        states = [0]
        for i in range(1, len(self.tags)):
            bad = self.symbols[i] in KINDS or self.tags[i] in BOILERPLATE_TAGS
            states.append(int(not bad and (self.tags[i] in CONTENT_TAGS or states[self.parents[i]] == 1)))
        return states


class Model:
    """Log potentials of symbols and of parent-child states, from counts."""

    def __init__(self, counts: dict[tuple[str, int, int], float]):
        """counts: (symbol, state, 0) and ("|element" or "|text" for the child, its parent's state, its state)."""
        shown: dict[str, list[float]] = {}
        together = {name: [[SMOOTHING, SMOOTHING], [SMOOTHING, SMOOTHING]] for name in ("|element", "|text")}
        for (name, a, b), n in counts.items():
            if name in together:
                together[name][a][b] += n
            else:
                shown.setdefault(name, [SMOOTHING, SMOOTHING])[a] += n
        for name in {*KINDS, *BOILERPLATE_TAGS}:
            shown.setdefault(name, [SMOOTHING, SMOOTHING])[0] += PRIOR
        for name in CONTENT_TAGS:
            shown.setdefault(name, [SMOOTHING, SMOOTHING])[1] += PRIOR
        totals = [sum(x[s] for x in shown.values()) for s in (0, 1)]
        self.symbol = {k: tuple(math.log(v[s] / totals[s]) for s in (0, 1)) for k, v in shown.items()}
        for name, (no, yes) in self.symbol.items():
            if name in KINDS or name in BOILERPLATE_TAGS:
                self.symbol[name] = (no, min(yes, no - NAMED_ODDS))
            elif name in CONTENT_TAGS:
                self.symbol[name] = (min(no, yes - NAMED_ODDS), yes)
            else:
                most = TEXT_ODDS if name.startswith("text-") else TAG_ODDS
                self.symbol[name] = (0.0, max(-most, min(most, yes - no)))
        chance = {name: [x / sum(row) for row in table for x in row] for name, table in together.items()}
        chance["|element"] = [min(max(x, TURN), 1 - TURN) for x in chance["|element"]]
        self.edge = {name: [math.log(x) for x in table] for name, table in chance.items()}

    def content(self, page: Page) -> list[float]:
        """Marginal probability of content for every node: upward, then downward messages."""
        n, parents = len(page.symbols), page.parents
        edges = [self.edge["|text" if t is not None else "|element"] for t in page.texts]
        own = [list(self.symbol.get(s, (0.0, 0.0))) for s in page.symbols]
        own[0] = [0.0, -50.0]
        up = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            e00, e01, e10, e11 = edges[i]
            x0, x1 = own[i]  # with the messages of all children
            up[i] = (_sum(e00 + x0, e01 + x1), _sum(e10 + x0, e11 + x1))
            parent = own[parents[i]]
            parent[0] += up[i][0]
            parent[1] += up[i][1]
        result = [0.0] * n
        for i in range(1, n):
            e00, e01, e10, e11 = edges[i]
            p0, p1 = own[parents[i]]  # its own belief by now
            p0, p1 = p0 - up[i][0], p1 - up[i][1]
            top = max(p0, p1)
            p0, p1 = p0 - top, p1 - top
            mine = own[i]
            mine[0] += _sum(p0 + e00, p1 + e10)
            mine[1] += _sum(p0 + e01, p1 + e11)
            result[i] = 1 / (1 + math.exp(min(700.0, mine[0] - mine[1])))
        return result


def _sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def train(pages: DataFrame) -> Model:
    """Counts over all labelled pages; ``pages`` has html."""

    def partial(batches):
        counts: dict[tuple[str, int, int], int] = {}
        for batch in batches:
            for source in batch.column(0):
                page = Page(source.as_py() or "")
                states = page.labels()
                for i in range(1, len(page.symbols) if states else 0):
                    child = "|text" if page.texts[i] is not None else "|element"
                    for key in ((page.symbols[i], states[i], 0), (child, states[page.parents[i]], states[i])):
                        counts[key] = counts.get(key, 0) + 1
        if counts:
            name, a, b = zip(*counts, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(counts.values(), pa.int64())],
                ["name", "a", "b", "n"],
            )

    counted = pages.select("html").mapInArrow(partial, "name STRING, a INT, b INT, n BIGINT")
    rows = counted.groupBy("name", "a", "b").agg(F.sum("n").alias("n")).collect()
    return Model({(r.name, r.a, r.b): r.n for r in rows})


def extract(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """page_id, url, text (blocks in page order, joined by an empty line) and n_blocks of every page."""
    rows = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html")
    )
    shared = pages.sparkSession.sparkContext.broadcast(train(rows))

    def blocks(batches):
        for batch in batches:
            texts, counts = [], []
            for source in batch.column(2):
                page = Page(source.as_py() or "")
                likely = shared.value.content(page)
                found = [t for t, p in zip(page.texts, likely, strict=True) if t and p >= LEAST]
                texts.append("\n\n".join(found))
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                ["page_id", "url", "text", "n_blocks"],
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(blocks, f"page_id {kind}, url STRING, text STRING, n_blocks BIGINT")
