"""Main text of web pages by tree scoring.

A page is read as a tree of its block elements. Elements that never hold article text (menus, page
headers, footers, sidebars, notices, adverts, forms, comments, scripts, hidden parts), told by tag,
role or a whole word of class and id, are left out with all they hold. Each remaining block of text
passes points for its length and its commas to its ancestors, less the farther they are; an
ancestor's points are discounted by the share of its text that lies in links. The container with the most
points, or the ``article`` or ``main`` around it, is kept, and with it those siblings that look like
text too. Lists and boxes of links inside it go.

A block's white space becomes single spaces, blocks are joined by two line feeds, in page order, whole.
Tag soup is read as browsers do where it matters here: paragraphs end where a block starts, end tags
without a start are nothing, an element to leave out that is never closed is read like any other.

Work per page is linear in its length, apart from its nesting depth times a constant. Pages are
independent: no shuffle. Defined cases: null or empty html, or a page without text, gives an empty text;
repeated rows are extracted each; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import narrow, table

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_PAGE_PARTS = re.compile(r"<(?:article|main)\b|(?:<p\b.*?){3}", re.IGNORECASE | re.DOTALL)

_set = lambda words: frozenset(words.split())
RAW = _set("script style textarea title noscript iframe noframes noembed xmp template")
LEFT_OUT = _set("nav footer aside menu button select option dialog svg canvas object audio video form fieldset label datalist")
BLOCKS = _set(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul")
#: Blocks that are a paragraph of their container rather than a container.
LEAVES = _set("p pre h1 h2 h3 h4 h5 h6 li dt dd td th blockquote figcaption caption summary address")
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
NEVER = _set("hr br img input meta link area base col embed source track wbr param")
#: A start tag here ends these, up to the container named after them.
_ENDS = {"li": (_set("li"), _set("ul ol menu")), "dt": (_set("dt dd"), _set("dl")), "dd": (_set("dt dd"), _set("dl")),
         "tr": (_set("tr td th"), _set("table")), "td": (_set("td th"), _set("tr table")), "th": (_set("td th"), _set("tr table"))}
BOILERPLATE_ROLES = _set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form")
#: Words of class and id of parts that are not the article.
BOILERPLATE = _set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion sidebar sidebars "
    "rail menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead notice notices alert alerts cookie cookies "
    "consent gdpr banner popup modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus "
    "replies respond related recommended recommendations share sharing social pagination pager widget widgets toolbar search "
    "header topbar skip")
#: Before such a word these say that something lies beside the element, or not at all.
_BESIDE = _set("no has with without")
_KEPT_ANYWAY = _set("html body main")
_BLOCK_EDGE = re.compile(rf"<(/?(?:{'|'.join(sorted(BLOCKS))}))(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE)
GOOD = _set("article content main body post entry story text")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth_in_article: bool
    points: float = 0.0
    chars: int = 0
    linked: int = 0
    links: int = 0


@dataclass(slots=True)
class Block:
    node: int
    parts: list = field(default_factory=list)
    linked: int = 0
    links: int = 0
    text: str = ""


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _words(attributes: dict[str, str]) -> list[str]:
    return [w.lower() for w in _WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")]


def boilerplate(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is left out with all it holds."""
    if tag in _KEPT_ANYWAY:
        return False
    if tag in LEFT_OUT or (tag == "header" and not in_article):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in BOILERPLATE_ROLES:
        return True
    words = _words(attributes)
    return any(
        w in BOILERPLATE and not (i and words[i - 1] in _BESIDE) and not (w == "header" and in_article)
        for i, w in enumerate(words)
    )


class Page:
    """The block elements of a page and its blocks of text, without boilerplate."""

    def __init__(self, html: str):
        self.nodes = [Node("html", -1, False)]
        self.blocks: list[Block] = []
        self._html, self._ends = html, {}
        self._stack, self._open = [0], {"html": 1}
        self._block: Block | None = None
        self._link = False
        self._read()

    def _end_of(self, tag: str, at: int) -> int | None:
        """Where the element of that name whose start tag ends at ``at`` ends; None if it is never closed."""
        if tag not in self._ends:
            ends, opened = {}, []
            step = re.compile(rf"<!--.*?(?:-->|\Z)|<(script|style)\b.*?</\1|<(/?){re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)",
                              re.DOTALL | re.IGNORECASE | re.ASCII)
            for found in step.finditer(self._html):
                if found[2] == "":
                    opened.append(found.end())
                elif found[2] and opened:
                    ends[opened.pop()] = found.end()
            self._ends[tag] = ends
        return self._ends[tag].get(at)

    def _read(self) -> None:
        html, at = self._html, 0
        while at < len(html):
            found = _TOKEN.search(html, at)
            if found is None:
                self._text(html[at:])
                break
            self._text(html[at:found.start()])
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                continue
            if found[1]:
                self._end(tag)
            elif tag in RAW:
                end = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
            else:
                at = self._start(tag, found[3] or "", at)
        self._break()

    def _start(self, tag: str, rest: str, at: int) -> int:
        """Take a start tag; returns where reading goes on."""
        node, attributes = self.nodes[self._stack[-1]], _attributes(rest)
        if tag not in NEVER and boilerplate(tag, attributes, node.depth_in_article):
            stop = self._skip(tag, at)
            if stop is not None:
                if tag in BLOCKS:
                    self._break()
                return stop
        if tag == "br":
            self._text(" ")
        elif tag == "a":
            self._link = True
            if self._block is not None:
                self._block.links += 1
        elif tag in BLOCKS:
            self._break()
            if tag in ("html", "body") and self._open.get(tag):
                return at
            if self._open.get("p"):
                self._close("p")
            if tag in _ENDS:
                ended, within = _ENDS[tag]
                while self.nodes[self._stack[-1]].tag not in within and len(self._stack) > 1 and any(
                        self._open.get(t) for t in ended) and self._near(ended, within):
                    self._pop()
            if tag != "hr":
                parent = self.nodes[self._stack[-1]]
                self.nodes.append(Node(tag, self._stack[-1], parent.depth_in_article or tag == "article"))
                self.nodes[-1].points = self._start_points(tag, attributes)
                self._stack.append(len(self.nodes) - 1)
                self._open[tag] = self._open.get(tag, 0) + 1
        return at

    def _near(self, ended: frozenset, within: frozenset) -> bool:
        """Whether one of ``ended`` is open inside the innermost of ``within``; looks a few levels up."""
        for i in self._stack[:-12:-1]:
            if self.nodes[i].tag in within:
                return False
            if self.nodes[i].tag in ended:
                return True
        return False

    @staticmethod
    def _start_points(tag: str, attributes: dict[str, str]) -> float:
        good = 10.0 if attributes and GOOD.intersection(_words(attributes)) else 0.0
        return good + {"article": 20.0, "main": 15.0, "section": 2.0, "div": 2.0}.get(tag, 0.0)

    def _skip(self, tag: str, at: int) -> int | None:
        """Where an element that starts at ``at`` ends; None if it is to be read after all."""
        if tag == "p":  # ends where any block does
            stop = _BLOCK_EDGE.search(self._html, at)
            return len(self._html) if stop is None else stop.end() if stop[1].lower() == "/p" else stop.start()
        end = self._end_of(tag, at)
        if end is None:
            return None
        if tag == "form" and _PAGE_PARTS.search(self._html, at, end):  # a form around a whole page is a page
            return None
        if tag in _ENDS:  # ends where the next begins
            again = re.compile(rf"<{tag}(?=[\s/>])", re.IGNORECASE).search(self._html, at, end)
            return again.start() if again else end
        return end

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._link = False
        elif tag in BLOCKS:
            self._break()
            if self._open.get(tag) and tag not in ("html", "body"):
                self._close(tag)

    def _close(self, tag: str) -> None:
        while self._open.get(tag) and len(self._stack) > 1:
            if self._pop() == tag:
                break

    def _pop(self) -> str:
        tag = self.nodes[self._stack.pop()].tag
        self._open[tag] -= 1
        return tag

    def _text(self, text: str) -> None:
        if not text:
            return
        if self._block is None:
            if text.isspace():
                return
            self._block = Block(self._stack[-1], links=int(self._link))
        text = references.unescape(text) if "&" in text else text
        self._block.parts.append(text)
        if self._link:
            self._block.linked += len(text)

    def _break(self) -> None:
        """End the current block of text."""
        block, self._block = self._block, None
        if block is not None:
            block.text = _SPACE.sub(" ", "".join(block.parts)).strip()
            if block.text:
                block.linked = min(block.linked, len(block.text))
                self.blocks.append(block)

    def score(self) -> list[float]:
        """Points of each element, discounted by its share of linked text."""
        nodes = self.nodes
        for block in self.blocks:
            node = nodes[block.node]
            node.chars += len(block.text)
            node.linked += block.linked
            node.links += block.links
            points = (1 + block.text.count(",") + min(len(block.text) / 100, 3)) * (1 - block.linked / len(block.text))
            at = node.parent if node.tag in LEAVES and node.parent >= 0 else block.node
            for share in (1, 2, 4, 8, 16):
                if at < 0:
                    break
                nodes[at].points += points / share
                at = nodes[at].parent
        for node in reversed(nodes[1:]):  # children come after their parents
            parent = nodes[node.parent]
            parent.chars += node.chars
            parent.linked += node.linked
            parent.links += node.links
        return [n.points * (1 - n.linked / n.chars) if n.chars else 0.0 for n in nodes]

    def main_text(self) -> str:
        if not self.blocks:
            return ""
        nodes, points = self.nodes, self.score()
        best = max((i for i, n in enumerate(nodes) if n.tag not in LEAVES and n.chars), key=lambda i: (points[i], -i), default=0)
        around, at = None, best
        while at >= 0:
            if nodes[at].tag == "article":
                around = at
                break
            if nodes[at].tag == "main" and around is None:
                around = at
            at = nodes[at].parent
        best = best if around is None else around
        kept = [False] * len(nodes)
        parent, least = nodes[best].parent, max(10.0, 0.2 * points[best])
        dropped = [n.links > 1 and n.chars > 0 and n.linked > 0.6 * n.chars and n.tag not in _KEPT_ANYWAY and n.tag not in ("p", "article")
                   for n in nodes]
        for i, node in enumerate(nodes):
            if i == best:
                kept[i] = True
            elif node.parent == parent and parent >= 0:
                linked = node.linked / node.chars if node.chars else 1.0
                leaf = node.tag in LEAVES and nodes[best].tag != "article"
                kept[i] = (leaf and linked < 0.33) or (points[i] >= least and linked < 0.5)
            elif node.parent >= 0:
                kept[i] = kept[node.parent] and not dropped[i]
        return "\n\n".join(b.text for b in self.blocks if kept[b.node])


def extract(html: str | None) -> str:
    """The main text of a page."""
    return Page(html).main_text() if html else ""


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                texts = [extract(html) for html in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    rows = narrow(pages, ["page_id", "url", "html"]).select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
