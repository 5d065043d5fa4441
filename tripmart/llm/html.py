"""Main text of web pages by consensus paths of their host.

Every page scores its containers: a block of text counts for its container and
by half for the one around it, link text does not count. From the best container
a page climbs to the article or main around it; without these, to the outermost
container below body that adds text, and to body if text stands in it directly.
So headlines, leads and further sections are kept. The page votes for the
generalised tag and class path of the container reached. Spark sums the votes per
host (combined inside map tasks, so a host with a third of all pages is no hot
key); the best path of a host wins. Pages are then extracted again from all
containers at their host's path; a page without one uses its own best.

Blocks end at block-level tags. Inside a block references are decoded and
white space becomes one space; blocks are joined by one line break in page
order, repeats included.

Defined results: null or empty html, and pages without text, give an empty
text; a null or unusual url counts as the host ''. Rows repeat as they come.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.shared import small_side, stored

# Elements by their part in a page.
_CONTAINERS = frozenset("html body main article section div center".split())
_BLOCKS = _CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption thead tbody tfoot tr td th figure "
    "figcaption hr address details summary fieldset header footer nav aside form dialog hgroup search menu".split()
)
_DROPPED = frozenset(
    "head nav aside footer form dialog menu search button select option textarea svg canvas object map".split()
)
_RAW = ("script", "style", "noscript", "template", "iframe", "title", "textarea")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ROLES = frozenset(
    "navigation banner complementary contentinfo search dialog alertdialog alert menu menubar toolbar form".split()
)
# Class and id words of elements that are not the article, and of those that may be.
_ASIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar "
    "side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr "
    "notice notices alert disclaimer newsletter subscribe subscription signup login comment comments "
    "commentlist reply replies respond disqus related recommended recommendations share sharing social widget "
    "popup modal overlay pagination pager toolbar skip".split()
)
_MAYBE = frozenset("content article main post entry story body text page wrapper container layout".split())
_ARTICLE_ASIDE = frozenset("ad ads advert sponsored promo comment comments reply related recommended".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PART = re.compile(r"[a-z]+")


class Page:
    """Blocks and containers of one page."""

    def __init__(self, html: str):
        self.blocks: list[tuple[str, int, int]] = []  # text, container, letters outside links
        self.paths: list[str] = [""]
        self.names: list[str] = [""]
        self.parents: list[int] = [0]
        self._stack: list[tuple[str, bool, int]] = [("", False, 0)]
        self._parts: list[str] = []
        self._linked = 0
        self._in_link = False
        self._read(html)
        self._flush()

    def _text(self, raw: str) -> None:
        if raw and not self._stack[-1][1]:
            text = unescape(raw) if "&" in raw else raw
            self._parts.append(text)
            if self._in_link:
                self._linked += len(text.strip())

    def _flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.blocks.append((text, self._stack[-1][2], max(0, len(text) - self._linked)))
        self._parts, self._linked = [], 0

    def _read(self, html: str) -> None:
        at, low = 0, None
        while True:
            token = _TOKEN.search(html, at)
            if token is None:
                self._text(html[at:])
                return
            self._text(html[at : token.start()])
            at = token.end()
            name = token[2] or token[5]
            if name is None:
                continue
            name = name.lower()
            if token[1] or token[4]:
                self._end(name)
                continue
            if name in _RAW:
                # The content is no markup: skip to the end tag, or to the end of the page.
                low = html.lower() if low is None else low
                end = low.find(f"</{name}", at)
                if name != "noscript" or end >= 0:
                    at = len(html) if end < 0 else end
                continue
            self._start(name, token[3] or token[6] or "")

    def _aside(self, name: str, attributes: str) -> tuple[bool, str]:
        """Whether an element is outside the article, and its path step."""
        words: list[str] = []
        classes: list[str] = []
        role = ""
        if attributes:
            for key, a, b, c in _NAMED.findall(attributes):
                value, key = a or b or c, key.lower()
                if key == "role":
                    role = value.strip().lower()
                    continue
                parts = _PART.findall(_CAMEL.sub("-", value).lower())
                words += parts
                if key == "class":
                    classes += parts
        step = name + "".join(f".{w}" for w in sorted(set(classes)))
        if name in ("html", "body", "main"):
            return False, step
        if name == "article":
            return bool(_ARTICLE_ASIDE.intersection(words)), step
        if name == "header":
            inside = any(s[0] in ("article", "main") for s in self._stack)
            return not inside, step
        aside = bool(_ASIDE.intersection(words)) and not _MAYBE.intersection(words)
        return name in _DROPPED or role in _ROLES or aside, step

    def _start(self, name: str, attributes: str) -> None:
        block = name in _BLOCKS
        if block:
            self._flush()
            self._in_link = False
            if self._stack[-1][0] == "p":
                self._stack.pop()
        if name == "body":
            while self._stack[-1][0] == "head":
                self._stack.pop()
        if name == "br":
            self._text(" ")
        if name in _VOID or attributes.endswith("/") and not block:
            return
        if name == "a":
            self._in_link = True
        _, dropped, container = self._stack[-1]
        if dropped:
            # Inside a dropped element only its namesakes and containers matter, to find its end.
            if name == self._dropping() or name in _CONTAINERS:
                self._stack.append((name, True, container))
            return
        aside, step = self._aside(name, attributes)
        if aside:
            self._flush() if block else None
            self._stack.append((name, True, container))
        elif name in _CONTAINERS:
            self.paths.append(f"{self.paths[container]}>{step}")
            self.names.append(name)
            self.parents.append(container)
            self._stack.append((name, False, len(self.paths) - 1))

    def _dropping(self) -> str:
        for name, dropped, _ in self._stack:
            if dropped:
                return name
        return ""

    def _end(self, name: str) -> None:
        if name in _BLOCKS:
            self._flush()
        if name == "a":
            self._in_link = False
        if self._stack[-1][1]:
            # A dropped element ends with its own end tag or with that of an open container.
            if name != self._dropping() and name not in _CONTAINERS:
                return
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i][0] == name:
                del self._stack[i:]
                return

    def scores(self) -> list[float]:
        own = [0.0] * len(self.paths)
        for _, container, letters in self.blocks:
            own[container] += letters
            own[self.parents[container]] += letters / 2 if container else 0
        return own

    def _around(self, at: int) -> int:
        """The container that holds the whole article of which ``at`` is a part."""
        chain = [at]
        while chain[-1]:
            chain.append(self.parents[chain[-1]])
        marked = [i for i in chain if self.names[i] in ("article", "main")]
        if marked:
            return marked[-1]
        direct = [0] * len(self.paths)
        for text, container, letters in self.blocks:
            direct[container] += letters if any(map(str.isalnum, text)) else 0
        inside = direct[:]
        for i in range(len(inside) - 1, 0, -1):
            inside[self.parents[i]] += inside[i]
        for i in chain:
            adds = direct[i] > 0 if self.names[i] in ("", "html", "body") else inside[i] > inside[at]
            at = i if adds else at
        return at

    def best(self) -> tuple[str, float]:
        """Path of the article around the best container, and that one's score; ties go to the earlier one."""
        own = self.scores()
        at = max(range(len(own)), key=lambda i: (own[i], -i))
        return self.paths[self._around(at)], own[at]

    def extract(self, path: str) -> str:
        """Text of all containers at a path, of the best one if there is none with text."""
        inside = [False] * len(self.paths)
        for i, own in enumerate(self.paths):
            inside[i] = own == path or (i > 0 and inside[self.parents[i]])
        texts = [t for t, c, _ in self.blocks if inside[c]]
        if not texts and self.blocks and self.best()[0] != path:
            return self.extract(self.best()[0])
        return "\n".join(texts)


def _vote(batches):
    for batch in batches:
        found = [Page(h.as_py() or "").best() for h in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array([p for p, _ in found], pa.string()), pa.array([int(s) for _, s in found], pa.int64())],
            ["host", "path", "letters"],
        )


def _extract(batches):
    for batch in batches:
        texts = [
            Page(h.as_py() or "").extract(p.as_py() or "") for h, p in zip(batch.column("html"), batch.column("path"))
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.select(["page_id", "url"]).columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """host and path: the path with most votes, then most letters, then the smallest."""
    votes = (
        pages.select("host", "html")
        .mapInArrow(_vote, "host string, path string, letters bigint")
        .where("letters > 0")
        .groupBy("host", "path")
        .agg(F.count("*").alias("votes"), F.sum("letters").alias("letters"))
    )
    best = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("letters"), "path")
    return votes.withColumn("place", F.row_number().over(best)).where("place = 1").select("host", "path")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit(""))).alias("host"),
    )
    paths = stored(host_paths(pages), "html-paths")
    return pages.join(small_side(paths), "host", "left").select("page_id", "url", "html", "path").mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint"
    )
