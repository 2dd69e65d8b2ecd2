"""Main text of web pages by the consensus of their hosts.

1. Every page is parsed once; its containers are scored by the text of their paragraphs, less text in links. The path of
   the best one, tags and classes with digits generalised, is the page's vote.
2. Spark counts the votes of each host and joins all of them with the paths of each page; of those that hold a fair
   share of the page's text the one with the most wins.
3. Every page is read again: the text is taken from the containers on its winning path.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out in both
readings, by their tags and by the words in their classes and ids. Sites also wrap their articles in such elements, and
forget to close them; so what they hold is read as a zone of its own, and whether a zone is left out is decided when the
whole page is known (see ``Page.decide``).
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.llm.rows import map_texts, without
from agentlake.llm.storage import materialize

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CONTAINERS = frozenset("article main section div td body center fieldset details figure blockquote".split())
BLOCKS = CONTAINERS | frozenset(
    "html head address aside caption dd dl dt figcaption footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li menu nav ol "
    "option p pre summary table tbody tfoot th thead tr ul".split())
#: Elements that the start of others closes: (starting tags, closed tags, tags that shield an outer one).
CLOSES = (
    (BLOCKS - {"option", "li", "dd", "dt", "tr", "td", "th", "tbody", "thead", "tfoot"}, {"p"}, {"button", "td", "th", "div", "article", "section", "li"}),
    ({"li"}, {"li", "p"}, {"ul", "ol", "menu"}),
    ({"dd", "dt"}, {"dd", "dt", "p"}, {"dl"}),
    ({"td", "th"}, {"td", "th", "p"}, {"tr", "table"}),
    ({"tr"}, {"tr", "td", "th", "p"}, {"table"}),
    ({"tbody", "thead", "tfoot"}, {"tbody", "thead", "tfoot", "tr", "td", "th", "p"}, {"table"}),
    ({"option"}, {"option"}, {"select"}),
)

# What is never main text.
SKIPPED_TAGS = frozenset("script style noscript template iframe svg math object canvas audio video button select textarea input head title".split())
#: The same, but articles inside of them count.
ZONE_TAGS = frozenset("nav header footer aside form dialog menu".split())
#: Elements often left open: (tag, what may stand inside); anything else of the blocks ends an open one.
LEFT_OPEN = {"nav": frozenset("ul ol li menu p dl dd dt hr".split()), "select": frozenset("option hr".split()), "form": frozenset("p ul ol li dl dd dt fieldset legend table tbody tr td th option hr".split())}
#: What may stand in a head.
HEAD_TAGS = frozenset("head html base basefont bgsound link meta title style script noscript template".split())
SKIPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu footer "
    "comment comments commentlist disqus respond replies share sharing social related recommended recommendations cookie cookies "
    "consent gdpr popup modal newsletter subscribe subscription signup login breadcrumb breadcrumbs pagination pager".split())
#: Left out unless another word says that it holds the text.
DOUBTFUL_WORDS = frozenset("sidebar side header masthead widget widgets notice notices alert banner toolbar search tags meta legal copyright skip hidden outbrain taboola".split())
TEXT_WORDS = frozenset("article content post entry story body main text".split())
#: What follows these in a class or id tells what an element is about or comes with, not what it is.
WITH_WORDS = frozenset("with without has no".split())
#: The same where a name starts so, menus of categories and tags excepted.
TOPIC_WORDS = frozenset("category tag".split())
MENU_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs pagination pager".split())

_MARKUP = re.compile(r"""<(?:!--(?:.*?)(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]|"[^"<]*"|'[^'<]*')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|$)""", re.I)
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_LETTERS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")

def _named(name: str) -> set[str]:
    """Words of a class or id that name the element itself."""
    words = _LETTERS.findall(name)
    if words and words[0] in TOPIC_WORDS and not MENU_WORDS.intersection(words):
        return set()
    return set(words[: next((k for k, w in enumerate(words) if w in WITH_WORDS), None)])


def _left_out(tag: str, names: list[str], role: str, inner: bool) -> bool:
    """Whether names (the id first, then classes) and role say that an element is not main text. Articles and main
    elements are kept, but for articles inside of others (``inner``), which hold comments too. A name with text words
    and no skipped ones keeps an element, unless its id or role says nothing but skipped words."""
    if tag in ("article", "main") and not inner:
        return False
    named = [_named(n) for n in names]
    skipped = [bool(w & SKIPPED_WORDS) for w in named]
    if not SKIPPED_WORDS.isdisjoint(_LETTERS.findall(role)) or (named[0] and named[0] <= SKIPPED_WORDS):
        return True
    if any(skipped) and not any(w & TEXT_WORDS and not s for w, s in zip(named, skipped)) and not (role == "main"):
        return True
    words = set(_LETTERS.findall(" ".join([*names, role])))
    return tag not in ("article", "main") and bool(set().union(*named, _LETTERS.findall(role)) & DOUBTFUL_WORDS) and not words & TEXT_WORDS


#: What a block counts for the containers further out.
OUTER_SHARE = 0.5
#: What text in links takes away.
LINK_COST = 3
#: Characters of text that a zone with a doubtful name must have to be all of a page.
PARAGRAPHS = 200
#: Of the paragraph text in the page's own best container, what a winning path must hold on the page.
SHARE = 0.25


@dataclass
class Zone:
    """A part of the page whose text counts or not as a whole, without the zones inside of it."""

    kind: str  # "page"; left out: "tag" or "named" (by a name that ends in another word), "held" (form, hidden); "text" inside of those
    outer: int
    size: int = 0
    filled: bool = False
    open: bool = False


class Page:
    """Blocks of text and the containers that they stand in. Node 0 stands for the page itself, zone 0 for what is read
    in any case. ``open_tags``: places of start tags that are known to lack an end tag."""

    def __init__(self, html: str, open_tags: frozenset[int] = frozenset()):
        self.parent, self.path, self.container = [-1], [""], [True]
        self.blocks: list[tuple[int, str, int]] = []  # (innermost container, text, characters in links)
        self.zones = [Zone("page", -1, open=True)]
        self._all: list[tuple[int, tuple[int, str, int]]] = []  # blocks of all zones, the zone before each
        self._parts: list[str] = []
        self._links, self._stack = 0, [(0, "", 0, -1)]  # (node, tag, zone or -1 for nothing at all, place)
        self._in_link = 0
        self._main = 0  # characters in articles and main elements of zone 0
        self._unclosed: set[int] = set()
        self._known = open_tags
        at = 0
        for m in _MARKUP.finditer(html):
            if m.start() < at:
                continue
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self._close(tag)
            else:
                self._open(tag, m[3] if m[2] else m[6], m.start())
                if tag in RAW:
                    end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                    at = end.start() if end else len(html)
        if at < len(html):
            self._text(html[at:])
        self._flush()
        self._cut(1)
        if self._unclosed and not open_tags:
            self.__init__(html, frozenset(self._unclosed))  # read again, each of them ending where its kind of content does
        else:
            self.decide()

    def decide(self) -> None:
        """Which zones count. Sizes are characters of text, less what links take away.

        - A form, or an element that is not shown, that holds more than all of zone 0 counts as a whole.
        - Articles, main elements and text containers inside of zones count where zone 0 has no article or main element
          with text and they hold more than it: the zone is a wrapper, not a list of comments beside the article. Those
          in zones whose names say nothing but that they are left out count only if no others do, and each by itself.
        - On a page without any text so far, the largest zone counts whose name ends in another word, if its text is
          that of paragraphs.
        """
        page = self.zones[0]
        if not self._main:
            for zone in self.zones:
                zone.open = zone.open or (zone.kind == "held" and zone.size > page.size)
            texts = [z for z in self.zones if z.kind == "text" and not self._in_text(z)]
            wrapped = [z for z in texts if self.zones[z.outer].kind != "tag"]
            if sum(z.size for z in wrapped) > page.size:
                texts = wrapped
            else:
                texts = [z for z in texts if z.size > page.size]
            for zone in texts:
                zone.open = True
        if not any(z.open and z.filled for z in self.zones):
            named = [z for z in self.zones if z.kind == "named" and z.size >= PARAGRAPHS]
            if named:
                max(named, key=lambda z: z.size).open = True
        self.blocks = [block for zone, block in self._all if self.zones[zone].open]

    def _in_text(self, zone: Zone) -> bool:
        while zone.outer > 0:
            zone = self.zones[zone.outer]
            if zone.kind == "text":
                return True
        return False

    def _text(self, text: str) -> None:
        if self._stack[-1][2] >= 0:
            text = unescape(text) if "&" in text else text
            self._parts.append(text)
            if self._in_link:
                self._links += len("".join(text.split()))

    def _flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            node = self._stack[-1][0]
            number = next(z for _, _, z, _ in reversed(self._stack) if z >= 0)
            while not self.container[node]:
                node = self.parent[node]
            self._all.append((number, (node, text, self._links)))
            zone = self.zones[number]
            zone.size, zone.filled = zone.size + max(0, len(text) - LINK_COST * self._links), True
            if number == 0 and any(t in ("article", "main") for _, t, _, _ in self._stack):
                self._main += len(text)
        self._parts, self._links = [], 0

    def _open(self, tag: str, attributes: str, place: int) -> None:
        if tag == "br":
            self._parts.append(" ")
            return
        if tag not in HEAD_TAGS and self._stack[-1][1] == "head":
            self._cut(len(self._stack) - 1)
        if tag in BLOCKS:
            self._flush()
            for starting, closed, shields in CLOSES:
                if tag in starting:
                    for k in range(len(self._stack) - 1, 0, -1):
                        if self._stack[k][1] in closed:
                            self._cut(k)
                        elif self._stack[k][1] in shields:
                            break
            if self._known:
                for k in range(1, len(self._stack)):
                    if self._stack[k][3] in self._known and tag not in LEFT_OPEN[self._stack[k][1]]:
                        self._cut(k)
                        break
        if tag in VOID:
            return
        node, _, zone, _ = self._stack[-1]
        label = tag
        if zone >= 0:
            label, zone = self._zone(tag, attributes, zone)
        if tag in BLOCKS:
            self.parent.append(node)
            self.path.append(f"{self.path[node]}/{label}")
            self.container.append(tag in CONTAINERS)
            node = len(self.parent) - 1
        self._in_link += tag == "a"
        self._stack.append((node, tag, zone, place))

    def _zone(self, tag: str, attributes: str, zone: int) -> tuple[str, int]:
        """The element's label in paths, and the zone of its text."""
        classes, names, role, hidden = [], [""], "", False
        for a in _ATTRIBUTE.finditer(attributes) if attributes else ():
            name, value = a[1].lower(), (a[2] or "").strip("\"'").lower()
            if name == "class":
                classes = sorted(set(_DIGITS.sub("#", value).split()))
                names += value.split()
            elif name == "id":
                names[0] = value
            elif name == "role":
                role = value
            elif name == "style":
                hidden = hidden or bool(_NOT_SHOWN.search(value))
            hidden = hidden or name == "hidden" or (name == "aria-hidden" and value == "true" and tag in BLOCKS)
        label = ".".join([tag, *classes])
        if tag in SKIPPED_TAGS:
            return label, -1
        if tag in ("html", "body"):
            return label, zone
        named = len(names) > 1 or names[0] or role
        inner = tag == "article" and any(t == "article" for _, t, _, _ in self._stack)
        kind = None
        if named and _left_out(tag, names, role, inner):
            ends = [w[-1] for n in names if (w := _LETTERS.findall(n))]
            kind = "named" if any(w not in SKIPPED_WORDS and w not in DOUBTFUL_WORDS for w in ends) else "tag"
        elif tag in ZONE_TAGS:
            kind = "held" if tag == "form" else "tag"
        elif hidden:
            kind = "held"
        elif zone and self.zones[zone].kind != "text" and (tag in ("article", "main") or any(_named(n) & TEXT_WORDS for n in names)):
            kind = "text"
        if kind is None:
            return label, zone
        if tag not in BLOCKS:
            return label, zone if kind == "text" else -1
        self.zones.append(Zone(kind, zone))
        return label, len(self.zones) - 1

    def _cut(self, k: int) -> None:
        """End the elements from the k-th on, none of them by an end tag of its own."""
        self._unclosed.update(place for _, t, _, place in self._stack[k:] if t in LEFT_OPEN)
        self._drop(k)

    def _drop(self, k: int) -> None:
        self._in_link -= sum(t == "a" for _, t, _, _ in self._stack[k:])
        del self._stack[k:]

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k][1] == tag:
                self._unclosed.update(place for _, t, _, place in self._stack[k + 1 :] if t in LEFT_OPEN)
                self._drop(k)
                return

    def best(self) -> str | None:
        """Path of the container with the most paragraph text; None on a page without text."""
        own: dict[int, float] = defaultdict(float)
        for node, text, links in self.blocks:
            own[node] += max(0, len(text) - LINK_COST * links)
        total: dict[int, float] = defaultdict(float)
        for node, value in own.items():
            share = value
            while node >= 0:
                if self.container[node]:
                    total[node] += share
                    share *= OUTER_SHARE
                node = self.parent[node]
        if not self.blocks:
            return None
        return self.path[max(total, key=lambda n: (total[n], -n))]

    def candidates(self) -> list[str]:
        """Distinct paths of containers with text below whose paragraph text is at least the share ``SHARE`` of that of
        the best container."""
        values: dict[str, int] = defaultdict(int)
        for node, text, links in self.blocks:
            paths = set()
            while node >= 0:
                if self.container[node]:
                    paths.add(self.path[node])
                node = self.parent[node]
            for path in paths:
                values[path] += max(0, len(text) - LINK_COST * links)
        best = self.best()
        most = values[best] if best is not None else 0
        return [p for p, v in values.items() if v >= SHARE * most]

    def text(self, path: str) -> str:
        """Blocks below containers on the path, in page order."""
        inside = [False] * len(self.path)
        for node in range(len(self.path)):
            inside[node] = (self.container[node] and self.path[node] == path) or (self.parent[node] >= 0 and inside[self.parent[node]])
        return "\n".join(t for node, t, _ in self.blocks if inside[node])


def main_text(html: str | None, winner: str | None) -> str:
    """Text of the containers on the winning path, or of the page's own best one."""
    page = Page(html or "")
    text = page.text(winner) if winner is not None else ""
    if text:
        return text
    best = page.best()
    return page.text(best) if best is not None else ""


#: Pages of a host that are counted and joined together.
PART_PAGES = 256


def page_paths(pages: DataFrame) -> DataFrame:
    """(host, part, page, path, own): a row for each path that may win on each page, and whether it is the page's own
    vote. Pages are known by digests of their html, and stay in one part."""

    def make():
        def run(part: pa.RecordBatch) -> list:
            made = [Page(h or "") for h in part.column("html").to_pylist()]
            return [[p.best() for p in made], [p.candidates() for p in made]]

        return run

    fields = [("best", T.StringType()), ("paths", T.ArrayType(T.StringType()))]
    voted = map_texts(pages, fields, make, text="html", keep=["host", "part", "page"])
    rows = voted.select("host", "part", "page", "best", F.explode("paths").alias("path"))
    return rows.withColumn("own", F.col("path") == F.col("best")).drop("best")


def path_votes(paths: DataFrame) -> DataFrame:
    """(host, path, part, votes): all votes of each path that has any, in each part where pages have the path."""
    counted = paths.groupBy("host", "path", "part").agg(F.sum(F.col("own").cast("long")).alias("votes"))
    whole = counted.withColumn("votes", F.sum("votes").over(Window.partitionBy("host", "path")))
    return whole.where("votes > 0")


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, winners): the paths that the pages of each host voted for, most votes first, then by name."""
    paths = page_paths(pages.select("host", "html", F.lit(0).alias("part"), F.lit(None).cast("binary").alias("page")))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("order"), "path")))
    return path_votes(paths).groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("winners"))


def page_winners(paths: DataFrame) -> DataFrame:
    """(host, part, page, winner): of the paths that may win on each page, the one with the most votes at its host, then
    by name."""
    place = F.struct((-F.col("votes")).alias("order"), "path")
    joined = paths.join(path_votes(paths), ["host", "path", "part"])
    return joined.groupBy("host", "part", "page").agg(F.min(place)["path"].alias("winner"))


def host_parts(rows: DataFrame, part_pages: int) -> int:
    """Parts that the largest host needs, for parts of about ``part_pages`` pages. One number, so that no join has to tell
    pages their host's; smaller hosts take as many parts, most of them empty."""
    largest = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return max(1, -(-(largest or 0) // part_pages))


def extract_pages(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``pages`` (or those of ``keep``) with ``text`` and ``n_chars`` (its code points).

    ``pages`` needs ``url`` and ``html``. Character references are decoded, white space inside a block becomes one
    space, blocks are joined by line feeds in page order. The host is what stands between ``//`` and the next ``/``,
    ``?`` or ``#`` of the url, in lower case, without user and port; urls without one (and null) vote together as "".
    Null and empty pages, and pages without text, get the empty string. Each row is extracted by itself, repeated ones
    too; input columns called ``text`` or ``n_chars`` are replaced. Broken markup is read as far as it goes.
    """
    names = ["text", "n_chars"]
    pages = without(pages, names)
    keep = [c for c in (keep or pages.columns) if c.lower() not in names]
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), host.alias("host"), F.col("html").cast("string"))
    # A host may own a third of all pages, and so may one text: pages are dealt to parts, so that no join key holds all of them.
    part = F.pmod(F.xxhash64("html", "row"), F.lit(host_parts(rows, PART_PAGES))).cast("int")
    rows = rows.withColumns({"part": part, "page": F.unhex(F.sha2("html", 256))})
    paths = materialize(page_paths(rows.select("host", "part", "page", "html")), "paths")
    joined = rows.join(page_winners(paths), ["host", "part", "page"], "left")

    def make():
        def run(part: pa.RecordBatch) -> list:
            texts = [main_text(h, w) for h, w in zip(part.column("html").to_pylist(), part.column("winner").to_pylist())]
            return [texts, [len(t) for t in texts]]

        return run

    return map_texts(joined, [("text", T.StringType()), ("n_chars", T.LongType())], make, text="html", keep=["row"]).select("row.*", *names)
