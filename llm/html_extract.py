"""Main text of web pages by consensus paths per host.

First pass: every page's containers are scored by the text of their own
paragraphs outside links. The best one is widened to its article or main and
to ancestors that add running text, and votes for its generalised path (tags
with their classes, digits made equal). Votes are counted by (host, path) in
Spark. Second pass: each page is extracted again through the first winning
path of its host that covers most of the page's text outside links, widened
in the same way, so a page whose own scores mislead follows its siblings; a
page that no winning path covers keeps its own container.

Elements named like clutter are dropped, but not those that hold more text
than the rest of a page without other articles, or its only article: such
names are a layout's.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from bisect import bisect_left
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import checkpointed, table

MIN_SHARE = 0.05  # of its host's votes that a winning path has, so at most 20 paths win
SALT = 16

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_HIDDEN = {"script", "style", "template", "iframe", "svg", "head", "title", "object", "canvas", "nav", "footer", "aside",
           "button", "select", "textarea", "dialog", "menu"}
_WRAPS = {"form", "noscript"}  # clutter, unless they hold the page: server forms and pages for readers without scripts
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
_CONTAINER = {"article", "main", "section", "div", "body", "td", "blockquote"}
_BLOCK = _CONTAINER | _HEADING | {"p", "li", "ul", "ol", "dl", "dt", "dd", "pre", "table", "tr", "th", "thead", "tbody", "tfoot", "caption",
                                  "figure", "figcaption", "header", "address", "details", "summary", "fieldset", "hr", "html", "label", "legend"} | _HIDDEN | _WRAPS
_INNER = {"p", *_HEADING, "li", "dt", "dd", "tr", "td", "th"}  # closed by the next of its kind
_ENDS = {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}  # what else a start tag closes
_CLUTTER = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent",
            "notice", "notices", "alert", "nav", "navbar", "navigation", "menu", "sidebar", "footer", "header", "masthead", "comment",
            "comments", "respond", "reply", "replies", "disqus", "social", "share", "sharing", "newsletter", "subscribe", "subscription",
            "signup", "popup", "modal", "overlay", "related", "recommended", "breadcrumb", "breadcrumbs", "pagination", "widget", "login",
            "search", "toolbar", "skip", "paywall"}
# others' text and notices, which may be longer than the article: kept only if the page has nothing else
_ASIDE = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "comment", "comments", "respond", "reply",
          "replies", "disqus", "related", "recommended", "newsletter", "cookie", "cookies", "consent"}
_STATE = {"has", "no", "not", "with", "without", "hide"}  # has-sidebar says something of the layout, not of the element
_PROSE = _HEADING | {"p", "li", "dt", "dd", "pre", "blockquote", "td", "th", "caption", "figcaption"}
_LONG = 80  # characters outside links that make a block of another element running text
_ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar", "toolbar"}


class Node:
    __slots__ = ("blocks", "children", "clutter", "heads_only", "parent", "path", "soft", "tag")

    def __init__(self, tag, path, parent, heads_only, clutter=0, soft=False):
        self.tag, self.path, self.parent, self.heads_only, self.clutter, self.soft = tag, path, parent, heads_only, clutter, soft
        self.children, self.blocks = [], []


_NAME_END = re.compile(r"[\s/>]")
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_STOP = re.compile(r"""["'>]""")
_OPENS = re.compile(r"<(?:p|div|section|article|main|table|ul|ol|h[1-6])\b", re.I)
_CUT = re.compile(r"<[/!?a-zA-Z][^<>]*\Z")  # a tag that the page's end cuts off
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_END = re.compile(r"</([a-zA-Z][^\s/>]*)")
_RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "iframe")}


class _Ahead:
    """The next match of a pattern at or after a place; places only grow, so all
    questions together read the page once."""

    def __init__(self, pattern: re.Pattern, page: str):
        self.pattern, self.page, self.found = pattern, page, -1

    def at(self, start: int) -> int:
        if self.found < start:
            m = self.pattern.search(self.page, start)
            self.found = m.start() if m else len(self.page)
        return self.found


class _Tags:
    """Tags of a page from a place on: (start, end, slash, name, attributes).

    A tag ends at the first ``>`` outside quotes; one that does not end is
    text. Quotes from which no end was found are remembered, and so is the
    next quote or ``>``, so that broken pages are read in linear time too.
    """

    def __init__(self, page: str):
        self.page, self.name_end, self.stop, self.endless = page, _Ahead(_NAME_END, page), _Ahead(_STOP, page), set()
        self.last = page.rfind(">")

    def next(self, start: int) -> tuple[int, int, str, str, str] | None:
        page = self.page
        while (lt := page.find("<", start)) >= 0:
            start = lt + 1
            if page.startswith("!--", start):
                end = page.find("-->", start + 3)
                return lt, len(page) if end < 0 else end + 3, "", "", ""
            name = start + page.startswith("/", start)
            if page[name:name + 1] in _LETTERS:
                stop = self.name_end.at(name + 1)
                end = self._end(stop)
                if end:
                    return lt, end, page[start:name], page[name:stop], page[stop:end - 1]
            if start < len(page) and page[start] in "!?/" and self.last >= start:
                return lt, page.index(">", start) + 1, "", "", ""
        return None

    def _end(self, at: int) -> int:
        """Behind the ``>`` of a tag whose name ends at ``at``, or 0."""
        page, passed = self.page, []
        stop = self.stop.at(at)
        while stop < len(page) and self.last >= stop:
            if page[stop] == ">":
                return stop + 1
            if stop in self.endless:
                break
            passed.append(stop)
            shut = page.find(page[stop], stop + 1)
            if shut < 0:
                break
            m = _STOP.search(page, shut + 1)
            stop = m.start() if m else len(page)
        self.endless.update(passed)
        return 0


class _Tree:
    """Block elements with their text; inline tags only mark links and clutter."""

    def __init__(self, page: str):
        self.root = self.at = Node("", "", None, False)
        self.links = self.linked = 0
        self.text: list[str] = []
        self.cluttered = False
        self.wrappers: set[str] = set()  # inline tags that stand around blocks
        cut = page.rfind("<")
        page = page[:cut] if cut >= 0 and _CUT.match(page, cut) else page
        self.opens, self.ends, self.open_now = _Ahead(_OPENS, page), None, Counter()
        tags = _Tags(page)
        skip, depth, end, start = "", 0, 0, 0  # the hidden element that is open, how often it is nested
        while t := tags.next(start):
            at, after, slash, tag, attrs = t
            if not skip and at > end:
                self.data(page[end:at])
            start = end = after
            tag = tag.lower()
            if not tag:
                continue
            if skip:
                if tag == skip:
                    depth += -1 if slash else 0 if attrs.endswith("/") else 1
                elif slash and tag in ("body", "html", "article", "main"):
                    depth = 0
                    self.close(tag)
                if depth <= 0:
                    skip = ""
            elif slash:
                self.close(tag)
            elif self.open(tag, attrs, page, end) and tag not in _VOID and not attrs.endswith("/"):
                if tag in _RAW:
                    raw = _RAW[tag].search(page, end)
                    start = end = raw.end() if raw else len(page)
                else:
                    skip, depth = tag, 1
        if not skip and end < len(page):
            self.data(page[end:])
        self.flush()

    def shut(self, tag: str, page: str, end: int) -> int:
        """Where the next end tag of this name begins."""
        if self.ends is None:
            self.ends = {}
            for m in _END.finditer(page):
                self.ends.setdefault(m[1].lower(), []).append(m.start())
        places = self.ends.get(tag, [])
        k = bisect_left(places, end)
        return places[k] if k < len(places) else len(page)

    def data(self, text: str):
        if "&" in text:
            text = unescape(text)
        self.text.append(text)
        if self.links:
            self.linked += len(text)

    def flush(self):
        if self.text:
            text = " ".join("".join(self.text).split())
            lead = self.at.tag == "p" and len(text) - min(self.linked, len(text)) >= _LONG
            if text and (not self.at.heads_only or self.at.tag in _HEADING or lead):
                self.at.blocks.append((text, min(self.linked, len(text))))
                self.at.children.append(text)
            self.text, self.linked = [], 0

    def open(self, tag: str, attrs: str, page: str, end: int) -> bool:
        """Whether the element is hidden with all it holds."""
        said = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)} if "=" in attrs or "hidden" in attrs else {}
        if tag not in _BLOCK:
            if tag == "a":
                self.links += 1
            elif tag == "br":
                self.text.append(" ")
            clutter, soft = _cluttered(said) if said and tag not in _VOID and not attrs.endswith("/") else (0, False)
            block = self.opens.at(end) if clutter else len(page)
            if block >= len(page) or self.shut(tag, page, end) < block:
                return bool(clutter)
            self.wrappers.add(tag)
        else:
            clutter, soft = _cluttered(said) if said and tag not in ("html", "body", "article", "main", "hr") else (0, False)
            if tag in _WRAPS and clutter < 1:
                clutter, soft = 1, False
        self.flush()
        if tag == "hr":
            return False
        if tag in _HIDDEN or tag in ("label", "legend"):
            return True
        inside = self.at
        while inside.tag == "p" or inside.tag in _ENDS.get(tag, ()) or (tag in _INNER and (inside.tag in _HEADING or (inside.tag == tag and tag != "td"))):
            inside = inside.parent
        heads = inside.heads_only
        in_article = self.open_now["article"] + self.open_now["main"] > 0
        if tag == "header":
            if not in_article:
                return True
            heads = True
        names = sorted(set(re.sub(r"\d+", "0", said["class"]).split())) if "class" in said else ()
        self.leave(inside)
        # a path's digest stands for it: paths of deep pages are as long as the page
        path = hashlib.blake2b(f"{inside.path}/{'.'.join([tag, *names])}".encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
        self.at = Node(tag, path, inside, heads, clutter, soft and in_article)
        self.open_now[tag] += 1
        self.cluttered |= clutter > 0
        inside.children.append(self.at)
        return False

    def leave(self, node: Node):
        """Up to ``node``, an element around this one."""
        while self.at is not node:
            self.open_now[self.at.tag] -= 1
            self.at = self.at.parent

    def close(self, tag: str):
        if tag == "a":
            self.links = max(0, self.links - 1)
        if self.open_now[tag]:
            self.flush()
            node = self.at
            while node.tag != tag:
                node = node.parent
            self.leave(node.parent)


def _cluttered(said: dict) -> tuple[int, bool]:
    """0 no, 1 named like clutter, 2 named like others' text, 3 hidden or of a role;
    and whether 1 rests on a part of a name only (share-price)."""
    if "hidden" in said or said.get("aria-hidden", "").lower() == "true" or said.get("role", "").lower() in _ROLES:
        return 3, False
    found, soft = 0, True
    for token in f"{said.get('class', '')} {said.get('id', '')}".lower().split():
        words = [w for w in re.split(r"[^a-z]+", token) if w]
        if words and words[0] not in _STATE and not _CLUTTER.isdisjoint(words):
            found = max(found, 1 if _ASIDE.isdisjoint(words) else 2)
            soft &= not _CLUTTER.issuperset(words)
    return found, found == 1 and soft


def _in_order(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def _prune(root: Node):
    """Drops the clutter, but not an element that is named so and holds the page."""
    nodes = _in_order(root)
    if any(x.soft for x in nodes):  # inside an article such a name counts only for short or linked text
        sums = _sums(root)
        for x in nodes:
            if x.soft and sums[id(x)][1] >= _LONG and 2 * sums[id(x)][1] >= sums[id(x)][0]:
                x.clutter = 0
    whole: dict[int, list] = {}  # characters outside links, articles and mains that have any: without others' text
    core: dict[int, list] = {}  # the same without what any clutter below holds
    inner: dict[int, list[Node]] = {}  # the outermost clutter below
    for node in reversed(nodes):
        own = sum(len(t) - linked for t, linked in node.blocks)
        w, c, below = [own, 0], [own, 0], []
        for x in node.children:
            if isinstance(x, str) or x.clutter == 3:
                continue
            if x.clutter:
                below.append(x)
            else:
                c[0], c[1] = c[0] + core[id(x)][0], c[1] + core[id(x)][1]
                below += inner[id(x)]
            if x.clutter < 2:
                w[0], w[1] = w[0] + whole[id(x)][0], w[1] + whole[id(x)][1]
        if node.tag in ("article", "main"):
            w[1], c[1] = w[1] + (w[0] > 0), c[1] + (c[0] > 0)
        whole[id(node)], core[id(node)], inner[id(node)] = w, c, below

    def around(x):
        found = 0
        while x.parent is not None:
            x = x.parent
            found += x.tag in ("article", "main") and core[id(x)][0] > 0
        return found

    kept, (size, articles) = set(), core[id(root)]
    named = [x for x in inner[id(root)] if x.clutter == 1]
    if not whole[id(root)][0]:
        kept = {id(x) for x in nodes if x.clutter == 2}
    elif not size and 2 * max((whole[id(x)][0] for x in named), default=0) <= whole[id(root)][0]:
        kept = {id(x) for x in named}  # the text is dealt to several of them
    else:
        todo = [(-whole[id(x)][0], k, x) for k, x in enumerate(named)]
        heapq.heapify(todo)
        made = len(todo)
        while todo:
            less, _, x = heapq.heappop(todo)
            if (-less > size or whole[id(x)][1]) and articles <= around(x):
                kept.add(id(x))
                size, articles = size + core[id(x)][0], articles + core[id(x)][1]
                for y in inner[id(x)]:
                    if y.clutter == 1:
                        made += 1
                        heapq.heappush(todo, (-whole[id(y)][0], made, y))
    for node in nodes:
        if any(not isinstance(x, str) and x.clutter for x in node.children):
            node.children = [x for x in node.children if isinstance(x, str) or not x.clutter or id(x) in kept]


def parse(page: str | None) -> Node:
    tree = _Tree(page or "")
    if tree.cluttered:
        _prune(tree.root)
    return tree.root


def _text_of(node: Node, out: list[str]) -> list[str]:
    todo = [iter(node.children)]
    while todo:
        for c in todo[-1]:
            if isinstance(c, str):
                out.append(c)
            else:
                todo.append(iter(c.children))
                break
        else:
            todo.pop()
    return out


def scores(root: Node) -> dict[int, tuple[Node, float]]:
    """Score of every container: its own blocks' text outside links in full, its
    inner containers' text by half for each level."""
    out: dict[int, tuple[Node, float]] = {}
    around: dict[int, Node | None] = {id(None): None}  # the nearest container, the element itself included
    todo = [root]
    while todo:
        node = todo.pop()
        todo += [c for c in node.children if isinstance(c, Node)]
        around[id(node)] = node if node.tag in _CONTAINER else around[id(node.parent)]
        worth = sum(len(t) - 2 * linked + (10 if node.tag == "p" else 0) for t, linked in node.blocks)
        up, share = around[id(node)], 1.0
        while worth and up is not None and share > 0.1:
            extra = 1.25 if up.tag in ("article", "main") else 1.0
            out[id(up)] = (up, out.get(id(up), (up, 0.0))[1] + worth * share * extra)
            share /= 2
            up = around[id(up.parent)]
    return out


def _sums(root: Node) -> dict[int, list[int]]:
    """Of every element with all it holds: characters, those outside links, those
    of running text, those in an article, a main or a headline."""
    nodes = _in_order(root)
    out = {id(n): [0, 0, 0, 0] for n in nodes}
    for node in reversed(nodes):
        mine = out[id(node)]
        for t, linked in node.blocks:
            free = len(t) - linked
            mine[0] += len(t)
            mine[1] += free
            mine[2] += free if node.tag in _PROSE or free >= _LONG else 0
        if node.tag in ("article", "main", "h1"):
            mine[3] = mine[1]
        if node.parent is not None:
            for k, x in enumerate(mine):
                out[id(node.parent)][k] += x
    return out


def _widened(node: Node, sums: dict[int, list[int]]) -> Node:
    """The nearest article or main, and then each ancestor of which at least half
    of what it adds is running text; beyond articles and mains, text of another
    article or a headline."""
    above = [node]
    while above[-1].parent is not None:
        above.append(above[-1].parent)
    tops = [k for k, x in enumerate(above) if x.tag in ("article", "main")]
    at = tops[0] if tops else 0
    for k in range(at + 1, len(above)):
        more, had = sums[id(above[k])], sums[id(above[at])]
        what = 3 if tops and k > tops[-1] else 2
        if 2 * (more[what] - had[what]) >= more[0] - had[0] > 0:
            at = k
    return above[at]


def best_container(root: Node, sums: dict[int, list[int]] | None = None) -> Node | None:
    found = scores(root)
    return _widened(max(found.values(), key=lambda x: x[1])[0], _sums(root) if sums is None else sums) if found else None


def extract(page: str | None, paths: list[str] | None) -> str:
    """Text through the first of ``paths`` that covers most of the page's text
    outside links, else through the page's own best container."""
    root = parse(page)
    sums = _sums(root)
    if paths:
        by: dict[str, list[Node]] = {}
        for node in _in_order(root):
            by.setdefault(node.path, []).append(node)
        for p in paths:
            nodes = [n for n in by.get(p, []) if sums[id(n)][0]]
            if nodes and 2 * sum(sums[id(n)][1] for n in nodes) >= sums[id(root)][1]:
                wide = {id(n): n for n in (_widened(n, sums) for n in nodes)}
                nodes = [n for n in wide.values() if not _below(n, wide)]
                return "\n".join(t for n in nodes for t in _text_of(n, []))
    return "\n".join(_text_of(best_container(root, sums) or root, []))


def _below(node: Node, others: dict[int, Node]) -> bool:
    while node.parent is not None:
        node = node.parent
        if id(node) in others:
            return True
    return False


def _host(url: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars), one row per input row.

    Null and empty pages have the empty text; pages with a null or odd url
    share the empty host. Ties between paths go to the one with more text,
    then to the first in order. Null ids and repeated rows are kept; other
    columns are ignored.
    """
    src = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    src = src.withColumn("host", _host("url"))

    def vote(batches):
        for b in batches:
            host, path, size = [], [], []
            for h, html in zip(b["host"].to_pylist(), b["html"].to_pylist()):
                node = best_container(parse(html))
                if node is not None:
                    host.append(h)
                    path.append(node.path)
                    size.append(sum(map(len, _text_of(node, []))))
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(size, pa.int64())],
                                             names=["host", "path", "size"])

    votes = (src.select("host", "html").mapInArrow(vote, "host string, path string, size bigint")
             .groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("size").alias("size")))
    votes = checkpointed(votes)
    total = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    ranked = (votes.join(total, "host").where(F.col("votes") >= F.col("total") * min_share).groupBy("host")
              .agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), (-F.col("size")).alias("s"), "path"))).alias("p"))
              .select("host", F.transform("p", lambda x: x["path"]).alias("paths")))
    # a hot host is spread over SALT keys; the other side is one row a host and salt
    ranked = checkpointed(ranked).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    both = src.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALT)).cast("int")).join(ranked, ["host", "salt"], "left")

    def run(batches):
        for b in batches:
            text = [extract(h, p) for h, p in zip(b["html"].to_pylist(), b["paths"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return both.select("page_id", "url", "html", "paths").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op4_html_extraction(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))
