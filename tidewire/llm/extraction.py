"""Main text of web pages by composite text density.

Every DOM node gets characters per tag, adjusted by how much of it sits in links relative to the whole
body.  A node's density sum adds up the densities of its block children; the subtree with the largest sum is the
core of the article.  The lowest density on the path from the core up to the body is the threshold, and neighbors along
that path that reach it belong to the article too.  Article and main elements don't choose text: one around the core widens it (with
its headings and short parts), one with most of the core's text narrows it.

Elements that say they are navigation, header, footer, sidebar, notice, advert, form, script, style or
reader comments (by name, role, class or id) are cut off before densities are computed.  Classes and ids only count where
the text agrees: what holds an article, main or h1 element or most of the body's unlinked characters stays (comments and adverts may
outweigh an article, so they stay where they are nearly all of it and no such element is elsewhere), and names that layouts also use inside longer words
cut link lists only.

Defined cases: null, empty or text-free html gives an empty string; a tag with an unclosed quote ends at its first ``>``, and
what no ``>`` follows is text; other broken markup is read as far as it goes; repeated rows are extracted once each; an empty table gives no rows; further columns are ignored.

Plan: one pass over the table, no shuffle; memory is one Arrow batch and one page's nodes.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes noembed".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img".split()
)
DROPPED = frozenset(
    "head nav footer aside form script style noscript template iframe object embed svg math canvas audio video select "
    "button input textarea dialog menu option datalist map frameset".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion promoted "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login paywall nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidebars rail widget widgets related "
    "recommended recommendations share sharing social comment comments commentlist disqus respond replies footer header "
    "masthead toolbar pagination pager skip copyright".split()
)
#: Of these, what readers or advertisers write; such a part can be longer than the article.
FOREIGN = frozenset(
    "comment comments commentlist disqus respond replies ad ads adv advert adverts advertisement advertisements advertising adsense sponsored cookie cookies consent gdpr".split()
)
#: Of these, words that are part of names of content too (``social-science``, ``elementor-widget``): alone they count, inside a name with link lists.
AMBIGUOUS = frozenset("social widget widgets notice notices alert rail skip login copyright promotion subscription related respond replies header footer menu".split())
#: Foreign parts with this share of the body's unlinked characters are the page's text.
NEARLY_ALL = 0.9

_TAG = re.compile(r"<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)")
_MARK = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"(?:^|[\s/\"'])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?=[\s/]|$)", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SOLE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}


class _Node:
    __slots__ = ("tag", "parent", "children", "dropped", "chars", "tags", "link_chars", "link_tags", "density", "total", "named")

    def __init__(self, tag: str, parent: _Node | None, dropped: bool, named: str = ""):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.named = named  # what its class and id say: "", "maybe", "boilerplate" or "foreign"
        self.children: list = []  # nodes and texts in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _is_boilerplate(tag: str, attrs: str, inside_article: bool) -> bool:
    if tag in DROPPED or tag == "header" and not inside_article:
        return True
    if not attrs:
        return False
    for name, value in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name == "role" and value.lower() in DROPPED_ROLES:
            return True
    return False


def _named(attrs: str, inside_article: bool) -> str:
    """What class and id words say of an element."""
    found = ""
    for name, value in _ATTRIBUTE.findall(attrs):
        if name.lower() not in ("class", "id"):
            continue
        for word in value.strip("\"'").split():
            parts = [p.lower() for p in _NAME_PART.findall(word)]
            if parts and parts[0] in ("has", "with", "no", "without") or inside_article and "header" in parts:
                continue
            names = DROPPED_NAMES.intersection(parts)
            if names & FOREIGN and (len(parts) == 1 or names - AMBIGUOUS):
                return "foreign"
            if names and (len(parts) == 1 or names - AMBIGUOUS):
                found = "boilerplate"
            elif names:
                found = found or "maybe"
    return found


class _Tags:
    """Ends of a page's tags.  Where a tag has been found to have none is remembered, so a page is read in linear time."""

    def __init__(self, page: str):
        self._page, self._last = page, page.rfind(">")
        self._endless: set[int] = set()  # places outside quotes from which an unclosed quote follows

    def start(self, pos: int) -> re.Match | None:
        return _TAG.match(self._page, pos) if pos < self._last else None

    def end(self, pos: int) -> int:
        """Behind the first ``>`` outside quotes; where a quote is never closed, behind the first one at all."""
        seen, at = [], pos
        while at not in self._endless and (mark := _MARK.search(self._page, at)):
            if mark[0] == ">":
                return mark.end()
            close = self._page.find(mark[0], mark.end())
            if close < 0:
                break
            at = close + 1
            seen.append(at)
        self._endless.update(seen)
        return self._page.find(">", pos) + 1


def parse(page: str) -> _Node:
    """The page's tree.  End tags that are missing or misplaced are supplied or ignored as browsers do."""
    root = _Node("#page", None, False)
    stack = [root]
    articles = 0  # open article and main elements
    places: dict[str, list[int]] = {}  # by name, the depths of its open elements
    pos, size = 0, len(page)
    tags, last_data = _Tags(page), page.rfind("]]>")

    def close_to(depth: int) -> None:
        nonlocal articles
        while len(stack) > depth:
            tag = stack.pop().tag
            places[tag].pop()
            articles -= tag in ("article", "main")

    def deepest(names: tuple[str, ...]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def open_depth(names: tuple[str, ...], stops: tuple[str, ...] = ()) -> int:
        """Depth of the innermost open element of these names, 0 where there is none or a stop is inside it."""
        depth = deepest(names)
        return depth if depth and depth >= deepest(stops) else 0

    while pos < size:
        if page[pos] != "<":
            end = page.find("<", pos)
            end = size if end < 0 else end
            stack[-1].children.append(html.unescape(page[pos:end]))
            pos = end
            continue
        if page.startswith("<!--", pos):
            end = page.find("-->", pos + 4)
            pos = size if end < 0 else end + 3
            continue
        if page.startswith("<![CDATA[", pos) and pos + 9 <= last_data:
            end = page.index("]]>", pos + 9)
            stack[-1].children.append(page[pos + 9 : end])
            pos = end + 3
            continue
        if page.startswith(("<!", "<?"), pos):
            end = page.find(">", pos)
            pos = size if end < 0 else end + 1
            continue
        match = tags.start(pos)
        if match is None:
            stack[-1].children.append("<")
            pos += 1
            continue
        pos = tags.end(match.end())
        tag = match["name"].lower()
        if match["end"]:
            stops = ("table", "td", "th", "article", "main", "section", "div", "body") if tag in INLINE or tag == "p" else ("article", "main") if tag not in ("body", "html") else ()
            if depth := open_depth((tag,), tuple(s for s in stops if s != tag)):
                close_to(depth)
            continue
        attrs = page[match.end() : pos - 1]
        if tag in CLOSES_P and (depth := open_depth(("p",), ("table", "td", "th", "button", "article", "main", "section", "div", "body"))):
            close_to(depth)
        if tag in _SOLE:
            same = ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,)
            if depth := open_depth(same, _SOLE[tag]):
                close_to(depth)
        if tag == "body" and (depth := open_depth(("head",))):
            close_to(depth)
        named = _named(attrs, articles > 0) if attrs and tag not in ("html", "body", "main", "h1") else ""
        node = _Node(tag, stack[-1], stack[-1].dropped or _is_boilerplate(tag, attrs, articles > 0), named)
        stack[-1].children.append(node)
        if tag in VOID or attrs.endswith("/") and tag not in RAW and tag not in CLOSES_P and tag not in INLINE:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|$)", re.I).search(page, pos)
            stop = end.start() if end else size
            if not node.dropped and tag not in ("script", "style", "title"):
                node.children.append(page[pos:stop])
            pos = stop
        places.setdefault(tag, []).append(len(stack))
        stack.append(node)
        articles += tag in ("article", "main")
    return root


def _is_main(node: _Node) -> bool:
    return node.tag in ("main", "h1") or node.tag == "article" and node.named in ("", "maybe")


def _cut_named(root: _Node) -> None:
    """Cut off elements that their names call boilerplate, where their text agrees."""
    nodes = _in_order(root)
    if not any(n.named for n in nodes):
        return
    sizes: dict[int, tuple[int, int, bool]] = {}  # characters, those in links, whether a main part is inside
    for node in reversed(nodes):  # children before parents
        chars = linked = 0
        holds = False
        for child in node.children:
            if isinstance(child, str):
                chars += len("".join(child.split()))
            elif not child.dropped:
                c, k, h = sizes[id(child)]
                chars, linked, holds = chars + c, linked + k, holds or h or c > 0 and _is_main(child)
        sizes[id(node)] = (chars, chars if node.tag == "a" else linked, holds)
    body = next((n for n in nodes if n.tag == "body"), root)
    whole = sizes[id(body)][0] - sizes[id(body)][1]
    headed = any(sizes[id(n)][0] and _is_main(n) for n in nodes)
    cut: set[int] = set()
    for node in nodes:  # parents before children
        if id(node.parent) in cut:
            node.dropped = True
        elif node.named and node.tag != "article":
            chars, linked, holds = sizes[id(node)]
            most = 0.5 if node.named != "foreign" else 1.0 if headed else NEARLY_ALL
            node.dropped = not holds and chars - linked <= most * whole and (node.named != "maybe" or 2 * linked > chars)
        if node.dropped:
            cut.add(id(node))


def _in_order(root: _Node) -> list[_Node]:
    """Kept nodes, parents before children."""
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if not node.dropped:
            found.append(node)
            waiting += [c for c in reversed(node.children) if isinstance(c, _Node)]
    return found


def _measure(root: _Node) -> list[_Node]:
    nodes = _in_order(root)
    for node in reversed(nodes):  # children before parents
        link = node.tag == "a"
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            elif not child.dropped:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
        if link:
            node.link_chars = node.chars
    body = next((n for n in nodes if n.tag == "body"), root)
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        if node.chars:
            plain = max(node.chars - node.link_chars, 1)
            base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
            ratio = node.chars / max(node.link_chars, 1) * max(node.tags, 1) / max(node.link_tags, 1)
            node.density = node.chars / max(node.tags, 1) * max(math.log(max(ratio, 1e-9)) / base, 0.0)
    for node in nodes:
        # Inline elements are part of a block's text: a bold paragraph is no core of its own.
        node.total = sum(c.density for c in node.children if not isinstance(c, str) and not c.dropped and c.tag not in INLINE)
    return nodes


def _up_to_body(node: _Node) -> list[_Node]:
    path = [node]
    while path[-1].parent is not None and path[-1].tag != "body":
        path.append(path[-1].parent)
    return path


def _inside(root: _Node) -> list[_Node]:
    """Kept article and main elements below a node, parents before children."""
    return [n for n in _in_order(root)[1:] if n.tag in ("article", "main") and n.chars]


def main_nodes(root: _Node) -> list[_Node]:
    """The subtrees that hold the article, in page order."""
    _cut_named(root)
    nodes = _measure(root)
    candidates = [n for n in nodes if n.chars]
    if not candidates:
        return []
    core = max(candidates, key=lambda n: (n.total, n.density))
    # A lone child's wrapper has the same sum and takes in what stands beside it; an element with most of its text is meant.
    most = [n for n in _inside(core) if 2 * (n.chars - n.link_chars) > core.chars - core.link_chars]
    core = next((n for tag in ("article", "main") for n in reversed(most) if n.tag == tag), core)
    path = _up_to_body(core)
    threshold = min(n.density for n in path)
    best = next((n for tag in ("article", "main") for n in path if n.tag == tag), core)
    above, chosen, waiting = {id(n) for n in path[path.index(best) + 1 :]}, [], [path[-1]]
    while waiting:
        node = waiting.pop()
        if id(node) in above:
            waiting += [c for c in reversed(node.children) if isinstance(c, _Node)]
        elif node is best or not node.dropped and node.chars and (node.density >= threshold or node.tag == "h1"):
            chosen.append(node)
    return chosen


def text_of(node: _Node) -> str:
    """Text of a subtree without the cut-off parts; block elements and line breaks separate words."""
    parts: list[str] = []
    waiting: list = [node]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            parts.append(item)
        elif not item.dropped:
            if item.tag not in INLINE:
                parts.append(" ")
                waiting.append(" ")
            waiting += reversed(item.children)
    return " ".join("".join(parts).split())


def extract(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    return " ".join(filter(None, map(text_of, main_nodes(parse(page)))))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(page.as_py()) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text and n_chars (code points)."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(
        _texts, "page_id long, url string, text string, n_chars long"
    )
