"""Main text of HTML pages by tree scoring.

A tolerant parser builds the element tree. Each paragraph passes points for its length and its commas to its
ancestors, less the further up; points are discounted by the share of text that stands in links. The best
container wins, and gives way to the article around it where that scores well too; its siblings are kept if they
score well or hold solid text with few links, as are headings beside it. Elements whose name or role says menu,
header, footer, form and the like never count. Class and id words (sidebar, comments, advert) are weights only:
an element so marked goes if the page has a tenth of its points elsewhere, and stays if it holds the text itself.
Inside what is kept, blocks of links go by their link density. Of the header of an article its headings stay.
Defined results: null or empty html gives an empty text; a page without any main text gives an empty text;
repeated rows and null ids give one row each; an empty table gives no rows; other columns are ignored. All html
is parsed, whatever its length, in one pass: what isn't closed costs no second look.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import document_batches

SCHEMA = "page_id long, url string, text string, n_chars long"

#: Element names of the HTML standard by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("script style textarea title xmp iframe noembed noframes head nav footer aside form button select option input label fieldset legend noscript template svg math canvas object embed audio video map menu dialog datalist".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTUAL = frozenset("p pre td th blockquote li dd dt div section article main body center figcaption caption summary address".split())
#: Elements that go if they hold little but links.
MENUS = frozenset("div section ul ol dl table center".split())
#: What an opening tag closes, and the elements at which the search for it stops.
P_CLOSERS = BLOCKS - frozenset("body html caption tbody td tfoot th thead tr legend".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
STOPS = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "tr": frozenset(("table",)), "td": frozenset(("table", "tr")), "th": frozenset(("table", "tr")), "option": frozenset(("select",)), "tbody": frozenset(("table",)), "tfoot": frozenset(("table",))}
#: Words in class and id names that speak against article text, roles that rule it out, words that speak for it.
CLUTTER = frozenset("ad ads adv advert adverts advertisement advertising adbox adslot adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notification alert popup modal overlay subscribe subscription newsletter signup login paywall sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead toolbar topbar widget social share sharing related recommended recommendations teaser teasers outbrain taboola comment comments commentlist disqus respond reply replies pagination pager skip".split())
CLUTTER_NAMES = frozenset("header head hidden site-header page-header top-bar".split())
CLUTTER_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar form status".split())
GOOD = frozenset("article content main body entry post story text page hentry".split())
#: Words that make a class name tell how the page is laid out, not what the element is.
LAYOUT = frozenset("no not has have with without is layout template theme page".split())
#: Share of a marked element's points that the rest of the page must have for it to go; share of text in links of a
#: block that goes; share of the best container's points at which the article around it takes its place.
ELSEWHERE, LINKED, AROUND = 0.1, 0.5, 1 / 3

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_QUOTE = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+")
_END = {tag: re.compile(rf"</{tag}\s*/?>", re.I) for tag in RAW}


class Node:
    __slots__ = ("tag", "parent", "children", "good", "marked", "dropped", "points", "mass", "text", "linked", "links", "commas")

    def __init__(self, tag: str, parent: Node | None, good: bool = False, marked: bool = False, dropped: bool = False):
        self.tag, self.parent, self.good, self.marked, self.dropped = tag, parent, good, marked, dropped
        self.children: list = []
        self.points, self.mass, self.text, self.linked, self.links, self.commas = 0.0, 0.0, 0, 0, 0, 0


def _marks(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether names speak for an element, against it, and whether it is none of the text whatever it holds."""
    dropped = tag in DROPPED
    if not attributes or not attributes.strip(" /"):
        return False, False, dropped
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), unescape(a or b or c).lower())
    if tag in ("html", "body", "main"):
        return False, False, dropped
    good = marked = False
    for name in (found.get("class", "") + " " + found.get("id", "")).split():
        words = set(_WORD.findall(name))
        marked |= name in CLUTTER_NAMES or bool(words & CLUTTER) and not words & LAYOUT
        good |= bool(words & GOOD)
    style = found.get("style", "").replace(" ", "")
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
    return good and not marked, marked, dropped or hidden or found.get("role", "") in CLUTTER_ROLES


class Tokens:
    """Reads the markup at one place after the other. A search that fails is not made again."""

    def __init__(self, html: str):
        self.html, self.end, self.last = html, len(html), html.rfind(">")
        self.quoted = True

    def close(self, at: int) -> int:
        """Where the tag that is open at a place ends: its first > outside quotes, or the first if quotes don't match."""
        first = self.html.find(">", at)
        while self.quoted:
            m = _QUOTE.search(self.html, at)
            if m is None:
                self.quoted = False
            elif m[0] == ">":
                return m.start()
            else:
                at = self.html.find(m[0], m.end()) + 1
                self.quoted = 0 < at <= self.last
        return first

    def next(self, at: int) -> tuple[int, int, str, str, str]:
        """(start, end, text of a CDATA section, / and name, attributes) of the next markup at or after a place."""
        html = self.html
        while 0 <= at <= self.last:
            at = html.find("<", at)
            if at < 0 or at > self.last:
                break
            if html.startswith("<!--", at):
                stop = html.find("-->", at + 2)
                return at, stop + 3 if stop >= 0 else self.end, "", "", ""
            if html.startswith("<![CDATA[", at):
                stop = html.find("]]>", at)
                return at, stop + 3 if stop >= 0 else self.end, html[at + 9 : stop if stop >= 0 else self.end], "", ""
            if html.startswith(("<!", "<?"), at):
                return at, html.find(">", at) + 1, "", "", ""
            m = _NAME.match(html, at + 1)
            if m:
                stop = self.close(m.end())
                return at, stop + 1, "", m[1] + m[2].lower(), html[m.end() : stop]
            at += 1
        at = html.find("<!--", at) if at >= 0 else -1
        return (at, self.end, "", "", "") if at >= 0 else (self.end, self.end, "", "", "")


def parse(html: str) -> Node:
    """The element tree; text lies among the children as str, line breaks as a space."""
    root = node = Node("#root", None)
    inside: dict[str, int] = {}
    tokens, at, end = Tokens(html), 0, len(html)

    def close(upto: Node) -> Node:
        n = node
        while True:
            inside[n.tag] = inside.get(n.tag, 1) - 1
            if n is upto:
                return n.parent
            n = n.parent

    while at < end:
        start, stop, verbatim, tag, attributes = tokens.next(at)
        if start > at:
            node.children.append(unescape(html[at:start]))
        at = stop
        if verbatim:
            node.children.append(verbatim)
        if not tag:
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if tag == "br":
                node.children.append(" ")
            elif inside.get(tag, 0) > 0:
                n = node
                while n.tag != tag:
                    n = n.parent
                node = close(n)
            elif tag == "p":
                node.children.append(Node("p", node))
            continue
        if tag in P_CLOSERS and inside.get("p", 0) > 0:
            n = node
            while n.tag not in ("p", "button", "table", "td", "th", "#root"):
                n = n.parent
            if n.tag == "p":
                node = close(n)
        if tag in CLOSES:
            n, last, left = node, None, sum(inside.get(x, 0) for x in CLOSES[tag])
            while left > 0 and n.parent is not None and n.tag not in STOPS[tag]:
                if n.tag in CLOSES[tag]:
                    last, left = n, left - 1
                n = n.parent
            if last is not None:
                node = close(last)
        if tag in ("br", "wbr"):
            node.children.append(" " if tag == "br" else "")
            continue
        child = Node(tag, node, *_marks(tag, attributes))
        child.dropped |= tag == "header" and inside.get("article", 0) <= 0
        node.children.append(child)
        if tag in VOID:
            continue
        if tag in RAW:
            found = _END[tag].search(html, at)
            child.children.append(html[at : found.start() if found else end])
            at = found.end() if found else end
            continue
        node = child
        inside[tag] = inside.get(tag, 0) + 1
    return root


def _walk(root: Node) -> list[Node]:
    """Nodes outside clutter, parents first."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append(n)
        stack.extend(c for c in reversed(n.children) if isinstance(c, Node) and not c.dropped)
    return out


def measure(root: Node) -> list[tuple[Node, float]]:
    """Text, links and commas of every node outside clutter, the points of the paragraphs in it as mass, and each
    paragraph with its points."""
    nodes, found = _walk(root), []
    own: dict[int, int] = {}
    for n in nodes:
        text = "".join(c for c in n.children if isinstance(c, str))
        n.text = own[id(n)] = len(" ".join(text.split()))
        n.commas = text.count(",") + text.count("，") + text.count("、")
        n.linked = n.links = 0
        n.points = n.mass = 0.0
    for n in reversed(nodes):
        if n.tag == "a":
            n.linked, n.links = n.text, n.links + 1
        if n.tag in TEXTUAL and own[id(n)]:
            points = (1 if own[id(n)] >= 25 else 0.2) + n.commas + min(own[id(n)] / 100, 3)
            points *= 1 - min(1.0, n.linked / max(n.text, 1))
            n.mass += points
            found.append((n, points))
        if n.parent is not None:
            n.parent.text += n.text
            n.parent.linked += n.linked
            n.parent.links += n.links
            n.parent.mass += n.mass
            if n.tag not in BLOCKS:
                n.parent.commas += n.commas
                own[id(n.parent)] += own[id(n)]
    return found


def drop_marked(root: Node) -> None:
    """Drop marked elements that aren't what the page is about; leave an article's header its headings."""
    measure(root)
    holds: set[int] = set()
    for n in reversed(_walk(root)):
        if n.parent is not None and (n.tag in ("article", "main") and not n.marked or id(n) in holds):
            holds.add(id(n.parent))
    for n in _walk(root):
        if n.tag == "header":
            n.children = [x for x in _walk(n) if x.tag in HEADINGS]
        elif n.marked and id(n) not in holds:
            n.dropped = ELSEWHERE * n.mass < root.mass - n.mass or n.mass < 1


def score(root: Node) -> list[Node]:
    """Give every node outside clutter its points."""
    for n, points in measure(root):
        up, level = n.parent, 0
        if n.tag in ("div", "section", "article", "main", "body"):
            up = n
        while up is not None and level < 5:
            up.points += points / (1, 2, 4, 6, 8)[level]
            up, level = up.parent, level + 1
    nodes = _walk(root)
    for n in nodes:
        base = {"article": 12, "main": 10, "section": 2, "div": 2, "td": 1, "blockquote": 1, "ul": -3, "ol": -3, "dl": -3, "li": -3, "header": -5}.get(n.tag, 0)
        if n.points > 0 or n.text:
            n.points += base + (8 if n.good else 0) - (25 if n.marked else 0)
        n.points *= 1 - min(1.0, n.linked / max(n.text, 1))
    return nodes


def main_nodes(root: Node) -> list[Node]:
    """The best container and the neighbours that belong to it, in page order."""
    drop_marked(root)
    nodes = score(root)
    able = [n for n in nodes if n.text and n.tag in ("article", "main", "section", "div", "body", "td", "blockquote", "center", "#root", "html", "pre")]
    best = max(able, key=lambda n: (n.points, n.text), default=None)
    if best is None or best.points <= 0:
        return []
    up = best
    while up is not None and up.tag != "article":
        up = up.parent
    if up is not None and up.points >= AROUND * best.points:
        best = up
    if best.parent is None or best.tag in ("body", "html"):
        return [best]
    least, out = max(6.0, best.points * 0.2), []
    for c in best.parent.children:
        if c is best:
            out.append(c)
        elif isinstance(c, Node) and not c.dropped and not c.marked and c.text:
            density = c.linked / c.text
            if c.tag in HEADINGS and density < 0.5 or c.points >= least and density < 0.35 or density < 0.25 and (c.text >= 80 or c.text >= 20 and any(n.commas for n in _walk(c))):
                out.append(c)
    return out


def is_menu(n: Node) -> bool:
    """Whether a block inside the text is little more than links."""
    return n.links > 1 and n.tag in MENUS and n.linked > LINKED * n.text


def blocks(nodes: list[Node]) -> list[str]:
    """The texts of the blocks below, white space turned into single spaces."""
    out, run = [], []

    def close():
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    stack: list = [(n, True) for n in reversed(nodes)]
    while stack:
        x, opening = stack.pop()
        if isinstance(x, str):
            run.append(x)
        elif not opening:
            close()
        elif not x.dropped and (x in nodes or not is_menu(x)):
            if x.tag in BLOCKS:
                close()
                stack.append((x, False))
            stack.extend((c, True) for c in reversed(x.children))
    close()
    return out


def extract(html: str | None) -> str:
    """The main text of a page: its blocks in page order, an empty line between them."""
    return "\n\n".join(blocks(main_nodes(parse(html)))) if html else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every page."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        for b in batches:
            texts = [extract(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    document_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, SCHEMA)
