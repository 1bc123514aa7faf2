"""Main text of web pages by composite text density.

Every page becomes a tree. For each node the number of characters per tag is
adjusted by the share of link text; the sum of a node's children's densities is
largest for the node that holds most of the article's paragraphs. The sum only
finds the text: all of the outermost article or main element around that node is
kept, headline, lead and short sections too. Without such an element it is the
outermost element with few links around the node, less lists of links beside the
node. Further article and main elements are kept, and so are subtrees elsewhere
that are as dense as the path from the body to the node, with a fair share of
the best sum.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_or_empty

#: Share of the best density sum that a subtree outside the text's own element must have; also the share of a named
#: wrapper's text from which an article outside of it is the text instead.
PART = 0.25
#: Largest share of link text of an element that is kept whole though it is no article or main element.
LINKS = 1 / 3

#: Name and value of one attribute. A quote delimits a value only if the value begins with it.
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)?)?""")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([A-Za-z][^\s/>]*)((?:[\s/]++|" + ATTRIBUTE.pattern.replace("(", "(?:").replace("(?:?:", "(?:")
                   + r")*+)(?:>|\Z)", re.S)
SPACE = re.compile(r"\s+")
NAME = re.compile(r"[a-z]+")
#: Where a name in camel case begins a new word.
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the end tag, never markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul").split())
#: A start tag of the first kind ends an open element of the second, unless one of the third is in between.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
PARAGRAPH_BARRIER = frozenset("button table td th caption object".split())
#: Elements that are never article text.
DROPPED = RAW | frozenset((
    "head nav footer aside button select input label menu svg math canvas object embed audio video map "
    "dialog").split())
#: Words of class, id or role that name what isn't article text, unless the text is inside (see ``judge``).
DROPPED_NAMES = frozenset((
    "ad ads adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar aside foot footer comment comments disqus reply replies cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended pagination pager widget toolbar search skip complementary contentinfo hidden").split())
CONTENT = frozenset(("article", "main"))
#: Those that name an article that is a reader's comment.
COMMENTS = frozenset(("comment", "comments", "disqus", "reply", "replies"))
#: Characters from which an element inside an article stays as prose though a word of its longer name is doubtful.
PROSE = 100
#: Elements that hold a piece of an article, never all of it; their parents may be chosen instead.
PIECES = frozenset((
    "a abbr b big blockquote caption cite code dd del dfn dl dt em figcaption figure font h1 h2 h3 h4 h5 h6 i ins kbd "
    "label li mark ol p pre q s samp small span strike strong sub summary sup table tbody tfoot thead time tr tt u ul "
    "var").split())


class Node:
    __slots__ = ("tag", "parent", "parts", "drop", "doubtful", "vague", "own", "chars", "tags", "link_chars", "link_tags",
                 "density", "total")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False, doubtful: bool = False, vague: bool = False):
        self.tag, self.parent, self.drop, self.doubtful, self.vague = tag, parent, drop, doubtful, vague
        self.parts: list[Node | str] = []
        self.own = self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def dropped(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, bool]:
    """Whether an element is none of the article; whether it isn't unless the text is in it; and whether the doubt is
    vague, as only a word of a longer name inside an article says so. ``inside``: of an article or main."""
    if tag in DROPPED or tag == "header" and not inside:
        return True, False, False
    doubtful, vague = tag == "form", False
    if not attributes or tag in ("body", "html", "main"):
        return False, doubtful, False
    names = COMMENTS if tag == "article" else DROPPED_NAMES
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" and tag != "article" or name == "aria-hidden" and "true" in value.lower():
            return True, False, False
        if name in ("class", "id", "role"):
            for one in value.split():
                words = NAME.findall(CAMEL.sub("-", one).lower())
                if not names.isdisjoint(words):
                    vague = inside and len(words) > 1 and (vague or not doubtful)
                    doubtful = True
    return False, doubtful, vague


def parse(page: str) -> Node:
    """The tree of a page. Missing end tags are implied as browsers do; wrong end tags are skipped."""
    root = at = Node("html", None)
    depth = {"html": 1}  # open elements by tag
    content = 0
    place, size = 0, len(page)
    find = TOKEN.search

    def close(node: Node) -> Node:
        """Close everything up to ``node``; returns its parent."""
        nonlocal at, content
        while True:
            depth[at.tag] -= 1
            content -= at.tag in CONTENT
            done, at = at is node, at.parent
            if done:
                return at

    while place < size:
        token = find(page, place)
        if not token:
            at.parts.append(page[place:])
            break
        if token.start() > place:
            at.parts.append(page[place:token.start()])
        place = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            if depth.get(tag) and tag != "html":
                node = at
                while node.tag != tag:
                    node = node.parent
                close(node)
            continue
        if tag in ("html", "body") and depth.get(tag):
            continue
        if depth.get("p") and tag in BLOCK:
            node = at
            while node.tag != "p" and node.tag not in PARAGRAPH_BARRIER and node.parent:
                node = node.parent
            if node.tag == "p":
                close(node)
        if tag in IMPLIED_END:
            ends, barriers = IMPLIED_END[tag]
            last, node = None, at
            while node.parent and node.tag not in barriers:
                if node.tag in ends:
                    last = node
                node = node.parent
            if last:
                close(last)
        if tag == "body" and depth.get("head"):
            node = at
            while node.tag != "head":
                node = node.parent
            close(node)
        drop, doubtful, vague = dropped(tag, token[3], content > 0)
        node = Node(tag, at, at.drop or drop, doubtful, vague)
        at.parts.append(node)
        if tag in RAW and not token[3].rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, place)
            place = end.end() if end else size
        elif tag not in VOID:
            at = node
            depth[tag] = depth.get(tag, 0) + 1
            content += tag in CONTENT
    return root


def ordered(root: Node) -> list[Node]:
    """Kept nodes, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in reversed(node.parts) if not isinstance(x, str) and not x.drop]
    return out


def judge(nodes: list[Node]) -> list[Node]:
    """Nodes that stay; marks named elements and forms as dropped unless the text is in them.

    Such an element is a mere wrapper if it contains an article or main element with at least as
    much text as each article or main element has outside of all named elements and forms. It also is if it
    holds most of the page's text, links aside, and no such outer element has a fair share of that.
    Where the doubt is vague, prose with few links stays as well.
    """
    # characters: all, those outside links, those outside doubtful nodes too; of the largest article inside
    every, plain, clear, holds = {}, {}, {}, {}
    for node in nodes:
        node.own = sum(len("".join(x.split())) for x in node.parts if isinstance(x, str))
    if not any(n.doubtful for n in nodes):
        return nodes
    for node in reversed(nodes):
        at = id(node)
        every[at] = every.get(at, 0) + node.own
        if node.tag == "a":
            plain[at] = clear[at] = 0
        else:
            plain[at] = plain.get(at, 0) + node.own
            clear[at] = clear.get(at, 0) + node.own
        if node.parent:
            up = id(node.parent)
            every[up] = every.get(up, 0) + every[at]
            plain[up] = plain.get(up, 0) + plain[at]
            clear[up] = clear.get(up, 0) + (0 if node.doubtful else clear[at])
            holds[up] = max(holds.get(up, 0), holds.get(at, 0), plain[at] if node.tag in CONTENT else 0)
    within, outer = set(), 0
    for node in nodes:
        if node.doubtful or node.parent and id(node.parent) in within:
            within.add(id(node))
        elif node.tag in CONTENT:
            outer = max(outer, clear[id(node)])
    page, out = plain[id(nodes[0])], []
    for node in nodes:
        at = id(node)
        prose = node.vague and plain[at] >= PROSE and plain[at] >= (1 - LINKS) * every[at]
        node.drop = bool(node.parent) and node.parent.drop or node.doubtful and not (
            prose or holds.get(at, 0) >= max(outer, 1) or 2 * plain[at] > page and outer < PART * plain[at])
        if not node.drop:
            out.append(node)
    return out


def densities(nodes: list[Node]) -> None:
    """Characters, tags and their link shares bottom-up, then density and its sum over children.

    The published measure takes a logarithm to a base that is a logarithm itself and may be under 1; here the
    logarithm is divided by that base, which is 1 at least.
    """
    for node in reversed(nodes):
        node.chars += node.own
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.parent:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = nodes[0]
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in reversed(nodes):
        chars, tags = node.chars, max(1, node.tags)
        links, link_tags = max(1, node.link_chars), max(1, node.link_tags)
        if chars:
            base = math.log(chars / max(1, chars - node.link_chars) * node.link_chars + share * chars + math.e)
            adjusted = math.log(max(chars / links * tags / link_tags, 1.0 + 1e-9)) / base
            node.density = chars / tags * adjusted
        if node.parent:
            node.parent.total += node.density


def link_list(node: Node) -> bool:
    """Whether an element is little more than several links, or nothing but two."""
    some = node.link_tags >= 3 and 2 * node.link_chars > node.chars
    return (node.tag == "ul" or node.tag not in PIECES) and (some or node.link_tags == 2 and node.link_chars == node.chars)


def selected(nodes: list[Node]) -> list[Node]:
    """The roots of the main text, in page order, none inside another; marks lists of links beside it as dropped."""
    holders = [n for n in nodes if n.tag not in PIECES]
    best = max(holders, key=lambda n: n.total, default=nodes[0])  # the first of equals is the outermost
    if not best.total:
        return nodes[:1]
    threshold, path = best.density, [best]
    while path[-1].parent:
        path.append(path[-1].parent)
        threshold = min(threshold, path[-1].density)
    around = [n for n in path if n.tag in CONTENT]
    whole = around or [n for n in path if n.link_chars <= LINKS * n.chars] or [best]
    chosen, above = whole[-1], {id(n) for n in path}
    inside, beside, out = set(), set(), []
    for node in nodes:
        up = id(node.parent)
        if node.parent and up in inside:
            inside.add(id(node))
            if not around and (up in beside or up in above and up != id(best)) and id(node) not in above:
                beside.add(id(node))
                node.drop = link_list(node)
        elif node is chosen or id(node) not in above and (
                node.tag in CONTENT and not link_list(node)
                or node.tag not in PIECES and node.density >= threshold and node.total >= PART * best.total):
            inside.add(id(node))
            out.append(node)
    return out


def blocks(root: Node) -> list[str]:
    """Texts of the blocks below ``root`` in page order, white space reduced."""
    out: list[list[str]] = [[]]
    todo: list[Node | str | None] = [root]
    while todo:
        x = todo.pop()
        if x is None:
            out.append([])
        elif isinstance(x, str):
            out[-1].append(x)
        elif x.tag == "br":
            out[-1].append(" ")
        elif not x.drop:
            block = x.tag in BLOCK
            if block:
                out.append([])
                todo.append(None)
            todo += reversed(x.parts)
    texts = (SPACE.sub(" ", html.unescape("".join(x))).strip() for x in out)
    return [x for x in texts if x]


def main_text(page: str) -> str:
    """The main text of a page; empty if there is none."""
    root = parse(page)
    start = next((x for x in root.parts if not isinstance(x, str) and x.tag == "body"), root)
    if start is not root:
        start.parent = None
    nodes = judge(ordered(start))
    densities(nodes)
    return "\n".join(x for node in selected(nodes) for x in blocks(node))


def extract_html(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with text and n_chars in place of ``html_col``.

    Null and empty pages, and those without any text, have an empty text. Each
    row is parsed alone, so repeated rows are alike; every other column stays,
    but for own columns named text or n_chars, which are replaced.
    """
    own = [c for c in pages.columns if c.lower() not in ("text", "n_chars", html_col.lower())]
    rows = pages.select(*[pages[c] for c in own], text_or_empty(html_col).alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(len(own)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], names=[*own, "text"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return arrow_map(rows, run, f"{fields}text string").withColumn("n_chars", F.length("text").cast("bigint"))
