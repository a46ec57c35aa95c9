"""Main text of web pages by minimum-cut labelling of their blocks.

A page becomes blocks of text in page order.  A linear classifier over each block's place, markup
and wording gives the log-odds of content, which become capacities to the two terminals.  Neighbouring
blocks and blocks under one parent are tied by smoothness edges, stronger the nearer they
are in the tree.  The minimum cut is the labelling of least total cost; a block on the source's side is content.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable
from html import unescape
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stokesweave.llm.common import map_texts

# fixed values: element names of HTML
#: no text of theirs is shown, or it belongs to controls
SILENT = frozenset("script style noscript template textarea title select option button iframe object embed svg math canvas audio video datalist head".split())
#: their content holds no tags
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: an opening tag closes an open element of these names
CLOSES = {
    "p": frozenset(["p", *HEADINGS]),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
#: closing an element of these names from inside stops at these
SCOPES = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]), "td": frozenset(["tr", "table"]), "th": frozenset(["tr", "table"])}
DIVISIONS = frozenset(["", "body", "div", "section"])
ASIDE = frozenset("nav footer aside form menu dialog".split())
STRONG = frozenset("article main".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form status".split())
#: words of class and id attributes
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline cookie cookies consent gdpr comment comments commentlist "
    "disqus reply replies respond footer header masthead menu menus modal nav navbar navigation newsletter notice notices notification alert outbrain pager "
    "pagination popup overlay promo promotion promoted recommended recommendations related rss share sharing shares sharebar shoutbox sidebar sidebars "
    "side signup signin login search skip social sponsor sponsored sponsors subscribe subscription taboola tags toolbar tooltip widget widgets".split()
)
#: such a class tells of a layout, not of the element's own role
ABOUT = frozenset("has with no without".split())
#: of these an inline element is left out of the text around it
ADVERT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising promo promoted promotion sponsor sponsored sponsors".split())
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text".split())

# fixed values: the classifier, log-odds of content
BIAS = -0.4
IN_CONTENT = 3.2  # under article, main or an element named as content
IN_ASIDE = -9.0  # under navigation, footer, sidebar, notice, advert, form or comments
HEADING = 0.6
PER_WORD = 0.05  # up to 40 words
SENTENCE = 0.7  # ends like a sentence
LINKED = -3.5  # times the share of characters inside links
TINY = -0.3  # under three words
UNMARKED = -0.8  # directly in a division, not in a paragraph or the like
# of the size of a block's own log-odds where no name tells its kind
ADJACENT, SAME_PARENT, NEAR = 1.0, 1.8, 0.8
BOTH_UNNAMED = 0.3

TAG_START = re.compile(r"</?[a-zA-Z]")
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORDS = re.compile(r"[a-z]+|[A-Z]+[a-z]*")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Block:
    """Text of a block element.  ``parent`` numbers the element around it, ``depth`` is its own depth and ``shared`` that down to which it shares its ancestors with the block before."""

    __slots__ = ("text", "linked", "name", "parent", "depth", "shared", "aside", "content")

    def __init__(self, text: str, linked: int, name: str, parent: int, depth: int, shared: int, aside: bool, content: bool) -> None:
        self.text, self.linked, self.name, self.aside, self.content = text, linked, name, aside, content
        self.parent, self.depth, self.shared = parent, depth, shared


class Element(NamedTuple):
    """An open element; inline ones stand in the block around them."""

    name: str
    block: int  # place of the innermost block element on the stack, its own if it is one
    number: int
    parent: int
    depth: int  # of that block element
    aside: bool
    content: bool
    silent: bool
    linked: bool


class OpenElements:
    """The stack of open elements; the innermost one of a name is found without a search."""

    def __init__(self) -> None:
        self.stack = [Element("", 0, 0, 0, 0, False, False, False, False)]
        self.places: dict[str, list[int]] = {}

    def push(self, element: Element) -> None:
        self.places.setdefault(element.name, []).append(len(self.stack))
        self.stack.append(element)

    def last(self, names: Iterable[str]) -> int:
        """Place of the innermost open element of these names, 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def cut(self, place: int) -> None:
        """Close the element at this place and all inside it."""
        while len(self.stack) > place:
            self.places[self.stack.pop().name].pop()


def inline_silent(name: str, attributes: str) -> bool:
    """Whether an inline element is hidden, or an advert by its class."""
    if name in SILENT or name in RAW:
        return True
    for found in ATTRIBUTE.finditer(attributes):
        key, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if key in ("class", "id"):
            words = {w.lower() for w in WORDS.findall(value)}
            if not words.isdisjoint(ADVERT_WORDS) and words.isdisjoint(ABOUT):
                return True
        elif key == "style" and HIDDEN.search(value) or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
    return False


def element_kind(name: str, attributes: str, within_content: bool) -> tuple[bool, bool, bool]:
    """(aside, content, hidden) that an element adds by its name and attributes."""
    aside, content, hidden = name in ASIDE or (name == "header" and not within_content), name in STRONG, False
    if attributes.strip():
        for found in ATTRIBUTE.finditer(attributes):
            key, value = found[1].lower(), found[2] or found[3] or found[4] or ""
            if key == "role":
                aside |= value.lower() in ASIDE_ROLES
                content |= value.lower() in ("main", "article")
            elif key in ("class", "id"):
                words = {w.lower() for w in WORDS.findall(value)}
                if name in ("body", "html") or not words.isdisjoint(ABOUT):
                    continue
                content |= not words.isdisjoint(CONTENT_WORDS)
                # the header of an article holds its title
                aside |= name not in STRONG and not words.isdisjoint(ASIDE_WORDS - {"header"} if within_content or content else ASIDE_WORDS)
            elif key == "style":
                hidden |= bool(HIDDEN.search(value))
            elif key == "hidden" or value.lower() == "true":
                hidden = True
    return aside, content, hidden


def blocks_of(html: str) -> list[Block]:
    """Visible text of a page, cut at block elements, with its place in the tree.

    A comment, a declaration and the content of silent elements give nothing and do not part the text around them,
    nor do inline elements that are hidden or adverts.  A tag that never ends is dropped with what it holds up
    to the next one.  From a tag on whose quotes never close, tags end at the next ``>``.  Time and memory grow with
    the length of the page, however broken or deeply nested it is.
    """
    out: list[Block] = []
    open_elements = OpenElements()
    stack = open_elements.stack
    number = lowest = 0  # elements so far; least depth since the last block
    parts: list[str] = []
    linked_parts: list[str] = []
    last_end, quoted = html.rfind(">"), True

    def close_block() -> None:
        nonlocal parts, linked_parts, lowest
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                top = stack[-1]
                lowest = min(lowest, top.depth)
                out.append(Block(text, len(" ".join(unescape("".join(linked_parts)).split())), stack[top.block].name, top.parent, top.depth, lowest, top.aside, top.content))
                lowest = top.depth
        parts, linked_parts = [], []

    def cut(place: int) -> None:
        nonlocal lowest
        open_elements.cut(place)
        lowest = min(lowest, stack[-1].depth)

    def take(text: str) -> None:
        if not stack[-1].silent:
            parts.append(text)
            if stack[-1].linked:
                linked_parts.append(text)

    at, end = 0, len(html)
    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            take(html[at:])
            break
        if lt > at:
            take(html[at:lt])
        if html.startswith("<!--", lt):
            stop = html.find("-->", lt + 4)
            at = end if stop < 0 else stop + 3
            continue
        if html.startswith(("<!", "<?"), lt):
            stop = html.find(">", lt)
            at = end if stop < 0 else stop + 1
            continue
        tag = None
        named = TAG_START.match(html, lt) if lt < last_end else None
        if named:
            tag = TAG.match(html, lt) if quoted else None
            if tag is None:
                quoted = False
                tag = LOOSE_TAG.match(html, lt)
        if tag is None:
            if lt + 1 < end and (html[lt + 1].isalpha() or html[lt + 1] == "/"):
                nxt = html.find("<", lt + 1)
                at = end if nxt < 0 else nxt
            else:
                take("<")
                at = lt + 1
            continue
        at = tag.end()
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        top = stack[-1]
        if name == "br":
            take(" ")
        elif name in VOID and name != "hr":
            pass
        elif closing:
            place = open_elements.last((name,))
            if name in INLINE or name in SILENT or name in RAW:
                if place > top.block or place and name not in INLINE:
                    cut(place)
            elif place:
                if not stack[place - 1].silent:
                    close_block()
                cut(place)
            elif not top.silent:
                close_block()
        elif name in INLINE or name in SILENT or name in RAW:
            if name in CLOSES and open_elements.last(CLOSES[name]) > top.block:
                cut(open_elements.last(CLOSES[name]))
                top = stack[-1]
            if attributes.rstrip().endswith("/") and name not in RAW and name not in INLINE:
                continue
            silent = top.silent or inline_silent(name, attributes)
            open_elements.push(top._replace(name=name, silent=silent, linked=top.linked or name == "a"))
            if name in RAW:
                shut = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
                at = end if shut is None else shut.start()
        else:
            if not top.silent:
                close_block()
            # a new item or cell ends the one before it in the same list or table; any block ends a paragraph
            ended = open_elements.last(CLOSES.get(name, ()))
            if name in SCOPES and ended > open_elements.last(SCOPES[name]) or name not in SCOPES and stack[top.block].name in CLOSES["p"]:
                place = ended if name in SCOPES else top.block
                if stack[place].silent or not top.silent:
                    cut(place)
                    top = stack[-1]
            if name in VOID or attributes.rstrip().endswith("/"):
                continue
            aside, content, hidden = element_kind(name, attributes, top.content)
            number += 1
            open_elements.push(Element(name, len(stack), number, top.number, top.depth + 1, top.aside or aside, top.content or content, top.silent or hidden, False))
    close_block()
    return out


def log_odds(block: Block) -> float:
    words = block.text.count(" ") + 1
    return (
        BIAS
        + IN_CONTENT * block.content
        + IN_ASIDE * block.aside
        + HEADING * (block.name in HEADINGS)
        + PER_WORD * min(words, 40)
        + SENTENCE * (block.text[-1] in ".!?\"'”»…:")
        + LINKED * min(1.0, block.linked / len(block.text))
        + TINY * (words < 3)
        + UNMARKED * (block.name in DIVISIONS)
    )


def kind(block: Block) -> int:
    """-1 under an element named as something beside the text, 1 under one named as content, else 0."""
    return -1 if block.aside else int(block.content)


def tie(a: Block, b: Block) -> float:
    kinds = kind(a), kind(b)
    if kinds == (0, 0):
        return BOTH_UNNAMED * (a.parent == b.parent)
    return float(kinds[0] * kinds[1] >= 0)


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges of the graph: each block to the one before it, and to the last one under the same parent.

    Blocks of no kind take the side of the named ones round them; what is named content is not tied to what is
    named as beside it.  Two blocks of no kind tell each other little, and nothing across parents.
    """
    edges, last = [], {}
    for i, block in enumerate(blocks):
        before, sibling = blocks[i - 1] if i else None, last.get(block.parent)
        if before is not None:
            near = SAME_PARENT if before.parent == block.parent else NEAR * (block.shared + 1) / (max(before.depth, block.depth) + 1)
            edges.append((i - 1, i, (ADJACENT + near) * tie(before, block)))
        if sibling is not None and sibling < i - 1:
            edges.append((sibling, i, SAME_PARENT * tie(blocks[sibling], block)))
        last[block.parent] = i
    return [e for e in edges if e[2]]


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for nodes on the source's side of the minimum cut.

    ``odds > 0`` is the capacity from the source, ``odds < 0`` that to the sink.  A node whose own
    capacity is at least that of all its edges keeps its side in some minimum cut, so it is
    settled first and its edges become capacities of its neighbours; what stays is solved by
    blocking flows.
    """
    n = len(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    odds, side = list(odds), [None] * n
    queue = deque(range(n))
    while queue:
        v = queue.popleft()
        if side[v] is None and abs(odds[v]) >= sum(near[v].values()):
            side[v] = odds[v] > 0
            for u, w in near[v].items():
                del near[u][v]
                odds[u] += w if side[v] else -w
                queue.append(u)
            near[v] = {}
    left = [v for v in range(n) if side[v] is None]
    if left:
        reached = _flow(left, odds, near)
        for v in left:
            side[v] = v in reached
    return side


def _flow(nodes: list[int], odds: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes that the source still reaches when the flow is largest."""
    source, sink, tiny = -1, -2, 1e-9
    room: dict[int, dict[int, float]] = {v: dict(near[v]) for v in nodes}
    room[source], room[sink] = {}, {}
    for v in nodes:
        if odds[v] > 0:
            room[source][v], room[v][source] = odds[v], 0.0
        elif odds[v] < 0:
            room[v][sink], room[sink][v] = -odds[v], 0.0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            v = queue.popleft()
            for u, c in room[v].items():
                if c > tiny and u not in level:
                    level[u] = level[v] + 1
                    queue.append(u)
        if sink not in level:
            return set(level) - {source}
        todo = {v: list(room[v]) for v in level}
        path = [source]
        while path:
            v = path[-1]
            if v == sink:
                least = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= least
                    room[b][a] = room[b].get(a, 0.0) + least
                # go back to the first edge that is full
                cut = next(i for i, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= tiny)
                del path[cut + 1 :]
                continue
            while todo[v]:
                u = todo[v][-1]
                if room[v].get(u, 0.0) > tiny and level.get(u, -1) == level[v] + 1:
                    path.append(u)
                    break
                todo[v].pop()
            else:
                path.pop()
                if path:
                    todo[path[-1]].pop()


def main_text(html: str) -> str:
    """Content blocks in page order, one a line."""
    return labelled(html)[0]


def labelled(html: str) -> tuple[str, int]:
    """The main text, and how many blocks the cut labels against their own log-odds."""
    blocks = blocks_of(html)
    odds = [log_odds(b) for b in blocks]
    content = minimum_cut(odds, smoothness(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, content) if keep), sum((o > 0) != keep for o, keep in zip(odds, content))


def extract(df: DataFrame, key: str = "page_id", html: str = "html", also: str = "url") -> DataFrame:
    """``key, also, text, n_chars`` of every page.

    Null or empty html and pages without content give an empty text.  Rows are handled
    each for itself, so repeated rows repeat their result.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    packed = df.select(F.struct(F.col(key).alias("k"), F.col(also).alias("a")).alias("key"), F.col(html).alias("text"))

    def run(keys: list, texts: list[str]) -> dict[str, list]:
        return {"key": keys, "text": [main_text(t) for t in texts]}

    out = map_texts(packed, run, f"key struct<k:{kinds[key]},a:{kinds[also]}>, text string", "key", "text")
    return out.select(F.col("key.k").alias(key), F.col("key.a").alias(also), "text", F.length("text").cast("bigint").alias("n_chars"))
