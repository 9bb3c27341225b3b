"""Main text of web pages: block costs from a small classifier, smoothed by a minimum cut over the page."""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from lakeops.llm.common import map_batches, text_of

# A quote opens a string only right after "="; any other value ends at white space or ">".
_VALUE = r"""=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+|(?=>|\Z))"""
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
                    rf"|<(/?)([A-Za-z][^\s/>]*)((?:[^=>]++|{_VALUE})*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)|'([^']*)|([^\s>"'][^\s>]*))?"?'?)?""")
_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Element names by their role in a page; fixed by the HTML standard.
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
SKIPPED = frozenset("head noscript template svg math canvas object embed audio video select option button datalist "
                    "input label fieldset legend dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements whose end tag may be left out, with the elements whose start closes them.
CLOSED_BY_BLOCK = frozenset(["p"])
ITEMS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
         "th": {"tr", "table"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What may stand in the head of a page; the start of anything else ends the head, as text does.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Elements without text of their own that may stand amid a sentence without parting it.
UNSEEN = frozenset(["script", "style"])
#: Elements that show a form around them to be the page's frame and not a form to fill in.
FRAMED = frozenset("article main header nav footer section".split()) | HEADINGS

#: Log-odds of being content that an enclosing element adds, by its name.
TAG_ODDS = {"article": 4.0, "main": 3.0, "nav": -8.0, "aside": -8.0, "footer": -8.0, "header": -3.0, "menu": -8.0}
#: The same by a word of the element's class, id or role.
WORD_ODDS = {
    **dict.fromkeys("article content main post entry story body text prose".split(), 1.5),
    **dict.fromkeys("nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside widget ad ads advert "
                    "adverts advertisement banner promo promotion sponsor sponsored cookie cookies consent notice "
                    "popup modal overlay newsletter subscribe subscription signup login share sharing social related "
                    "recommended comment comments commentlist respond disqus reply replies masthead topbar toolbar "
                    "pagination pager skip copyright legal complementary contentinfo search alert".split(), -8.0),
    **dict.fromkeys("header tags tag meta byline author caption".split(), -1.0),
}
#: Words that say what a text is about as often as what an element is for, and what they add to one that is
#: called an article by its name or by a word of its own.
TOPICS = frozenset("copyright legal search alert social".split())
TOPIC = -2.0
START = -0.5
PER_LOG_CHARACTER = 0.35
LINKED = -5.0
HEADING = 0.5
#: Capacity between neighbouring blocks, and what nearness in the document tree adds to it.
ADJACENT = 0.4
NEAR = 1.2


@dataclass(eq=False, slots=True)
class Element:
    """An open element: what it and those around it say of the text inside."""

    name: str
    parent: Element | None = None
    best: float = 0.0
    against: float = 0.0
    heading: bool = False
    skipped: bool = False
    form: Form | None = None
    depth: int = 0


@dataclass(eq=False, slots=True)
class Form:
    """A form, the one around it, and the text found in it apart from its fields."""

    outer: Form | None
    characters: int = 0
    linked: float = 0.0
    framed: bool = False
    frame: bool = False


@dataclass(slots=True)
class Block:
    """Text that stands between two block boundaries, with what is known of where."""

    text: str
    place: Element
    odds: float
    linked: float
    heading: bool


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape("".join(values)))
    return out


def _hides(attributes: dict[str, str]) -> bool:
    style = "".join(attributes.get("style", "").lower().split())
    return ("hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
            or "display:none" in style or "visibility:hidden" in style)


def _word_odds(value: str, names_article: bool) -> float:
    """What the words of a class, id or role add: of each sign the strongest counts, so that long lists do not add up."""
    tokens = [[w for w in _PARTS.split(_CAMEL.sub("-", t).lower()) if w] for t in value.split()]
    names_article |= any(len(t) == 1 and WORD_ODDS.get(t[0], 0.0) > 0 for t in tokens)
    known = [TOPIC if names_article and t == [w] and w in TOPICS else WORD_ODDS[w]
             for t in tokens for w in t if w in WORD_ODDS]
    return min([0.0, *known]) + max([0.0, *known])


def _element_odds(name: str, text: str, inside_article: bool) -> tuple[float, bool]:
    odds = TAG_ODDS.get(name, 0.0)
    if name == "header" and inside_article:
        odds = 0.0
    skipped = name in SKIPPED
    if text and ("=" in text or "hidden" in text.lower()):
        attributes = _attributes(text)
        skipped |= _hides(attributes)
        for kind in ("class", "id", "role"):
            if kind in attributes:
                odds += _word_odds(attributes[kind], name in ("article", "main"))
    if name in ("html", "body"):
        skipped, odds = False, 0.0
    return odds, skipped


def _without_forms(blocks: list[Block], forms: list[Form]) -> list[Block]:
    """The blocks that stand in no form, or only in forms that are the frame of the page.

    Such a form holds more than half of the page's text, and either a heading or a section, or 200 characters that
    are no links. Fields, labels and buttons were left out before. ``forms`` has each form after those around it.
    """
    if not forms:
        return blocks
    for block in blocks:
        if block.place.form is not None:
            block.place.form.characters += len(block.text)
            block.place.form.linked += block.linked * len(block.text)
    for form in reversed(forms):
        if form.outer is not None:
            form.outer.characters += form.characters
            form.outer.linked += form.linked
    total = sum(len(b.text) for b in blocks)
    for form in forms:
        form.frame = (2 * form.characters > total and (form.framed or form.characters - form.linked >= 200)
                      and (form.outer is None or form.outer.frame))
    return [b for b in blocks if b.place.form is None or b.place.form.frame]


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order; scripts, styles, forms, hidden elements and markup are left out.

    Unclosed and stray tags are taken as browsers take them in the common cases: an end tag closes up to its own
    element, block starts close an open paragraph, list items and cells close their kind, and the head ends where
    something begins that cannot stand in it. Time and memory grow with the page, however deep its elements nest.
    """
    stack = [Element("")]
    opened: Counter[str] = Counter()
    out: list[Block] = []
    forms: list[Form] = []
    words: list[tuple[str, bool]] = []
    links = articles = hidden = foreign = 0
    # The hidden inline element whose text is being passed over: its name, how many of the name are open, and the
    # depth at which it began.
    veil, veils, veiled = "", 0, 0

    def flush() -> None:
        if words:
            text = " ".join(html.unescape("".join(t for t, _ in words)).split())
            if text:
                inside = sum(len(t.strip()) for t, linked in words if linked)
                place = stack[-1]
                # Signs against content add up; of those for it the strongest counts, so that nesting proves nothing.
                out.append(Block(text, place, START + place.best + place.against, min(1.0, inside / len(text)),
                                 place.heading))
            words.clear()

    def close(depth: int) -> None:
        nonlocal articles, hidden, foreign, veil
        flush()
        for element in stack[depth:]:
            articles -= element.name in ("article", "main")
            foreign -= element.name in ("svg", "math")
            hidden -= element.skipped
            opened[element.name] -= 1
        del stack[depth:]
        if veil and len(stack) < veiled:
            veil = ""

    at, end = 0, len(page)
    while at < end:
        match = _TOKEN.search(page, at)
        text = page[at:match.start() if match else end]
        if stack[-1].name == "head" and not text.isspace() and text:
            close(len(stack) - 1)
        if text and not hidden and not veil:
            words.append((text, links > 0))
        if not match:
            break
        at = match.end()
        if match.group(2) is None:
            continue
        closing, name, attributes = bool(match.group(1)), match.group(2).lower(), match.group(3)
        if foreign and not closing and attributes.endswith("/"):
            continue
        if stack[-1].name == "head" and not closing and name not in IN_HEAD:
            close(len(stack) - 1)
        if name in INLINE:
            if veil:
                veils += (not closing) * (name == veil and name not in VOID) - (closing and name == veil)
                veil = veil if veils else ""
            elif not closing and name not in VOID and attributes and _hides(_attributes(attributes)):
                veil, veils, veiled = name, 1, len(stack)
            elif name == "a":
                links = max(0, links - 1) if closing else 1
            elif name == "br" and not hidden:
                words.append((" ", False))
            continue
        if name in UNSEEN and not foreign:
            if not closing:
                stop = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        links = 0 if name not in VOID else links
        if closing:
            if not opened[name]:
                flush()
                continue
            depth = len(stack) - 1
            while stack[depth].name != name:
                depth -= 1
            close(depth)
            continue
        if stack[-1].name in CLOSED_BY_BLOCK:
            close(len(stack) - 1)
        if name in ITEMS and (opened[name] or name in ("dt", "dd") and opened["dt"] + opened["dd"]):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name or name in ("dt", "dd") and stack[depth].name in ("dt", "dd"):
                    close(depth)
                    break
                if stack[depth].name in ITEMS[name]:
                    break
        flush()
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if name in VOID or attributes.endswith("/") and name in ("svg", "math"):
            continue
        odds, skipped = _element_odds(name, attributes, articles > 0)
        parent = stack[-1]
        form = parent.form
        if name == "form":
            form = Form(parent.form)
            forms.append(form)
        if form is not None and name in FRAMED:
            form.framed = True
        stack.append(Element(name, parent, max(parent.best, odds), parent.against + min(0.0, odds),
                             parent.heading or name in HEADINGS, skipped, form, len(stack)))
        opened[name] += 1
        articles += name in ("article", "main")
        foreign += name in ("svg", "math")
        hidden += skipped
    close(1)
    return _without_forms(out, forms)


def content_odds(block: Block) -> float:
    """The classifier: log-odds that a block is content, from where it stands and what it holds."""
    return (block.odds + PER_LOG_CHARACTER * math.log1p(len(block.text)) + LINKED * block.linked
            + HEADING * block.heading)


def _tree_distance(one: Element, two: Element) -> int:
    """Steps from one element to the other over the nearest one around both."""
    steps = 0
    while one is not two:
        if one.depth >= two.depth:
            one = one.parent
        else:
            two = two.parent
        steps += 1
    return steps


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: between neighbours on the page, stronger the nearer they are in the tree, and between
    a block and the one before it under the same parent."""
    out, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            distance = _tree_distance(blocks[i - 1].place, block.place)
            out.append((i - 1, i, ADJACENT + NEAR / (1 + distance)))
        parent = block.place.parent
        before = last.get(parent)
        if before is not None and before != i - 1:
            out.append((before, i, NEAR / 3))
        last[parent] = i
    return out


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each block lies on the content side of a minimum cut (ties go to boilerplate).

    A block with positive odds hangs on the source by that capacity, one with negative odds on the sink. Flow from
    the source runs along shortest free paths until none is left; what the source still reaches is content.
    """
    n = len(odds)
    near: list[list[int]] = [[] for _ in range(n)]
    to, free = [], []
    for a, b, capacity in edges:
        near[a].append(len(to))
        to.append(b)
        free.append(capacity)
        near[b].append(len(to))
        to.append(a)
        free.append(capacity)
    supply = [max(0.0, o) for o in odds]
    demand = [max(0.0, -o) for o in odds]
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i] > tiny)
        for i in queue:
            level[i] = 0
        found = False
        while queue:
            i = queue.popleft()
            found |= demand[i] > tiny
            for e in near[i]:
                if free[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not found:
            return [x >= 0 for x in level]
        place = [0] * n
        for source in range(n):
            while supply[source] > tiny:
                path, i = [], source
                while demand[i] <= tiny:
                    while place[i] < len(near[i]):
                        e = near[i][place[i]]
                        if free[e] > tiny and level[to[e]] == level[i] + 1:
                            break
                        place[i] += 1
                    if place[i] < len(near[i]):
                        path.append(near[i][place[i]])
                        i = to[path[-1]]
                    elif path:
                        i = to[path.pop() ^ 1]
                        place[i] += 1
                    else:
                        break
                if demand[i] <= tiny:
                    break
                flow = min([supply[source], demand[i], *(free[e] for e in path)])
                supply[source] -= flow
                demand[i] -= flow
                for e in path:
                    free[e] -= flow
                    free[e ^ 1] += flow


def main_text(page: str) -> str:
    """The content blocks of a page, joined by one space."""
    blocks = blocks_of(page)
    content = minimum_cut([content_odds(b) for b in blocks], edges_of(blocks))
    return " ".join(b.text for b, kept in zip(blocks, content) if kept)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row: key, url, text, n_chars, in one pass without a shuffle.

    NULL and empty pages give the empty text; pages without markup are one block. Nothing is cut off, whatever the
    length. Repeated rows, NULL keys and NULL urls pass through.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p) for p in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                           pa.array([len(t) for t in texts], pa.int64())],
                                          ["key", "url", "text", "n_chars"])

    rows = pages.select(pages[key].alias("key"), pages[url].alias("url"), text_of(page).alias("page"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("key", "url"))
    out = map_batches(rows, run, f"{kinds}, text string, n_chars long")
    return out.select(out["key"].alias(key), out["url"].alias(url), "text", "n_chars")
