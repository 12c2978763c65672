"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. A line's weight is its text length, without
weight if it lies in a part that cannot be article text (menus, footer, asides, dialogs) or if it is
mostly links. Weights are summed over windows of ``WINDOW`` lines. Text starts at a surge, where a
window rises over the threshold, and ends at a dive, where the window falls to nothing; the lines
between are kept, and with them what else stands in the same elements. This holds for every page.

A page's <article> and <main> parts weigh more than the rest if they hold the larger part of its
unlinked text (``OUTSIDE``); else all lines weigh the same. They are set apart by ``WINDOW`` empty
lines, so a window never joins the article with what follows it. Within them, parts that cannot be
article text do not count as lines, and lines of links belong to the text that they stand in.

Page headers, forms and what a class, id or role calls an advert, notice, comment and the like are
doubtful, and none of their lines counts, however long. Doubt about an element is given up, from
the outermost on, where it holds most of the page's unlinked text and the rest of the page has no
surge of its own; about forms and headers also where they hold nine tenths of it beside no <article>
or <main> (``_settled``). Inline elements are not doubted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.llm.workspace import ship

WINDOW = 3
SURGE = 80  # characters in a window, at most; less on pages whose fullest window is small
LINKED = 0.5  # share of link text from which a line has no weight
WRAPPER = 0.9  # share of the unlinked text from which a form or header is the page itself
OUTSIDE = 0.25  # weight of a character outside <article> and <main> where these hold most text

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe|select|button|object|canvas"
    r"|audio|video|annotation|annotation-xml|datalist)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp"
    " rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow"
    " mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mstyle mspace mpadded"
    " mphantom menclose mfenced mmultiscripts semantics".split()
)
_SPACED = frozenset(["td", "th"])
_NEVER = frozenset("nav footer aside head menu dialog".split())
_DOUBTED = frozenset(["form", "fieldset"])
_MAIN = frozenset(["article", "main"])
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies copyright disclaimer discussion disqus footer login masthead menu"
    " menubar modal nav navbar navigation newsletter notice notices overlay pager pagination paywall"
    " popup promo promos promotion promoted recommendation recommendations recommended related"
    " replies reply respond search share sharing sidebar sidebars signup skip social sponsor"
    " sponsored subscribe subscription toolbar widget complementary contentinfo".split()
)
# Parts that may stand beside a hint in a name; with others ("related-work") it is no hint.
_NEUTRAL = frozenset(
    "area article bar block blog body box button buttons container content div field fixed footer form"
    " google header icon icons inner item items left link links list main page panel post posts reader"
    " right section sidebar site slot sticky text title top bottom unit user wrap wrapper".split()
)
_APART = [("", 0, True, False, 0, ())] * WINDOW  # lines without text


def _is_hinted(attributes: str) -> bool:
    for match in _MARK.finditer(attributes):
        value = match[1] or match[2] or match[3] or ""
        for name in value.split():
            parts = {part.lower() for part in _PARTS.findall(name)}
            if parts & _HINTS and parts <= _HINTS | _NEUTRAL:
                return True
    return False


def _lines(html: str) -> Iterator[tuple[str, int, bool, bool, int, tuple[tuple[int, bool], ...]]]:
    """(text, characters in links, in a part that is never text, in the main part, number of the
    element it stands in, the doubtful elements around it) per line; elements directly in the body
    count as 0. A doubtful element is its number and whether a class, id or role makes it so.

    A line without text is yielded wherever a part begins or ends.
    """
    open_tags: list[tuple[str, bool, bool, bool]] = []  # name, never text, main part, doubtful
    doubted: tuple[tuple[int, bool], ...] = ()
    numbers: list[int] = []  # of the open tags
    count = 0
    never = main = links = 0
    words: list[str] = []
    linked = 0
    at = 0

    def line():
        nonlocal words, linked
        text, chars = " ".join("".join(words).split()), linked
        words, linked = [], 0
        number = numbers[-1] if numbers else 0
        return (text, chars, never > 0, main > 0, number, doubted) if text else None

    def push(name: str, is_never: bool, is_main: bool, is_doubted: bool, is_named: bool) -> None:
        nonlocal never, main, count, doubted
        count += 1
        open_tags.append((name, is_never, is_main, is_doubted))
        if is_doubted:
            doubted += ((count, is_named),)
        numbers.append(0 if name in ("body", "html") else count)
        never += is_never
        main += is_main

    def close(count: int) -> None:
        nonlocal never, main, doubted
        for _ in range(count):
            _, was_never, was_main, was_doubted = open_tags.pop()
            numbers.pop()
            if was_doubted:
                doubted = doubted[:-1]
            never -= was_never
            main -= was_main

    for match in _MARKUP.finditer(html):
        if match.start() > at:
            text = unescape(html[at : match.start()])
            words.append(text)
            if links:
                linked += len(text.strip())
        at = match.end()
        if match["raw"]:
            words.append(" ")
            continue
        if not match["name"]:
            continue
        name = match["name"].lower()
        if name in _SPACED:
            words.append(" ")
            continue
        if name in _INLINE:
            if name == "a":
                links = 0 if match["end"] else 1
            continue
        if found := line():
            yield found
        if open_tags and open_tags[-1][0] == "p":  # a block ends a paragraph
            close(1)
            yield "", 0, True, main > 0, 0, ()
        if match["end"]:
            for depth in range(len(open_tags)):
                if open_tags[-1 - depth][0] == name:
                    ended = open_tags[-1 - depth :]
                    if any(m for _, _, m, _ in ended):
                        yield from _APART
                    elif any(n or d for _, n, _, d in ended):
                        yield "", 0, True, main > 0, 0, ()
                    close(depth + 1)
                    break
        elif name not in _VOID and not match["attributes"].endswith("/"):
            is_main = name in _MAIN
            is_never = name in _NEVER
            is_named = (
                name not in ("body", "html") and not is_main and _is_hinted(match["attributes"])
            )
            is_doubted = is_named or name in _DOUBTED or (name == "header" and not main)
            apart = is_never or is_doubted
            if apart or is_main:
                yield from _APART if is_main else [("", 0, True, main > 0, 0, ())]
            if apart or name not in ("p", "li", "dt", "dd", "tr", "option"):
                push(name, is_never, is_main, is_doubted, is_named)
    if at < len(html):
        words.append(unescape(html[at:]))
    if found := line():
        yield found


def main_text(html: str | None) -> str:
    """The blocks of the main text, joined by line ends; empty if there is none."""
    lines = _settled(list(_lines(html or "")))
    inside = outside = 0
    for text, linked, never, main, _, doubted in lines:
        if not never and not doubted:
            own = max(len(text) - linked, 0)
            inside, outside = (inside + own, outside) if main else (inside, outside + own)
    marked = 0 < inside >= outside
    plain = [k for k, x in enumerate(lines) if not (marked and x[3] and (x[2] or x[5]))]
    weights = [0.0] * len(plain)
    for i, k in enumerate(plain):
        text, linked, never, main, _, doubted = lines[k]
        if text and not never and not doubted and linked < LINKED * len(text):
            weights[i] = len(text) * (OUTSIDE if marked and not main else 1)
    fullest = max(_windows(weights), default=0)
    kept = set()
    for start, end in _surges(weights, min(SURGE, fullest / 2)):
        own = {i for i in range(start, end) if _belongs(lines[plain[i]], weights[i], marked)}
        # Lines of links between the lines of an element belong to its text.
        edges: dict[int, tuple[int, int]] = {}
        for i in sorted(own):
            element = lines[plain[i]][4]
            edges[element] = (edges.get(element, (i, i))[0], i)
        for i in range(start, end):
            text, _, never, _, element, doubted = lines[plain[i]]
            first, last = edges.get(element, (end, end))
            if first < i < last and text and not never and not doubted:
                own.add(i)
        kept |= own
    # A notice or advert within the text's own element does not end the text.
    elements = {lines[plain[i]][4] for i in kept} - {0}
    kept.update(
        i
        for i, k in enumerate(plain)
        if lines[k][4] in elements and _belongs(lines[k], weights[i], marked)
    )
    return "\n".join(lines[plain[i]][0] for i in sorted(kept))


def _settled(lines: list[tuple]) -> list[tuple]:
    """``lines`` without doubt about elements that hold the page's text themselves."""
    while True:
        total = marked = 0
        held: dict[int, int] = {}  # unlinked text by doubtful element
        named: dict[int, bool] = {}  # whether a class, id or role makes it doubtful
        rest = []
        for text, linked, never, main, _, doubted in lines:
            own = 0 if never else max(len(text) - linked, 0)
            total += own
            marked += own if main and not doubted else 0
            if text or never:
                rest.append(own if not doubted and linked < LINKED * len(text) else 0)
            for number, is_named in doubted:
                held[number] = held.get(number, 0) + own
                named[number] = is_named
        surges = max(_windows(rest), default=0) >= SURGE
        least = max(3 * marked, WINDOW * SURGE) if marked else 0
        found = [
            number
            for number, own in held.items()
            if (not surges and 2 * own > total and own > least)
            or (not named[number] and not marked and own >= WRAPPER * total > 0)
        ]
        if not found:
            return lines
        outer = min(found)
        lines = [(*x[:5], tuple(d for d in x[5] if d[0] != outer)) for x in lines]


def _windows(weights: list[float]) -> list[float]:
    """Sum of the ``WINDOW`` weights from each line on."""
    padded = [*weights, *[0] * WINDOW]
    return [sum(padded[i : i + WINDOW]) for i in range(len(weights))]


def _surges(weights: list[float], surge: float) -> Iterator[tuple[int, int]]:
    """Start and end of the runs of windows that hold a surge."""
    sums = _windows(weights)
    start = None
    for i, total in enumerate([*sums, 0]):
        if total > 0 and start is None:
            start = i
        elif total == 0 and start is not None:
            if max(sums[start:i]) >= surge:
                yield start, i
            start = None


def _belongs(line: tuple, weight: float, marked: bool) -> bool:
    """Whether a line near kept ones is text: it has weight, or stands in the marked main part."""
    text, _, never, main, _, doubted = line
    return not doubted and (weight > 0 or bool(marked and main and text and not never))


def extract_main_text(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """Add the main text of every page as column ``into``.

    Pages that are null, empty or without text give an empty text. Whole pages are read, whatever
    their length; unclosed elements, comments and quotes end with the page. Equal pages give equal
    texts; an empty table stays empty. An input column named ``into`` is replaced.
    """
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h) for h in batch], dtype=object)

    kept = [c for c in pages.columns if c != into]
    return pages.select(*kept, texts(F.col(html)).alias(into))
