"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass looks at each block by itself: its
share of characters inside links, its share of stop words, its length, and what surrounds it
(navigation, page header and footer, asides, forms, and elements whose class or id says advert,
comment, notice ...). It decides for text, against it, or leaves the block open: short blocks
and blocks with few stop words say little about themselves. The second pass lets every open block
inherit the label of the nearest decided block of its section; between two equally near ones that
differ, and in a section without decided blocks, blocks of an article count as text and others
do not.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import append_columns

# Element kinds of HTML.
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
            "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
            "ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
RAW = set("script style noscript template textarea iframe svg math object select button head title "
          "canvas audio video datalist".split())
OPAQUE = {"script", "style", "textarea", "title"}  # their content holds no tags
CONTAINER = set("article aside div dl fieldset figure footer form header main menu nav ol section table ul dialog "
                "details blockquote body li td".split())
BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "header", "fieldset"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# What class and id names call boilerplate.
BOILER_NAMES = re.compile(
    r"(?:^|[\s_\-])(?:ads?|adverts?|advertisements?|advertising|adsense|banners?|sponsor(?:ed|s)?|promos?|promotions?|"
    r"comments?|commentlist|disqus|respond|replies|cookies?|consent|gdpr|notices?|alerts?|disclaimers?|popups?|modal|overlay|"
    r"sidebars?|side|menus?|nav|navbar|navigation|breadcrumbs?|pagination|pager|footer|foot|header|masthead|topbar|"
    r"social|share|sharing|newsletter|subscribe|signup|login|search|related|recommended|widgets?|toolbar|skip)"
    r"(?:$|[\s_\-])|(?:comment|sidebar|cookie|advert|newsletter)", re.I)
COMMENT_NAMES = re.compile(r"(?:comments?|replies|reply)(?:$|[_\-])(?!open|closed|enabled|disabled|on$|off$)", re.I)
# What tells that a name speaks of the page's layout or state, not of its own content.
STATE_NAMES = re.compile(r"^(?:has|with|no|without|is|show|hide|not)[_\-]|[_\-](?:open|closed|enabled|disabled|on|off|active|allowed)$", re.I)
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in is it that for was on are as with be at by this from or an have not they you his her which one "
    "we were all their has will there been if more when who would so no what up out about than them can its "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis "
    "le la les de des et un une du en que qui dans pour pas sur au par avec ce il est se ne plus sont ou son sa ses "
    "aux mais comme nous vous ils elle cette été leur "
    "el los las y del que en un una por con para se no al lo como más su sus es o este sí porque esta entre cuando "
    "muy sin sobre también me hasta hay donde quien desde todo nos a".split())

LINKS_HIGH = 0.5      # above: a list of links
LINKS_SOME = 0.2      # above, outside an article: a list of links
STOPS_HIGH, STOPS_LOW = 0.30, 0.12
STOPS_FOREIGN = 0.06  # below, on the whole page: length and links decide
LONG, SHORT = 200, 70  # characters

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|$)", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HEAD_END = re.compile(r"</head\s*>|<body\b", re.I)
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int
    boiler: bool      # in an element that holds boilerplate
    named: bool       # in one whose class or id says so
    section: int      # number of the innermost article or main, 0 outside
    heading: bool
    label: str = field(default="open")


def blocks(page: str) -> list[Block]:
    """Blocks of a page with text in them, in page order."""
    out: list[Block] = []
    parts: list[str] = []
    # open containers: name; boilerplate by element, by name, and section, each from the outside in
    stack: list[tuple[str, bool, bool, int]] = [("", False, False, 0)]
    still = Counter()  # how many of each are open
    state = {"links": 0, "linked": 0, "heading": False, "sections": 0}

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, state["linked"], *stack[-1][1:], state["heading"]))
            parts.clear()
        state["linked"] = 0

    def add(s):
        parts.append(s)
        if state["links"]:
            state["linked"] += len("".join(html.unescape(s).split()))

    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m.group("close"))
        attrs = m.group("attrs")
        if tag == "br":
            add(" ")
            continue
        if tag in RAW and not closing and not attrs.rstrip().endswith("/"):
            if tag in BLOCK:
                flush()
            end = (HEAD_END if tag == "head" else re.compile(rf"</{re.escape(tag)}\s*>", re.I)).search(page, at)
            if end:
                at = end.end() if end.group().startswith("</") else end.start()
            elif tag in OPAQUE:
                at = len(page)
            continue
        if tag == "a":
            state["links"] = max(0, state["links"] - 1) if closing else 1
        if tag not in BLOCK:
            continue
        flush()
        state["links"] = 0
        state["heading"] = not closing and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
        if tag not in CONTAINER or tag in VOID:
            continue
        if closing:
            while still[tag]:
                gone = stack.pop()[0]
                still[gone] -= 1
                if gone == tag:
                    break
        else:
            _, hard, named, section = stack[-1]
            names = " ".join(a or b or c for a, b, c in NAMES.findall(attrs)).split()
            named |= tag not in ("body", "main", "article") and any(
                BOILER_NAMES.search(n) and not STATE_NAMES.search(n) for n in names)
            # a comment may be an article of its own
            named |= tag == "article" and any(COMMENT_NAMES.match(n) for n in names)
            hard |= tag in BOILERPLATE and not (tag == "header" and section)
            if tag in ("article", "main"):
                state["sections"] += 1
                section = state["sections"]
            still[tag] += 1
            stack.append((tag, hard, named, section))
    flush()
    return out


def judged(found: list[Block], by_name: bool = True) -> list[Block]:
    """The blocks with both passes' labels (good or bad); ``by_name``: class and id names count."""
    shares = []
    for b in found:
        words = WORD.findall(b.text.lower())
        shares.append((b.boiler or by_name and b.named, sum(w in STOP_WORDS for w in words), len(words),
                       b.linked / max(1, len(b.text.replace(" ", "")))))
    plain = [(b, stops, words) for b, (boiler, stops, words, links) in zip(found, shares)
             if not boiler and links <= LINKS_SOME]
    # few function words on the whole page: a language that the list does not know
    foreign = sum(s for _, s, _ in plain) < STOPS_FOREIGN * sum(w for _, _, w in plain)
    inside = sum(len(b.text) for b, _, _ in plain if b.section)
    outside = sum(len(b.text) for b, _, _ in plain if not b.section and len(b.text) >= LONG)
    in_article = any(b.section and not boiler for b, (boiler, *_) in zip(found, shares)) and outside <= 2 * inside
    for b, (boiler, stops, words, links) in zip(found, shares):
        stops = stops / words if words else 0.0
        size = len(b.text)
        if boiler or links > LINKS_HIGH or (links > LINKS_SOME and not b.section):
            b.label = "bad"
        elif in_article and not b.section:
            b.label = "bad"
        elif b.heading or size < SHORT:
            b.label = "open"
        elif stops >= STOPS_HIGH or ((stops >= STOPS_LOW or foreign) and size >= LONG):
            b.label = "good"
        elif stops < STOPS_LOW and size < LONG and not b.section and links > 0:
            b.label = "bad"
        else:
            b.label = "open"
    decided: dict[int, list[int]] = {}  # decided blocks of each section, in page order
    for i, b in enumerate(found):
        if b.label != "open":
            decided.setdefault(b.section, []).append(i)
    labels = [b.label for b in found]
    for i, b in enumerate(found):
        if b.label != "open":
            continue
        own = _near(decided.get(b.section, []), labels, i)
        least = min((d for d, _ in own), default=None)
        nearest = {label for d, label in own if d == least}
        if len(nearest) == 1 and not (b.section and "bad" in nearest):
            b.label = nearest.pop()
        elif b.section:
            # a list of links beside it says nothing about a line of an article
            b.label = "good"
        else:
            b.label = "good" if not decided else "bad"
    return found


def _near(decided: list[int], labels: list[str], i: int):
    """(distance, label) of the nearest decided blocks on both sides."""
    at = bisect.bisect_left(decided, i)
    return [(abs(decided[j] - i), labels[decided[j]]) for j in (at - 1, at) if 0 <= j < len(decided)]


def main_text(page) -> str:
    """The main text of a page. Names decide only as long as something is left beside what they
    condemn: a page that would be empty without it is judged by its blocks alone."""
    if not page:
        return ""
    found = blocks(page)
    text = "\n\n".join(b.text for b in judged(found) if b.label == "good")
    if not text and any(b.named for b in found):
        text = "\n\n".join(b.text for b in judged(found, by_name=False) if b.label == "good")
    return text


EXTRACTED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and its length ``n_chars`` in code points.

    NULL, empty and textless pages have an empty text. Pages of any length and depth are read whole,
    in time that grows with their length. Columns of these names are replaced, all others are kept;
    repeated rows are treated alike.
    """

    def run(column):
        texts = [main_text(p) for p in column.to_pylist()]
        return texts, [len(t) for t in texts]

    return append_columns(pages, run, [html_col], EXTRACTED)
