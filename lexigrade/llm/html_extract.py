"""Main text of web pages by tag-path ratios.

A page is split into text nodes, each with its path of open elements. Per path the text length, the punctuation and
the link text are summed over its nodes. The ratio of text to nodes and the ratio of punctuation are smoothed over the
neighbouring nodes of the page and multiplied (the fused score of a path). Furniture elements have no score. A class, id
or role that names furniture lowers the score of its paths by their share of the page's text and punctuation: to nothing
where the rest of the page holds more, not at all where they hold most. All other paths are content if their score passes a
share of the spread of the scores, a smaller one for paragraphs, headings and items, and most of their text is no link text. No
single subtree is chosen, so an article of several parts is kept whole.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template noscript iframe svg math xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FURNITURE = frozenset("nav header footer aside form menu dialog button select head object audio video canvas template".split())
LISTS = frozenset("ul ol dl table select".split())
#: Blocks that are mostly text, however short.
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote caption".split())
#: Elements that hold the page or the article, whatever their class says.
WHOLE = frozenset("html body main article".split())
#: Words in class, id or role that name furniture.
FURNITURE_WORD = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|sponsor(?:ed)?|promo(?:tions?)?|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|"
    r"aside|footer|header|masthead|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|"
    r"comments?|commentlist|disqus|replies|reply|respond|discussion|related|recommend(?:ed|ations)?|share|sharing|social|toolbar|pagination|"
    r"pager|widget|search|contentinfo|complementary|hidden|skip|copyright|legal|paywall|tags?|byline)(?:$|[\s_-])",
    re.IGNORECASE,
)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL)
NAMES = re.compile(r"""(?:^|\s)(class|id|role|aria-label|hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
PUNCTUATION = re.compile(r"[.,;:!?…¿¡、。，！？；：]")
SPACES = re.compile(r"\s+")


class ExtractParams(NamedTuple):
    threshold: float = 0.1
    smooth: float = 1.0
    beside_share: float = 0.95
    # Of the threshold, for paths that end in a paragraph, heading or item.
    named_share: float = 0.2


class Node(NamedTuple):
    path: int
    block: int
    text: str
    links: int
    furniture: bool


class Page(NamedTuple):
    """Text nodes in page order; of every path its last element and whether it lies in a main or article element; and the marks.

    A mark is the place of a named element: the path above it, its tag and the words. It stands over ranges of nodes."""

    nodes: list[Node]
    names: list[str]
    declared: list[bool]
    marks: list[tuple[int, list[tuple[int, int]]]]


def furniture(tag: str, attributes: str) -> bool:
    """Whether an element is furniture by what it is, not by a name that was given to it."""
    if tag in FURNITURE or not attributes:
        return tag in FURNITURE
    for name, value in NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def furniture_words(tag: str, attributes: str) -> tuple[str, ...]:
    """Words in the names of an element that name furniture."""
    if tag in WHOLE or not attributes:
        return ()
    names = [v.strip("\"'") for n, v in NAMES.findall(attributes) if n.lower() in ("class", "id", "role", "aria-label")]
    return tuple(sorted({m[0].strip(" \t\n\r\f\v_-").lower() for v in names for m in FURNITURE_WORD.finditer(v)}))


class _Open(NamedTuple):
    tag: str
    full: int
    path: int
    furniture: bool
    mark: int | None
    start: int


class _Stack:
    """Open elements. Paths are numbered by (parent, step) and places of tags are kept, so a step costs the same at any depth."""

    def __init__(self) -> None:
        self.open: list[_Open] = []
        self.places: dict[str, list[int]] = {}
        self.solid: list[int] = []
        self.ids: dict[tuple[int, str], int] = {}
        self.names, self.declared = [""], [False]
        self.full_ids: dict[tuple[int, str], int] = {}
        self.mark_ids: dict[tuple, int] = {}
        self.marks: list[tuple[int, list[tuple[int, int]]]] = []
        self.furniture = 0

    def last(self, tags: frozenset[str] | set[str]) -> int:
        """Place of the innermost open element of these tags, -1 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def push(self, tag: str, step: str, furniture: bool, words: tuple[str, ...], start: int) -> None:
        above = self.open[-1] if self.open else None
        parent, full = (above.path, above.full) if above else (0, 0)
        path = parent
        if tag not in INLINE:
            path = self.ids.setdefault((parent, step), len(self.names))
            if path == len(self.names):
                self.names.append(tag)
                self.declared.append(self.declared[parent] or tag in ("main", "article"))
            self.solid.append(len(self.open))
        mark = None
        if words:
            mark = self.mark_ids.setdefault((full, tag, words), len(self.marks))
            if mark == len(self.marks):
                self.marks.append((len(self.open), []))
        self.places.setdefault(tag, []).append(len(self.open))
        self.furniture += furniture
        self.open.append(_Open(tag, self.full_ids.setdefault((full, step), len(self.full_ids) + 1), path, furniture, mark, start))

    def close_from(self, place: int, end: int) -> None:
        while len(self.open) > place:
            gone = self.open.pop()
            self.places[gone.tag].pop()
            if self.solid and self.solid[-1] == len(self.open):
                self.solid.pop()
            self.furniture -= gone.furniture
            if gone.mark is not None and end > gone.start:
                self.marks[gone.mark][1].append((gone.start, end))


def nodes(html: str) -> Page:
    """Text nodes in page order. Unclosed paragraphs, items and cells end where the standard ends them."""
    stack, out = _Stack(), []
    block, at = 0, 0

    def text(raw: str) -> None:
        clean = SPACES.sub(" ", unescape(raw) if "&" in raw else raw)
        if clean:
            linked = bool(stack.places.get("a"))
            out.append(Node(stack.open[-1].path if stack.open else 0, block, clean, len(clean) if linked else 0, stack.furniture > 0))

    while True:
        match = TOKEN.search(html, at)
        if not match:
            text(html[at:])
            stack.close_from(0, len(out))
            return Page(out, stack.names, stack.declared, [m for m in stack.marks if m[1]])
        if match.start() > at:
            text(html[at : match.start()])
        at = match.end()
        if not match[2]:
            if match[0].startswith("<![CDATA["):
                text(match[0][9:].removesuffix("]]>"))
            continue
        tag, attributes = match[2].lower(), match[3]
        if tag not in INLINE:
            block += 1
        if match[1]:
            if (place := stack.last({tag})) >= 0:
                stack.close_from(place, len(out))
            continue
        if tag in CLOSES_P and stack.solid and stack.open[stack.solid[-1]].tag == "p":
            stack.close_from(stack.solid[-1], len(out))
        if tag in SAME_CLOSES and (place := stack.last(SAME_CLOSES[tag])) > stack.last(LISTS):
            stack.close_from(place, len(out))
        if tag in VOID or attributes.endswith("/") and tag in RAW:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(html, at)
            at = close.end() if close else len(html)
            continue
        kind = next((v.strip("\"'") for n, v in NAMES.findall(attributes) if n.lower() == "class"), "") if attributes else ""
        # The header of an article holds its heading.
        inside = tag == "header" and stack.last({"article", "main"}) >= 0
        stack.push(tag, f"{tag}.{kind}" if kind else tag, furniture(tag, attributes) and not inside, furniture_words(tag, attributes), len(out))


def smoothed(values: np.ndarray, width: float) -> np.ndarray:
    """Gaussian mean over the neighbouring nodes."""
    reach = np.arange(-2, 3)
    weights = np.exp(-(reach**2) / (2 * width**2))
    padded = np.pad(values, 2, mode="edge")
    return np.convolve(padded, weights / weights.sum(), mode="valid")


def outweighed(page: Page, mass: np.ndarray, params: ExtractParams) -> np.ndarray:
    """Whether each node stands under a mark whose nodes hold less of the mass than the rest that is kept.

    The heaviest marks are weighed first, the outer of two equal ones before the inner; a mark that holds at least as
    much as all nodes without one, or with none but such marks, is no furniture. Beside an article or main element
    without a mark it must hold nearly all.
    """
    left = np.zeros(len(mass), dtype=np.int64)
    if not page.marks:
        return left > 0
    under = [np.concatenate([np.arange(low, high) for low, high in ranges]) for _, ranges in page.marks]
    total = [mass[of].sum() for of in under]
    for of in under:
        left[of] += 1
    declared = np.array(page.declared)[[x.path for x in page.nodes]] & (mass > 0)
    for m in sorted(range(len(under)), key=lambda m: (-total[m], page.marks[m][0])):
        of = under[m]
        rest = left == 0
        rest[of] = False
        beside = (declared & rest).any() and not declared[of].any()
        share = params.beside_share if beside else 0.5
        if total[m] and total[m] * (1 - share) >= mass[rest].sum() * share:
            left[of] -= 1
    return left > 0


def content(page: Page, params: ExtractParams) -> list[bool]:
    """Whether each node is content."""
    found = page.nodes
    n = len(found)
    _, of = np.unique([x.path for x in found], return_inverse=True)
    n_paths = int(of.max()) + 1
    size = np.array([len(x.text.strip()) for x in found], float)
    marks = np.array([len(PUNCTUATION.findall(x.text)) for x in found], float)
    linked = np.array([x.links for x in found], float)
    per = lambda v: np.bincount(of, v, n_paths)
    count, chars = per(np.ones(n)), per(size)
    text_ratio = chars / count
    mark_ratio = per(marks) / count
    link_share = per(linked) / np.maximum(chars, 1)
    plain = np.array([not x.furniture for x in found])
    fused = smoothed(text_ratio[of], params.smooth) * (1 + smoothed(mark_ratio[of], params.smooth)) * (1 - link_share[of])
    plain &= ~outweighed(page, np.where(plain, (size + marks) * (1 - link_share[of]), 0), params)
    score = np.where(plain & (size > 0), fused, 0)
    if not score.any():
        return [False] * n
    level = params.threshold * score[plain & (size > 0)].std()
    named = np.array([page.names[x.path] in BLOCKS for x in found])
    # A telling element lowers what its path must score; it spares no path the threshold.
    needed = np.where(named, level * params.named_share, level)
    return (plain & (link_share[of] < 0.5) & (score >= needed)).tolist()


def main_text(html: str | None, params: ExtractParams = ExtractParams()) -> str:
    """Blocks of content in page order, joined by one space; white space inside a block is one space."""
    if not html:
        return ""
    page = nodes(html)
    if not page.nodes:
        return ""
    kept = content(page, params)
    blocks: dict[int, list[str]] = {}
    for node, ok in zip(page.nodes, kept):
        if ok:
            blocks.setdefault(node.block, []).append(node.text)
    joined = (SPACES.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return " ".join(b for b in joined if b)


def extract(pages: DataFrame, params: ExtractParams = ExtractParams()) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text).

    A null or empty page, or one without content, has an empty text. Pages are read whole; repeated rows are extracted
    each; other columns are ignored; an empty table gives no rows.
    """

    @F.arrow_udf("string")
    def read(pages_: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py(), params) for p in pages_], pa.string())

    found = pages.select("page_id", "url", read("html").alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
