"""Main text of web pages by tag-path ratios.

A page is read once into its text blocks, each with its root-to-leaf path of
block tags. Text length and punctuation are summed per path and divided by
the path's number of blocks; the two ratios are smoothed along the page,
fused by their product, and a path is content if its fused ratio reaches a
threshold between the page's mean and its deviation. The main text is every
block of a content path; every other block of a content node (the deepest
element that holds nearly all content, the containers of what lies outside it,
and the ``article`` around any of them), short headings, lists and captions
included; and headings and paragraphs next to those.

What is never article text is left out while reading: scripts, styles and
other non-text elements, navigation, asides, headers and footers of the page.
Forms, and elements whose class, id or role has a word for menus, sidebars,
notices, adverts, comments and the like, are left out unless they are around
the article: they hold most of the page's text and punctuation, and no longer
``article`` or ``main`` stands elsewhere. (What readers wrote may be most of a
page; beside a title elsewhere it is kept only from nine tenths on.)

Defined results: a null or empty html, and a page without text, give an empty
text; open elements end where their parent or a following block ends them;
rows are judged one by one, repeated or not; an empty table gives an empty
result; a column named like the added one is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakwatch.llm import cells as C

# Element names of HTML by what they mean here.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
LEFT_OUT = set(
    "head title script style noscript template nav footer aside button select option textarea input label iframe object embed applet canvas svg math audio video map menu dialog".split()
)
#: Left out like elements with a name of ``NAMES``: unless they are around the article.
DOUBTFUL = {"form", "fieldset"}
#: An element ends when one of these opens inside it.
ENDED_BY = {
    "p": set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"},
}
#: An implied end does not reach beyond these.
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}, "p": {"td", "th", "table", "button", "object"}}
#: Words of class, id and role names that mark what is not the article.
NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner breadcrumb breadcrumbs comment comments commentlist disqus consent cookie cookies "
    "copyright dialog disclaimer footer form gdpr login masthead menu menubar modal nav navbar navigation navigationbar newsletter notice notices notification pager "
    "pagination paywall popup promo promoted promotion promotions related recommend recommended recommendations replies reply respond search share sharing sharebar "
    "sidebar side sidebars signup skip skyscraper social sponsor sponsored subscribe subscription tagcloud toolbar topbar widget widgets complementary contentinfo alert "
    "discussion feedback responses"
    .split()
)
HEADER_NAMES = {"header", "siteheader", "pageheader"}
#: Those of what readers write, which may be longer than the article.
READERS = set("comment comments commentlist disqus replies reply respond discussion feedback responses".split())

#: Elements of text, not containers of it.
LEAVES = set("p blockquote pre li ul ol td tr tbody table h1 h2 h3 h4 h5 h6".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PARAGRAPHS = {"p", "blockquote", "pre", "figcaption"}
#: Blocks looked at on either side of kept ones, and characters of a short block.
NEXT_TO, SHORT = 5, 200

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)(?:>|\Z)""", re.S)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)|(?=[\s/>]|$))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_MARKS = re.compile(r"[.,;:!?…。，、；：！？]")


@dataclass
class Element:
    name: str
    parent: int
    path: str
    out: bool
    depth: int
    #: Words that speak against the element as part of an article.
    doubt: frozenset[str] = frozenset()


@dataclass
class Page:
    elements: list[Element] = field(default_factory=lambda: [Element("", -1, "", False, 0)])
    #: (element, text) of every block
    blocks: list[tuple[int, str]] = field(default_factory=list)
    #: For each block its element, and the pieces of its text with theirs.
    raw: list[tuple[int, list[tuple[int, str]]]] = field(default_factory=list)


def _doubt(name: str, rest: str, inside_article: bool) -> set[str] | None:
    """The element's names that mark it as no part of an article; None if it is hidden."""
    doubt: set[str] = set()
    for key, value in _NAMED.findall(rest):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return None
        if key in ("class", "id", "role"):
            if name in ("html", "body", "main", "article") and key != "role":
                if name == "article":
                    doubt |= {"comment", "comments", "ad", "advert", "sponsored", "promo"}.intersection(_name_words(value))
                continue
            words = set(_name_words(value))
            doubt |= words & (NAMES if inside_article else NAMES | HEADER_NAMES)
    return doubt


def _name_words(value: str) -> list[str]:
    parts = re.split(r"[\s_\-:]+", value)
    return [w.lower() for p in parts for w in (p, *_WORDS.findall(p))]


def read(html: str) -> Page:
    """The page's elements and text blocks."""
    page = Page()
    elements, stack, text = page.elements, [0], []
    at, raw_end = 0, None

    def block() -> None:
        if text:
            owner = stack[-1]
            while elements[owner].name in INLINE:
                owner = elements[owner].parent
            page.raw.append((owner, text.copy()))
            text.clear()

    def pop_to(i: int) -> None:
        if any(elements[e].name not in INLINE for e in stack[i:]):
            block()
        del stack[i:]

    def shown() -> bool:
        return not elements[stack[-1]].out

    while True:
        m = _TAG.search(html, at)
        if shown():
            text.append((stack[-1], html[at : m.start() if m else len(html)]))
        if not m:
            break
        at = m.end()
        name = m["name"]
        if name is None:
            if m["cdata"] and shown():
                text.append((stack[-1], m["cdata"].replace("&", "&amp;")))
            continue
        name = name.lower()
        if m["close"]:
            if name == "br":
                text.append((stack[-1], " "))
            for i in range(len(stack) - 1, 0, -1):
                if elements[stack[i]].name == name:
                    pop_to(i)
                    break
                if name in INLINE and elements[stack[i]].name not in INLINE:
                    break  # a stray inline end does not close blocks
            continue
        if name == "br":
            text.append((stack[-1], " "))
            continue
        for i in range(len(stack) - 1, 0, -1):
            here = elements[stack[i]].name
            if name in ENDED_BY.get(here, ()):
                pop_to(i)
                break
            if name in SCOPE and here in SCOPE[name]:
                break
        if name not in INLINE:
            block()
        if name in VOID or (m["rest"].endswith("/") and name in LEFT_OUT | DOUBTFUL):
            continue
        up = elements[stack[-1]]
        inside = "/article" in up.path or "/main" in up.path
        doubt = _doubt(name, m["rest"], inside) if m["rest"] else set()
        out = up.out or name in LEFT_OUT or (name == "header" and not inside) or doubt is None
        path = up.path if name in INLINE else f"{up.path}/{name}"
        elements.append(Element(name, stack[-1], path, out, up.depth + 1, frozenset((doubt or set()) | ({name} & DOUBTFUL))))
        stack.append(len(elements) - 1)
        if name in RAW:
            raw_end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = raw_end.end() if raw_end else len(html)
            pop_to(len(stack) - 1)
    pop_to(1)
    block()
    _settle(page)
    return page


def _settle(page: Page) -> None:
    """Leave the doubtful elements out that are not around the article, and put the blocks together."""
    elements = page.elements
    length, marks = [0] * len(elements), [0] * len(elements)
    if any(e.doubt for e in elements):
        for _, pieces in page.raw:
            for e, t in pieces:
                t = " ".join(unescape(t).split())
                length[e] += len(t)
                marks[e] += len(_MARKS.findall(t))
        for i in range(len(elements) - 1, 0, -1):
            length[elements[i].parent] += length[i]
            marks[elements[i].parent] += marks[i]
    ends = list(range(1, len(elements) + 1))  # an element's descendants follow it up to here
    for i in range(len(elements) - 1, 0, -1):
        ends[elements[i].parent] = max(ends[elements[i].parent], ends[i])
    marked = [k for k, e in enumerate(elements) if e.name in ("article", "main", "h1") and not e.out and not e.doubt]
    for i in range(1, len(elements)):
        e = elements[i]
        e.out = e.out or elements[e.parent].out or (bool(e.doubt) and not _around(elements, i, ends, marked, length, marks))
    for owner, pieces in page.raw:
        words = unescape("".join(t for e, t in pieces if not elements[e].out)).split()
        if words:
            page.blocks.append((owner, " ".join(words)))


def _around(elements: list[Element], i: int, ends: list[int], marked: list[int], length: list[int], marks: list[int]) -> bool:
    """Whether a doubtful element is around the article: it holds most of the
    page's text and punctuation, and the article is not elsewhere."""
    if 2 * length[i] <= length[0] or (marks[0] and 2 * marks[i] <= marks[0]):
        return False
    within = [length[k] for k in marked if i < k < ends[i] and elements[k].name != "h1"]
    elsewhere = [k for k in marked if (k >= ends[i] or ends[k] <= i) and not elements[k].out]
    longest = max((length[k] for k in elsewhere if elements[k].name != "h1"), default=0)
    if within or 10 * longest >= length[0]:
        return max(within, default=0) >= longest
    title = any(elements[k].name == "h1" and length[k] for k in elsewhere)
    return not (elements[i].doubt & READERS and title and 10 * length[i] < 9 * length[0])


def _smooth(x: np.ndarray) -> np.ndarray:
    """Weighted mean of each value and its neighbours (Gaussian, radius 2)."""
    weights = np.exp(-np.arange(-2, 3) ** 2 / 2.0)
    padded = np.pad(x, 2)
    ones = np.pad(np.ones(len(x)), 2)
    return np.convolve(padded, weights, "valid") / np.convolve(ones, weights, "valid")


def content_paths(page: Page) -> np.ndarray:
    """For each block whether its path is content."""
    paths: dict[str, int] = {}
    at = np.array([paths.setdefault(page.elements[e].path, len(paths)) for e, _ in page.blocks])
    length = np.array([len(t) for _, t in page.blocks], float)
    marks = np.array([len(_MARKS.findall(t)) for _, t in page.blocks], float)
    count = np.bincount(at)
    text_ratio = np.bincount(at, weights=length) / count
    mark_ratio = (np.bincount(at, weights=marks) + 0.5) / count
    fused = _smooth(text_ratio[at]) * _smooth(mark_ratio[at])
    fused = np.bincount(at, weights=fused) / count  # one value per path again
    threshold = min(fused[at].mean(), 0.8 * fused[at].std() + 1e-9) if len(paths) > 1 else 0.0
    return fused[at] >= threshold


def _container(page: Page, e: int) -> int:
    """The block around a paragraph: it is a leaf, not a container."""
    while page.elements[e].name in LEAVES:
        e = page.elements[e].parent
    return e


def content_nodes(page: Page, content: np.ndarray, share: float = 0.9) -> set[int]:
    """Elements taken whole: the deepest that holds at least ``share`` of the
    content text, if it is less than the page, and of what lies outside the
    first containers of paragraphs whose text is mostly content. A node in an
    ``article`` stands for all of that."""
    elements = page.elements
    held, text, own = ([0] * len(elements) for _ in range(3))
    for (e, t), on in zip(page.blocks, content, strict=True):
        text[e] += len(t)
        if on:
            held[e] += len(t)
            own[_container(page, e)] += len(t)
    for i in range(len(elements) - 1, 0, -1):
        held[elements[i].parent] += held[i]
        text[elements[i].parent] += text[i]
    best = _container(page, max((e for e in range(len(elements)) if held[e] >= share * held[0]), key=lambda e: (elements[e].depth, -e)))
    nodes = {best} if elements[best].name not in ("", "html", "body") or own[best] > (1 - share) * held[0] else set()
    above, e = set(), best
    while e >= 0:
        above.add(e)
        e = elements[e].parent
    taken = [False] * len(elements)
    for i, e in enumerate(elements):
        taken[i] = i in nodes or (e.parent >= 0 and taken[e.parent])
        if not taken[i] and i not in above and own[i] and 2 * held[i] >= text[i]:
            nodes.add(i)
            taken[i] = True
    article = [-1] * len(elements)
    for i, e in enumerate(elements[1:], 1):
        article[i] = i if e.name == "article" else article[e.parent]
    return {article[e] if article[e] >= 0 else e for e in nodes}


def _next_to(page: Page, kept: list[bool]) -> list[bool]:
    """``kept`` with the headings before kept blocks, the short blocks between
    the two, and the paragraphs beside kept blocks."""
    elements, blocks, out = page.elements, page.blocks, list(kept)

    def above(e: int) -> set[int]:
        found = set()
        while e >= 0:
            found.add(e)
            e = elements[e].parent
        return found

    for s in [i for i in range(1, len(kept)) if kept[i] and not kept[i - 1]]:
        around, beside = above(blocks[s][0]), True
        for i in range(s - 1, max(-1, s - 1 - NEXT_TO), -1):
            e, t = blocks[i]
            if kept[i] or len(t) > SHORT and not (beside and elements[e].name in PARAGRAPHS):
                break
            c = _container(page, e)
            near = c in around
            if elements[e].name in HEADINGS and (near or elements[c].parent in around):
                out[i:s] = [True] * (s - i)  # the last one found is the first of them
            beside = beside and near and elements[e].name in PARAGRAPHS
            out[i] = out[i] or beside
    for s in [i for i in range(len(kept) - 1) if kept[i] and not kept[i + 1]]:
        around = above(blocks[s][0])
        for i in range(s + 1, min(len(kept), s + 1 + NEXT_TO)):
            e, _ = blocks[i]
            if kept[i] or _container(page, e) not in around or elements[e].name not in PARAGRAPHS | HEADINGS:
                break
            if elements[e].name in PARAGRAPHS:
                out[s + 1 : i + 1] = [True] * (i - s)
    return out


def main_text(html: str | None) -> str:
    """The main text: blocks in page order, joined by an empty line."""
    if not html:
        return ""
    page = read(html)
    if not page.blocks:
        return ""
    content = content_paths(page)
    nodes = content_nodes(page, content)
    inside = [False] * len(page.elements)
    for i, e in enumerate(page.elements):
        inside[i] = i in nodes or (e.parent >= 0 and inside[e.parent])
    kept = _next_to(page, [bool(on) or inside[e] for (e, _), on in zip(page.blocks, content, strict=True)])
    return "\n\n".join(t for (_, t), on in zip(page.blocks, kept, strict=True) if on)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with ``text_col``, the main text of the whole html."""
    C.whole_batches(pages.sparkSession)

    @F.arrow_udf("string")
    def text_of(html: pa.Array) -> pa.Array:
        return pa.array([main_text(h) for h in html.to_pylist()], pa.string())

    return pages.withColumn(text_col, text_of(F.col(html_col).cast("string")))
