"""Main text of web pages by tree scoring.

A page is read once into a tree of elements and a list of text blocks; parts that never hold an article
(menus, headers and footers of the page, sidebars, notices, adverts, forms, scripts, styles, comments of
readers) are left out by element, role or class. Each block's points, one and one for each comma and each
hundred characters (three at most), less the share of its text that is link text, go to its container, half
of them to the next ancestor, and less further up. The container of the most points, discounted by the
share of links in it, is the article, or the ``article`` element around it; siblings that score nearly as
much or are long paragraphs of few links join it, and so do headings beside it.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and
joined in page order by two line feeds. No text of the chosen containers is dropped or cut.

Each page is worked on by itself, so nothing is shuffled, and reading is one pass however deep elements
are nested.

Edge cases: a null or empty page, or one without any text outside the parts left out, has the empty text;
of equal containers the first wins; repeated rows are extracted alike; an empty table gives no rows;
markup that never ends is read as far as it goes, as browsers do.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup; browsers read them up to their end tag.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
LEFT_OUT = frozenset(
    "head script style noscript template textarea title iframe object svg math canvas audio video nav footer aside form "
    "button select input dialog menu figure map noembed noframes xmp".split()
) - {"figure"}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s samp small span "
    "strike strong sub sup time tt u var wbr br img".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that hold one paragraph; their points go to the element around them.
PARAGRAPHS = frozenset("p pre li dt dd td th blockquote figcaption caption address".split()) | HEADINGS
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
#: Parts of class names and ids that tell what is not the article.
LEFT_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion sidebar widget menu nav "
    "navbar navigation breadcrumb breadcrumbs masthead header footer comment comments disqus respond cookie cookies consent "
    "gdpr notice notification alert banner popup modal overlay newsletter subscribe signup share sharing social related "
    "recommended pagination pager toolbar login copyright skip".split()
)
ARTICLE_NAMES = frozenset("article content main post entry body text story page".split())
#: What ends an open element of the same kind when it begins.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = frozenset("html body table ul ol dl div article section main aside nav footer header form td th".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
_NAMES = re.compile(r"[^a-z0-9]+")


@dataclass(slots=True)
class Element:
    tag: str
    parent: int
    bonus: float
    out: bool  # it, or one around it, is left out
    in_article: bool
    in_link: bool


@dataclass(slots=True)
class Block:
    element: int
    text: str
    linked: int  # characters of link text


def _left_out(tag: str, attributes: dict[str, str], in_article: bool) -> tuple[bool, float]:
    """Whether an element never holds an article, and the points its name is worth."""
    if tag in LEFT_OUT or (tag == "header" and not in_article):
        return True, 0
    bonus = {"article": 20.0, "main": 10.0}.get(tag, 0.0)
    if tag in ("html", "body") or not attributes:
        return False, bonus
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True, 0
    role = attributes.get("role", "").lower()
    if role in LEFT_OUT_ROLES:
        return True, 0
    if tag in ("article", "main") or role in ("main", "article"):
        return False, max(bonus, 10.0)
    for names in (attributes.get("class", ""), attributes.get("id", "")):
        for name in names.lower().split():
            parts = [p for p in _NAMES.split(name) if p]
            if parts and parts[0] not in ("no", "has", "with", "without") and LEFT_OUT_NAMES & set(parts):
                if not (in_article and set(parts) & LEFT_OUT_NAMES == {"header"}):
                    return True, 0
            if ARTICLE_NAMES & set(parts):
                bonus = max(bonus, 5.0)
    return False, bonus


def read(html: str) -> tuple[list[Element], list[Block]]:
    """The elements of a page, parents first, and its text blocks in page order."""
    elements = [Element("#page", -1, 0.0, False, False, False)]
    blocks: list[Block] = []
    stack = [0]
    parts: list[str] = []
    linked = 0
    block_of = 0

    def close_block() -> None:
        nonlocal linked
        if parts:
            if text := " ".join("".join(parts).split()):
                blocks.append(Block(block_of, text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked, block_of
        top = elements[stack[-1]]
        if top.out or not text:
            return
        if "&" in text:
            text = unescape(text)
        if not parts:
            if text.isspace():
                return
            block_of = next(s for s in reversed(stack) if elements[s].tag not in INLINE)
        parts.append(text)
        if top.in_link:
            linked += len(" ".join(text.split()))

    def pop_to(depth: int) -> None:
        if any(elements[s].tag not in INLINE for s in stack[depth:]):
            close_block()
        del stack[depth:]

    at, n = 0, len(html)
    while at < n:
        tag_at = html.find("<", at)
        if tag_at < 0:
            add(html[at:])
            break
        if tag_at > at:
            add(html[at:tag_at])
        follows = html[tag_at + 1 : tag_at + 2]
        if html.startswith("<!--", tag_at):
            end = html.find("-->", tag_at + 4)
            at = n if end < 0 else end + 3
            continue
        if follows in ("!", "?") or (follows == "/" and not html[tag_at + 2 : tag_at + 3].isalpha()):
            end = html.find(">", tag_at)
            at = n if end < 0 else end + 1
            continue
        match = _TAG.match(html, tag_at) or _LOOSE_TAG.match(html, tag_at)
        if not match:
            if follows.isalpha() or follows == "/":
                break  # a tag that never ends
            add("<")
            at = tag_at + 1
            continue
        at = match.end()
        tag = match[2].lower()
        if match[1]:
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = elements[stack[depth]].tag
                if open_tag == tag:
                    pop_to(depth)
                    break
                if tag in INLINE and open_tag not in INLINE:
                    break
            else:
                if tag == "p":
                    close_block()
            continue
        if tag == "br":
            if parts:
                parts.append(" ")
            continue
        if tag in INLINE or tag in VOID:
            if tag in VOID:
                if tag == "hr":
                    close_block()
                continue
        else:
            # A block begins: it ends an open paragraph and, for list items and cells, an open one of its kind.
            closes = ENDS.get(tag, set())
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = elements[stack[depth]].tag
                if open_tag in closes or open_tag == "p" or (open_tag in HEADINGS and tag in HEADINGS):
                    pop_to(depth)
                    if open_tag != "p":
                        break
                elif open_tag in SCOPES:
                    break
            close_block()
        parent = elements[stack[-1]]
        attributes = {}
        if match[3] and not match[3].isspace():
            for a in _ATTRIBUTE.finditer(match[3]):
                attributes.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
        out, bonus = (True, 0.0) if parent.out else _left_out(tag, attributes, parent.in_article)
        elements.append(
            Element(tag, stack[-1], bonus, out, parent.in_article or tag in ("article", "main"), parent.in_link or tag == "a")
        )
        if match[3].endswith("/") and tag not in INLINE and tag in ("svg", "math", "path", "circle"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*+>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        stack.append(len(elements) - 1)
    close_block()
    return elements, blocks


def extract(html: str) -> str:
    """The main text of one page."""
    elements, blocks = read(html)
    if not blocks:
        return ""
    n = len(elements)
    score, length, links = [e.bonus for e in elements], [0] * n, [0] * n
    touched = [False] * n
    for b in blocks:
        size = len(b.text)
        length[b.element] += size
        links[b.element] += b.linked
        tag = elements[b.element].tag
        if tag in HEADINGS:
            continue
        points = (1 + b.text.count(",") + min(size / 100, 3)) * (1 - b.linked / size)
        at = elements[b.element].parent if tag in PARAGRAPHS and b.element else b.element
        for level in range(6):
            if at < 0:
                break
            score[at] += points / (1, 2, 6, 9, 12, 15)[level]
            touched[at] = True
            at = elements[at].parent
    for k in range(n - 1, 0, -1):
        length[elements[k].parent] += length[k]
        links[elements[k].parent] += links[k]
    density = [a / b if b else 0.0 for a, b in zip(links, length)]
    final = [s * (1 - d) for s, d in zip(score, density)]
    candidates = [k for k in range(n) if touched[k]]
    if not candidates:
        return "\n\n".join(b.text for b in blocks)
    best = max(candidates, key=lambda k: (final[k], -k))
    at = best
    while at > 0:
        if elements[at].tag == "article":
            best = at
            break
        at = elements[at].parent
    kept = {best}
    if best:
        least = max(10.0, 0.2 * final[best])
        for k in range(1, n):
            e = elements[k]
            if e.parent != elements[best].parent or k == best or e.out or not length[k]:
                continue
            long_paragraph = e.tag in PARAGRAPHS and length[k] > 80 and density[k] < 0.25
            if e.tag in HEADINGS or long_paragraph or (touched[k] and final[k] >= least and density[k] < 0.25):
                kept.add(k)
    inside = [False] * n
    for k in range(n):
        inside[k] = k in kept or (k > 0 and inside[elements[k].parent])
    return "\n\n".join(b.text for b in blocks if inside[b.element])


def extract_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url`` and main ``text`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                texts = [extract(h) if h else "" for h in rows.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
                )

    needed = pages.selectExpr(f"cast(`{id_col}` as long) page_id", f"`{url_col}` url", f"`{html_col}` html")
    return needed.mapInArrow(run, "page_id long, url string, text string")
