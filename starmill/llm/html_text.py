"""Main text of web pages by tag-path ratios.

Text blocks are grouped by their path of tags from the root. Long texts with much punctuation are typical
of article paths, short ones and links of all others: text length and punctuation per block of a path are
smoothed over neighbouring blocks, multiplied, and compared with a threshold. The article is the smallest
element around the selected blocks. Elements that name themselves menus, notices, adverts, comments and so
on have no part in it.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from starmill.llm.tables import slices
from starmill.sources.tables import read_table

# --- Fixed values: the HTML elements by kind, and names that pages give to what is not the article. ---
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr picture q rp "
    "rt ruby s samp small source span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
NEVER_ARTICLE = frozenset("aside audio button canvas datalist dialog footer head map math menu nav object select "
                          "svg video".split())
SELDOM_ARTICLE = frozenset("fieldset form header".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that a new element of the same group ends, and the elements that keep outer ones from it.
ENDED_BY_NEXT = {**{t: ({"li"}, {"ul", "ol", "menu"}) for t in ("li",)},
                 **{t: ({"dt", "dd"}, {"dl"}) for t in ("dt", "dd")},
                 **{t: ({"td", "th"}, {"tr", "table"}) for t in ("td", "th")},
                 "tr": ({"tr", "td", "th"}, {"table"}),
                 **{t: ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}) for t in ("thead", "tbody", "tfoot")}}
OTHER_NAMES = frozenset(
    "ad ads adsense adv advert advertisement advertising adverts alert alerts aside banner breadcrumb breadcrumbs "
    "comment commentlist comments consent cookie cookies copyright disqus footer gdpr header login masthead menu "
    "menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription toolbar topbar trending widget widgets".split())
# With one of these, a "header" is the article's own.
OWN_NAMES = frozenset("article content entry page post story".split())
COMMENT_NAMES = frozenset("comment comments disqus replies reply respond".split())
OTHER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                        "search toolbar".split())
PUNCTUATION = re.compile("[.,;:!?¿¡…、。，！？؟،।]")
# --- End of fixed values. ---

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)

# Neighbouring blocks on each side that smoothing looks at, with these weights by distance.
SMOOTHING = (0.5, 0.2, 0.05)
# A path belongs to the article from this share of the best path's score on.
THRESHOLD = 0.2
# The article is the smallest element with this share of the selected text.
COVER = 0.9


class Element:
    """An open or closed element; ``aside`` tells that it is no article unless it holds one."""

    __slots__ = ("tag", "parent", "path", "depth", "never", "aside", "holds_article")

    def __init__(self, tag: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        self.path = f"{parent.path}/{tag}" if parent else tag
        self.depth = parent.depth + 1 if parent else 0
        self.never = self.aside = self.holds_article = False


class Block:
    """Text between two block boundaries."""

    __slots__ = ("element", "text", "linked")

    def __init__(self, element: Element, text: str, linked: int):
        self.element, self.text, self.linked = element, text, linked

    @property
    def is_heading(self) -> bool:
        return self.element.tag in HEADINGS


def _names_itself_other(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether attributes say that an element is hidden, and that it is something beside the article."""
    hidden, names = False, []
    for name, value in NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            names += re.split(r"[\s_\-:]+", value)
        elif name == "role":
            names += ["nav"] if value in OTHER_ROLES else []
        elif name == "hidden" or name == "aria-hidden" and value == "true" \
                or name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    if tag in ("html", "body", "main"):
        return False, False
    if tag == "article":
        return hidden, not COMMENT_NAMES.isdisjoint(names)
    told = OTHER_NAMES - {"header"} if not OWN_NAMES.isdisjoint(names) else OTHER_NAMES
    return hidden, not told.isdisjoint(names)


def parse_blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, without those inside elements that never hold an article."""
    root = Element("html", None)
    current, blocks, parts = root, [], []
    linked = in_link = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not current.never:
                blocks.append(Block(current, text, min(linked, len(text))))
            parts.clear()
            linked = 0

    def is_open(tag: str) -> bool:
        element = current
        while element.parent:
            if element.tag == tag:
                return True
            element = element.parent
        return False

    def close(tag: str):
        nonlocal current
        while current.tag != tag:
            current = current.parent
        current = current.parent

    at, end = 0, len(page)
    while at < end:
        found = TAG.search(page, at)
        text = page[at:found.start() if found else end]
        if text:
            parts.append(text)
            if in_link:
                linked += len(text.strip())
        if not found:
            break
        at = found.end()
        closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in UNREAD and not closing:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
            flush()
            continue
        if tag == "a":
            in_link = 0 if closing else 1
        if tag == "br":
            parts.append(" ")
        if closing:
            if tag in ("html", "body"):
                continue
            if is_open(tag):
                flush()
                close(tag)
            continue
        hidden, other = _names_itself_other(tag, attributes) if attributes else (False, False)
        if tag in INLINE and (tag in VOID or not (hidden or other)):
            continue
        flush()
        if tag in VOID or tag == "html":
            continue
        if current.tag == "p" or tag in HEADINGS and current.tag in HEADINGS:
            current = current.parent
        ends, kept_by = ENDED_BY_NEXT.get(tag, ((), ()))
        element, last = current, None
        while ends and element.parent and element.tag not in kept_by:
            if element.tag in ends:
                last = element
            element = element.parent
        if last:
            current = last.parent
        opened = Element(tag, current)
        opened.never = current.never or hidden or tag in NEVER_ARTICLE
        opened.aside = other or tag in SELDOM_ARTICLE
        if not opened.aside and tag in ("article", "main"):
            element = current
            while element and not element.holds_article:
                element.holds_article = True
                element = element.parent
        current = opened
    flush()
    _admit_forms(blocks)
    return [b for b in blocks if not _beside_article(b)]


def _admit_forms(blocks: list[Block]) -> None:
    """A form around most of the page's text is a wrapper and no form to fill in."""
    held, total = defaultdict(int), sum(len(b.text) for b in blocks)
    for block in blocks:
        element = block.element
        while element:
            if element.tag in ("form", "fieldset"):
                held[element] += len(block.text)
            element = element.parent
    for element, chars in held.items():
        element.holds_article |= 2 * chars > total


def _beside_article(block: Block) -> bool:
    """Whether the block is in an element that is no article and holds none; an article's title stays."""
    element, aside = block.element, None
    while element:
        if element.tag in ("article", "main") and aside is not None:
            if aside.tag == "header" and block.is_heading:
                aside = None
        if element.aside and not element.holds_article:
            aside = element
        element = element.parent
    return aside is not None


def _smooth(values: list[float]) -> list[float]:
    found = []
    for i in range(len(values)):
        total = weight = 0.0
        for j in range(max(0, i - 2), min(len(values), i + 3)):
            share = SMOOTHING[abs(i - j)]
            total += share * values[j]
            weight += share
        found.append(total / weight)
    return found


def selected_paths(blocks: list[Block]) -> set[str]:
    """Paths whose fused ratio of text and punctuation reaches the threshold."""
    chars, signs, number = defaultdict(float), defaultdict(float), defaultdict(int)
    for block in blocks:
        path = block.element.path
        chars[path] += len(block.text) - block.linked
        signs[path] += len(PUNCTUATION.findall(block.text)) if block.linked < len(block.text) else 0
        number[path] += 1
    by_text = _smooth([chars[b.element.path] / number[b.element.path] for b in blocks])
    by_sign = _smooth([signs[b.element.path] / number[b.element.path] for b in blocks])
    score = defaultdict(float)
    for block, text, sign in zip(blocks, by_text, by_sign):
        path = block.element.path
        own = chars[path] / number[path]
        score[path] += min(text, own) * (1 + sign) / number[path]
    best = max(score.values(), default=0.0)
    return {path for path, value in score.items() if value >= THRESHOLD * best and value > 0}


def article_of(blocks: list[Block], paths: set[str]) -> Element | None:
    """The smallest element that holds ``COVER`` of the text on selected paths."""
    held, total = defaultdict(int), 0
    for block in blocks:
        if block.element.path in paths:
            total += len(block.text)
            element = block.element
            while element:
                held[element] += len(block.text)
                element = element.parent
    around = [e for e, n in held.items() if n >= COVER * total]
    return max(around, key=lambda e: e.depth, default=None)


def main_text(page: str) -> str:
    """Blocks of the article in page order, joined by an empty line."""
    blocks = parse_blocks(page)
    paths = selected_paths(blocks)
    article = article_of(blocks, paths)
    if article is None:
        return "\n\n".join(b.text for b in blocks if not b.linked)
    # A single paragraph is part of a larger article; so are a list's entries and a table's cells.
    while article.parent and article.tag not in ("article", "main", "body", "section", "div", "html"):
        article = article.parent
    loose = article.tag in ("html", "body")

    def inside(block: Block) -> bool:
        element = block.element
        while element and element is not article:
            element = element.parent
        return element is article

    kept = []
    for n, block in enumerate(blocks):
        chosen = block.element.path in paths
        if chosen and inside(block):
            kept.append(block.text)
        elif inside(block):
            leads = block.is_heading and (not loose or any(
                b.element.path in paths for b in blocks[n + 1:n + 3]))
            if leads or not loose and block.linked * 2 <= len(block.text):
                kept.append(block.text)
        elif chosen and block.linked * 2 <= len(block.text) and article.tag not in ("article", "main"):
            kept.append(block.text)
    return "\n\n".join(kept)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "html"):
            texts = [main_text(page) if page else "" for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"),
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def extract_text(pages: DataFrame) -> DataFrame:
    """The main text of each page: ``page_id``, ``url``, ``text``, ``n_chars`` (code points).

    Character references are decoded, white space within a block becomes one space, blocks are joined by
    an empty line. NULL and empty pages and pages without an article have the empty text. Every row has
    one result row, also rows that share an id or have none; other columns are not looked at. An empty
    table gives an empty result. A page is the unit of work and is held whole by one task.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        _extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op3_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))


QUERIES = {"op3_tag_path_text": op3_tag_path_text}
ORACLE: dict[str, str] = {}
