"""Main text of a page by its line-block distribution.

Markup is stripped into lines, one per block of the page. The length of a line counts only text that can
belong to an article: text in menus, headers, footers, side bars, notices, adverts, forms and comments counts
nothing. Lengths are summed over sliding windows of `WINDOW` lines. A surge is a line whose
window rises above the limit and whose own length counts; the following dive is where windows fall to
nothing. Text between a surge and its dive is kept, without the lines that count nothing. Short headings, paragraphs
and quotations next to kept text join it, also past lines that count nothing. A page that
marks its article with `article` or `main` has its window confined to it, and the limit is then any text: there the
element decides, and the distribution serves the pages without one.

A class, id or role names its element whole: `site-footer` and `related-posts` are made of words for page parts
and layout, `side-by-side` and `legal-news` are not. Names that an article may carry as well (`social`, `legal`, `side` ...)
only lower the weight: text inside of such names counts nothing unless it is more than the text outside of them;
the same holds for names within names.

Each page is on its own: one pass, no shuffle, memory bounded by one page.

Defined cases: null or empty html, or html without article text, gives an empty text; unclosed tags end at
the end of the enclosing element; a quote opens a value only after `=` and closes it only before a blank, `/` or `>`,
otherwise the tag ends at the next `>`; unknown character references stay as written; repeated rows each give a
row. Other columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: A surge needs a window of this many characters where no element marks the article.
SURGE = 80

#: Elements without article text, elements that end a line, elements without content.
DROPPED = {"script", "style", "head", "template", "noscript", "svg", "iframe", "object", "canvas"}
BOILER = {
    "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "option",
    "textarea", "label", "input", "fieldset",
}
MAIN = {"article", "main"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "wbr", "img",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose short lines join kept text next to them.
TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption"}
#: Words of names for parts that are no article, of names that an article may have as well, of layout.
NAMED = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo(?:s|t\w*)?|banner\w*|menu\w*|nav(?:s|bar|igation)?|breadcrumbs?|sidebar\w*|footer|header|masthead"
    r"|comments?|commentlist|replies|disqus|cookies?|consent|popup|modal|newsletter|toolbar|pagination|pager|copyright"
)
WEAK = re.compile(
    r"side|reply|respond|notices?|subscribe|signup|login|share|sharing|social|related|recommended|widget\w*|legal"
)
LAYOUT = re.compile(
    r"\d*|area|bar|block|body|bottom|box|btn|buttons?|col|column|container|content|desktop|form|global|group|icons?|inner"
    r"|items?|js|l|left|links?|list|main|mobile|outer|page|panel|posts?|primary|right|row|secondary|section|site|slot|sticky"
    r"|thread|top|unit|wrap|wrapper"
)
ATTRIBUTES = r"""(?:[^<>=]|=\s*(?:"[^"]*"(?=[\s/>])|'[^']*'(?=[\s/>]))?)*+"""
RAW = re.compile(
    rf"<!--.*?(?:-->|$)|<(script|style|template|noscript|svg|iframe|object|canvas)\b{ATTRIBUTES}>"
    r".*?(?:</\1\s*>|$)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
TAG = re.compile(rf"<(/?)([A-Za-z][A-Za-z0-9:-]*)({ATTRIBUTES})>")
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}


#: Weights of elements: none, that of a name which an article may have, full.
NONE, LOW, FULL = 0, 1, 2


class Line:
    __slots__ = ("parts", "depth", "main", "block")

    def __init__(self):
        self.parts, self.depth, self.main, self.block = [], 0, False, ""

    def text(self) -> str:
        return " ".join(unescape("".join(self.parts)).split())


def name_weight(name: str) -> int:
    """Of one class, id or role: all of its words must be of the page's parts or its layout to lower it."""
    words = re.split(r"[-_]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
    rest = [w for w in words if not LAYOUT.fullmatch(w)]
    if not rest or not all(NAMED.fullmatch(w) or WEAK.fullmatch(w) for w in rest):
        return FULL
    return NONE if any(NAMED.fullmatch(w) for w in rest) else LOW


def weight(name: str, attributes: str) -> int:
    """Of the text of an element."""
    if name in BOILER:
        return NONE
    least = FULL
    for match in ATTRIBUTE.finditer(attributes):
        for value in (match[1] or match[2] or match[3] or "").split():
            if value.lower() in ROLES:
                return NONE
            if name not in ("body", "html", "article", "main"):
                least = min(least, name_weight(value))
    return least


def lines(html: str) -> list[tuple[str, int, bool, str]]:
    """(text, depth, in the marked article, element) of each line of the page, without empty ones.

    The depth counts the names of low weight around the line; it is -1 for text that counts nothing.
    """
    html = RAW.sub(" ", html)
    out, stack = [Line()], []
    boiler = low = main = head = at = 0

    def fresh() -> None:
        if out[-1].parts:
            out.append(Line())
        line = out[-1]
        line.depth, line.main = -1 if boiler or head else low, main > 0
        line.block = stack[-1][0] if stack else ""

    def leave(frame) -> None:
        nonlocal boiler, low, main, head
        boiler, low, main, head = boiler - frame[1], low - frame[2], main - frame[3], head - frame[4]

    for tag in TAG.finditer(html):
        if tag.start() > at:
            out[-1].parts.append(html[at : tag.start()])
        at = tag.end()
        name = tag[2].lower()
        if not tag[1]:
            own = weight(name, tag[3])
            if name not in INLINE or own < FULL:
                if name in VOID:
                    fresh()
                    continue
                if name in ("body", "article", "main") and head:
                    while stack and head:
                        leave(stack.pop())
                inside = (name in MAIN) and not boiler
                # a header inside of the article holds its title
                bad = own == NONE and not (name == "header" and main)
                frame = (name, int(bad), int(own == LOW), int(inside), int(name == "head"))
                stack.append(frame)
                boiler, low, main, head = boiler + frame[1], low + frame[2], main + frame[3], head + frame[4]
                fresh()
        elif any(frame[0] == name for frame in stack):
            while stack:
                frame = stack.pop()
                leave(frame)
                if frame[0] == name:
                    break
            fresh()
        elif name not in INLINE:
            fresh()
    out[-1].parts.append(html[at:])
    found = ((line.text(), line.depth, line.main, line.block) for line in out)
    return [x for x in found if x[0]]


def joined(page: list[tuple[str, int, bool, str]], sizes: list[int], stays: list[bool]) -> None:
    """Short lines of text elements next to a kept line stay, too; lines that count nothing are passed over."""
    for order in (range(len(page)), range(len(page) - 1, -1, -1)):
        near = False
        for i in order:
            if sizes[i]:
                near = stays[i] = stays[i] or near and page[i][3] in TEXT


def kept(page: list[tuple[str, int, bool, str]]) -> list[str]:
    """The lines between surge and dive points of the distribution."""
    marked = any(main and depth >= 0 for _, depth, main, _ in page)
    depths = [depth if main or not marked else -1 for _, depth, main, _ in page]
    most = 0
    while sum(len(x[0]) if d > most else -len(x[0]) if d >= 0 else 0 for x, d in zip(page, depths)) > 0:
        most += 1
    sizes = [len(line[0]) if 0 <= depth <= most else 0 for line, depth in zip(page, depths)]
    limit = 1 if marked else min(SURGE, max((sum(sizes[i : i + WINDOW]) for i in range(len(sizes))), default=0))
    stays, inside = [False] * len(page), False
    for i in range(len(page)):
        window = sum(sizes[i : i + WINDOW])
        if not inside and sizes[i] and window >= max(1, limit):
            inside = True
        elif inside and not window:
            inside = False
        stays[i] = inside and sizes[i] > 0
    joined(page, sizes, stays)
    return [line[0] for line, stay in zip(page, stays) if stay]


def main_text(html: str | None) -> str:
    return "\n".join(kept(lines(html or "")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def batches(found):
        for batch in found:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(x) for x in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return rows.mapInArrow(batches, "page_id long, url string, text string, n_chars long")
