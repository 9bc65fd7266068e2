"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block element. A line's mass is the length of
its text outside links, weighted by structure: elements that announce themselves as
something else than the article (navigation, forms, adverts, comments ...) weigh nothing,
lines inside ``article`` or ``main`` weigh LIFT characters more, and beside an article
that holds most of the page's text, lines outside it weigh a quarter. Masses are summed in
sliding windows over the lines; text is kept from where the sums first surge to where they
last dive. All pages go this way, whatever their elements.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 60
LIFT = 20
OUTSIDE = 0.25

# Element names of the HTML standard.
RAW = frozenset(["script", "style", "textarea", "title", "xmp", "noscript", "iframe", "noembed", "noframes"])
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"])
INLINE = frozenset(
    ["a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp", "small"]
    + ["span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "label", "ruby", "rt", "rp", "nobr"]
)
DROPPED = frozenset(["head", "nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "template", "svg", "math", "object", "canvas", "audio", "video", "map", "fieldset"])
MAIN = frozenset(["article", "main"])
SECTIONS = frozenset(["article", "main", "nav", "header", "footer", "aside", "section", "body"])
#: Elements that the next one of their kind ends, as a block ends a paragraph.
SERIAL = frozenset(["li", "dt", "dd", "td", "th", "tr", "option", "p"])
_NOT_ARTICLE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adverts|adbox|banners?|sponsor\w*|promo\w*|nav\w*|menus?|breadcrumbs?|side-?bar\w*|aside|footer\w*|(?:site|page|top|main)-?header|masthead|"
    r"comments?|comment-?\w*|disqus\w*|replies|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|overlay|newsletter\w*|subscri\w*|signup|login|share\w*|sharing|social\w*|"
    r"related\w*|recommend\w*|pagination|pager|toolbar|widget\w*|copyright|legal|disclaimer|skip-?\w*|search\w*)(?:$|[\s_-])",
    re.IGNORECASE,
)
_COMMENT = re.compile(r"(?:^|[\s_-])comments?(?:$|[\s_-])", re.IGNORECASE)
_ROLES = frozenset(["navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "menubar", "form", "alertdialog"])
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_SPACE = re.compile(r"\s+")


def _mark(name: str, attributes: str) -> str:
    """How an element says that it isn't part of the article: by element, word, comment; '' if it doesn't."""
    if name in DROPPED:
        return "element"
    if not attributes or name in ("html", "body"):
        return ""
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value.lower() in _ROLES:
            return "element"
        if key in ("class", "id"):
            if _COMMENT.search(value):
                return "comment"
            if name not in MAIN and _NOT_ARTICLE.search(value):
                return "word"
    return ""


def _tokens(page: str) -> list[tuple]:
    """(text before, slash, name, attributes) of each tag; the last has no name. Raw contents are skipped."""
    out, at, held, lower = [], 0, [], None
    while m := _TOKEN.search(page, at):
        held.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        out.append(("".join(held), m[1], name, m[3]))
        held = []
        if name in RAW and not m[1]:
            lower = page.lower() if lower is None else lower
            end = lower.find("</" + name, at)
            if end < 0 and name in ("script", "style", "textarea", "title"):
                end = len(page)
            if end >= 0:
                at = end
    held.append(page[at:])
    out.append(("".join(held), "", "", ""))
    return out


def _ends(tokens: list[tuple]) -> dict[int, tuple[int, bool]]:
    """For each element the token that ends it, and whether that is its own end tag.

    An end tag ends all elements in it; one of an inline element reaches no further than
    the block around. The next block ends a paragraph, the next item, cell or row its
    like. The others end with the page.
    """
    stack: list[tuple[int, str]] = []
    depths: dict[str, list[int]] = defaultdict(list)
    blocks: list[int] = []
    out: dict[int, tuple[int, bool]] = {}

    def close(depth: int, at: int, own: bool) -> None:
        while len(stack) > depth:
            k, name = stack.pop()
            depths[name].pop()
            if blocks and blocks[-1] == len(stack):
                blocks.pop()
            out[k] = (at, own and len(stack) == depth)

    for i, (_, slash, name, attributes) in enumerate(tokens):
        if slash:
            if depths[name] and (name not in INLINE or not blocks or depths[name][-1] > blocks[-1]):
                close(depths[name][-1], i, True)
        elif name and name not in VOID and not attributes.endswith("/"):
            if name not in INLINE:
                inner = stack[blocks[-1]][1] if blocks else ""
                if inner == "p" or inner == name and name in SERIAL:
                    close(blocks[-1], i, False)
                blocks.append(len(stack))
            depths[name].append(len(stack))
            stack.append((i, name))
    close(0, len(tokens) - 1, False)
    return out


def lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, length outside links, within article or main) of every block that weighs anything, in page order.

    A marked element without an end tag goes on to the next section or article, an
    article without one to the end of what it stands in. Words in class or id don't
    mark an element that holds an article.
    """
    tokens, out, parts = _tokens(page), [], []
    ends = _ends(tokens)
    marks = {i: m for i, (_, slash, name, attributes) in enumerate(tokens) if name and not slash and (m := _mark(name, attributes))}
    articles = [i for i, (_, slash, name, _) in enumerate(tokens) if name in MAIN and not slash and marks.get(i) != "comment"]
    sections = [i for i, (_, slash, name, _) in enumerate(tokens) if name in SECTIONS and not slash]
    closing: dict[int, list[str]] = defaultdict(list)
    count = {"apart": 0, "main": 0, "link": 0}
    plain = 0

    def holds_article(i: int, end: int) -> bool:
        k = bisect_right(articles, i)
        return k < len(articles) and articles[k] < end

    def close() -> None:
        nonlocal plain
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            out.append((text, min(plain, len(text)), count["main"] > 0))
        parts.clear()
        plain = 0

    for i, (text, slash, name, attributes) in enumerate(tokens):
        if text and not count["apart"]:
            text = entities.unescape(text)
            parts.append(text)
            if not count["link"]:
                plain += len(_SPACE.sub("", text))
        if name and name not in INLINE:
            close()
        elif name == "br" and not count["apart"]:
            parts.append(" ")
        for kind in closing.pop(i, ()):
            count[kind] -= 1
            if kind == "apart" and name in INLINE:
                parts.append(" ")
        if slash or i not in ends:
            continue
        end, own = ends[i]
        mark = marks.get(i)
        if mark == "word" and holds_article(i, end) or name == "header" and mark == "element" and count["main"]:
            mark = None
        if mark:
            if not own and (k := bisect_right(sections, i)) < len(sections):
                end = min(end, sections[k])
            count["apart"] += 1
            closing[end].append("apart")
        elif name in MAIN:
            count["main"] += 1
            closing[end].append("main")
        elif name == "a":
            count["link"] += 1
            closing[end].append("link")
    close()
    return out


def masses(rows: list[tuple[str, int, bool]]) -> list[float]:
    """Weighted length of each line."""
    inside = sum(x[1] for x in rows if x[2])
    outer = OUTSIDE if inside and 2 * inside >= sum(x[1] for x in rows) else 1.0
    return [plain + LIFT if main else plain * outer for _, plain, main in rows]


def block_sums(rows: list[tuple[str, int, bool]], mass: list[float]) -> list[float]:
    """Sum over the window of lines around each.

    Windows stop at the edge of an article; one that is cut short there on the inner
    side counts as a whole one, so that short articles and their ends aren't lost.
    """
    half, out = WINDOW // 2, []
    for i, row in enumerate(rows):
        near = [mass[j] for j in range(max(0, i - half), min(len(rows), i + half + 1)) if rows[j][2] == row[2]]
        out.append(sum(near) * (WINDOW / len(near) if row[2] else 1))
    return out


def main_text(page: str) -> str:
    """The article of a page, one line a block; empty if there is none.

    It goes from where the block sums first surge to SURGE, or to half of the page's
    largest sum if that is less, to where they last dive below half of that. What lies
    between goes too if it has mass and isn't outside an article that holds most of the
    page. Up to WINDOW lines with mass right above the first surge (title, byline) belong
    to it. A page with no article element and under SURGE characters outside links has
    no main text.
    """
    rows = lines(page)
    mass = masses(rows)
    if sum(mass) < SURGE and not any(x[2] for x in rows) or not any(mass):
        return ""
    sums = block_sums(rows, mass)
    surge = min(SURGE, max(sums) / 2)
    inside = [False] * len(rows)
    i = 0
    while i < len(rows):
        if sums[i] >= surge and mass[i]:
            while i < len(rows) and sums[i] >= surge / 2 and any(mass[i : i + 2]):
                inside[i] = True
                i += 1
        else:
            i += 1
    first, last = inside.index(True), len(rows) - 1 - inside[::-1].index(True)
    most = any(x[2] for x in rows) and not all(m == x[1] for m, x in zip(mass, rows, strict=True) if not x[2])
    between = [i for i in range(first, last + 1) if inside[i] or mass[i] and (rows[i][2] or not most)]
    above = first
    while above and first - above < WINDOW and mass[above - 1] and rows[above - 1][2] == rows[first][2]:
        above -= 1
    return "\n".join(rows[i][0] for i in [*range(above, first), *between])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row; a null html is an empty page.

    Pages without an article have an empty text. Ids and urls pass unchanged, nulls and
    repeated rows included. No other column is read. No rows: no rows.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x or "") for x in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(task, "page_id long, url string, text string, n_chars long")
