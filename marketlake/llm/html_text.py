"""Main text of web pages by two passes over their blocks.

First pass: each block of text is decided where it can be. Blocks in page furniture (navigation, headers,
footers, asides, forms, or a class or id that names adverts, notices, menus, comments and the like) and blocks
that are mostly links are bad. Elsewhere a long block is good if its density of stop words is high or if it
stands in the page's article; a long block without stop words outside it is bad. Short blocks stay open.
Second pass: an open block inherits the label of the nearest decided neighbours (of the same article, if it is
in one): the one both sides agree on, else the nearer side's; with none to ask it is good in an article only.

Character references are decoded, white space in a block becomes one space, blocks are joined by an empty line.
A main element lifts what class names of the elements around it say; an article does so too, but in comments,
related items and the like, and where the whole name says it ("sidebar"), only if the page has no other article.
Names of layouts ("has-sidebar", "content-sidebar-wrap", "elementor-widget") say nothing. An open head ends at the
body, or at the first element that cannot stand in a head.

Nothing is capped. A null or empty page, or one without text, gives an empty text. Broken markup is read as far
as it goes: an unclosed comment, script or tag at the end hides the rest. Repeated pages give repeated rows.
Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import small_batches

#: Frequent words of the languages covered.
STOP = frozenset(
    """
    a an and are as at be by for from had has have he her his in is it its not of on or she that the their they this
    to was were which with you der die das den dem des ein eine einen und ist im in von zu mit auf für nicht sich auch
    als an es er sie le la les un une des du de et est en que qui dans pour pas sur par au il elle ce el los las una y
    por con para no se del lo su al
    """.split()
)
FURNITURE = frozenset("nav header footer aside form menu dialog noscript button select textarea template iframe svg canvas object audio video".split())
HIDDEN = frozenset("script style head title".split())
ARTICLE = frozenset("article main".split())
BLOCK = frozenset(
    """
    address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead
    tr ul caption
    """.split()
)
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|alert|sidebar|side|menu|nav\w*|"
    r"breadcrumbs?|comments?|disqus|reply|replies|footer|header|masthead|share|sharing|social|related|recommended|"
    r"newsletter|subscribe|signup|login|popup|modal|pagination|pager|tags|toolbar|widget)(?:$|[\s_-])",
    re.I,
)
#: Class names of wrappers of whole pages: a part of them names what stands beside the text.
LAYOUT = re.compile(
    r"(?:has|with|without|no)[_-].*|(?:content|main|page)[_-].*[_-](?:wrap|wrapper|container|inner)|"
    r"elementor[_-]widget(?:[_-](?:wrap|container|text-editor|theme-post-content|heading|image))?",
    re.I,
)
#: Class names of elements that hold articles other than the page's own.
OTHERS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|reply|replies|related|recommended|ads?|advert\w*|sponsor\w*|promo\w*)(?:$|[\s_-])", re.I)
#: What makes an element furniture: part of a class name, a whole one, its tag.
PART, WHOLE, TAG = 1, 2, 3
#: Elements that may stand in a head.
IN_HEAD = frozenset("html head title script style base link meta noscript template".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
CLASS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
WORD = re.compile(r"\w+")
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())

LONG = 70
DENSE = 0.2
LINKS = 0.5
GOOD, BAD, OPEN = 1, 0, None


def named(names: list[str]) -> int:
    """What class names say of an element: nothing, PART or WHOLE."""
    kinds = [WHOLE if m[0] == name or OTHERS.search(name) else PART for name in names if not LAYOUT.fullmatch(name) and (m := NAMES.search(name))]
    return max(kinds, default=0)


def furniture(stack: list[tuple[str, int, int]]) -> int:
    """2: in furniture; 1: in an article that counts only if the page has no other; 0: neither."""
    kind = doubt = 0
    for name, own, article in stack:
        kind = max(kind, own)
        if article and kind < TAG:
            doubt = max(doubt, kind == WHOLE and name != "main")
            kind = 0
    return 2 if kind else int(doubt)


def blocks(page: str) -> Iterator[tuple[str, float, int, int]]:
    """Text, share of it in links, `furniture`, and its article's number (0: none)."""
    stack: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked = links = articles = 0
    at, end = 0, len(page)

    def flush() -> Iterator[tuple[str, float, int, int]]:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            yield text, min(1.0, linked / len(text)), furniture(stack), next((s[2] for s in reversed(stack) if s[2]), 0)
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            linked += len(text.strip())

    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        opened = next((k for k, s in enumerate(stack) if s[0] == "head"), None) if not m[1] else None
        if opened is not None and (name == "body" or opened == len(stack) - 1 and name not in IN_HEAD):
            yield from flush()
            del stack[opened:]
        if name in HIDDEN and not m[1]:
            yield from flush()
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if name in ("script", "style", "title"):
                at = close.end() if close else end
                continue
        if name in BLOCK or name in FURNITURE or name in HIDDEN:
            yield from flush()
        elif name == "br" or name == "img":
            parts.append(" ")
        if name == "a":
            links = max(0, links - 1) if m[1] else 1
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        elif name not in VOID and name != "p" and (name in BLOCK or name in FURNITURE or name in HIDDEN) and not m[3].endswith("/"):
            names = " ".join(a or b or c for a, b, c in CLASS.findall(m[3])).split()
            article = 0
            if name in ARTICLE:
                articles += 1
                article = articles
            bad = TAG if name in FURNITURE or name in HIDDEN else 0 if name in ("body", "html", "article", "main") else named(names)
            stack.append((name, bad, article))
            links = 0
    yield from flush()


def main_text(page: str | None) -> str:
    found = list(blocks(page or ""))
    most = 0 if any(f[3] and not f[2] for f in found) else 1
    found = [(text, linked, kind > most, article) for text, linked, kind, article in found]
    labels: list[int | None] = []
    for text, linked, bad, article in found:
        if bad or linked > LINKS:
            labels.append(BAD)
        elif len(text) < LONG:
            labels.append(OPEN)
        elif article:
            labels.append(GOOD)
        else:
            words = WORD.findall(text.lower())
            labels.append(GOOD if sum(w in STOP for w in words) >= DENSE * len(words) else BAD)
    # nearest decided blocks on both sides; in an article only those of the article that are not furniture
    n = len(found)
    decided = list(labels)
    sides: list[list[tuple[int, int] | None]] = []
    for order in (range(n), range(n - 1, -1, -1)):
        last: dict[int, tuple[int, int]] = {}
        near: list[tuple[int, int] | None] = [None] * n
        for i in order:
            article = found[i][3]
            near[i] = last.get(article) if article else last.get(-1)
            if labels[i] is not OPEN:
                last[-1] = (i, labels[i])
                if article and not found[i][2]:
                    last[article] = (i, labels[i])
        sides.append(near)
    for i in range(n):
        if labels[i] is not OPEN:
            continue
        a, b = sides[0][i], sides[1][i]
        if a is None or b is None:
            decided[i] = (a or b or (0, GOOD if found[i][3] else BAD))[1]
        elif a[1] == b[1] or i - a[0] < b[0] - i:
            decided[i] = a[1]
        elif b[0] - i < i - a[0]:
            decided[i] = b[1]
        else:
            decided[i] = GOOD if found[i][3] else BAD
    return "\n\n".join(f[0] for f, label in zip(found, decided, strict=True) if label == GOOD)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(page) for page in batch["html"].to_pylist()]
            columns = [batch["page_id"], batch["url"], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())]
            yield pa.record_batch(columns, ["page_id", "url", "text", "n_chars"])

    small_batches(pages.sparkSession)
    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
