"""Main text of web pages by line-block distribution.

Markup is stripped: scripts, styles, comments, forms and elements that by their tag, role, class or id are
menus, headers, footers, sidebars, notices, adverts or reader comments leave a gap; block elements end a
line; character references are decoded. Words that also name parts of an article (header, discussion, related,
...) mark nothing inside <article> and <main>.
What remains is a list of lines, one per paragraph, heading, list item or cell, and an empty line for each gap:
where a box (div, section, article, table, ...) begins or ends or markup was removed. A line's length is its text
length; lines made of links have none.

The lengths of WINDOW neighbouring lines are summed. A surge is a place where lines that stand together, without
a gap, sum to SURGE characters, which short adverts, notices and menus do not reach; on a page without such a place
it is the largest sum of the page, so that short pages keep their text. The block begins behind the gap before the
surge. It dives at a gap behind which the next WINDOW lines sum to less than a surge. All lines between are
kept, however short; lines of links only where a line of the block follows. A surge inside an <article>, or a <main>
without one, takes in that element from end to end, so a short title or ending in a box of its own stays there. What
the method cannot tell apart: such a title or ending on a page without these elements is lost, and a notice without a
gap to the text, or without a mark inside the article, is kept.

Null html counts as empty. Broken markup (tags that are never closed, a page cut in the middle of a tag or a
character reference) is read as browsers read it: what is open ends with its parent or with the page. No text
is capped for being long.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80

# Element names, and words in class, id and role that mark what isn't main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
#: Blocks in the flow of a text: they end a line and leave no gap.
FLOW = frozenset("blockquote br center dd dl dt figcaption h1 h2 h3 h4 h5 h6 hgroup li ol p pre tbody td th thead tr ul".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas audio video select button".split())
SKIPPED = RAW | frozenset("head nav header footer aside form dialog menu".split())
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs header masthead footer sidebar side aside widget related recommended share sharing "
    "social cookie cookies consent notice notices newsletter subscribe subscription popup modal overlay comment "
    "comments reply replies discussion disqus form search login signup copyright pager pagination toolbar tags "
    "complementary contentinfo alert dialog rail".split()
)
#: Words that name parts of an article, too.
LOOSE_WORDS = frozenset("header discussion related tags side share sharing alert dialog reply".split())
HOMES = ("article", "main")
#: What may stand in <head>; the first other start tag, or text, ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
_CLOSES_P = BLOCK - {"br", "body", "html", "title", "option", "optgroup"}
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[^a-z0-9]+")


def _unwanted(tag: str, attributes: str, at_home: bool) -> bool:
    """Whether an element is no main text; `at_home` says that it lies inside an article or main element."""
    if tag in SKIPPED:
        return True
    if not attributes or tag in ("html", "body", *HOMES):
        return False
    bad = BAD_WORDS - LOOSE_WORDS if at_home else BAD_WORDS
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role") and not bad.isdisjoint(_PARTS.split(value)):
            return True
        if name == "hidden" and value != "until-found" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def strip_markup(page: str) -> list[tuple[str, bool, int]]:
    """Lines of a page, (text, whether it is mostly links, its article or main element or 0); an empty line for a gap."""
    lines: list[tuple[str, bool, int]] = []
    homes: list[tuple[str, int]] = []  # open article and main elements, each with a number
    n_homes = 0
    text: list[str] = []
    linked = total = 0
    open_: list[str] = []
    skip_at = -1  # depth of the element whose content is dropped
    links = 0

    def end(gap: bool = False) -> None:
        nonlocal linked, total
        joined = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
        if joined:
            articles = [number for tag, number in homes if tag == "article"] or [number for _, number in homes]
            lines.append((joined, bool(total) and linked > 0.8 * total, articles[-1] if articles else 0))
        if gap and lines and lines[-1][0]:
            lines.append(("", False, 0))
        text.clear()
        linked = total = 0

    def close(depth: int) -> None:
        nonlocal skip_at, links
        while len(open_) > depth:
            tag = open_.pop()
            if len(open_) == skip_at:
                skip_at = -1
            if (tag in BLOCK or tag in HOMES) and skip_at < 0:
                end(tag not in FLOW)
            if tag in HOMES:
                homes.pop()
            links -= tag == "a"

    at, size = 0, len(page)
    while at < size:
        if open_ and open_[-1] in RAW:
            raw = re.compile(rf"</{re.escape(open_[-1])}(?=[\s/>]|$)", re.I).search(page, at)
            at = raw.start() if raw else size
            if at == size:
                break
        found = _TAG.search(page, at)
        piece = page[at : found.start() if found else size]
        start = (found[2] or "").lower() if found and not found[1] else ""
        if open_ and open_[-1] == "head" and (piece.strip() or start and start not in IN_HEAD):
            close(len(open_) - 1)
        if piece and skip_at < 0:
            text.append(piece)
            n = len(piece.strip())
            total += n
            linked += n if links > 0 else 0
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag in open_:
                depth = len(open_) - 1 - open_[::-1].index(tag)
                close(depth)
            elif tag in ("p", "br") and skip_at < 0:
                end()
            continue
        if tag in BLOCK:
            ending = _SAME.get(tag, {"p"} if tag in _CLOSES_P else set())
            if tag in _CLOSES_P:
                ending = ending | {"p"}
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth] in ending:
                    close(depth)
                    break
                if open_[depth] in BLOCK and open_[depth] != "p":
                    break
            if skip_at < 0:
                end(tag not in FLOW)
        if tag in VOID or found[3].rstrip().endswith("/") and tag in ("svg", "math"):
            continue
        if skip_at < 0 and _unwanted(tag, found[3], bool(homes)):
            skip_at = len(open_)
            if tag in BLOCK:
                end(True)
        open_.append(tag)
        if tag in HOMES:
            n_homes += 1
            homes.append((tag, n_homes))
        links += tag == "a"
    if skip_at < 0:
        end()
    return lines


def main_text(page: str | None) -> str:
    """The lines between surge and dive, joined by line feeds."""
    lines = strip_markup(page or "")
    boxes: list[list[tuple[str, int]]] = [[]]
    homes = [0]
    for text, links, home in lines:
        if text:
            boxes[-1].append((text, 0 if links else len(text)))
            homes[-1] = home
        else:
            boxes.append([])
            homes.append(0)
    together = [max(_sums([n for _, n in box]), default=0) for box in boxes]
    surge = min(SURGE, max(together))
    if not surge:
        return ""
    whole = {home for home, most in zip(homes, together, strict=True) if most >= surge and home}
    lengths = [n for box in boxes for _, n in box]
    ahead = [*_sums(lengths), 0]
    kept: list[str] = []
    waiting: list[str] = []
    at, inside = 0, False
    for box, most, home in zip(boxes, together, homes, strict=True):
        inside = most >= surge or home in whole or inside and ahead[at] >= surge
        at += len(box)
        if not inside:
            waiting.clear()
            continue
        for text, n in box:
            if n:
                kept += waiting
                kept.append(text)
                waiting.clear()
            elif kept:
                waiting.append(text)
    return "\n".join(kept)


def _sums(lengths: list[int]) -> list[int]:
    """The sums of WINDOW neighbours, from each place on."""
    return [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]


def text_of(page: Column) -> Column:
    """The main text of a column of pages."""

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(x) for x in batch.to_pylist()], pa.string())

    return extract(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    out = pages.select("page_id", "url", text_of(F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
