"""Main text of web pages by the distribution of line blocks.

Markup is stripped and each block element becomes a line. A line has the length of its text, or 0 if
it stands in a part that is no article text (menus, forms, adverts and the like, known by element or
by class, id and role). Lengths are summed over a sliding window of lines. Where the sum rises over
the threshold the main text surges, where it falls back to zero the text dives; lines between a
surge and a dive are kept, but for the zero ones.

A page that marks its article (``article``, ``main`` or role main) says itself where the text is:
lines outside have length 0, and the threshold is one character, so that a short paragraph at either
end of the article is kept. An element round ``main`` switches off nothing in it by its class or id words, nor as a form;
one round an ``article`` doesn't either if no marked text is left otherwise (a layout may be named after its sidebar, but
teasers in a sidebar can be articles too). Inside, headings are never off by such words, sections only by class words for
comments and adverts, since their ids and names come from what they are about.

Elsewhere the threshold is ``SURGE``, and link text does not count; a line that is wholly links stays if it stands between
a surge and the dive, and unlinked lines right before a surge, such as a title and a short opening paragraph, belong to it
if they stand in the same container. An element that is off by a word only and holds more than half of the page's text is
not off.

Only block elements begin and end lines; raw, unknown and inline elements inside a paragraph leave it whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import stage

#: Lines in a window, and the characters in it with which the main text begins.
WINDOW, SURGE = 3, 80

# Element names of HTML, and words that name parts of a page.
RAW = frozenset("script style noscript template textarea title svg iframe object canvas select option button datalist".split())
OFF = frozenset("nav footer aside form dialog menu fieldset label head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset(("h1", "h2", "h3"))
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Blocks of text; the container of a line is the innermost other block round it.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote hgroup".split())
OFF_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget notice cookie cookies consent "
    "banner gdpr ad ads advert adverts advertisement promo promotion sponsor sponsored newsletter subscribe signup login form search share "
    "sharing social comment comments reply replies disqus respond related recommended popup modal overlay toolbar pagination pager".split()
)
#: The words that switch off an ``article`` element too, and those that switch off nothing inside an article.
ARTICLE_OFF = frozenset("comment comments reply replies related promo sponsored ad advert advertisement".split())
OUTSIDE_ONLY = frozenset("header masthead banner".split())
ALL_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Raw elements that a slash in the start tag ends.
FOREIGN = frozenset(("svg",))
OFF_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PART = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")


#: How an element is off: in any case, or unless it holds the marked article.
NOT_OFF, OFF_ROUND, OFF_ALWAYS = 0, 1, 2


def _off(name: str, attributes: str, inside: bool, is_main: bool) -> int:
    """Whether an element holds no article text; a header inside the article may hold its title."""
    if name == "form":
        return OFF_ROUND
    if name in OFF or (name == "header" and not inside):
        return OFF_ALWAYS
    if re.search(r"(?:^|\s)hidden(?:\s|$)", attributes):
        return OFF_ALWAYS
    if name in ("html", "body", "main") or "=" not in attributes:
        return NOT_OFF
    words = OFF_WORDS - OUTSIDE_ONLY if inside else OFF_WORDS
    if name == "article" or inside and name == "section":
        words = ARTICLE_OFF
    if is_main or inside and name in ALL_HEADINGS:
        words = frozenset()
    keys = ("class",) if inside and name == "section" else ("class", "id")
    off = NOT_OFF
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        key = key.lower()
        if key == "role" and value in OFF_ROLES:
            return OFF_ALWAYS
        if key in keys:
            for label in value.split():
                parts = _PART.split(label)
                if parts[0] not in ("with", "has", "no", "without") and words.intersection(parts):
                    off = OFF_ROUND
        if key == "style" and "display:none" in value.replace(" ", ""):
            return OFF_ALWAYS
        if key == "aria-hidden" and value == "true":
            return OFF_ALWAYS
    return off


@dataclass
class Line:
    text: str
    #: Characters that count: none if the line is off, and none in links outside a marked article.
    length: int
    inside: bool
    title: bool
    off: bool
    #: Number of the container, and whether no part of the line is a link.
    box: int
    plain: bool


@dataclass
class _Open:
    """An open element, and what held before it."""

    name: str
    how: int
    marks: bool
    spared: int
    spared_main: int
    box: int
    block: int


def lines_of(page: str) -> list[Line]:
    """Lines of a page; time is linear in its length, however deep elements are nested."""
    lines: list[Line] = []
    strict: list[bool] = []  # off with the elements round the article
    lenient: list[bool] = []  # off without them
    always: list[bool] = []  # off other than by words
    sizes: list[int] = []  # characters of all lines, counted or not
    held: list[str] = []
    links = 0  # characters of link text in the held line
    open_: list[_Open] = []
    places: dict[str, list[int]] = {}  # where in ``open_`` the elements of a name are
    off = off_round = marked = in_link = titles = 0
    spared = spared_main = 0  # of ``off_round``, those that stand round the article; those round a main element
    box, block = 0, -1  # the container; the place of the innermost block
    boxes = 0
    words_off: list[tuple[int, int]] = []  # first line and the one after the last of elements that are off by a word
    begun: list[int] = []

    def end_line() -> None:
        nonlocal links
        text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
        if text:
            length = max(0, len(text) if marked else len(text) - links)
            lines.append(Line(text, length, bool(marked), titles > 0, False, box, not links))
            strict.append(off + off_round > spared_main)
            lenient.append(off + off_round > spared)
            always.append(off > 0)
            sizes.append(len(text))
        held.clear()
        links = 0

    def close(k: int) -> None:
        nonlocal off, off_round, marked, in_link, spared, spared_main, box, block, titles
        while len(open_) > k:
            e = open_.pop()
            places[e.name].pop()
            off -= e.how == OFF_ALWAYS
            if e.how == OFF_ROUND:
                off_round -= 1
                words_off.append((begun.pop(), len(lines)))
            marked -= e.marks
            in_link -= e.name == "a"
            titles -= e.name in HEADINGS
            spared, spared_main, box, block = e.spared, e.spared_main, e.box, e.block

    at, size = 0, len(page)
    raw_ends: dict[str, re.Pattern] = {}
    while at < size:
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else size]
        if text:
            held.append(text)
            links += len(text) if in_link else 0
        if not token:
            break
        at = max(token.end(), token.start() + 1)
        name = (token.group(2) or "").lower()
        if not name:
            continue
        if name in BLOCK:
            end_line()
        elif name == "br":
            held.append(" ")
        if token.group(1):
            if places.get(name):
                close(places[name][-1])
            continue
        ended = token.group(3).endswith("/")
        if name in RAW and not (name in FOREIGN and ended):
            ends = raw_ends.setdefault(name, re.compile(rf"</{re.escape(name)}[^>]*(?:>|\Z)", re.IGNORECASE)).search(page, at)
            at = ends.end() if ends else size
            continue
        if name in VOID or ended and name not in ("p", "div", "a"):
            continue
        if name in ("p", "li", "tr", "td", "th", "dt", "dd") and block >= 0 and open_[block].name == name:
            close(block)  # ended by the next of its kind
        marks = name in ("article", "main") or "main" in re.findall(r"""role\s*=\s*["']?(\w+)""", token.group(3))
        is_main = marks and name != "article"
        how = _off(name, token.group(3), bool(marked), is_main)
        places.setdefault(name, []).append(len(open_))
        open_.append(_Open(name, how, marks, spared, spared_main, box, block))
        if name in BLOCK:
            block = len(open_) - 1
            if name not in TEXT_BLOCKS:
                boxes += 1
                box = boxes
        if is_main:
            spared = spared_main = off_round
        elif marks and not marked:
            spared = off_round
        off += how == OFF_ALWAYS
        if how == OFF_ROUND:
            off_round += 1
            begun.append(len(lines))
        marked += marks
        in_link += name == "a"
        titles += name in HEADINGS
    end_line()
    close(0)
    if any(line.inside and line.length and not s for line, s in zip(lines, strict, strict=True)):
        found = strict
    elif any(line.inside and line.length for line in lines):
        found = lenient
    else:
        found = _off_by_parts(always, words_off, sizes)
    for line, is_off in zip(lines, found, strict=True):
        line.off = is_off
        line.length = 0 if is_off else line.length
    return lines


def _off_by_parts(always: list[bool], words_off: list[tuple[int, int]], sizes: list[int]) -> list[bool]:
    """Which lines are off on a page without marks: those of elements off by a word, but for elements with most of the text."""
    upto = [0, *accumulate(0 if o else s for o, s in zip(always, sizes, strict=True))]
    change = [0] * (len(sizes) + 1)
    for first, stop in words_off:
        if 2 * (upto[stop] - upto[first]) <= upto[-1]:
            change[first] += 1
            change[stop] -= 1
    return [o or n > 0 for o, n in zip(always, accumulate(change), strict=False)]


def main_lines(lines: list[Line], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines between a surge and the dive after it.

    A surge begins at a line of at least half its window's mean, so that a short line before the text
    is left out; headings that stand right before it belong to it, and so do unlinked lines of its container.
    """
    marked = any(line.inside and line.length for line in lines)
    length = np.array([line.length if line.inside or not marked else 0 for line in lines], dtype=np.int64)
    if not length.any():
        return []
    sums = np.convolve(length, np.ones(window, dtype=np.int64))[window - 1 :]  # of the window that begins at a line
    least = 1 if marked else min(surge, int(sums.max()))
    kept = np.zeros(len(lines), bool)
    within = False
    for k in range(len(lines)):
        if not within and length[k] and sums[k] >= least and (marked or 2 * window * length[k] >= sums[k]):
            within = True
            before = k - 1
            while before >= 0 and length[before] and not kept[before]:
                line = lines[before]
                if not (line.title or not marked and line.plain and line.box == lines[k].box):
                    break
                kept[before] = True
                before -= 1
        elif within and not sums[k]:
            within = False
        kept[k] |= within and (length[k] > 0 or not marked and not lines[k].off)
    return [line.text for line, keep in zip(lines, kept, strict=True) if keep]


def main_text(page: str | None) -> str:
    """The main text, a block per line; empty if the page has none."""
    return "\n".join(main_lines(lines_of(page or "")))


def extract(pages: DataFrame) -> DataFrame:
    """Per row: ``page_id, url, text, n_chars`` (code points of the text).

    Null and empty pages and pages without main text give an empty text; broken markup is read as far
    as it goes. Rows are independent, so repeated rows and ids do not matter.
    """
    stage(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
