"""Main text of web pages by line-block distribution.

Markup is stripped and the page becomes a sequence of lines, one per block element. A line weighs the characters
that may be article text: none in menus, footers, forms, adverts and the like; the unlinked ones elsewhere; and where
the page declares its article, none outside it. Lengths are summed over a sliding window of lines. Text begins where
that sum surges above a threshold and ends where it dives to another; what lies between is kept.

Pages are independent: one pass over them, no shuffle. A task holds one page's lines at a time.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quotaloom.llm.common import fresh

#: Lines on either side of a line that its window takes in.
REACH = 1
#: A page without a declared article: text begins at a window of SURGE characters (half the page's fullest window if that is
#: less) and ends before one of less than a quarter of that.
SURGE = 80
#: At the ends of such text, lines shorter than this that are neither headings nor sentences go.
SHORT = 25

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript object script select style svg template textarea title xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag ends an open element of these, unless an element of the last set was opened since.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("article aside blockquote body div dl footer form header main menu nav ol section table ul".split())

# What is not the article, by element, role and the words of class and id.
DROP_TAGS = frozenset("aside audio button canvas dialog fieldset footer form head label map menu nav search video".split())
DROP_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "promotion recommended related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toc toolbar topbar".split()
)
#: A header outside the article goes, unless its name says that it is the article's.
OWN_HEADER = frozenset("article content entry post section story".split())
#: A name that begins like this says something about its element's surroundings.
ABOUT = frozenset("has is no not with without".split())

_tag = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_unfinished = re.compile(r"<[a-zA-Z/!?]")
_attribute = re.compile(r"""([^\s"'=<>/]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_name_part = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass(slots=True)
class Line:
    """One block's text; ``linked``: characters in links; ``heading``: of a heading; ``inside``: of a declared article."""

    text: str
    linked: int
    heading: bool
    inside: bool


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _attribute.finditer(source)}


def _unwanted(tag: str, attributes: dict[str, str], in_article: bool, by_name: bool, drop: frozenset[str]) -> bool:
    """Whether the element is something other than the article."""
    if tag in drop or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    if attributes.get("role", "").lower() in DROP_ROLES:
        return True
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split() if by_name else ():
        words = [w.lower() for w in _name_part.findall(name)]
        if words and words[0] not in ABOUT and not DROP_WORDS.isdisjoint([*words, "".join(words)]):
            return True
        if "header" in words and not in_article and OWN_HEADER.isdisjoint(words):
            return True
    return False


def lines(source: str, by_name: bool = True, drop: frozenset[str] = DROP_TAGS) -> list[Line]:
    """The page's blocks in order; unwanted elements leave an empty line where they stood.

    ``by_name``: heed class and id; ``drop``: elements that hold no article text.
    """
    out: list[Line] = []
    pieces: list[str] = []
    links: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # of open elements: tag, unwanted, article, link; each of the element or around it
    opened: dict[str, int] = {}
    state = ("", False, False, False)
    heading = False

    def end_line() -> None:
        nonlocal heading
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                linked = len(" ".join(html.unescape("".join(links)).split())) if links else 0
                out.append(Line(text, linked, heading, state[2]))
            pieces.clear()
            links.clear()
        heading = False

    def leave(to: int) -> None:
        nonlocal state
        while len(stack) > to:
            opened[stack.pop()[0]] -= 1
        state = stack[-1] if stack else ("", False, False, False)

    def add(text: str) -> None:
        if not state[1]:
            pieces.append(text)
            if state[3]:
                links.append(text)

    at, end = 0, source.rfind(">") + 1  # no tag is complete beyond that
    while m := _tag.search(source, at, end):
        if m.start() > at:
            add(source[at : m.start()])
        at = m.end()
        closing, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:  # a comment or declaration
            continue
        tag = tag.lower()
        if tag == "br":
            add("\n")
            continue
        if tag in BLOCKS:
            end_line()
        if closing:
            if opened.get(tag):
                to = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
                if stack[-1][1] and not (stack[to - 1][1] if to else False) and tag in BLOCKS:
                    out.append(Line("", 0, False, False))
                leave(to)
            continue
        if tag in RAW and not rest.endswith("/"):
            over = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            at = over.end() if over else len(source)
            continue
        if tag in VOID or rest.endswith("/"):
            continue
        if tag == "body" and opened.get("head"):
            leave(next(i for i in range(len(stack)) if stack[i][0] == "head"))
        ends = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
        if n_open := sum(opened.get(t, 0) for t in ends):
            leave(_outermost(stack, ends, n_open))
        attributes = _attributes(rest) if rest.strip() else {}
        role = attributes.get("role", "").lower()
        unwanted = state[1] or _unwanted(tag, attributes, state[2], by_name, drop)
        article = state[2] or (not unwanted and (tag in ("article", "main") or role in ("article", "main")))
        stack.append((tag, unwanted, article, state[3] or tag == "a"))
        opened[tag] = opened.get(tag, 0) + 1
        state = stack[-1]
        heading = heading or tag in HEADINGS
    rest = source[at:]
    cut_off = _unfinished.search(rest)
    add(rest[: cut_off.start()] if cut_off else rest)
    end_line()
    return out


def _outermost(stack: list, tags: set[str], n_open: int) -> int:
    """Where the outermost of ``tags``, of which ``n_open`` are open, stands inside the innermost holding element; the stack's length if none does."""
    found = len(stack)
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in tags:
            found, n_open = i, n_open - 1
        if not n_open or stack[i][0] in HOLDS:
            break
    return found


def kept_lines(page: list[Line]) -> list[Line]:
    """The lines between surge and dive points."""
    import numpy as np

    declared = any(x.inside and x.text for x in page)
    if declared:
        weight = np.array([len(x.text) if x.inside else 0 for x in page], np.int64)
    else:
        weight = np.array([len(x.text) - x.linked for x in page], np.int64)
    total = np.concatenate([[0], np.cumsum(weight)])
    at = np.arange(len(page))
    window = total[np.minimum(at + REACH + 1, len(page))] - total[np.maximum(at - REACH, 0)]
    surge = 1 if declared else min(SURGE, max(1, int(window.max(initial=0)) // 2))
    dive = max(1, surge // 4)
    out: list[Line] = []
    i = 0
    while i < len(page):
        if window[i] < surge:
            i += 1
            continue
        low = high = i
        while low and window[low - 1] >= dive:
            low -= 1
        while high < len(page) and window[high] >= dive:
            high += 1
        run = [x for x, w in zip(page[low:high], weight[low:high], strict=True) if w > 0]
        if not declared:
            run = _trimmed(run)
        out += run
        i = high
    return out


def _trimmed(run: list[Line]) -> list[Line]:
    """``run`` without the short lines at its ends that are neither headings nor sentences; all of it if there are only such."""

    def stays(x: Line) -> bool:
        return x.heading or len(x.text) - x.linked >= SHORT or x.text[-1] in ".!?…:;\"'”’)。！？"

    marks = [i for i, x in enumerate(run) if stays(x)]
    return run[marks[0] : marks[-1] + 1] if marks else run


def extract(source: str) -> str:
    """The main text of a page: its kept blocks, joined by two line breaks."""
    found = kept_lines(lines(source))
    if not found:  # names, or a form around the whole page, would drop everything
        found = kept_lines(lines(source, by_name=False)) or kept_lines(lines(source, False, DROP_TAGS - {"form"}))
    return "\n\n".join(x.text for x in found)


def main_text(pages: DataFrame, html_col: str = "html", text_name: str = "text", count_name: str = "n_chars") -> DataFrame:
    """``pages`` with the main text and its code points in place of ``html_col``.

    Character references are decoded (as HTML does, also without semicolon); white space, Unicode's included, and ``br`` become one space
    inside a block; blocks are joined in page order by two line breaks. A null, empty or textless page has the empty
    text. Every row is kept with its other columns, repeated ones as often as they come; a new name that one of them
    has gets an underscore. An empty table gives no rows.
    """
    at = pages.columns.index(html_col)
    rest = pages.drop(html_col)
    names = [*rest.columns, *fresh(rest, text_name, count_name)]
    schema = StructType([*rest.schema.fields, StructField(names[-2], StringType()), StructField(names[-1], LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(s.as_py() or "") for s in batch.column(at)]
            others = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*others, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=names)

    return pages.mapInArrow(run, schema)
