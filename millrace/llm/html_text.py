"""Main text of web pages by the distribution of line blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Set

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import in_batches

#: Lines summed at once; also how many empty lines part the page's containers.
WINDOW = 3
#: A block of lines starts where a window holds this many characters.
SURGE = 86
#: A line of which links make up more than this share counts as navigation.
MOST_LINKED = 0.6

# Element names.
SILENT = frozenset(
    "script style template noscript svg math title iframe object canvas select button textarea option datalist".split()
)
BOILERPLATE = frozenset("nav header footer aside form menu dialog".split())
CONTAINERS = frozenset("html body main article section div table".split())
BLOCKS = CONTAINERS | BOILERPLATE | frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd tr td th thead tbody tfoot caption pre blockquote figure figcaption address "
    "hr details summary fieldset legend center hgroup search video audio".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names in class, id and role of what is no article text.
_APART = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|banners?|sponsor(?:ed|s)?|promos?|promotions?|"
    r"nav|navbar|navigation|menus?|breadcrumbs?|masthead|topbar|footer|foot|bottombar|colophon|copyright|"
    r"side|sidebar|aside|rail|widgets?|"
    r"cookies?|consent|gdpr|notices?|alerts?|popups?|modal|overlay|toast|paywall|"
    r"comments?|commentlist|disqus|respond|replies|reply|reviews|"
    r"share|sharing|social|newsletter|subscribe|signup|login|search|searchbox|form|"
    r"pagination|pager|tagcloud|skip|contentinfo|complementary|banner)(?:$|[\s_-]|\d)",
    re.IGNORECASE,
)
#: Names of what is none outside an article. Inside it may be a part of the text: its blocks decide.
_DOUBTFUL = re.compile(
    r"(?:^|[\s_-])(?:header|legal|related|recommend(?:ed|ations?)?|popular|trending|discussion|review|follow|"
    r"subscription|tags?|toc)(?:$|[\s_-]|\d)",
    re.IGNORECASE,
)
#: A name that starts like this tells reader comments, on an article element as well.
_COMMENTS = re.compile(r"(?:^|\s)(?:comments?|commentlist|disqus|respond|replies|reply)(?:$|[\s_-]|\d)", re.IGNORECASE)
#: How an open element is taken: as text, by what its blocks say, dropped, dropped with articles in it.
TEXT, DOUBTFUL, DROPPED, FIRM = range(4)
#: A last short block that is no text.
_RIGHTS = re.compile(r"©|\bcopyright\b|\ball rights reserved\b", re.IGNORECASE)
_SENTENCE_END = tuple(".!?…。！？\"”’)")
#: Names that only say what a page has elsewhere.
_STATE = re.compile(r"\b(?:has|no|with|without|hide|show|is)[-_][\w-]+", re.IGNORECASE)
_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE) for name in SILENT}
_ARTICLE_ROLES = frozenset(("main", "article"))
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)


def _taken(attributes: str) -> tuple[int, bool]:
    """How an element's class, id or role says it is to be taken; whether it names the article."""
    taken, article = TEXT, False
    if "=" in attributes or "hidden" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or "").strip("\"'")
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                taken = max(taken, DROPPED)
            elif key == "style":
                if "display:none" in value.replace(" ", "").lower():
                    taken = max(taken, DROPPED)
            elif key in ("class", "id", "role"):
                spaced = _STATE.sub("", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value))
                if _COMMENTS.search(spaced):
                    taken = FIRM
                elif _APART.search(spaced):
                    taken = max(taken, DROPPED)
                elif _DOUBTFUL.search(spaced):
                    taken = max(taken, DOUBTFUL)
                article |= key == "role" and value.lower() in _ARTICLE_ROLES
    return taken, article


def _own(lines: list[tuple[str, int]]) -> list[int]:
    """Text lengths, 0 where a line is mostly links."""
    return [0 if linked > MOST_LINKED * len(text) else len(text) for text, linked in lines]


def _sums(own: list[int]) -> list[int]:
    return [sum(own[i : i + WINDOW]) for i in range(len(own))]


def lines_of(page: str) -> tuple[list[tuple[str, int]], list[tuple[str, int]], set[int]]:
    """Lines of the page outside its article, lines inside its article or main element, each
    (text, linked characters), and which of the former are headings.

    Markup is stripped; a block-level element starts a new line, a line break is white space.
    What navigation, headers, footers, forms, adverts, notices or comments hold is dropped and
    leaves WINDOW empty lines, as does each border of a container outside the article.
    Inside the article, an element of a doubtful name stays if a block in it surges, or if it has
    a heading and is a header or has other text that is no link.
    Scripts and their like end at their own end tag; without one, only script and style take what
    follows. Elements left open end with their parent; an article's start ends boilerplate left
    open, but not asides, footers and reader comments: articles in those are dropped with them.
    """
    lines: list[tuple[str, int]] = []
    inner: list[tuple[str, int]] = []
    headings: set[int] = set()
    inner_headings: list[int] = []
    stack: list[tuple[str, int, int]] = []  # open elements that matter: name, how taken, lines of the article before
    open_names: dict[str, int] = {}
    outs: list[int] = []  # depths of dropped elements
    article = linked = firm = 0
    parts: list[str] = []
    link_chars = at = 0
    in_heading = False

    def take(text: str) -> None:
        nonlocal link_chars
        if text and not outs:
            parts.append(text)
            if linked:
                link_chars += len(text.strip())

    def end_line() -> None:
        nonlocal link_chars
        if parts:
            line = " ".join(html.unescape("".join(parts)).split())
            if line:
                if in_heading:
                    inner_headings.append(len(inner)) if article else headings.add(len(lines))
                (inner if article else lines).append((line, link_chars))
            parts.clear()
            link_chars = 0

    def gap() -> None:
        if not article:
            lines.extend([("", 0)] * WINDOW)

    def enter(name: str, taken: int) -> None:
        nonlocal article, linked, firm
        if taken >= DROPPED:
            outs.append(len(stack))
            firm += taken == FIRM or name in ("aside", "footer")
        article += name == "article:"
        linked += name == "a"
        stack.append((name, taken, len(inner)))
        open_names[name.rstrip(":")] = open_names.get(name.rstrip(":"), 0) + 1

    def judge(name: str, before: int) -> None:
        """Take a doubtful element's lines out again if its blocks do not speak for it."""
        own = _own(inner[before:])
        headed = [i for i in range(len(inner_headings) - 1, -1, -1) if inner_headings[i] >= before]
        other = sum(1 for n in own if n) > len(headed)
        if max(_sums(own), default=0) < SURGE and not (headed and (name == "header" or other)):
            del inner[before:]
            del inner_headings[len(inner_headings) - len(headed) :]

    def leave(depth: int) -> None:
        nonlocal article, linked, firm
        while len(stack) > depth:
            name, taken, before = stack.pop()
            open_names[name.rstrip(":")] -= 1
            if taken >= DROPPED:
                outs.pop()
                firm -= taken == FIRM or name in ("aside", "footer")
            elif taken == DOUBTFUL:
                judge(name, before)
            article -= name == "article:"
            linked -= name == "a"

    endless: set[str] = set()
    while m := _TOKEN.search(page, at):
        closing, name = m[1], (m[2] or "").lower()
        take(page[at : m.start()])
        at = m.end()
        if not name:
            continue
        if name in SILENT and not closing:
            # What looks like markup inside is none: only the element's own end tag ends it.
            end = None if m[0].endswith("/>") or name in endless else _END[name].search(page, at)
            if end:
                at = end.end()
            elif not m[0].endswith("/>"):
                endless.add(name)
                if name in ("script", "style"):
                    at = len(page)
            continue
        if name == "head":  # its elements are silent or void; other text is the body's, with or without tags
            continue
        if name == "br" or name in VOID and name != "hr":
            take(" ")
            continue
        if name == "a":
            if closing:
                at_depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in ("a", "p", "li", "div")), -1)
                if at_depth >= 0 and stack[at_depth][0] == "a":
                    leave(at_depth)
            elif not (stack and stack[-1][0] == "a"):
                enter("a", TEXT)
            continue
        taken, named_article = (TEXT, False) if closing or not m[3] else _taken(m[3])
        if name in ("html", "body", "main") or name == "article" and taken != FIRM or name in HEADINGS and taken == DOUBTFUL:
            taken = TEXT
        if taken == DOUBTFUL and (not article or name not in BLOCKS):
            taken = DROPPED
        if name not in BLOCKS:
            if taken and not closing:  # an inline element set apart
                enter(name, taken)
            elif closing and any(n == name and out >= DROPPED for n, out, _ in stack[-4:]):
                leave(max(i for i in range(max(0, len(stack) - 4), len(stack)) if stack[i][0] == name and stack[i][1] >= DROPPED))
            continue
        end_line()
        in_heading = name in HEADINGS and not closing
        if closing:
            if open_names.get(name):
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0].rstrip(":") == name))
            if name in CONTAINERS or name in BOILERPLATE:
                gap()
            continue
        if name == "hr":
            continue
        starts_article = (name in ("article", "main") or named_article) and taken < DROPPED
        if starts_article and outs and not firm:
            # Boilerplate that was never closed does not swallow the article.
            leave(outs[0])
        if name in ("p", "li", "tr", "td", "th", "dt", "dd"):
            if stack and stack[-1][0] == name:
                leave(len(stack) - 1)
        # A header inside the article holds its headline.
        if name in BOILERPLATE and not (name == "header" and article):
            taken = max(taken, DROPPED)
        if name in CONTAINERS or name in BOILERPLATE:
            gap()
        if starts_article and not outs and taken < DROPPED:
            enter("article:", TEXT)
        else:
            enter(name, taken)
    take(page[at:])
    end_line()
    leave(0)
    return lines, inner, headings


def _runs(lines: list[tuple[str, int]], start: int, step: int) -> Iterator[tuple[int, int]]:
    """Runs of lines with text from ``start`` on, as (first, end), in the direction of ``step``."""
    i = start
    while 0 <= i < len(lines):
        if not lines[i][0]:
            i += step
            continue
        j = i
        while 0 <= j < len(lines) and lines[j][0]:
            j += step
        yield (i, j) if step > 0 else (j + 1, i + 1)
        i = j


def spread(lines: list[tuple[str, int]], surge: int, headings: Set[int] = frozenset()) -> list[str]:
    """The text between the first surge and the last dive point of the line-block distribution.

    A line's block is the sum of the text lengths of WINDOW lines from it on, without lines
    that are mostly links. A run of lines whose blocks stay above zero counts if a block in it
    reaches ``surge``, or the page's highest block if none does. Text starts with the first
    such run and ends where the last one falls to zero; all in between but links is kept, and a
    line of links between two lines of text. Up to two runs without links before it are
    taken as well if one of them has a heading, and all next ones after it that have no links
    and end like a sentence.
    """
    own = _own(lines)
    sums = _sums(own)
    least = min(surge, max(sums, default=0))
    high = [i for i, s in enumerate(sums) if s >= least > 0]
    if not high:
        return []
    start, end = high[0], high[-1]
    while start > 0 and sums[start - 1]:
        start -= 1
    while end < len(sums) and sums[end]:
        end += 1
    while start < end and not own[start]:
        start += 1
    if headings:
        for (first, last), _ in zip(_runs(lines, start - 1, -1), range(2)):
            if not all(own[first:last]):
                break
            if any(i in headings for i in range(first, last)):
                start = first
    for first, last in _runs(lines, end, 1):
        text = lines[last - 1][0]
        if not all(own[first:last]) or not text.endswith(_SENTENCE_END) or _RIGHTS.search(text):
            break
        end = last

    def kept(i: int) -> bool:
        return own[i] > 0 or lines[i][0] != "" and start < i < end - 1 and own[i - 1] > 0 and own[i + 1] > 0

    return [lines[i][0] for i in range(start, end) if kept(i)]


def main_text(page: str) -> str:
    """The article's blocks, joined by one line feed; empty if the page has none."""
    lines, inner, headings = lines_of(page)
    # In a marked article every text counts; else the distribution has to tell it.
    kept = [text for text, _ in inner] if inner else spread(lines, SURGE, headings)
    return "\n".join(kept)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py() or "") for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html, ...).

    The whole page is read. Null and empty pages and pages without an article give an empty
    text, an empty table an empty one, a null page_id stays null. Character references are decoded, white space inside a block is one space, blocks
    are joined by one line feed in page order. Repeated rows are extracted alike; other columns
    are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return in_batches(rows, _texts, "page_id long, url string, text string, n_chars long")
