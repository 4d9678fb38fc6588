"""Main text of web pages from the events of the standard library's HTML parser.

A page becomes lines, one for each block of text, with the text-to-tag ratio of each. The ratios are
smoothed with a Gaussian, lines above a threshold are seeds, and the regions (the innermost
sectioning elements) that hold a seed are content; within an article so are regions that aren't mostly links. Menus, forms, adverts
and the like, known by their elements and roles, are never content. What only a class name, an id or <form> marks
isn't either, unless the page's article or most of its text is in there.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Elements by their role in a page, as in the HTML standard.
DROPPED = set("nav header footer aside script style noscript template button select svg iframe object canvas dialog head title menu textarea fieldset legend label datalist optgroup option".split())
ARTICLE = {"article", "main"}
#: Dropped as by a class name.
MARKED = {"form"}
SECTIONS = set("html body div section article main ul ol dl table tbody tr td th blockquote figure details fieldset center".split()) | DROPPED | MARKED
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog", "alert", "form"}
# Words of class names and ids that mark what isn't the article.
COMMENT_WORDS = set("comment comments commentlist disqus respond replies reply".split())
OTHER_WORDS = COMMENT_WORDS | set(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert sidebar widget menu nav navbar navigation breadcrumb breadcrumbs masthead header footer share sharing social related "
    "recommended newsletter subscribe signup login popup modal pagination pager".split()
)
# Parts of a class name that say where or what kind of box it is; with them alone it marks nothing.
PLACE_WORDS = set("left right top bottom area block body box container content inner item items list main outer page section site slot text unit user reader wrap wrapper".split())
#: Lines to each side that smoothing reaches, and its spread.
REACH, SIGMA = 2, 1.0
#: A region is a menu if more than this part of its characters are in links.
LINKED = 0.6
#: Characters given to the parser at a time.
FEED = 1 << 20
#: Unclosed tags that are read on from behind as text, before the rest of the page is cut at its tags by a pattern.
RECOVERIES = 16
#: Marked elements within each other that are told apart; deeper ones belong to the last of these.
DEEPEST = 32


@dataclass
class Line:
    region: int
    inside: bool
    dropped: bool
    #: The innermost marked element around the line, or 0.
    mark: int = 0
    parts: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0


class Open(NamedTuple):
    """An open element: its name, and what it says of the lines in it."""

    tag: str = ""
    region: int = 0
    inside: bool = False
    dropped: bool = False
    mark: int = 0
    #: The header of an article: only headings in it are content.
    header: bool = False
    #: Not a sectioning element, opened in a paragraph, so that the paragraph's end closes it.
    in_paragraph: bool = False


class Blocks(HTMLParser):
    """Collects the lines of a page from start, end and text events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        #: Open sectioning elements, and others that are dropped or marked; how many of each name are open.
        self.open: list[Open] = []
        self.names: Counter[str] = Counter()
        #: For each marked element the one around it, and how many there are around it; 0 is the page.
        self.marks = [0]
        self.depths = [0]
        self.regions = 0
        self.links = 0
        self.paragraph = False
        self._line()

    def _line(self) -> None:
        top = self.open[-1] if self.open else Open()
        last = self.lines[-1] if self.lines else None
        if last is not None and not last.parts:
            last.region, last.inside, last.dropped, last.mark = top.region, top.inside, top.dropped, top.mark
        else:
            self.lines.append(Line(top.region, top.inside, top.dropped, top.mark))

    def _close(self, size: int) -> None:
        """Close open elements until ``size`` are left."""
        for x in self.open[size:]:
            self.names[x.tag] -= 1
        del self.open[size:]

    def _end_paragraph(self) -> None:
        """The start or end of a block ends a paragraph, and with it a marked <p> and what is open in there."""
        size = len(self.open)
        while size and self.open[size - 1].in_paragraph:
            size -= 1
        self._close(size)
        self.paragraph = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        inline = tag in INLINE
        if not inline and tag not in VOID:
            self._end_paragraph()
            self.paragraph = tag == "p"
        top = self.open[-1] if self.open else Open()
        section = tag in SECTIONS and not inline
        header = tag == "header" and top.inside and not top.dropped
        unwanted = tag not in VOID and (self._unwanted(attrs) or (tag in DROPPED and not header))
        marked = tag not in VOID and not unwanted and not top.dropped and not header and (tag in MARKED or self._marked(tag, attrs))
        if tag not in VOID and (section or unwanted or marked or self.names[tag]):
            region, mark = top.region, top.mark
            dropped = top.dropped or unwanted or header
            if marked and self.depths[mark] < DEEPEST:
                self.marks.append(mark)
                self.depths.append(self.depths[mark] + 1)
                mark = len(self.marks) - 1
            if (section or unwanted or marked) and not header:
                self.regions += 1
                region = self.regions
            inside = top.inside or (tag in ARTICLE and not dropped and not marked)
            self.open.append(Open(tag, region, inside, dropped, mark, header and not top.dropped, not section and (self.paragraph or tag == "p")))
            self.names[tag] += 1
            inline = inline and not (unwanted or marked)
        if inline:
            self.lines[-1].tags += 1
            self.links += tag == "a"
            return
        self._line()
        self.lines[-1].tags += 1
        if tag in HEADINGS and top.header and not (unwanted or marked):
            self.lines[-1].dropped = False

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        inline = tag in INLINE
        if not inline and tag not in VOID:
            self._end_paragraph()
        closed = Open()
        if self.names[tag]:
            at = len(self.open) - 1
            while self.open[at].tag != tag:
                at -= 1
            closed = self.open[at]
            self._close(at)
        top = self.open[-1] if self.open else Open()
        if inline:
            self.links -= tag == "a" and self.links > 0
            if closed.region == top.region or not closed.tag:
                return
        elif tag in SECTIONS and closed.tag:
            self.links = 0
        self._line()

    def handle_data(self, data: str) -> None:
        line = self.lines[-1]
        line.parts.append(data)
        if self.links:
            line.linked += len(data)

    @staticmethod
    def _unwanted(attrs: list[tuple[str, str | None]]) -> bool:
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "role" and (value or "").lower() in ROLES:
                return True
            if name == "style" and re.search(r"display\s*:\s*none", value or "", re.I):
                return True
        return False

    @staticmethod
    def _marked(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        for name, value in attrs:
            if name in ("class", "id") and tag not in ("html", "body", "main"):
                known = COMMENT_WORDS if tag == "article" else OTHER_WORDS
                for token in (value or "").lower().split():
                    parts = {x for x in re.split(r"[^a-z]+", token) if len(x) > 1}
                    if parts & known and parts <= known | PLACE_WORDS:
                        return True
        return False


def drop_marked(lines: list[Line], sizes: list[int], marks: list[int]) -> None:
    """Set ``dropped`` for the lines in marked elements, but for those elements that the content is in.

    While no article is left outside of marked elements: of those that hold article text, if any, the one with most of it is no
    longer marked; on a page without article text, the one with more than half of the text, or with the most if no other is left.
    An element that is mostly links stays marked. Of elements of equal text the outermost comes first.
    """
    live = [i for i, x in enumerate(lines) if not x.dropped]
    inside = any(lines[i].inside for i in live)
    freed = {0}

    def around(mark: int) -> list[int]:
        out = []
        while mark:
            if mark not in freed:
                out.append(mark)
            mark = marks[mark]
        return out

    for _ in marks:
        text = [0] * len(marks)
        article, linked = text[:], text[:]
        total = outside = 0
        found = False
        for i in live:
            x, n = lines[i], sizes[i]
            held = around(x.mark)
            total += n
            outside += 0 if held else n
            found = found or (x.inside and not held)
            for m in held:
                text[m] += n
                article[m] += n * x.inside
                linked[m] += x.linked
        if found:
            break
        value = article if inside else text
        usable = [m for m in range(1, len(marks)) if value[m] and linked[m] <= LINKED * text[m]]
        best = max(usable, key=lambda m: (value[m], text[m], -m), default=0)
        if not best or (not inside and outside and 2 * text[best] <= total):
            break
        freed.add(best)
    for i in live:
        lines[i].dropped = bool(around(lines[i].mark))


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """``ratios`` smoothed with a Gaussian that is cut off at REACH lines."""
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    return np.convolve(np.pad(ratios, REACH, mode="edge"), kernel / kernel.sum(), mode="valid")


def finish(parser: Blocks) -> None:
    """Close the parser, in time linear in what an unclosed tag or comment has left unread.

    An unclosed comment hides the rest of the page, as the HTML standard says. An unclosed tag is text up to the next ``>``, as
    in the parser's own ``close``; after RECOVERIES of them, all that looks like a tag is cut from the rest, which is one line.
    """
    for tried in range(RECOVERIES + 1):
        rest = parser.rawdata
        if parser.cdata_elem or not re.match(r"<[a-zA-Z/!?]", rest):
            break
        end = rest.find(">") + 1
        if rest.startswith("<!"):
            parser.rawdata = ""
        elif not end or tried == RECOVERIES:
            parser.rawdata = ""
            parser.handle_data(unescape(re.sub(r"<[^<>]*>", " ", rest)))
        else:
            parser.rawdata = rest[end:]
            parser.handle_data(unescape(rest[:end]))
            parser.feed("")
    parser.close()


def extract(html: str | None) -> str:
    """The main text: blocks in page order, white space made single spaces; empty if there is none."""
    if not html:
        return ""
    parser = Blocks()
    for at in range(0, len(html), FEED):
        parser.feed(html[at : at + FEED])
    finish(parser)
    texts, lines = [], []
    for line in parser.lines:
        text = " ".join("".join(line.parts).split())
        if text:
            texts.append(text)
            lines.append(line)
    if not lines:
        return ""
    drop_marked(lines, list(map(len, texts)), parser.marks)
    in_article = any(x.inside and not x.dropped for x in lines)
    candidate = [not x.dropped and (x.inside or not in_article) for x in lines]
    if not any(candidate):
        return ""
    score = smoothed(np.array([len(t) / max(1, x.tags) for t, x in zip(texts, lines, strict=True)]))
    chars: dict[int, int] = {}
    linked: dict[int, int] = {}
    best: dict[int, float] = {}
    for i, x in enumerate(lines):
        if candidate[i]:
            chars[x.region] = chars.get(x.region, 0) + len(texts[i])
            linked[x.region] = linked.get(x.region, 0) + x.linked
            best[x.region] = max(best.get(x.region, -math.inf), float(score[i]))
    prose = [r for r in chars if linked[r] <= LINKED * chars[r]]
    threshold = float(score.std())
    if in_article:
        # an article's regions are content, but for lists of links with as little text for their tags as a menu
        chosen = set(prose) | {r for r in chars if best[r] >= threshold} or set(chars)
    else:
        usable = prose or list(chars)
        chosen = {r for r in usable if best[r] >= threshold} or {max(usable, key=lambda r: (chars[r], -r))}
    return " ".join(t for t, x, c in zip(texts, lines, candidate, strict=True) if c and x.region in chosen)


def main_text(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """For each row: the key, the URL, ``text`` (its main text, empty if none) and ``n_chars``.

    Whole pages are read, in feeds of bounded size. Null and empty pages give empty texts; null keys and URLs stay null;
    repeated rows are read alike; other columns are left out; pages without markup are their own text.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[key, url, "text", "n_chars"])

    return df.select(key, url, html).mapInArrow(read, df.select(key, url).schema.add("text", "string").add("n_chars", "long"))
