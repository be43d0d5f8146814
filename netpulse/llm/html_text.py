"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import slices

#: Lines in a sliding window, and the text in one that makes a surge.
WINDOW, SURGE = 3, 80
#: Text in a window that keeps a marked element, and the share of it in links up to which it does.
LONG, LINKED = 400, 0.25
#: Text in an article or main element counts so many times.
BONUS = 3

# Element names of HTML by role.
DROPPED = frozenset(
    "head title script style noscript template iframe object svg canvas audio video map form button select option textarea "
    "input label fieldset nav menu footer aside dialog".split()
)
RAW = frozenset("script style noscript template iframe textarea title svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
BODY = frozenset(("article", "main"))
# Words in class, id and role names that mark what is not the article.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar side "
    "aside menu nav navbar navigation navigationbar breadcrumb breadcrumbs pagination pager toolbar topbar header masthead footer "
    "comment comments commentlist respond reply replies disqus discussion share sharing social related recommended "
    "recommendations widget widgets search skip complementary contentinfo".split()
)
# Of these, words that mark what is no article however long it is, and words that take a mark back.
SURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr comment comments "
    "commentlist respond reply replies disqus".split()
)
UNMARKING = frozenset("no has with without".split())

#: Of marks, words that inside an article name parts of it as well; links alone make such a part go.
SOFT = frozenset("search skip notice notices alert related discussion".split())
# Start tags that end an open element of their group, as HTML leaves out its end tag.
IMPLIED = {n: group for group in ({"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}) for n in group}

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")


def _left_out(name: str, attributes: str, inside: int) -> bool:
    """Whether the element goes whatever it holds."""
    if name in DROPPED or (name == "header" and not inside):
        return True
    return bool(attributes) and name not in ("html", "body") and bool(_HIDDEN.search(attributes))


def _marked(name: str, attributes: str, inside: int) -> set[str]:
    """The words that mark the element, if any; a header in an article holds its title."""
    if not attributes or name in ("html", "body") or name in BODY and not _commented(attributes):
        return set()
    found = _marks(attributes) & MARKED
    return found - {"header", "masthead"} if inside else found


def _marks(attributes: str) -> set[str]:
    found: set[str] = set()
    for _, *values in _NAMES.findall(attributes):
        split = re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values))
        for one in split.lower().split():
            words = _WORDS.findall(one)
            found.update(w for w, before in zip(words, ["", *words]) if before not in UNMARKING)
    return found


def _commented(attributes: str) -> bool:
    return bool(_marks(attributes) & {"comment", "comments", "reply"})


def _tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, '/' or '', name, attributes) of every tag; comments and declarations have no name.

    Every character is passed a bounded number of times: a tag ends at the first > outside quotes;
    where quotes run to the end of the page they count for nothing from there on, and an element of
    raw content is looked for an end tag only while one may follow.
    """
    at, quotes, unending = 0, True, set()
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = end + 3 if end >= 0 else len(page)
            yield at, end, "", "", ""
        elif name := _NAME.match(page, at):
            end = _ATTRIBUTES.match(page, name.end()).end() if quotes else -1
            if end < 0 or not page.startswith(">", end):
                quotes, end = False, page.find(">", name.end())
            if end < 0:
                return  # no tag ends any more
            tag, attributes, end = name[2].lower(), page[name.end() : end], end + 1
            yield at, end, name[1], tag, attributes
            if tag in RAW and not name[1] and tag not in unending:
                stop = re.compile(rf"</{re.escape(tag)}\s*+>", re.IGNORECASE).search(page, end)
                if stop:
                    yield stop.start(), stop.end(), "/", tag, ""
                    end = stop.end()
                elif tag in ("script", "style"):
                    yield len(page), len(page), "/", tag, ""
                    return
                else:
                    unending.add(tag)
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            if end < 0:
                return
            end += 1
            yield at, end, "", "", ""
        else:
            end = at + 1
        at = end


@dataclass
class _Element:
    name: str
    start: int
    goes: bool = False
    marks: frozenset[str] = frozenset()
    inside: int = 0
    bodies: int = 0
    body: bool = False


class _Page:
    """Markup taken off in one pass with a stack: pieces of text, line breaks (None), and marked elements.

    An element's marks hold if its own end tag closes it; one that the page or an outer element
    ends leaves no trace. Inline end tags do not reach beyond the block they stand in.
    """

    def __init__(self, page: str):
        self.pieces: list[str | None] = []
        self.linked: list[bool] = []
        self.inside: list[bool] = []
        self.gone: list[tuple[int, int]] = []
        self.gaps: set[int] = set()
        self.doubtful: list[tuple[_Element, int, bool]] = []
        self.stack: list[_Element] = []
        self.open: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.depth = self.bodies = 0
        at = 0
        for start, end, slash, name, attributes in _tags(page):
            self.add(page[at:start])
            at = end
            if not name:
                continue
            if name == "br":
                self.add(" ")
            elif slash:
                self.end(name)
            else:
                self.begin(name, attributes)
        self.add(page[at:])
        self.add(None)
        while self.stack:
            self.pop(False)
        self.judge()

    def add(self, piece: str | None) -> None:
        if piece != "":
            self.pieces.append(piece)
            self.linked.append(bool(self.open.get("a")))
            self.inside.append(self.depth > 0)

    def begin(self, name: str, attributes: str) -> None:
        block = name not in INLINE
        if block:
            self.add(None)
        top = self.stack[-1].name if self.stack else ""
        if top in IMPLIED.get(name, ()) or block and top == "p":
            self.pop(True)
        if name in VOID or attributes.rstrip().endswith("/"):
            return
        goes = name in RAW or _left_out(name, attributes, self.depth)
        marks = frozenset() if goes else frozenset(_marked(name, attributes, self.depth))
        body = name in BODY and not goes and not _commented(attributes)
        element = _Element(name, len(self.pieces), goes, marks, self.depth, self.bodies, body)
        self.bodies += body
        self.depth += body
        self.open.setdefault(name, []).append(len(self.stack))
        if block:
            self.blocks.append(len(self.stack))
        self.stack.append(element)

    def end(self, name: str) -> None:
        places = self.open.get(name)
        if name not in INLINE:
            self.add(None)
        elif places and self.blocks and places[-1] < self.blocks[-1]:
            return
        if places:
            for _ in range(len(self.stack) - 1 - places[-1]):
                self.pop(False)
            self.pop(True)

    def pop(self, closed: bool) -> None:
        element = self.stack.pop()
        self.open[element.name].pop()
        block = element.name not in INLINE
        if block:
            self.blocks.pop()
        self.depth -= element.body
        if closed and element.goes:
            self.leave_out(element.start, len(self.pieces), block)
        elif closed and element.marks and self.bodies == element.bodies + element.body:
            if element.marks & SURE:
                self.leave_out(element.start, len(self.pieces), block)
                return
            self.doubtful.append((element, len(self.pieces), block))

    def leave_out(self, start: int, end: int, block: bool) -> None:
        self.gone.append((start, end))
        if block:
            self.gaps.add(start)

    def judge(self) -> None:
        """Marked elements go unless their line blocks show text: WINDOW lines with LONG characters, few in links.

        Inside an article, those with soft marks only go if much of them is links.
        """
        if not self.doubtful:
            return
        # per place in the pieces: the line it is on; per line: its characters
        line = np.cumsum([0, *[p is None for p in self.pieces]])
        length = np.array([len(" ".join(p.split())) if p else 0 for p in self.pieces], np.int64)
        total = np.concatenate([[0], np.cumsum(length)])
        links = np.concatenate([[0], np.cumsum(length * np.array(self.linked, np.int64))])
        size = np.bincount(line[:-1], length, line[-1] + 1).astype(np.int64)
        rank = np.concatenate([[0], np.cumsum(size > 0)])  # empty lines do not count
        ends = np.concatenate([[0], np.cumsum(size[size > 0])])
        windows = ends[WINDOW:] - ends[:-WINDOW] if len(ends) > WINDOW else np.zeros(0, np.int64)
        highest = [windows]
        while 2 ** len(highest) <= len(windows):
            step, last = 2 ** (len(highest) - 1), highest[-1]
            highest.append(np.maximum(last[:-step], last[step:]))
        for element, end, block in self.doubtful:
            chars = total[end] - total[element.start]
            few_links = links[end] - links[element.start] <= LINKED * chars
            if element.inside and element.marks <= SOFT:
                text = few_links
            else:
                first, after = rank[line[element.start]], rank[line[end]]
                most = chars
                if after - first > WINDOW:
                    n = int(after - first - WINDOW + 1)
                    level = highest[n.bit_length() - 1]
                    most = max(level[first], level[first + n - 2 ** (n.bit_length() - 1)])
                text = most >= LONG and few_links
            if not text:
                self.leave_out(element.start, end, block)

    def lines(self) -> list[tuple[str, bool, int]]:
        """(text, in the article, characters in links) per block; empty lines where an element was left out."""
        change = [0] * (len(self.pieces) + 1)
        for start, end in self.gone:
            change[start] += 1
            change[end] -= 1
        out: list[tuple[str, bool, int]] = []
        parts: list[str] = []
        hidden = linked = 0
        inside = False
        for i, piece in enumerate(self.pieces):
            hidden += change[i]
            if i in self.gaps:
                out.extend([("", False, 0)] * WINDOW)
            if piece is not None and not hidden:
                parts.append(piece)
                linked += len(" ".join(piece.split())) if self.linked[i] else 0
                inside = self.inside[i]
            elif piece is None and parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    out.append((text, inside, linked))
                parts, linked = [], 0
        return out


def _stretches(sizes: list[int]) -> list[tuple[int, int, int]]:
    """Where the window sums rise above zero and fall to it again, and their greatest: (from, to, top)."""
    sums, run = [], sum(sizes[:WINDOW])
    for i in range(len(sizes)):
        sums.append(run)
        run += (sizes[i + WINDOW] if i + WINDOW < len(sizes) else 0) - sizes[i]
    out, start = [], None
    for i, total in enumerate([*sums, 0]):
        if total and start is None:
            start = i
        elif not total and start is not None:
            out.append((start, i, max(sums[start:i])))
            start = None
    return out


def main_text(page: str | None) -> str:
    """Text between the surge and dive points of the line-block distribution.

    Each line's block is the text of WINDOW lines from it on. A stretch of lines runs from where the
    block sums rise above zero to where they fall to it again; it is kept if its sums surge to SURGE
    characters. If none does, the stretch of the greatest sum is kept. Elements left out leave empty
    lines, so they end a stretch. Lines in an article or main element count BONUS times. Where they
    still weigh no less than the surging lines around them, without links, the lines around count as
    empty and every stretch inside is kept: its short lines are no noise. Else, as with a teaser
    beside the text, all lines are judged alike.
    """
    lines = _Page(page or "").lines()
    sizes = [len(text) * (BONUS if inside else 1) for text, inside, _ in lines]
    around = [0 if inside else max(0, len(text) - linked) for text, inside, linked in lines]
    weight = sum(size for size, (_, inside, _) in zip(sizes, lines) if inside)
    article = 0 < weight >= sum(sum(around[a:b]) for a, b, top in _stretches(around) if top >= SURGE)
    if article:
        sizes = [size if inside else 0 for size, (_, inside, _) in zip(sizes, lines)]
    stretches = _stretches(sizes)
    least = 1 if article else min(SURGE, max((top for _, _, top in stretches), default=0))
    return "\n".join(lines[i][0] for a, b, top in stretches if top >= least for i in range(a, b) if sizes[i])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row; '' and 0 for null, empty or textless pages.

    Pages are read whole and alone, however broken their markup; repeated rows give repeated results;
    extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    source = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return source.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
