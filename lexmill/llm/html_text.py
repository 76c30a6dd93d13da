"""Main text of web pages by tree scoring.

A page is cut into tags and text once; open elements form a tree, with the ends that HTML implies put in. Text gathers
into blocks at the borders of block elements. Each block outside menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments passes points to the elements around it: one, one more per comma and up to three for
length, less its share of link text; the parent gets all points, the grandparent half, elements further up ever less.
The element with most points, less its own share of link text, is the container. An article or main element around it
takes its place; otherwise neighbours that score well, hold prose or head it are kept too. All its blocks are returned in page order.

Each page is handled where it is read, in memory proportional to that page; nothing is shuffled.

Defined cases: null or empty html and pages without text give an empty text; broken markup (unclosed tags, quotes
or comments, stray ends, an end in the middle of a tag) is read as far as it goes; repeated rows and null ids give a row
each; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.texts import reach_package, slices

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
# Those of them that may end in their own tag, being no HTML inside.
SELF_CLOSING = frozenset(("svg", "math"))
CELLS = frozenset(("td", "th", "table"))
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "tr ul caption optgroup select".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SKIPPED = frozenset(
    "head nav header footer aside form button select option menu dialog object audio video canvas input fieldset label".split()
)
#: An opening tag of the key ends open elements of the value, up to one that shields them.
IMPLIED_END = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
    "body": {"head"},
}
SHIELD = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
TABLE_PARTS = frozenset("tr td th tbody tfoot".split())
#: Parts of a list or a table are no container by themselves.
PARTS = frozenset("tr td th thead tbody tfoot table ul ol li dl dt dd p".split())
#: Words of a class, an id or a role that mark what is not the article.
AWAY = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline combx comment comments complementary "
    "consent contentinfo cookie cookies dialog disqus footer gdpr masthead menu menubar modal nav navbar navigation newsletter "
    "notice notices outbrain pager pagination paywall popup promo promoted recommended related remark remarks replies rss search share "
    "sharing shoutbox sidebar signup skyscraper social sponsor sponsored subscribe subscription taboola tags toolbar topbar "
    "widget widgets alert alertdialog".split()
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAIL = re.compile(r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_MAX_UP = 5


def _put_away(tag: str, attributes: str) -> bool:
    if tag in SKIPPED:
        return True
    if not attributes or attributes.isspace():
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        value = value.strip("\"'")
        if name in ("class", "id", "role"):
            if any(word.lower() in AWAY for word in _PART.findall(value)) and tag not in ("body", "html", "article", "main"):
                return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return True
    return False


class _Page:
    """Elements (tag, parent, whether put away) and blocks (element, text, share of link text) of one page."""

    def __init__(self, source: str):
        self.tag, self.parent, self.away = ["#"], [0], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self._open, self._block, self._links = [0], [0], 0
        # Places in the list of open elements: of each tag, of blocks and of cells and tables.
        self._places: dict[str, list[int]] = {}
        self._blocks_at, self._cells_at = [0], [0]
        self._text: list[str] = []
        self._link_text: list[str] = []
        self._read(source)
        self._flush()

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            if text and not self.away[self._open[-1]]:
                linked = len(" ".join(html.unescape("".join(self._link_text)).split())) if self._link_text else 0
                self.blocks.append((self._block[-1], text, min(linked, len(text))))
            self._text, self._link_text = [], []

    def _add(self, text: str) -> None:
        if text and not self.away[self._open[-1]]:
            self._text.append(text)
            if self._links:
                self._link_text.append(text)

    def _pop(self) -> None:
        node = self._open[-1]
        tag = self.tag[node]
        if tag in BLOCK or self.away[node] != self.away[self.parent[node]]:
            self._flush()
        self._open.pop()
        self._places[tag].pop()
        if tag in BLOCK:
            self._block.pop()
            self._blocks_at.pop()
        if tag in CELLS:
            self._cells_at.pop()
        if tag == "a":
            self._links -= 1

    def _close_implied(self, tag: str) -> None:
        if tag in BLOCK:
            # A block ends an open paragraph, with whatever inline elements were left open in it.
            at = self._last("p")
            if at and at >= self._blocks_at[-1] and at > self._last("button"):
                self._pop_to(at)
        ends = IMPLIED_END.get(tag)
        if ends and any(self._places.get(e) for e in ends):
            shield = SHIELD.get(tag) or ({"table"} if tag in TABLE_PARTS else ())
            for i in range(len(self._open) - 1, 0, -1):
                name = self.tag[self._open[i]]
                if name in shield:
                    break
                if name in ends:
                    while len(self._open) > i:
                        self._pop()
                    if tag not in TABLE_PARTS:
                        break

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._add(" ")
            return
        self._close_implied(tag)
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        above = self._open[-1]
        away = self.away[above] or _put_away(tag, attributes)
        if tag in BLOCK or away != self.away[above]:
            self._flush()
        self.tag.append(tag)
        self.parent.append(above)
        self.away.append(away)
        node = len(self.tag) - 1
        at = len(self._open)
        self._places.setdefault(tag, []).append(at)
        self._open.append(node)
        if tag in BLOCK:
            self._block.append(node)
            self._blocks_at.append(at)
        if tag in CELLS:
            self._cells_at.append(at)
        if tag == "a":
            self._links += 1

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._add(" ")
        at = self._last(tag)
        # An inline element's end does not reach out of a block, nor that of a paragraph or item out of a cell.
        if tag not in BLOCK and self._blocks_at[-1] > at or tag in ("p", "li", "div") and self._cells_at[-1] > at:
            return
        if at:
            self._pop_to(at)

    def _last(self, tag: str) -> int:
        """Place of the innermost open element of a tag; 0 if there is none."""
        places = self._places.get(tag)
        return places[-1] if places else 0

    def _pop_to(self, at: int) -> None:
        while len(self._open) > at:
            self._pop()

    def _read(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            mark = s.find("<", at)
            if mark < 0:
                self._add(s[at:])
                return
            self._add(s[at:mark])
            after = s[mark + 1 : mark + 2]
            if s.startswith("<!--", mark):
                end = s.find("-->", mark + 4)
                at = n if end < 0 else end + 3
            elif after in ("!", "?"):
                end = s.find(">", mark)
                at = n if end < 0 else end + 1
            elif name := _NAME.match(s, mark + 1 + (after == "/")):
                tail = _TAIL.match(s, name.end())
                end = tail.end() if tail else s.find(">", name.end()) + 1
                if not end:
                    return
                tag = name.group().lower()
                at = end
                if after == "/":
                    self._end(tag)
                elif tag in RAW and not (tag in SELF_CLOSING and s.endswith("/>", mark, end)):
                    # Its content is no text of the page.
                    stop = _RAW_END[tag].search(s, end)
                    if not stop:
                        return
                    at = s.find(">", stop.end()) + 1 or n
                else:
                    self._start(tag, s[name.end() : end - 1])
            else:
                self._add("<")
                at = mark + 1


def main_text(source: str | None) -> str:
    """The article's blocks, one per line."""
    page = _Page(source or "")
    if not page.blocks:
        return ""
    points: dict[int, float] = {}
    size: dict[int, int] = {}
    linked: dict[int, int] = {}
    for node, text, link in page.blocks:
        worth = (1 + text.count(",") + min(len(text) // 100, 3)) * (1 - link / len(text))
        if page.tag[node] in HEADINGS:
            worth = 0.0
        up = node
        for level in range(_MAX_UP):
            up = page.parent[up]
            points[up] = points.get(up, 0.0) + worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
            if up == 0:
                break
        up = node
        for _ in range(_MAX_UP + 1):
            size[up] = size.get(up, 0) + len(text)
            linked[up] = linked.get(up, 0) + link
            if up == 0:
                break
            up = page.parent[up]
    final = {k: v * (1 - linked[k] / size[k]) for k, v in points.items()}
    best = max(final, key=lambda k: (final[k], -k))
    while page.tag[best] in PARTS and page.parent[best]:
        best = page.parent[best]
        final.setdefault(best, 0.0)
    up, chosen = best, None
    while up:
        if page.tag[up] in ("article", "main"):
            chosen = up
        if page.tag[up] == "article":
            break
        up = page.parent[up]
    if chosen is not None:
        kept = {chosen}
    else:
        kept = {best} | _neighbours(page, best, final, size, linked)
    out, inside = [], {}
    for node, text, _ in page.blocks:
        path, up = [], node
        while up and up not in kept and up not in inside:
            path.append(up)
            up = page.parent[up]
        found = up in kept or inside.get(up, False)
        inside.update(dict.fromkeys(path, found))
        if found:
            out.append(text)
    return "\n".join(out)


def _neighbours(page: _Page, best: int, final: dict, size: dict, linked: dict) -> set[int]:
    """Elements beside the container that belong to it."""
    least, around, kept = max(10.0, 0.2 * final[best]), page.parent[best], set()
    for node in size:
        if node == best or node == 0 or page.parent[node] != around or page.away[node]:
            continue
        share = linked[node] / size[node]
        prose = page.tag[node] in ("p", "pre", "blockquote") and (size[node] > 80 and share < 0.25 or share == 0)
        if final.get(node, 0) >= least or prose or page.tag[node] in HEADINGS and node < best:
            kept.add(node)
    return kept


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars`` (code points)."""
    reach_package(pages.sparkSession)
    read = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(source).cast("string").alias("html"),
    )
    return read.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op8."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
