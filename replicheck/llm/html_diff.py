"""Main text of web pages by differencing pages of neighbouring URLs.

Pages are sorted by host, path and id, so that each stands beside the pages with the nearest
URLs of its host. A page's markup is cut into lines, one a block. Lines of a page and of its
neighbours are aligned by their longest common subsequence (bit-parallel, on line hashes); shared
lines are the site's template and are deleted. Neighbours that share most of their lines are
copies or further versions of the page and say nothing of the template; the next one of the host is
taken instead, however far away. Two things decide beside it: lines in elements
that by name or role never hold main text (menus, headers, footers, adverts, forms, comments,
...) are deleted, shared or not, and where a page has an ``article`` or ``main`` element, what lies
outside is deleted. Lines inside one go only where the neighbours on both sides share them, so
that a passage of two pages stays and a notice in every article goes.

Hosts are dealt out by ranges of their URLs, so a large host is split over tasks, as hashes of
lines only. A task looks at the ``REACH`` pages on either side. Pages that may lose lines and find
no neighbour there, amid copies or at the edge of a range, look on by joins: every range tells
which lines all its pages of a host hold, so that ranges of nothing but copies are passed over, and
the first range left is searched by its pages without enough of the lines, then further ones.
What goes is joined to the pages by a hash of the whole row, so texts are not shuffled unless
many pages lose lines.

Null and empty pages have an empty text; a null url sorts as an empty host and path. Texts of any
length are taken whole. Repeated rows are copies of each other. Extra columns are not read and an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterable
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from replicheck.llm.text import give_back, map_batches, record
from replicheck.llm.urls import host_and_path
from replicheck.sources import Workspace

#: Pages on either side that a task looks at by itself, and the share of lines from which
#: a page counts as a copy.
REACH, COPY = 3, 0.6
#: Bits of a page's place that count it inside its range.
LOCAL_BITS = 33
#: What a page's line is: in an element without main text, outside the page's frame, or text.
EXCLUDED, OUTSIDE, TEXT = range(3)

#: What begins like markup: comments and the like, which always end somewhere, or a tag's name.
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)(?=[A-Za-z])", re.S)
NAME_END, EVENT = re.compile(r"[\s/>]"), re.compile("[>\"']")
# Elements of HTML by what they do to a text.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "wbr"}
NEVER = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "object", "audio", "video", "canvas",
         "map", "head", "fieldset", "header"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "menubar", "form"}
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?s?|sidebar|side-bar|nav(?:bar|igation)?"
    r"|menus?|breadcrumbs?|(?:page-|site-)?(?:header|footer)|masthead|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal"
    r"|newsletter|subscribe|signup|social|share|sharing|related|recommended|comments?|respond|disqus|replies|reply|pagination"
    r"|pager|widget|toolbar|skip-link)(?=$|[\s_-])",
    re.I,
)
ATTRIBUTE = re.compile(r"(class|id|role|aria-hidden|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
CLOSES_P = {"p", "div", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "aside", "nav",
            "header", "footer", "main", "form", "blockquote", "pre", "hr", "figure", "address", "fieldset", "details"}


def _excluded(name: str, attributes: str) -> bool:
    if name in NEVER:
        return True
    if name in ("html", "body", "main", "article") or not attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        key = m[1].lower()
        if key in ("class", "id") and NAMES.search(value):
            return True
        if key == "role" and value.lower() in ROLES or key == "aria-hidden" and value.lower() == "true" or key == "hidden":
            return True
    return False


class Tags:
    """Markup of a page in order. A tag is a name, then quoted strings and what else is no quote,
    up to ``>`` or the page's end; where a quote stays open it is no tag, unless a shorter name
    leaves that quote to the rest. Every stretch is read a few times at most, whatever the page."""

    def __init__(self, html: str):
        self.html = html
        self.ends: dict[int, int] = {}  # by an opening quote: the tag's end, -1 where it has none
        self.near = {EVENT: (0, -1), NAME_END: (0, -1)}  # the stretch known to hold no such sign
        self.refused = 0  # no quote before it leads to a tag's end

    def _next(self, sign: re.Pattern, at: int) -> int:
        """The first place of a sign from ``at`` on, the page's end if there is none."""
        low, found = self.near[sign]
        if not low <= at <= found:
            m = sign.search(self.html, at)
            found = m.start() if m else len(self.html)
            self.near[sign] = (at, found)
        return found

    def _end(self, at: int) -> int:
        """Where a tag ends whose inside is at ``at``, beyond its ``>``."""
        html, passed = self.html, []
        event = self._next(EVENT, at)
        while True:
            if event == len(html):
                end = event
            elif html[event] == ">":
                end = event + 1
            elif event in self.ends:
                end = self.ends[event]
            else:
                passed.append(event)
                close = html.find(html[event], event + 1)
                if close >= 0:
                    m = EVENT.search(html, close + 1)
                    event = m.start() if m else len(html)
                    continue
                end = -1
            for quote in passed:
                self.ends[quote] = end
            return end

    def _tag(self, at: int) -> tuple[int, int] | None:
        """Where the name at ``at`` and its tag end."""
        stop = self._next(NAME_END, at)
        if (end := self._end(stop)) >= 0:
            return stop, end
        if stop <= self.refused:
            return None
        for quote in range(stop - 1, max(at, self.refused - 1), -1):
            if self.html[quote] in "\"'" and (end := self._end(quote)) >= 0:
                return quote, end
        self.refused = stop
        return None

    def __iter__(self):
        """``(start, end, closing, name, attributes)``; comments and the like have no name."""
        at = 0
        while m := MARKUP.search(self.html, at):
            if m[1] is None:
                yield m.start(), m.end(), False, "", ""
                at = m.end()
                continue
            tag = self._tag(m.end())
            if tag is None:
                at = m.end()
                continue
            stop, end = tag
            inside = self.html[stop : end - 1 if self.html[end - 1] == ">" and end > stop else end]
            at = (yield m.start(), end, bool(m[1]), self.html[m.end() : stop].lower(), inside) or end


class Open:
    """Open elements as ``(name, excluded, inside)``, with the places of each name and of all that
    are no inline elements."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def top(self) -> tuple[str, bool, bool]:
        return self.stack[-1] if self.stack else ("", False, False)

    def push(self, name: str, excluded: bool, inside: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((name, excluded, inside))

    def cut(self, k: int) -> None:
        """Close the elements from place ``k`` on."""
        while len(self.stack) > k:
            name = self.stack.pop()[0]
            self.places[name].pop()
            if name not in INLINE:
                self.blocks.pop()

    def close(self, name: str) -> None:
        """An unclosed inline element ends with the block around it."""
        if self.places.get(name):
            k = self.places[name][-1]
            if name not in INLINE or not self.blocks or self.blocks[-1] < k:
                self.cut(k)

    def close_paragraph(self) -> None:
        """An open ``p`` ends, unless another block lies in it."""
        if self.places.get("p") and self.blocks[-1] == self.places["p"][-1]:
            self.cut(self.blocks[-1])


def page_lines(html: str | None) -> list[tuple[str, bool, bool]]:
    """``(text, excluded, inside)`` of every block: whether it lies in an element that never holds
    main text, and whether in an ``article`` or ``main``."""
    out: list[tuple[str, bool, bool]] = []
    held: list[str] = []
    opened = Open()

    def flush() -> None:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, *opened.top()[1:]))

    html = html or ""
    at, tags = 0, iter(Tags(html))
    tag = next(tags, None)
    while tag is not None:
        start, end, closing, name, attributes = tag
        held.append(html[at:start])
        at = end
        if name and name not in INLINE and name not in RAW:
            flush()
        if closing:
            opened.close(name)
        elif name in RAW:
            at = _raw_end(html, name, at)
        elif name and name not in VOID:
            if name in CLOSES_P:
                opened.close_paragraph()
            if not (html.endswith("/>", start, end) and name in INLINE):
                _, excluded, inside = opened.top()
                opened.push(name, excluded or _excluded(name, attributes), inside or name in ("article", "main"))
        try:
            tag = tags.send(at)
        except StopIteration:
            break
    held.append(html[at:])
    flush()
    return out


def _raw_end(html: str, name: str, at: int) -> int:
    """Where an element ends that holds no markup: beyond its closing tag."""
    m = re.compile(f"</{re.escape(name)}", re.I).search(html, at)
    return (html.find(">", m.end()) + 1 or len(html)) if m else len(html)


def shared_lines(a: list[int], b: list[int]) -> set[int]:
    """Places of ``a`` on a longest common subsequence of ``a`` and ``b``."""
    low = 0
    while low < len(a) and low < len(b) and a[low] == b[low]:
        low += 1
    end = 0
    while end < min(len(a), len(b)) - low and a[-1 - end] == b[-1 - end]:
        end += 1
    out = set(range(low)) | set(range(len(a) - end, len(a)))
    x, y = a[low : len(a) - end], b[low : len(b) - end]
    if not x or not y:
        return out
    # Bit j of a row is 0 where the subsequence of x[:i] and y[:j + 1] is longer than with y[:j].
    places: dict[int, int] = {}
    for j, v in enumerate(y):
        places[v] = places.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    if len(x) * len(y) > 1 << 28:  # rows of so many bits don't fit; halves do
        half = len(x) // 2
        cut = _best_cut(x[:half], x[half:], y)
        first, second = shared_lines(x[:half], y[:cut]), shared_lines(x[half:], y[cut:])
        return out | {low + i for i in first} | {low + half + i for i in second}
    rows = [full]
    for v in x:
        row, hit = rows[-1], places.get(v, 0)
        match = row & hit
        rows.append(((row + match) | (row - match)) & full)
    i, j = len(x), len(y)
    while i and j:
        if rows[i] >> (j - 1) & 1:  # y[j - 1] adds nothing
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:  # it adds without x[i - 1], too
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.add(low + i)
    return out


def _lengths(x: list[int], y: list[int]) -> list[int]:
    """Lengths of the longest common subsequence of ``x`` with every prefix of ``y``."""
    places: dict[int, int] = {}
    for j, v in enumerate(y):
        places[v] = places.get(v, 0) | 1 << j
    full = row = (1 << len(y)) - 1
    for v in x:
        match = row & places.get(v, 0)
        row = ((row + match) | (row - match)) & full
    out = [0]
    for bit in bin(row | 1 << len(y))[:2:-1]:
        out.append(out[-1] + (bit == "0"))
    return out


def _best_cut(first: list[int], second: list[int], y: list[int]) -> int:
    ahead, behind = _lengths(first, y), _lengths(second[::-1], y[::-1])
    return max(range(len(y) + 1), key=lambda k: ahead[k] + behind[len(y) - k])


class Page:
    def __init__(self, page_id: int, url: str | None, host: str, html: str | None):
        self.page_id, self.url, self.host = page_id, url, host
        lines = page_lines(html)
        self.framed = any(inside and not excluded for _, excluded, inside in lines)
        self.lines = [t for t, _, _ in lines]
        self.kinds = bytes(
            EXCLUDED if excluded else TEXT if inside or not self.framed else OUTSIDE for _, excluded, inside in lines
        )

    def hashes(self) -> np.ndarray:
        found = (xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in self.lines)
        return np.fromiter(found, np.uint64, len(self.lines)).view(np.int64)

    def texts(self) -> list[str]:
        return [t for t, kind in zip(self.lines, self.kinds) if kind == TEXT]

    def text(self, gone: list[bool]) -> str:
        """Main text without the lines that are ``gone``, a mark for each of ``texts``, if any."""
        texts = self.texts()
        return "\n".join(t for t, away in zip(texts, gone or [False] * len(texts)) if not away)


class Entry:
    """What decides about a page's lines, in the order of URLs."""

    def __init__(self, host: str, page_id: int, key: int, hashes: list[int], kinds: bytes, framed: bool):
        self.host, self.page_id, self.key = host, page_id, key
        self.hashes, self.kinds, self.framed = hashes, kinds, framed
        self.all = set(hashes)
        self.mine = {h for h, kind in zip(hashes, kinds) if kind != EXCLUDED}

    def is_copy(self, other: Entry) -> bool:
        """Whether most of what may be main text is the other's, too."""
        return bool(self.mine) and len(self.mine & other.all) >= COPY * len(self.mine)

    def nearest(self, others: Iterable[Entry]) -> tuple[list[int] | None, bool]:
        """Lines of the neighbour among pages on one side, nearest first, and whether it may lie
        beyond them."""
        for other in others:
            if other.host != self.host:
                return None, False
            if other.page_id != self.page_id and not self.is_copy(other):
                return other.hashes, False
        return None, True


def lines_gone(hashes: list[int], kinds: bytes, framed: bool, neighbours: list[list[int] | None]) -> list[bool] | None:
    """Which lines of text are the site's, given the lines of neighbours; None for none at all."""
    held = Counter(k for n in neighbours if n for k in shared_lines(hashes, n))
    # a frame speaks for its lines, so one page that holds them is not enough there
    gone = [held[k] >= (2 if framed else 1) for k, kind in enumerate(kinds) if kind == TEXT]
    return gone if any(gone) else None


ENTRY = "host string, page_id long, key long, hashes array<long>, kinds binary, framed boolean"
PLACED = f"""place long, {ENTRY}, gone array<boolean>, mine array<long>, back array<long>, open_back boolean,
    ahead array<long>, open_ahead boolean, common array<long>"""


def _rows(pages: DataFrame) -> DataFrame:
    """Rows that are equal have one key, and lose the same lines."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.withColumn("key", F.xxhash64("page_id", "url", "html"))


def _entries(pages: DataFrame) -> DataFrame:
    host, path = host_and_path(F.col("url"))

    def make():
        def step(batch: pa.RecordBatch):
            found = [Page(0, None, "", html) for html in batch.column("html").to_pylist()]
            columns = {c: batch.column(c) for c in ("host", "path", "url", "page_id", "key")}
            return record(
                **columns,
                hashes=pa.array([p.hashes() for p in found], pa.list_(pa.int64())),
                kinds=pa.array([p.kinds for p in found], pa.binary()),
                framed=pa.array([p.framed for p in found], pa.bool_()),
            )

        return step

    rows = _rows(pages).select("page_id", "url", "html", "key", host.alias("host"), path.alias("path"))
    schema = "host string, path string, url string, page_id long, key long, hashes array<long>, kinds binary, framed boolean"
    return map_batches(rows, schema, make)


def _placed(entries: DataFrame) -> DataFrame:
    """Pages in order, each with what it loses, or with the sides on which it has to look on. The
    last page of a host in a range has the lines that all its pages there hold in ``common``."""
    ordered = entries.repartitionByRange("host", "path", "page_id").sortWithinPartitions(
        "host", "path", "page_id", "url", "key"
    )

    def run(batches):
        place = TaskContext.get().partitionId() << LOCAL_BITS
        before: deque[Entry] = deque(maxlen=REACH)
        ahead: deque[Entry] = deque()
        common: set[int] | None = None

        def decide(page: Entry) -> tuple:
            """``gone, mine, back, open_back, ahead, open_ahead``."""
            if TEXT not in page.kinds:
                return None, None, None, False, None, False
            (back, open_back), (front, open_front) = page.nearest(reversed(before)), page.nearest(ahead)
            if page.framed and open_back != open_front:
                # what the known neighbour lacks stays, whatever the other one holds
                if lines_gone(page.hashes, page.kinds, False, [back, front]) is None:
                    open_back = open_front = False
            if open_back or open_front:
                return None, list(page.mine), back, open_back, front, open_front
            return lines_gone(page.hashes, page.kinds, page.framed, [back, front]), None, None, False, None, False

        def finish() -> tuple:
            nonlocal place, common
            page = ahead.popleft()
            decided = decide(page)
            common = set(page.all) if common is None else common & page.all
            shared = None
            if not ahead or ahead[0].host != page.host:
                shared, common = list(common), None
            before.append(page)
            place += 1
            entry = (page.host, page.page_id, page.key, page.hashes, page.kinds if decided[1] else None, page.framed)
            return place, *entry, *decided, shared

        names = ("place", "host", "page_id", "key", "hashes", "kinds", "framed", "gone", "mine", "back", "open_back",
                 "ahead", "open_ahead", "common")
        longs = pa.list_(pa.int64())
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), longs, pa.binary(), pa.bool_(), pa.list_(pa.bool_()), longs,
                 longs, pa.bool_(), longs, pa.bool_(), longs)

        def packed(rows: list[tuple]):
            return record(**{n: pa.array(c, t) for n, t, c in zip(names, types, zip(*rows))})

        rows = []
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                columns = [part.column(c).to_pylist() for c in ("host", "page_id", "key", "hashes", "kinds", "framed")]
                for values in zip(*columns):
                    ahead.append(Entry(*values))
                    if len(ahead) > REACH:
                        rows.append(finish())
                if rows:
                    yield packed(rows)
                    rows = []
        rows = [finish() for _ in range(len(ahead))]
        if rows:
            yield packed(rows)
        before.clear()
        give_back()

    return ordered.select("host", "page_id", "key", "hashes", "kinds", "framed").mapInArrow(run, PLACED)


class Holders:
    """Pages of a range by the lines they hold."""

    def __init__(self, hashes: pa.Array):
        self.n = len(hashes)
        at = np.repeat(np.arange(self.n), np.diff(hashes.offsets.to_numpy()))
        values = hashes.flatten().to_numpy()
        order = np.lexsort((at, values))
        values, at = values[order], at[order]
        other = np.ones(len(values), bool)
        other[1:] = (values[1:] != values[:-1]) | (at[1:] != at[:-1])
        self.values, self.at = values[other], at[other]

    def lacking(self, mine: np.ndarray) -> np.ndarray:
        """Pages that hold too few of these lines for a copy. A line that most pages hold is
        counted by those that lack it."""
        low, high = np.searchsorted(self.values, mine, "left"), np.searchsorted(self.values, mine, "right")
        common, have, lack = 0, [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in zip(low, high):
            if 2 * (b - a) > self.n:
                common += 1
                if b - a < self.n:
                    lack.append(np.setdiff1d(np.arange(self.n), self.at[a:b], assume_unique=True))
            else:
                have.append(self.at[a:b])
        counts = np.bincount(np.concatenate(have), minlength=self.n) - np.bincount(np.concatenate(lack), minlength=self.n)
        return np.flatnonzero(common + counts < COPY * len(mine))


def _search(asked: pa.Table, pages: pa.Table) -> pa.Table:
    """The nearest neighbour of every page that asks, among the pages of one host and range."""
    pages = pages.sort_by("place").combine_chunks()
    places, ids = pages["place"].to_numpy(), pages["page_id"].to_pylist()
    lines = pages["hashes"].combine_chunks()
    holders = Holders(lines)
    rows = zip(*(asked[c].to_pylist() for c in ("mine", "place", "page_id", "side", "n")))
    last, found, out = None, None, []
    for mine, place, page_id, side, n in sorted(rows, key=lambda r: r[0]):
        if mine != last:
            last, found = mine, holders.lacking(np.array(mine, np.int64))
        at = np.searchsorted(found, np.searchsorted(places, place))
        for k in found[:at][::-1] if side < 0 else found[at:]:
            if ids[k] != page_id:
                out.append((place, side, n, k))
                break
    place, side, n, k = zip(*out) if out else ((),) * 4
    return pa.table(
        {"place": pa.array(place, pa.int64()), "side": pa.array(side, pa.int32()), "n": pa.array(n, pa.int32()),
         "hashes": lines.take(pa.array(k, pa.int64()))}
    )


def _neighbours(placed: DataFrame, asking: DataFrame, ws: Workspace) -> DataFrame:
    """``(place, side, hashes)``: the neighbours of pages that have to look on, -1 the one before."""
    part = lambda c: F.shiftrightunsigned(c, LOCAL_BITS).alias("part")
    sides = F.explode(F.array_compact(F.array(F.when(F.col("open_back"), -1), F.when(F.col("open_ahead"), 1))))
    asked = asking.select("place", part("place").alias("own"), "host", "page_id", "mine", sides.alias("side"))
    # mine is in a fixed order, so that copies ask once
    asked = asked.withColumn("mine", F.sort_array("mine"))
    held = placed.filter("common is not null").select("host", part("place"), "common")
    away = (F.col("part") - F.col("own")) * F.col("side")
    copies = F.size(F.array_intersect("mine", "common")) >= F.lit(COPY) * F.size("mine")
    nearest_first = Window.partitionBy("place", "side").orderBy(away)
    trips = ws.stage(
        asked.join(held, "host").filter((away >= 0) & ~copies).withColumn("n", F.row_number().over(nearest_first)), "trips"
    )
    pages = placed.select("host", part("place"), "place", "page_id", "hashes")
    most = trips.agg(F.max("n")).first()[0] or 0
    at = ["host", "part", "own"]  # by the asking pages' range, too: many may ask one range
    found, low, high = None, 1, 1
    while low <= most:
        todo = trips.filter(F.col("n").between(low, high))
        if found is not None:
            todo = todo.join(found.select("place", "side"), ["place", "side"], "left_anti")
        todo = ws.stage(todo.select(*at, "place", "page_id", "mine", "side", "n"), "todo")
        targets = todo.select("host", "part", F.col("own").alias("of")).distinct()
        there = pages.join(targets, ["host", "part"]).withColumnRenamed("of", "own")
        there = there.select(*[F.col(c).alias(c) for c in there.columns])  # unlike the columns of todo
        hits = todo.groupBy(*at).cogroup(there.groupBy(*at))
        hits = hits.applyInArrow(_search, "place long, side int, n int, hashes array<long>")
        hits = ws.stage(hits.groupBy("place", "side").agg(F.min_by("hashes", "n").alias("hashes")), "neighbours")
        found = hits if found is None else found.union(hits)
        low, high = high + 1, 4 * high + 4
    return found if found is not None else placed.select("place", F.lit(-1).alias("side"), "hashes").limit(0)


def _decided(placed: DataFrame, ws: Workspace) -> DataFrame:
    """``(key, gone)`` of the rows that lose lines."""
    here = placed.filter("gone is not null").select("key", "gone")
    asking = placed.filter("open_back or open_ahead")
    if asking.isEmpty():
        return here
    found = _neighbours(placed, asking, ws)

    def make():
        def step(batch: pa.RecordBatch):
            columns = [batch.column(c).to_pylist() for c in ("hashes", "kinds", "framed", "back", "ahead")]
            gone = [lines_gone(h, kinds, framed, [a, b]) for h, kinds, framed, a, b in zip(*columns)]
            return record(key=batch.column("key"), gone=pa.array(gone, pa.list_(pa.bool_())))

        return step

    beside = asking.select("place", "key", "hashes", "kinds", "framed", "back", "ahead")
    for side, name in ((-1, "back"), (1, "ahead")):
        other = found.filter(F.col("side") == side).select("place", F.col("hashes").alias("found"))
        beside = beside.join(other, "place", "left").withColumn(name, F.coalesce(name, "found")).drop("found")
    return here.union(map_batches(beside, "key long, gone array<boolean>", make).filter("gone is not null"))


def extract(pages: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    ws = ws or Workspace(pages.sparkSession)
    placed = ws.stage(_placed(ws.stage(_entries(pages), "lines")), "placed")
    gone = ws.stage(_decided(placed, ws).dropDuplicates(["key"]), "gone")

    def make():
        def step(batch: pa.RecordBatch):
            texts = [Page(0, None, "", html).texts() for html in batch.column("html").to_pylist()]
            columns = {c: batch.column(c) for c in ("page_id", "url", "key")}
            return record(**columns, texts=pa.array(texts, pa.list_(pa.string())))

        return step

    found = map_batches(_rows(pages), "page_id long, url string, key long, texts array<string>", make)
    kept = F.when(F.col("gone").isNull(), F.col("texts")).otherwise(
        F.filter("texts", lambda _, k: ~F.get("gone", k))
    )
    text = found.join(gone, "key", "left").select("page_id", "url", F.array_join(kept, "\n").alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("long"))
