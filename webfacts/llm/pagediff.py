"""Main text of pages by differencing them with the page of the nearest URL.

Pages of a host stand in order of URL path, so that pages made from one
template are neighbours. Each page is cut into lines, one per block of the page;
a longest common subsequence aligns the lines of neighbours, and lines that both
have are the template's: menus, notices, footers.

Copies of a page, of the same path or near it, say nothing about the template: a
page is differenced with the nearest pages before and after it that are not nearly
the same.

Two things that differencing alone gets wrong are set right by the markup: an
article that two pages both carry is not template, so lines inside an article or
main element stay; and parts that markup names as no content (navigation,
adverts, comments and so on) go even where their words differ from page to page.
On a page with an article, only its lines are text; on a page without, the lines
that no neighbour shares.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfacts.llm.ranges import RANGES_PER_PARTITION, in_ranges, range_of, shuffle_partitions

# A comment, a declaration, or a tag whose quoted attributes may hold ">"; a tag
# with an open quote ends at its first ">".
_MARK = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)"""
    r"""((?:[^>"']*+(?:"[^"]*"|'[^']*')?+)*+)(?:>|(?=["'])[^>]*>?|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_RAW = frozenset("script style noscript template textarea title iframe svg math object select "
                 "option audio video canvas".split())
_UNPARSED = frozenset("script style textarea title iframe noscript template".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "html head body p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table tr caption thead tbody tfoot "
    "section article main nav aside header footer form fieldset blockquote pre figure figcaption "
    "address details summary hr menu dialog center".split())
_SPACED = frozenset("br td th button".split())
_CONTENT = frozenset("article main".split())
_OTHER = frozenset("nav header footer aside menu dialog button fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu "
                   "menubar alertdialog".split())
# Class names and ids that name parts beside the article, alone or as the first
# or last word of a name.
_NAMED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices notification alert newsletter subscribe signup "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment "
    "comments disqus respond reply replies social share sharing related recommended popup modal "
    "overlay widget pagination pager toolbar skip".split())
# Names with one of these words tell what a part has or is like: has-sidebar, comments-open.
_STATES = frozenset(
    "has have with no without is not hide show open opened closed enabled disabled active wrapper "
    "wrap layout container page".split())
_COMMENT = frozenset(["comment", "comments"])
_WORD = re.compile(r"[a-z]+")
_CLOSED_BY = {
    "p": _BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "option": frozenset(["option"])}

ARTICLE, BODY, OTHER = "a", "b", "o"
# Pages are copies when this part of the words of the longer one is in both.
NEARLY = 0.9
_ROWS_AT_ONCE = 256


def _named(value: str, content: bool) -> bool:
    """Does a name in a class or id attribute name a part beside the article?
    An article or main is one only as a comment."""
    for token in value.split():
        words = _WORD.findall(token)
        if not words or len(words) > 1 and not _STATES.isdisjoint(words):
            continue
        if words[0] in _COMMENT if content else words[0] in _NAMED or words[-1] in _NAMED:
            return True
    return False


def _beside(name: str, attributes: str) -> str | None:
    """``"sure"`` for a part beside the article by its element or role,
    ``"named"`` for a form and one by class or id alone."""
    if name in _OTHER:
        return "sure"
    found = "named" if name == "form" else None
    content = name in _CONTENT
    if not attributes or name in ("html", "body") or content and "omment" not in attributes:
        return found
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        key = key.lower()
        if key == "role" and value in _ROLES or key == "aria-hidden" and value == "true":
            return "sure"
        if key == "role" and value == "form" or key in ("class", "id") and _named(value, content):
            found = "named"
    return found


def page_lines(page: str) -> list[tuple[str, str]]:
    """``(zone, line)`` of each block with text, in page order.

    One pass with a stack of open elements. The content of scripts and the like
    is skipped up to its own closing tag; an unclosed element ends with its
    parent. An article inside a form or a part named by class or id alone counts
    where no article is inside fewer of them: such a part may hold the page, or
    be a list of other articles.
    """
    out: list[tuple[str, str, int]] = []
    line: list[str] = []
    stack: list[str] = []
    # Depths at which an article, a part beside it, one by name alone and an
    # unread part begin.
    inside: list[int] = []
    beside: list[int] = []
    named: list[int] = []
    unread: list[int] = []

    def text(raw: str) -> None:
        if raw and not unread:
            line.append(raw)

    def flush() -> None:
        if line:
            words = " ".join(html.unescape("".join(line)).split())
            line.clear()
            if words:
                if beside or named and (not inside or named[-1] > inside[-1]):
                    zone = OTHER
                else:
                    zone = ARTICLE if inside else BODY
                out.append((zone, words, len(named)))

    def shut(depth: int) -> None:
        if any(name in _BLOCK for name in stack[depth:]):
            flush()
        del stack[depth:]
        for marks in (inside, beside, named, unread):
            while marks and marks[-1] >= depth:
                marks.pop()

    at = 0
    lower = None
    while True:
        mark = _MARK.search(page, at)
        if not mark:
            text(page[at:])
            break
        text(page[at:mark.start()])
        at = mark.end()
        name = (mark.group(2) or "").lower()
        if not name:
            continue
        if mark.group(1):
            if name in stack:
                shut(len(stack) - 1 - stack[::-1].index(name))
            elif name in _BLOCK:
                flush()
            continue
        attributes = mark.group(3) or ""
        if name in _SPACED:
            text(" ")
        if name in _VOID:
            if name in _BLOCK:
                flush()
            continue
        if name in _UNPARSED:
            lower = page.lower() if lower is None else lower
            end = lower.find(f"</{name}", at) if len(lower) == len(page) else page.find(f"</{name}", at)
            closing = page.find(">", end) if end >= 0 else -1
            at = closing + 1 if closing >= 0 else len(page)
            continue
        if stack and name in _CLOSED_BY.get(stack[-1], ()):
            shut(len(stack) - 1)
        if name in _BLOCK:
            if name != "p" and "p" in stack[-8:]:
                shut(len(stack) - 1 - stack[::-1].index("p"))
            flush()
        if attributes.rstrip().endswith("/") and name in _RAW:
            continue
        if name in _RAW:
            unread.append(len(stack))
        elif part := _beside(name, attributes):
            flush()
            (beside if part == "sure" else named).append(len(stack))
        elif name in _CONTENT or "role" in attributes and re.search(r"role\s*=\s*[\"']?main", attributes):
            inside.append(len(stack))
        stack.append(name)
    flush()
    least = min((n for zone, _, n in out if zone == ARTICLE), default=0)
    return [(OTHER if zone == ARTICLE and n > least else zone, words) for zone, words, n in out]


def common_lines(one: Sequence[str], two: Sequence[str]) -> tuple[set[int], set[int]]:
    """Places of the lines that a longest common subsequence aligns.

    Equal ends are matched at once. The rest is solved by rows of bits, one bit
    for each line of the other page, halved (Hirschberg) while the rows would
    take too much memory.
    """
    first: set[int] = set()
    second: set[int] = set()

    def row_after(a: Sequence[str], b: Sequence[str]) -> int:
        where: dict[str, int] = {}
        for j, value in enumerate(b):
            where[value] = where.get(value, 0) | (1 << j)
        row = full = (1 << len(b)) - 1
        for value in a:
            hit = row & where.get(value, 0)
            row = ((row + hit) | (row - hit)) & full
        return row

    def lengths(row: int, n: int) -> list[int]:
        out = [0]
        for bit in format(row, f"0{n}b")[::-1] if n else "":
            out.append(out[-1] + (bit == "0"))
        return out

    todo = [(0, len(one), 0, len(two))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and one[a] == two[c]:
            first.add(a)
            second.add(c)
            a, c = a + 1, c + 1
        while a < b and c < d and one[b - 1] == two[d - 1]:
            b, d = b - 1, d - 1
            first.add(b)
            second.add(d)
        if a == b or c == d:
            continue
        if b - a == 1:
            for j in range(c, d):
                if two[j] == one[a]:
                    first.add(a)
                    second.add(j)
                    break
            continue
        if d - c == 1:
            for i in range(a, b):
                if one[i] == two[c]:
                    first.add(i)
                    second.add(c)
                    break
            continue
        middle = (a + b) // 2
        ahead = lengths(row_after(one[a:middle], two[c:d]), d - c)
        behind = lengths(row_after(one[middle:b][::-1], two[c:d][::-1]), d - c)[::-1]
        total = [x + y for x, y in zip(ahead, behind)]
        cut = c + total.index(max(total))
        todo += [(a, middle, c, cut), (middle, b, cut, d)]
    return first, second


def main_text(lines: list[tuple[str, str]], shared: set[int]) -> str:
    """Lines of the article, or without one the lines that no neighbour has."""
    if any(zone == ARTICLE for zone, _ in lines):
        kept = [line for zone, line in lines if zone == ARTICLE]
    else:
        kept = [line for i, (zone, line) in enumerate(lines) if zone == BODY and i not in shared]
    return "\n".join(kept)


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html",
    ranges: int | None = None,
) -> DataFrame:
    """``(page_id, url, text, n_chars, shared_lines)``, one row per page.

    The pages are shuffled once, into ranges of (host, path, page_id). A page is
    compared with the nearest page before and the nearest after it, of its host,
    that is no copy (``NEARLY``); ``shared_lines`` counts its lines that one of
    them has. A range gets the last page of the range before and the first of the
    one after as rows that are only looked at; where a run of copies goes on over
    that border, the nearest page beyond the border that is no copy as well.

    Defined cases: null markup has empty text; pages whose URL is null or has no host are one
    host; a null id comes first; repeated pages and pages that differ in few words
    are no template of each other, so a host of copies alone keeps all but the
    parts that markup names as no content; an empty table gives an empty table;
    other columns are left out.
    """
    least = -(1 << 63)
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(markup).alias("html"),
        F.struct(
            F.coalesce(_host(F.col(url)), F.lit("")).alias("host"),
            F.coalesce(_path(F.col(url)), F.lit("")).alias("path"),
            F.coalesce(F.col(page_id).cast("long"), F.lit(least)).alias("id")).alias("_key"))
    ranges = ranges or RANGES_PER_PARTITION * shuffle_partitions(pages.sparkSession)
    cuts = _key_cuts(rows, ranges)
    literal = lambda keys: F.array(*[F.struct(
        F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(i).cast("long").alias("id"))
        for h, p, i in keys])
    placed = rows.withColumn("_part", range_of(F.col("_key"), cuts, literal))
    looks = _looks(rows, placed)
    both = placed.withColumn("_place", F.lit(1))
    if looks:
        # A few rows for each range, whose number the session's partitions bound.
        wanted = F.broadcast(pages.sparkSession.createDataFrame(
            looks, "_for int, _at int, _key struct<host:string,path:string,id:bigint>"))
        seen = (
            rows.join(wanted, "_key").groupBy("_for", "_at", "_key").agg(F.min("html").alias("html"))
            .select(F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("url"),
                    "html", "_key", F.col("_for").alias("_part"), F.col("_at").alias("_place")))
        both = both.unionByName(seen)
    ordered = in_ranges(both, "_part", F.asc("_place"), F.asc("_key"), F.asc("html"), partitions=ranges)
    return ordered.select("page_id", "url", "html", F.col("_key.host").alias("_host"), "_part", "_place").mapInArrow(
        _differenced, "page_id long, url string, text string, n_chars long, shared_lines long")


def _key_cuts(rows: DataFrame, ranges: int, each: int = 32) -> list[tuple]:
    """Keys that begin a range, from a hashed sample of ``each`` keys per range."""
    n = rows.count()
    share = min(1.0, ranges * each / max(n, 1))
    bar = int(share * (1 << 32))
    sample = sorted(
        tuple(r["_key"]) for r in rows.select("_key")
        .where(F.pmod(F.xxhash64("_key"), F.lit(1 << 32)) < bar).collect())
    picked = {sample[i * len(sample) // ranges] for i in range(1, ranges)} if sample else set()
    return sorted(picked)


def _looks(rows: DataFrame, placed: DataFrame) -> list[tuple]:
    """``(range, place, key)`` of the pages that a range looks at beyond its ends,
    where its host goes on there."""
    ends = sorted(
        ((r["_part"], tuple(r["a"]), tuple(r["b"])) for r in placed.groupBy("_part").agg(
            F.min("_key").alias("a"), F.max("_key").alias("b")).collect()), key=lambda r: r[0])
    # Ranges and pages on both sides of each border inside a host.
    borders = [(one[0], one[2], two[0], two[1]) for one, two in zip(ends, ends[1:]) if one[2][0] == two[1][0]]
    looks = [look for low, last, high, first in borders for look in ((high, 0, last), (low, 2, first))]
    if not borders:
        return looks
    key = "struct<host:string,path:string,id:bigint>"
    edges = F.broadcast(rows.sparkSession.createDataFrame(
        [(i, side, b[2 * side + 1]) for i, b in enumerate(borders) for side in (0, 1)],
        f"_border int, _side int, _key {key}"))
    pairs = (
        rows.join(edges, "_key").groupBy("_border", "_side").agg(F.min("html").alias("html"))
        .groupBy("_border").agg(F.max(F.when(F.col("_side") == 0, F.col("html"))).alias("a"),
                                F.max(F.when(F.col("_side") == 1, F.col("html"))).alias("b")))

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for border, one, two in zip(*(c.to_pylist() for c in batch.columns)):
                if _Page((), page_lines(one or "")).nearly(_Page((), page_lines(two or ""))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([border], pa.int32()), pa.array([two], pa.string())], names=["border", "html"])

    # At most one page for each border, of which few lie in a run of copies.
    runs: dict[str, list] = {}
    for r in pairs.mapInArrow(copies, "border int, html string").collect():
        low, last, high, first = borders[r["border"]]
        runs.setdefault(first[0], []).append((r["border"], last, first, r["html"]))
    if not runs:
        return looks

    def beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages = {i: _Page((), page_lines(page or "")) for own in runs.values() for i, _, _, page in own}
        best: dict[tuple, tuple] = {}
        for batch in batches:
            for found, markup in zip(batch.column(0).to_pylist(), batch.column(1)):
                at = (found["host"], found["path"], found["id"])
                page = None
                for border, last, first, _ in runs[at[0]]:
                    place = 0 if _order(at) < _order(last) else 2 if _order(at) > _order(first) else None
                    held = best.get((border, place))
                    if place is None or held and (_order(held) >= _order(at)) == (place == 0):
                        continue
                    page = page or _Page((), page_lines(markup.as_py() or ""))
                    if not page.nearly(pages[border]):
                        best[border, place] = at
        for (border, place), (host, path, own) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in ((border, pa.int32()), (place, pa.int32()), (host, pa.string()),
                                               (path, pa.string()), (own, pa.int64()))],
                names=["border", "place", "host", "path", "id"])

    hosts = F.broadcast(rows.sparkSession.createDataFrame([(h,) for h in sorted(runs)], "_host string"))
    others = (
        rows.join(hosts, F.col("_key.host") == F.col("_host"), "left_semi").select("_key", "html")
        .mapInArrow(beyond, "border int, place int, host string, path string, id long")
        .groupBy("border", "place").agg(F.min(F.struct("host", "path", "id")).alias("a"),
                                        F.max(F.struct("host", "path", "id")).alias("b")).collect())
    for r in others:
        low, _, high, _ = borders[r["border"]]
        looks.append((high, 0, tuple(r["b"])) if r["place"] == 0 else (low, 2, tuple(r["a"])))
    return looks


def _order(key: tuple) -> tuple:
    """Keys in Spark's order, that of the bytes of their strings."""
    host, path, own = key
    return host.encode("utf-8", "surrogatepass"), path.encode("utf-8", "surrogatepass"), own


class _Page:
    """Pages with the same lines in a row, and what their neighbours share."""

    def __init__(self, group: tuple, lines: list[tuple[str, str]]):
        self.group = group
        self.lines = lines
        self.plain = [line for _, line in lines]
        self.words = Counter(w for zone, line in lines if zone != OTHER for w in line.split())
        self.n = sum(self.words.values())
        self.rows: list[tuple] = []
        self.shared: set[int] = set()
        self.before: _Page | None = None

    def nearly(self, other: _Page) -> bool:
        least, most = sorted((self.n, other.n))
        if least < NEARLY * most:
            return False
        few, many = sorted((self.words, other.words), key=len)
        return sum(min(n, many[w]) for w, n in few.items()) >= NEARLY * most


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "text", "n_chars", "shared_lines"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    # The last page, and it and those before it that still have to meet a page
    # after them which is no copy.
    last: _Page | None = None
    waiting: list[_Page] = []

    def closed(pages: list[_Page]) -> Iterator[pa.RecordBatch]:
        for page in pages:
            text = main_text(page.lines, page.shared) if page.rows else ""
            for at in range(0, len(page.rows), _ROWS_AT_ONCE):
                rows = [(*row, text, len(text), len(page.shared)) for row in page.rows[at:at + _ROWS_AT_ONCE]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    for batch in batches:
        for page_id, url, markup, host, part, place in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist()):
            lines = page_lines(markup.as_py() or "")
            if last and last.group == (part, host) and last.lines == lines:
                if place == 1:
                    last.rows.append((page_id, url))
                continue
            page = _Page((part, host), lines)
            if place == 1:
                page.rows.append((page_id, url))
            if last and last.group == page.group:
                copy = page.nearly(last)
                if not copy:
                    still = []
                    done = []
                    for one in waiting:
                        if one is not last and one.nearly(page):
                            still.append(one)
                            continue
                        if one.rows:
                            one.shared.update(common_lines(one.plain, page.plain)[0])
                        done.append(one)
                    yield from closed(done)
                    waiting = still
                other = last if not copy else last.before
                if other and copy and page.nearly(other):
                    other = other.before
                if other and not page.nearly(other):
                    page.before = other
                    # A page further back is not asked for.
                    if other.before:
                        other.before.before = None
                    if page.rows:
                        page.shared.update(common_lines(page.plain, other.plain)[0])
            else:
                yield from closed(waiting)
                waiting = []
            waiting.append(page)
            last = page
    yield from closed(waiting)
