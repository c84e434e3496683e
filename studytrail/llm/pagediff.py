"""Main text of web pages by markup and by differencing with the page at the nearest URL.

A page is cut into text blocks. Blocks in elements that carry no article text (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, comments) are left out. If the page marks
its article (``article`` or ``main``), the blocks in it are the text. If it does not, the page
is compared with its neighbour in URL order within the host: lines are aligned by longest
common subsequence, and lines that both pages have are template text and deleted.

Differencing never touches a marked article: two articles of a host may share a sentence, a
heading or a licence line, and those belong to both.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studytrail.llm.common import kept, whole

# Elements by what they mean for the text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
LEFT_OUT = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript template head nav footer aside form button select "
    "option datalist menu dialog svg math canvas object audio video map".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
MARKED = frozenset("article main".split())
# Words of class, id and role that name parts without article text.
NAMED_OUT = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside complementary contentinfo cookie cookies consent gdpr notice "
    "popup modal newsletter subscribe signup login search comment comments disqus respond related recommended share sharing "
    "social widget toolbar pagination pager side alert topbar adsbygoogle skip".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>?|([^<]+|<)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TELLING = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
# First words of two-word names whose second word is in NAMED_OUT ("site-header").
PLACES = frozenset("site page main top bottom left right global primary secondary blog user reader post article".split())
_PART = re.compile(r"[^a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
# Words that, beside one of NAMED_OUT, name a part inside an article ("comment-list", "ad-slot-2"); with other
# words it may be the name of a heading ("search-algorithms") or of a figure ("comment-count").
CONTAINERS = frozenset(
    "area bar block box button buttons container form group icons inner items link links list panel posts row section slot strip "
    "thread unit wrap wrapper".split()
)
# Elements whose id names their own place in the text.
ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p a span li dt".split())
OPEN, OUT, ARTICLE = 0, 1, 2


def _attributes(text: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    if _TELLING.search(text):
        for name, double, single, bare in _ATTRIBUTE.findall(text):
            found.setdefault(name.lower(), double or single or bare)
    return found


def _names_a_part(label: str, in_article: bool) -> bool:
    """Whether a class, id or role names a part without article text. Inside an article all of its words
    have to say so, elsewhere the first."""
    parts = [p for p in _PART.split(label) if p and not p.isdigit()]
    if not parts:
        return False
    if in_article:
        return "header" not in parts and not NAMED_OUT.isdisjoint(parts) and all(p in NAMED_OUT | CONTAINERS | PLACES for p in parts)
    # "ad", "cookie-notice", "site-footer", "reader-comments"; but not "no-sidebar".
    return parts[0] in NAMED_OUT or len(parts) == 2 and parts[0] in PLACES and parts[1] in NAMED_OUT


def _is_out(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """An element that begins a part without article text."""
    if name in LEFT_OUT:
        return True
    if name == "header" and not in_article:
        return True
    if not attributes or name in ("html", "body"):
        return False
    if "hidden" in attributes or _HIDDEN.search(attributes.get("style", "")):
        return True
    told = ("class", "role") if in_article and name in ANCHORED else ("class", "id", "role")
    return any(_names_a_part(label, in_article) for key in told for label in attributes.get(key, "").lower().split())


def _flush(pieces: list[str], found: list[tuple[int, str]], region: int) -> None:
    if pieces:
        text = " ".join("".join(pieces).split())
        if text:
            found.append((region, text))
        pieces.clear()


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(region, text) of each text block in page order; white space within is one space.

    Unclosed elements end with their parent, a page may end anywhere, and an unclosed menu or
    header ends where an article begins."""
    found: list[tuple[int, str]] = []
    # Open elements that decide the region: (name, region before it).
    stack: list[tuple[str, int, int]] = []
    depth: dict[str, int] = {}
    # The region, and that of the text collected so far.
    region = owner = OPEN
    pieces: list[str] = []
    data = html or ""
    at = 0
    while at < len(data):
        token = _TOKEN.match(data, at)
        at = token.end()
        close, name, attributes, loose_name, loose_attributes, text = token.groups()
        if loose_name:
            name, attributes = loose_name, loose_attributes
        if text is not None:
            if region != OUT:
                pieces.append(entities.unescape(text))
                owner = region
        elif close:
            name = close.lower()
            if name in BLOCK and region != OUT:
                _flush(pieces, found, owner)
            depth[name] = max(0, depth.get(name, 0) - 1)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name and stack[i][2] > depth[name]:
                    region = stack[i][1]
                    del stack[i:]
                    break
        elif name:
            name = name.lower()
            if name in BLOCK and region != OUT:
                _flush(pieces, found, owner)
            if name in VOID or attributes.endswith("/") and name not in BLOCK:
                continue
            # A paragraph ends where a block begins, a list item where the next one does.
            if stack and (stack[-1][0] == "p" and name in BLOCK or stack[-1][0] == name == "li"):
                region = stack.pop()[1]
            depth[name] = depth.get(name, 0) + 1
            told = _attributes(attributes)
            out = _is_out(name, told, region == ARTICLE)
            if name in MARKED and not out and region == OUT and stack and stack[-1][0] in ("nav", "header", "head", "ul"):
                region = stack[-1][1]
                stack.pop()
            if out and region != OUT:
                stack.append((name, region, depth[name]))
                region = OUT
            elif region == OPEN and (name in MARKED or "main" in told.get("role", "").lower().split()):
                stack.append((name, region, depth[name]))
                region = ARTICLE
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])|\Z", re.IGNORECASE).search(data, at)
                at = end.start()
    _flush(pieces, found, owner)
    return found


def text_lines(html: str | None) -> tuple[bool, list[str]]:
    """Whether the page marks its article, and the lines of it or else of all open parts."""
    cut = blocks(html)
    marked = [t for r, t in cut if r == ARTICLE]
    return (True, marked) if marked else (False, [t for r, t in cut if r == OPEN])


def common(left: list[int], right: list[int]) -> set[int]:
    """Places in ``left`` of a longest common subsequence with ``right``.

    Equal ends are taken first; the middle is solved over the places where lines match."""
    head = 0
    while head < min(len(left), len(right)) and left[head] == right[head]:
        head += 1
    tail = 0
    while tail < min(len(left), len(right)) - head and left[-1 - tail] == right[-1 - tail]:
        tail += 1
    found = {*range(head), *range(len(left) - tail, len(left))}
    places: dict[int, list[int]] = {}
    for j in range(head, len(right) - tail):
        places.setdefault(right[j], []).append(j)
    tops: list[int] = []
    ends: list[tuple] = []
    for i in range(head, len(left) - tail):
        for j in reversed(places.get(left[i], ())):
            k = bisect_left(tops, j)
            link = (i, ends[k - 1] if k else None)
            if k == len(tops):
                tops.append(j)
                ends.append(link)
            else:
                tops[k], ends[k] = j, link
    link = ends[-1] if ends else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def address(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL for the order of pages: digits padded, so /9 comes before /10."""
    try:
        parts = urlsplit(url or "")
        host, path = (parts.hostname or "").lower(), parts.path
    except ValueError:
        host, path = "", url or ""
    return host, re.sub(r"\d+", lambda m: m[0].zfill(12), path.rstrip("/"))


OUTLINE = "page_id long, print long, host string, path string, marked boolean, lines array<long>"


def _line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def _rows(pages: DataFrame) -> DataFrame:
    """page_id, url, html and a hash of the html, which tells rows of one page_id apart."""
    html = whole("html")
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"), F.xxhash64(html).alias("print"))


def outlines(pages: DataFrame) -> DataFrame:
    """Per page its address and the hashes of its lines: those of its text if the page has no
    marked article, else of every block, against which its neighbours are held."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int64())]
        names = ["page_id", "print", "host", "path", "marked", "lines"]
        for batch in batches:
            rows = []
            for page_id, url, html, mark in zip(*batch.columns):
                found = blocks(html.as_py())
                marked = any(r == ARTICLE for r, _ in found)
                own = [_line_hash(t) for r, t in found if marked or r == OPEN]
                rows.append((page_id.as_py(), mark.as_py(), *address(url.as_py()), marked, own))
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return _rows(pages).mapInArrow(cut, OUTLINE)


def distinct_lists(outline: DataFrame) -> DataFrame:
    """One row per host and list of lines, at the first place where it stands: copies of a page meet the
    nearest page that differs, all of them the same. ``marked`` if all its pages are."""
    return outline.groupBy("host", "lines").agg(
        F.min(F.struct("path", "page_id", "print")).alias("at"), F.bool_and("marked").alias("marked")
    ).select("host", "lines", "at.*", "marked")


def neighbours(outline: DataFrame) -> DataFrame:
    """Lists of pages without a marked article with those before and after in order of (host, path).

    The order is cut into ranges, so a host of any size is spread over tasks; the first and last
    page of a range meet those of the ranges beside it over a table of one row per range."""
    order = ["host", "path", "page_id", "print"]
    ranged = outline.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    ranged = kept(ranged, "page-order")
    side = F.struct("host", "path", "lines")
    inside = Window.partitionBy("part").orderBy(*order)
    met = ranged.select("*", F.lag(side).over(inside).alias("before"), F.lead(side).over(inside).alias("after"))
    ends = ranged.groupBy("part").agg(
        F.min_by(side, F.struct(*order)).alias("first"), F.max_by(side, F.struct(*order)).alias("last")
    )
    parts = Window.orderBy("part")
    ends = ends.select("part", F.lag("last").over(parts).alias("last_before"), F.lead("first").over(parts).alias("first_after"))
    joined = met.filter("not marked").join(ends, "part", "left")
    return joined.select(
        "host", "path", "lines",
        F.coalesce("before", "last_before").alias("before"), F.coalesce("after", "first_after").alias("after"),
    )


def _near(path: str, other: str) -> int:
    """Length of the common beginning."""
    n = 0
    for a, b in zip(path, other):
        if a != b:
            break
        n += 1
    return n


def shared_lines(pairs: DataFrame) -> DataFrame:
    """(host, lines, drops): places of the lines to delete, for lists that lose any.

    The nearer of both neighbours of the host is taken, the one before if both are as near. A
    page keeps its lines if its neighbour has them all."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, path, lines, before, after in zip(*[c.to_pylist() for c in batch.columns]):
                beside = [n for n in (before, after) if n is not None and n["host"] == host]
                if not beside or not lines:
                    continue
                other = max(beside, key=lambda n: _near(path, n["path"]))
                drops = common(lines, other["lines"])
                if drops and len(drops) < len(lines):
                    rows.append((host, lines, sorted(drops)))
            columns = list(zip(*rows)) or [[]] * 3
            types = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["host", "lines", "drops"])

    return pairs.mapInArrow(align, "host string, lines array<long>, drops array<int>")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the main text, its blocks joined by line ends.

    One row per input row. A null or empty html has the text "". A null url belongs to the host
    "" and a page alone on its host keeps all its open lines. Rows that repeat a page_id are
    told apart by their html, exact repeats have equal results. An empty table gives no rows.
    Other columns are not read."""
    outline = kept(outlines(pages), "page-outlines")
    of_lists = shared_lines(neighbours(distinct_lists(outline)))
    of_pages = outline.filter("not marked").join(of_lists, ["host", "lines"])
    drops = kept(of_pages.groupBy("page_id", "print").agg(F.min("drops").alias("drops")), "page-drops")
    if drops.count() <= 20_000:
        drops = F.broadcast(drops)
    rows = _rows(pages)
    schema = "page_id long, url string, text string, n_chars long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            found = []
            for page_id, url, html, dropped in zip(*batch.columns):
                marked, lines = text_lines(html.as_py())
                if not marked and dropped.is_valid:
                    gone = set(dropped.as_py())
                    lines = [t for i, t in enumerate(lines) if i not in gone]
                text = "\n".join(lines)
                found.append((page_id.as_py(), url.as_py(), text, len(text)))
            columns = list(zip(*found)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["page_id", "url", "text", "n_chars"]
            )

    marks = drops.select(F.col("page_id").alias("__id"), F.col("print").alias("__print"), "drops")
    same = rows["page_id"].eqNullSafe(F.col("__id")) & (rows["print"] == F.col("__print"))
    return rows.join(marks, same, "left").select("page_id", "url", "html", "drops").mapInArrow(cut, schema)
