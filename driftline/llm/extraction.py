"""Main text of web pages: page structure, and differences from the page with the nearest URL."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stages, ship, slices, whole_text
from .url_filter import host_and_path

ship(__name__)

# -- page structure -------------------------------------------------------------------

#: Elements by what they mean for the text.
RAW = frozenset("script style noscript template svg iframe object canvas textarea title".split())
ASIDE = frozenset("nav footer aside form dialog menu head select button fieldset".split())
CONTENT = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
    "menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Words of class, id and role that mark what is not main text.
HINTS = re.compile(
    r"(?:^|[\s_\"'-])(?:ads?|advert\w*|banner|menu|nav\w*|sidebar|footer|masthead|cookies?|consent|"
    r"notice|notification|popup|modal|newsletter|subscribe|signup|share|social|related|promo\w*|"
    r"sponsor\w*|comments?|repl(?:y|ies)|breadcrumbs?|pagination|contentinfo|complementary|search|"
    r"alert)(?=$|[\s_\"'-])",
    re.IGNORECASE,
)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none", re.IGNORECASE)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: The rest of a tag; nothing is tried twice, so it takes one look at every sign.
_REST = re.compile(r"""((?:[^>"']|"[^"]*"|'[^']*')*+)>""")

MAIN, OPEN, SIDE = 2, 1, 0


def page_lines(page: str) -> list[tuple[str, int]]:
    """(line, kind) of every block with text, in page order.

    MAIN lines are inside the page's article, SIDE lines inside what structure or names mark as
    menus, notices and the like, OPEN lines in neither. The time grows with the length of the
    page: after a tag whose quotes never end, quotes mean nothing any more, and closing tags of
    names that are not open are passed over without a look at what is.
    """
    lines: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []
    opened: Counter[str] = Counter()
    sides = mains = 0
    quotes = True

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            lines.append((text, SIDE if sides else MAIN if mains else OPEN))

    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        if start < 0:
            held.append(page[at:])
            break
        held.append(page[at:start])
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            at = close + 3 if close >= 0 else end
            continue
        tag = _NAME.match(page, start)
        if tag is None and page[start + 1 : start + 2] not in ("!", "?"):
            held.append("<")
            at = start + 1
            continue
        rest = _REST.match(page, tag.end()) if tag and quotes else None
        if rest is None:
            quotes = quotes and tag is None
            close = page.find(">", tag.end() if tag else start)
            if close < 0:
                held.append(page[start:])
                break
        marks = rest[1] if rest else page[tag.end() if tag else start : close]
        at = rest.end() if rest else close + 1
        if tag is None:
            continue
        name = tag[2].lower()
        if name in BLOCK:
            flush()
        if tag[1]:
            if not opened[name]:
                continue
            flush()
            closed = None
            while closed != name:
                closed, side, main = stack.pop()
                opened[closed] -= 1
                sides -= side
                mains -= main
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        if name in BLOCK and stack and stack[-1][0] in ("p", "li") and (
            stack[-1][0] == "p" or name == "li"
        ):
            closed, side, main = stack.pop()
            opened[closed] -= 1
            sides -= side
            mains -= main
        if name in VOID:
            continue
        side = name in ASIDE or (name == "header" and not mains)
        if marks and not side and name not in ("html", "body"):
            side = any(HINTS.search(m) for m in _MARKED.findall(marks)) or bool(
                _HIDDEN.search(marks)
            )
        if side or name in BLOCK:
            if side:
                flush()
            stack.append((name, side, name in CONTENT))
            opened[name] += 1
            sides += side
            mains += name in CONTENT
    flush()
    return lines


def line_hashes(lines: list[tuple[str, int]]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(text) for text, _ in lines], np.uint64).view(np.int64)


# -- differences ----------------------------------------------------------------------


def common_positions(one: list[int], two: list[int]) -> list[int]:
    """Positions in ``one`` of a longest common subsequence with ``two``.

    Rows of the usual table are kept as bits of whole numbers, so a row costs the length of
    ``two`` divided by the word size; lines that only one page has are left out beforehand.
    """
    both = set(one) & set(two)
    left = [i for i, line in enumerate(one) if line in both]
    right = [line for line in two if line in both]
    if not left:
        return []
    where: dict[int, int] = {}
    for j, line in enumerate(right):
        where[line] = where.get(line, 0) | (1 << j)
    full = (1 << len(right)) - 1
    row, rows = full, [full]
    for i in left:
        hit = row & where[one[i]]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    # a zero bit j of row i: the common length grows at column j
    found, j = [], len(right) - 1
    for i in range(len(left), 0, -1):
        while j >= 0 and (rows[i] >> j) & 1:
            j -= 1
        if j < 0:
            break
        if (rows[i - 1] >> j) & 1:
            found.append(left[i - 1])
            j -= 1
    return found[::-1]


def nearer(path: str, before: str | None, after: str | None) -> int:
    """-1 if the path before has the longer common beginning (or as long), 1 if that after has,
    0 if there is neither."""

    def shared(other: str | None) -> int:
        if other is None:
            return -1
        n = 0
        for a, b in zip(path, other):
            if a != b:
                break
            n += 1
        return n

    if before is None and after is None:
        return 0
    return -1 if shared(before) >= shared(after) else 1


def neighbours(stages: Stages, pages: DataFrame) -> DataFrame:
    """Each row (host, path, content, lines, open) with the rows before and after it of its host.

    Rows are dealt by ranges of (host, path), so a host that most pages have is many ranges; the
    ranges' first and last rows are handed on, so the result does not depend on the ranges.
    """
    order = ["host", "path", "content"]
    placed = stages.put(
        pages.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges"
    )
    me = F.struct("host", "path", "lines")
    inside = W.partitionBy("part").orderBy(*order)
    rows = placed.withColumn("before", F.lag(me).over(inside)).withColumn(
        "after", F.lead(me).over(inside)
    )
    ends = placed.groupBy("part").agg(
        F.min_by(me, F.struct(*order)).alias("first"), F.max_by(me, F.struct(*order)).alias("last")
    )
    across = W.orderBy("part")
    ends = ends.select(
        "part", F.lag("last").over(across).alias("last"), F.lead("first").over(across).alias("first")
    )
    rows = rows.join(ends, "part")
    same = lambda c: F.when(c["host"] == F.col("host"), c)
    return rows.select(
        "host",
        "path",
        "content",
        "lines",
        "open",
        same(F.coalesce("before", "last")).alias("before"),
        same(F.coalesce("after", "first")).alias("after"),
    )


def deleted_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, content, deleted): positions of open lines that the nearest page shares."""
    for batch in slices(batches):
        found = []
        for row in batch.to_pylist():
            side = nearer(row["path"], *(row[k] and row[k]["path"] for k in ("before", "after")))
            if side:
                other = row["before"] if side < 0 else row["after"]
                shared = common_positions(row["lines"], other["lines"])
                gone = sorted(set(shared) & set(row["open"]))
                if gone:
                    found.append((row["host"], row["content"], gone))
        hosts, contents, gone = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hosts, pa.string()),
                pa.array(contents, pa.int64()),
                pa.array(gone, pa.list_(pa.int32())),
            ],
            names=["host", "content", "deleted"],
        )


def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, content, lines, open) of pages: hashes of all lines, positions of open ones."""
    for batch in slices(batches):
        lines, open_lines = [], []
        for page in batch.column(3).to_pylist():
            found = page_lines(page)
            lines.append(line_hashes(found).tolist())
            kept_apart = any(kind == MAIN for _, kind in found)
            open_lines.append(
                [] if kept_apart else [i for i, (_, kind) in enumerate(found) if kind == OPEN]
            )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                batch.column(2),
                pa.array(lines, pa.list_(pa.int64())),
                pa.array(open_lines, pa.list_(pa.int32())),
            ],
            names=["host", "path", "content", "lines", "open"],
        )


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    stages: Stages | None = None,
) -> DataFrame:
    """One row per page: id, url, text.

    Pages are read into lines (blocks). In every host, pages are paired with the one whose URL
    path is nearest, their line sequences aligned by longest common subsequence, and lines that
    both have are deleted, but for those inside an ``article`` or ``main`` element: passages of
    an article recur on other pages. Lines inside menus, headers, footers, sidebars, notices,
    adverts, forms and comments never stay. If a page has an article, its lines are the text;
    else all lines that are left.

    Copies of a page on one host count once and are no neighbours of each other. A page alone on
    its host is judged by structure only; pages whose url is null or has no host are one host
    named by the empty text. Null html is empty and gives the empty text, as do pages without
    text. Repeated rows are extracted each; an empty table gives no rows. Other columns are not
    read. Html and lines travel only for the pages that lose lines.
    """
    stages = stages or Stages(pages.sparkSession)
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    page = whole_text(html_col)
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        page.alias("html"),
        host.alias("host"),
        path.alias("path"),
        F.xxhash64(page).alias("content"),
    )
    narrow = rows.select("host", "path", "content", "html").mapInArrow(
        sequences,
        "host string, path string, content long, lines array<bigint>, open array<int>",
    )
    single = narrow.groupBy("host", "content").agg(
        F.min("path").alias("path"), F.first("lines").alias("lines"), F.first("open").alias("open")
    )
    gone = neighbours(stages, single).mapInArrow(
        deleted_lines, "host string, content long, deleted array<int>"
    )
    gone = stages.put(gone, "deleted-lines")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for source, deleted in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                lines = page_lines(source)
                main = [text for text, kind in lines if kind == MAIN]
                if not main:
                    lost = set(deleted or ())
                    main = [t for i, (t, kind) in enumerate(lines) if kind == OPEN and i not in lost]
                found.append("\n".join(main))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string())],
                names=["id", "url", "text"],
            )

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "url")}
    with_deleted = rows.join(gone, ["host", "content"], "left")
    return (
        with_deleted.select("id", "url", "html", "deleted")
        .mapInArrow(texts, f"id {kinds['id']}, url {kinds['url']}, text string")
        .withColumnsRenamed({"id": id_col, "url": url_col})
    )
