"""Main text of web pages by differencing each with the page whose URL is nearest.

Pages are split into lines (the text of one block each). Within a host, pages
are ordered by URL path; each is paired with the neighbour whose path has the
longest common beginning, their lines are aligned by longest common
subsequence, and the shared ones are taken for the site's template and deleted.
Two rules of markup go with that. Lines inside elements that are never main
text (navigation, headers, footers, asides, forms, adverts, notices, comments)
go whether shared or not. And if a page names its main content (``article`` or
``main``), just the lines in it stay, shared or not: a copied article is no
template. Such pages are neighbours of others, but aren't compared themselves,
as no result could depend on it.

The order is found on lean rows (host, path and a hash of the lines), dealt out
by range, so that a host of any size is split; what a range needs to know of
the pages beyond its ends is a page or two, worked out from one row for each
range. Only pages that are to be compared fetch the lines of their neighbour.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, sliced
from .reputation import host_and_path

#: Pages of a range that are ordered together, about; results don't depend on it.
GROUP = 50_000
#: What pages are paired within.
UNITS = {"host": ["host"], "folder": ["host", "folder"]}

# Elements and names by their role.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg", "head", "object", "audio", "video", "canvas", "fieldset", "option", "datalist"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CLOSED_BY = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select", "datalist"}}
NAMES = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "sidebar", "comment", "comments", "commentlist", "disqus", "replies", "reply", "respond", "menu", "navbar", "nav", "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "toolbar", "related", "share", "sharing", "social", "widget", "login", "search", "pagination", "pager"}
STEMS = ("advert", "sponsor", "cookie", "comments", "sidebar", "newsletter", "breadcrumb", "navig", "subscri", "notific", "popup")
#: Names that mean a page's head outside of an article, and the article's own title in it.
TITLES = {"header", "masthead"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}

TAG = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|(/?)([A-Za-z][^\s/>]*)([^>]*)>|[!?][^>]*>|/?[A-Za-z][^>]*\Z)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|(?<![-\w])hidden(?![-\w=])""", re.IGNORECASE)
SPACE = re.compile(r"\s+")
MAIN, OTHER, CHROME = 0, 1, 2


def _names_chrome(value: str, in_article: bool) -> bool:
    parts = (p.rstrip("0123456789") for word in value.split() for p in re.split(r"[-_:]+|(?<=[a-z])(?=[A-Z])", word))
    return any(p in NAMES and not (in_article and p in TITLES) or p.startswith(STEMS) for p in map(str.lower, parts))


def _is_chrome(name: str, attributes: str, in_article: bool) -> bool:
    if name in DROPPED and not (in_article and name in TITLES):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        if not m[1]:
            return True
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "role":
            if value.strip().lower() in ROLES:
                return True
        elif kind == "style":
            if "display:none" in value.replace(" ", "").lower():
                return True
        elif _names_chrome(value, in_article):
            return True
    return False


def lines_of(page: str) -> list[tuple[str, int]]:
    """(text, zone) of each block that has text, in page order.

    Markup may be broken: elements left open end with the page or with an
    element around them, stray end tags are passed over, and a tag cut off by
    the end of the page is dropped.
    """
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, bool, bool]] = []  # name, is chrome, is main
    text: list[str] = []
    chrome = main = 0

    def flush():
        if text:
            line = SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if line:
                out.append((line, CHROME if chrome else MAIN if main else OTHER))

    def close(to: int):
        nonlocal chrome, main
        while len(stack) > to:
            _, c, m = stack.pop()
            chrome -= c
            main -= m

    at, n = 0, len(page)
    while at < n:
        found = TAG.search(page, at)
        if not found:
            text.append(page[at:])
            break
        if found.start() > at:
            text.append(page[at : found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            if name in BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if any(c or m or n in BLOCK for n, c, m in stack[k:]):
                        flush()
                    close(k)
                    break
                if name not in BLOCK and stack[k][0] in BLOCK:
                    break
            continue
        attributes = found[3] or found[6] or ""
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = end.start() if end else n
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCK:
            flush()
            for k in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        if name in CLOSED_BY:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name or (name, stack[k][0]) in (("dt", "dd"), ("dd", "dt"), ("td", "th"), ("th", "td")):
                    close(k)
                    break
                if stack[k][0] in CLOSED_BY[name]:
                    break
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        is_chrome = _is_chrome(name, attributes, main > 0)
        is_main = name in ("article", "main") or "role" in attributes and re.search(r"""role\s*=\s*["']?main\b""", attributes) is not None
        if is_chrome and name not in BLOCK:
            flush()
        stack.append((name, is_chrome, is_main))
        chrome += is_chrome
        main += is_main
    flush()
    return out


def shared(a: list[int], b: list[int]) -> list[bool]:
    """Which of ``a`` are in a longest common subsequence with ``b``; whole rows of bits at a time."""
    where: dict[int, int] = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows, v = [], full
    for x in a:
        hit = v & where.get(x, 0)
        v = ((v + hit) | (v - hit)) & full
        rows.append(v)
    out, j = [False] * len(a), len(b)
    # Zero bits of row i below j count the common subsequence of a[:i + 1] and b[:j].
    length = lambda i, j: j - (rows[i] & ((1 << j) - 1)).bit_count() if i >= 0 else 0
    i = len(a) - 1
    while i >= 0 and j > 0:
        now = length(i, j)
        if not now:
            break
        if length(i - 1, j) == now:
            i -= 1
        elif length(i, j - 1) == now:
            j -= 1
        else:
            out[i] = True
            i, j = i - 1, j - 1
    return out


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def main_lines(lines: list[str], zones: list[int], keys: list[int], neighbours: list[list[int]]) -> list[str]:
    """What stays of a page next to its neighbour.

    ``neighbours``: the keys of the lines of nearby pages, nearest first. The
    nearest that isn't the same page line for line is the one to compare with.
    """
    has_main = MAIN in zones
    other = None if has_main else next((k for k in neighbours if k and k != keys), None)
    gone = shared(keys, other) if other else [False] * len(keys)
    return [x for x, zone, deleted in zip(lines, zones, gone, strict=True) if zone == MAIN or not has_main and zone == OTHER and not deleted]


# Neighbours in the order of URLs.

LEAN = ["unit", "path", "page", "key", "open"]


def _rows(batches) -> list[tuple]:
    return [r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(b.num_columns)), strict=True)]


def _firsts_of_runs(rows: list[tuple]) -> list[int]:
    """Where runs of pages that are the same line for line begin."""
    return [i for i, r in enumerate(rows) if not i or (r[0], r[2]) != (rows[i - 1][0], rows[i - 1][2])]


def _ends(batches):
    """One row for a range: its first and last page, and the pages next to the first and to the last run of equal ones."""
    rows = _rows(batches)
    if not rows:
        return
    runs = _firsts_of_runs(rows)
    of = lambda r: {"unit": r[0], "path": r[1], "page": r[2], "key": r[3]}
    inner = [of(rows[runs[1]]), of(rows[runs[-1] - 1])] if len(runs) > 1 else [None, None]
    page = pa.struct([("unit", pa.string()), ("path", pa.string()), ("page", pa.int64()), ("key", pa.int64())])
    yield pa.RecordBatch.from_arrays([pa.array([rows[0][5]], pa.int32()), *(pa.array([x], page) for x in (of(rows[0]), of(rows[-1]), *inner))], ["range", "first", "last", "second", "last_but_one"])


END = "struct<unit:string,path:string,page:bigint,key:bigint>"


def _beyond(ends: list, forward: bool) -> dict[int, tuple | None]:
    """For each range the (unit, path, key) of the page before it (or after it) that differs from its first (last) run."""
    out: dict[int, tuple | None] = {}
    last = other = None  # the nearest page so far, and the page beyond the run that this one is in
    plain = lambda p: (p.unit, p.path, p.key)
    for e in sorted(ends, key=lambda e: e.range, reverse=not forward):
        near, far, inner = (e.first, e.last, e.last_but_one) if forward else (e.last, e.first, e.second)
        if last is not None and (last.unit, last.page) == (near.unit, near.page):
            beyond = other
        else:
            beyond = plain(last) if last is not None else None
        out[e.range] = beyond
        last, other = far, plain(inner) if inner is not None else beyond
    return out


def partners(lean: DataFrame, group: int = GROUP) -> DataFrame:
    """``(key, partner)`` of the open pages among ``lean(unit, path, page, key, open, order...)``.

    The partner is the nearest page of the same unit, before or after, that
    isn't the same line for line: that with the longer common beginning of the
    path, of equals the one before. Pages without one have no row.
    """
    spark = lean.sparkSession
    order = [c for c in lean.columns if c not in ("key", "open")]
    ranges = max(1, -(-lean.count() // group))
    dealt = lean.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = cut(dealt.select(*LEAN, F.spark_partition_id().alias("range")))
    ends = dealt.mapInArrow(_ends, f"range int, first {END}, last {END}, second {END}, last_but_one {END}").collect()
    # A few numbers and two paths for each range.
    around = spark.sparkContext.broadcast((_beyond(ends, True), _beyond(ends, False)))

    def choose(batches):
        rows = _rows(batches)
        if not rows:
            return
        here, keys, chosen = rows[0][5], [], []
        runs = [*_firsts_of_runs(rows), len(rows)]
        plain = lambda r: (r[0], r[1], r[3])
        for a, b in zip(runs, runs[1:], strict=False):
            before = plain(rows[a - 1]) if a else around.value[0].get(here)
            after = plain(rows[b]) if b < len(rows) else around.value[1].get(here)
            for unit, path, _, key, is_open, _ in rows[a:b] if any(r[4] for r in rows[a:b]) else ():
                near = [p for p in (before, after) if p is not None and p[0] == unit]
                if is_open and near:
                    keys.append(key)
                    chosen.append(max(near, key=lambda p: _common(path, p[1]))[2])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(chosen, pa.int64())], ["key", "partner"])

    return dealt.mapInArrow(choose, "key long, partner long")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group: int = GROUP, within: str = "folder") -> DataFrame:
    """``(id, url, text)`` of every row: the main text, blocks joined by one space.

    Pages are paired ``within`` a host, or within a folder of it. Null html
    counts as empty and gives the empty string. A page without a
    neighbour, or with none but copies of itself, is compared with nothing and
    keeps what markup leaves. Order within a host is by path,
    url, id and lines, so ties and repeated rows are settled; pages with null
    urls form one host. Pages without text are nobody's neighbour. Very long
    pages are aligned whole. Other columns play no part; an empty table gives
    no rows.
    """
    host, path = host_and_path(F.col(url_col))
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    fields = [T.StructField("id", pages.schema[id_col].dataType), *(T.StructField(c, T.StringType()) for c in ("url", "host", "path")), T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("zones", T.ArrayType(T.IntegerType()))]

    def parse(batches):
        for batch in sliced(batches, 256):
            made = [lines_of(h or "") for h in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([[x for x, _ in m] for m in made], pa.list_(pa.string())), pa.array([[z for _, z in m] for m in made], pa.list_(pa.int32()))], [f.name for f in fields])

    parsed = source.mapInArrow(parse, T.StructType(fields)).withColumn("folder", F.regexp_extract("path", r"(?s)\A(.*/)", 1)).withColumn("keys", F.transform("lines", lambda x: F.xxhash64(x)))
    parsed = parsed.withColumn("page", F.xxhash64("keys")).withColumn("key", F.xxhash64("host", "path", F.coalesce("url", F.lit("\0")), F.coalesce(F.col("id").cast("string"), F.lit("\0")), "page"))
    is_open = F.array_contains("zones", OTHER) & ~F.array_contains("zones", MAIN)
    unit = F.concat_ws("\0", *UNITS[within])
    # Rows that are the same in all that counts are one page here.
    lean = cut(parsed.where(F.size("keys") > 0).select(unit.alias("unit"), "path", "url", "id", "page", "key", is_open.alias("open")).distinct())
    if lean.where("open").limit(1).count():
        pairs = cut(partners(lean.select("unit", "path", "url", "id", "page", "key", "open"), group))
        others = parsed.select("key", "keys").join(pairs.select(F.col("partner").alias("key")).distinct(), "key", "left_semi").dropDuplicates(["key"])
        near = pairs.join(others.select(F.col("key").alias("partner"), F.col("keys").alias("other")), "partner").select("key", "other")
        paired = parsed.join(near, "key", "left")
    else:
        paired = parsed.withColumn("other", F.lit(None).cast("array<long>"))

    def compare(batches):
        for batch in sliced(batches, 256):
            columns = (batch.column(k).to_pylist() for k in range(2, 6))
            out = [" ".join(main_lines(lines, zones, keys, [other] if other else [])) for lines, zones, keys, other in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["id", "url", "text"])

    done = paired.select("id", "url", "lines", "zones", "keys", "other").mapInArrow(compare, T.StructType([fields[0], fields[1], T.StructField("text", T.StringType())]))
    return done.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
