"""Main text of web pages by differencing with the nearest pages of the host.

Pages are ordered by host and URL path; a page is compared with the one before
and the one after it there. Text lines are aligned by longest common
subsequence, and lines that a page shares with each neighbour are template.
Where a page has no article element they go. Where it has one, template runs
go that lead from outside into the article: a share bar, a byline strip or a
sign-up blurb that the frame of the site continues with. Template lines with
the article's own lines on both sides are text that articles quote alike, and
stay; so does all of an article whose copy lies next door, since a neighbour
that shares half of the article's lines says nothing about the template.

The mark-up corrects what a difference cannot see: lines inside menus, headers,
footers, sidebars, notices, adverts, forms and comments go although no
neighbour has them.

The order is laid out as blocks of neighbouring pages, of some size in bytes;
each block also gets the page before it and the page after it, so a host of
any size is shared out and every page meets its neighbours. Texts move once.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from html import unescape
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewatt.llm.common import pick
from statewatt.operators.ordering import with_position

#: Bytes of html in a block, on average, and blocks at most; a block is read in
#: order and never held, so beyond that many they grow.
BLOCK_BYTES, BLOCKS = 16 << 20, 100_000
#: Bits of alignment rows that are held at once.
ALIGN_BITS = 1 << 28

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template svg canvas".split())
#: Of these, what takes the rest of a page if it is never closed.
ENDLESS_TAGS = frozenset("script style textarea title".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog button select head".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup login sidebar aside comment comments disqus replies respond nav navbar navigation menu topmenu breadcrumb breadcrumbs "
    "footer header masthead topbar related recommended share sharing social widget widgets toolbar pagination pager skip copyright disclaimer".split()
)
#: What may stand beside such a name in one that is wholly furniture, as in ad-slot.
NEUTRAL_NAMES = frozenset("area article articles bar block box button buttons container content entry form group inner item items label links list outer page panel post posts reader readers section site slot top unit user wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/><]*)[^><]*\Z|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")

ARTICLE, FURNITURE = 1, 2


def _named(word: str, inside: bool) -> bool:
    """Whether a class or id names furniture: by its first or last part, and
    inside an article as a whole, so that ``related-work`` does not."""
    parts = _NAME.findall(word)
    if not inside:
        return bool(FURNITURE_NAMES.intersection(parts[:1] + parts[-1:]))
    own = FURNITURE_NAMES.intersection(parts) - {"header"}
    return bool(own) and own | NEUTRAL_NAMES >= set(parts)


def _furniture(tag: str, attributes: str, inside: bool) -> bool:
    if tag in FURNITURE_TAGS or tag == "header" and not inside:
        return True
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value.strip() in FURNITURE_ROLES:
            return True
        if name in ("class", "id") and not (inside and tag in HEADINGS) and any(_named(word, inside) for word in value.split()):
            return True
    return False


def text_lines(html: str | None) -> tuple[list[str], list[int]]:
    """The text of each block, white space made one space, with its marks:
    ``ARTICLE`` inside an article or main element, ``FURNITURE`` inside an
    element that is not main text. Scripts, styles and the head leave none."""
    html = html or ""
    lines: list[str] = []
    marks: list[int] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    mark = 0

    def flush() -> None:
        if held:
            line = " ".join(unescape("".join(held)).split())
            held.clear()
            if line:
                lines.append(line)
                marks.append(mark)

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.match(html, at)
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            if not m[0].startswith(("<!", "<?")):
                held.append(m[0])
            continue
        tag, ends = tag.lower(), bool(m[1] or m[4])
        block = tag in BLOCK_TAGS
        if tag == "br":
            held.append(" ")
            continue
        if not ends and tag in RAW_TAGS:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
            if tag in ENDLESS_TAGS:
                at = close.end() if close else size
            elif close and not (m[3] or "").rstrip().endswith("/"):
                at = close.end()
            continue
        if block:
            flush()
        if ends:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if stack[k][1] != mark:
                        flush()
                    mark = stack[k][1]
                    del stack[k:]
                    break
                if tag not in BLOCK_TAGS and stack[k][0] in BLOCK_TAGS:
                    break
            continue
        if tag in VOID_TAGS:
            continue
        if tag == "p" or tag == "li":  # an open one of its kind ends here
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    mark = stack[k][1]
                    del stack[k:]
                    break
                if stack[k][0] in BLOCK_TAGS and stack[k][0] != "p":
                    break
        new = mark | (ARTICLE if tag in ("article", "main") else 0)
        if _furniture(tag, m[3] or "", bool(new & ARTICLE)):
            new |= FURNITURE
        if new != mark:
            flush()
        stack.append((tag, mark))
        mark = new
    flush()
    return lines, marks


def shared_lines(a: list[str], b: list[str], bits: int = ALIGN_BITS) -> np.ndarray:
    """Which lines of ``a`` a longest common subsequence with ``b`` holds.

    Alignment rows are bit vectors, one long integer a line; where they would
    take more than ``bits`` the task is halved at an optimal point.
    """
    out = np.zeros(len(a), bool)
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    out[:start] = True
    out[len(a) - end :] = True
    x, y = a[start : len(a) - end], b[start : len(b) - end]
    if not x or not y or not set(x) & set(y):
        return out
    if len(x) > 1 and len(x) * len(y) > bits:
        half = len(x) // 2
        ahead = _lengths(x[:half], y)
        behind = _lengths(x[half:][::-1], y[::-1])[::-1]
        at = int(np.argmax(ahead + behind))
        out[start : start + half] = shared_lines(x[:half], y[:at], bits)
        out[start + half : len(a) - end] = shared_lines(x[half:], y[at:], bits)
        return out
    rows = _rows(x, y)
    i, j = len(x), len(y)
    while i and j:
        # a zero bit j - 1 in row i: the subsequence grows by y[j - 1]
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            out[start + i - 1] = True
            i, j = i - 1, j - 1
    return out


def _rows(x: list[str], y: list[str], keep: bool = True) -> list[int]:
    """Bit-parallel alignment: row i has a zero at every j where the longest
    common subsequence of x[:i] and y[:j + 1] is longer than that of y[:j]."""
    full = (1 << len(y)) - 1
    places: dict[str, int] = {}
    for j, line in enumerate(y):
        places[line] = places.get(line, 0) | 1 << j
    row, rows = full, [full]
    for line in x:
        if hit := places.get(line, 0):
            both = row & hit
            row = ((row + both) | (row - both)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _lengths(x: list[str], y: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequence of x and each y[:j]."""
    row = _rows(x, y, keep=False)[0]
    raw = np.frombuffer(row.to_bytes((len(y) + 7) // 8, "little"), np.uint8)
    zeros = 1 - np.unpackbits(raw, bitorder="little")[: len(y)].astype(np.int64)
    return np.r_[0, np.cumsum(zeros)]


def main_text(lines: list[str], marks: list[int], neighbours: list[list[str]]) -> str:
    """What differencing leaves, corrected by the mark-up.

    Without an article, lines stay that some neighbour lacks; all do if there is
    no neighbour or none would stay. With one, its lines stay but for template
    runs that reach into it from outside; neighbours that share half of its lines
    or more are copies and not asked. Furniture never stays.
    """
    own = np.array([not m & FURNITURE for m in marks], bool)
    article = own & np.array([m & ARTICLE > 0 for m in marks], bool)
    shared = [shared_lines(lines, other) for other in neighbours]
    if article.any():
        shared = [s for s in shared if 2 * (s & article).sum() < article.sum()]
        own = article
    template = np.logical_and.reduce(shared) if shared else np.zeros(len(lines), bool)
    if article.any():
        run = np.cumsum(~template)  # lines of one template run share a number
        framed = np.isin(run, run[template & ~article])
        template &= framed
    chosen = np.flatnonzero(own & ~template)
    if not len(chosen):
        chosen = np.flatnonzero(own)
    return "\n\n".join(lines[i] for i in chosen)


_URL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text), one row per row of ``pages``.

    Text blocks are joined by two line feeds; a page without any has an empty
    text, so has a null one. Pages with a null or odd URL form a host of their
    own. Rows alike in host, path and id are ordered by a hash of their html;
    rows alike in that too are each other's neighbours, and where they fill more
    than one block are dealt over those in turn.
    """
    few = pick(pages, id_col, url_col, html_col).toDF("page_id", "url", "html")
    kind = few.schema["page_id"].dataType
    spark = few.sparkSession
    host, path = (F.coalesce(F.regexp_extract("url", _URL, i), F.lit("")) for i in (1, 2))
    few = few.select("page_id", "url", "html", F.lower(host).alias("host"), path.alias("path"), F.xxhash64("html").alias("tie"), F.octet_length("html").alias("bytes"))
    key = ["host", "path", "page_id", "tie"]
    rows = with_position(few.select(*key, "bytes"), key)
    whole = rows.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    blocks = min(BLOCKS, whole["n"], (whole["bytes"] or 0) // BLOCK_BYTES + 2 * spark.sparkContext.defaultParallelism)
    block = F.floor(F.col("position") / max(1, -(-whole["n"] // max(1, blocks)))).cast("long")
    ends = rows.groupBy(block.alias("block")).agg(F.min(F.struct("position", *key)).alias("first"), F.max(F.struct("position", *key)).alias("last"))
    edges = sorted((r["block"], _key(r["first"]), _key(r["last"])) for r in ends.collect())  # a row for each block
    firsts, lasts = [e[1] for e in edges], [e[2] for e in edges]
    few = few.drop("bytes")
    fields = [T.StructField("page_id", kind), *(T.StructField(n, T.StringType()) for n in ("url", "host", "path"))]
    schema = T.StructType([*fields, T.StructField("tie", T.LongType()), T.StructField("block", T.LongType()), T.StructField("guest", T.BooleanType()), T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("marks", T.ArrayType(T.IntegerType()))])

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, turn = None, 0
        for batch in batches:
            out = out or [batch.schema.field(0).type, pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32())]
            found = []
            for page_id, url, html, host, path, tie in zip(*(c.to_pylist() for c in batch.columns)):
                own = _key({"host": host, "path": path, "page_id": page_id, "tie": tie})
                lines, marks = text_lines(html)
                low, high = bisect_left(lasts, own), bisect_right(firsts, own)
                at, turn = low + turn % (high - low), turn + 1
                for to, guest in ((at, False), (at - 1, True), (at + 1, True)):
                    if to < 0 or to >= len(firsts) or guest and own != (firsts[at] if to < at else lasts[at]):
                        continue
                    found.append((page_id, url, host, path, tie, to, guest, lines, marks))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), out)] if found else [pa.array([], k) for k in out], names)

    names = schema.names
    order = ["block", "host", "path", "page_id", "tie", "guest"]
    dealt = few.mapInArrow(parse, schema).repartitionById(max(1, len(edges)), F.col("block").cast("int")).sortWithinPartitions(*order)
    return dealt.mapInArrow(_difference, T.StructType([T.StructField("page_id", kind), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())]))


def _key(r) -> tuple:
    return r["host"], r["path"], r["page_id"] is not None, r["page_id"] or 0, r["tie"]


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _difference(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, out = None, []

    def typed() -> Iterator[dict]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            yield from _rows_of([batch])

    for _, group in groupby(typed(), key=lambda r: (r["block"], r["host"])):
        before, page = None, next(group)
        while page is not None:
            after = next(group, None)
            if not page["guest"]:
                near = [o["lines"] for o in (before, after) if o is not None]
                out.append((page["page_id"], page["url"], main_text(page["lines"], page["marks"], near)))
                if len(out) == 500:
                    yield _texts(out, kind)
                    out = []
            before, page = page, after
    if out:
        yield _texts(out, kind)


def _texts(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (kind, pa.string(), pa.string()))], ["page_id", "url", "text"])
