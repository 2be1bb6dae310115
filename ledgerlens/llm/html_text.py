"""Main text of web pages by differencing with the page of the nearest URL.

A page becomes its text lines (one per block), each with the part of the page it stands in. Pages
of a host are sorted by URL path and compared with the neighbour, among two before and two after, that shares the longest path
prefix. Their lines outside of the parts to leave out are aligned by longest common subsequence, and shared lines are deleted: a
template repeats from page to page, a text does not. A neighbour that shares most of the page's
lines and characters, or four fifths of its characters, is a near copy (a print or ?page= version) and tells nothing; the next is
asked, and without any other nothing is deleted. Two facts about markup are evidence of their own: a line
inside a declared article (``article``, ``main``) stays though it is shared, as pages of one host may
quote the same passage; and lines in a menu, header, footer, sidebar, notice, advert, form or reader
comments (but no wrapper around the article) go even where the neighbour words them differently. All other lines are decided by
the comparison, whether or not the page has an article.

Only line hashes are shuffled to find neighbours: pages are cut into ranges of (host, path), so one
host may hold any share of them. The texts themselves move once, compressed.

A null or empty html gives an empty text, an empty table an empty result. Pages of any length are read whole. Rows that repeat are treated alike. Null urls form a host of
their own. Other columns are not looked at.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved, signed
from ledgerlens.llm.url_filter import with_parts
from ledgerlens.operators import ordered

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)(?:>|\Z)|[^<]++|<", re.S
)
#: attributes one after the other, so that no name is found inside a value
_ATTRIBUTE = re.compile(r"([^\s/>=\"'][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMED = re.compile(r"class|id|role|hidden", re.I)
_MAIN = re.compile(r"\brole\s*=\s*[\"']?main\b", re.I)
_PART = re.compile(r"[-_]+")
_NUMBER = re.compile(r"\d+(?:x\d+)?")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: their content is not text; it ends at the literal closing tag, whatever stands in it
RAW = frozenset("script style noscript template iframe object svg math canvas textarea title select option datalist video audio".split())
_OWN_TAG = {name: re.compile(rf"<(/?){name}(?=[\s/>]|\Z)[^>]*+>?", re.I) for name in RAW}
#: raw elements that may hold one of their own kind
NESTED = frozenset(("object", "svg", "template"))
#: without a closing tag these hold the rest of the page; of the others only the tag is left out
ENDLESS = frozenset(("script", "style"))
#: what a head may hold; anything else ends it
IN_HEAD = frozenset("head html base basefont bgsound link meta noscript script style template title".split())
_HEAD_END = re.compile(r"</head(?=[\s/>])", re.I)
DROPPED = frozenset("nav footer aside form menu dialog".split())
#: whole words of class or id that mark the parts to leave out
MARKS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising gdpr sponsor sponsored promo promotion banner cookie cookies consent notice notices alert sidebar "
    "nav navbar navigation menu breadcrumb breadcrumbs footer comment comments disqus related recommended share sharing social newsletter "
    "subscribe signup login popup modal pagination pager".split()
)
#: these mark a word of which they are a part, unless another part says that it is a state of the page: user-comments does, no-comments and ad-free do not
PART_MARKS = frozenset("ad ads advert adverts advertisement comment comments".split())
STATES = frozenset("allow closed count disabled enabled free has hide no off on open show with without".split())
HEADER_MARKS = frozenset("header masthead topbar".split())
#: a word of several parts marks if one of them does and the others are of these: site-footer does, has-sidebar and comments-open do not
NEUTRAL = frozenset(
    "area bar block bottom box btn button buttons container entry form global icons inner item items left links list main outer post posts primary "
    "right secondary section site top widget widgets wrap wrapper".split()
)
ROLES = frozenset("navigation contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ARTICLE = frozenset(("article", "main"))


def _marks(words: str) -> set[str]:
    """The marks among the whole words of a class or id."""
    found = set()
    for word in words.split():
        parts = set(_PART.split(word))
        if len(parts) > 1 and not parts & STATES:
            found |= parts & PART_MARKS
        if len(parts) > 1 and all(p in MARKS or p in HEADER_MARKS or p in NEUTRAL or not p or _NUMBER.fullmatch(p) for p in parts):
            # post-header and the like are headings
            found |= parts & MARKS if parts & {"entry", "post"} else parts
        else:
            found.add(word)
    return found


def _role(name: str, attributes: str, in_article: bool) -> str:
    """``out`` for a part to leave out, ``in`` for an article, else empty."""
    if name in DROPPED or (name == "header" and not in_article):
        return "out"
    marks, role = set(), ""
    if attributes and _NAMED.search(attributes):
        own: dict[str, str] = {}
        for key, *values in _ATTRIBUTE.findall(attributes):
            own.setdefault(key.lower(), "".join(values).lower())
        if "hidden" in own or own.get("aria-hidden") == "true":
            return "out"
        role = own.get("role", "").strip()
        if name not in ("body", "html"):
            marks = _marks(own.get("class", "") + " " + own.get("id", ""))
    if role in ROLES or (role == "banner" and not in_article):
        return "out"
    if name in ARTICLE or role in ARTICLE:
        return "out" if marks & {"comment", "comments", "related", "recommended"} else "in"
    if marks & MARKS or (marks & HEADER_MARKS and not in_article):
        return "out"
    return ""


def _enclosing(articles: list[tuple[str, tuple[int, ...], list[int]]], plain: int) -> set[int]:
    """The parts to leave out that enclose the page's ``main``, or its longest article where no article stands outside
    of such parts and it is longer than the ``plain`` text outside: they are wrappers."""
    full = [a for a in articles if a[2][0]]
    found = {i for name, parts, _ in full if name == "main" for i in parts}
    if not found and full and all(parts for _, parts, _ in full):
        _, parts, n = max(full, key=lambda a: a[2][0])
        found = set(parts) if n[0] > plain else found
    return found


def _end_of(page: str, name: str, start: int) -> int:
    """Where the content of the raw element ``name`` that begins at ``start`` ends, its closing tag included; -1 if it is never closed."""
    depth, end = 1, -1
    for m in _OWN_TAG[name].finditer(page, start):
        if m[1]:
            depth, end = depth - 1, m.end()
        elif name in NESTED and not m[0].endswith("/>"):
            depth += 1
        if not depth:
            break
    return end


def lines_of(page: str | None) -> list[tuple[str, str]]:
    """(part, line) in page order; part is ``in`` an article, ``out`` in a part to leave out, or empty."""
    found: list[tuple[tuple[int, ...], bool, str]] = []
    stack: list[tuple[str, str]] = []  # open elements that are blocks or have a role
    aside: list[list[str]] = []  # the line around each open inline part to leave out, which goes on after it
    outs: tuple[int, ...] = ()  # open parts to leave out, as numbers into forms
    forms: list[bool] = []
    articles: list[tuple[str, tuple[int, ...], list[int]]] = []  # name, parts to leave out around it, characters of its own
    opened: list[tuple[str, tuple[int, ...], list[int]]] = []
    buffer: list[str] = []
    unclosed: set[str] = set()
    head = False

    def flush() -> None:
        if buffer:
            line = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if line:
                found.append((outs, bool(opened), line))
                for _, parts, n in opened:
                    n[0] += len(line) if parts == outs else 0

    def leave() -> str:
        nonlocal outs
        last, role = stack.pop()
        if role and last not in BLOCKS:
            flush()
        if role == "out":
            outs = outs[:-1]
            if last not in BLOCKS:
                buffer[:] = aside.pop()
        elif role == "in":
            opened.pop()
        return last

    page = page or ""
    pieces = _PIECE.finditer(page)
    while (m := next(pieces, None)) is not None:
        name = m[2]
        if name is None:
            piece = m[0]
            if not head and (piece == "<" or not piece.startswith("<")):
                buffer.append(piece)
            continue
        name, closing = name.lower(), m[1] == "/"
        if name == "head":
            # a head that is never closed ends by itself
            head = not closing and _HEAD_END.search(page, m.end()) is not None
            continue
        head = head and name in IN_HEAD
        if name in RAW and not closing:
            if not m[3].endswith("/") and name not in unclosed:
                at = _end_of(page, name, m.end())
                if at >= 0:
                    pieces = _PIECE.finditer(page, at)
                elif name in ENDLESS:
                    break
                else:
                    unclosed.add(name)
            continue
        if name == "br":
            buffer.append(" ")
            continue
        if name in BLOCKS:
            flush()
        elif name in VOID:
            continue
        if not closing:
            if name in VOID or m[3].endswith("/"):
                continue
            role = _role(name, m[3], bool(opened))
            if name in BLOCKS or role:
                if role == "out" and name not in BLOCKS:
                    aside.append(buffer[:])
                    buffer.clear()
                elif role and name not in BLOCKS:
                    flush()
                stack.append((name, role))
                if role == "out":
                    outs += (len(forms),)
                    forms.append(name == "form")
                elif role == "in":
                    opened.append((name if name == "main" or not _MAIN.search(m[3]) else "main", outs, [0]))
                    articles.append(opened[-1])
        elif any(n == name for n, _ in stack):
            while leave() != name:
                pass
            if name in BLOCKS:
                flush()
    while stack:
        flush()
        leave()
    flush()
    wrappers = _enclosing(articles, sum(len(t) for parts, inside, t in found if not parts and not inside))
    if all(set(parts) - wrappers for parts, _, _ in found):
        # nothing would be left: the text stands in forms
        wrappers |= {i for i, form in enumerate(forms) if form}
    return [("out" if any(i not in wrappers for i in parts) else "in" if inside else "", t) for parts, inside, t in found]


def shared_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Marks the lines of ``a`` that are in a longest common subsequence with ``b`` (bit-parallel, one big integer per line)."""
    shared = np.zeros(len(a), bool)
    place: dict[int, int] = {}
    for j, x in enumerate(b.tolist()):
        place[x] = place.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows, v = [full], full
    for x in a.tolist():
        u = v & place.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    j = len(b)
    for i in range(len(a), 0, -1):
        if not j:
            break
        low = (1 << j) - 1
        here = j - (rows[i] & low).bit_count()
        if j - (rows[i - 1] & low).bit_count() == here:
            continue  # line i is not needed
        # line i is matched with the last place where the length still grows
        while j and (j - 1) - (rows[i] & (low >> 1)).bit_count() == here:
            j, low = j - 1, low >> 1
        shared[i - 1] = True
        j -= 1
    return shared


def _hashes(lines: list[tuple[str, str]]) -> np.ndarray:
    return signed(np.fromiter((xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for _, t in lines), np.uint64, len(lines)))


def _asked(page: str | None) -> list[tuple[str, str]]:
    """The lines that are not in a part to leave out."""
    return [x for x in lines_of(page) if x[0] != "out"]


def _outline(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"key": frame["key"], "host": frame["host"], "path": frame["path"], "lines": [_hashes(_asked(h)) for h in frame["html"]]})


def _pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        packed = [zlib.compress("\n".join(p + "\t" + t for p, t in _asked(h)).encode("utf-8", "surrogatepass"), 4) for h in frame["html"]]
        yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "key": frame["key"], "packed": packed})


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _repeats(lines: list[tuple[str, str]], path: str, near: list[dict]) -> np.ndarray:
    """Marks the lines that repeat in the neighbour of the longest path prefix (then the nearest, then the one before) that is no near copy."""
    size = np.fromiter((len(t) for _, t in lines), np.int64, len(lines))
    own = _hashes(lines)
    for x in sorted(near, key=lambda x: (-_prefix(path, x["path"]), abs(x["step"]), x["step"])):
        shared = shared_lines(own, np.asarray(x["lines"], np.int64))
        most_text, most_lines = size[shared].sum() / size.sum(), shared.mean()
        if most_text <= 0.8 and (most_text <= 0.5 or most_lines <= 0.5):
            return shared
    return np.zeros(len(lines), bool)


def _difference(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = []
        for packed, path, near in zip(frame["packed"], frame["path"], frame["near"]):
            raw = zlib.decompress(packed).decode("utf-8", "surrogatepass")
            lines = [tuple(x.split("\t", 1)) for x in raw.split("\n")] if raw else []
            gone = _repeats(lines, path, near if near is not None else []) if lines else []
            texts.append("\n".join(t for (p, t), g in zip(lines, gone) if p == "in" or not g))
        yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def _neighbours(chained: DataFrame) -> DataFrame:
    """(key, near): the up to two pages before and two after each page, from (key, path, lines, previous)."""

    def seen(step: int, page: str) -> Column:
        return F.struct(F.lit(step).alias("step"), F.col(page + "path").alias("path"), F.col(page + "lines").alias("lines"))

    one = chained.where("previous is not null")
    two = one.select(F.col("previous.key").alias("middle"), "key", "path", "lines").join(
        one.select(F.col("key").alias("middle"), "previous"), "middle"
    )
    pairs = None
    for step, rows in ((1, one), (2, two)):
        both = rows.select("key", seen(-step, "previous.").alias("page")).union(rows.select("previous.key", seen(step, "").alias("page")))
        pairs = both if pairs is None else pairs.union(both)
    return pairs.groupBy("key").agg(F.collect_list("page").alias("near"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages`` (page_id, url, html, any more columns)."""
    spark = pages.sparkSession
    keyed = with_parts(pages.select("page_id", "url", "html")).withColumn(
        "key", F.md5(F.concat_ws("\u0001", F.coalesce(F.col("page_id").cast("string"), F.lit("\u0002")), F.coalesce("url", F.lit("\u0002")), F.md5(F.coalesce("html", F.lit("\u0002")))))
    )
    ranges = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    outline = keyed.select("key", "host", "path", "html").mapInPandas(_outline, "key string, host string, path string, lines array<long>").dropDuplicates(["key"])
    outline = saved(outline.repartitionByRange(ranges, "host", "path", "key").withColumn("range", F.spark_partition_id()), "outline")
    chained = ordered.with_previous(outline, ["host"], "range", ["path", "key"], ["key", "path", "lines"], "previous")
    chained = saved(chained.select("key", "path", "lines", "previous"), "chained")
    packed = keyed.select("page_id", "url", "key", "html").mapInPandas(_pack, "page_id long, url string, key string, packed binary")
    return (
        packed.join(chained.select("key", "path").join(_neighbours(chained), "key", "left"), "key")
        .mapInPandas(_difference, "page_id long, url string, text string, n_chars long")
    )
