"""Main text of web pages by differencing each page with its nearest by URL.

A page is read into lines, one a block, with what its elements say of each: declared page
furniture (menus, footers, forms and the like), declared article, or nothing. Within a
host, pages are put in order of path; pages of the same lines are one. Each is paired with
its neighbours on both sides, the lines of a pair are aligned by their longest common
subsequence, and lines that the alignment shares are deleted: what a template gives to two
pages is not the text of either. Two checks follow. A shared line that an ``article`` or
``main`` element declares to be the page's own stays, since articles quote each other and
license lines. Declared furniture goes though no neighbour has it, since menus differ from
page to page. Pairs that share nearly all are copies of one page, and tell nothing.

Only hashes of lines are shuffled to find pairs. Neighbours come from a sort over all
pages and not from a task for each host. What was found is joined back by the lines' key;
only pages that lose undeclared lines are in that table.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm.lineage import discard, written

#: A pair whose alignment has this percentage of the characters of both pages is of copies.
COPY_PERCENT = 90
#: Alignments with more cells than this are halved until they have fewer.
CELLS = 1 << 24

#: What elements and their names say; fixed values of HTML and of common usage.
FURNITURE = frozenset("nav footer aside form menu dialog".split())
OUTSIDE = frozenset("header".split())
UNSEEN = frozenset("head noscript template svg iframe object canvas audio video select button datalist map math".split())
ABSENT = FURNITURE | UNSEEN
RAW = frozenset("script style title textarea xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul caption".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert "
    "popup modal overlay nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar masthead comment comments commentlist disqus respond replies share sharing "
    "social related recommended newsletter subscribe subscription signup login search pagination pager toolbar skip widget".split()
)
OUTER_NAMES = frozenset("header footer topbar bottombar".split())

TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)(?:>|$)|<[/a-zA-Z][^>]*(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
ENDS = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: What is declared of a line.
OPEN, ARTICLE, GONE = 0, 1, 2


def _declared(tag: str, attributes: str, inside: bool) -> int | None:
    """What an element says of its content; ``inside`` an article, headers are its own."""
    if tag in ABSENT or not inside and tag in OUTSIDE:
        return GONE
    kind = ARTICLE if tag in ("article", "main") else None
    if "=" not in attributes and "hidden" not in attributes:
        return kind
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name == "role" and value.lower() in ROLES:
            return GONE
        if name == "role" and value.lower() in ("main", "article"):
            kind = ARTICLE
        if name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return GONE
        if name in ("class", "id") and tag not in ("html", "body", "main"):
            words = {w.lower() for w in WORD.findall(value)}
            if words & NAMES or not inside and words & OUTER_NAMES:
                return GONE
    if re.search(r"(?:^|\s)hidden(?:\s|$|=)", attributes):
        return GONE
    return kind


def read_lines(page: str) -> list[tuple[str, int]]:
    """The page's blocks in order, white space as one space, each with what is declared of it; without empty ones.

    Where a page is broken off, what stands before is read; a tag without end is none.
    """
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []  # open elements that say something, or may hold others that do
    state, text = OPEN, []

    def flush():
        if text:
            line = "".join(text)
            text.clear()
            line = " ".join((html.unescape(line) if "&" in line else line).split())
            if line:
                out.append((line, state))

    at, end = 0, len(page)
    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            text.append(page[at:])
            break
        if mark > at:
            text.append(page[at:mark])
        m = TAG.match(page, mark)
        if m is None:
            text.append("<")
            at = mark + 1
            continue
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if at == end and page[-1] != ">":
            break  # broken off within the tag
        if tag in RAW:
            if not m[1]:
                stop = ENDS[tag].search(page, at)
                at = stop.end() if stop else end
            continue
        block = tag in BLOCKS
        if not block and tag not in UNSEEN:
            if tag == "br" or tag in ("td", "th"):
                text.append(" ")
            elif not m[1] and tag not in VOID and "=" in m[3] and _declared(tag, m[3], state == ARTICLE) == GONE:
                flush()
                stack.append((tag, state))
                state = GONE
            elif not m[1] and stack and stack[-1][0] == tag:
                stack.append((tag, state))
            elif m[1] and stack and stack[-1][0] == tag:
                flush()
                state = stack.pop()[1]
            continue
        flush()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    state = stack[k][1]
                    del stack[k:]
                    break
            continue
        while stack and (stack[-1][0] == "p" or tag == stack[-1][0] == "li"):
            state = stack.pop()[1]
        if tag == "hr" or m[3].endswith("/") and tag in UNSEEN:
            continue
        said = GONE if state == GONE else _declared(tag, m[3], state == ARTICLE)
        stack.append((tag, state))
        state = state if said is None else said
    flush()
    return out


def host_and_path(url: str | None) -> tuple[str | None, str]:
    """Host in lower case, without user and port; and path with query, without fragment."""
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^#]*)", url or "")
    return (m[1].lower(), m[2] or "/") if m and m[1] else (None, "")


def _key(lines: list[tuple[str, int]]) -> bytes:
    mark = hashlib.blake2b(digest_size=16)
    for line, kind in lines:
        mark.update(b"%d %d " % (kind, len(line)) + line.encode("utf-8", "surrogatepass"))
    return mark.digest()


def _hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, path, key, and hash, length and declaration of the lines of each page with a host."""
    for batch in batches:
        rows = []
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            host, path = host_and_path(url)
            if host is not None:
                lines = read_lines(page or "")
                rows.append((host, path, _key(lines), [_hash(x) for x, _ in lines], [len(x) for x, _ in lines], bytes(k for _, k in lines)))
        if rows:
            cols = list(zip(*rows))
            types = [pa.string(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=["host", "path", "key", "lines", "sizes", "kinds"])


def _row_sums(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each prefix of ``b``."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(-(-len(b) // 8) or 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence.

    Rows of the table are sets of bits, all kept for the way back; a table of more than
    CELLS is halved where the two halves' lengths add up to most, so memory stays bounded.
    """
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    out = [(k, k) for k in range(first)]
    x, y = a[first : len(a) - last], b[first : len(b) - last]
    if x and y:
        if len(x) * len(y) > CELLS and len(x) > 1:
            half = len(x) // 2
            split = int(np.argmax(_row_sums(x[:half], y) + _row_sums(x[half:][::-1], y[::-1])[::-1]))
            out += [(first + i, first + j) for i, j in aligned(x[:half], y[:split])]
            out += [(first + half + i, first + split + j) for i, j in aligned(x[half:], y[split:])]
        else:
            out += [(first + i, first + j) for i, j in _table(x, y)]
    return out + [(len(a) - last + k, len(b) - last + k) for k in range(last)]


def _table(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, []
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    # a cleared bit j of row i: the length grows at j
    out, i, j = [], len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            out.append((i, j))
            i, j = i - 1, j - 1
    return out[::-1]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page of a pair the undeclared lines that the alignment shares."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            pair = aligned(r["lines"], r["lines2"])
            sides = (("key", "sizes", "kinds", [i for i, _ in pair]), ("key2", "sizes2", "kinds2", [j for _, j in pair]))
            if any(100 * sum(r[sizes][i] for i in at) < COPY_PERCENT * sum(r[sizes]) for _, sizes, _, at in sides):
                some = ((r[key], [i for i in at if r[kinds][i] == OPEN]) for key, _, kinds, at in sides)
                rows += [(r["host"], key, at) for key, at in some if at]
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.list_(pa.int32())))], names=["host", "key", "at"])


def deleted_lines(pages: DataFrame) -> DataFrame:
    """``host, key, deleted``: for pages that share undeclared lines with a neighbour, the places of these lines."""
    hashed = pages.mapInArrow(_hashed, "host string, path string, key binary, lines array<long>, sizes array<int>, kinds binary")
    # pages of the same lines are one, at the least of their paths
    once = hashed.groupBy("host", "key").agg(F.min(F.struct("path", "lines", "sizes", "kinds")).alias("p")).select("host", "key", "p.*")
    order = ["host", "path", "key"]
    table = written(once.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id()))
    # ids are consecutive within a part of the sort; parts follow each other
    table = table.withColumn("part", F.shiftright("id", 33))
    sizes = sorted((r.part, r.n) for r in table.groupBy("part").agg(F.count("*").alias("n")).collect())  # a row a task
    starts = pages.sparkSession.createDataFrame([(part, sum(n for _, n in sizes[:k])) for k, (part, _) in enumerate(sizes)], "part long, start long")
    place = table.join(F.broadcast(starts), "part").withColumn("place", F.col("start") + F.col("id").bitwiseAND((1 << 33) - 1)).drop("id", "path", "part", "start")
    behind = place.select(F.col("host").alias("host2"), *[F.col(c).alias(f"{c}2") for c in ("key", "lines", "sizes", "kinds")], (F.col("place") - 1).alias("place"))
    pairs = place.join(behind, "place").where("host = host2").drop("place", "host2")
    found = pairs.mapInArrow(_shared, "host string, key binary, at array<int>")
    out = written(found.groupBy("host", "key").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("deleted")))  # two rows a key at most
    discard(table.drop("part"))
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page with the lines that may be its text, their places among all its lines, and host and key."""
    for batch in batches:
        hosts, keys, places, texts = [], [], [], []
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            lines = read_lines(page or "")
            own = any(k == ARTICLE for _, k in lines)
            some = [(i, x) for i, (x, k) in enumerate(lines) if k == ARTICLE or k == OPEN and not own]
            hosts.append(host_and_path(url)[0])
            keys.append(_key(lines))
            places.append([i for i, _ in some])
            texts.append([x for _, x in some])
        yield pa.record_batch(
            [batch.column("id"), batch.column("url"), pa.array(hosts, pa.string()), pa.array(keys, pa.binary()), pa.array(places, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string()))],
            names=["id", "url", "host", "key", "places", "texts"],
        )


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    Lines outside a declared article count only where a page declares none. Null html, and
    html without text, gives empty text; pages with null or unreadable URLs have no
    neighbours and are judged by their elements alone. Rows may repeat, ids too. Other
    columns are not read.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    gone = deleted_lines(rows.select("url", "html"))
    kind = rows.schema["id"].dataType.simpleString()
    read = rows.mapInArrow(_read, f"id {kind}, url string, host string, key binary, places array<int>, texts array<string>")
    both = read.join(gone, ["host", "key"], "left")
    stays = F.filter("texts", lambda x, i: ~F.array_contains(F.coalesce("deleted", F.array().cast("array<int>")), F.get("places", i)))
    text = F.array_join(F.when(F.col("deleted").isNull(), F.col("texts")).otherwise(stays), "\n\n")
    return both.select(F.col("id").alias("page_id"), "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
