"""HTML extraction by differencing each page with the page of the nearest URL on its host.

1. A page is read into blocks: text between block-level tags, character references decoded, white space made one
   space. Scripts, styles, comments, forms and the like are skipped. Each block knows whether it stands in the
   page's main element (article, main), in an element that is boilerplate by its name, role or class (nav, header,
   footer, aside, ad, cookie notice, comments ...), or neither.
2. Pages are numbered by (host, path, query) over the whole table, without a window over a host; those of equal html
   that differ in the query at most are one page, however many they are. Each is compared
   with the pages up to ``REACH`` places away on its host, those first whose path shares more leading characters
   (ties: the nearer, then the one before).
3. The blocks of both whole pages are aligned by longest common subsequence. Blocks that both pages share are the
   site's, not the page's. Where that leaves under a tenth of the characters that are not boilerplate by their
   element, the other page is a near copy (a mirror, a print version, the same page with another query): the next
   page is taken, and the first that is not a near copy decides. One page is too weak a witness against a block inside the
   main element, as any two articles may share a sentence: such a block goes if most of the first ``WITNESSES`` pages that are
   not near copies share it, and two at least.
4. The text is the blocks that are neither boilerplate by their element nor shared, inside the main element or not.
   Blocks stay in page order, joined by an empty line.

Markup is read forward only, in time linear in the page: a tag that does not end ends at the next ``<``, and quotes
count after an equals sign only. Long line lists are aligned by Hirschberg's divide and conquer, in memory linear in them.

Blocks travel to the neighbours as 64-bit hashes, in ranges of the numbering, so pages are shuffled once.

Defined cases: null html has no text; a null or broken URL is of the host '' (pages of it are neighbours too); copies of a
page get the same result; with no neighbour, or none within reach but near copies, nothing is shared; unclosed elements end with the page or with the
element that encloses them. Other columns are carried in ``rest``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.llm._text import cut, pieces, rest_of
from harvest.operators.numbering import consecutive_index

#: A tag; possessive, so no character is read again. What a tag without an end leaves off at is text.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>?")
SKIPPED = frozenset("script style noscript template svg math iframe object canvas head title form button select textarea audio video".split())
RAW = frozenset("script style textarea title".split())
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
BOILERPLATE = frozenset("nav header footer aside menu dialog".split())
MAIN = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup "
                   "time tt u var wbr br".split())
ROLES = re.compile(r"\brole\s*=\s*[\"']?(navigation|banner|contentinfo|complementary|search|dialog|alert)\b", re.I)
NAMED = re.compile(r"\b(?:class|id)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
#: Words of class names and ids of boilerplate, and those that may stand beside them: a name counts if it has one of the
#: first and no other than both kinds ("cookie-notice", "site-footer", but not "share-price-table").
MARKS = frozenset("ad ads advert adverts advertisement advertisements sponsor sponsored promo banner menu nav navbar navigation breadcrumb breadcrumbs "
                  "sidebar aside footer header masthead cookie cookies consent notice notices popup modal newsletter subscribe share sharing social "
                  "comment comments disqus related pagination pager widget".split())
BESIDE = frozenset("site page main top bottom left right global primary secondary inner outer box bar block container wrapper wrap section area list item items "
                   "link links row col column group holder slot unit zone text content body title icon icons button buttons js is has".split())
#: Those that make even an article one of readers or advertisers.
COMMENTS = frozenset("comment comments ad ads advert advertisement sponsored promo related".split())
WORDS = re.compile(r"[A-Za-z]+")
SPACE = re.compile(r"\s+")
OUTSIDE, INSIDE, SITE = range(3)
#: Pages that bear witness against a block of the main element; cells of an alignment that is kept whole (8 MB of bits).
WITNESSES, CELLS = 5, 1 << 26
KEY = ["host", "path", "ph"]
#: Pages of a range of the numbering, how far a page looks for one that is not its near copy, and the share of characters that it leaves.
RANGE, REACH, LEFT = 256, 16, 0.1


def is_boilerplate(name: str, attributes: str, place: int = 0) -> bool:
    if name in BOILERPLATE:
        return not (name == "header" and place == INSIDE)       # an article's own header holds its title
    if not attributes:
        return False
    if ROLES.search(attributes):
        return True
    marks = COMMENTS if name in MAIN else MARKS
    for x in NAMED.findall(attributes):
        for token in x.strip("\"'").lower().split():
            words = WORDS.findall(token)
            if any(w in marks for w in words) and all(w in MARKS or w in BESIDE for w in words):
                return True
    return False


def tags(html: str) -> Iterator[tuple[int, int, str, str, str]]:
    """start, end, slash, name and attributes of each tag, comment, CDATA section or declaration (of the latter the name is what it
    begins with); the reader may send on where to go on, after what is not markup."""
    at, n = 0, len(html)
    while (i := html.find("<", at)) >= 0:
        found = None
        if html.startswith("<!--", i):
            j = html.find("-->", i + 4)
            found = (i, j + 3 if j >= 0 else n, "", "<!--", "")
        elif html.startswith("<![CDATA[", i):
            j = html.find("]]>", i)
            found = (i, j + 3 if j >= 0 else n, "", "<![CDATA[", html[i + 9:j if j >= 0 else n])
        elif html[i + 1:i + 2] in ("!", "?"):
            j = html.find(">", i)
            found = (i, j + 1 if j >= 0 else n, "", "<!", "")
        elif m := TAG.match(html, i):
            found = (i, m.end(), m[1], m[2].lower(), m[3])
        at = found[1] if found else i + 1
        if found:
            at = (yield found) or at


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(place, text) of each block: OUTSIDE, INSIDE the main element, or of the SITE."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int, bool]] = []      # name, place, skipped
    deep: Counter = Counter()       # how often each name is on the stack
    place, skipped, at = OUTSIDE, False, 0

    def end_block() -> None:
        if text:
            line = SPACE.sub(" ", unescape("".join(text))).strip()
            if line:
                out.append((place, line))
            text.clear()

    html = html or ""
    n = len(html)
    reader, go_on = tags(html), None
    while True:
        try:
            start, end, slash, name, attributes = reader.send(go_on)
        except StopIteration:
            break
        go_on = None
        if not skipped:
            text.append(html[at:start])
        at = end
        if name[0] == "<":
            if name == "<![CDATA[" and not skipped:
                text.append(attributes.replace("&", "&amp;"))
            continue
        if name == "br":
            text.append(" ")
            continue
        if name not in INLINE:
            end_block()
        if slash:
            if deep[name]:
                while (last := stack.pop()[0]) != name:
                    deep[last] -= 1
                deep[name] -= 1
                place, skipped = stack[-1][1:] if stack else (OUTSIDE, False)
        elif name not in VOID and not attributes.endswith("/") and (name not in INLINE or is_boilerplate(name, attributes)):
            if name in RAW:     # its content is not markup
                close = RAW_END[name].search(html, at)
                at = go_on = close.end() if close else n
                continue
            if name not in ("html", "body") and is_boilerplate(name, attributes, place):
                place = SITE
            elif name in MAIN and place != SITE:
                place = INSIDE
            skipped = skipped or name in SKIPPED
            stack.append((name, place, skipped))
            deep[name] += 1
    if not skipped:
        text.append(html[at:])
    end_block()
    return out


def shared(a: list, b: list) -> set[int]:
    """The places in ``a`` of a longest common subsequence of both."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    out = {*range(low), *range(len(a) - high, len(a))}
    rest = a[low:len(a) - high], b[low:len(b) - high]
    both = set(rest[0]) & set(rest[1])          # other lines are in no common subsequence
    at = [i for i, x in enumerate(rest[0]) if x in both]
    return out | {low + at[i] for i in subsequence([rest[0][i] for i in at], [x for x in rest[1] if x in both])}


def grown(a: list, b: list) -> Iterator[int]:
    """After each line of ``a``: bits, zero where the longest common subsequence with ``b`` grows along b (bit-parallel)."""
    where: dict = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)

    def mask(x: object) -> int:
        js = where.get(x, ())
        if len(js) < 64:
            return sum(1 << j for j in js)
        flags = np.zeros(len(b), bool)
        flags[js] = True
        return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")

    masks = {x: mask(x) for x in where} if len(b) <= 4096 else None      # as many masks of as many bits: of long lists, made when needed
    v = full = (1 << len(b)) - 1
    for x in a:
        u = v & (masks.get(x, 0) if masks is not None else mask(x))
        v = (v + u | v - u) & full
        yield v


def reach(a: list, b: list) -> np.ndarray:
    """The length of the longest common subsequence of ``a`` and each beginning of ``b``."""
    v = (1 << len(b)) - 1
    for v in grown(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate(([0], np.cumsum(bits == 0)))


def subsequence(a: list, b: list) -> list[int]:
    """The places in ``a`` of a longest common subsequence. Up to ``CELLS`` the whole alignment is kept and read back, larger ones are halved."""
    if not a or not b:
        return []
    if len(a) * len(b) > CELLS and len(a) > 1:
        mid = len(a) // 2
        j = int(np.argmax(reach(a[:mid], b) + reach(a[mid:][::-1], b[::-1])[::-1]))
        return subsequence(a[:mid], b[:j]) + [mid + i for i in subsequence(a[mid:], b[j:])]
    rows = [(1 << len(b)) - 1, *grown(a, b)]
    length = lambda i, j: j - (rows[i] & (1 << j) - 1).bit_count()
    i, j, out = len(a), len(b), []
    while i and j:
        n = length(i, j)
        if n == length(i - 1, j):
            i -= 1
        elif n == length(i, j - 1):
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append(i)
    return out[::-1]


def key_of(url: str, html: str) -> list:
    """host, path and a hash of the html: pages that differ in the query at most are one page."""
    return [F.lower(part_of(url, 1)).alias("host"), part_of(url, 2).alias("path"), F.xxhash64(F.col(html).cast("string")).alias("ph")]


def part_of(url: str, k: int) -> Column:
    link = F.coalesce(F.col(url).cast("string"), F.lit(""))
    return F.regexp_extract(link, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(.*)$", k)


def numbered(pages: DataFrame, url: str, html: str) -> DataFrame:
    """host, path, ph and place of each distinct page in the order of (host, path, least query, hash)."""
    rows = pages.select(*key_of(url, html), part_of(url, 3).alias("query")).groupBy(*KEY).agg(F.min("query").alias("query"))
    return cut(consecutive_index(rows, ["host", "path", "query", "ph"], name="place").select(*KEY, "place"))


def neighbours(lines: DataFrame) -> DataFrame:
    """host, path, ph and the places of the lines that a page shares with its neighbour. lines: host, path, ph, place, lines
    (hashes) and sizes (characters, negative inside the main element, 0 for boilerplate)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: list[tuple] = []
        now = None
        for b in pieces(batches, 500):
            for row in zip(*(b.column(n).to_pylist() for n in ("range", "place", *KEY, "lines", "sizes"))):
                if row[0] != now:
                    yield from settle(now, pages)
                    now, pages = row[0], []
                pages.append(row[1:])
        yield from settle(now, pages)

    def settle(now: int | None, pages: list[tuple]) -> Iterator[pa.RecordBatch]:
        out = []
        for k, (place, host, path, ph, own, sizes) in enumerate(pages):
            if place // RANGE != now:
                continue
            near = [(-common(path, x[2]), abs(x[0] - place), x[0], x[4]) for x in pages[max(0, k - REACH):k + REACH + 1] if x[1] == host and x[0] != place]
            if gone := site_lines(own, sizes, [x[3] for x in sorted(near, key=lambda x: x[:3])]):
                out.append((host, path, ph, gone))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32())))], [*KEY, "gone"])

    ranges = F.array_distinct(F.transform(F.array(F.lit(0), F.lit(-REACH), F.lit(REACH)), lambda d: F.floor((F.col("place") + d) / RANGE)))
    return (lines.withColumn("range", F.explode(ranges)).repartition("range").sortWithinPartitions("range", "place")
            .mapInArrow(run, "host string, path string, ph long, gone array<int>"))


def site_lines(own: list, sizes: list[int], near: list[list]) -> list[int]:
    """The places of the lines that the ``near`` pages show to be the site's; sizes of lines inside the main element are negative."""
    total, gone, inside, asked, votes = sum(map(abs, sizes)), [], [], 0, Counter()
    for other in near:
        found = shared(own, other)
        if not total or total - sum(abs(sizes[i]) for i in found) < LEFT * total:
            continue
        if not asked:           # the first that is not a near copy
            gone = [i for i in found if sizes[i] >= 0]
            inside = [i for i in found if sizes[i] < 0]
            if not inside:
                break
        votes.update(i for i in inside if i in found)
        asked += 1
        if asked == WITNESSES:
            break
    return sorted(gone + [i for i in inside if votes[i] > 1 and 2 * votes[i] > asked])


def common(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def main_text(found: list[tuple[int, str]], gone: list[int] | None) -> str:
    """The text of a page, given the places of the lines it shares with its neighbour."""
    drop = set(gone or ())
    return "\n\n".join(t for k, (p, t) in enumerate(found) if p != SITE and k not in drop)


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """rest (all columns but the html) and text: a row for each row of ``pages``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 500):
            found = [blocks(h) for h in b.column("html").to_pylist()]
            lines = [[xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for _, t in x] for x in found]
            sizes = [[0 if p == SITE else -len(t) if p == INSIDE else len(t) for p, t in x] for x in found]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(lines, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))],
                                             [*KEY, "lines", "sizes"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in pieces(batches, 500):
            blobs = [z.compress(h.encode("utf-8", "surrogatepass")) if h else b"" for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(blobs, pa.binary())], [*KEY, "rest", "z"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for b in pieces(batches, 500):
            texts = [main_text(blocks(z.decompress(x).decode("utf-8", "surrogatepass") if x else None), g)
                     for x, g in zip(b.column("z").to_pylist(), b.column("gone").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("rest"), pa.array(texts, pa.string())], ["rest", "text"])

    keyed = pages.select(*key_of(url, html), rest_of(pages, html), F.col(html).cast("string").alias("html"))
    rest = dict(keyed.dtypes)["rest"]
    key = "host string, path string, ph long"
    lines = keyed.select(*KEY, "html").mapInArrow(read, f"{key}, lines array<long>, sizes array<int>").dropDuplicates(KEY)
    gone = neighbours(lines.join(numbered(pages, url, html), KEY))
    return (keyed.mapInArrow(pack, f"{key}, rest {rest}, z binary").join(gone, KEY, "left").select("rest", "z", "gone")
            .mapInArrow(finish, f"rest {rest}, text string"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("rest.page_id", "rest.url", "text", F.length("text").cast("long").alias("n_chars"))
