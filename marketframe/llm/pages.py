"""Main text of web pages by nearest-URL page differencing.

Pages become lists of text lines, one per block. Within a host, pages are ordered by URL path; each is aligned
with its neighbours by longest common subsequence, and lines they share are template lines and deleted. Lines
inside markup that names them as navigation, page header or footer, sidebar, notice, advert, form or comments
are deleted in any case, and lines inside an ``article`` or ``main`` element are text of the page itself even if
a neighbour repeats them (copies and shared passages), so differencing decides over all others.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, in_arrow

# HTML elements by what they do to text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
select summary table tbody td tfoot th thead tr ul""".split())
DROPPED = frozenset("""nav footer aside head script style textarea title iframe noembed noframes noscript template select option
button menu dialog object svg math canvas audio video map datalist""".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
# whole names of class and id attributes, alone or with the additions below; the second list does not count inside an article
DROPPED_NAMES = frozenset("""ad ads advert adverts advertisement advertising adslot sponsor sponsored promo promotion cookie cookies consent
gdpr notice notices popup modal overlay newsletter subscribe signup login sidebar aside breadcrumb breadcrumbs menu nav navbar navigation
pagination pager comment comments commentlist reply replies respond disqus share sharing social related recommended toolbar skip""".split())
DROPPED_OUTSIDE = frozenset("header footer masthead banner topbar bottombar copyright widget widgets".split())
ADDITIONS = frozenset("""area bar block bottom box btn button buttons card col column container content footer form global group header icons
inner item items left link links list main message mobile outer page panel primary right row secondary section site slot small text top unit
wrap wrapper""".split())
# what readers or other pages say, even in an article element of their own
OTHERS = frozenset("comment comments commentlist reply replies respond disqus".split())
# text of an article whatever it is called
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre b i em strong span a code q cite mark small sub sup u s abbr time".split())
INSIDE = frozenset(("article", "main"))
PAGE = frozenset(("article", "main", "h1", "nav", "header", "footer"))  # a form around one of these is the page's frame
_CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"}
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}}

# a quote delimits a value right after "=" only, and only if it is closed
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*(?:\"[^\"]*|'[^']*)display\s*:\s*none)", re.I)
_PART = re.compile(r"[a-z0-9]+")

OPEN, MAIN, OUT, RESCUED = 0, 1, 2, 3
KEPT, SOFT, HARD = 0, 1, 2  # nothing dropped; dropped unless it holds the article; dropped in any case
KEY = ("host", "path", "address", "number")  # the order of pages; address and number: URL and page id as strings


def _named(value: str, names: frozenset) -> bool:
    """Whether a class or id is one of the names: whole, or a compound of them and nothing but usual additions."""
    for name in value.split():
        parts = set(_PART.findall(name))
        if parts & names and not parts - names - ADDITIONS:
            return True
    return False


def _unwanted(tag: str, attributes: str, inside: bool) -> int:
    if tag in DROPPED or (tag == "header" and not inside):
        return HARD
    if not attributes:
        return KEPT
    if _HIDDEN.search(attributes):
        return HARD
    worst = KEPT
    for m in _ATTR.finditer(attributes):
        value = html.unescape(m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in DROPPED_ROLES:
                return HARD
        elif tag not in ("html", "body") and not (inside and tag in TEXT):
            if _named(value, OTHERS):
                return HARD
            if tag not in INSIDE and _named(value, DROPPED_NAMES if inside else DROPPED_NAMES | DROPPED_OUTSIDE):
                worst = SOFT
    return worst


def lines_of(page: str) -> list[tuple[int, str]]:
    """``(zone, text)`` of every block with text, in page order. Character references are decoded, white space
    inside a block is one blank. Zones: inside an article or main element, in markup that is no main text, or
    neither. Scripts, styles and comments give no line.

    An element that only its name drops gives way to an article or main element inside it, if the page has none
    elsewhere. A form goes with all its text, unless it frames the page: then only its labels and controls go."""
    out: list[tuple[int, str, int]] = []  # zone, text, form
    words: list[str] = []
    stack: list[tuple[str, int, int, int]] = []  # element, how it drops, main from here, names that drop before it
    blocks: list[int] = []  # places of block elements in the stack
    opened: dict[str, int] = {}
    frames: list[bool] = [True]  # of every form, whether it frames the page; the first is no form
    hard = soft = given_way = inside = rescued = form = 0

    def text(raw: str) -> None:
        if words or raw and not raw.isspace():
            words.append(raw)

    def flush() -> None:
        if words:
            line = " ".join(html.unescape("".join(words)).split())
            words.clear()
            if line:
                zone = OUT if hard or soft > given_way else RESCUED if rescued else MAIN if inside else OPEN
                out.append((zone, line, form))

    def pop() -> None:
        nonlocal hard, soft, given_way, inside, rescued, form
        tag, drop, main, before = stack.pop()
        opened[tag] -= 1
        if blocks and blocks[-1] == len(stack):
            blocks.pop()
        hard -= drop == HARD
        soft -= drop == SOFT
        inside -= main > 0
        if main == RESCUED:
            rescued, given_way = rescued - 1, before
        if tag == "form":
            form = 0

    def close_nearest(tags: set[str]) -> None:
        """Closes the innermost open block, with all inline elements in it, if it is one of ``tags``."""
        if blocks and stack[blocks[-1]][0] in tags:
            for _ in range(len(stack) - blocks[-1]):
                pop()

    at, low = 0, None
    while at < len(page):
        m = _TAG.search(page, at)
        text(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        tag = m[2].lower() if m[2] else ""
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
        if tag == "br":
            text(" ")
        if m[1]:
            if opened.get(tag):
                if tag in DROPPED or tag == "label":
                    flush()
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in RAW:
            low = page.lower() if low is None else low
            end = low.find(f"</{tag}", at)
            close = page.find(">", end) if end >= 0 else -1
            at = len(page) if close < 0 else close + 1
            continue
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag in BLOCKS and tag != "html" and stack and stack[-1][0] == "head":
            pop()
        if tag in _CLOSES_P:
            close_nearest({"p"})
        if tag in _SAME:
            close_nearest(_SAME[tag])
        if tag == "form":
            if form:  # a form holds no other
                continue
            frames.append(False)
            form = len(frames) - 1
        elif form and tag in PAGE:
            frames[form] = True
        drop = HARD if form and tag == "label" else _unwanted(tag, m[3], inside > 0)
        if drop and tag not in BLOCKS:
            flush()
        if tag in BLOCKS:
            blocks.append(len(stack))
        opened[tag] = opened.get(tag, 0) + 1
        main = 0
        if tag in INSIDE and not hard and not drop:
            main = RESCUED if soft > given_way or rescued else MAIN
        stack.append((tag, drop, main, given_way))
        if main == RESCUED:
            rescued, given_way = rescued + 1, soft
        inside += main > 0
        hard += drop == HARD
        soft += drop == SOFT
    flush()
    last = OUT if any(z == MAIN and frames[f] for z, _, f in out) else MAIN
    return [(OUT if not frames[f] else last if z == RESCUED else z, line) for z, line, f in out]


def common_subsequence(a: list[int], b: list[int]) -> tuple[set[int], set[int]]:
    """Places in ``a`` and ``b`` of a longest common subsequence, the k-th occurrence of a line standing for itself
    only; then it is a longest increasing subsequence, found in n log n."""
    def numbered(x: list[int]) -> list[tuple[int, int]]:
        seen: dict[int, int] = {}
        out = []
        for v in x:
            seen[v] = seen.get(v, -1) + 1
            out.append((v, seen[v]))
        return out

    where = {k: j for j, k in enumerate(numbered(b))}
    pairs = [(i, where[k]) for i, k in enumerate(numbered(a)) if k in where]
    tails: list[int] = []
    tail_at: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        back.append(tail_at[k - 1] if k else -1)
        tails[k:k + 1] = [j]
        tail_at[k:k + 1] = [n]
    left, right, n = set(), set(), tail_at[-1] if tail_at else -1
    while n >= 0:
        left.add(pairs[n][0])
        right.add(pairs[n][1])
        n = back[n]
    return left, right


def _short(key) -> Column:
    """A key for ordering, of bounded length: long ones end in their hash."""
    return F.when(F.length(key) > 480, F.concat(F.substring(key, 1, 448), F.md5(key))).otherwise(key)


def host_and_path(pages: DataFrame, url_col: str) -> DataFrame:
    """``pages`` with ``host`` and ``path``, taken from the URL."""
    url = F.coalesce(F.trim(F.col(url_col)), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    return pages.withColumn("host", _short(host)).withColumn("path", _short(path))


def _same(a: Counter, b: Counter) -> bool:
    """Whether two bags of words share at least half of both."""
    n = 2 * (a & b).total()
    return n >= a.total() and n >= b.total()


def kept_lines(zones: list[int], marks: list[int], sizes: list[int], lines: list[str],
               others: list[tuple[list[int], list[int], list[int], list[str]]]) -> list[bool]:
    """Which lines of a page are main text, given its neighbours' lines; ``lines`` are the texts outside ``OUT``.

    A neighbour that shares most of the text open to differencing may be a copy, which tells nothing about templates.
    That is judged without the lines that a third neighbour has as well, where the three pages are otherwise different:
    of the words of their other open lines no two share half. So a template may be longer than the pages' own text,
    while copies with another date or number stay copies."""
    met = []
    for z, m, s, t in others:
        mine, theirs = common_subsequence(marks, m)
        both = {i: j for i, j in zip(sorted(mine), sorted(theirs), strict=True) if zones[i] == OPEN == z[j]}
        met.append(({i for i in mine if zones[i] == OPEN}, {j for j in theirs if z[j] == OPEN}, both, z, s, t))

    def mass(z: list[int], s: list[int], gone: set[int]) -> int:
        return sum(n for i, (n, k) in enumerate(zip(s, z, strict=True)) if k == OPEN and i not in gone)

    def rest(z: list[int], t: list[str], gone: set[int]) -> Counter:
        texts = iter(t)
        words = Counter()
        for i, k in enumerate(z):
            line = next(texts) if k != OUT else ""
            if k == OPEN and i not in gone:
                words.update(line.split())
        return words

    def a_copy(mine: set[int], theirs: set[int], z: list[int], s: list[int], gone: dict[int, int]) -> bool:
        left = sum(sizes[i] for i in mine if i not in gone), sum(s[j] for j in theirs - set(gone.values()))
        return 2 * left[0] > mass(zones, sizes, set(gone)) and 2 * left[1] > mass(z, s, set(gone.values()))

    shared: set[int] = set()
    for mine, theirs, both, z, s, t in met:
        if not a_copy(mine, theirs, z, s, {}):
            shared |= mine
            continue
        template: dict[int, int] = {}
        for _, _, both3, z3, _, t3 in met:
            common = both.keys() & both3.keys()
            if both3 is both or not common or common <= template.keys():
                continue
            bags = (rest(zones, lines, common), rest(z, t, {both[i] for i in common}), rest(z3, t3, {both3[i] for i in common}))
            if not any(_same(a, b) for a, b in combinations(bags, 2)):
                template.update((i, both[i]) for i in common)
        if template:
            shared |= template.keys() if a_copy(mine, theirs, z, s, template) else mine
    return [z == MAIN or (z == OPEN and i not in shared) for i, z in enumerate(zones)]


def bucket_edges(keys: list[tuple[str, ...]], step: int) -> list[tuple[str, ...]]:
    """First keys of buckets of about ``step`` of the sorted keys, which begin with the host. An edge that would leave a host
    with a single key on either side moves to where that host begins or ends, so pages of a host meet others."""
    edges: list[tuple[str, ...]] = []
    last = 0
    for j in range(step, len(keys), step):
        lo, hi = bisect_left(keys, (keys[j][0], "")), bisect_right(keys, (keys[j][0], chr(0x10FFFF)))
        at = lo if j - max(lo, last) < 2 else hi if hi - j < 2 else j
        if last < at < len(keys):
            edges.append(keys[at])
            last = at
    return edges


def border_pages(keyed: DataFrame, edges: list[tuple[str, ...]]) -> dict[tuple[str, ...], list[int]]:
    """The keys of the two pages on either side of every edge, in the edge's host, with the buckets across the edge."""
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near: dict[tuple[int, bool], list[tuple[str, ...]]] = {}
        for b in batches:
            for k in zip(*(b.column(c).to_pylist() for c in KEY), strict=True):
                at = bisect_right(edges, k)
                for e, after in ((at - 1, True), (at, False)):
                    if 0 <= e < len(edges) and edges[e][0] == k[0]:
                        got = near.setdefault((e, after), [])
                        if k not in got:
                            got[:] = sorted([*got, k], reverse=not after)[:2]
        rows = [(e, after, *k) for (e, after), got in near.items() for k in got]
        cols = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.bool_(), *[pa.string()] * 4), strict=True)], names=["e", "after", *KEY])

    found = in_arrow(keyed.select(*KEY), nearest, "e int, after boolean, " + ", ".join(f"{c} string" for c in KEY))
    key = F.struct(*KEY)
    # the two nearest of each side: the ends of the sorted keys that the partitions found
    least = found.groupBy("e", "after").agg(F.array_sort(F.collect_set(key)).alias("k"))
    out: dict[tuple[str, ...], list[int]] = {}
    for r in least.select("e", "after", F.when(F.col("after"), F.slice("k", 1, 2)).otherwise(F.slice(F.reverse("k"), 1, 2)).alias("k")).collect():
        for k in r.k:
            out.setdefault(tuple(k), []).append(r.e if r.after else r.e + 1)
    return out


def extracted(pages: DataFrame, pages_a_bucket: int = 500, url_sample: int = 20_000) -> DataFrame:
    """One row per page of ``pages(page_id, url, html)``: ``page_id, url, text, n_chars``.

    Pages of a host are cut into buckets of neighbours by path, URL and page id at quantiles of a bounded sample, so a
    hot host or path is many buckets, each with the two border pages of the next ones; inside a bucket pages stream by in path order and each meets the two before and after it
    that differ from it; equal pages in a row are one.
    Null html is empty and gives an empty text; null or unreadable URLs share the empty host. Repeated pages are
    extracted alike, pages of any length whole; other columns are ignored; an empty table gives an empty result. Only lines that may be main text are shuffled, with a hash of every line.
    """
    own = pages.select("page_id", "url", "html")
    n = own.count()
    wanted = -(-n // pages_a_bucket)
    keyed = (host_and_path(own, "url").withColumn("address", _short(F.coalesce("url", F.lit(""))))
             .withColumn("number", _short(F.coalesce(F.col("page_id").cast("string"), F.lit("")))))
    picked = sorted(tuple(r) for r in bounded_sample(keyed.select(*KEY), list(KEY), list(KEY), url_sample, rows=n).collect()) if wanted > 1 else []
    edges = bucket_edges(picked, max(2, -(-len(picked) // max(1, wanted))))
    borders = border_pages(keyed, edges) if edges else {}
    schema = ("host string, bucket int, border boolean, path string, url string, page_id {id}, zones array<int>, marks array<long>, sizes array<int>, "
              "lines array<string>").format(id=own.schema["page_id"].dataType.simpleString())

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest
        for b in batches:
            keys = list(zip(*(b.column(c).to_pylist() for c in KEY), strict=True))
            zones, marks, sizes, lines = [], [], [], []
            for page in b.column("html"):
                got = lines_of(page.as_py() or "")
                zones.append([z for z, _ in got])
                marks.append([xxh64_intdigest(t.encode("utf-8", "surrogatepass")) >> 1 for _, t in got])
                sizes.append([len(t) for _, t in got])
                lines.append([t for z, t in got if z != OUT])
            bucket = [bisect_right(edges, k) for k in keys]
            made = pa.RecordBatch.from_arrays(
                [b.column("host"), pa.array(bucket, pa.int32()), pa.array([False] * len(bucket)), b.column("path"), b.column("url"),
                 b.column("page_id"), pa.array(zones, pa.list_(pa.int32())), pa.array(marks, pa.list_(pa.int64())),
                 pa.array(sizes, pa.list_(pa.int32())), pa.array(lines, pa.list_(pa.string()))],
                names=["host", "bucket", "border", "path", "url", "page_id", "zones", "marks", "sizes", "lines"])
            yield made
            across = [(i, k) for i, key in enumerate(keys) for k in borders.get(key, ())]
            if across:
                again = made.take(pa.array([i for i, _ in across]))
                yield (again.set_column(1, "bucket", pa.array([k for _, k in across], pa.int32()))
                       .set_column(2, "border", pa.array([True] * len(across))))

    parsed = in_arrow(keyed, parse, schema)
    ordered = (parsed.repartition("host", "bucket")
               .sortWithinPartitions("host", "bucket", "path", _short(F.coalesce("url", F.lit(""))), _short(F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
                                     F.xxhash64("marks")))

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, urls, texts = [], [], []
        held: list[tuple | None] = [None] * 4  # two runs before, the run at hand, the next; a run: equal pages in a row

        def done(after: tuple | None) -> None:
            page = held[2]
            if page is not None:
                others = [x[2:6] for x in (*held[:2], held[3], after) if x is not None and x[0] == page[0]]
                keep = kept_lines(*page[2:6], others)
                rest = iter(page[5])
                lines = [next(rest) if z != OUT else None for z in page[2]]
                text = "\n".join(t for t, k in zip(lines, keep, strict=True) if k)
                for url, page_id in page[1]:
                    ids.append(page_id)
                    urls.append(url)
                    texts.append(text)
            held[:] = [*held[1:], after]

        def batch(kinds: list) -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip((ids, urls, texts), kinds, strict=True)],
                                              names=["page_id", "url", "text"])
            for c in (ids, urls, texts):
                c.clear()
            return made

        kinds: list = []
        for b in batches:
            kinds = [b.schema.field("page_id").type, pa.string(), pa.string()]
            cols = [b.column(c) for c in ("url", "page_id", "zones", "marks", "sizes", "lines", "border")]
            place = zip(b.column("host").to_pylist(), b.column("bucket").to_pylist(), strict=True)
            for i, where in enumerate(place):
                url, page_id, zones, marks, sizes, lines, border = (c[i].as_py() for c in cols)
                own_page = [] if border else [(url, page_id)]
                last = held[3]
                if last is not None and last[0] == where and last[2:4] == (zones, marks):
                    last[1].extend(own_page)
                    continue
                done((where, own_page, zones, marks, sizes, lines))
                if len(ids) >= 1000:
                    yield batch(kinds)
        done(None)
        done(None)
        if ids:
            yield batch(kinds)

    out = in_arrow(ordered, difference, f"page_id {own.schema['page_id'].dataType.simpleString()}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
