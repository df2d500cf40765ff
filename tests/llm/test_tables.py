import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketframe.llm import embed_dedup, pages, sharding

from .conftest import prose


# --- shards

@given(st.lists(st.integers(1, 200), max_size=40), st.integers(1, 6))
@settings(max_examples=200, deadline=None)
def test_differencing_gives_every_item_a_shard_and_balances(sizes, shards):
    to = sharding.karmarkar_karp(sizes, shards)
    assert len(to) == len(sizes) and all(0 <= s < shards for s in to)
    held = np.bincount(to, weights=sizes, minlength=shards) if sizes else np.zeros(shards)
    assert held.max() - held.min() <= max(sizes, default=0)


def check_shards(rows, texts, shards):
    assert len(rows) == len(texts)
    slots, group = defaultdict(list), {}
    for r in rows:
        slots[r.shard].append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    by = defaultdict(set)
    size = {}
    for i, t in texts:
        raw = (t or "").encode()
        size[i] = (len(raw) + 8, zlib.crc32(raw))
        group[i] = raw
    for r in rows:
        if r.doc_id is not None:
            assert (r.size, r.text_crc32) == size[r.doc_id]
            by[group[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in by.values())
    held = np.zeros(shards)
    for r in rows:
        held[r.shard] += r.size
    return held


def test_shards_are_even_and_keep_copies_together(make_docs, odd, odd_rows, empty):
    texts = [prose(k, 5 + k % 60) for k in range(600)] + [prose(7, 40)] * 30 + [None, ""]
    held = check_shards(sharding.sharded(make_docs(texts), shards=6, rows_a_block=50).collect(), list(enumerate(texts)), 6)
    assert held.max() - held.min() <= 0.01 * held.mean()
    clash = odd.withColumn("shard", F.lit("x")).withColumn("unit", F.lit(1)).withColumn("size", F.lit(None))
    check_shards(sharding.sharded(clash, shards=4).collect(), [r[:2] for r in odd_rows], 4)
    assert sharding.sharded(empty).count() == 0
    hot = [prose(1, 400)] * 200 + [prose(k, 10) for k in range(200)]  # one group is most of the bytes
    held = check_shards(sharding.sharded(make_docs(hot), shards=4).collect(), list(enumerate(hot)), 4)
    assert np.ptp(sorted(held)[:3]) <= 100


# --- vectors

def brute_links(rows, cosine=0.93):
    import math
    good = [(i, np.array(e, float), label) for i, e, label in rows if i is not None and label is not None and e and
            all(x is not None and math.isfinite(x) for x in e) and any(e)]
    n = defaultdict(int)
    comp = {i: i for i, _, _ in good}
    links = [(a[0], b[0]) for k, a in enumerate(good) for b in good[:k] if a[2] == b[2] and len(a[1]) == len(b[1])
             and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= cosine]
    for a, b in links:
        n[a] += 1
        n[b] += 1
    for _ in range(len(good)):
        before = dict(comp)
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
        if comp == before:
            break
    return {i: (n[i], comp.get(i, i)) for i, _, _ in rows if i is not None}


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(6)
    rows = []
    for k in range(500):
        rows.append((len(rows), r.normal(size=32).tolist(), k % 2))
    for c in range(12):
        base = r.normal(size=32)
        for _ in range(12):
            rows.append((len(rows), (base + r.normal(size=32) * 0.2).tolist(), 0))
    base = r.normal(size=32)
    rows += [(len(rows) + k, (base + r.normal(size=32) * 0.05).tolist(), 1) for k in range(150)]  # a dense cluster
    copy = r.normal(size=32).tolist()
    rows += [(len(rows) + k, copy, 1) for k in range(40)]
    rows += [(len(rows), [2 * x for x in copy], 1), (len(rows) + 1, copy, 0), (len(rows) + 2, copy, None)]
    return rows


def test_forest_finds_links_and_no_other(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").repartition(4)
    exact = {r.vec_id: (r.embedding, r.label) for r in df.collect()}
    want = brute_links([(i, exact[i][0], exact[i][1]) for i, _, _ in vectors])
    for leaf in (10_000, 64):  # one leaf a label; many leaves, the dense ones in blocks
        got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.linked(df, trees=6, leaf=leaf).collect()}
        assert all(got[i][0] <= want[i][0] and got[i][1] >= want[i][1] for i in want)
        if leaf > 1000:
            assert got == want
        else:
            assert sum(g[0] for g in got.values()) >= 0.98 * sum(w[0] for w in want.values())
            assert np.mean([got[i][1] == want[i][1] for i in want]) > 0.99


def test_a_label_that_no_tree_splits_is_compared_whole_and_once(spark):
    """Alike vectors, above a leaf's size but without a cut, beside a label that splits: every link of the first, counted once."""
    r = np.random.default_rng(5)
    base = r.normal(size=32)
    rows = [(k, (base + r.normal(size=32) * 0.1).tolist(), 1) for k in range(300)]
    rows += [(300 + k, r.normal(size=32).tolist(), 2) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.linked(df, leaf=64).where("vec_id < 300").collect()}
    assert got == {i: w for i, w in brute_links(rows).items() if i < 300}


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, 0.0], 1), (4, None, 1), (5, [], 1), (6, [1.0, None], 1), (7, [nan, 1.0], 1),
            (8, [inf, 1.0], 1), (9, [1.0, 0.0], None), (10, [1.0, -0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [3e38, 1e30], 1), (13, [1e-38, 0.0], 1)]
    df = spark.createDataFrame(rows + [(None, [1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit("x"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.linked(df).collect()}
    assert got.pop(None) == (0, None)
    linked = {1, 2, 10, 12, 13}
    assert got == {i: (4, 1) if i in linked else (0, i) for i in got}
    assert embed_dedup.linked(df.limit(0)).count() == 0
    twice = spark.createDataFrame([rows[0], rows[0]], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in embed_dedup.linked(twice).collect()] == [(1, 1, 1, True)] * 2


# --- pages

@given(st.lists(st.integers(0, 9), max_size=12, unique=True), st.lists(st.integers(0, 9), max_size=12, unique=True))
@settings(max_examples=300, deadline=None)
def test_common_subsequence_is_longest(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
    left, right = pages.common_subsequence(a, b)
    assert len(left) == len(right) == best[-1, -1]
    assert [a[i] for i in sorted(left)] == [b[j] for j in sorted(right)]


def test_lines_and_zones():
    def lines(page):
        return [t for z, t in pages.lines_of(page) if z != pages.OUT]
    assert lines("<p>a<br>b &amp;amp; c&nbsp;\n d<p>e<div class='ad-slot'>x</div>f") == ["a b &amp; c d", "e", "f"]
    assert lines("<body><header>H</header><main><article><header><h1>T</h1></header><p>x <b>y</b>z</p><section class=comments><p>c"
                 "</p></section></article></main><footer>f") == ["T", "x yz"]
    assert lines("<script>var t='</p><p>';</script><style>p{}</style><p>ok</p><!-- <p>no</p> --><form><p>no</p></form><p title='a>b'>2") == ["ok", "2"]
    assert lines("<title>no</title><nav><ul><li>no<li>no</ul></nav><div id=cookie-banner>no</div><aside>no</aside>yes<p hidden>no") == ["yes"]
    assert lines("") == [] and lines("plain < text") == ["plain < text"] and lines("<p>a</p") == ["a"]


ARTICLE = "<article><h1>Head</h1><p>Some text.</p></article>"


@pytest.mark.parametrize("page,want", [
    ('<div class="layout has-sidebar"><main><p>Some text.</p></main></div>', ["Some text."]),
    (f'<div class="page comments-closed related-none">{ARTICLE}</div>', ["Head", "Some text."]),
    (f'<section class="no-menu">{ARTICLE}</section>', ["Head", "Some text."]),
    (f'<div class="sidebar">{ARTICLE}</div>', ["Head", "Some text."]),  # nothing else is the article
    (f'{ARTICLE}<div class="sidebar"><article>Teaser</article></div>', ["Head", "Some text."]),
    (f'<form id="aspnetForm"><label>Find</label><select><option>x</select>{ARTICLE}<button>go</button></form>', ["Head", "Some text."]),
    ('<form><p>Your name</p><h3>Write to us</h3><input></form><p>Some text.</p>', ["Some text."]),
    ('<article><p class="related">Some text.</p><div class="related-links">no</div><p>More.</p></article>', ["Some text.", "More."]),
    ('<article><p>Some text.</p><section class="comments"><article>no</article></section><article class="comment">no</article></article>', ["Some text."]),
    ('<div class="sidebar"><main><p>Some text.</p><div class="share-buttons">no</div><article>More.</article></main></div>', ["Some text.", "More."]),
    ('<div class="site-header">no</div><div id="main-nav">no</div><div class="entry-header">Some text.</div>', ["Some text."]),
    ("<article><p><a title=don't href=x>link</a> text</p><p>It's two</p></article>", ["link text", "It's two"]),
    ('<p class="a"">One</p><p class="b">Two</p>', ["One", "Two"]),
    ('<p class="a>One</p>', ["One"]),
    ("<p class='a>One</p>", ["One"]),
    ('<p title = "a>b" class=x>One</p>', ["One"]),
])
def test_names_and_quotes_lose_no_article(page, want):
    assert [t for z, t in pages.lines_of(page) if z != pages.OUT] == want


def test_a_very_long_page_is_whole(spark):
    text = [prose(k, 40) for k in range(6000)]
    page = "<nav>no</nav><article>" + "".join(f"<p>{t}</p>" for t in text) + "</article>"
    rows = [(1, "https://a.example/" + "x" * 5000, page), (2, "https://a.example/" + "x" * 5001, "<article>b</article>")]
    got = {r.page_id: r.text for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "\n".join(text), 2: "b"}


def test_hostile_markup_takes_linear_time():
    import time
    t0 = time.time()
    for page in ("<div " * 100_000, "<p>" * 100_000, "<" * 100_000, "<!--" * 100_000, '<a "' * 50_000, "<b>" * 50_000 + "</i>" * 50_000,
                 "<b>" * 50_000 + "<li></li>" * 50_000, "<div><b>" * 30_000 + "</p>" * 30_000, "<script>" * 50_000, "&" * 100_000, "<a =\"" * 50_000, "<a ='" * 50_001, "<a = = =" * 50_000, "<form>" * 50_000 + ARTICLE):
        pages.lines_of(page)
    assert time.time() - t0 < 30


def test_template_lines_go_by_differencing(spark):
    rows = []
    for host in ("a.example", "b.example"):
        for k in range(30):
            own = "".join(f"<div>{prose(k * 10 + j + 1000 * (host[0] == 'b'), 15)}</div>" for j in range(4))
            rows.append((len(rows), f"https://{host}/x/{k:03d}?q=1", f"<div>Welcome to {host}</div><div>Latest</div>{own}<div>All rights of {host}</div>"))
    lone = (900, "https://lone.example/", "<div>only page</div><article><p>Body.</p></article>")
    copies = [(901, "https://c.example/1", "<div>same text</div><div>more of it</div>"), (902, "https://c.example/2", "<div>same text</div><div>more of it</div>")]
    odd = [(903, None, "<p>no url</p>"), (904, "::", None), (None, "https://z.example/zz", "<article><p>Body.</p></article>"), lone, lone, *copies]
    df = spark.createDataFrame(rows + odd, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("x"))
    out = pages.extracted(df, pages_a_bucket=10).collect()
    got = {r.page_id: r.text for r in out}
    for i, _, page in rows:
        want = [t for _, t in pages.lines_of(page)][2:-1]
        assert got[i].split("\n") == want
    assert got[900] == "only page\nBody." and got[901] == got[902] == "same text\nmore of it" and got[903] == "no url" and got[904] == ""
    assert len(out) == len(rows) + len(odd) and all(r.n_chars == len(r.text) for r in out)
    assert pages.extracted(df.limit(0)).count() == 0


def test_template_longer_than_the_own_text_goes(spark):
    top, foot = "<div>Welcome to the shop of many small things</div><div>All prices with tax</div>", "<div>Write to us or come by, we are open all week</div>"
    rows = [(k, f"https://s.example/p/{k:02d}", f"{top}<div>{prose(k + 50, 8)[:60]}</div>{foot}") for k in range(12)]
    # copies that differ by a number stay whole
    same = "".join(f"<div>{prose(900 + j, 12)}</div>" for j in range(3))
    rows += [(k, f"https://t.example/c/{k}", f"{same}<div>Printed copy number {k}</div>") for k in range(20, 24)]
    # a copy among pages of a template neither saves the template nor loses its text
    rows += [(k, f"https://u.example/p/{k}", f"{top}<div>{prose(70 + max(k, 31), 8)[:60]}</div>{foot}") for k in range(30, 36)]
    got = {r.page_id: r.text for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, _, page in rows:
        texts = [t for _, t in pages.lines_of(page)]
        assert got[k].split("\n") == (texts if 20 <= k < 24 else texts[2:3])


def test_equal_paths_are_many_buckets_with_border_pages(spark):
    top = "<div>Welcome to the shop</div>"
    # a line that only two pages in a row share: a bucket's edge must not part them
    rows = [(k, None if k < 60 else f"https://i.example/index.php?id={k:03d}",
             f"{top}<div>{prose(k + 300, 20)}</div><div>{prose((k + k // 60) // 2 + 800, 9)}</div>") for k in range(10, 110)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = pages.extracted(df, pages_a_bucket=10).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for some in ([r for r in got if r.page_id < 60], [r for r in got if r.page_id >= 60]):
        assert len({r.part for r in some}) > 1
    whole = {r.page_id: r.text for r in pages.extracted(df, pages_a_bucket=1000).collect()}
    assert {r.page_id: r.text for r in got} == whole and len(got) == len(rows)
    assert all(t.split("\n") == [prose(k + 300, 20)] for k, t in whole.items() if k not in (10, 59, 60, 109))
