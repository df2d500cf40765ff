import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketframe.llm import simhash
from marketframe.llm.components import components

from .conftest import prose


def classes(n, edges):
    at = list(range(n))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    for a, b in edges:
        a, b = root(a), root(b)
        at[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def naive(text, k=4):
    import xxhash
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


@given(st.text(alphabet="aB é\x85\t\n.", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    assert simhash.fingerprint(text.encode(), 4) & (2 ** 64 - 1) == naive(text)


def test_every_pair_within_the_radius_collides_in_some_table():
    r = random.Random(5)
    for radius in (2, 4):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            flips = r.sample(range(64), r.randint(0, radius))
            assert any(all(not m >> f & 1 for f in flips) for m in masks)


def test_links_have_the_components_of_all_pairs(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = {b ^ sum(1 << i for i in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(20)} | {0}
    fps = sorted(x - (1 << 64) if x >= 1 << 63 else x for x in fps)
    want = classes(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (2 ** 64 - 1)).bit_count() <= 4])
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for largest in (512, 2):  # 2: all larger buckets by shared points
        got = {row.a: row.b for row in simhash.near_links(df, 4, largest).limit(0).collect()}
        edges = [(fps.index(row.a), fps.index(row.b)) for row in simhash.near_links(df, 4, largest).collect()]
        assert classes(len(fps), edges) == want and not got


def test_components_of_random_graphs_chains_and_nothing(spark):
    r = random.Random(7)
    for n, edges in ((60, [(r.randrange(60), r.randrange(60)) for _ in range(45)]), (150, [(i, i + 1) for i in range(149)])):
        want = classes(n, edges)
        df = spark.createDataFrame(edges + edges[:3], "a long, b long")
        got = {row.node: row.component for row in components(df).collect()}
        assert got == {i: want[i] for i in {x for e in edges if e[0] != e[1] for x in e}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


def brute(rows):
    fps = [naive(t) for _, t in rows]
    group = classes(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    low = {}
    for g, (i, _) in zip(group, rows, strict=True):
        if i is not None:
            low[g] = min(i, low.get(g, i))
    return [(i, fps[k] - (1 << 64) if fps[k] >= 1 << 63 else fps[k], low.get(group[k])) for k, (i, _) in enumerate(rows)]


def key(row):
    return tuple((x is None, x) for x in row)


def test_groups_of_odd_rows_and_copies(spark, odd, odd_rows, empty, make_docs):
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.duplicate_groups(odd.withColumn("fp", F.lit(1)).withColumn("class", F.lit("x"))).collect()]
    assert sorted(got, key=key) == sorted(brute([r[:2] for r in odd_rows]), key=key)
    assert simhash.duplicate_groups(empty).count() == 0
    texts = [prose(k % 5, 300) + (f" extra{k}" if k % 2 else "") for k in range(60)]
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.duplicate_groups(make_docs(texts)).collect()]
    assert sorted(got) == sorted(brute(list(enumerate(texts))))


def test_deduplication_keeps_one_row_of_each_group(odd, odd_rows, empty):
    clash = odd.withColumn("copies", F.lit(1)).withColumn("FP", F.lit(2)).withColumn("class", F.lit(3))
    got = simhash.deduplicated(clash)
    assert got.columns == clash.columns
    rows = got.collect()
    groups = {(i, c) for i, _, c in brute([r[:2] for r in odd_rows])}
    named = sorted({c for _, c in groups if c is not None})
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == named
    nameless = {f for i, f, c in brute([r[:2] for r in odd_rows]) if c is None}
    assert len([r for r in rows if r.doc_id is None]) == len(nameless)
    assert simhash.deduplicated(empty).count() == 0


def test_an_id_on_unlike_texts_names_each_of_its_groups(make_docs):
    a, b, c, d = (prose(500 + k, 200) for k in range(4))
    docs = make_docs([a, b, c, b, d, d, a]).withColumn("doc_id", F.element_at(F.array(*map(F.lit, [1, 1, 2, 2, 3, 3, 4])), F.col("doc_id").cast("int") + 1))
    got = sorted((r.doc_id, r.text) for r in simhash.deduplicated(docs).collect())
    assert got == sorted([(1, a), (1, b), (2, c), (3, d)])
