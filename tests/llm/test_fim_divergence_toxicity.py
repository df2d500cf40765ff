import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketframe.llm import divergence, fim, toxicity

from .conftest import prose

# --- fill in the middle

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def fim_by_definition(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check_fim(rows, texts):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter()
    for i, t in texts:
        n, form, p, m, out = fim_by_definition(i, t)
        want[i, n, form, p, m, sha(out), sha(t or "")] += 1
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in rows)
    assert got == want


def test_fim_equals_its_definition(make_docs, odd, odd_rows, empty):
    texts = [prose(k, k % 50) for k in range(300)] + ["a <P> b", "<S>", "x<M>", "<", "<P", " \x0b\x0c ", "\x1c a\x85b c", "é\n\n ü  "] * 3
    check_fim(fim.report(make_docs(texts)).collect(), list(enumerate(texts)))
    clash = odd.withColumn("fim_n", F.lit("x")).withColumn("form", F.lit(1)).withColumn("restored", F.lit(None))
    rows = fim.report(clash).collect()
    check_fim(rows, [r[:2] for r in odd_rows])
    assert {r.form for r in rows if r.doc_id in (3, 4)} == {"plain"}
    assert fim.report(empty).count() == 0 and len(fim.report(empty).columns) == 7


def test_fim_keeps_columns_and_rebuilds_texts(make_docs):
    texts = [prose(k, 30) for k in range(50)]
    docs = make_docs(texts).withColumn("FIM_OUTPUT", F.lit("mine"))
    out, c = fim.rotated(docs, rate=100, spm=50)
    assert c["output"] not in docs.columns and set(docs.columns) <= set(out.columns)
    back = fim.unrotated(out, c["output"], c["form"]).collect()
    assert {r.doc_id: r.restored for r in back} == dict(enumerate(texts))
    assert {r[c["form"]] for r in back} == {"psm", "spm"}


@given(st.text("ab <PSM>é\n", max_size=40), st.integers(0, 40), st.integers(0, 40), st.sampled_from(["psm", "spm"]))
@settings(max_examples=400, deadline=None)
def test_rotation_and_its_inverse(text, a, b, form):
    raw = text.encode()
    if any(m in raw for m in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE)):
        return
    ends = [0, *fim.token_ends(raw)]
    assert [len(t.encode()) for t in TOKEN.findall(text)] == np.diff(ends).tolist()
    a, b = sorted((int(ends[a % len(ends)]), int(ends[b % len(ends)])))
    out = fim.transform(raw, a, b, form)
    p, m, s = raw[:a], raw[a:b], raw[b:]
    assert out == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm" else b"<S>" + s + b"<P>" + p + b"<M>" + m)
    assert fim.restore(out, form) == raw


# --- divergence

def audited_by_definition(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        c = Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")))
        counts[lang, source].update(c)
        counts[lang,].update(c)
        docs[lang].update(set(c))
    out = set()
    for lang, source in groups:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        v = len(kept)

        def p(key, kept=kept, v=v):
            n = sum(counts[key][t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[key][t] + 2) // (n + 2 * v) for t in kept}

        mine, all_ = p((lang, source)), p((lang,))
        price = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = []
        for x, other in groups:
            if x == lang and other != source:
                q = p((lang, other))
                pairs.append((sum(price(mine[t], q[t]) for t in kept), other))
        terms = [(price(mine[t], all_[t]), t) for t in kept if counts[lang, source][t] and mine[t] > all_[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            for k, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]):
                out.add((lang, source, part, item, value, k + 1))
    return out


def as_set(df):
    rows = [(r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def sourced(spark):
    from .conftest import DOCUMENTS
    rows = [(i, prose(i % 90, 10 + i % 70) + " Éa ÉA 7x7", ("en", "fr", None)[i % 5 % 3], f"s{i * i % 11}" if i % 7 else None, 1) for i in range(400)]
    rows += [(999, None, "alone", "x", 0), (1000, "", "two", "a", 0), (1001, "few words", "two", None, 0), (1002, "UP up Up", "en", "only", 1)]
    rows += [rows[3]] * 20
    return spark.createDataFrame(rows, DOCUMENTS).repartition(5), [(r[1], r[2], r[3]) for r in rows]


def test_divergence_equals_its_definition(sourced, odd, odd_rows, empty):
    docs, rows = sourced
    want = audited_by_definition(rows, 10, 10)
    assert as_set(divergence.audited(docs)) == want
    # many blocks of terms and of sources give the same
    assert as_set(divergence.audited(docs, entries_a_block=150, sources_a_block=3, broadcast_rows=0)) == want
    clash = odd.withColumn("term", F.lit("x")).withColumn("value", F.lit(None)).withColumn("n", F.lit("n"))
    assert as_set(divergence.audited(clash, min_docs=2, top_terms=3)) == audited_by_definition([(r[1], r[2], r[3]) for r in odd_rows], 2, 3)
    assert divergence.audited(empty).count() == 0


def test_one_hot_products_equal_direct_sums():
    rng = np.random.default_rng(5)
    counts = rng.geometric(0.2, (700, 5)) * rng.integers(0, 2, (700, 5))
    sizes = counts.sum(axis=0).tolist()
    p = np.stack([divergence.probabilities(counts[:, g], sizes[g], 700) for g in range(5)])
    direct = np.array([[int(divergence.price(p[g], p[h]).sum()) for h in range(5)] for g in range(5)])
    every = list(range(5))
    assert (divergence.pair_sums(counts, every, every, sizes, 700) == direct).all()
    assert (divergence.pair_sums(counts, every, every, sizes, 700, widest=20) == direct).all()
    assert (divergence.pair_sums(counts, [0, 2], [1, 3, 4], sizes, 700) == direct[np.ix_([0, 2], [1, 3, 4])]).all()
    huge = divergence.probabilities(np.array([0, 10 ** 13]), 10 ** 13, 5)
    assert huge.tolist() == [1 + 2 * 10 ** 9 // (10 ** 13 + 10), 1 + 10 ** 9 * (10 ** 13 + 2) // (10 ** 13 + 10)]


# --- toxicity

def random_vectors(rng, n, terms, most):
    idf = rng.uniform(1, 5, terms)
    return [toxicity.unit(sorted((int(t), int(rng.integers(1, 4))) for t in set(rng.integers(0, terms, rng.integers(0, most)))), idf) for _ in range(n)], idf


@pytest.mark.parametrize("n,terms,most,k", [(500, 60, 12, 7), (40, 5, 4, 50), (1, 3, 3, 2), (300, 2, 2, 5), (0, 4, 3, 2)])
def test_block_max_search_is_exact(n, terms, most, k):
    rng = np.random.default_rng(n + terms)
    vectors, idf = random_vectors(rng, n, terms, most)
    dense = np.zeros((n, terms))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    index = toxicity.BlockMaxIndex(vectors, terms, block=8)
    for j in range(60):
        t, w = random_vectors(rng, 1, terms, most)[0][0]
        q = np.zeros(terms)
        q[t] = w
        less = j % n if n and j % 3 == 0 else -1
        all_ = dense @ q
        if less >= 0:
            all_[less] = 0
        got, cosine = index.nearest(t, w, k, less)
        want = np.sort(all_[all_ > 0])[::-1][:k]
        np.testing.assert_allclose(cosine, want, atol=1e-12)
        np.testing.assert_allclose(all_[got], cosine, atol=1e-12)
        assert len(set(got.tolist())) == len(got) and less not in got.tolist()


BAD = ["zonk", "glarb", "frimp", "Ömpf"]


@pytest.fixture(scope="module")
def marked(spark):
    from .conftest import DOCUMENTS
    rows, marks = [], []
    for i in range(700):
        words = prose(i, 60 + i % 90).split()
        toxic = i % 6 == 0
        if toxic:
            for j in range(3):
                words.insert((i * 7 + j * 13) % len(words), BAD[(i + j) % 4])
        rows.append((i, " ".join(words), "en", "s", 1))
        if i % 7 != 3:
            marks.append((i, int(toxic)))
    return spark.createDataFrame(rows, DOCUMENTS).repartition(4), spark.createDataFrame(marks, "doc_id long, toxic int"), rows, dict(marks)


def toxicity_by_definition(rows, marks, k=15, least_docs=5, least_z=4.0, least_ratio=2.0):
    """The scores by dense cosines with every example."""
    terms_of = lambda t: re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t.lower())
    known = sorted(i for i in marks if zlib.crc32(str(i).encode()) % 5)
    texts = {r[0]: Counter(terms_of(r[1])) for r in rows}
    y = np.array([marks[i] for i in known])
    docs = [Counter(), Counter()]
    for i in known:
        docs[marks[i]].update(set(texts[i]))
    n, m = (y == 0).sum(), (y == 1).sum()
    terms = []
    for t in {*docs[0], *docs[1]}:
        a, b = docs[0][t], docs[1][t]
        p = (a + b) / (n + m)
        x, y_ = (a + .5) / (n + .5), (b + .5) / (m + .5)
        if a + b >= least_docs and max(x / y_, y_ / x) >= least_ratio and abs(b / m - a / n) / math.sqrt(p * (1 - p) * (1 / n + 1 / m)) >= least_z:
            terms.append(t)
    idf = np.array([math.log((1 + n + m) / (1 + docs[0][t] + docs[1][t])) + 1 for t in terms])

    def vector(c):
        v = np.array([1 + math.log(c[t]) if c[t] else 0 for t in terms]) * idf
        return v / (np.linalg.norm(v) or 1)

    x = np.stack([vector(texts[i]) for i in known])

    def vote(s):
        top = np.argsort(-s, kind="stable")[:k]
        w = np.maximum(s[top], 0) ** 2
        return (w @ y[top] + toxicity.PRIOR * m / (n + m)) / (w.sum() + toxicity.PRIOR)

    own = x @ x.T
    np.fill_diagonal(own, -1)
    a, b = toxicity.fitted_curve(np.array([vote(s) for s in own]), y, np.ones(len(y)))
    share = {i: vote(x @ vector(c)) for i, c in texts.items()}
    return {i: 1 / (1 + math.exp(-(a * math.log(s / (1 - s)) + b))) for i, s in share.items()}


def test_toxicity_equals_brute_force_and_tells_labels_apart(marked):
    docs, labels, rows, marks = marked
    got = toxicity.report(docs, labels).collect()
    want = toxicity_by_definition(rows, marks)
    assert len(got) == len(rows)
    # neighbours of equal cosine may be taken in another order, so a few votes differ
    assert np.mean([abs(r.score - want[r.doc_id]) < 1e-6 for r in got]) > 0.95
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5) and (r.doc_id % 6 == 0) == bool(r.predicted)
        assert list(r.near_cosines) == sorted(r.near_cosines, reverse=True)
        assert all(zlib.crc32(str(i).encode()) % 5 and marks[i] == y for i, y in zip(r.near_ids, r.near_toxic, strict=True))
    # held-out labels do not matter
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in toxicity.report(docs, flipped).collect()} == {r.doc_id: r.score for r in got}


def test_toxicity_of_odd_rows_and_bounds(spark, marked, odd, odd_rows, empty):
    docs, labels, _, _ = marked
    none = labels.where("false")
    rows = toxicity.report(odd.withColumn("score", F.lit("x")).withColumn("tox_score", F.lit(1)), none).collect()
    assert len(rows) == len(odd_rows) and {r.score for r in rows} == {0.0} and not any(r.held_out for r in rows if r.doc_id is None)
    same = toxicity.report(odd, spark.createDataFrame([(1, 1), (2, 1), (None, 0), (6, None)], "doc_id long, toxic int")).collect()
    assert {r.score for r in same} == {1.0}
    assert toxicity.report(empty, labels).count() == 0
    # a text of repeated words, a null, an empty one, and several labels and texts of one id
    more = docs.unionAll(odd.where("doc_id is null or doc_id in (3, 4, 7)").select(docs.columns)).unionAll(docs.where("doc_id < 30"))
    twice = labels.unionAll(labels.withColumn("toxic", F.lit(0)))
    rows = toxicity.report(more, twice).collect()
    assert len(rows) == more.count()
    assert {r.predicted for r in rows if r.doc_id is not None and r.doc_id >= 30} == {0, 1}
    model = toxicity.fit(docs, labels, most_examples=60, least_docs=2)
    assert len(model.ids) == 60 and model.toxic.sum() == 30
    assert model.weight[model.toxic == 0].mean() > model.weight[model.toxic == 1].mean()
