import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketframe.llm import langid, lm_score, pii, quality

from .conftest import prose

SF01 = "/root/testdata/sf0.01"


# --- quality

def test_em_finds_accurate_and_blind_labellers():
    r = random.Random(2)
    names = list(quality.LABELLERS)
    hist = {}
    truth = []
    for _ in range(4000):
        good = r.random() < 0.8
        votes = []
        for k in range(len(names)):
            hit = r.random() < (0.9 if k < 6 else 0.02)
            votes.append("." if good else "-" if hit else ".")
        p = "".join(votes)
        hist[p] = hist.get(p, 0) + 1
        truth.append((p, good))
    m = quality.expectation_maximisation(hist)
    assert abs(m.prior - 0.8) < 0.02
    assert all(m.bad[k, 0] > 0.85 for k in range(6)) and all(m.bad[k, 0] < 0.1 for k in range(6, len(names)))
    assert np.mean([(m.posterior(p) > 0.5) == g for p, g in truth]) > 0.99
    assert quality.expectation_maximisation({}).prior == 0.8


def test_quality_on_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classified(docs).join(labels, "doc_id").select("kept", "quality").collect()
    kept = [r.kept for r in got if r.quality == 1]
    lost = [not r.kept for r in got if r.quality == 0]
    assert np.mean(kept) > 0.98 and np.mean(lost) > 0.9


def test_quality_of_odd_rows(odd, empty):
    rows = quality.classified(odd.withColumn("quality_votes", F.lit(1)).withColumn("score", F.lit(2))).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in rows)
    assert all(r.score == 0 and not r.kept for r in rows if r.doc_id in (3, 4, 5))
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert quality.classified(empty).count() == 0 and quality.accepted(empty).columns == empty.columns


# --- language

def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150 and np.mean([r.lang == r.lang_pred for r in got]) > 0.97


def test_language_of_odd_rows(spark, odd, empty):
    rows = langid.report(odd.withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1))).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    assert langid.report(empty).count() == 0
    assert {r.lang_pred for r in langid.report(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_windows_hold_every_filter_place():
    for n in (1, 5, 255, 256, 257, 509, 510, 1000):
        line = bytes(random.Random(n).randrange(1, 255) for _ in range(n))
        x = langid.windows_of(line)
        for w in langid.WIDTHS:
            seen = {bytes(v[i:i + w]) for v in x for i in range(langid.LENGTH - w + 1)}
            assert all(line[i:i + w] in seen for i in range(n - w + 1))


def test_convolution_by_pairs_equals_single_places():
    net, x = langid.ByteNet(["a", "b"]), np.random.default_rng(0).integers(0, 256, (5, langid.LENGTH)).astype(np.uint8)
    plain = net.probabilities(x)
    assert np.allclose(net.ready().probabilities(x), plain, atol=1e-5)


# --- personal data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
         "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for k, p in PLAIN.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if k == "ip" else True,
                  "card": 12 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[k]
            if ok:
                out.append((*m.span(), k))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@given(st.text(alphabet=st.sampled_from("ab0124589.@-+ ()%_é\n²"), max_size=60))
@settings(max_examples=1500, deadline=None)
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_of_long_runs_take_linear_time():
    import time
    t0 = time.time()
    for c in ("a", "1", "1.", "a@", "+1", "1 ", "+(", "1-"):
        pii.base_spans(c * 100_000)
    assert time.time() - t0 < 20


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 6), st.sampled_from(pii.KINDS), st.floats(0.1, 1)), max_size=8))
@settings(max_examples=200, deadline=None)
def test_reconciled_spans_are_the_best_set_without_overlaps(items):
    from itertools import combinations
    found = [(s, s + n, k, p) for s, n, k, p in items]
    best = {}
    for s, e, k, p in found:
        best[s, e, k] = max(p, best.get((s, e, k), 0))
    got = pii.reconciled(found)
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))
    top = max((sum(best[x] for x in c) for n in range(len(best) + 1) for c in combinations(best, n)
               if all(a[1] <= b[0] or b[1] <= a[0] for a, b in combinations(c, 2))), default=0)
    assert sum(best[x] for x in got) == pytest.approx(top)


def test_tagger_gradient():
    g = pii.Tagger(embed=3, hidden=2)
    g.w = {k: v.astype(np.float64) for k, v in g.w.items()}
    r = np.random.default_rng(0)
    x, y = r.integers(0, 131, (3, 7)), np.array([[0, 1, 2, 2, 0, 0, 0], [0, 0, 3, 4, 0, 5, 6], [0] * 7])
    _, grad = g.gradient(x, y)
    for k, w in g.w.items():
        i = (x[0, 1], 1) if k == "E" else (0, 1) if k == "T" else tuple(int(r.integers(0, s)) for s in w.shape)
        old, w[i] = w[i], w[i] + 1e-4
        up = g.gradient(x, y)[0]
        w[i] = old - 1e-4
        down = g.gradient(x, y)[0]
        w[i] = old
        assert (up - down) / 2e-4 == pytest.approx(float(grad[k][i]), abs=2e-3, rel=2e-2)


@pytest.fixture(scope="module")
def people(make_docs):
    r = random.Random(4)

    def card():
        d = "4" + "".join(str(r.randrange(10)) for _ in range(14))
        return next(d + str(k) for k in range(10) if pii.luhn(d + str(k)))

    def phone():
        return f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}"

    kinds = [card, phone, lambda: f"{prose(r.random(), 1).strip('.').lower()}.{r.randrange(99)}@mail{r.randrange(9)}.example.com",
             lambda: ".".join(str(r.randrange(10, 255)) for _ in range(4))]
    texts = [f"{prose(k, 12)} {kinds[k % 4]()} {prose(k + 500, 10)}" for k in range(400)]
    texts += [f"{prose(k, 5)} {phone()} {card()} {prose(k, 5)}" for k in range(20)]
    return make_docs(texts), texts


def test_tagger_adds_what_the_patterns_drop_and_keeps_the_rest(people):
    docs, texts = people
    tagger = pii.fit(docs, sample=600, epochs=8)
    found = pii.find_spans(texts, tagger)
    assert all(set(b) <= set(a) and b == plain_spans(t) for t, (b, a) in zip(texts, found, strict=True))
    both = [{k for _, _, k in a} for _, a in found[400:]]
    assert np.mean([x == {"card", "phone"} for x in both]) > 0.5  # the base patterns find no phone there
    clean = [prose(k, 60) + " in 1999, 12.5 and 1,234,567 of 2024-01-30." for k in range(50)]
    assert sum(len(a) for _, a in pii.find_spans(clean, tagger)) <= 1


def test_pieces_cut_by_window_edges_are_joined():
    e, c = "email", "card"
    whole = (5, 20, e, 0.9, False, False)
    assert pii.joined_pieces([whole]) == [(5, 20, e, 0.9)]
    assert pii.joined_pieces([(40, 96, e, 0.9, False, True), (48, 110, e, 0.8, True, False)]) == [(40, 110, e, 0.8)]
    # over three windows, and pieces without the other half or of another kind
    assert pii.joined_pieces([(40, 96, e, 0.9, False, True), (48, 144, e, 0.8, True, True), (96, 150, e, 0.7, True, False)]) == [(40, 150, e, 0.7)]
    assert pii.joined_pieces([(40, 96, e, 0.9, False, True), (48, 110, c, 0.8, True, False), (200, 210, e, 0.9, True, False)]) == []
    path = np.zeros(pii.WIDTH, int)
    path[:3], path[90], path[91:] = 2, 1, 2  # the end of a span that began before, and the start of one that goes on
    got = pii._window_spans(path, np.ones(pii.WIDTH), 48, pii.WIDTH, 500)
    assert got == [(48, 51, e, 1.0, True, False), (138, 144, e, 1.0, False, True)]


def test_an_added_span_may_widen_a_base_one_of_its_kind():
    t = "an müller@example.com, x"
    b = pii.base_spans(t)
    assert [t[s:e] for s, e, _ in b] == ["ller@example.com"]
    assert pii._agrees(t, 3, 21, "email", b) and not pii._agrees(t, 3, 21, "card", b) and not pii._agrees(t, 0, 21, "email", b)
    assert not pii._agrees(t, 5, 21, "email", b) and not pii._agrees(t, 7, 21, "email", b) and pii._agrees(t, 22, 24, "email", b)


def test_labellers_take_other_scripts_for_text():
    text = "Сегодня утром мы пошли в старый парк, где растут высокие деревья и поют птицы. " * 4
    votes = dict(zip(quality.LABELLERS, quality.votes_of(quality.measured(text.encode())), strict=True))
    assert votes["stop_words"] == "_" and votes["word_length"] == "." and votes["odd_words"] == "."
    chinese = quality.votes_of(quality.measured(("今天早上我们去了老公园那里长着高大的树木。 " * 12).encode()))
    assert dict(zip(quality.LABELLERS, chinese, strict=True))["word_length"] == "_"
    latin = quality.measured("Élan “vérité” où déjà çà et là, naïveté, cœur – œuvre. ".encode() * 8)
    assert latin.foreign < 0.2 and latin.unspaced == 0


def test_every_language_is_a_class(spark):
    import itertools
    words = ["".join(x) for x in itertools.islice(itertools.product("abcdefgh", repeat=3), 300)]
    rows = [(f"l{i:03d}", f"{w} {w}{w} {w}") for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = langid.training_windows(df, 500, 4, 600).collect()
    assert {r.lang for r in got} == {r[0] for r in rows} and len(got) <= 600


def test_report_and_redaction_of_odd_rows(odd, empty):
    clash = odd.withColumn("spans", F.lit(1)).withColumn("redacted", F.lit(2)).withColumn("base", F.lit(3))
    rows = {r.doc_id: r for r in pii.report(clash).collect()}
    assert (rows[9].n_email, rows[9].n_phone, rows[9].n_ip, rows[9].n_card) == (1, 1, 0, 0)
    assert rows[9].spans == "email:6:26,phone:27:44" and rows[3].spans == ""
    out = pii.redacted(clash)
    assert out.columns == clash.columns and out.schema["n_chars"].dataType == odd.schema["n_chars"].dataType
    got = {r.doc_id: r for r in out.collect()}
    assert got[9].text == "é 123 [EMAIL] [PHONE]" and got[9].n_chars == len(got[9].text) and got[3].text is None
    assert pii.report(empty).count() == 0 and pii.redacted(empty).count() == 0


# --- language model scores

def brute_scores(rows, good):
    """Every document under counts of all other documents, straight from the definition."""
    from collections import Counter
    import math
    lines = [[b"<s>", *(t or "").encode().lower().split(), b"</s>"] for _, t in rows]
    v = len({w for s in lines for w in s[1:]})

    def counts(use):
        pairs, words = Counter(), Counter()
        for keep, s in zip(use, lines, strict=True):
            if keep:
                pairs.update(zip(s, s[1:]))
                words.update(s)
        return pairs, words

    wanted = [i in good for i, _ in rows]
    out = []
    for k, (i, _) in enumerate(rows):
        s, row = lines[k], [i, len(lines[k]) - 1]
        for use in (wanted, [True] * len(rows)):
            pairs, words = counts([u and j != k for j, u in enumerate(use)])
            total = sum(words.values()) - words[b"<s>"]
            row.append(np.mean([-math.log((pairs[a, b] + 20 * (words[b] + .5) / (total + .5 * v)) / (words[a] + 20)) for a, b in zip(s, s[1:])]))
        out.append(tuple(row))
    return out


def test_scores_equal_brute_force(spark, odd, odd_rows, empty, make_docs):
    texts = [prose(k % 40, 60) for k in range(90)]
    good = spark.createDataFrame([(k,) for k in range(0, 120, 3)] + [(None,), (3,)], "doc_id long")
    clash = odd.withColumn("block", F.lit("x")).withColumn("target", F.lit(None)).withColumn("ids", F.lit(1))
    for docs, rows in ((make_docs(texts, 4), list(enumerate(texts))), (clash, [r[:2] for r in odd_rows])):
        # one block a task and one partition; many of both, and ids too many to broadcast
        for bounds in ({}, {"block_tokens": 300, "part_tokens": 700, "broadcast_ids": 1}):
            got = lm_score.scored(docs, good, **bounds).collect()
            want = brute_scores(rows, set(range(0, 120, 3)))
            order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
            for g, w in zip(sorted([tuple(r)[:4] for r in got], key=order), sorted(want, key=order), strict=True):
                assert g[:2] == w[:2] and g[2:] == pytest.approx(w[2:], rel=1e-12)
    assert lm_score.scored(empty, good).count() == 0
    assert lm_score.scored(odd, good.limit(0)).count() == odd.count()


@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=50), st.integers(1, 9))
@settings(max_examples=100, deadline=None)
def test_codes_pack_and_cut(codes, parts):
    c = np.unique(np.array(codes, np.uint64))
    assert (lm_score.unpacked_codes(lm_score.packed_codes(c)) == c).all()
    cuts = lm_score.cuts_of(c, parts)
    assert cuts[0] == 0 and cuts[-1] == len(c) and (np.diff(cuts) >= 0).all()
    part = np.repeat(np.arange(parts), np.diff(cuts))
    assert part.tolist() == [int(x) * parts >> 64 for x in c.tolist()]
    pair, word = lm_score.pairs_of(lm_score.numbers_of([str(x).encode() for x in codes]))
    assert not lm_score.is_word(pair).any() and lm_score.is_word(word).all()
