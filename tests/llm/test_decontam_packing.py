import re
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketframe.llm import decontam, packing

from .conftest import prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(text, items, k=10):
    words, hit, who = WORD.findall(lower(text)), set(), set()
    for item, t in items:
        own = WORD.findall(lower(t))
        for i in range(max(1, len(own) - k + 1) if own else 0):
            w = own[i:i + k]
            for j in range(len(words) - len(w) + 1):
                if words[j:j + len(w)] == w:
                    hit.update(range(j, j + len(w)))
                    who.add(str(item))
    return len(words), len(hit), sorted(who)


def cases():
    items = [(1, prose(90, 25)), (2, "short one"), (3, None), (4, ""), (10, prose(91, 12)), (1, prose(90, 25)), (5, "... !!")]
    texts = [prose(1, 50) + " " + prose(90, 25).upper() + "\n" + prose(2, 30), "x Short--ONE, y short one one", None, "", "...",
             prose(91, 12), prose(91, 12)[:-30], prose(5, 20_000), "a b", "shortone", " ".join(prose(90, 25).split()[3:14])]
    return items, texts


def test_hits_and_items_equal_brute_force(spark, make_docs):
    items, texts = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(texts).withColumn("bench_hit", F.lit(1)).withColumn("item_id", F.lit(2))
    for most in (32 << 20, 60):  # one automaton, then several blocks
        out, c = decontam.marked(docs, bench, most_bytes=most)
        got = {r.doc_id: (r[c["words"]], len(r[c["hit"]]), list(r[c["items"]])) for r in out.collect()}
        assert got == {i: brute(t, items) for i, t in enumerate(texts)}
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in decontam.hit_spans(*decontam.marked(docs, bench)).collect()}
    assert texts[1][slice(*spans[1][0])] == "Short--ONE" and texts[0][slice(*spans[0][0])].lower() == prose(90, 25).lower().rstrip(".")


def test_decontamination_of_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, "tail")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminated(odd, bench).count() == odd.count() - 1
    assert decontam.decontaminated(odd, none).count() == odd.count()
    assert decontam.decontaminated(odd, bench).columns == odd.columns
    assert decontam.report(empty, bench).count() == 0
    blank = decontam.report(odd, bench).where("doc_id = 3").first()
    assert (blank.n_words, blank.n_hit, blank.contaminated) == (0, 0, False)
    assert blank.items_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


HARD = st.text(alphabet=st.sampled_from("aBé'sll ,.!ſİΣßü²12_-\n\t\x1c\x85́中…»|<"), max_size=40)


@given(HARD)
@settings(max_examples=300, deadline=None)
def test_word_cache_gives_the_tokenizers_ids(text):
    ids = packing._word_ids(packing.tokenizer_path())
    want = ids.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids.encode(text.encode()), "<u4").tolist() == want


def test_special_tokens_and_bounded_cache(monkeypatch):
    ids = packing._word_ids(packing.tokenizer_path())
    for text in ("a<|endoftext|>b", "<|STARTOFTEXT|> <|startoftext|>x, Y", prose(8, 500)):
        want = ids.tokenizer.encode(text, add_special_tokens=False).ids
        monkeypatch.setattr(packing, "WORD_CACHE", 10)
        assert np.frombuffer(ids.encode(text.encode()), "<u4").tolist() == want


@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=200, deadline=None)
def test_best_fit_places_without_overlap(sizes):
    bins, offsets, fill = packing.placed(sizes, 50)
    spans = defaultdict(list)
    for b, o, s in zip(bins, offsets, sizes, strict=True):
        spans[b].append((o, o + s))
    for b, own in spans.items():
        own.sort()
        assert own[0][0] == 0 and all(x[1] == y[0] for x, y in zip(own, own[1:])) and own[-1][1] == fill[b] <= 50
    assert sum(2 * f <= 50 for f in fill.values()) <= 1  # two such bins would have been one


def check_packed(rows, texts, room):
    ids = packing._word_ids(packing.tokenizer_path()).tokenizer
    docs, places = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.offset + r.length))
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(x[1] == y[0] for x, y in zip(own, own[1:])) and own[-1][1] <= room
    for i, text in texts:
        want = np.array([*ids.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(docs[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in own] == [(k, s, min(room, len(want) - s)) for k, s in enumerate(range(0, len(want), room))]
        assert [r.ids_crc32 for r in own] == [zlib.crc32(want[r.start:r.start + r.length].tobytes()) for r in own]
    return len(places), sum(r.length for r in rows)


def test_packing_rebuilds_every_document_in_few_sequences(make_docs, odd, empty):
    texts = [prose(k, 20 + 37 * k % 900) for k in range(160)] + [None, "", prose(99, 9000)]
    n, total = check_packed(packing.packed(make_docs(texts, 6), room=2048).collect(), list(enumerate(texts)), 2048)
    assert n <= 1.06 * total / 2048 + 1
    n, total = check_packed(packing.packed(make_docs(texts, 8), room=256, fan_in=20, block=40).collect(), list(enumerate(texts)), 256)
    assert n <= 1.1 * total / 256 + 8
    rows = packing.packed(odd.withColumn("bin", F.lit(1))).collect()
    assert len([r for r in rows if r.doc_id == 2]) == 2 and len([r for r in rows if r.doc_id == 3]) == 1
    assert packing.packed(empty).count() == 0
