"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A bounded sample of labelled documents gives the terms whose use differs by label, their inverse document
frequencies and the examples' unit vectors. Postings are cut into blocks of examples; every block knows its
largest weight, so a text looks only into blocks whose bound can still reach its nearest examples, and the
result equals that of comparing with all of them. Neighbours vote by squared cosine and class weight; a logistic
curve fitted on the examples, each without itself, turns votes into probabilities. The neighbours are the evidence.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import appended, bounded_sample, checkpointed, fresh, in_arrow

# ASCII letters in lower case and all bytes of multi-byte characters stay; the rest separates terms
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SLACK = 1e-9  # rounding of sums in different orders
PRIOR = 0.25  # votes of the class shares themselves, in squared cosines


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the spans, one span after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class BlockMaxIndex:
    """Postings by term and example; examples of like heaviest term lie together, so few blocks bound high.

    ``vectors`` are (terms, weights) of unit length. Per term the postings of a block are one entry: the block, its
    postings and their largest weight.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = 64):
        heaviest = np.array([t[np.argmax(w)] if len(t) else terms for t, w in vectors], np.int64)
        order = np.argsort(heaviest, kind="stable")
        self.example = order  # place in the index -> number given
        self.place = np.empty_like(order)
        self.place[order] = np.arange(len(order))
        lengths = np.array([len(vectors[i][0]) for i in order], np.int64)
        at = np.repeat(np.arange(len(order)), lengths)
        term = np.concatenate([np.zeros(0, np.int64), *(vectors[i][0] for i in order)])
        weight = np.concatenate([np.zeros(0), *(vectors[i][1] for i in order)])
        by = np.lexsort((at, term))
        self.at, self.weight, term = at[by].astype(np.int32), weight[by], term[by]
        self.size, self.block, self.blocks = len(order), block, -(-len(order) // block)
        code = term * max(self.blocks, 1) + self.at // block
        self.first = np.flatnonzero(np.diff(code, prepend=-1))
        self.length = np.diff(self.first, append=len(code))
        self.most = np.maximum.reduceat(self.weight, self.first) if len(code) else np.zeros(0)
        self.of = (self.at[self.first] // block).astype(np.int64)
        self.entries = np.searchsorted(term[self.first], np.arange(terms + 1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, less: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` nearest examples of positive cosine, nearest first, ties in the index's
        order; example ``less`` is passed over. Blocks come by falling bound, until none can hold one of them."""
        count = self.entries[terms + 1] - self.entries[terms]
        entry = _spans(self.entries[terms], count)
        if not len(entry):
            return np.zeros(0, np.int64), np.zeros(0)
        heavy, of = np.repeat(weights, count), self.of[entry]
        bound = np.bincount(of, heavy * self.most[entry], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[:np.count_nonzero(bound)]
        skip = self.place[less] if less >= 0 else -1
        score, done, step = np.zeros(self.size), 0, 4
        found, held = np.zeros(0, np.int64), np.zeros(0)
        while done < len(order) and (len(held) < k or bound[order[done]] >= held[-1] - SLACK):
            now = np.zeros(self.blocks, bool)
            now[order[done:done + step]] = True
            pick = now[of]
            lengths = self.length[entry[pick]]
            p = _spans(self.first[entry[pick]], lengths)
            score += np.bincount(self.at[p], np.repeat(heavy[pick], lengths) * self.weight[p], self.size)
            done, step = done + step, step * 2
            if skip >= 0:
                score[skip] = 0
            some = np.flatnonzero(score > 0 if len(held) < k else score >= held[-1])
            best = some[np.argsort(-score[some], kind="stable")[:k]]
            found, held = best, score[best]
        return self.example[found], held


@dataclass
class Model:
    """All that scoring a text needs; bounded by the sample's and the vocabulary's documented sizes."""
    number: dict[bytes, int]  # of every term
    idf: np.ndarray
    index: BlockMaxIndex
    toxic: np.ndarray  # label of every example
    weight: np.ndarray  # documents that an example stands for, mean 1
    ids: list  # of the examples
    k: int
    share: float  # of toxic documents among the labelled
    slope: float = 1.0
    offset: float = 0.0

    def vector(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        counts: Counter = Counter()
        for term, c in Counter(terms_of(text)).items():
            t = self.number.get(term)
            if t is not None:
                counts[t] = c
        return unit(sorted(counts.items()), self.idf)

    def votes(self, text: bytes | None, less: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """Share of toxic votes, and the neighbours with their cosines."""
        near, cosine = self.index.nearest(*self.vector(text), self.k, less)
        w = cosine ** 2 * self.weight[near]
        return float((w @ self.toxic[near] + PRIOR * self.share) / (w.sum() + PRIOR)), near, cosine

    def probability(self, share: float) -> float:
        return 1 / (1 + math.exp(-max(min(self.slope * _logit(share) + self.offset, 500.0), -500.0)))


def unit(counts: list[tuple[int, int]], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and weights of a vector of length one: ``(1 + ln count) * idf``."""
    t = np.array([x for x, _ in counts], np.int64)
    w = (1 + np.log(np.array([c for _, c in counts], np.float64))) * idf[t]
    return t, w / (math.sqrt(float(w @ w)) or 1.0)


def _logit(x):
    x = np.clip(x, 1e-9, 1 - 1e-9)
    return np.log(x / (1 - x))


def fitted_curve(share: np.ndarray, toxic: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve from vote shares to probabilities, by Newton's method. Targets are
    drawn in by one example a class, so that separable examples have a finite curve; the slope stays positive."""
    x = _logit(share)
    up, down = weight[toxic == 1].sum(), weight[toxic == 0].sum()
    target = np.where(toxic == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-12)
        hess = np.array([[h @ (x * x) + 1e-6, h @ x], [h @ x, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, [g @ x + 1e-6 * (a - 1), g.sum()])
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -5, 5))
        if abs(step).max() < 1e-10:
            break
    return max(a, 1e-3), b


def examples_of(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, dict[bool, int], int]:
    """``doc_id, toxic, text`` of at most ``most`` labelled documents, half of them of each label where there are as
    many, chosen by hash of the id; also the number of labelled documents by label, and the rows taken. Several
    labels of an id count as toxic if one is; of several texts of an id the smallest stands."""
    marks = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic") == 1).alias("toxic"))
             .join(docs.where("doc_id is not null").select("doc_id").distinct(), "doc_id"))
    marks = checkpointed(marks)
    totals = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    # a label that has fewer leaves its places to the other
    size = {t: max(most // 2, most - totals.get(not t, 0)) for t in (False, True)}
    picked = [bounded_sample(marks.where(F.col("toxic") == t), ["doc_id"], ["doc_id", "toxic"], size[t], rows=totals.get(t, 0))
              for t in (False, True)]
    chosen = picked[0].unionAll(picked[1])
    # broadcast: at most ``most`` ids
    rows = checkpointed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
                        .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    return rows, totals, rows.count()


def telling_terms(examples: DataFrame, of: dict[bool, int], most: int, least_docs: int, least_z: float, least_ratio: float) -> list[tuple[bytes, int]]:
    """At most ``most`` terms, with their documents among the examples, whose share of documents differs between the
    labels by ``least_z`` standard errors and is ``least_ratio`` times as large in one of them (so that words of all
    texts, whose shares differ little, are none); the largest differences first, ties by term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = {}

        def out() -> pa.RecordBatch:
            both = np.array(list(held.values()), np.int64).reshape(len(held), 2)
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(both[:, 0]), pa.array(both[:, 1])],
                                              names=["term", "clean", "toxic"])
            held.clear()
            return made

        for b in batches:
            for toxic, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                for term in set(terms_of(text.as_py())):
                    held.setdefault(term, [0, 0])[toxic] += 1
                if len(held) > 500_000:
                    yield out()
        if held:
            yield out()

    counts = in_arrow(examples.select("toxic", "text"), run, "term binary, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n, m = of.get(False, 0), of.get(True, 0)
    if not (n and m):
        return []
    both = F.col("clean") + F.col("toxic")
    share = both / (n + m)
    z = F.abs(F.col("toxic") / m - F.col("clean") / n) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / n + 1 / m))
    a, b = (F.col("clean") + 0.5) / (n + 0.5), (F.col("toxic") + 0.5) / (m + 0.5)
    rows = (counts.where((both >= least_docs) & (F.greatest(a / b, b / a) >= least_ratio))
            .select("term", both.alias("docs"), z.alias("z")).where(F.col("z") >= least_z)
            .orderBy(F.desc("z"), "term").limit(most).collect())
    return [(bytes(r.term), r.docs) for r in rows]


def fit(docs: DataFrame, labels: DataFrame, k: int = 15, most_examples: int = 20_000, most_terms: int = 20_000,
        least_docs: int = 5, least_z: float = 4.0, least_ratio: float = 2.0) -> Model | float:
    """The model, from a sample of at most ``most_examples`` documents of ``docs(doc_id, text)`` with a label in
    ``labels(doc_id, toxic)``, over at most ``most_terms`` terms. Where there is nothing to tell labels apart (no
    labels, or all alike), the constant score: the share of toxic documents."""
    examples, totals, rows = examples_of(docs, labels, most_examples)
    share = totals.get(True, 0) / max(sum(totals.values()), 1)
    of = {r.toxic: r["count"] for r in examples.groupBy("toxic").count().collect()}
    terms = telling_terms(examples, of, most_terms, least_docs, least_z, least_ratio)
    if not terms:
        return share
    number = {t: i for i, (t, _) in enumerate(terms)}
    idf = np.array([math.log((1 + rows) / (1 + d)) + 1 for _, d in terms])
    kind = examples.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [sorted((number[w], c) for w, c in Counter(terms_of(t.as_py())).items() if w in number) for t in b.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([[t for t, _ in x] for x in own], pa.list_(pa.int32())),
                                              pa.array([[c for _, c in x] for x in own], pa.list_(pa.int64()))],
                                             names=["doc_id", "toxic", "terms", "counts"])

    known = in_arrow(examples.select("doc_id", "toxic", "text"), count, f"doc_id {kind}, toxic boolean, terms array<int>, counts array<bigint>")
    known = sorted(known.collect(), key=lambda r: r.doc_id)  # bounded: examples times terms
    toxic = np.array([float(r.toxic) for r in known])
    weight = np.where(toxic == 1, totals.get(True, 0) / max(of.get(True, 0), 1), totals.get(False, 0) / max(of.get(False, 0), 1))
    weight *= rows / weight.sum()
    index = BlockMaxIndex([unit(list(zip(r.terms, r.counts, strict=True)), idf) for r in known], len(terms))
    model = Model(number, idf, index, toxic, weight, [r.doc_id for r in known], k, share)
    # every example's votes without itself
    shared, own = docs.sparkSession.sparkContext.broadcast(model), {r.doc_id: i for i, r in enumerate(known)}
    places = docs.sparkSession.sparkContext.broadcast(own)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [places.value[i] for i in b.column(0).to_pylist()]
            got = [shared.value.votes(t.as_py(), i)[0] for i, t in zip(at, b.column(1).cast(pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(got, pa.float64())], names=["at", "share"])

    votes = np.zeros(rows)
    for r in in_arrow(examples.select("doc_id", "text"), vote, "at int, share double").collect():
        votes[r["at"]] = r["share"]
    model.slope, model.offset = fitted_curve(votes, toxic, weight)
    return model


def scored(docs: DataFrame, model: Model | float, text_col: str = "text", id_type=None, shown: int = 3) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with each whole text's probability and its ``shown`` nearest examples: ids, cosines and labels; also
    returns the new columns' names (``score, near, cosine, label``). Only the text is looked at. A text without any of
    the model's terms (null, empty) has no neighbour and the score of the class shares alone."""
    names = {x: fresh(docs, f"tox_{x}") for x in ("score", "near", "cosine", "label")}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def run(texts: list[bytes | None]) -> list[list]:
            out: list[list] = [[], [], [], []]
            for text in texts:
                if isinstance(model, float):
                    row = model, [], [], []
                else:
                    share, near, cosine = model.votes(text)
                    near, cosine = near[:shown], cosine[:shown]
                    row = model.probability(share), [model.ids[i] for i in near], cosine.tolist(), model.toxic[near].tolist()
                for col, x in zip(out, row, strict=True):
                    col.append(x)
            return out
        return run

    kinds = (DoubleType(), ArrayType(id_type or docs.schema["doc_id"].dataType), ArrayType(DoubleType()), ArrayType(DoubleType()))
    return appended(docs, text_col, list(zip(names.values(), kinds, strict=True)), make, raw=True), names


def report(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, near_ids, near_cosines, near_toxic``.

    Labels are learned only from ids whose checksum modulo 5 is not 0; ids that are null are neither learned from nor
    held out. Null and empty texts score as texts without any known term, repeated rows alike, texts of any length
    whole. Other columns are ignored. An empty table gives an empty result; without labels every score is 0.
    """
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    own = docs.select("doc_id", "text")
    model = fit(own, labels.select("doc_id", "toxic").where(rest != 0), **settings)
    out, c = scored(own.withColumn("held_out", F.coalesce(rest == 0, F.lit(False))), model)
    return out.select("doc_id", "held_out", F.col(c["score"]).alias("score"), (F.col(c["score"]) >= 0.5).cast("int").alias("predicted"),
                      F.col(c["near"]).alias("near_ids"), F.col(c["cosine"]).alias("near_cosines"), F.col(c["label"]).alias("near_toxic"))
