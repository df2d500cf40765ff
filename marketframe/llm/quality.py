"""Quality classifier: a weak-label model over heuristic labellers trains a hashed linear scorer.

Each labeller votes good, bad or nothing on a text. Expectation-maximisation over the histogram of vote
patterns (complete statistics of all documents, at most ``4 ** labellers`` rows, in practice dozens) estimates how accurate each
labeller is, without true labels. The posterior of "good" is the soft target of a logistic regression on
hashed features, fitted on a bounded sample and applied to every whole text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from .common import appended, bounded_sample, fresh

# Common function words of English, French, German and Spanish.
STOP_WORDS = """
a all an and are as at be but by for from had has have he her his i in is it not of on or she that the they
this to was we were which will with you
au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour qui que
sa se son sur un une vous
als am an auch auf aus bei das dem den der des die ein eine einen einer er es für hat ich im in ist mit nicht
noch oder sich sie sind und von war wie wir zu zum zur
al con como del el ella en es ese esta este la las lo los más no o para pero por que se si su sus un una y
"""
_STOP = frozenset(x.encode() for w in STOP_WORDS.split() for x in (w, w.title()))
_EDGES = b".,;:!?'\"()-"
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _EDGES)
_SHAPES = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1+")
# UTF-8 bytes: inside a character; first ones of characters above the Latin blocks (but for general punctuation);
# first ones of South-East and East Asian scripts
_INNER = bytes(range(0x80, 0xC0))
_FOREIGN = bytes(x for x in range(0xCD, 0xF5) if x != 0xE2)
_UNSPACED = bytes((0xE0, *range(0xE3, 0xEE), 0xF0))
_ASCII_LETTERS = bytes(c for c in range(128) if chr(c).isalpha())
_LATIN = bytes(range(0xC3, 0xCB))
_PLAIN = frozenset((b"a", b"A", b"Aa", b"0", b"a'a", b"a-a", b"Aa-Aa", b"Aa-a", b"A'Aa", b"0.0", b"0,0"))


@lru_cache(maxsize=100_000)
def _shape(pattern: bytes) -> tuple[bytes, int, int, int]:
    """Shape of a word given as ``aAa0,`` classes: runs as one character; odd, blank, shouted or not."""
    shape = _RUNS.sub(rb"\1", pattern)[:12]
    core = shape.strip(_EDGES)
    return (shape, core not in _PLAIN, not core.strip(_SYMBOLS + _EDGES),
            core == b"A" and len(pattern.strip(_EDGES)) > 1)


@dataclass
class Measures:
    """What labellers and features are computed from, counted over the whole text."""
    counts: Counter  # of words
    shapes: Counter
    words: int
    symbols: float  # symbol characters per character
    odd: float  # share of words that are no plain words or numbers
    blank: float  # ... without letter or digit
    shouted: float  # ... in capitals
    emphasis: float  # exclamation and question marks per word
    stop: float  # share of function words
    unique: float
    top: float  # share of the most frequent word
    stutter: float  # share of words equal to the one before
    repeated_lines: float  # share of characters in repeats of earlier lines
    mean_word: float  # in code points
    foreign: float  # share of letters outside the Latin script
    unspaced: float  # share of letters in scripts that may not part words by blanks


def measured(text: bytes | None) -> Measures:
    raw = text or b""
    words = raw.split()
    counts = Counter(words)
    n = max(len(words), 1)
    inner = 0 if raw.isascii() else len(raw) - len(raw.translate(None, _INNER))
    solid = max(sum(map(len, words)) - inner, 1)  # code points
    count_of = lambda some: len(raw) - len(raw.translate(None, some))
    foreign, unspaced = (count_of(_FOREIGN), count_of(_UNSPACED)) if inner else (0, 0)
    letters = max(foreign + count_of(_ASCII_LETTERS) + count_of(_LATIN), 1) if foreign else 1
    shapes: Counter = Counter()
    odd = blank = shouted = 0
    for pattern, c in Counter(raw.translate(_SHAPES).split()).items():
        shape, o, b, u = _shape(pattern[:64])
        shapes[shape] += c
        odd += c * o
        blank += c * b
        shouted += c * u
    lines = [x for x in map(bytes.strip, raw.split(b"\n")) if x]
    again = sum(len(x) * (c - 1) for x, c in Counter(lines).items() if c > 1) if len(lines) > 1 else 0
    return Measures(counts, shapes, len(words), (len(raw) - len(raw.translate(None, _SYMBOLS))) / solid, odd / n, blank / n,
                    shouted / n, (raw.count(b"!") + raw.count(b"?")) / n, sum(map(counts.get, _STOP.intersection(counts))) / n,
                    len(counts) / n, max(counts.values(), default=0) / n, sum(map(eq, words, words[1:])) / n, again / solid,
                    solid / n, foreign / letters, unspaced / letters)


def _diversity(m: Measures) -> float:
    """Share of different words, levelled for length (the share falls with about the fourth root of it)."""
    return m.unique * m.words ** 0.25


# name -> vote of a text: 1 good, -1 bad, 0 nothing found, None too short to tell. Thresholds follow the public
# rules for web text (symbol and word statistics, repetition, function words).
LABELLERS = {
    "symbols": lambda m: -1 if m.symbols > 0.05 else 0,
    "odd_words": lambda m: None if m.words < 3 else -1 if m.odd > 0.25 else 0,
    "blank_words": lambda m: None if m.words < 3 else -1 if m.blank > 0.15 else 0,
    "shouting": lambda m: None if m.words < 5 else -1 if m.shouted > 0.4 else 0,
    "emphasis": lambda m: None if m.words < 5 else -1 if m.emphasis > 0.25 else 0,
    "stutter": lambda m: None if m.words < 8 else -1 if m.stutter > 0.15 else 0,
    "word_diversity": lambda m: None if m.words < 30 else -1 if _diversity(m) < 1.3 else 1 if _diversity(m) > 2.0 else 0,
    "top_word": lambda m: None if m.words < 20 else -1 if m.top > 0.2 else 0,
    "repeated_lines": lambda m: None if m.words < 20 else -1 if m.repeated_lines > 0.3 else 0,
    "word_length": lambda m: None if m.words < 8 or m.unspaced > 0.3 else -1 if not 2.8 <= m.mean_word <= 9.0 else 0,
    "stop_words": lambda m: None if m.words < 30 or m.foreign > 0.5 else -1 if m.stop < 0.03 else 0,
}
_VOTES = "-.+"
_SIGN = {-1: "-", 0: ".", 1: "+", None: "_"}


def votes_of(m: Measures) -> str:
    """One character per labeller: ``+`` good, ``-`` bad, ``.`` nothing found, ``_`` too short to tell."""
    return "".join(_SIGN[vote(m)] for vote in LABELLERS.values())


@dataclass
class WeakLabels:
    """Class prior and each labeller's distribution of votes in either class."""
    prior: float
    good: np.ndarray  # labellers x votes (-, ., +)
    bad: np.ndarray

    def posterior(self, pattern: str) -> float:
        """Probability of "good"; labellers that could not tell do not count."""
        k = np.array([i for i, c in enumerate(pattern) if c != "_"], dtype=int)
        at = np.array([_VOTES.index(c) for c in pattern if c != "_"], dtype=int)
        a = np.log(self.prior) + np.log(self.good[k, at]).sum()
        b = np.log1p(-self.prior) + np.log(self.bad[k, at]).sum()
        return float(1 / (1 + np.exp(np.clip(b - a, -700, 700))))


def expectation_maximisation(histogram: dict[str, int], prior: float = 0.8, accuracy: float = 0.8, rounds: int = 60,
                             smooth: float = 1.0) -> WeakLabels:
    """Fits prior and vote distributions to the pattern counts. Starts from labellers that are right more often
    than not, which decides which class is called good. Without rows the start is returned."""
    n = len(LABELLERS)
    start = np.array([1 - accuracy, 1.0, accuracy])
    good = np.tile(start / start.sum(), (n, 1))
    model = WeakLabels(prior, good, good[:, ::-1].copy())
    if not histogram:
        return model
    count = np.array(list(histogram.values()), dtype=float)
    voted = np.array([[[c == v for v in _VOTES] for c in p] for p in histogram], dtype=float)
    for _ in range(rounds):
        p = np.array([model.posterior(x) for x in histogram])
        g = np.einsum("i,ijk->jk", count * p, voted) + smooth * model.good.mean(axis=0)
        b = np.einsum("i,ijk->jk", count * (1 - p), voted) + smooth * model.bad.mean(axis=0)
        rate = (count @ p + 1) / (count.sum() + 2)
        new = WeakLabels(float(np.clip(rate, 1e-4, 1 - 1e-4)), g / g.sum(axis=1, keepdims=True), b / b.sum(axis=1, keepdims=True))
        moved = max(abs(new.prior - model.prior), np.abs(new.good - model.good).max(), np.abs(new.bad - model.bad).max())
        model = new
        if moved < 1e-7:
            break
    return model


def features_of(m: Measures, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a whole text: words and word shapes with damped counts, each kind of unit length, and
    binned statistics."""
    mask = (1 << bits) - 1
    index, value = [], []
    for bag, seed in ((m.counts, 0), (m.shapes, 1)):
        at = np.fromiter((zlib.crc32(w, seed) for w in bag), dtype=np.int64, count=len(bag))
        x = np.log1p(np.fromiter(bag.values(), dtype=np.float64, count=len(bag)))
        index.append(at & mask)
        value.append(x / max(np.sqrt(x @ x), 1e-12))
    stats = (m.symbols * 25, m.odd * 10, m.blank * 10, m.shouted * 10, m.emphasis * 10, m.stop * 25,
             min(_diversity(m), 6) * 4, m.top * 20, m.stutter * 10, m.repeated_lines * 10, min(m.mean_word, 40))
    index.append(np.array([zlib.crc32(b"%d:%d" % (k, v), 3) & mask for k, v in enumerate(stats)], dtype=np.int64))
    value.append(np.full(len(stats), 0.5))
    return np.concatenate(index), np.concatenate(value)


@dataclass
class Scorer:
    """Logistic regression on hashed features."""
    weights: np.ndarray
    bias: float
    bits: int

    def probability(self, m: Measures) -> float:
        index, value = features_of(m, self.bits)
        return float(1 / (1 + np.exp(-np.clip(self.weights[index] @ value + self.bias, -60, 60))))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], bits: int, rounds: int = 120, rate: float = 0.5,
               decay: float = 1e-5) -> Scorer:
    """Full-batch Adam on the cross-entropy with the posteriors as soft targets."""
    w, b = np.zeros(1 << bits), 0.0
    if not rows:
        return Scorer(w, b, bits)
    index = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    y = np.array([r[2] for r in rows])
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[index] * value, len(rows)) + b, -60, 60)))
        err = (p - y) / len(rows)
        g = np.bincount(index, err[row] * value, len(w)) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * err.sum(), 0.999 * vb + 0.001 * err.sum() ** 2
        step = rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
        w -= step * m / (np.sqrt(v) + 1e-8)
        b -= step * mb / (np.sqrt(vb) + 1e-8)
    return Scorer(w.astype(np.float32), float(b), bits)


@dataclass
class Model:
    labels: WeakLabels
    scorer: Scorer


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 6000, bits: int = 16) -> Model:
    """The weak-label model from all documents, the scorer from at most ``sample`` of them (chosen by hash;
    equal rows count once)."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def make_votes():
        return lambda texts: [[votes_of(measured(t)) for t in texts]]

    voted = appended(own, "text", [("votes", StringType())], make_votes, raw=True)
    histogram = {r.votes: r.n for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    labels = expectation_maximisation(dict(sorted(histogram.items())))
    rows = bounded_sample(own, ["doc_id", "text"], ["text"], sample, rows=sum(histogram.values()))

    def make_rows():
        def work(texts):
            out = [[], [], []]
            for t in texts:
                m = measured(t)
                index, value = features_of(m, bits)
                for col, x in zip(out, (votes_of(m), index.astype(np.int32).tobytes(), value.astype(np.float32).tobytes()), strict=True):
                    col.append(x)
            return out
        return work

    from pyspark.sql.types import BinaryType
    coded = appended(rows, "text", [("v", StringType()), ("i", BinaryType()), ("x", BinaryType())], make_rows, raw=True)
    taken = sorted((bytes(r.i), bytes(r.x), r.v) for r in coded.select("v", "i", "x").collect())
    data = [(np.frombuffer(i, np.int32).astype(np.int64), np.frombuffer(x, np.float32).astype(np.float64), labels.posterior(v))
            for i, x, v in taken]
    return Model(labels, fit_scorer(data, bits))


@lru_cache(maxsize=4)
def _posteriors(prior: float, good: bytes, bad: bytes):
    shape = (len(LABELLERS), 3)
    labels = WeakLabels(prior, np.frombuffer(good).reshape(shape), np.frombuffer(bad).reshape(shape))
    return lru_cache(maxsize=None)(labels.posterior)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with votes, weak-label posterior and the scorer's probability of good quality; also returns the
    new columns' names. A text without words (null, empty, blank) has no votes and score 0."""
    names = {k: fresh(docs, f"quality_{k}") for k in ("votes", "posterior", "score")}
    scorer, labels = model.scorer, model.labels

    def make():
        posterior = _posteriors(labels.prior, labels.good.tobytes(), labels.bad.tobytes())

        def work(texts):
            out = [[], [], []]
            for t in texts:
                m = measured(t)
                v = votes_of(m)
                for col, x in zip(out, (v, posterior(v), scorer.probability(m) if m.words else 0.0), strict=True):
                    col.append(x)
            return out
        return work

    return appended(docs, text_col, [(names["votes"], StringType()), (names["posterior"], DoubleType()),
                                     (names["score"], DoubleType())], make, raw=True), names


def classified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_from: float = 0.5) -> DataFrame:
    """One row per document: ``doc_id, votes, posterior, score, kept``. Null ids and repeated rows are scored like
    any others, null texts like empty ones, texts of any length whole; other columns are ignored; an empty table gives an
    empty result."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out, c = scored(own, fit(own))
    return out.select("doc_id", F.col(c["votes"]).alias("votes"), F.col(c["posterior"]).alias("posterior"),
                      F.col(c["score"]).alias("score"), (F.col(c["score"]) >= keep_from).alias("kept"))


def accepted(docs: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """``docs`` without the documents whose score is below ``keep_from``."""
    out, c = scored(docs, fit(docs))
    return out.where(F.col(c["score"]) >= keep_from).select(*docs.columns)
