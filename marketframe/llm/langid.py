"""Language identification by a byte convolutional network, trained in numpy on labelled text.

A text's letters (lower case, everything else one blank) are cut into fixed-length windows that overlap by the
widest filter. Filters of several widths over one-hot bytes, max pooling over the window and a softmax give
each window's language probabilities; a text's are the mean over all its windows, weighted by their bytes.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StringType, StructField, StructType

from .common import appended, in_arrow

WIDTHS = (2, 3, 4)
LENGTH = 256
STRIDE = LENGTH - max(WIDTHS) + 1
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]").search
UNKNOWN = "und"


def letters_of(text: bytes | None) -> bytes:
    """The words of a text between single blanks, or nothing if it has no letter."""
    if not text or not (_ASCII_LETTER(text) or any(map(str.isalpha, text.decode("utf-8", "replace")))):
        return b""
    return b" %b " % b" ".join(text.translate(_LETTERS).split())


def windows_of(line: bytes) -> np.ndarray:
    """All windows of a line, zero-padded, as rows of bytes."""
    n = max(1, -(-(len(line) - max(WIDTHS) + 1) // STRIDE))
    room = np.zeros((n - 1) * STRIDE + LENGTH, np.uint8)
    room[:len(line)] = np.frombuffer(line, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(room, LENGTH)[::STRIDE]


class ByteNet:
    """``filters[w]`` is (w, 256, f): the weight of every byte at every place of a filter."""

    def __init__(self, languages: list[str], filters: int = 16, seed: int = 1, weights: dict[str, np.ndarray] | None = None):
        self.languages = languages
        if weights is None:
            rng = np.random.default_rng(seed)
            weights = {f"F{w}": rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in WIDTHS}
            weights |= {"b": np.zeros(len(WIDTHS) * filters, np.float32), "c": np.zeros(len(languages), np.float32),
                        "W": rng.normal(0, 0.2, (len(WIDTHS) * filters, len(languages))).astype(np.float32)}
        self.w = weights
        self.tables: dict[tuple[int, int], np.ndarray] = {}

    def ready(self) -> ByteNet:
        """Sums the weights of neighbouring places over all byte pairs, so that use needs half the lookups."""
        for w in WIDTHS:
            f = self.w[f"F{w}"]
            for j in range(0, w - 1, 2):
                self.tables[w, j] = (f[j][:, None, :] + f[j + 1][None, :, :]).reshape(65536, -1)
        return self

    def _pooled(self, x: np.ndarray, where: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Max over the window of every filter, before the bias; with ``where`` also the places."""
        pairs = (x[:, :-1].astype(np.uint16) << 8) | x[:, 1:] if self.tables else None
        pooled, places = [], []
        for w in WIDTHS:
            f, n, out = self.w[f"F{w}"], LENGTH - w + 1, None
            j = 0
            while j < w:
                if (w, j) in self.tables:
                    part = self.tables[w, j].take(pairs[:, j:j + n], axis=0)
                    j += 2
                else:
                    part = f[j].take(x[:, j:j + n], axis=0)
                    j += 1
                out = part if out is None else np.add(out, part, out=out)
            if where:
                at = out.argmax(axis=1)
                places.append(at)
                pooled.append(np.take_along_axis(out, at[:, None, :], axis=1)[:, 0])
            else:
                pooled.append(out.max(axis=1))
        return np.concatenate(pooled, axis=1), places

    def probabilities(self, x: np.ndarray, batch: int = 64) -> np.ndarray:
        out = np.zeros((len(x), len(self.languages)), np.float32)
        for i in range(0, len(x), batch):
            h = np.maximum(self._pooled(x[i:i + batch])[0] + self.w["b"], 0)
            z = h @ self.w["W"] + self.w["c"]
            e = np.exp(z - z.max(axis=1, keepdims=True))
            out[i:i + batch] = e / e.sum(axis=1, keepdims=True)
        return out

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 2) -> list[float]:
        """Adam on the cross-entropy; the pooling passes gradients to the places of the maxima only."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        step, losses = 0, []
        for epoch in range(epochs):
            order, loss = rng.permutation(len(x)), 0.0
            for s in range(0, len(x), batch):
                pick = order[s:s + batch]
                xb, yb = x[pick], y[pick]
                pooled, places = self._pooled(xb, where=True)
                pre = pooled + self.w["b"]
                h = np.maximum(pre, 0)
                z = h @ self.w["W"] + self.w["c"]
                e = np.exp(z - z.max(axis=1, keepdims=True))
                p = e / e.sum(axis=1, keepdims=True)
                at = np.arange(len(xb))
                loss -= float(np.log(p[at, yb] + 1e-12).sum())
                dz = p.copy()
                dz[at, yb] -= 1
                dz /= len(xb)
                dh = (dz @ self.w["W"].T) * (pre > 0)
                g = {"W": h.T @ dz + 1e-4 * self.w["W"], "c": dz.sum(axis=0), "b": dh.sum(axis=0)}
                k = dh.shape[1] // len(WIDTHS)
                for n, w in enumerate(WIDTHS):
                    d, f = np.zeros_like(self.w[f"F{w}"]), np.arange(k)[None, :]
                    for j in range(w):
                        np.add.at(d[j], (xb[at[:, None], places[n] + j], f), dh[:, n * k:(n + 1) * k])
                    g[f"F{w}"] = d
                step += 1
                lr = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for name, d in g.items():
                    m[name] = 0.9 * m[name] + 0.1 * d
                    v2[name] = 0.999 * v2[name] + 0.001 * d * d
                    self.w[name] = self.w[name] - (lr * m[name] / (np.sqrt(v2[name]) + 1e-8)).astype(np.float32)
            losses.append(loss / max(len(x), 1))
        return losses

    def identify(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        """Language and mean probability of whole texts; ``und`` and 0 where there is no letter."""
        lines = [letters_of(t) for t in texts]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        todo = [i for i, line in enumerate(lines) if line]
        for part in _runs(todo, [len(lines[i]) for i in todo], 1 << 20):
            parts = [windows_of(lines[i]) for i in part]
            p = self.probabilities(np.concatenate(parts))
            size = np.concatenate([np.minimum(len(lines[i]) - STRIDE * np.arange(len(x)), LENGTH) for i, x in zip(part, parts, strict=True)])
            starts = np.concatenate([[0], np.cumsum([len(x) for x in parts])[:-1]])
            mean = np.add.reduceat(p * size[:, None], starts, axis=0) / np.add.reduceat(size, starts)[:, None]
            best = mean.argmax(axis=1)
            for i, k, row in zip(part, best, mean, strict=True):
                names[i], scores[i] = self.languages[k], float(min(row[k], 1.0))
        return names, scores


def _runs(items: list[int], sizes: list[int], most: int) -> list[list[int]]:
    """Consecutive items in runs of about ``most`` bytes; a longer item is a run of its own."""
    out: list[list[int]] = []
    held = most
    for i, s in zip(items, sizes, strict=True):
        if held + s > most:
            out.append([])
            held = 0
        out[-1].append(i)
        held += s
    return out


def training_windows(docs: DataFrame, a_language: int, a_text: int, most_windows: int, seed: int = 9) -> DataFrame:
    """``(lang, window)`` of a sample balanced by language: at most ``a_language`` different labelled texts each,
    chosen by hash, and ``a_text`` windows of each at hash-chosen places. Every language has its share, at least one
    text, of ``most_windows`` in all; there is no bound on the number of languages."""
    own = docs.where("lang is not null and text is not null").select("lang", "text")
    counts = {r.lang: r.n for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # the classes of the model
    a_language = max(1, min(a_language, most_windows // (a_text * max(len(counts), 1))))
    if not counts:
        return docs.sparkSession.createDataFrame([], "lang string, window binary")
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items())
                           for x in (lang, min(1.0, 2.0 * a_language / n + 32.0 / n))])
    h = F.xxhash64(F.lit(seed), "lang", "text")
    near = (own.withColumn("h", h).withColumn("u", F.pmod("h", F.lit(1 << 30)) / float(1 << 30))
            .where(F.col("u") <= share[F.col("lang")]).groupBy("lang", "h").agg(F.min("text").alias("text")))
    first = Window.partitionBy("lang").orderBy("h")
    taken = near.withColumn("k", F.row_number().over(first)).where(F.col("k") <= a_language).select("lang", "text", "h")

    def cut(batches):
        import pyarrow as pa
        for b in batches:
            langs, out = [], []
            for lang, text, key in zip(*(c.to_pylist() for c in b.columns), strict=True):
                line = letters_of(text.encode())
                if line:
                    x = windows_of(line)
                    pick = np.random.default_rng(key & (2 ** 63 - 1)).permutation(len(x))[:a_text]
                    langs += [lang] * len(pick)
                    out += [x[i].tobytes() for i in sorted(pick)]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], names=["lang", "window"])

    return in_arrow(taken, cut, StructType([StructField("lang", StringType()), StructField("window", BinaryType())]))


def fit(docs: DataFrame, a_language: int = 500, a_text: int = 4, most_windows: int = 200_000) -> ByteNet:
    """The network, from ``docs(lang, text)``. Short windows are repeated shorter, so that it knows short texts."""
    rows = sorted((r.lang, bytes(r.window)) for r in training_windows(docs, a_language, a_text, most_windows).collect())
    languages = sorted({lang for lang, _ in rows})
    net = ByteNet(languages)
    if rows:
        x = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, LENGTH)
        y = np.array([languages.index(lang) for lang, _ in rows])
        rng = np.random.default_rng(4)
        short = x.copy()
        keep = np.minimum(rng.integers(8, 80, len(x)), LENGTH)
        short[np.arange(LENGTH)[None, :] >= keep[:, None]] = 0
        net.train(np.concatenate([x, short]), np.concatenate([y, y]))
    return net


@lru_cache(maxsize=2)
def _net(languages: tuple[str, ...], packed: tuple) -> ByteNet:
    weights = {k: np.frombuffer(v, np.float32).reshape(shape) for k, shape, v in packed}
    return ByteNet(list(languages), weights=weights).ready()


def identified(docs: DataFrame, net: ByteNet, text_col: str, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with each whole text's language and probability; only the text is looked at."""
    languages, packed = tuple(net.languages), tuple((k, v.shape, v.astype(np.float32).tobytes()) for k, v in net.w.items())

    def make():
        return lambda texts: [list(c) for c in _net(languages, packed).identify(texts)]

    return appended(docs, text_col, [(names[0], StringType()), (names[1], DoubleType())], make, raw=True)


def held_out_split(docs: DataFrame) -> DataFrame:
    """``doc_id, text, lang, held_out``: a quarter of the ids, by checksum, is never learned from. A null id is not
    held out and not learned from either."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return docs.select("doc_id", "text", "lang", F.coalesce(rest == 2, F.lit(False)).alias("held_out"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``. Null texts and texts without letters are
    ``und`` with score 0; so is everything if there is nothing to learn from. Repeated rows are scored alike, texts of any length whole;
    other columns are ignored; an empty table gives an empty result."""
    own = held_out_split(docs)
    net = fit(own.where("doc_id is not null and not held_out").select("lang", "text"))
    return identified(own.select("doc_id", "held_out", "text"), net, "text").select("doc_id", "held_out", "lang_pred", "score")
