"""Personal data: exact base patterns plus a character-level bidirectional LSTM with CRF transitions.

The tagger is trained in numpy on labelled spans: windows of the corpus whose base matches are the labels,
with variants (no country code, other separators, neighbours side by side) added. At use, every stretch of
text that could hold a span (all kinds need a digit or an ``@``) is covered by overlapping windows; each
window is decoded and the spans of a whole text are reconciled by the best-scoring set without overlaps. The
tagger adds spans where the base patterns dropped or missed one; base spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .common import appended, bounded_sample, checkpointed, fresh, in_arrow

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

_ANY = re.compile("[0-9@]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*$")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches found from each ``@``: the local part is the run of its characters before it, back to
    the previous match at most. Linear, also on long runs without ``@``."""
    out: list[Span] = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[Span]:
    """All base spans (code points, end exclusive) by start, then kind in the order of ``KINDS``."""
    if not _ANY.search(text):
        return []
    out = _emails(text)
    out += [(*m.span(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255
                                                                for p in m.group().split("."))]
    out += [(*m.span(), "card") for m in _CARD.finditer(text)
            if 12 <= len(d := digits_of(m.group())) <= 19 and luhn(d)]
    out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# --- tagger -----------------------------------------------------------------------------------------------

WIDTH, STRIDE = 96, 48
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_LETTER, _OTHER, _PAD = 128, 129, 130
_CHARS = 131


def coded(text: str) -> np.ndarray:
    """Character classes: ASCII as itself, then letters, others, padding."""
    return np.fromiter((o if (o := ord(c)) < 128 else _LETTER if c.isalpha() else _OTHER for c in text),
                       dtype=np.int16, count=len(text))


def tagged(length: int, spans: list[Span]) -> np.ndarray:
    y = np.zeros(length, dtype=np.int8)
    for s, e, kind in spans:
        if y[s:e].any():
            continue
        k = 1 + 2 * KINDS.index(kind)
        y[s], y[s + 1:e] = k, k + 1
    return y


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Embedding, one LSTM in either direction, linear emissions and CRF transitions, in plain numpy."""

    def __init__(self, embed: int = 12, hidden: int = 16, seed: int = 3, weights: dict[str, np.ndarray] | None = None):
        self.hidden = hidden
        if weights is None:
            rng = np.random.default_rng(seed)
            k = len(TAGS)

            def near(*shape: int) -> np.ndarray:
                return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
            weights = {"E": rng.normal(0, 0.5, (_CHARS, embed)).astype(np.float32), "Wo": near(2 * hidden, k),
                       "bo": np.zeros(k, np.float32), "T": np.zeros((k, k), np.float32), "S": np.zeros(k, np.float32)}
            for d in "fb":
                weights |= {f"Wx{d}": near(embed, 4 * hidden), f"Wh{d}": near(hidden, 4 * hidden),
                            f"b{d}": np.repeat(np.array([0, 1, 0, 0], np.float32), hidden)}
        self.w = weights
        # an I tag needs a B or I of its kind before it
        self.allowed = np.zeros((len(TAGS), len(TAGS)), np.float32)
        for j in range(2, len(TAGS), 2):
            self.allowed[[i for i in range(len(TAGS)) if i not in (j - 1, j)], j] = -1e4
        self.first = np.zeros(len(TAGS), np.float32)

    def _run(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (batch, time, hidden) of one direction; with ``keep`` also what backpropagation needs."""
        w, h = self.w, self.hidden
        table = w["E"] @ w[f"Wx{d}"] + w[f"b{d}"]
        b, t = x.shape
        hs = np.zeros((b, t, h), np.float32)
        cell, state, kept = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32), []
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            z = table[x[:, i]] + state @ w[f"Wh{d}"]
            gate = _sigmoid(z[:, :3 * h])
            g = np.tanh(z[:, 3 * h:])
            new = gate[:, h:2 * h] * cell + gate[:, :h] * g
            tc = np.tanh(new)
            out = gate[:, 2 * h:] * tc
            if keep:
                kept.append((i, gate, g, cell, state, tc))
            cell, state = new, out
            hs[:, i] = out
        return hs, kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        hs = np.concatenate([self._run(x, "f", False)[0], self._run(x, "b", False)[0]], axis=2)
        return hs @ self.w["Wo"] + self.w["bo"]

    def _lattice(self, em: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward scores of a batch, scaled to sum 1 at every step, the scaled emissions, the steps'
        scales and the log partition."""
        move = np.exp((self.w["T"] + self.allowed).astype(np.float64))
        top = em.max(axis=2, keepdims=True)
        e = np.exp((em - top).astype(np.float64))
        b, t, k = em.shape
        alpha, beta, scale = np.zeros((b, t, k)), np.ones((b, t, k)), np.zeros((b, t))
        now = e[:, 0] * np.exp((self.w["S"] + self.first).astype(np.float64))
        for i in range(t):
            if i:
                now = (alpha[:, i - 1] @ move) * e[:, i]
            scale[:, i] = now.sum(axis=1)
            alpha[:, i] = now / scale[:, i, None]
        for i in range(t - 2, -1, -1):
            beta[:, i] = ((beta[:, i + 1] * e[:, i + 1]) @ move.T) / scale[:, i + 1, None]
        return alpha, beta, e, scale, np.log(scale).sum(axis=1) + top.sum(axis=(1, 2))

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tag sequence of each window and every chosen tag's marginal probability."""
        em = self.emissions(x)
        tr = self.w["T"] + self.allowed
        b, t, _ = em.shape
        score, back = em[:, 0] + self.w["S"] + self.first, []
        for i in range(1, t):
            s = score[:, :, None] + tr
            back.append(s.argmax(axis=1))
            score = s.max(axis=1) + em[:, i]
        path = np.zeros((b, t), np.int64)
        path[:, -1] = score.argmax(axis=1)
        for i in range(t - 1, 0, -1):
            path[:, i - 1] = back[i - 1][np.arange(b), path[:, i]]
        alpha, beta, *_ = self._lattice(em)
        return path, np.take_along_axis(alpha * beta, path[:, :, None], axis=2)[:, :, 0]

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tag sequences and its gradient."""
        w, h = self.w, self.hidden
        b, t = x.shape
        (hf, kf), (hb, kb) = self._run(x, "f", True), self._run(x, "b", True)
        hs = np.concatenate([hf, hb], axis=2)
        em = hs @ w["Wo"] + w["bo"]
        alpha, beta, e, scale, z = self._lattice(em)
        tr = w["T"] + self.allowed
        at = np.arange(b)
        gold = em[at[:, None], np.arange(t)[None, :], y].sum(axis=1) + (w["S"] + self.first)[y[:, 0]]
        gold += tr[y[:, :-1], y[:, 1:]].sum(axis=1)
        d_em = alpha * beta
        d_start = d_em[:, 0].sum(axis=0)
        d_em[at[:, None], np.arange(t)[None, :], y] -= 1
        ahead = (e * beta / scale[:, :, None])[:, 1:].reshape(-1, em.shape[2])
        d_tr = (alpha[:, :-1].reshape(-1, em.shape[2]).T @ ahead) * np.exp(tr.astype(np.float64))
        np.subtract.at(d_tr, (y[:, :-1], y[:, 1:]), 1)
        np.subtract.at(d_start, y[:, 0], 1)
        d_em = (d_em / b).astype(np.float32)
        g = {"T": (d_tr / b).astype(np.float32), "S": (d_start / b).astype(np.float32),
             "Wo": hs.reshape(b * t, -1).T @ d_em.reshape(b * t, -1), "bo": d_em.sum(axis=(0, 1)), "E": np.zeros_like(w["E"])}
        d_hs = d_em @ w["Wo"].T
        seen = np.zeros((b * t, _CHARS), np.float32)
        seen[np.arange(b * t), x.reshape(-1)] = 1
        for d, kept, part in (("f", kf, d_hs[:, :, :h]), ("b", kb, d_hs[:, :, h:])):
            wh, wx = w[f"Wh{d}"], w[f"Wx{d}"]
            d_wh, d_z = np.zeros_like(wh), np.zeros((b, t, 4 * h), np.float32)
            d_state, d_cell = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
            for i, gate, gg, cell, state, tc in reversed(kept):
                d_out = part[:, i] + d_state
                gi, gf, go = gate[:, :h], gate[:, h:2 * h], gate[:, 2 * h:]
                d_c = d_cell + d_out * go * (1 - tc * tc)
                dz = np.concatenate([d_c * gg * gi * (1 - gi), d_c * cell * gf * (1 - gf), d_out * tc * go * (1 - go),
                                     d_c * gi * (1 - gg * gg)], axis=1)
                d_wh += state.T @ dz
                d_z[:, i] = dz
                d_state, d_cell = dz @ wh.T, d_c * gf
            d_table = seen.T @ d_z.reshape(b * t, 4 * h)
            g |= {f"Wh{d}": d_wh, f"Wx{d}": w["E"].T @ d_table, f"b{d}": d_table.sum(axis=0)}
            g["E"] += d_table @ wx.T
        return float((z - gold).mean()), g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.01, seed: int = 5) -> list[float]:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        losses, step = [], 0
        total = epochs * max(1, -(-len(x) // batch))
        for _ in range(epochs):
            order, loss = rng.permutation(len(x)), 0.0
            for s in range(0, len(x), batch):
                pick = order[s:s + batch]
                value, g = self.gradient(x[pick], y[pick])
                loss += value * len(pick)
                norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
                step += 1
                lr = rate * (1 - 0.9 * step / total) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for k, a in g.items():
                    a *= min(1.0, 5.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * a
                    v2[k] = 0.999 * v2[k] + 0.001 * a * a
                    self.w[k] = self.w[k] - (lr * m[k] / (np.sqrt(v2[k]) + 1e-8)).astype(np.float32)
            losses.append(loss / max(len(x), 1))
        return losses


# --- windows ----------------------------------------------------------------------------------------------

def windows_of(text: str) -> list[int]:
    """Starts of the overlapping windows that hold a digit or an ``@``; no other window can hold a span."""
    last = max(0, len(text) - 1) // STRIDE
    starts: set[int] = set()
    at = _ANY.search(text)
    while at:
        k = at.start() // STRIDE
        starts.update(range(max(0, k - 1), min(k, last) + 1))
        at = _ANY.search(text, (k + 1) * STRIDE)
    return [k * STRIDE for k in sorted(starts)]


def padded(parts: list[str]) -> np.ndarray:
    x = np.full((len(parts), WIDTH), _PAD, dtype=np.int16)
    for i, p in enumerate(parts):
        x[i, :len(p)] = coded(p)
    return x


def _valid(kind: str, s: str) -> bool:
    """What a span of the kind must look like, however it was found."""
    d = digits_of(s)
    if kind == "email":
        return re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@.]{2,}", s) is not None
    if kind == "ip":
        parts = s.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 12 <= len(d) <= 19 and re.fullmatch(r"[0-9][0-9 ./-]*[0-9]", s) is not None and luhn(d)
    return (9 <= len(d) <= 15 and re.fullmatch(r"\+?[0-9(][0-9 ()./-]*[0-9]", s) is not None
            and ("+" in s or re.search(r"[0-9)][ ()./-]+[0-9]", s) is not None))


def reconciled(found: list[tuple[int, int, str, float]]) -> list[Span]:
    """The set of spans without overlaps that has the largest total score, over a whole text. The same span from
    two windows counts with its best score."""
    best: dict[Span, float] = {}
    for s, e, k, p in found:
        best[(s, e, k)] = max(p, best.get((s, e, k), 0.0))
    items = sorted(best.items(), key=lambda x: (x[0][1], x[0][0], x[0][2]))
    ends = [x[0][1] for x in items]
    total, take = [0.0], []
    from bisect import bisect_right
    for i, ((s, _, _), p) in enumerate(items):
        j = bisect_right(ends, s, 0, i)
        with_it = total[j] + p
        take.append(with_it > total[i])
        total.append(max(total[i], with_it))
    out, i = [], len(items)
    while i:
        if take[i - 1]:
            out.append(items[i - 1][0])
            i = bisect_right(ends, items[i - 1][0][0], 0, i - 1)
        else:
            i -= 1
    return sorted(out)


def _window_spans(path: np.ndarray, sure: np.ndarray, start: int, length: int, end_of_text: int) -> list[tuple[int, int, str, float, bool, bool]]:
    """Spans of one decoded window, and whether an inner window edge cuts them on the left or on the right."""
    out = []
    i = 0
    while i < length:
        t = int(path[i])
        if t % 2 == 1:
            j = i + 1
            while j < length and path[j] == t + 1:
                j += 1
            out.append((start + i, start + j, KINDS[(t - 1) // 2], float(sure[i:j].min()),
                        i == 0 and start > 0, j == WIDTH and start + WIDTH < end_of_text))
            i = j
        elif t and i == 0 and start > 0:  # the window begins inside a span
            j = i + 1
            while j < length and path[j] == t:
                j += 1
            out.append((start, start + j, KINDS[(t - 1) // 2], float(sure[:j].min()), True, j == WIDTH and start + WIDTH < end_of_text))
            i = j
        else:
            i += 1
    return out


def joined_pieces(pieces: list[tuple[int, int, str, float, bool, bool]]) -> list[tuple[int, int, str, float]]:
    """Whole spans, and those put together from pieces: one cut on the right is continued by one of its kind cut on the
    left that begins inside it or at its end. A piece without its other half is no span."""
    out = [(s, e, k, p) for s, e, k, p, left, right in pieces if not left and not right]
    open_ends: dict[str, list] = {}
    for s, e, k, p, left, right in sorted(x for x in pieces if x[4] or x[5]):
        if not left:
            open_ends[k] = [s, e, p]
        elif k in open_ends and s <= open_ends[k][1]:
            now = open_ends[k]
            now[1], now[2] = max(now[1], e), min(now[2], p)
            if not right:
                out.append((now[0], now[1], k, now[2]))
                del open_ends[k]
    return out


def _agrees(text: str, a: int, e: int, kind: str, base: list[Span]) -> bool:
    """Whether an added span leaves all base spans whole: it meets none, or holds those of its own kind that it meets;
    then what it adds are characters of words, so that it widens a span (a name with an accent) and joins no others."""
    met = [(s, t, k) for s, t, k in base if a < t and s < e]
    if not met:
        return True
    if len(met) > 1 or met[0][2] != kind or not (a <= met[0][0] and met[0][1] <= e) or (a, e) == met[0][:2]:
        return False
    return all(c.isalnum() or c in "._%+-" for c in text[a:met[0][0]] + text[met[0][1]:e])


def find_spans(texts: list[str], tagger: Tagger | None, surely: float = 0.7) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans (base and added, by start, then kind) of each text."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return [(b, b) for b in base]
    where = [(i, s) for i, t in enumerate(texts) for s in windows_of(t)]
    pieces: list[list[tuple[int, int, str, float, bool, bool]]] = [[] for _ in texts]
    for k in range(0, len(where), 256):
        part = where[k:k + 256]
        path, sure = tagger.decode(padded([texts[i][s:s + WIDTH] for i, s in part]))
        for (i, s), p, q in zip(part, path, sure, strict=True):
            t = texts[i]
            pieces[i] += _window_spans(p, q, s, min(WIDTH, len(t) - s), len(t))
    out = []
    for t, b, own in zip(texts, base, pieces, strict=True):
        added = [(a, e, kind, p) for a, e, kind, p in joined_pieces(own) if p >= surely and _valid(kind, t[a:e]) and _agrees(t, a, e, kind, b)]
        out.append((b, sorted(b + reconciled(added), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))))
    return out


def joined_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def variants(parts: list[str], copies: int, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Labelled windows: each window as it is, and new ones whose spans are varied. Window cuts through a span
    keep no label for it."""
    rng = np.random.default_rng(seed)
    out = [(p, base_spans(p)) for p in parts]
    pool = [(p[s:e], k) for p, spans in out for s, e, k in spans]
    plain = [p for p, spans in out if not spans] or [""]

    def varied(s: str, kind: str) -> str:
        if kind == "phone" and rng.random() < 0.5:
            s = re.sub(r"^\+[0-9]{1,2}[ .-]?", "", s)
        if kind == "card" and rng.random() < 0.6:
            d, sep = digits_of(s), " -./"[rng.integers(4)]
            s = sep.join(d[i:i + 4] for i in range(0, len(d), 4))
        if kind in ("phone", "ip"):
            s = "".join(str(rng.integers(10)) if c.isdigit() and kind == "phone" and i > 3 else c for i, c in enumerate(s))
        if kind == "email" and rng.random() < 0.6:  # letters that the base pattern does not know
            for _ in range(1 + int(rng.integers(3))):
                at = int(rng.integers(s.index("@")))
                s = s[:at] + "äçéñöüßøłšжя"[rng.integers(12)] + s[at + 1:]
        return s

    have = {k: max(1, sum(kind == k for _, kind in pool)) for k in KINDS}
    # windows of a rare kind are varied more often, so that each kind is learned from some hundred spans
    often = [(p, spans, min(12, max(1, 300 // min(have[k] for _, _, k in spans)))) for p, spans in out[:len(parts)] if spans]
    for p, spans in [(p, spans) for p, spans, n in often for _ in range(n * copies)]:
        text, got = "", []
        before = p[:spans[0][0]]
        text += before[-int(rng.integers(0, 40)):] if before else ""
        for _ in range(1 + int(rng.integers(3))):
            a, e, own = spans[rng.integers(len(spans))]
            s, kind = pool[rng.integers(len(pool))] if got else (p[a:e], own)
            s = varied(s, kind)
            if len(text) + len(s) > WIDTH - 4:
                break
            got.append((len(text), len(text) + len(s), kind))
            text += s + (" " if rng.random() < 0.6 else ", " if rng.random() < 0.5 else f" {plain[rng.integers(len(plain))][:int(rng.integers(3, 15))]} ")
        text = (text + p[spans[-1][1]:])[:WIDTH]
        if got:
            out.append((text, got))
    return out


def fit(docs: DataFrame, text_col: str = "text", sample: int = 1600, epochs: int = 6, copies: int = 1) -> Tagger:
    """The tagger, trained on at most ``sample`` different windows of the corpus (chosen by hash). A corpus without
    digits and ``@`` leaves it untrained, which adds nothing: no window is ever decoded."""
    own = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]"))
    schema = StructType([StructField("part", StringType())])

    def run(batches):
        import pyarrow as pa
        for b in batches:
            parts = {t[s:s + WIDTH] for t in b.column(0).to_pylist() if t for s in windows_of(t)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(parts), pa.string())], names=["part"])

    windows = checkpointed(in_arrow(own, run, schema))
    parts = sorted(r.part for r in bounded_sample(windows, ["part"], ["part"], sample).collect())
    tagger = Tagger()
    if parts:
        data = variants(parts, copies)
        x = padded([p for p, _ in data])
        y = np.zeros((len(data), WIDTH), np.int8)
        for i, (p, spans) in enumerate(data):
            y[i, :len(p)] = tagged(len(p), spans)
        tagger.train(x, y, epochs)
    return tagger


@lru_cache(maxsize=2)
def _tagger(packed: tuple) -> Tagger:
    return Tagger(weights={k: np.frombuffer(v, np.float32).reshape(shape) for k, shape, v in packed})


def _finder(tagger: Tagger | None) -> Callable[[list], list[tuple[list[Span], list[Span]]]]:
    packed = tuple((k, v.shape, v.astype(np.float32).tobytes()) for k, v in tagger.w.items()) if tagger else None
    return lambda texts: find_spans([t or "" for t in texts], _tagger(packed) if packed else None)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the number of base spans of each kind, ``base_sha256`` over the base spans
    and ``spans``, all spans. Null texts are empty; null ids and repeated rows are handled like others; texts of any
    length are read whole, in overlapping windows; other columns are ignored; an empty table gives an empty result."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    find = _finder(fit(own))

    def make():
        def work(texts):
            got = find(texts)
            return [[joined_spans(b) for b, _ in got], [joined_spans(a) for _, a in got],
                    *([sum(s[2] == k for s in b) for b, _ in got] for k in KINDS)]
        return work

    out = appended(own, "text", [("base", StringType()), ("spans", StringType()), *((f"n_{k}", LongType()) for k in KINDS)], make)
    return out.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data in the text replaced; ``length_col``, if there, is the new text's length. Null
    texts stay null."""
    find = _finder(fit(docs, text_col))
    name = fresh(docs, "redacted")

    def make():
        return lambda texts: [[None if t is None else redact(t, a) for t, (_, a) in zip(texts, find(texts), strict=True)]]

    out = appended(docs, text_col, [(name, StringType())], make)
    keep = [F.col(name).alias(c) if c == text_col else
            F.coalesce(F.length(name), F.lit(0)).cast(docs.schema[c].dataType).alias(c)
            if c == length_col and isinstance(docs.schema[c].dataType, (IntegerType, LongType)) else F.col(c)
            for c in docs.columns]
    return out.select(*keep)
