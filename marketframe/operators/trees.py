"""Regression trees over binned features, in numpy: what a task of the boosted model (E13) does with its rows, and
the choice of a split from the summed histograms. Imports no Spark, so a Python worker loads it quickly.

A tree is nested ``[feature, threshold, left, right]`` with numbers as leaves; a row goes left if its feature is at
most the threshold. While it is fitted, a feature is its place in the row and a threshold the number of a bin.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LEAST_WEIGHT = 1e-4


def cut_points(values: np.ndarray, counts: np.ndarray, bins: int) -> list[float]:
    """At most ``bins - 1`` thresholds between distinct ascending values, placed as MLlib places them: halfway between
    all neighbours if there are few values, else about every ``1 / bins`` of the count."""
    a, b = values[:-1], values[1:]
    mid = a + (b - a) / 2
    mid = np.where((mid >= a) & (mid < b), mid, a)              # neighbouring floats, infinities
    if len(values) <= bins:
        return [float(x) for x in mid]
    out, seen, stride = [], float(counts[0]), counts.sum() / bins
    target = stride
    for x, n in zip(mid, counts[1:], strict=True):
        if abs(seen - target) < abs(seen + n - target):
            out.append(float(x))
            target += stride
        seen += n
    return out


def walk(tree, x):
    """The leaf each row of the columns ``x[feature]`` ends in."""
    if not isinstance(tree, list):
        return tree
    name, threshold, left, right = tree
    return np.where(x[name] <= threshold, walk(left, x), walk(right, x))


def add_rounds(scores: np.ndarray, rounds: list[list], x, rate: float) -> np.ndarray:
    """``scores`` (a row a class) raised in place by ``rate`` times the leaves of every round's trees."""
    for trees in rounds:
        for c, tree in enumerate(trees):
            scores[c] += rate * walk(tree, x)
    return scores


def softmax(scores: np.ndarray) -> np.ndarray:
    """Class probabilities of scores, shifted by the largest so that none overflows."""
    parts = np.exp(scores - scores.max(axis=0))
    return parts / parts.sum(axis=0)


def probabilities(rows: pa.StructArray, start: list[float], rounds: list[list], rate: float) -> pa.ListArray:
    """Class probabilities of rows with the named features after ``rounds``. A null or NaN feature goes right."""
    x = {f.name: v.to_numpy(zero_copy_only=False) for f, v in zip(rows.type, rows.flatten(), strict=True)}
    scores = add_rounds(np.repeat(np.array(start)[:, None], len(rows), axis=1), rounds, x, rate)
    ends = np.arange(0, scores.size + 1, len(start), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(softmax(scores).T.ravel()))


def to_bins(batches, cuts: list[list[float]]):
    """Feature columns and a label → one byte a feature, the number of its bin, and the label."""
    for batch in batches:
        if any(c.null_count for c in batch.columns):
            raise ValueError("features and labels of training rows must not be null")
        *x, label = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if any(np.isnan(v).any() for v in x):
            raise ValueError("features of training rows must not be NaN")
        raw = np.column_stack([np.searchsorted(t, v) for t, v in zip(cuts, x, strict=True)]).astype(np.uint8).tobytes()
        rows = [raw[i:i + len(cuts)] for i in range(0, len(raw), len(cuts))]
        yield pa.record_batch([pa.array(rows, pa.binary()), pa.array(label, pa.int32())], ["bins", "label"])


def _state(batch, width: int, rounds: list[list], rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins (a row a feature), labels and scores (a row a class) after ``rounds``."""
    n = batch.num_rows
    x = np.ascontiguousarray(np.frombuffer(batch.column(0).buffers()[2], np.uint8, n * width).reshape(n, width).T)
    scores = np.array([c.to_numpy() for c in batch.columns[2:]])
    return x, batch.column(1).to_numpy(), add_rounds(scores, rounds, x, rate)


def with_scores(batches, width: int, rounds: list[list], rate: float):
    """The rows with their scores after ``rounds``."""
    for batch in batches:
        if batch.num_rows:
            scores = _state(batch, width, rounds, rate)[2]
            yield pa.record_batch([*batch.columns[:2], *map(pa.array, scores)], batch.schema.names)


def histograms(batches, width: int, bins: int, rounds: list[list], rate: float, routes: list, nodes: int):
    """Sums of residual and weight p(1 - p) a (class, feature, open node, bin); ``routes`` end in the number of an open
    node or in -1. A task holds and yields one cell of each at most, whatever its rows."""
    sums = np.zeros((2, len(routes), width, nodes * bins))
    for batch in batches:
        if not batch.num_rows:
            continue
        x, label, scores = _state(batch, width, rounds, rate)
        p = softmax(scores)
        for c, route in enumerate(routes):
            node = np.broadcast_to(walk(route, x), len(label))
            is_open = node >= 0
            g = np.where(is_open, (label == c) - p[c], 0.0)
            h = np.where(is_open, np.maximum(p[c] * (1.0 - p[c]), LEAST_WEIGHT), 0.0)
            first = np.where(is_open, node, 0) * bins
            for f in range(width):
                cell = first + x[f]
                sums[0, c, f] += np.bincount(cell, g, nodes * bins)
                sums[1, c, f] += np.bincount(cell, h, nodes * bins)
    g, h = sums.reshape(2, -1)
    cells = np.flatnonzero(h)
    yield pa.record_batch([pa.array(cells, pa.int64()), pa.array(g[cells]), pa.array(h[cells])], ["cell", "g", "h"])


def best_split(g: np.ndarray, h: np.ndarray) -> list | None:
    """``[feature, bin, left value, right value]`` of the split of one node that lowers the weighted variance of
    residual / weight most, or None if none does. ``g``, ``h``: sums a (feature, bin)."""
    gl, hl = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
    gr, hr = (np.flip(np.flip(s, 1).cumsum(axis=1), 1)[:, 1:] for s in (g, h))
    ok = (hl > 0) & (hr > 0)
    gain = np.full(gl.shape, -np.inf)
    gain[ok] = gl[ok] ** 2 / hl[ok] + gr[ok] ** 2 / hr[ok] - (gl[ok] + gr[ok]) ** 2 / (hl[ok] + hr[ok])
    f, b = map(int, np.unravel_index(gain.argmax(), gain.shape))
    return [f, b, float(gl[f, b] / hl[f, b]), float(gr[f, b] / hr[f, b])] if gain[f, b] > 0 else None
