"""Embedding near-duplicates by a random-projection tree forest.

Every tree splits the vectors of a label at random directions, again and again; vectors within a margin of a
cut go to both sides (spill). A split is fitted on a bounded sample of a node's vectors and applied to all of
them, so a leaf that is still too large is simply split further in the next round. Inside a leaf all pairs are
compared exactly. A pair that meets in several leaves counts only in the first leaf the two share, which each
vector's list of leaves tells, so no list of pairs is ever written or made distinct: a leaf returns link counts
and the edges of a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketframe.session import ship_package

from .common import checkpointed, in_arrow
from .components import components

NODES = "key long, tree int, leaf long"


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(rows, -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, by way of their largest component, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@lru_cache(maxsize=4096)
def direction(seed: int, dim: int) -> np.ndarray:
    d = np.random.default_rng(seed).standard_normal(dim)
    return d / np.sqrt(d @ d)


def margin(cosine: float, dim: int, width: float) -> float:
    """``width`` standard deviations of how far a pair at the threshold lies apart along a random direction."""
    return width * np.sqrt(2 * (1 - cosine) / dim)


_SPLIT = np.dtype([("seed", "<u4"), ("cut", "<f8"), ("left", "<i4"), ("right", "<i4")])


def grow(x: np.ndarray, rows: int, seed: int, leaf: int, spill: float, most_depth: int = 6) -> bytes:
    """Splits of a node of ``rows`` vectors, fitted on its sample ``x``: an array of (direction, cut, children); a
    child below 0 is a leaf. Leaves are aimed well below ``leaf``, so that few need another round. A cut goes through the widest gap among the middle values of a projection. A node whose
    vectors are so alike that a cut would send nearly all to both sides is not split."""
    out: list[tuple[int, float, int, int]] = []
    share = rows / max(len(x), 1)

    def split(at: np.ndarray, depth: int, path: int) -> int:
        if len(at) * share <= 0.6 * leaf or len(at) < 8 or depth == most_depth:
            return -1
        for attempt in range(4):
            s = int(np.random.SeedSequence([seed, path, attempt]).generate_state(1)[0])
            p = x[at] @ direction(s, x.shape[1])
            v = np.sort(p)
            a, b = int(0.3 * (len(v) - 1)), max(int(0.7 * (len(v) - 1)), int(0.3 * (len(v) - 1)) + 1)
            k = a + int(np.diff(v[a:b + 1]).argmax())
            cut = float((v[k] + v[k + 1]) / 2)
            left, right = at[p <= cut + spill], at[p > cut - spill]
            if max(len(left), len(right)) <= 0.85 * len(at):
                me = len(out)
                out.append((s, cut, -1, -1))
                go = (split(left, depth + 1, 2 * path), split(right, depth + 1, 2 * path + 1))
                out[me] = (s, cut, *go)
                return me
        return -1

    split(np.arange(len(x)), 0, 1)
    return np.array(out, dtype=_SPLIT).tobytes()


def leaves_of(x: np.ndarray, model: bytes, spill: float) -> list[tuple[int, np.ndarray]]:
    """``(leaf number, row numbers)`` of every leaf that rows of ``x`` fall into."""
    splits = np.frombuffer(model, _SPLIT)
    out, todo = [], [(0, 1, np.arange(len(x)))]
    if not len(splits):
        return [(1, np.arange(len(x)))]
    while todo:
        node, path, at = todo.pop()
        seed, cut, left, right = splits[node]
        p = x[at] @ direction(int(seed), x.shape[1])
        for child, number, rows in ((left, 2 * path, at[p <= cut + spill]), (right, 2 * path + 1, at[p > cut - spill])):
            if len(rows):
                if child >= 0:
                    todo.append((int(child), number, rows))
                else:
                    out.append((number, rows))
    return out


def forest_of(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean link matrix."""
    left, out = np.arange(len(near)), []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            reach = near[np.ix_(front, left)]
            hit = reach.any(axis=0)
            out += list(zip(front[reach[:, hit].argmax(axis=0)].tolist(), left[hit].tolist(), strict=True))
            front, left = left[hit], left[~hit]
    return out


def compared(x: np.ndarray, node: np.ndarray, copies: np.ndarray, leaves: list[list[int]], here: int, cosine: float,
             halves: np.ndarray | None = None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of a leaf: every row's number of linked vectors that this leaf accounts for, and forest edges. With
    ``halves`` (0 or 1) only pairs of different halves are looked at."""
    u = unit(x)
    near = (u @ u.T) >= cosine
    np.fill_diagonal(near, False)
    if halves is not None:
        near &= halves[:, None] != halves[None, :]
    edges = forest_of(near)
    before = sorted({c for own in leaves for c in own if c < here})
    if before and edges:
        place = {c: i for i, c in enumerate(before)}
        member = np.zeros((len(x), len(before)), np.float32)
        for i, own in enumerate(leaves):
            member[i, [place[c] for c in own if c < here]] = 1
        near &= (member @ member.T) < 0.5
    return near.astype(np.int64) @ copies, [(int(node[a]), int(node[b])) for a, b in edges]


def _split_round(rows: DataFrame, sizes: DataFrame, sample: int, leaf: int, spill_width: float, cosine: float, seed: int) -> DataFrame:
    """One round of the forest: nodes of more than ``leaf`` vectors are split, all others stay."""
    big = sizes.where((F.col("n") > leaf) & ~F.col("dense"))
    h = F.pmod(F.xxhash64(F.lit(seed), "node", "tree"), F.lit(1 << 30)) / float(1 << 30)
    picked = (rows.join(big, ["key", "tree", "leaf"]).where(h <= F.least(F.lit(1.0), 1.5 * sample / F.col("n")))
              .select("key", "tree", "leaf", "n", "node", "x"))

    def fit(table: pa.Table) -> pa.Table:
        t = table.sort_by("node")
        x = unit(_matrix(t["x"], len(t)))
        key, tree, at = (t[c][0].as_py() for c in ("key", "tree", "leaf"))
        start = int(np.random.SeedSequence([seed, tree, at & (2 ** 63 - 1)]).generate_state(1)[0])
        model = grow(x, t["n"][0].as_py(), start, leaf, margin(cosine, x.shape[1], spill_width))
        return pa.table({"key": pa.array([key], pa.int64()), "tree": pa.array([tree], pa.int32()),
                         "leaf": pa.array([at], pa.int64()), "model": pa.array([model], pa.binary())})

    models = picked.groupBy("key", "tree", "leaf").applyInArrow(fit, f"{NODES}, model binary")
    given = rows.join(models, ["key", "tree", "leaf"], "left").select(*rows.columns, "model")
    schema = StructType([f for f in given.schema.fields if f.name != "model"])
    names = schema.names

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            model = t["model"].to_pylist()
            rest = t.filter(pc.is_null(t["model"])).select(names)
            if len(rest):
                yield from rest.to_batches()
            by: dict[tuple[bytes, int], list[int]] = {}
            for i, (m, dim) in enumerate(zip(model, pc.list_value_length(t["x"]).to_pylist(), strict=True)):
                if m is not None:
                    by.setdefault((m, dim), []).append(i)
            for (m, dim), at in by.items():
                own = t.take(pa.array(at)).select(names)
                x = unit(_matrix(own["x"], len(own)))
                for number, which in leaves_of(x, m, margin(cosine, dim, spill_width)):
                    part = own.take(pa.array(which))
                    leaf_of = np.array([_child(p, number) for p in part["leaf"].to_pylist()], dtype=np.int64)
                    dense = pa.array([number == 1] * len(part))
                    cols = {n: part[n] for n in names} | {"leaf": pa.array(leaf_of), "dense": dense}
                    yield from pa.table([cols[n] for n in names], schema=part.schema).to_batches()

    return in_arrow(given, descend, schema)


def _child(leaf: int, number: int) -> int:
    """A leaf's number below another: unchanged where nothing was split, else mixed into 62 bits."""
    if number == 1:
        return leaf
    return int(np.random.SeedSequence([leaf, number]).generate_state(2, np.uint32).view(np.uint64)[0] >> np.uint64(2))


def linked(vectors: DataFrame, cosine: float = 0.93, trees: int = 6, leaf: int = 1024, sample: int = 2048, spill: float = 0.45,
           rounds: int = 12, seed: int = 17) -> DataFrame:
    """One row per vector of ``vectors(vec_id, embedding, label)``: ``vec_id, n_links, component_id, kept``.

    Vectors link if their labels are equal and not null and their cosine, in double precision, is at least
    ``cosine``. Null, empty and zero vectors, those with null or non-finite components, with null labels or null
    ids link with nothing. Vectors of different lengths are not compared. Equal vectors of a label are one entry
    with a count, so a large group of copies is not expanded; repeated rows are copies.     Leaves that cannot be split
    (too alike) and exceed ``leaf`` are compared block by block; a label that some tree leaves whole is compared once. A null id has no component and is kept.
    Other columns are ignored; an empty table gives an empty result.
    """
    ship_package(vectors.sparkSession)
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    v = vectors.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("x"), F.col("label").cast("string").alias("label"))
    v = v.withColumn("x", F.transform("x", lambda c: F.when(c == 0, F.lit(0.0).cast(kind)).otherwise(c)))
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)
             & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
             & F.exists("x", lambda c: c != 0))
    good = v.where(F.coalesce(sound, F.lit(False)))
    key = F.xxhash64("label", F.size("x"))
    entries = checkpointed(good.groupBy("label", "x").agg(F.min("vec_id").alias("node"), F.count("*").alias("m"))
                           .select(key.alias("key"), "node", "m", "x"))

    rows = (entries.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("leaf", F.lit(0).cast("long"))
            .withColumn("dense", F.lit(False)).select("key", "tree", "leaf", "dense", "node", "m", "x"))
    for k in range(rounds):
        rows = checkpointed(rows) if k else rows  # the first round's rows are the entries, listed once a tree
        sizes = rows.groupBy("key", "tree", "leaf").agg(F.count("*").alias("n"), F.max("dense").alias("dense"))
        if not sizes.where((F.col("n") > leaf) & ~F.col("dense")).limit(1).count():
            break
        rows = _split_round(rows, sizes, sample, leaf, spill, cosine, seed + k)
    else:
        rows = checkpointed(rows)

    found = checkpointed(_compare(_whole_once(rows), leaf, cosine))
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("near"))
    label = components(found.where("b is not null").select("a", "b"))
    per_entry = entries.select("key", "node", "m", "x").join(counts, "node", "left").join(label, "node", "left")
    per_entry = per_entry.select("key", "x", (F.coalesce("near", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                                 F.coalesce("component", "node").alias("component_id"))
    marked = v.withColumn("key", F.when(F.coalesce(sound, F.lit(False)), key))
    out = marked.join(per_entry, ["key", "x"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
                      (F.col("vec_id").isNull() | (F.coalesce("component_id", "vec_id") == F.col("vec_id"))).alias("kept"))


def _whole_once(rows: DataFrame) -> DataFrame:
    """``rows`` without the trees that add nothing: where a tree leaves a label whole (its root, leaf 0, was not split), that one
    leaf holds every pair of the label, so the first such tree stands for all."""
    whole = rows.where("leaf = 0").groupBy("key").agg(F.min("tree").alias("only"))
    return rows.join(whole, "key", "left").where(F.col("only").isNull() | (F.col("tree") == F.col("only"))).drop("only")


def _compare(rows: DataFrame, leaf: int, cosine: float) -> DataFrame:
    """``(a, b, n)``: edges where ``b`` is set, else link counts of ``a``."""
    code = F.xxhash64("tree", "leaf")
    coded = rows.withColumn("code", code)
    lists = coded.groupBy("key", "node").agg(F.collect_set("code").alias("leaves"))  # a few leaves a tree
    sizes = coded.groupBy("key", "code").agg(F.ceil(F.count("*") / leaf).cast("int").alias("blocks"))
    own = coded.select("key", "code", "node", "m", "x").join(lists, ["key", "node"]).join(sizes, ["key", "code"])
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # a leaf of several blocks is compared for every pair of them
    spread = (own.withColumn("i", mine).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("p", F.least("i", "o")).withColumn("q", F.greatest("i", "o"))
              .select("key", "code", "p", "q", "i", "node", "m", "x", "leaves"))

    def work(table: pa.Table) -> pa.Table:
        t = table.sort_by("node")
        p, q = t["p"][0].as_py(), t["q"][0].as_py()
        node = t["node"].to_numpy()
        halves = None if p == q else (t["i"].to_numpy() == q).astype(int)
        near, edges = compared(_matrix(t["x"], len(t)), node, t["m"].to_numpy(), t["leaves"].to_pylist(),
                               t["code"][0].as_py(), cosine, halves)
        some = near > 0
        a = np.concatenate([node[some], np.array([e[0] for e in edges], dtype=np.int64)])
        b = [None] * int(some.sum()) + [e[1] for e in edges]
        n = np.concatenate([near[some], np.zeros(len(edges), np.int64)])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return spread.groupBy("key", "code", "p", "q").applyInArrow(work, "a long, b long, n long")
