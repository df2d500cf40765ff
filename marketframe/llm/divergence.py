"""Source divergence audit by one-hot level products.

In a block of terms every (group, count level) is an indicator column: 1 where the term occurs that often in the
group, level 0 included. The matrix times its transpose holds every joint table of two groups at once: how many
terms have count c in one and d in the other. A cell is priced once, by both groups' smoothed probabilities of
such counts, so a pair's divergence is the sum of its priced cells. Blocks (terms by hash, sources by hash) are
multiplied apart and their exact integer sums added.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketframe.session import ship_package

from .common import checkpointed, in_arrow

SCALE = 10 ** 9
# ASCII letters in lower case and all bytes of multi-byte characters stay; the rest separates terms
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def occurrences(docs: DataFrame, most: int = 500_000) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of every term, added up within each task; a task
    holds about ``most`` entries before it passes them on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), own in held.items():
                k = len(own)
                cols = [pa.array([lang], pa.string()).take(pa.array(np.zeros(k, np.int64))),
                        pa.array([source], pa.string()).take(pa.array(np.zeros(k, np.int64))),
                        pa.array(list(own), pa.binary()).cast(pa.string())]
                both = np.array(list(own.values()), np.int64).reshape(k, 2)
                cols += [pa.array(both[:, 0]), pa.array(both[:, 1])]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "source", "term", "n", "docs"])
            held.clear()

        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()), strict=True):
                own = held.setdefault((lang, source), {})
                before = len(own)
                for term, c in Counter(terms_of(text.as_py())).items():
                    have = own.get(term)
                    if have is None:
                        own[term] = [c, 1]
                    else:
                        have[0] += c
                        have[1] += 1
                size += len(own) - before
                if size > most:
                    yield from out()
                    size = 0
        yield from out()

    return in_arrow(docs.select("lang", "source", "text"), run, "lang string, source string, term string, n long, docs long")


def kept_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """``lang, source, term, n, total, first``: counts of the terms in at least ``min_docs`` documents of their
    language, with the language's count; ``first`` is 1 on one row of each term. One shuffle by (lang, term): its
    rows are sums of tasks already, so a frequent term has no more than tasks times sources."""
    term = Window.partitionBy("lang", "term")
    return (occurrences(docs).repartition("lang", "term")
            .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .withColumn("seen", F.sum("docs").over(term)).where(F.col("seen") >= min_docs)
            .withColumn("total", F.sum("n").over(term))
            .withColumn("first", (F.row_number().over(term.orderBy("source")) == 1).cast("long"))
            .select("lang", "source", "term", "n", "total", "first"))


def probabilities(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 2) / (n + 2 * v))``, exact at any size."""
    return np.array([1 + SCALE * (int(c) + 2) // (n + 2 * v) for c in counts], np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)**2 / (p + q))``: both are at most SCALE + 1, so the square fits 64 bits."""
    return (p - q) ** 2 // (p + q)


def indicators(counts: np.ndarray, sizes: list[int], v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One-hot columns of a (terms, groups) count matrix, each column's probability, each group's first column."""
    cols, p, starts = [], [], []
    width = 0
    for g, n in enumerate(sizes):
        levels, at = np.unique(counts[:, g], return_inverse=True)
        starts.append(width)
        cols.append(at + width)
        p.append(probabilities(levels, n, v))
        width += len(levels)
    x = np.zeros((len(counts), width), np.float32)
    x[np.arange(len(counts))[:, None], np.stack(cols, axis=1)] = 1
    return x, np.concatenate(p), np.array(starts)


def pair_sums(counts: np.ndarray, left: list[int], right: list[int], sizes: list[int], v: int, widest: int = 2048) -> np.ndarray:
    """Summed prices of the terms for all pairs of a left and a right group. Terms are cut until a block has few
    columns; a cell counts at most 2 ** 24 terms, where float32 products are still exact integers."""
    if not (len(counts) and left and right):
        return np.zeros((len(left), len(right)), np.int64)
    levels = sum(len(np.unique(counts[:, g])) for g in {*left, *right})
    if len(counts) > 64 and levels > widest or len(counts) > 1 << 16:
        half = len(counts) // 2
        return sum(pair_sums(part, left, right, sizes, v, widest) for part in (counts[:half], counts[half:]))
    x, p, at = indicators(counts[:, left], [sizes[g] for g in left], v)
    y, q, to = (x, p, at) if left == right else indicators(counts[:, right], [sizes[g] for g in right], v)
    joint = (x.T @ y).astype(np.int64)  # terms by (group, level) and (group, level)
    priced = joint * price(p[:, None], q[None, :])
    return np.add.reduceat(np.add.reduceat(priced, at, axis=0), to, axis=1)


def _top(source: str, item: np.ndarray, rank: np.ndarray, value: np.ndarray, most: int) -> list[tuple[str, int, int]]:
    order = np.lexsort((rank, -value))[:most]
    return [(source, int(item[i]), int(value[i])) for i in order]


def multiplied(entries: pa.Table, groups: pa.Table, most: int) -> pa.Table:
    """One block of terms for two blocks of sources: every pair's part of its divergence and, where both blocks of
    sources are the same, each group's ``most`` most over-represented terms of the block."""
    names = groups["source"].to_pylist()
    sizes, sides = groups["size"].to_pylist(), groups["side"].to_pylist()
    a, b, v, n_lang = (groups[c][0].as_py() for c in ("a", "b", "v", "n_lang"))
    lang = groups["lang"][0].as_py()
    place = {s: k for k, s in enumerate(names)}
    coded = entries["term"].combine_chunks().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.array([place[s] for s in entries["source"].to_pylist()], np.int64)
    n, total = entries["n"].to_numpy(), entries["total"].to_numpy()
    m = len(coded.dictionary)
    counts = np.zeros((m, len(names)), np.int64)
    counts[code, group] = n
    by_size = counts[np.argsort(counts.sum(axis=1), kind="stable")]  # terms of like frequency share levels
    left = [k for k, s in enumerate(sides) if s == a]
    right = left if a == b else [k for k, s in enumerate(sides) if s == b]
    sums = pair_sums(by_size, left, right, sizes, v)
    none = {g: probabilities(np.zeros(1), sizes[g], v) if v else np.ones(1, np.int64) for g in {*left, *right}}
    rows = []
    for i, g in enumerate(left):
        for j, h in enumerate(right):
            if g != h:
                absent = int(price(none[g], none[h])[0])
                rows.append((lang, names[g], "pair", names[h], int(sums[i, j]), m, v, absent))
                if a != b:
                    rows.append((lang, names[h], "pair", names[g], int(sums[i, j]), m, v, absent))
    if a == b and m:
        words = coded.dictionary.cast(pa.binary())
        rank = np.empty(m, np.int64)
        rank[pc.sort_indices(words).to_numpy()] = np.arange(m)
        q = probabilities(total, n_lang, v)
        for g in left:
            own = np.flatnonzero(group == g)
            p = probabilities(n[own], sizes[g], v)
            own, p = own[p > q[own]], p[p > q[own]]
            for source, item, value in _top(names[g], code[own], rank[code[own]], price(p, q[own]), most):
                rows.append((lang, source, "term", coded.dictionary[item].as_py(), value, 0, v, 0))
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                names=["lang", "source", "part", "item", "value", "seen", "v", "absent"])


def audited(docs: DataFrame, min_docs: int = 10, top_terms: int = 10, entries_a_block: int = 100_000,
            sources_a_block: int = 64, broadcast_rows: int = 50_000) -> DataFrame:
    """One row per group and other source of its language (``part`` pair) or over-represented term (``part`` term,
    the first ``top_terms``): ``lang, source, part, item, value, rank``.

    Groups are all (lang, source) of ``docs(text, lang, source)``, nulls read as ''. Repeated rows are separate
    documents, texts of any length are counted whole, other columns are ignored. A language without kept terms has
    pairs of value 0; a group without terms meets its pairs with level 0 alone. Ties in value are ranked by item. An
    empty table gives an empty result. A block holds about ``entries_a_block`` counts of at most two blocks of
    sources; nothing is collected to the driver.
    """
    own = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = checkpointed(kept_counts(own, min_docs))
    per_lang = kept.groupBy("lang").agg(F.sum("first").alias("v"), F.sum("n").alias("n_lang"), F.count("*").alias("rows"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = own.select("lang", "source").distinct()
    shapes = (groups.groupBy("lang").agg(F.count("*").alias("g")).join(per_lang, "lang", "left")
              .select("lang", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("v", "n_lang")),
                      F.ceil(F.col("g") / sources_a_block).cast("int").alias("sides"),
                      F.greatest(F.lit(1), F.ceil(F.coalesce("rows", F.lit(0)) / entries_a_block)).cast("int").alias("blocks")))
    shapes = checkpointed(shapes)
    # one row a language; beyond a size that is safe to broadcast it is joined by shuffle, large languages split by AQE
    shaped = F.broadcast(shapes) if shapes.count() <= broadcast_rows else shapes
    side = F.pmod(F.xxhash64("source"), F.col("sides")).cast("int")
    groups = checkpointed(groups.join(sizes, ["lang", "source"], "left").join(shaped, "lang")
                          .withColumn("size", F.coalesce("size", F.lit(0))).withColumn("side", side))

    def meeting(rows: DataFrame) -> DataFrame:
        """Rows in every pair of source blocks that their own belongs to."""
        other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        return other.withColumn("a", F.least("side", "other")).withColumn("b", F.greatest("side", "other"))

    key = ["lang", "block", "a", "b"]
    entries = meeting(kept.join(shaped, "lang").drop("v", "n_lang").withColumn("side", side)
                      .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")))
    heads = meeting(groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return multiplied(left, right, top_terms)

    ship_package(docs.sparkSession)
    parts = (entries.select(*key, "source", "term", "n", "total").groupBy(*key)
             .cogroup(heads.select(*key, "source", "size", "side", "v", "n_lang").groupBy(*key))
             .applyInArrow(run, "lang string, source string, part string, item string, value long, seen long, v long, absent long"))
    # a term is in one block; a pair is in all of them, and terms that neither block of sources has are priced here
    summed = parts.groupBy("lang", "source", "part", "item").agg(
        (F.sum("value") + (F.max("v") - F.sum("seen")) * F.max("absent")).alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (summed.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top_terms))
            .select("lang", "source", "part", "item", "value", "rank"))
