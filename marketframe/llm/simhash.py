"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint is the bit majority of its word shingles' 64-bit hashes. To find every pair of
fingerprints within ``radius`` bits, each bit position gets a non-zero vector of ``radius + 1`` bits; table
``v`` (every non-zero vector) compares only the positions whose vector has an odd product with ``v``. The
at most ``radius`` positions where two near fingerprints differ span a space that some ``v`` is orthogonal
to, so that table hides all of them and the pair collides there: no pair within the radius is missed.
Buckets are compared on distinct fingerprints only, so a group of exact copies is one entry.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import appended, checkpointed, fresh, in_arrow
from .components import components

BITS = 64


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit SimHash of a text: ASCII lower case, words between ASCII white space, XXH64 (seed 42)
    of each run of ``shingle`` words; fewer words are one shingle, no word gives zero."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxh64_intdigest(line, 42)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1]
        hashes = np.fromiter((xxh64_intdigest(line[s:e], 42) for s, e in
                              zip(starts.tolist(), ends[shingle - 1:].tolist(), strict=True)),
                             dtype=np.uint64, count=len(starts))
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 4, name: str = "fp") -> DataFrame:
    """``docs`` with the column ``name``: the SimHash as a signed long. Null and empty texts give 0."""
    def make():
        return lambda texts: [[fingerprint(t, shingle) for t in texts]]

    return appended(docs, text_col, [(name, LongType())], make, raw=True)


def covering_masks(radius: int, bits: int = BITS, seed: int = 42) -> list[int]:
    """The ``2 ** (radius + 1) - 1`` bit masks, as signed longs. Positions get vectors evenly, in a seeded
    random order, so that every mask keeps about half of the positions."""
    vectors = list(range(1, 2 ** (radius + 1)))
    order = (vectors * (bits // len(vectors) + 1))[:bits]
    random.Random(seed).shuffle(order)
    masks = []
    for v in vectors:
        m = sum(1 << i for i, a in enumerate(order) if (a & v).bit_count() % 2)
        masks.append(m - (1 << bits) if m >= 1 << (bits - 1) else m)
    return masks


def _bucket_forest(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """For each bucket (a list of fingerprints) the edges of a spanning forest of its links."""
    import numpy as np

    for b in batches:
        a_out: list[int] = []
        b_out: list[int] = []
        for members in b.column(0).to_pylist():
            x = np.array(sorted(members), dtype=np.int64)
            left = np.arange(len(x))
            while len(left):
                front, left = left[:1], left[1:]
                while len(front) and len(left):
                    near = np.bitwise_count((x[front][:, None] ^ x[left][None, :]).view(np.uint64)) <= radius
                    hit = near.any(axis=0)
                    a_out += x[front[near[:, hit].argmax(axis=0)]].tolist()
                    b_out += x[left[hit]].tolist()
                    front, left = left[hit], left[~hit]
        yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])


def near_links(fps: DataFrame, radius: int = 4, largest: int = 512) -> DataFrame:
    """Edges ``(a, b)`` between the distinct fingerprints ``fps(fp)`` whose components are exactly those of
    "at most ``radius`` bits differ".

    Buckets of up to ``largest`` fingerprints are compared inside and give a spanning forest. In larger ones
    two near fingerprints share a point at most ``radius / 2`` flips of the table's hidden bits away from
    both, so every member is listed under each such point and linked to the point's smallest member: as
    complete, with work in proportion to the bucket. Either way no bucket lists all its pairs.
    """
    if radius % 2 or not 0 < radius <= 4:
        raise ValueError("radius must be 2 or 4")
    masks = covering_masks(radius)
    tables = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks]))
                        .alias("t", "k"))
    sizes = (tables.groupBy("t", "k").agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
             .where("n > 1"))
    sizes = checkpointed(sizes)
    far = F.bit_count(F.col("lo").bitwiseXOR(F.col("hi")))
    two = sizes.where("n = 2").where(far <= radius).select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    more = checkpointed(tables.join(sizes.where("n > 2").select("t", "k", "n"), ["t", "k"]))

    lists = more.where(f"n <= {int(largest)}").groupBy("t", "k").agg(F.collect_list("fp").alias("f")).select("f")
    forest = in_arrow(lists, lambda it: _bucket_forest(it, radius), "a long, b long")

    hidden = []
    for m in masks:
        free = [i for i in range(BITS) if not (m >> i) & 1]
        flips = [0, *(1 << i for i in free)]
        if radius == 4:
            flips += [(1 << i) | (1 << j) for n, i in enumerate(free) for j in free[:n]]
        hidden.append([f - (1 << BITS) if f >= 1 << (BITS - 1) else f for f in flips])

    def points(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        flips = [np.array(h, dtype=np.int64) for h in hidden]
        for b in it:
            for t, fp in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                p = flips[t] ^ np.int64(fp)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), t, np.int32)), pa.array(p), pa.array(np.full(len(p), fp, np.int64))],
                    names=["t", "p", "fp"])

    spread = in_arrow(more.where(f"n > {int(largest)}").select("t", "fp"), points, "t int, p long, fp long")
    hubs = spread.groupBy("t", "p").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z")
    stars = spread.join(hubs.select("t", "p", "a"), ["t", "p"]).where("fp <> a").select("a", F.col("fp").alias("b"))
    return two.unionAll(forest).unionAll(stars.distinct())


def near_classes(fps: DataFrame, radius: int = 4) -> DataFrame:
    """``(fp, class)`` for the distinct fingerprints ``fps(fp)`` that are linked to another one; class is the
    smallest fingerprint (signed) reachable. Fingerprints without links are absent."""
    return components(near_links(fps, radius)).select(F.col("node").alias("fp"), F.col("component").alias("class"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                     radius: int = 4) -> DataFrame:
    """One row per document: ``doc_id, fp, class, component_id`` (smallest id of its group, itself included).

    Null texts have no words, like empty ones: their fingerprint is zero and they link like any other.
    Rows without an id are grouped too but never name a group; a group of such rows only has a null
    ``component_id``. Repeated rows give repeated result rows. An empty table gives an empty result.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fp = checkpointed(fingerprints(own, "text", shingle).select("doc_id", "fp"))
    least = checkpointed(fp.groupBy("fp").agg(F.min("doc_id").alias("first")))
    classes = near_classes(least.select("fp"), radius)
    named = least.join(classes, "fp", "left").select("fp", "first", F.coalesce("class", "fp").alias("class"))
    group = checkpointed(named.groupBy("class").agg(F.min("first").alias("component_id")))
    label = checkpointed(named.join(group, "class").select("fp", "class", "component_id"))
    return fp.join(label, "fp").select("doc_id", "fp", "class", "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 radius: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest id. Of several rows of the group with
    that id, or of a group without ids, the smallest row (column by column) stays. An id on unlike texts names each
    of their groups, or those where it is the smallest."""
    groups = checkpointed(duplicate_groups(docs, id_col, text_col, shingle, radius))
    names = F.col("doc_id") == F.col("component_id")
    own = (groups.where("doc_id is not null").groupBy("doc_id")
           .agg(F.count("*").alias("n"), F.max(names).alias("names")).where("names"))
    tag, key, part = fresh(docs, "copies"), fresh(docs, "fp"), fresh(docs, "class")
    rows = docs.join(own.select(F.col("doc_id").alias(id_col), F.col("n").alias(tag)), id_col)
    once = rows.where(F.col(tag) == 1).select(*docs.columns)
    # an id on several rows: the text tells which group a row is in
    several = fingerprints(rows.where(F.col(tag) > 1).select(*docs.columns), text_col, shingle, key)
    named = groups.where(names).join(own.where("n > 1").select("doc_id"), "doc_id", "left_semi")
    named = named.select(F.col("doc_id").alias(id_col), F.col("fp").alias(key), F.col("class").alias(part)).distinct()
    again = _smallest(several.join(named, [id_col, key]), docs, part)

    nameless = groups.where("component_id is null").select(F.col("fp").alias(key), F.col("class").alias(part))
    blank = fingerprints(docs.where(F.col(id_col).isNull()), text_col, shingle, key)
    return once.unionByName(again).unionByName(_smallest(blank.join(nameless.distinct(), key), docs, part))


def _smallest(rows: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """The smallest row of each ``key``, by a pre-aggregated minimum over whole rows (map columns, which
    have no order, are carried but not compared)."""
    order = [f.name for f in docs.schema.fields if "map" not in f.dataType.simpleString()]
    return (rows.groupBy(F.col(key).alias("__key"))
            .agg(F.min_by(F.struct(*docs.columns), F.struct(*order)).alias("__row")).select("__row.*"))


def simhash_hex(col: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))
