"""Byte-balanced shards by Karmarkar-Karp differencing over indivisible groups of equal texts.

Groups above ``1 / units`` of all bytes are units of their own (at most ``units`` of them); all others meet
in ``units`` hash parcels. At most ``2 * units`` sizes therefore reach the differencing, however large the
corpus, and a unit is never split, so no group is.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import checkpointed


def karmarkar_karp(sizes: list[int], shards: int) -> list[int]:
    """Shard of every item. Each item starts as a partial partition (itself and ``shards - 1`` empty sets); the
    two partial partitions of largest spread are combined again and again, the largest set of one with the
    smallest of the other. Ties are settled by item order."""
    if not sizes:
        return []
    if shards == 1:
        return [0] * len(sizes)
    # a set is (size less the smallest of its partition, tree of items); sets in descending order
    heap = [(-s, i, [(s, i)] + [(0, None)] * (shards - 1)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        sets = [(x + y, t if u is None else u if t is None else (t, u)) for (x, t), (y, u) in zip(a, reversed(b), strict=True)]
        sets.sort(key=lambda s: -s[0])
        low = sets[-1][0]
        if low:
            sets = [(x - low, t) for x, t in sets]
        heapq.heappush(heap, (-sets[0][0], min(i, j), sets))
    out = [0] * len(sizes)
    for shard, (_, tree) in enumerate(heap[0][2]):
        todo = [] if tree is None else [tree]
        while todo:
            t = todo.pop()
            if isinstance(t, tuple):
                todo += t
            else:
                out[t] = shard
    return out


def _table(docs: DataFrame, rows: list[tuple[int, int]]) -> DataFrame:
    schema = StructType([StructField("unit", LongType()), StructField("to", IntegerType())])
    return F.broadcast(docs.sparkSession.createDataFrame(rows, schema))


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 24, units_a_shard: int = 1024,
            rows_a_block: int = 100_000) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    Size is the text's UTF-8 bytes plus 8. Documents with equal texts share a shard; null and empty texts are
    equal (no bytes, checksum 0). Slots number a shard's documents without gaps from 0, by id within hash
    blocks. Null ids and repeated rows are numbered like others, texts of any length weigh by their whole
    bytes; other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = checkpointed(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_key")))
    units = shards * units_a_shard
    groups = checkpointed(own.groupBy("text_key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
    total, rows = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    limit = total / units
    parcel = F.pmod(F.col("text_key"), F.lit(units))
    large = [(r.text_key, r.bytes) for r in groups.where(F.col("bytes") > limit).select("text_key", "bytes").collect()]
    small = [(r.unit, r.bytes) for r in groups.where(F.col("bytes") <= limit).groupBy(parcel.alias("unit"))
             .agg(F.sum("bytes").alias("bytes")).collect()]
    items = [(False, *x) for x in sorted(small)] + [(True, *x) for x in sorted(large)]
    to = karmarkar_karp([size for _, _, size in items], shards)
    own_units = _table(docs, [(key, s) for (alone, key, _), s in zip(items, to, strict=True) if alone])
    parcels = _table(docs, [(key, s) for (alone, key, _), s in zip(items, to, strict=True) if not alone])

    placed = (own.join(own_units.withColumnRenamed("to", "alone"), own["text_key"] == F.col("unit"), "left").drop("unit")
              .join(parcels, parcel == F.col("unit"), "left").drop("unit")
              .select("doc_id", "size", "text_crc32", F.coalesce("alone", "to").alias("shard"),
                      F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(max(1, -(-rows // rows_a_block)))).alias("block")))
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    ahead = _before(counts)
    from pyspark.sql import Window
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "size", "text_crc32")
    return (placed.withColumn("k", F.row_number().over(inside) - 1).join(ahead, ["shard", "block"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("k")).cast("long").alias("slot")))


def _before(counts: DataFrame) -> DataFrame:
    """``(shard, block, before)``: rows of the shard in earlier blocks; one row per block, not per document."""
    from pyspark.sql import Window
    w = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("shard", "block", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
