"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items scans every text once.

Texts and items are lower-cased (A-Z) and cut into words, runs of anything but ASCII non-alphanumerics.
Every run of ``window`` consecutive item words is a pattern (an item of fewer words is one pattern). A
document word inside any occurrence of a pattern is hit, and hits are mapped back to the original text.

The automaton reads words, not characters: the items' words are numbered and a pattern is a sequence of numbers, so
it has one state a word and window. A mebibyte of items takes about 130 MB in each worker.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType

from .common import appended, checkpointed, fresh, joined_ids

# ASCII letters in lower case, digits and all bytes of multi-byte characters stay; the rest separates words
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32)
               for c in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")  # in the original: capitals are letters


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def windows_of(words: list[bytes], window: int) -> list[tuple[bytes, ...]]:
    """The distinct patterns of an item."""
    if not words:
        return []
    return sorted({tuple(words[i:i + window]) for i in range(max(1, len(words) - window + 1))})


class Scanner:
    """The automaton over one block of items; texts are scanned as numbers of words, 0 for those of no item."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        import ahocorasick
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            for p in windows_of(words_of(text), window):
                key = tuple(self.number.setdefault(w, len(self.number) + 1) for w in p)
                owners.setdefault(key, set()).add(item_id if item_id is not None else "")
        self.empty = not owners
        self.tree = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        self.shortest = min(map(len, owners), default=0)
        for key, who in owners.items():
            self.tree.add_word(key, (len(key), tuple(sorted(who))))
        if not self.empty:
            self.tree.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, list[int], list[str]]:
        """Number of words, indexes of hit words, ids of the items that occur."""
        words = words_of(text)
        if self.empty or not words:
            return len(words), [], []
        number = self.number.get
        line = np.array([0, *[number(w, 0) for w in words], 0], np.int64)
        # a pattern has words of items only, so the automaton need not read shorter runs of them than any pattern
        edges = np.flatnonzero((line[1:] > 0) != (line[:-1] > 0)).reshape(-1, 2)
        hit: set[int] = set()
        who: set[str] = set()
        for start, stop in edges[edges[:, 1] - edges[:, 0] >= self.shortest].tolist():
            for end, (n, ids) in self.tree.iter(tuple(line[start + 1:stop + 1].tolist())):
                hit.update(range(start + end - n + 1, start + end + 1))
                who.update(ids)
        return len(words), sorted(hit), sorted(who)


def spans_of(text: str, hit: list[int]) -> list[tuple[int, int]]:
    """Original code point spans (end exclusive) of runs of hit words, given their indexes."""
    where = [m.span() for m in _WORD.finditer(text)]
    out: list[tuple[int, int]] = []
    before = -2
    for i in hit:
        if i == before + 1:
            out[-1] = (out[-1][0], where[i][1])
        else:
            out.append(where[i])
        before = i
    return out


@lru_cache(maxsize=1)
def _scanner(items: tuple[tuple[str | None, bytes | None], ...], window: int) -> Scanner:
    return Scanner(list(items), window)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, most_bytes: int) -> list[tuple]:
    """The items in blocks of about ``most_bytes`` of text at most; one block unless the benchmark is larger
    than that. A block is what an automaton holds and what is sent to the tasks."""
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("binary").alias("t")).distinct()
    size = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    n = max(1, -(-int(size) // most_bytes))
    block = F.pmod(F.xxhash64("i", "t"), F.lit(n)).cast("int")
    if n == 1:
        return [tuple(sorted(((r.i, bytes(r.t)) for r in items.where("t is not null").collect()), key=repr))]
    return [tuple(sorted(((r.i, bytes(r.t)) for r in items.where("t is not null").where(block == k).collect()), key=repr))
            for k in range(n)]


def marked(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text", window: int = 10, most_bytes: int = 2 << 20) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with, per row, the number of words, the indexes of hit words, their original spans (code
    points) and the ids of the items that occur; also returns the new columns' names.

    Null texts and items have no words. Repeated items count once. An item id that is null counts as ''.
    The benchmark is a bounded query set; one larger than ``most_bytes`` is scanned block after block with the same
    result, the rows written between two blocks, so that a worker never holds more than one block's automaton. Very
    long texts are scanned whole, other columns stay as they are, an empty table gives an empty result.
    """
    names = {k: fresh(docs, f"bench_{k}") for k in ("words", "hit", "items")}
    out = docs
    parts: list[tuple[str, str]] = []
    for k, block in enumerate(item_blocks(benchmark, item_id, item_text, most_bytes)):
        out = checkpointed(out) if k else out
        n, hit, who = (fresh(docs, f"bench_{x}_{k}") for x in ("n", "h", "w"))

        def make(block=block):
            scan = _scanner(block, window).scan
            return lambda texts: [list(c) for c in zip(*map(scan, texts), strict=True)] or [[], [], []]

        out = appended(out, text_col, [(n, LongType()), (hit, ArrayType(IntegerType())), (who, ArrayType(StringType()))],
                       make, raw=True)
        parts.append((hit, who))
    hits, whos = (F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(p[i]) for p in parts])))) for i in (0, 1))
    out = out.select(*docs.columns, F.col(fresh(docs, "bench_n_0")).alias(names["words"]), hits.alias(names["hit"]),
                     whos.alias(names["items"]))
    return out, names


def hit_spans(docs: DataFrame, names: dict[str, str], text_col: str = "text", name: str = "spans") -> DataFrame:
    """``marked`` rows with the hit runs as spans of the original text."""
    @F.udf("array<struct<start:int,end:int>>", useArrow=True)
    def spans(text, hit):
        return spans_of(text or "", list(hit or []))

    return docs.withColumn(name, spans(F.col(text_col), F.col(names["hit"])))


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    own = docs.select("doc_id", "text")
    out, c = marked(own, benchmark, window=window)
    return out.select("doc_id", F.col(c["words"]).alias("n_words"), F.size(c["hit"]).cast("long").alias("n_hit"),
                      F.size(c["items"]).cast("long").alias("n_items"), joined_ids(F.col(c["items"])).alias("items_sha256"),
                      (F.size(c["hit"]) > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the documents that hold any window of a benchmark item; the rest is unchanged."""
    out, c = marked(docs, benchmark, window=window)
    return out.where(F.size(c["hit"]) == 0).select(*docs.columns)
