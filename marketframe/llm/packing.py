"""Hierarchical residual packing: local best-fit, then tree merges of underfull bins as items.

Every task tokenises its documents, cuts those longer than a sequence and packs its own pieces best-fit
decreasing. Bins with at most ``slack`` free places are final. The others become items: groups of at most
``fan_in`` of them are packed best-fit again, round after round, until one group is left.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import checkpointed, in_arrow

WORD_CACHE = 800_000
# lower-case words of ASCII and Latin-1 letters: one piece, already in composed form
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch
# such a word with ASCII punctuation (no apostrophe) behind it, which is a piece of its own
_TAILED = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]+)").fullmatch


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and number the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


class WordIds(dict):
    """Word -> its token ids as little-endian 32-bit bytes, encoded when first met; bounded.

    For a tokenizer whose pieces never cross white space, which drops white space and lowers case (as
    ``word_bpe_49k`` does), the ids of a text are those of its words one after another.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        if _PLAIN(word):  # only the merges are left to do
            piece = word.decode("latin-1")
            piece = piece if piece.isascii() else piece.translate(_LETTERS)
            coded = array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
        elif b"<|" not in word and (m := _TAILED(word)):
            coded = self[m[1]] + self[m[2]]
        else:
            coded = array("I", self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()
        self[word] = coded
        return coded

    def encode(self, text: bytes | None) -> bytes:
        if not text:
            return b""
        if len(self) > WORD_CACHE:
            self.clear()
        words = (text if b"<|" in text else text.lower()).split()  # special tokens are told apart by case
        return b"".join(map(self.__getitem__, words))


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def best_fit(sizes: list[int], room: int) -> list[int]:
    """Bin number of every item: largest first, each into the fullest bin that still takes it."""
    free: list[list[int]] = [[] for _ in range(room + 1)]
    have = 0  # bit r: some bin has r places left
    bins = [0] * len(sizes)
    made = 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        fit = have >> size
        if fit:
            rest = size + ((fit & -fit).bit_length() - 1)
            b = free[rest].pop()
            if not free[rest]:
                have &= ~(1 << rest)
        else:
            b, rest, made = made, room, made + 1
        bins[i] = b
        rest -= size
        if rest:
            free[rest].append(b)
            have |= 1 << rest
    return bins


def placed(sizes: list[int], room: int) -> tuple[list[int], list[int], dict[int, int]]:
    """Bin and offset of every item, in item order inside a bin, and the fill of every bin."""
    bins = best_fit(sizes, room)
    fill: dict[int, int] = {}
    offsets = []
    for b, size in zip(bins, sizes, strict=True):
        offsets.append(fill.get(b, 0))
        fill[b] = offsets[-1] + size
    return bins, offsets, fill


def local_pieces(docs: DataFrame, path: str, room: int, end_id: int, block: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, bin, offset, fill``: each document's pieces, packed with those
    of its task in blocks of about ``block`` pieces."""
    kinds = {"piece": "int", "start": "long", "length": "long", "ids_crc32": "long", "bin": "long", "offset": "long",
             "fill": "long"}
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType),
                         *(f for f in StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in kinds.items())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_type
        coder = _word_ids(path)
        base = TaskContext.get().partitionId() << 36
        end = end_id.to_bytes(4, "little")
        ids: list = []
        rows: list[tuple[int, int, int, int]] = []

        def flush() -> pa.RecordBatch:
            nonlocal ids, rows, base
            bins, offsets, fill = placed([r[2] for r in rows], room)
            cols = [pa.array(ids, type=to_arrow_type(schema["doc_id"].dataType)),
                    pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3)),
                    pa.array([base + b for b in bins], pa.int64()), pa.array(offsets, pa.int64()),
                    pa.array([fill[b] for b in bins], pa.int64())]
            base += len(fill)
            ids, rows = [], []
            return pa.RecordBatch.from_arrays(cols, names=schema.names)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                coded = coder.encode(text.as_py()) + end
                for k, s in enumerate(range(0, len(coded), 4 * room)):
                    part = coded[s:s + 4 * room]
                    ids.append(key)
                    rows.append((k, s // 4, len(part) // 4, zlib.crc32(part)))
                if len(rows) >= block:
                    yield flush()
        if rows:
            yield flush()

    return in_arrow(docs.select("doc_id", "text"), run, schema)


def _merge(items: DataFrame, groups: int, room: int) -> DataFrame:
    """``(bin, fill) -> (bin, into, base, total)``: the items of each hash group packed best-fit again. A new bin
    is named after its smallest member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(g, b, f) for x in batches for g, b, f in zip(*(c.to_pylist() for c in x.columns), strict=True)]
        by: dict[int, list[tuple[int, int]]] = {}
        for g, b, f in got:
            by.setdefault(g, []).append((b, f))
        for _, own in sorted(by.items()):
            own.sort()
            bins, offsets, fill = placed([f for _, f in own], room)
            name: dict[int, int] = {}
            for (b, _), k in zip(own, bins, strict=True):
                name.setdefault(k, b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in ([b for b, _ in own], [name[k] for k in bins], offsets,
                                                   [fill[k] for k in bins])], names=["bin", "into", "base", "total"])

    keyed = items.select(F.pmod(F.xxhash64("bin"), F.lit(groups)).alias("g"), "bin", "fill")
    return in_arrow(keyed.repartition(max(1, groups), "g"), run, "bin long, into long, base long, total long")


def packed(docs: DataFrame, room: int = 2048, tokenizer: str | None = None, end_id: int = 0, slack: int = 8,
           fan_in: int = 50_000, block: int = 200_000) -> DataFrame:
    """Every piece with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null text is empty: its only token is ``end_id``. Only documents longer than ``room`` tokens are cut. Rows
    without an id and repeated rows are packed like others. An empty table gives an empty result.
    """
    path = tokenizer or tokenizer_path()
    own = docs.select("doc_id", "text")
    pieces = checkpointed(local_pieces(own, path, room, end_id, block))
    bins = pieces.where(f"fill < {room - slack}").groupBy("bin").agg(F.max("fill").alias("fill"))
    todo = checkpointed(bins)
    moves = todo.select("bin", F.col("bin").alias("into"), F.lit(0).cast("long").alias("base"))
    left = todo.count()
    while left:
        groups = -(-left // fan_in)
        step = checkpointed(_merge(todo, groups, room))
        moves = (moves.withColumnRenamed("base", "had").join(
            step.select(F.col("bin").alias("into"), F.col("into").alias("next"), F.col("base").alias("more")), "into", "left")
            .select("bin", F.coalesce("next", "into").alias("into"),
                    (F.col("had") + F.coalesce("more", F.lit(0))).alias("base")))
        moves = checkpointed(moves)
        merged = step.where(f"total < {room - slack}").select(F.col("into").alias("bin"), F.col("total").alias("fill"))
        todo = checkpointed(merged.distinct())
        now = todo.count()
        if groups == 1 or now > 0.99 * left:
            break
        left = now
    done = pieces.join(moves, "bin", "left")
    return done.select("doc_id", "piece", "start", "length", "ids_crc32",
                       F.coalesce("into", "bin").alias("sequence_id"),
                       (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))
