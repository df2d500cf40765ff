"""Cross-entropy difference of documents under two matched bigram models.

A target model (documents labelled good) and a background model (all documents) share one vocabulary, order and
smoothing. A document's score is the mean per-token difference of the two losses, background minus target. The
documents that a model was counted on are scored without their own counts.

Words are 32-bit checksums, so every word of every corpus has its number without a list, and the vocabulary grows
with the corpus. Documents lie in blocks of bounded size. A block sends its different bigrams and words once, with
its own counts, to the partitions of a hash; a partition adds them up over all blocks and answers each block with
the sums, in the order asked. The block then scores its documents. Bytes moved per token do not depend on the size
of the corpus, and neither a model nor a vocabulary is ever whole in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, in_arrow

BOS, EOS, FIRST = 0, 1, 2
ANY = 2 ** 32 - 1  # in the first place of a pair: all occurrences of the second word
MU, ALPHA = 20.0, 0.5  # weight of the unigram model in the bigram's, and of the uniform in the unigram's
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so multiplying by it loses nothing
_PACK = pa.Codec("zstd")


def packed(a: np.ndarray) -> bytes:
    """An array's bytes, compressed; the length goes in front."""
    raw = np.ascontiguousarray(a).tobytes()
    return len(raw).to_bytes(8, "little") + _PACK.compress(raw, asbytes=True)


def unpacked(b: bytes, kind: type) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.frombuffer(_PACK.decompress(b[8:], n, asbytes=True), kind) if n else np.zeros(0, kind)


def packed_codes(c: np.ndarray) -> bytes:
    """Ascending codes as differences, byte planes apart: the high ones are nearly all zero."""
    return packed(np.diff(c, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T)


def unpacked_codes(b: bytes) -> np.ndarray:
    planes = unpacked(b, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def packed_counts(n: np.ndarray) -> bytes:
    """Counts, mostly small, byte planes apart."""
    return packed(n.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)


def unpacked_counts(b: bytes) -> np.ndarray:
    planes = unpacked(b, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel().astype(np.int64)


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def numbers_of(words: list[bytes]) -> np.ndarray:
    """A number for every word: its checksum, clear of the marks. Of n different words about n * n / 2 ** 33 pairs
    share a number and count as one word."""
    c = np.fromiter(map(crc32, words), np.uint64, len(words))
    return (c % np.uint64(ANY - FIRST) + np.uint64(FIRST)).astype(np.uint32)


def pairs_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a document's tokens, its words and the end mark: as bigrams with the word before (the begin mark
    first), and as words alone. Mixed, so that equal shares of the code space hold about equal numbers."""
    line = np.empty(len(ids) + 2, np.uint64)
    line[0], line[1:-1], line[-1] = BOS, ids, EOS
    return (line[:-1] << np.uint64(32) | line[1:]) * _MIX, (np.uint64(ANY) << np.uint64(32) | line[1:]) * _MIX


def is_word(codes: np.ndarray) -> np.ndarray:
    """Which codes are of words alone."""
    return codes * np.uint64(pow(int(_MIX), -1, 2 ** 64)) >> np.uint64(32) == np.uint64(ANY)


def cuts_of(codes: np.ndarray, parts: int) -> np.ndarray:
    """Where each partition's share of ascending codes begins and ends."""
    edges = np.array([-(-(k << 64) // parts) for k in range(1, parts)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(codes, edges), [len(codes)]])


def coded(docs: DataFrame, block_tokens: int) -> DataFrame:
    """``doc_id, target, block, ids``: each text as compressed word numbers, consecutive documents of a task in blocks
    of about ``block_tokens``; a longer document is a block of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = None, 0
        for b in batches:
            if block is None and b.num_rows:
                block = b.column(3)[0].as_py() << 32
            ids, at = [], []
            for text in b.column(2).cast(pa.binary()):
                n = numbers_of(words_of(text.as_py()))
                if size and size + len(n) + 1 > block_tokens:
                    block, size = block + 1, 0
                size += len(n) + 1
                at.append(block)
                ids.append(packed(n))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.int64()), pa.array(ids, pa.binary())],
                                             names=["doc_id", "target", "block", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs.select("doc_id", "target", "text", F.spark_partition_id().alias("place")), run,
                    f"doc_id {kind}, target boolean, block long, ids binary")


def block_counts(lines: list[np.ndarray], target: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's different codes, ascending, with their counts in all and in target documents."""
    both = [np.concatenate(pairs_of(ids)) for ids in lines]
    codes, n = np.unique(np.concatenate(both), return_counts=True)
    t = np.zeros(len(codes), np.int64)
    if any(target):
        own, c = np.unique(np.concatenate([x for x, y in zip(both, target, strict=True) if y]), return_counts=True)
        t[np.searchsorted(codes, own)] = c
    return codes, n, t


def counted(texts: DataFrame, parts: int) -> DataFrame:
    """``part, block, codes, n, t``: every block's different codes, dealt to the partitions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lines, target = None, [], []

        def out() -> pa.RecordBatch:
            codes, n, t = block_counts(lines, target)
            cuts = cuts_of(codes, parts)
            rows = [(p, now, packed_codes(codes[i:j]), packed_counts(n[i:j]), packed_counts(t[i:j]))
                    for p, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if j > i]
            lines.clear()
            target.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                               *(pa.array([r[k] for r in rows], pa.binary()) for k in (2, 3, 4))],
                                              names=["part", "block", "codes", "n", "t"])

        for b in batches:
            for flag, block, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if block != now:
                    if lines:
                        yield out()
                    now = block
                lines.append(unpacked(ids.as_py(), np.uint32))
                target.append(flag)
        if lines:
            yield out()

    return in_arrow(texts.select("target", "block", "ids"), run, "part int, block long, codes binary, n binary, t binary")


def answered(counts: DataFrame, parts: int) -> DataFrame:
    """``block, part, n, t, words``: for every row of ``counts`` the sums over all blocks of its codes' counts, in its
    order. ``words`` is the number of the partition's different words, on one row a partition. A task holds one
    partition: at most the block rows of an equal share of all codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        while rows:  # one turn, unless a task got several partitions
            own = [r for r in rows if r[0] == rows[0][0]]
            rows = [r for r in rows if r[0] != own[0][0]]
            asked = [unpacked_codes(r[2]) for r in own]
            codes, at = np.unique(np.concatenate(asked), return_inverse=True)
            n, t = (np.bincount(at, np.concatenate([unpacked_counts(r[k]) for r in own])).astype(np.int64) for k in (3, 4))
            words = int(np.count_nonzero(is_word(codes)))
            ends = np.cumsum([len(a) for a in asked])
            for i, (r, end, size) in enumerate(zip(own, ends, map(len, asked), strict=True)):
                place = at[end - size:end]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[1]], pa.int64()), pa.array([r[0]], pa.int32()), pa.array([packed_counts(n[place])], pa.binary()),
                     pa.array([packed_counts(t[place])], pa.binary()), pa.array([0 if i else words], pa.int64())],
                    names=["block", "part", "n", "t", "words"])

    return in_arrow(counts.repartitionById(parts, F.col("part")), run, "block long, part int, n binary, t binary, words long")


def loss(pair: np.ndarray, first: np.ndarray, second: np.ndarray, total: int, words: int) -> float:
    """Summed negative log probability of a document's tokens: each bigram's count over its first word's, with the
    unigram model mixed in. A begin mark is never a second word."""
    one = (second + ALPHA) / (total + ALPHA * words)
    return float(-np.log((pair + MU * one) / (first + MU)).sum())


def losses(ids: np.ndarray, target: bool, codes: np.ndarray, n: np.ndarray, t: np.ndarray, sizes: tuple[int, int, int]) -> tuple[int, float, float]:
    """A document's tokens, target loss and background loss, given its block's codes with their counts in all and in
    target documents. Its own counts are left out of every model that it was counted on."""
    words, all_n, all_t = sizes
    pair, word = pairs_of(ids)
    m = len(word)
    _, inverse, own_pair = np.unique(pair, return_inverse=True, return_counts=True)
    own_pair = own_pair[inverse]
    _, inverse, own_word = np.unique(word, return_inverse=True, return_counts=True)
    own_word = own_word[inverse]
    p, w = np.searchsorted(codes, pair), np.searchsorted(codes, word)
    out = []
    for count, total, inside in ((t, all_t, target), (n, all_n, True)):
        second = count[w] - own_word if inside else count[w]
        # the word before; begin marks are as many as end marks
        out.append(loss(count[p] - own_pair if inside else count[p], np.roll(second, 1), second, total - m if inside else total, words))
    return m, out[0] / m, out[1] / m


def scored(docs: DataFrame, good: DataFrame, block_tokens: int = 3_000_000, part_tokens: int = 3_000_000,
           broadcast_ids: int = 500_000) -> DataFrame:
    """One row per document of ``docs(doc_id, text)``: ``doc_id, n_tokens, loss_target, loss_background, score``.

    ``good(doc_id)`` names the target documents. Tokens are words (ASCII letters in lower case, split at white space)
    and the end mark; losses are means per token in nats, ``score = loss_background - loss_target``. A document's own
    counts are left out of the models it is in. A null or empty text is its end mark alone. Documents with null ids
    are background. Repeated rows are separate documents. A very long text is a block of its own, held by one task.
    Other columns are ignored. Without target documents the target model is uniform. An empty table gives an empty
    result.
    """
    flags = checkpointed(good.select("doc_id").where("doc_id is not null").distinct().withColumn("target", F.lit(True)))
    # few enough ids are broadcast, so that no text is shuffled to be marked
    flags = F.broadcast(flags) if flags.count() <= broadcast_ids else flags
    marked = docs.select("doc_id", "text").join(flags, "doc_id", "left").select("doc_id", F.coalesce("target", F.lit(False)).alias("target"), "text")
    texts = checkpointed(coded(marked, block_tokens))  # with every row's block, which the answers name

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = t = 0
        for b in batches:
            for flag, ids in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                m = int.from_bytes(ids.as_py()[:8], "little") // 4 + 1
                n, t = n + m, t + m * flag
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([t], pa.int64())], names=["n", "t"])

    r = in_arrow(texts.select("target", "ids"), sizes, "n long, t long").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).first()
    all_n, all_t = r.n or 0, r.t or 0
    parts = max(1, -(-all_n // part_tokens))
    answers = checkpointed(answered(counted(texts, parts), parts))
    shape = (answers.agg(F.sum("words")).first()[0] or 0, all_n, all_t)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's documents come first, then its answers by partition, which is the order of its codes."""
        now, ids, lines, target, n, t = None, [], [], [], [], []
        id_type = None

        def out() -> pa.RecordBatch:
            codes, _, _ = block_counts(lines, [])
            all_, good_ = np.concatenate(n), np.concatenate(t)
            rows = [losses(x, y, codes, all_, good_, shape) for x, y in zip(lines, target, strict=True)]
            made = pa.RecordBatch.from_arrays([pa.array(ids, id_type), *(pa.array([r[k] for r in rows], pa.int64() if k == 0 else pa.float64()) for k in range(3))],
                                              names=["doc_id", "n_tokens", "loss_target", "loss_background"])
            for x in (ids, lines, target, n, t):
                x.clear()
            return made

        for b in batches:
            id_type = b.column("doc_id").type
            for block, part, doc_id, flag, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != now:
                    if lines:
                        yield out()
                    now = block
                if part < 0:
                    ids.append(doc_id)
                    target.append(flag)
                    lines.append(unpacked(x, np.uint32))
                else:
                    n.append(unpacked_counts(x))
                    t.append(unpacked_counts(y))
        if lines:
            yield out()

    none = F.lit(None)
    both = texts.select("block", F.lit(-1).alias("part"), "doc_id", "target", F.col("ids").alias("x"), none.cast("binary").alias("y")).unionAll(
        answers.select("block", "part", none.cast(kind).alias("doc_id"), none.cast("boolean").alias("target"), F.col("n").alias("x"), F.col("t").alias("y")))
    gathered = both.repartition("block").sortWithinPartitions("block", "part")
    out = in_arrow(gathered, score, f"doc_id {kind}, n_tokens long, loss_target double, loss_background double")
    return out.withColumn("score", F.col("loss_background") - F.col("loss_target"))
