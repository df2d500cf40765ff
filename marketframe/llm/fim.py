"""Fill-in-middle transformation by in-place block rotation.

A text is scanned once for its tokens, two token boundaries drawn from the document's id cut it into prefix,
middle and suffix, and three sentinels are inserted at the cuts of a bytearray. Neighbouring segments change
places by three reversals; the inverse rotation and the removal of the sentinels give the text back exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import appended, fresh, in_arrow

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes of every sentinel
PLAIN, PSM, SPM = "plain", "psm", "spm"
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def token_ends(text: bytes) -> np.ndarray:
    """Where every token ends: white space belongs to the word after it, at the end it is a token of its own."""
    if not text:
        return np.zeros(0, np.int64)
    white = _WHITE[np.frombuffer(text, np.uint8)]
    return np.append(np.flatnonzero(white[1:] & ~white[:-1]) + 1, len(text))


def exchange(buf: bytearray, start: int, cut: int, end: int) -> None:
    """``buf[start:cut]`` and ``buf[cut:end]`` change places in the buffer, by three reversals."""
    for i, j in ((start, cut), (cut, end), (start, end)):
        buf[i:j] = buf[i:j][::-1]


def transform(text: bytes, first: int, second: int, form: str) -> bytes:
    """The text with sentinels, cut at byte ``first`` and byte ``second``, in the order of ``form``."""
    if form == PLAIN:
        return text
    buf = bytearray(text)
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buf[at:at] = mark
    middle, suffix = first + MARK, second + 2 * MARK
    exchange(buf, middle if form == PSM else 0, suffix, len(buf))
    return bytes(buf)


def restore(out: bytes, form: str) -> bytes:
    """The exact text that ``transform`` was given. No sentinel occurs in such a text, so the first of each is the cut."""
    if form == PLAIN:
        return out
    buf = bytearray(out)
    start, cut = (buf.find(SUFFIX), buf.find(MIDDLE)) if form == PSM else (0, buf.find(PREFIX))
    exchange(buf, start, cut, len(buf))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buf.find(mark)
        del buf[at:at + MARK]
    return bytes(buf)


def chosen(text: bytes, draw: str, rate: int, spm: int) -> tuple[int, str, int, int]:
    """Number of tokens, form and both cuts of a text, from the hex digits of its draw."""
    ends = token_ends(text)
    n = len(ends)
    a, b, c, d = (int(draw[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not n or c % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, 0, 0
    low, high = sorted((a % (n + 1), b % (n + 1)))
    return n, SPM if d % 100 < spm else PSM, *(int(ends[k - 1]) if k else 0 for k in (low, high))


def _letters(text: bytes, start: int, end: int) -> int:
    """Code points that begin in a span of the text."""
    return int(np.count_nonzero(np.frombuffer(text, np.uint8)[start:end] & 0xC0 != 0x80))


def rotated(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: int = 42, rate: int = 50,
            spm: int = 80) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the transformed text, its form, the number of tokens and the code points of prefix and middle;
    also returns the new columns' names (``n, form, prefix, middle, output``), which clash with none of ``docs``'.

    ``rate`` percent of the texts are cut, ``spm`` percent of those with the suffix in front. Draws depend on seed and
    id alone, so repeated ids draw alike and a null id draws as an empty one. Null texts count as empty; empty texts
    and texts that hold a sentinel stay plain, with null lengths. Texts of any length are cut whole. An empty table
    gives an empty result.
    """
    names = {k: fresh(docs, f"fim_{k}") for k in ("n", "form", "prefix", "middle", "output")}
    draw = fresh(docs, "fim_draw")
    kinds = (LongType(), StringType(), LongType(), LongType(), StringType())
    schema = StructType([*docs.schema.fields, *(StructField(n, t) for n, t in zip(names.values(), kinds, strict=True))])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ns, forms, prefixes, middles, outputs = [], [], [], [], []
            for given, key in zip(b.column(at).cast(pa.binary()), b.column(b.num_columns - 1), strict=True):
                text = given.as_py() or b""
                n, form, first, second = chosen(text, key.as_py(), rate, spm)
                ns.append(n)
                forms.append(form)
                prefixes.append(None if form == PLAIN else _letters(text, 0, first))
                middles.append(None if form == PLAIN else _letters(text, first, second))
                outputs.append(transform(text, first, second, form))
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            cols += [pa.array(ns, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()),
                     pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])

    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return in_arrow(docs.withColumn(draw, F.sha2(key, 256)), run, schema), names


def unrotated(rows: DataFrame, output_col: str, form_col: str, name: str = "restored") -> DataFrame:
    """``rows`` with the texts rebuilt from output and form alone."""
    name, both = fresh(rows, name), fresh(rows, "fim_both")

    def make():
        return lambda given: [[restore((x["o"] or "").encode(), x["f"]).decode() for x in given]]

    out = appended(rows.withColumn(both, F.struct(F.col(output_col).alias("o"), F.col(form_col).alias("f"))), both,
                   [(name, StringType())], make)
    return out.drop(both)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``."""
    out, c = rotated(docs.select("doc_id", "text"))
    back = unrotated(out.drop("text"), c["output"], c["form"])
    return back.select("doc_id", F.col(c["n"]).alias("n"), F.col(c["form"]).alias("form"),
                       F.col(c["prefix"]).alias("prefix_chars"), F.col(c["middle"]).alias("middle_chars"),
                       F.sha2(c["output"], 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
