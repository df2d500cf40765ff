"""Helpers shared by the text operators: lineage cuts, bounded samples, row-wise Arrow columns, list joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from marketframe.session import ensure_checkpoint_dir, ship_package


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written to the shared checkpoint folder, so later steps neither recompute
    them nor depend on the executors that made them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that clashes with none of ``df``'s (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def appended(df: DataFrame, column: str, fields: list[tuple[str, DataType]],
             make: Callable[[], Callable[[list], list[list]]], raw: bool = False) -> DataFrame:
    """``df`` with columns computed in Python from one column, row by row, in Arrow batches.

    ``make()`` runs once per task and returns a function from the column's values (None for null; with
    ``raw`` a text's UTF-8 bytes) to one list per new field. All other columns pass through untouched.
    """
    schema = StructType([*df.schema.fields, *(StructField(n, t) for n, t in fields)])
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        work = make()
        kinds = [to_arrow_type(t) for _, t in fields]
        for b in batches:
            given = b.column(at)
            new = work((given.cast(pa.binary()) if raw else given).to_pylist())
            cols = [b.column(i) for i in range(b.num_columns)]
            cols += [pa.array(v, type=k) for v, k in zip(new, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])

    return in_arrow(df, run, schema)


def bounded_sample(df: DataFrame, keys: list[str], cols: list[str], size: int, seed: int = 7,
                   rows: int | None = None) -> DataFrame:
    """At most ``size`` rows, chosen by the hash of ``keys`` (the same rows at every partitioning).

    Rows with equal keys count once, so a hot key cannot fill the sample. The hash threshold keeps about
    twice the wanted rows before the exact cut, so only a bounded number of rows meets in the last task.
    """
    rows = df.count() if rows is None else rows
    h = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    share = min(1.0, 2.0 * size / max(rows, 1) + 64.0 / max(rows, 1))
    top = int(-(2 ** 63) + share * (2 ** 64 - 1)) if share < 1 else 2 ** 63 - 1
    picked = (df.select(h.alias("__h"), *cols).where(F.col("__h") <= F.lit(top).cast("long"))
              .groupBy("__h").agg(F.min(F.struct(*cols)).alias("__r")))
    return picked.orderBy("__h").limit(size).select("__r.*")


def joined_ids(values: Column) -> Column:
    """Lower-case SHA-256 of an array's strings, sorted and joined with commas (empty array: of '')."""
    return F.sha2(F.array_join(F.array_sort(values), ","), 256)
