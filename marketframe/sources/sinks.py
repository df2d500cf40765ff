"""Table writes and maintenance jobs (S8–S24) on plain Parquet.

Tables are directories of Parquet partitioned by day (``dt``). Writes are appends or dynamic
partition overwrites, so a retried task or a rerun job rewrites whole partitions instead of
duplicating rows; nothing is collected to the driver.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketframe.session import cut_lineage, scratch_path


def with_day(df: DataFrame, ts_col: str, out: str = "dt") -> DataFrame:
    """S13 PARTITION BY toYYYYMMDD(ts)."""
    return df.withColumn(out, F.date_format(F.col(ts_col), "yyyyMMdd").cast("int"))


def write_table(df: DataFrame, path: str, ts_col: str | None = None, order: list[str] | None = None,
                mode: str = "append", max_records_per_file: int | None = None) -> None:
    """S8 append / S13 day partitions / S14 sorted storage / S9 bounded file size.

    ``order`` clusters rows inside each file (ORDER BY of the table) so Parquet min/max statistics
    prune row groups for range filters on those columns.
    """
    w = df
    parts = []
    if ts_col:
        w = with_day(w, ts_col)
        parts = ["dt"]
    if order:
        w = w.repartitionByRange(*(parts + order)).sortWithinPartitions(*(parts + order))      # a large day is many tasks
    writer = w.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if parts:
        writer = writer.partitionBy(*parts)
    if mode == "overwrite" and parts:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def export_parquet(df: DataFrame, path: str, rows_per_file: int = 100000) -> None:
    """Parquet export with bounded files (the modelled export uses 100000-row groups)."""
    df.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(path)


def truncate(spark: SparkSession, path: str, schema) -> None:
    """S19 TRUNCATE: replace the table by an empty one with the same schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def retention_filter(df: DataFrame, ts_col: str, as_of, days: int) -> DataFrame:
    """S12 TTL col + INTERVAL n DAY DELETE: keep rows whose TTL (second-truncated ts + n days) is after as_of."""
    ttl = F.date_trunc("second", F.col(ts_col)) + F.make_dt_interval(F.lit(int(days)))
    return df.filter(ttl > F.lit(as_of).cast("timestamp"))


def split_at(df: DataFrame, ts_col: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """(rows older than cutoff, the rest) — complementary filters, no row lost or doubled."""
    c = F.lit(cutoff).cast("timestamp")
    return df.filter(F.col(ts_col) < c), df.filter(~(F.col(ts_col) < c) | F.col(ts_col).isNull())


def archive(spark: SparkSession, hot_path: str, archive_path: str, ts_col: str, cutoff) -> str:
    """S11 archive job on a day-partitioned table: rows older than ``cutoff`` are appended to the
    archive (day partitions), then the hot table keeps only the rest (S22 predicate delete).

    Safe to run again after a stop anywhere: rows that the archive holds already are not appended twice (a multiset
    difference over the days at hand). The kept rows of the touched days are staged under the shared checkpoint folder
    (a Spark job cannot overwrite a path it is reading), then written back with dynamic partition overwrite; days that
    are entirely old are dropped. The hot read is bounded to days up to the cutoff's, and the archive's to the days that
    the hot table still holds, so a run costs what it moves and not what was archived before. Returns the staging path.
    """
    cut_day = int(datetime.fromisoformat(str(cutoff)).strftime("%Y%m%d"))
    hot = spark.read.parquet(hot_path).filter(F.col("dt") <= cut_day)
    old, keep = split_at(hot, ts_col, cutoff)
    touched = {r["dt"] for r in hot.select("dt").distinct().collect()}                          # one entry per day
    schema = old.schema
    held = _read_if_there(spark, archive_path, schema).filter(F.col("dt").isin(sorted(touched))).select(*schema.names)
    # materialised before the append changes the folder it was read from
    fresh = cut_lineage(old.exceptAll(held))
    fresh.write.mode("append").partitionBy("dt").parquet(archive_path)
    stage = scratch_path(spark, f"archive-stage-{uuid.uuid4().hex}")
    keep.write.mode("overwrite").parquet(stage)
    staged = spark.read.schema(schema).parquet(stage)
    kept = {r["dt"] for r in staged.select("dt").distinct().collect()}
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt")
           .parquet(hot_path))
    _drop_partitions(spark, hot_path, sorted(touched - kept))
    return stage


def _read_if_there(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``, or an empty one while the folder does not exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _drop_partitions(spark: SparkSession, path: str, days: list[int]) -> None:
    """Remove day partitions that no longer hold rows (partition directories, not data rows)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for d in days:
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/dt={d}")
        p.getFileSystem(conf).delete(p, True)


def table_size_mb(spark: SparkSession, path: str, name: str) -> DataFrame:
    """S23 stored size of a file-based table in MB: one row per file, file listing only, no content."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path", "length"))
    return files.agg(F.round(F.sum("length") / F.lit(1024.0 * 1024.0), 2).alias("size_mb")) \
                .select(F.lit(name).alias("table"), "size_mb")


def write_feature_dataset(labelled: DataFrame, path: str) -> None:
    """The labelled feature table per symbol, as Parquet partitioned by symbol."""
    labelled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol").parquet(path)


def read_feature_dataset(spark: SparkSession, path: str, columns: list[str] | None = None,
                         symbols: list[str] | None = None) -> DataFrame:
    """Read back with column pruning and partition pruning on symbol."""
    df = spark.read.parquet(path)
    if symbols:
        df = df.filter(F.col("symbol").isin(list(symbols)))
    return df.select(*columns) if columns else df


def compact_partials(spark: SparkSession, partial_path: str, out_path: str) -> None:
    """S17 compaction: merge all partial-state rows of each (symbol, minute) into one and write the
    compacted table by day (a new path; readers switch over, then old batches can be dropped)."""
    from marketframe.operators.bars import merge_partials
    p = spark.read.parquet(partial_path)
    p = p.drop(*[c for c in ("run_id", "batch_id", "dt") if c in p.columns])
    write_table(merge_partials(p), out_path, ts_col="minute", order=["symbol", "minute"], mode="overwrite")
