"""Registered queries over stored tables and streams: the bar-state table, the archive, clustered files, and streams that
are stopped and started again (S3–S5, S9, S11, S14, S17, S22, R1–R3, R6, R8)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketframe.operators import bars as B
from marketframe.operators import ledger as LG
from marketframe.plans import reports as R
from marketframe.plans.q_market import BAR_COLS, BAR_DOUBLES
from marketframe.plans.q_ops import ARCHIVE_CUTOFF
from marketframe.plans.q_trading import _tsql
from marketframe.plans.registry import register
from marketframe.plans.sql_views import with_views
from marketframe.session import cut_lineage, scratch_path
from marketframe.sources import fixtures as X
from marketframe.sources import sinks as SK
from marketframe.sources.bar_store import BarStore
from marketframe.streaming import stateful as ST

TICK_COLS = ["seq", "timestamp", "timestamp_ms", "symbol", "price", "volume"]


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def stored_bars(spark, sf_dir) -> BarStore:
    """The bar-state table as it grows: history, late ticks of all days, a retried batch, compactions between."""
    t = X.ticks(spark, sf_dir).select(*TICK_COLS)
    store = BarStore(spark, _scratch(spark, "bars"))
    late = F.col("seq") % 10 == 3
    store.append(t.filter(~late & (F.col("seq") % 10 < 8)), "history")
    store.append(t.filter(late), "late")
    store.compact()
    store.append(t.filter(late), "late")                        # a retry after its states were compacted
    store.append(t.filter(F.col("seq") % 10 >= 8), "live")
    return store


@register("stored_bars", with_views(f"SELECT {BAR_COLS} FROM bars", "bars"), BAR_DOUBLES, "S17 S20 U1 A9 A10 X1 X2")
def stored_bars_q(spark, sf_dir):
    store = stored_bars(spark, sf_dir)
    store.compact()
    store.vacuum()
    return store.bars().select(*BAR_COLS.split(", "))


STORED_FROM, STORED_TO = "2024-01-10 06:00:00", "2024-01-17 18:30:00"


@register("stored_reports", with_views(f"""
SELECT symbol, sum(volume) AS total_vol, sum(volume * open) AS total_vol_usd, max(minute) AS last_minute, arg_max(open, minute) AS last_open
FROM bars WHERE minute BETWEEN TIMESTAMP '{STORED_FROM}' AND TIMESTAMP '{STORED_TO}' GROUP BY symbol""", "bars"),
          ["total_vol", "total_vol_usd", "last_open"], "B1 B4 A14 A15 P8 S17")
def stored_reports_q(spark, sf_dir):
    """The volume and price panels over the stored states: only the range's days are opened, no tick is read."""
    b = cut_lineage(stored_bars(spark, sf_dir).bars(STORED_FROM, STORED_TO))
    last = R.current_price(b).select("symbol", F.col("minute").alias("last_minute"), F.col("open").alias("last_open"))
    return R.total_volume(b).join(R.notional_volume(b), "symbol").join(last, "symbol")


@register("archive_round_trip", with_views(f"""
SELECT part, dt, count(*) AS n_rows, sum(volume) AS volume FROM (
  SELECT CASE WHEN minute < TIMESTAMP '{ARCHIVE_CUTOFF}' THEN 'archive' ELSE 'hot' END AS part,
         CAST(strftime(minute, '%Y%m%d') AS INTEGER) AS dt, volume FROM bars) GROUP BY ALL""", "bars"), ["volume"], "S9 S11 S13 S22 U2 P7")
def archive_round_trip_q(spark, sf_dir):
    """Bars stored by day, archived at an earlier and at the final cutoff, the latter run twice, then both tables read."""
    hot, archive = _scratch(spark, "hot"), _scratch(spark, "archive")
    bars = B.ohlcv(X.ticks(spark, sf_dir))
    SK.write_table(bars, hot, ts_col="minute", order=["symbol", "minute"], max_records_per_file=100_000)
    for cutoff in ("2024-01-12 09:30:00", ARCHIVE_CUTOFF, ARCHIVE_CUTOFF):
        SK.archive(spark, hot, archive, "minute", cutoff)
    both = [spark.read.parquet(p).select(F.lit(n).alias("part"), F.col("dt").cast("int").alias("dt"), "volume")
            for n, p in (("archive", archive), ("hot", hot))]
    return both[0].unionByName(both[1]).groupBy("part", "dt").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("volume").alias("volume"))


def _in_files(rows, path, order, files=6):
    """Rows as ``files`` files of consecutive order, the transport of a file stream."""
    rows.repartitionByRange(files, *order).write.mode("append").parquet(path)


def _drained(stream, write, checkpoint, mode="append"):
    """One run of a stream over what is there, a micro-batch a file."""
    q = (stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


@register("stream_bars", with_views(f"SELECT {BAR_COLS} FROM bars", "bars"), BAR_DOUBLES, "S3 S4 S5 R1 R3 S17 U1")
def stream_bars_q(spark, sf_dir):
    """Ticks as a file stream with partial states appended a micro-batch: one run over most ticks in time order, then a
    second run from the same checkpoint over the late ones of all days. Nothing is lost, doubled or dropped as late."""
    src, out, ck = (_scratch(spark, n) for n in ("ticks", "states", "checkpoint"))
    t = X.ticks(spark, sf_dir).select(*TICK_COLS)
    write = ST.bars_partial_append(out, "run")
    late = F.col("seq") % 9 == 4
    for some, files in ((~late, 6), (late, 2)):
        _in_files(t.filter(some), src, ["timestamp", "seq"], files)
        _drained(spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 2).parquet(src), write, ck)
    return B.finalize(spark.read.parquet(out).drop("run_id", "batch_id")).select(*BAR_COLS.split(", "))


@register("stream_windows", with_views(f"""
SELECT {BAR_COLS} FROM bars WHERE minute + INTERVAL 1 MINUTE <= (SELECT max(timestamp) FROM ticks) - INTERVAL 10 MINUTE""", "bars"),
          BAR_DOUBLES, "R2 F1")
def stream_windows_q(spark, sf_dir):
    """Watermarked one-minute windows of a file stream in time order, stopped half-way and started again: every window
    that the watermark has closed, once."""
    src, out, ck = (_scratch(spark, n) for n in ("ticks", "windows", "checkpoint"))
    t = X.ticks(spark, sf_dir).select(*TICK_COLS)
    half = t.agg(F.percentile_approx(F.unix_micros("timestamp"), 0.5)).scalar()
    first = F.unix_micros("timestamp") < half

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    for some in (first, ~first):
        _in_files(t.filter(some), src, ["timestamp", "seq"], 2)
        _drained(ST.bars_watermarked(spark.readStream.schema(t.schema).parquet(src), "10 minutes"), write, ck)
    closed = t.agg((F.max("timestamp") - F.expr("INTERVAL 10 MINUTES"))).scalar()
    got = spark.read.parquet(out).select(*BAR_COLS.split(", "))
    return got.filter(F.col("minute") + F.expr("INTERVAL 1 MINUTE") <= closed)


@register("stream_feed_gaps", with_views("""
SELECT gap_start, gap_end, epoch_us(gap_end - gap_start) / 1e6 AS gap_seconds FROM (
  SELECT lag(timestamp) OVER (ORDER BY timestamp, seq) AS gap_start, timestamp AS gap_end FROM ticks)
WHERE epoch_us(gap_end - gap_start) > 90e6""", "ticks"), ["gap_seconds"], "R6")
def stream_feed_gaps_q(spark, sf_dir):
    """The whole feed's gaps from streamed sessions of its shards. A tick a day after the end in every shard closes the
    last sessions; it opens no gap that is reported."""
    src, out, ck = (_scratch(spark, n) for n in ("ticks", "sessions", "checkpoint"))
    t = X.ticks(spark, sf_dir).select("timestamp", "seq")
    _in_files(t, src, ["timestamp", "seq"], 3)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    stream = lambda: ST.whole_feed_sessions(spark.readStream.schema(t.schema).parquet(src), shards=4)
    _drained(stream(), write, ck)
    end = t.agg((F.max("timestamp") + F.expr("INTERVAL 1 DAY")).alias("timestamp"))
    end.select("timestamp", F.lit(-1).cast("long").alias("seq")).write.mode("append").parquet(src)
    _drained(stream(), write, ck)
    return ST.gaps_between(spark.read.parquet(out).select("session_start", "last_tick"))


POSITION_COLS = ["strategy_name", "symbol", "time", "quantity", "cash_balance", "market_value", "portfolio_value"]


@register("stream_positions", _tsql(f"SELECT {', '.join(POSITION_COLS)} FROM ledger", "ledger"),
          ["quantity", "cash_balance", "market_value", "portfolio_value"], "R8 L1 S21")
def stream_positions_q(spark, sf_dir):
    """The ledger of the recorded log from keyed state: the first half of the log, then the rest from the checkpoint."""
    from marketframe.plans.q_trading import fills
    src, out, ck = (_scratch(spark, n) for n in ("executions", "positions", "checkpoint"))
    log = X.recorded_executions(fills(spark, sf_dir))
    half = log.agg(F.percentile_approx(F.unix_micros("time"), 0.5)).scalar()
    first = F.unix_micros("time") < half

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for some in (first, ~first):
            log.filter(some).coalesce(1).write.mode("append").parquet(src)
            _drained(ST.portfolio_positions(spark.readStream.schema(log.schema).parquet(src)), write, ck, "update")
    finally:
        spark.conf.set(provider, before)
    return spark.read.parquet(out).select(*POSITION_COLS)


@register("clustered_scan", with_views("""
SELECT symbol, count(*) AS n_rows, min(minute) AS first_minute, max(high) AS high, CAST(1 AS BIGINT) AS skips FROM bars
WHERE symbol = 'view' AND minute >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY symbol""", "bars"), ["high"], "S14 S9")
def clustered_scan_q(spark, sf_dir):
    """Bars stored in (symbol, minute) order in small files, a narrow range read back. ``skips`` is 1 where the filter
    selects rows of at most a third of the files, counted by the files the rows come from."""
    path = _scratch(spark, "clustered")
    SK.write_table(B.ohlcv(X.ticks(spark, sf_dir)).repartitionByRange(24, "symbol", "minute").sortWithinPartitions("symbol", "minute"), path)
    t = spark.read.parquet(path)
    files = t.select(F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("f")).scalar()
    own = t.filter((F.col("symbol") == "view") & (F.col("minute") >= F.lit("2024-01-15").cast("timestamp")))
    own = own.select("*", F.col("_metadata.file_path").alias("f"))
    return own.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"), F.min("minute").alias("first_minute"), F.max("high").alias("high"),
                                     F.when(F.count_distinct("f") * 3 <= files, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("skips"))
