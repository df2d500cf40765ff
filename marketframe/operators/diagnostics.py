"""Feed diagnostics: heartbeat windows (R5) and feed-gap detection (R6), batch forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketframe import config as C
from marketframe.operators.scan import MIN_BLOCK_ROWS, blocked, blocked_scan
from marketframe.session import cut_lineage


def _epoch_ms(ts) -> int:
    from datetime import datetime, timezone
    d = datetime.fromisoformat(str(ts))
    d = d if d.tzinfo else d.replace(tzinfo=timezone.utc)
    return int(d.timestamp() * 1000)


def window_end_ms(period_ms: int, insert_time: str = "insert_time") -> Column:
    """End b (epoch ms) of the heartbeat window (a, b] that holds an insert time, b on the period grid."""
    return (F.ceil(F.unix_millis(insert_time) / F.lit(period_ms)) * F.lit(period_ms)).cast("long")


def window_means(window_ms: Column) -> list[Column]:
    """Per-window means as micros, taken of the offsets from the window end: these are small numbers, so the double
    sum behind the mean stays exact, where a sum of epoch micros loses digits."""
    base = window_ms * F.lit(1000)
    return [(F.floor(F.avg(F.unix_micros(c) - base)).cast("long")).alias(o)
            for c, o in (("timestamp", "__ts"), ("received_at", "__rc"), ("insert_time", "__in"))]


def heartbeat_columns() -> list[Column]:
    """Diagnostics row from a window (__w, ms), the offset means and the count."""
    def at(c: str) -> Column:
        return F.timestamp_micros(F.col(c) + F.col("__w") * F.lit(1000))
    return [at("__ts").alias("avg_timestamp"), at("__rc").alias("avg_received_at"), at("__in").alias("avg_processed_timestamp"),
            ((F.col("__rc") - F.col("__ts")) / F.lit(1e6)).alias("avg_websocket_lag"),
            ((F.col("__in") - F.col("__rc")) / F.lit(1e6)).alias("avg_processing_lag"),
            F.coalesce(F.col("__n"), F.lit(0)).cast("double").alias("message_count"),
            F.timestamp_millis("__w").alias("diagnostics_timestamp")]


def heartbeat(ticks: DataFrame, period_s: int = C.HEARTBEAT_S, start=None, end=None,
              keep_empty: bool = True) -> DataFrame:
    """Per heartbeat window (a, b] of insert time, b on a ``period_s`` grid: mean event, receive and
    insert time, websocket lag = mean(recv) − mean(event), processing lag = mean(insert) − mean(recv)
    in seconds, and the message count. ``keep_empty`` adds windows without ticks (NULL means, count 0)
    between ``start`` and ``end`` (default: the data's range), as the live job writes a row every period even
    when the feed is down.

    One pass over the ticks: the window rows are materialised, and each one then brings the empty windows since
    the one before it.
    """
    ms = period_s * 1000
    t = ticks.filter(F.col("insert_time").isNotNull())
    if start is not None:
        t = t.filter(F.col("insert_time") > F.lit(start).cast("timestamp"))
    if end is not None:
        t = t.filter(F.col("insert_time") <= F.lit(end).cast("timestamp"))
    agg = (t.withColumn("__w", window_end_ms(ms)).groupBy("__w")
           .agg(*window_means(F.col("__w")), F.count(F.lit(1)).alias("__n")))
    if keep_empty:
        if start is not None and end is not None:
            edge = [(-(-_epoch_ms(x) // ms) * ms,) for x in (start, end)]
            ends = t.sparkSession.createDataFrame(edge, "__w long")
            agg = agg.unionByName(ends, allowMissingColumns=True).groupBy("__w") \
                     .agg(*[F.max(c).alias(c) for c in ("__ts", "__rc", "__in", "__n")])
        agg = cut_lineage(agg.withColumn("__at", F.timestamp_millis("__w")))
        agg = blocked_scan(blocked(agg, [], "__at"), [], ["__w"], prevs={"__w": "__prev"})
        since = F.sequence(F.coalesce(F.col("__prev") + ms, F.col("__w")), F.col("__w"), F.lit(ms).cast("long"))
        own = F.col("__s") == F.col("__w")
        agg = agg.withColumn("__s", F.explode(since)).select(
            F.col("__s").alias("__w"), *[F.when(own, F.col(c)).alias(c) for c in ("__ts", "__rc", "__in", "__n")])
    return agg.select(*heartbeat_columns())


def websocket_diagnostics(hb: DataFrame) -> DataFrame:
    return hb.select("avg_timestamp", "avg_received_at", "avg_websocket_lag", "message_count", "diagnostics_timestamp")


def processing_diagnostics(hb: DataFrame) -> DataFrame:
    return hb.select("avg_timestamp", "avg_received_at", "avg_processed_timestamp", "avg_processing_lag",
                     "message_count", "diagnostics_timestamp")


def feed_gaps(ticks: DataFrame, timeout_s: float = C.WATCHDOG_TIMEOUT_S, keys: list[str] | None = None,
              min_rows: int = MIN_BLOCK_ROWS) -> DataFrame:
    """Silences longer than ``timeout_s`` between consecutive ticks (of the whole feed, or per key).

    The previous-tick lookup is a blocked scan, so even the key-less (whole feed) form runs in
    parallel over time blocks instead of in one task.
    """
    keys = keys or []
    t = blocked(ticks.select(*keys, "timestamp", "seq"), keys, "timestamp", min_rows, tie="seq")
    t = blocked_scan(t, keys, ["timestamp", "seq"], prevs={"timestamp": "gap_start"})
    gap = (F.unix_micros("timestamp") - F.unix_micros("gap_start")) / F.lit(1e6)
    return (t.filter(gap > F.lit(float(timeout_s)))
             .select(*keys, "gap_start", F.col("timestamp").alias("gap_end"), gap.alias("gap_seconds")))
