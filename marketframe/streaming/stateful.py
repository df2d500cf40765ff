"""Streaming aggregates and keyed state.

* ``bars_watermarked`` (R2, R3 mode a): tumbling one-minute windows, append mode; ticks later than
  the watermark are dropped — the price of bounded state.
* ``bars_partial_append`` (R3 mode b): each micro-batch's ticks become partial states appended to
  a partial table; reads merge them (``bars.finalize``). Late ticks merge into old bars without a
  bound, as the modelled store does, and state never grows in the stream.
* ``latest_prices`` (R4), ``heartbeat_stream`` (R5), ``feed_sessions`` (R6).
* ``portfolio_positions`` (R8): running position per (strategy, symbol) kept in keyed state by
  ``transformWithStateInPandas`` (RocksDB state store); each call sees only one key's new rows.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marketframe import config as C
from marketframe.operators import bars as B
from marketframe.operators.diagnostics import heartbeat_columns, window_end_ms, window_means
from marketframe.operators.scan import blocked, blocked_scan
from marketframe.session import cut_lineage, ship_package


def bars_watermarked(ticks: DataFrame, delay: str = "2 minutes", open_mode: str = "heavy") -> DataFrame:
    """R2: one-minute bars per symbol; emitted once the watermark passes the window end. Two chained aggregations, by
    price and then by window, as in the batch form: state is one row per price, never a map of all prices."""
    ordc = F.struct("timestamp_ms", "seq", "price")
    some = F.col("price").isNotNull()
    by_price = (ticks.withWatermark("timestamp", delay)
                .groupBy(F.window("timestamp", "1 minute").alias("w"), "symbol", "price")
                .agg(F.count("price").alias("n"), F.min(F.when(some, ordc)).alias("first"), F.max(F.when(some, ordc)).alias("last"),
                     F.sum("price").alias("total"), F.sum("volume").alias("volume")))
    heavy = F.max(F.when(some, F.struct("n", (-F.col("price")).alias("m"), "price")))["price"]
    open_col = heavy if open_mode == "heavy" else F.min("first")["price"]
    return (by_price.groupBy(F.window(F.window_time("w"), "1 minute").alias("w"), "symbol")
            .agg(open_col.alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max("last")["price"].alias("close"),
                 F.try_divide(F.sum("total"), F.sum("n")).alias("avg"), F.sum("volume").alias("volume"))
            .select(F.col("w.start").alias("minute"), "symbol", "open", "high", "low", "close", "avg", "volume"))


def bars_partial_append(partial_path: str, run_id: str):
    """R3 (b): a foreachBatch function appending the batch's partial states (S17 table). ``run_id`` names the query's
    checkpoint: a new checkpoint counts its batches from 0 again and must not replace an older run's folders."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # one directory per run and batch: a retried batch overwrites its own output, never duplicates
        B.partial_bars(batch).write.mode("overwrite").parquet(f"{partial_path}/run_id={run_id}/batch_id={batch_id}")
    return write


def latest_prices(ticks: DataFrame) -> DataFrame:
    """Last numeric price per symbol in arrival order (update/complete output mode)."""
    t = ticks.filter(F.col("price").isNotNull() & ~F.isnan("price"))
    return t.groupBy("symbol").agg(F.max_by("price", F.struct("received_at", "seq")).alias("price"),
                                   F.max("received_at").alias("received_at"))


def heartbeat_stream(ticks: DataFrame, period_s: int = C.HEARTBEAT_S, delay: str = "1 minute") -> DataFrame:
    """Windows (a, b] of insert time, as in the batch form: stream windows are [a, b), so they are taken one
    millisecond earlier. Means are taken of the offsets from the window end, which stay exact."""
    ms = period_s * 1000
    end = window_end_ms(ms)
    t = (ticks.filter(F.col("insert_time").isNotNull())
         .withColumn("__at", F.timestamp_millis(F.unix_millis("insert_time") - 1)).withColumn("__end", end))
    g = (t.withWatermark("__at", delay).groupBy(F.window("__at", f"{period_s} seconds").alias("w"))
         .agg(*window_means(F.col("__end")), F.count(F.lit(1)).alias("__n")))
    return g.withColumn("__w", F.unix_millis("w.end")).select(*heartbeat_columns())


def feed_sessions(ticks: DataFrame, gap: str = f"{C.WATCHDOG_TIMEOUT_S} seconds", delay: str = "5 minutes",
                  keys: list[str] | None = None) -> DataFrame:
    """R6 on a stream: activity sessions per key (default: symbol) closed by ``gap`` of silence; a new
    session after a closed one marks a feed gap."""
    keys = keys or ["symbol"]
    return (ticks.withWatermark("timestamp", delay).groupBy(F.session_window("timestamp", gap).alias("s"), *keys)
            .agg(F.count(F.lit(1)).alias("ticks"), F.max("timestamp").alias("last_tick"))
            .select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "last_tick", "ticks"))


def whole_feed_sessions(ticks: DataFrame, shards: int = 16, **kw) -> DataFrame:
    """R6 of the whole feed on a stream. A session window without a key would keep one session in one task, so ticks are
    dealt to ``shards`` by hash and each keeps its own sessions; ``gaps_between`` merges the closed ones."""
    return feed_sessions(ticks.withColumn("shard", F.pmod(F.xxhash64("timestamp", "seq"), F.lit(shards)).cast("int")), keys=["shard"], **kw)


def gaps_between(sessions: DataFrame, timeout_s: float = C.WATCHDOG_TIMEOUT_S) -> DataFrame:
    """The feed's gaps from the sessions of all shards: where a session starts more than ``timeout_s`` after the last
    tick of all sessions before it. A blocked scan over sessions, of which there are far fewer than ticks."""
    s = cut_lineage(sessions.groupBy("session_start").agg(F.max(F.unix_micros("last_tick")).alias("last")))
    s = blocked_scan(blocked(s, [], "session_start"), [], ["session_start"], maxes_excl={"last": "before"})
    gap = (F.unix_micros("session_start") - F.col("before")) / F.lit(1e6)
    return (s.filter(gap > F.lit(float(timeout_s)))
             .select(F.timestamp_micros("before").alias("gap_start"), F.col("session_start").alias("gap_end"), gap.alias("gap_seconds")))


POSITION_SCHEMA = ("strategy_name string, symbol string, time timestamp, quantity double, cash_balance double, "
                   "market_value double, portfolio_value double")


try:  # the processor API exists in PySpark >= 4.0
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
except ImportError:  # pragma: no cover
    StatefulProcessor, StatefulProcessorHandle = object, None


class PositionProcessor(StatefulProcessor):
    """Per key, fold approved executions into (quantity, cash, book value) and emit the new row.

    quantity += q; market_value += q·p; cash −= q·p; portfolio_value = cash + market_value.
    """

    def init(self, handle) -> None:
        self.pos = handle.getValueState("pos", "quantity double, book double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        q, book = self.pos.get() if self.pos.exists() else (0.0, 0.0)
        # a key's rows come in several chunks: order them over the whole batch before folding
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["time", "seq"], kind="stable")
        qs = q + pdf["quantity"].cumsum().to_numpy()
        books = book + (pdf["quantity"] * pdf["executed_price"]).cumsum().to_numpy()
        self.pos.update((float(qs[-1]), float(books[-1])))
        yield pd.DataFrame({
            "strategy_name": key[0], "symbol": key[1], "time": pdf["time"].to_numpy(), "quantity": qs,
            "cash_balance": C.STARTING_CASH - books, "market_value": books, "portfolio_value": C.STARTING_CASH})

    def close(self) -> None:
        pass


def portfolio_positions(executions: DataFrame) -> DataFrame:
    """Running position rows per (strategy, symbol) from a stream of approved executions."""
    ship_package(executions.sparkSession)
    approved = executions.filter(F.col("approval_status") == "Y").select(
        "strategy_name", "symbol", "time", "seq", "quantity", "executed_price")
    return approved.groupBy("strategy_name", "symbol").transformWithStateInPandas(
        statefulProcessor=PositionProcessor(), outputStructType=POSITION_SCHEMA, outputMode="Update",
        timeMode="None")


def snapshot_writer(keys_path: str, prices_path: str, out_path: str, run_id: str):
    """R7 stream form: a foreachBatch function for a clock stream (one batch per period, ticks or not). Each run marks
    every portfolio row at its symbol's latest price and writes one ``portfolio_ts`` row per key, stamped with the
    batch's time. It reads two small current tables, one row per key (S16) and per symbol (R4), and no history.
    ``run_id`` names the query's checkpoint: a new checkpoint counts from 0 again and must not replace stored snapshots."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cur, px = spark.read.parquet(keys_path), spark.read.parquet(prices_path)
        mv = F.col("quantity") * F.col("price")
        snap = (cur.join(px.select("symbol", "price"), "symbol")
                   .select(F.current_timestamp().alias("time"), "cash_balance", "symbol", "quantity",
                           mv.alias("market_value"), (F.col("cash_balance") + mv).alias("portfolio_value"),
                           "strategy_name"))
        snap.write.mode("overwrite").parquet(f"{out_path}/run_id={run_id}/batch_id={batch_id}")
    return write
