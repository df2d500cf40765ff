"""One-minute OHLCV bars: mergeable partial states, merge and finalise.

The partial table is long: one row per (symbol, minute, price) with

* ``n``            ticks at that price — mergeable state of the heavy-hitter open
* ``open_first``   min(struct(ts_ms, seq, price)) — deterministic first-price open
* ``close_state``  max(struct(ts_ms, seq, price)) — last tick wins, ties broken by seq
* ``price_sum``    with ``n`` the avg state
* ``volume``       sum state

All of it adds up under ``groupBy(symbol, minute, price)``, so states of any split of the ticks merge into the
same bars as one pass (tested as a property), no group holds a map or a list, and a hot minute is spread over its
prices. Ticks without a price count in the volume only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketframe.functions.timefn import minute_start

KEYS = ["symbol", "minute"]
STATE = ["minute", "symbol", "price", "n", "open_first", "close_state", "price_sum", "volume"]


def _point(ts="timestamp_ms", seq="seq", price="price") -> Column:
    return F.when(F.col(price).isNotNull(), F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"), F.col(price).alias("price")))


def partial_bars(ticks: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Mergeable partial states for a batch of ticks (map-side combined)."""
    t = ticks.withColumn("minute", bucket if bucket is not None else minute_start("timestamp"))
    return t.groupBy("symbol", "minute", "price").agg(
        F.count("price").alias("n"), F.min(_point()).alias("open_first"), F.max(_point()).alias("close_state"),
        F.sum("price").alias("price_sum"), F.sum("volume").alias("volume")).select(*STATE)


def merge_partials(partials: DataFrame) -> DataFrame:
    """A10 / U1 / S17 compaction: any number of partial rows per (symbol, minute, price) become one."""
    return partials.groupBy("symbol", "minute", "price").agg(
        F.sum("n").alias("n"), F.min("open_first").alias("open_first"), F.max("close_state").alias("close_state"),
        F.sum("price_sum").alias("price_sum"), F.sum("volume").alias("volume")).select(*STATE)


def finalize(partials: DataFrame, open_mode: str = "heavy", merge: bool = True) -> DataFrame:
    """The finalising view: merged states → (minute, symbol, open, high, low, close, avg, volume).

    open_mode "heavy": most frequent price, lowest on ties (A11); "first": price of the earliest tick (A13).
    """
    p = merge_partials(partials) if merge else partials
    heavy = F.max(F.when(F.col("price").isNotNull(), F.struct("n", (-F.col("price")).alias("m"), "price")))["price"]
    open_col = heavy if open_mode == "heavy" else F.min("open_first")["price"]
    return p.groupBy(*KEYS).agg(
        open_col.alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max("close_state")["price"].alias("close"), F.try_divide(F.sum("price_sum"), F.sum("n")).alias("avg"),
        F.sum("volume").alias("volume")).select("minute", "symbol", "open", "high", "low", "close", "avg", "volume")


def ohlcv(ticks: DataFrame, open_mode: str = "heavy", bucket: Column | None = None) -> DataFrame:
    """Bars keyed by (symbol, minute) in two aggregations, by price and then by minute. Both combine
    map-side, so a hot symbol ships one row per minute and price per task."""
    return finalize(partial_bars(ticks, bucket), open_mode, merge=False)


def price_series(bars: DataFrame) -> DataFrame:
    """(symbol, minute, price = open) — the input of the feature builder."""
    return bars.select("symbol", "minute", F.col("open").alias("price"))
