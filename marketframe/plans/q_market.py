"""Registered queries: ticks → bars → market-data reports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from marketframe.operators import bars as B
from marketframe.plans import reports as R
from marketframe.plans.registry import RANGE_FROM, RANGE_TO, register
from marketframe.plans.sql_views import with_views
from marketframe.sources import fixtures as X

BAR_DOUBLES = ["open", "high", "low", "close", "avg", "volume"]
BAR_COLS = "minute, symbol, open, high, low, close, avg, volume"


def bars(spark, sf_dir, open_mode="heavy", frm=None, to=None):
    """One-shot bars. With a report range [frm, to] on the bar minute, the ticks are bounded on the
    stored event time first: minute in [frm, to] implies frm_minute <= ts < to_minute + 1 minute."""
    lo = pd.Timestamp(frm).floor("min") if frm is not None else None
    hi = pd.Timestamp(to).floor("min") + pd.Timedelta(minutes=1) if to is not None else None
    t = X.ticks(spark, sf_dir, frm=lo, until=hi)
    return B.ohlcv(t.select("seq", "timestamp", "timestamp_ms", "symbol", "price", "volume"), open_mode=open_mode)


@register("ohlcv_bars", with_views(f"SELECT {BAR_COLS} FROM bars", "bars"), BAR_DOUBLES,
          "A1-A6 A11-A12 F1 S7")
def ohlcv_bars(spark, sf_dir):
    return bars(spark, sf_dir).select(*BAR_COLS.split(", "))


@register("bars_first_open", with_views("""
SELECT date_trunc('minute', timestamp) AS minute, symbol,
       arg_min(price, {'ts': timestamp_ms, 'seq': seq}) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, {'ts': timestamp_ms, 'seq': seq}) AS close, avg(price) AS avg, sum(volume) AS volume
FROM ticks GROUP BY 1, 2""", "ticks"), BAR_DOUBLES, "A13")
def bars_first_open(spark, sf_dir):
    return bars(spark, sf_dir, open_mode="first").select(*BAR_COLS.split(", "))


# Backfilled history and live ticks are split by insert time; each half becomes partial states and
# the union is merged, which must equal one pass over all ticks.
SPLIT_AT = "2024-01-15 00:00:00"


@register("bars_merge_partials", with_views(f"SELECT {BAR_COLS} FROM bars", "bars"), BAR_DOUBLES,
          "A9-A10 S17 S20 U1 X1")
def bars_merge_partials(spark, sf_dir):
    t = X.ticks(spark, sf_dir)
    cut = F.lit(SPLIT_AT).cast("timestamp")
    backfill = B.partial_bars(t.filter(F.col("insert_time") < cut))
    live = B.partial_bars(t.filter(F.col("insert_time") >= cut))
    return B.finalize(backfill.unionByName(live), open_mode="heavy").select(*BAR_COLS.split(", "))


@register("latest_price", with_views("""
SELECT symbol, arg_max(price, {'r': received_at, 's': seq}) AS price, max(received_at) AS received_at
FROM ticks GROUP BY symbol""", "ticks"), ["price"], "R4 J1")
def latest_price(spark, sf_dir):
    from marketframe.operators.asof import latest_per_symbol
    return latest_per_symbol(X.ticks(spark, sf_dir))


@register("current_price", with_views("""
SELECT symbol, max(minute) AS minute, arg_max(open, minute) AS open FROM bars GROUP BY symbol""", "bars"),
          ["open"], "B1 T2")
def current_price(spark, sf_dir):
    return R.current_price(bars(spark, sf_dir))


@register("ticker_list", with_views("""
SELECT raw_symbol, regexp_extract(raw_symbol, 'BINANCE:(.*)USDT', 1) AS ticker
FROM (SELECT DISTINCT concat('BINANCE:', upper(symbol), 'USDT') AS raw_symbol FROM ticks)""", "ticks"),
          [], "B5 P16 F11 F12")
def ticker_list(spark, sf_dir):
    return R.ticker_list(X.ticks(spark, sf_dir).select("symbol"))


_RANGE = f"minute BETWEEN TIMESTAMP '{RANGE_FROM}' AND TIMESTAMP '{RANGE_TO}'"


@register("price_series", with_views(f"SELECT minute, open, symbol FROM bars WHERE {_RANGE}", "bars"),
          ["open"], "B2 P8 T1")
def price_series(spark, sf_dir):
    return R.price_series(bars(spark, sf_dir, frm=RANGE_FROM, to=RANGE_TO), RANGE_FROM, RANGE_TO)


@register("volume_series", with_views(f"SELECT minute, volume, symbol FROM bars WHERE {_RANGE}", "bars"),
          ["volume"], "B3 P8 A3")
def volume_series(spark, sf_dir):
    return R.volume_series(bars(spark, sf_dir, frm=RANGE_FROM, to=RANGE_TO), RANGE_FROM, RANGE_TO)


@register("total_volume", with_views(
    f"SELECT symbol, sum(volume) AS total_vol FROM bars WHERE {_RANGE} GROUP BY symbol", "bars"),
          ["total_vol"], "B4 A14")
def total_volume(spark, sf_dir):
    return R.total_volume(bars(spark, sf_dir, frm=RANGE_FROM, to=RANGE_TO), RANGE_FROM, RANGE_TO)


@register("notional_volume", with_views(
    f"SELECT symbol, sum(volume * open) AS total_vol_usd FROM bars WHERE {_RANGE} GROUP BY symbol", "bars"),
          ["total_vol_usd"], "B4 A15 P17")
def notional_volume(spark, sf_dir):
    return R.notional_volume(bars(spark, sf_dir, frm=RANGE_FROM, to=RANGE_TO), RANGE_FROM, RANGE_TO)
