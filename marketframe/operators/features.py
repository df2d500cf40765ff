"""The 18-feature builder over a (symbol, minute, price) series, training and serving forms.

A symbol's bars are cut into blocks of ``BLOCK_ROWS`` rows, each with the ``HALO`` rows before it. All windows
run over (symbol, block). The halo covers the longest frame (60 rows) and, for the EWMs, so many rows that
what happened before them is below double precision: span 26 forgets in 520 rows, and the signal line (span 9)
reads 180 rows of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketframe import config as C
from marketframe.operators import windows as W
from marketframe.schemas import FEATURE_COLUMNS
from marketframe.session import cut_lineage

KEYS, ORDER = ["symbol"], ["minute"]


BLOCK_ROWS, HALO = 1500, 768
BKEYS = ["symbol", "__hb"]


def rsi(change: str, w, n: int = 14) -> tuple[Column, Column, Column]:
    """E3 simple-mean RSI of a price-change column: the gain and loss columns (a missing change counts as 0), and the
    RSI over columns named ``__gain`` and ``__loss``: rolling n mean each, 100 − 100/(1 + gain/loss); loss 0 and
    gain > 0 → 100; both 0 → NULL (0/0)."""
    gain = F.when(F.col(change) > 0, F.col(change)).otherwise(F.lit(0.0))
    loss = F.when(F.col(change) < 0, -F.col(change)).otherwise(F.lit(0.0))
    g, l_ = W.rolling_mean("__gain", w, n), W.rolling_mean("__loss", w, n)
    val = (F.when(l_ == 0, F.when(g > 0, F.lit(100.0)))
            .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.try_divide(g, l_))))
    return gain, loss, val


def build_features(series: DataFrame, dropna: bool = True, keep: list[str] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Returns, sma_30/60, momentum_10/30, volatility_30, lag_return_1/2/5, rsi_14, macd,
    macd_signal, price_change, sma_ratio, macd_diff, ema_return_10, zscore_30, dir_strength.

    Ratios with a zero denominator give NULL (the float library gives ±inf/NaN); ``dropna`` then
    removes every row with any NULL feature, including the 59-row warm-up of sma_60. ``keep`` names intermediate
    columns (ema_12, ema_26) to return as well.
    """
    place = W.indexed(cut_lineage(series.select("symbol", "minute", "price")), KEYS, "minute", "__at")
    df = W.halo_blocks(place, "__at", block_rows, back=min(HALO, block_rows))
    w = W.series_window(BKEYS, ORDER)
    base = ["symbol", "minute", "__hb", "__halo", "price"]
    # level 1: everything that reads only the price (one Window pass over the block)
    df = df.select(*base, W.pct_change("price", w).alias("returns"),
                   W.rolling_mean("price", w, 30).alias("sma_30"), W.rolling_mean("price", w, 60).alias("sma_60"),
                   W.pct_change("price", w, 10).alias("momentum_10"), W.pct_change("price", w, 30).alias("momentum_30"),
                   W.diff("price", w).alias("price_change"))
    # level 2: what reads returns / price changes
    gain, loss, rsi_14 = rsi("price_change", w)
    df = df.select("*", W.rolling_std("returns", w, 30).alias("volatility_30"),
                   W.rolling_mean("returns", w, 30).alias("__ret_mean30"),
                   *[W.lag("returns", w, k).alias(f"lag_return_{k}") for k in (1, 2, 5)],
                   gain.alias("__gain"), loss.alias("__loss"))
    df = df.select("*", rsi_14.alias("rsi_14"))
    # EWMs: both price EWMs and the return EWM in shared passes, then the signal line on macd
    df = W.ewm_many(df, [("price", "ema_12", 12), ("price", "ema_26", 26), ("returns", "ema_return_10", 10)], BKEYS, ORDER)
    df = df.select("*", (F.col("ema_12") - F.col("ema_26")).alias("macd"))
    df = W.ewm_many(df, [("macd", "macd_signal", 9)], BKEYS, ORDER)
    df = df.select("*",
                   (F.try_divide(F.col("sma_30"), F.col("sma_60")) - F.lit(1.0)).alias("sma_ratio"),
                   (F.col("macd") - F.col("macd_signal")).alias("macd_diff"),
                   F.try_divide(F.col("returns") - F.col("__ret_mean30"), F.col("volatility_30")).alias("zscore_30"),
                   F.try_divide(F.col("momentum_10"), F.col("volatility_30") + F.lit(C.EPS)).alias("dir_strength"))
    df = W.without_halo(df).select("symbol", "minute", "price", *FEATURE_COLUMNS, *(keep or []))
    return df.na.drop("any", subset=FEATURE_COLUMNS) if dropna else df


def serving_features(series: DataFrame, as_of, lookback_hours: int = C.SERVING_LOOKBACK_H,
                     bars: int = C.SERVING_BARS) -> DataFrame:
    """E5: the serving slice — bars in the last ``lookback_hours`` before ``as_of``, at most the newest
    ``bars`` per symbol (T4/W10) — then E2 and the newest row per symbol (tail(1)).

    EWMs restart inside the slice, as in serving, so values differ slightly from training features.
    """
    start = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(int(lookback_hours)))
    s = series.filter((F.col("minute") >= start) & (F.col("minute") <= F.lit(as_of).cast("timestamp")))
    s = W.tail_n(s, KEYS, ORDER, bars)
    return W.tail_n(build_features(s), KEYS, ORDER, 1)
