"""Dashboard reports (B1–B9, E20) as DataFrame functions over bars, ledgers and logs.

Every report takes DataFrames plus parameters (time range, tickers, as-of instant); nothing reads
the wall clock. Reports that the dashboards ran for one ticker are written for all tickers at once,
grouped by symbol; pass ``symbols`` to restrict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketframe.functions.text import model_base_name, raw_symbol, strategy_group, ticker_of
from marketframe.functions.timefn import bucket_start


def _in_range(df: DataFrame, col: str, frm, to) -> DataFrame:
    """P8 $__timeFilter(col): inclusive range on the raw column so Parquet pruning applies."""
    if frm is not None:
        df = df.filter(F.col(col) >= F.lit(frm).cast("timestamp"))
    if to is not None:
        df = df.filter(F.col(col) <= F.lit(to).cast("timestamp"))
    return df


def _symbols(df: DataFrame, symbols) -> DataFrame:
    """P4 equality filter on the key column; ``symbol`` is the stored ``event_type`` renamed, so the
    predicate passes the aggregate and reaches the Parquet reader as a pushed filter."""
    return df.filter(F.col("symbol").isin(list(symbols))) if symbols else df


def current_price(bars: DataFrame, symbols=None) -> DataFrame:
    """B1: open of the latest bar per symbol (ORDER BY minute DESC LIMIT 1, per symbol)."""
    b = _symbols(bars, symbols)
    return b.groupBy("symbol").agg(F.max("minute").alias("minute"), F.max_by("open", "minute").alias("open"))


def price_series(bars: DataFrame, frm=None, to=None, symbols=None) -> DataFrame:
    """B2: (minute, open, symbol) in range, newest first."""
    b = _symbols(_in_range(bars, "minute", frm, to), symbols)
    return b.select("minute", "open", "symbol").orderBy(F.desc("minute"), "symbol")


def volume_series(bars: DataFrame, frm=None, to=None, symbols=None) -> DataFrame:
    """(minute, volume, symbol) in range, newest first."""
    b = _symbols(_in_range(bars, "minute", frm, to), symbols)
    return b.select("minute", "volume", "symbol").orderBy(F.desc("minute"), "symbol")


def total_volume(bars: DataFrame, frm=None, to=None, symbols=None) -> DataFrame:
    """Σ volume over the range per symbol."""
    b = _symbols(_in_range(bars, "minute", frm, to), symbols)
    return b.groupBy("symbol").agg(F.sum("volume").alias("total_vol"))


def notional_volume(bars: DataFrame, frm=None, to=None, symbols=None) -> DataFrame:
    """Σ volume × open per minute, summed over the range per symbol."""
    b = _symbols(_in_range(bars, "minute", frm, to), symbols)
    return b.groupBy("symbol").agg(F.sum(F.col("volume") * F.col("open")).alias("total_vol_usd"))


def ticker_list(bars: DataFrame) -> DataFrame:
    """Distinct raw feed symbols and the ticker captured from each."""
    raw = bars.select(raw_symbol(F.upper("symbol")).alias("raw_symbol")).distinct()
    return raw.select("raw_symbol", ticker_of("raw_symbol").alias("ticker")).orderBy("raw_symbol")


def ingest_monitor(diagnostics: DataFrame) -> DataFrame:
    """Latest websocket lag, latest processing lag, total stored ticks — one row, from one pass over the
    diagnostics rows, whose counts add up to the ticks.

    Each "latest" is a max_by; NULL avg_timestamp rows (empty windows) never win, as with ORDER BY … DESC LIMIT 1
    and NULLs last. Rows of equal mean time are settled by the window.
    """
    last = F.when(F.col("avg_timestamp").isNotNull(), F.struct("avg_timestamp", "diagnostics_timestamp"))
    return diagnostics.agg(F.max_by("avg_websocket_lag", last).alias("avg_websocket_lag"),
                           F.max_by("avg_processing_lag", last).alias("avg_processing_lag"),
                           F.coalesce(F.sum("message_count"), F.lit(0)).cast("long").alias("total_rows"))


def portfolio_by_bucket(portfolio_ts: DataFrame, frm=None, to=None, bucket_s: int = 1800,
                        group_size: int = 5) -> DataFrame:
    """Mean value per (30-min bucket, group), then Σ × group size (nested aggregate)."""
    p = _in_range(portfolio_ts, "time", frm, to)
    inner = p.groupBy(bucket_start("time", bucket_s).alias("time_bucket"),
                      strategy_group("strategy_name").alias("category")) \
             .agg(F.avg("portfolio_value").alias("avg_value"))
    return (inner.groupBy("time_bucket", "category")
                 .agg((F.sum("avg_value") * F.lit(float(group_size))).alias("portfolio_value"))
                 .select(F.col("time_bucket").alias("time"), F.col("category").alias("metric"), "portfolio_value")
                 .orderBy("time", "metric"))


def portfolio_overview(portfolio_key: DataFrame) -> DataFrame:
    """Position, cash and net value per strategy group."""
    return (portfolio_key.groupBy(strategy_group("strategy_name").alias("strategy_group"))
            .agg(F.sum("market_value").alias("total_market_position"),
                 F.sum("cash_balance").alias("total_cash_position"),
                 F.sum("portfolio_value").alias("total_net_value"))
            .orderBy("strategy_group"))


RECENT_TRADES = 7


def recent_trades(execution: DataFrame, k: int = RECENT_TRADES) -> DataFrame:
    """The k most recent executions with trade value; a top-k report by design."""
    cols = ["time", "strategy_name", "symbol", "signal", "quantity"]
    return (execution.select(*cols, "seq", (F.col("executed_price") * F.col("quantity")).alias("trade_value"),
                             "approval_status", "approval_comment")
            .orderBy(F.desc("time"), "strategy_name", "symbol", F.desc("seq")).limit(k).drop("seq"))


def model_report(model_runs: DataFrame, as_of) -> DataFrame:
    """Latest run per model (W8), hours until next retrain at ``as_of`` (F8), metrics."""
    from pyspark.sql import Window
    from marketframe.functions.timefn import plus_hours, seconds_between
    w = Window.partitionBy("model_name").orderBy(F.desc("trained_at"), F.desc("run_id"))
    latest = model_runs.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    due = plus_hours("trained_at", F.col("retrain_interval"))
    return (latest.select(model_base_name("model_name").alias("model_name"),
                          F.col("model_description"),
                          seconds_between(due, F.lit(as_of).cast("timestamp")).alias("seconds_until_retrain"),
                          "train_accuracy", "test_accuracy", "precision", "recall", "f1")
            .orderBy("seconds_until_retrain", "model_name"))
