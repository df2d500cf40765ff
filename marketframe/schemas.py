"""One StructType per table. Parsers, stream sources and created frames pass theirs; Parquet readers take the file's."""

from pyspark.sql import types as T

S, D, L, TS, I = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType(), T.IntegerType()


def _s(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Inbound message value, as published per trade.
TICK_MESSAGE = _s(("timestamp", S, True), ("timestamp_ms", L, True), ("symbol", S, True),
                  ("price", S, True), ("volume", S, True), ("received_at", S, True))

# Exchange envelope {type, data:[{t,s,p,v}]}.
TRADE = _s(("t", L, True), ("s", S, True), ("p", D, True), ("v", D, True))
ENVELOPE = _s(("type", S, True), ("data", T.ArrayType(TRADE), True))

TICKS = _s(("seq", L, False), ("timestamp", TS, False), ("timestamp_ms", L, False), ("symbol", S, False),
           ("price", D, False), ("volume", D, False), ("received_at", TS, False), ("insert_time", TS, False))

MINUTE_BARS = _s(("minute", TS, False), ("symbol", S, False), ("open", D, True), ("high", D, True),
                 ("low", D, True), ("close", D, True), ("avg", D, True), ("volume", D, True))

POINT = _s(("ts", L, True), ("seq", L, True), ("price", D, True))
MINUTE_BARS_PARTIAL = _s(("minute", TS, False), ("symbol", S, False), ("price", D, True), ("n", L, False),
                         ("open_first", POINT, True), ("close_state", POINT, True), ("price_sum", D, True), ("volume", D, True))

EXECUTION = _s(("time", TS, False), ("symbol", S, False), ("signal", S, False), ("quantity", D, False),
               ("model_price", D, False), ("executed_price", D, True), ("strategy_name", S, False),
               ("approval_status", S, False), ("approval_comment", S, False))

PORTFOLIO_TS = _s(("time", TS, False), ("cash_balance", D, False), ("symbol", S, False), ("quantity", D, False),
                  ("market_value", D, False), ("portfolio_value", D, False), ("strategy_name", S, False))

PORTFOLIO_KEY = _s(("last_updated", TS, False), ("cash_balance", D, False), ("symbol", S, False),
                   ("quantity", D, False), ("market_value", D, False), ("portfolio_value", D, False),
                   ("strategy_name", S, False), ("strategy_description", S, False), ("status", S, False))

MODEL_RUNS = _s(("run_id", S, False), ("trained_at", TS, False), ("model_name", S, False),
                ("model_description", S, False), ("s3_key", S, False), ("retrain_interval", D, False),
                ("train_accuracy", D, False), ("test_accuracy", D, False), ("precision", D, False),
                ("recall", D, False), ("f1", D, False))

WEBSOCKET_DIAGNOSTICS = _s(("avg_timestamp", TS, True), ("avg_received_at", TS, True),
                           ("avg_websocket_lag", D, True), ("message_count", D, False),
                           ("diagnostics_timestamp", TS, False))

PROCESSING_DIAGNOSTICS = _s(("avg_timestamp", TS, True), ("avg_received_at", TS, True),
                            ("avg_processed_timestamp", TS, True), ("avg_processing_lag", D, True),
                            ("message_count", D, False), ("diagnostics_timestamp", TS, False))

STRATEGIES = _s(("slot", I, False), ("strategy_name", S, False), ("strategy_description", S, False),
                ("execution_frequency", I, False), ("allocation_pct", D, False), ("reset_interval", I, False),
                ("max_streak", I, False))

METRIC_SAMPLES = _s(("ts", TS, False), ("metric", S, False), ("labels", T.MapType(S, S), False), ("value", D, False))

FEATURE_COLUMNS = ["returns", "sma_30", "sma_60", "momentum_10", "momentum_30", "volatility_30",
                   "lag_return_1", "lag_return_2", "lag_return_5", "rsi_14", "macd", "macd_signal",
                   "price_change", "sma_ratio", "macd_diff", "ema_return_10", "zscore_30", "dir_strength"]
