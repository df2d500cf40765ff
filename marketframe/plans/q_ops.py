"""Registered queries: feed diagnostics, retention/maintenance, metric series, message parsing and
the model report (R5, R6, B6, S11–S13, S16, S23, M1–M8, P1–P3, F20, E20)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from marketframe import config as C
from marketframe.operators import diagnostics as DG
from marketframe.operators import metrics as MT
from marketframe.operators.asof import latest_per_symbol
from marketframe.operators.ledger import latest_per_key
from marketframe.plans import reports as R
from marketframe.plans.registry import register
from marketframe.plans.q_market import BAR_COLS, BAR_DOUBLES, bars
from marketframe.plans.q_trading import ORACLE_CTES, execution
from marketframe.plans.sql_views import with_views
from marketframe.plans.views import PRICE_RANGE_SQL, register_views, strategy_models, ticker_report
from marketframe.sources import fixtures as X
from marketframe.sources import messages as MS
from marketframe.sources import sinks as SK
from marketframe.session import cut_lineage

HB_MS = C.HEARTBEAT_S * 1000
HB_SQL = f"""
WITH agg AS (
  SELECT w, CAST(floor(avg(epoch_us(timestamp) - w * 1000)) AS BIGINT) + w * 1000 AS ts_us,
         CAST(floor(avg(epoch_us(received_at) - w * 1000)) AS BIGINT) + w * 1000 AS rc_us,
         CAST(floor(avg(epoch_us(insert_time) - w * 1000)) AS BIGINT) + w * 1000 AS in_us, count(*) AS n
  FROM (SELECT *, CAST(ceil((epoch_us(insert_time) // 1000) / {HB_MS}.0) AS BIGINT) * {HB_MS} AS w FROM ticks)
  GROUP BY w),
spine AS (SELECT unnest(generate_series(min(w), max(w), {HB_MS})) AS w FROM agg)
SELECT make_timestamp(ts_us) AS avg_timestamp, make_timestamp(rc_us) AS avg_received_at,
       make_timestamp(in_us) AS avg_processed_timestamp, (rc_us - ts_us) / 1e6 AS avg_websocket_lag,
       (in_us - rc_us) / 1e6 AS avg_processing_lag, CAST(coalesce(n, 0) AS DOUBLE) AS message_count,
       make_timestamp(w * 1000) AS diagnostics_timestamp
FROM spine LEFT JOIN agg USING (w)"""


def heartbeat(spark, sf_dir):
    return DG.heartbeat(X.ticks(spark, sf_dir))


@register("heartbeat_diagnostics", with_views(f"SELECT * FROM ({HB_SQL}) AS hb", "ticks"),
          ["avg_websocket_lag", "avg_processing_lag"], "R5 A6 A7 F9 P5")
def heartbeat_q(spark, sf_dir):
    return heartbeat(spark, sf_dir)


@register("feed_gaps", with_views(f"""
SELECT gap_start, gap_end, gap_seconds FROM (
  SELECT lag(timestamp) OVER (ORDER BY timestamp, seq) AS gap_start, timestamp AS gap_end,
         (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (ORDER BY timestamp, seq))) / 1e6 AS gap_seconds
  FROM ticks) WHERE gap_seconds > {C.WATCHDOG_TIMEOUT_S}""", "ticks"), ["gap_seconds"], "R6")
def feed_gaps_q(spark, sf_dir):
    return DG.feed_gaps(X.ticks(spark, sf_dir))


@register("ingest_monitor", with_views(f"""
SELECT (SELECT arg_max(avg_websocket_lag, {{'t': avg_timestamp, 'd': diagnostics_timestamp}}) FROM hb WHERE avg_timestamp IS NOT NULL) AS avg_websocket_lag,
       (SELECT arg_max(avg_processing_lag, {{'t': avg_timestamp, 'd': diagnostics_timestamp}}) FROM hb WHERE avg_timestamp IS NOT NULL) AS avg_processing_lag,
       (SELECT count(timestamp) FROM ticks) AS total_rows""", "ticks", extra=[("hb", HB_SQL)]),
          ["avg_websocket_lag", "avg_processing_lag"], "B6 T2 A5")
def ingest_monitor_q(spark, sf_dir):
    return R.ingest_monitor(heartbeat(spark, sf_dir))


ARCHIVE_CUTOFF = "2024-01-20 00:00:00"


@register("retention_split", with_views(f"""
SELECT CASE WHEN minute < TIMESTAMP '{ARCHIVE_CUTOFF}' THEN 'archive' ELSE 'hot' END AS part, {BAR_COLS}
FROM bars""", "bars"), BAR_DOUBLES, "S11 S22 P7 U2")
def retention_split_q(spark, sf_dir):
    old, hot = SK.split_at(bars(spark, sf_dir), "minute", ARCHIVE_CUTOFF)
    cols = BAR_COLS.split(", ")
    return (old.select(F.lit("archive").alias("part"), *cols)
               .unionByName(hot.select(F.lit("hot").alias("part"), *cols)))


TTL_AS_OF, TTL_DAYS = "2024-01-31 00:00:00", 9


@register("retention_ttl", with_views(f"""
SELECT CAST(strftime(timestamp, '%Y%m%d') AS INTEGER) AS dt, count(*) AS n_rows, max(timestamp) AS last_ts
FROM ticks WHERE date_trunc('second', timestamp) + INTERVAL {TTL_DAYS} DAY > TIMESTAMP '{TTL_AS_OF}'
GROUP BY 1""", "ticks"), [], "S12 S13 F3 F4")
def retention_ttl_q(spark, sf_dir):
    # a coarser bound on the stored time first, so that it reaches the Parquet reader; the TTL rule is exact
    recent = X.ticks(spark, sf_dir, frm=pd.Timestamp(TTL_AS_OF) - pd.Timedelta(days=TTL_DAYS))
    kept = SK.with_day(SK.retention_filter(recent, "timestamp", TTL_AS_OF, TTL_DAYS), "timestamp")
    return kept.groupBy("dt").agg(F.count(F.lit(1)).alias("n_rows"), F.max("timestamp").alias("last_ts"))


_EXEC = ORACLE_CTES[: [n for n, _ in ORACLE_CTES].index("execution") + 1]


@register("latest_per_key", with_views("""
SELECT * FROM execution
QUALIFY row_number() OVER (PARTITION BY strategy_name, symbol ORDER BY time DESC, seq DESC) = 1""",
                                       "decisions", extra=_EXEC),
          ["quantity", "model_price", "executed_price"], "S16 W8 T2")
def latest_per_key_q(spark, sf_dir):
    return latest_per_key(execution(spark, sf_dir), ["strategy_name", "symbol"], ["time", "seq"])


METRIC_SQL = """
SELECT timestamp AS ts, seq, 'kafka_topic_partition_current_offset' AS metric, 'price_ticks' AS topic, symbol,
       CAST(row_number() OVER (PARTITION BY symbol ORDER BY timestamp, seq) % 500 AS DOUBLE) AS value
FROM ticks
UNION ALL
SELECT timestamp, seq, 'price_gauge', 'price_ticks', symbol, price FROM ticks"""

STEP_S = 60


def _increase_sql(by: str, range_s: int) -> str:
    """increase(counter[range]) on the step grid, per ``by``: each increment counts at the steps t with ts <= t < ts + range."""
    return f"""
SELECT {by}, t, sum(delta) AS increase FROM (
  SELECT {by}, delta, unnest(generate_series(make_timestamp(g), make_timestamp(g + {range_s - STEP_S}000000), INTERVAL {STEP_S} SECOND)) AS t
  FROM (SELECT *, CAST(ceil(epoch_us(ts) / {STEP_S}e6) AS BIGINT) * {STEP_S}000000 AS g,
               CASE WHEN value < prev THEN value ELSE value - prev END AS delta
        FROM (SELECT *, lag(value) OVER (PARTITION BY topic, symbol ORDER BY ts, seq) AS prev FROM metric_samples
              WHERE metric = 'kafka_topic_partition_current_offset' AND topic = 'price_ticks')
        WHERE prev IS NOT NULL)) GROUP BY ALL"""


def counter_increments(spark, sf_dir):
    s = MT.select_series(X.metric_samples(spark, sf_dir), "kafka_topic_partition_current_offset", eq={"topic": "price_ticks"})
    s = s.select("ts", "seq", "value", MT.label("topic").alias("topic"), MT.label("symbol").alias("symbol"))
    return MT.counter_deltas(cut_lineage(s), ["topic", "symbol"], ["ts", "seq"])


def _metric_sql(select: str) -> str:
    return with_views(f"SELECT * FROM ({select}) AS r", "ticks", extra=[("metric_samples", METRIC_SQL)])


@register("counter_rate", _metric_sql(f"""
SELECT topic, u AS t, arg_max(rate, t) AS rate_last5m, max(CASE WHEN t = u THEN increase END) AS increase, max(CASE WHEN t = u THEN rate END) AS rate
FROM (SELECT topic, t, increase, increase / {STEP_S}.0 AS rate, unnest(generate_series(t, t + INTERVAL 240 SECOND, INTERVAL {STEP_S} SECOND)) AS u
      FROM ({_increase_sql('topic', STEP_S)})) GROUP BY topic, u"""), ["increase", "rate", "rate_last5m"], "M1 M2 M3 M4 M5")
def counter_rate_q(spark, sf_dir):
    r = cut_lineage(MT.rate(counter_increments(spark, sf_dir), ["topic"], STEP_S, STEP_S))
    return MT.last_over_time(r, ["topic"], "rate", 300, STEP_S, "rate_last5m").join(r, ["topic", "t"], "left") \
             .select("topic", "t", "increase", "rate", "rate_last5m")


@register("increase_5m", _metric_sql(f"SELECT topic, t, increase, increase / 300.0 AS per_second FROM ({_increase_sql('topic', 300)})"),
          ["increase", "per_second"], "M3 M4")
def increase_5m_q(spark, sf_dir):
    i = MT.increase(counter_increments(spark, sf_dir), ["topic"], 300, STEP_S)
    return i.withColumn("per_second", F.col("increase") / 300.0)


@register("increase_10m", _metric_sql(f"SELECT symbol, t, increase, increase / 600.0 AS per_second FROM ({_increase_sql('symbol', 600)})"),
          ["increase", "per_second"], "M3")
def increase_10m_q(spark, sf_dir):
    i = MT.increase(counter_increments(spark, sf_dir), ["symbol"], 600, STEP_S)
    return i.withColumn("per_second", F.col("increase") / 600.0)


@register("avg_rate", _metric_sql(f"""
SELECT t, avg(increase / 300.0) AS avg_rate, sum(increase / 300.0) AS sum_rate FROM ({_increase_sql('symbol', 300)}) GROUP BY t"""),
          ["avg_rate", "sum_rate"], "M2 M4")
def avg_rate_q(spark, sf_dir):
    r = MT.rate(counter_increments(spark, sf_dir), ["symbol"], 300, STEP_S)
    return MT.by_label(r, [], "rate", {"avg_rate": "avg", "sum_rate": "sum"})


@register("sum_by_label", _metric_sql(f"""
SELECT symbol, t, sum(increase / {STEP_S}.0) AS sum_rate FROM ({_increase_sql('symbol', STEP_S)})
WHERE regexp_full_match(symbol, 'c.*|view') GROUP BY symbol, t"""), ["sum_rate"], "M1 M4")
def sum_by_label_q(spark, sf_dir):
    s = MT.select_series(X.metric_samples(spark, sf_dir), "kafka_topic_partition_current_offset", eq={"topic": "price_ticks"},
                         regex={"symbol": "c.*|view"})
    s = cut_lineage(s.select("ts", "seq", "value", MT.label("symbol").alias("symbol")))
    r = MT.rate(MT.counter_deltas(s, ["symbol"], ["ts", "seq"]), ["symbol"], STEP_S, STEP_S)
    return MT.by_label(r, ["symbol"], "rate", {"sum_rate": "sum"})


@register("gauge_ratio", with_views("""
SELECT ts, symbol, greatest((1 - a / b) * 100.0, 0.0) AS value FROM (
  SELECT ts, symbol, max(CASE WHEN metric = 'kafka_topic_partition_current_offset' THEN value END) AS a,
         max(CASE WHEN metric = 'price_gauge' THEN value END) AS b
  FROM metric_samples WHERE NOT regexp_full_match(symbol, 'error') GROUP BY ts, symbol)
WHERE a IS NOT NULL AND b IS NOT NULL""", "ticks", extra=[("metric_samples", METRIC_SQL)]), ["value"], "M6 M7 M1")
def gauge_ratio_q(spark, sf_dir):
    s = MT.select_series(X.metric_samples(spark, sf_dir), None,
                         not_regex={"symbol": "error"})
    s = s.withColumn("symbol", MT.label("symbol"))
    return MT.gauge_ratio(s, "kafka_topic_partition_current_offset", "price_gauge", ["symbol"])


@register("last_not_null", with_views("""
SELECT metric, symbol, max(ts) AS ts, arg_max(value, {'t': ts, 's': seq}) AS value FROM metric_samples
WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY metric, symbol""", "ticks",
                                      extra=[("metric_samples", METRIC_SQL)]), ["value"], "M8")
def last_not_null_q(spark, sf_dir):
    s = X.metric_samples(spark, sf_dir).withColumn("symbol", MT.label("symbol"))
    return MT.last_not_null(s, ["metric", "symbol"])


@register("trade_envelope", with_views("""
SELECT make_timestamp(epoch_us(timestamp) // 1000 * 1000) AS timestamp, timestamp_ms, symbol, price, volume,
       received_at FROM ticks""", "ticks"), ["price", "volume"], "P1 P2 P3 F5 F6 F20 F22 S6 S1")
def trade_envelope_q(spark, sf_dir):
    raw = MS.envelope_json(X.ticks(spark, sf_dir))                 # exchange envelopes as text
    trades = MS.explode_envelopes(raw)                              # P1–P2
    payload = MS.tick_message_json(trades)                          # S6 producer payload
    return MS.valid(MS.parse_tick_messages(payload))                # P3 consumer parse


MODEL_AS_OF = "2024-01-31 00:00:00"


@register("model_report", """
SELECT CASE WHEN position('-ETH' IN model_name) > 0 THEN substring(model_name, 1, position('-ETH' IN model_name) - 1)
            ELSE model_name END AS model_name,
       model_description,
       (epoch_us(trained_at + to_hours(CAST(retrain_interval AS BIGINT))) - epoch_us(TIMESTAMP '""" + MODEL_AS_OF + """'))
         / 1e6 AS seconds_until_retrain,
       train_accuracy, test_accuracy, precision, recall, f1
FROM (SELECT 'run-' || event_id AS run_id, ts AS trained_at,
             ([""" + ", ".join(f"'{n}-{C.MODEL_TICKER}'" for n, _, _ in C.MODELS) + """])[user_id % 5 + 1] AS model_name,
             ([""" + ", ".join(f"'{d}'" for _, d, _ in C.MODELS) + """])[user_id % 5 + 1] AS model_description,
             CAST(4 + user_id % 20 AS DOUBLE) AS retrain_interval,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS train_accuracy,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS test_accuracy,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS precision,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS recall,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS f1
      FROM events)
QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY trained_at DESC, run_id DESC) = 1""",
          ["seconds_until_retrain", "train_accuracy", "test_accuracy", "precision", "recall", "f1"],
          "E20 W8 F8 F13 T1 E18")
def model_report_q(spark, sf_dir):
    return R.model_report(X.model_runs(spark, sf_dir), MODEL_AS_OF)


@register("table_size", None, [], "S23")
def table_size_q(spark, sf_dir):
    return SK.table_size_mb(spark, X.table_path(sf_dir, "events"), "events")


@register("strategy_models", with_views("""
SELECT s.strategy_name, s.model AS model_name, r.run_id, r.test_accuracy FROM (VALUES """ + ", ".join(
    f"('{k}', '{v}-{C.MODEL_TICKER}')" for k, v in C.STRATEGY_MODELS.items()) + f""", ('{C.LONG_ONLY}', NULL)) AS s(strategy_name, model)
LEFT JOIN (SELECT ([""" + ", ".join(f"'{n}-{C.MODEL_TICKER}'" for n, _, _ in C.MODELS) + """])[user_id % 5 + 1] AS m, 'run-' || event_id AS run_id,
                  CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS test_accuracy FROM events
           QUALIFY row_number() OVER (PARTITION BY m ORDER BY ts DESC, run_id DESC) = 1) r ON r.m = s.model"""),
          ["test_accuracy"], "J7 X4")
def strategy_models_q(spark, sf_dir):
    s = strategy_models(X.strategies(spark).select("strategy_name"), X.model_runs(spark, sf_dir))
    return s.select("strategy_name", "model_name", "run_id", "test_accuracy")


ONE_SYMBOL, ONE_FROM, ONE_TO = "view", "2024-01-05 00:00:00", "2024-01-12 00:00:00"


@register("ticker_range_sql", with_views(f"""
SELECT symbol, minute, open FROM bars WHERE symbol = '{ONE_SYMBOL}' AND minute BETWEEN TIMESTAMP '{ONE_FROM}' AND TIMESTAMP '{ONE_TO}'""",
                                         "bars"), ["open"], "X2 P4 P9 T1")
def ticker_range_sql_q(spark, sf_dir):
    """The dashboard statement over the bar views, with bound parameters."""
    register_views(spark, X.ticks(spark, sf_dir))
    return ticker_report(spark, PRICE_RANGE_SQL, symbol=ONE_SYMBOL, frm=ONE_FROM, to=ONE_TO)


@register("latest_price_of", with_views("""
SELECT symbol, arg_max(price, {'r': received_at, 's': seq}) AS price, max(received_at) AS received_at
FROM ticks WHERE symbol IN ('view', 'click') GROUP BY symbol""", "ticks"), ["price"], "J6 P4 P10 R4")
def latest_price_of_q(spark, sf_dir):
    return latest_per_symbol(X.ticks(spark, sf_dir), ["view", "click"])


@register("message_quality", with_views("""
SELECT error, count(*) AS n, sum(price) AS price_sum FROM (
  SELECT CASE seq % 11 WHEN 1 THEN 'malformed json' WHEN 2 THEN 'bad timestamp' WHEN 3 THEN 'bad price' ELSE 'none' END AS error,
         CASE WHEN seq % 11 IN (1, 2, 3) THEN NULL ELSE price END AS price
  FROM (SELECT seq, price FROM ticks WHERE seq % 5 <> 0 UNION ALL SELECT seq, price + 1 FROM ticks WHERE seq % 5 <> 0))
GROUP BY error""", "ticks"), ["price_sum"], "P1 P2 P3 F10 F20 F22")
def message_quality_q(spark, sf_dir):
    """Envelopes of two trades each, every fifth of another type; some payloads spoiled; parsed and counted by error."""
    t = X.ticks(spark, sf_dir)
    trade = lambda p: F.struct(F.col("timestamp_ms").alias("t"), F.col("symbol").alias("s"), p.alias("p"), F.col("seq").cast("double").alias("v"))
    env = F.struct(F.when(F.col("seq") % 5 == 0, "ping").otherwise("trade").alias("type"),
                   F.array(trade(F.col("price")), trade(F.col("price") + 1)).alias("data"))
    trades = MS.explode_envelopes(t.select(F.to_json(env).alias("value"), "received_at"))
    kind = F.col("volume").cast("long") % 11                    # the order id rides on the volume
    text = MS.tick_message_json(trades.withColumn("kind", kind), keep=["kind"])
    spoiled = (F.when(F.col("kind") == 1, F.lit("{not json"))
               .when(F.col("kind") == 2, F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"nope"'))
               .when(F.col("kind") == 3, F.regexp_replace("value", '"price":[-0-9.Ee]+', '"price":"abc"')).otherwise(F.col("value")))
    parsed = MS.parse_tick_messages(text.select(spoiled.alias("value")))
    # spoiled rows keep no price: they go to quarantine
    price = F.when(F.col("error").isNull(), F.col("price"))
    return parsed.groupBy(F.coalesce("error", F.lit("none")).alias("error")).agg(F.count(F.lit(1)).alias("n"), F.sum(price).alias("price_sum"))
