"""Market tables derived from the driver's ``events`` table (see FIXTURES.md section 2).

Each function reads only the columns it needs, so the Parquet scan prunes the rest; decision rows
come from the same scan as ticks (no self-join back to ``events``).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketframe import config as C
from marketframe.operators.signals import class_to_signal
from marketframe.operators.scan import Bounds, blocked_scan, time_bounds, with_blocks
from marketframe.session import ensure_utc


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan with an explicit column list (ReadSchema carries only these columns)."""
    ensure_utc(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def _ts() -> Column:
    return F.col("ts").cast("timestamp")


def _ms(expr: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), expr / F.lit(1000.0))


def tick_columns(with_user: bool = False) -> list[Column]:
    cols = [
        F.col("event_id").alias("seq"),
        _ts().alias("timestamp"),
        F.unix_millis(_ts()).alias("timestamp_ms"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        (_ts() + _ms(F.col("event_id") % 1000)).alias("received_at"),
        (_ts() + _ms(F.col("event_id") % 1000 + F.col("user_id"))).alias("insert_time"),
    ]
    if with_user:
        cols.append(F.col("user_id"))
    return cols


def ticks(spark: SparkSession, sf_dir: str, with_user: bool = False, frm=None, until=None) -> DataFrame:
    """The raw tick table ``ticks`` (seq breaks ties between equal timestamps).

    ``frm`` / ``until`` bound the event time as frm <= ts < until on the stored column itself, so the
    bounds reach the Parquet reader (row-group and partition skipping) instead of being applied to a
    derived value after the scan.
    """
    ensure_utc(spark)
    raw = spark.read.parquet(table_path(sf_dir, "events"))
    if frm is not None:
        raw = raw.filter(F.col("ts") >= F.lit(str(frm)).cast("timestamp_ntz"))
    if until is not None:
        raw = raw.filter(F.col("ts") < F.lit(str(until)).cast("timestamp_ntz"))
    return raw.select(*tick_columns(with_user))


def strategies(spark: SparkSession) -> DataFrame:
    """The strategy configuration as a 6-row DataFrame, slot = user_id % 6."""
    rows = [(i, n, d, ef, a, ri, ms) for i, (n, d, ef, a, ri, ms) in enumerate(C.STRATEGIES)]
    from marketframe.schemas import STRATEGIES
    return spark.createDataFrame(rows, STRATEGIES)


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored decisions, one per tick: portfolio key (strategy_name, symbol), class, confidence,
    signed quantity and model price.

    The strategy table has exactly len(C.STRATEGIES) rows, so broadcasting it is size-safe.
    """
    t = ticks(spark, sf_dir, with_user=True)
    cls = (F.col("volume") % 3).cast("int")
    d = t.select(
        F.col("seq"), F.col("timestamp").alias("time"), F.col("symbol"),
        (F.col("user_id") % len(C.STRATEGIES)).cast("int").alias("slot"),
        cls.alias("pred_class"),
        (F.col("volume") / F.lit(100.0)).alias("confidence"),
        ((cls - 1) * (F.lit(1) + F.col("seq") % 10)).cast("double").alias("quantity"),
        F.col("price").alias("model_price"),
    )
    return (d.join(F.broadcast(strategies(spark)), "slot")
             .withColumn("signal", class_to_signal())
             .drop("slot"))


def tick_bounds(spark: SparkSession, sf_dir: str) -> Bounds:
    """Quantiles of (time, order) per symbol (three narrow columns, scanned twice): the block cuts of every per-symbol and
    per-portfolio scan."""
    return time_bounds(ticks(spark, sf_dir).select("symbol", "timestamp", "seq"), ["symbol"], "timestamp", tie="seq")


# the fixture's five event types stand for the feed's five tickers, in this order
TICKER_EVENTS = {"ETH": "click", "BTC": "error", "SOL": "purchase", "ADA": "signup", "XRP": "view"}


def seed_portfolios(spark: SparkSession) -> DataFrame:
    """The ten portfolios that exist before any trade (strategy_name, symbol)."""
    rows = [(s, TICKER_EVENTS[t]) for s, t in C.SEED_PORTFOLIOS]
    return spark.createDataFrame(rows, "strategy_name string, symbol string")


RECORDED_REJECT_EVERY = 4


def recorded_executions(filled: DataFrame) -> DataFrame:
    """The execution log as it stands when orders are checked: every decision is recorded, each fourth order id
    as rejected; Long Only fills at the model price, others at the price one second later."""
    ok = F.col("seq") % RECORDED_REJECT_EVERY != 0
    px = F.when(F.col("strategy_name") == C.LONG_ONLY, F.col("model_price")).otherwise(F.col("fill_price"))
    return filled.select("seq", "time", "symbol", "signal", "quantity", "model_price", F.when(ok, px).alias("executed_price"),
                         "strategy_name", F.when(ok, F.lit("Y")).otherwise(F.lit("N")).alias("approval_status"))


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model_runs`` log: every event is a run of the model in slot user_id % 5 (FIXTURES.md)."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "props"])
    k = F.get_json_object("props", "$.k").cast("double") / F.lit(100.0)
    names = F.array(*[F.lit(f"{n}-{C.MODEL_TICKER}") for n, _, _ in C.MODELS])
    texts = F.array(*[F.lit(d) for _, d, _ in C.MODELS])
    slot = (F.col("user_id") % len(C.MODELS)).cast("int")
    return e.select(F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
                    _ts().alias("trained_at"), F.get(names, slot).alias("model_name"),
                    F.get(texts, slot).alias("model_description"),
                    F.concat(F.lit("models/"), F.get(names, slot), F.lit("-model.pkl")).alias("s3_key"),
                    (F.lit(4) + F.col("user_id") % 20).cast("double").alias("retrain_interval"),
                    k.alias("train_accuracy"), k.alias("test_accuracy"), k.alias("precision"),
                    k.alias("recall"), k.alias("f1"))


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled counter and gauge samples: counter = running count per symbol modulo 500 (forces
    resets), gauge = price. Long form: one row per (ts, metric, labels); seq breaks ties of ts.

    The running count is a per-symbol prefix count, computed with the blocked scan so one hot
    symbol does not sit in a single task.
    """
    t = ticks(spark, sf_dir).select("seq", "timestamp", "symbol", "price").withColumn("one", F.lit(1))
    t = with_blocks(t, tick_bounds(spark, sf_dir), ["symbol"], "timestamp", F.col("seq"))
    t = blocked_scan(t, ["symbol"], ["timestamp", "seq"], sums={"one": "running_n"})
    labels = F.create_map(F.lit("topic"), F.lit("price_ticks"), F.lit("symbol"), F.col("symbol"))
    # both metrics of a tick from one pass over the ticks
    pair = F.explode(F.array(
        F.struct(F.lit("kafka_topic_partition_current_offset").alias("metric"), (F.col("running_n") % 500).cast("double").alias("value")),
        F.struct(F.lit("price_gauge").alias("metric"), F.col("price").alias("value"))))
    return t.select(F.col("timestamp").alias("ts"), "seq", labels.alias("labels"), pair.alias("m")) \
            .select("ts", "seq", "m.metric", "labels", "m.value")
