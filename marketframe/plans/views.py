"""Views and parameterised SQL (X2, P9): the dashboards' SQL surface over Spark temp views.

``register_views`` publishes the tick table, the partial-state bar table and the finalising view;
``ticker_report`` runs dashboard-style SQL with named parameters (``spark.sql(text, args=...)``)
instead of string formatting, so values never become SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketframe.operators import bars as B


def register_views(spark: SparkSession, ticks: DataFrame, partials: DataFrame | None = None) -> None:
    """``ticks``, ``minute_bars`` (partial states) and ``minute_bars_final`` (merged view)."""
    ticks.createOrReplaceTempView("ticks")
    p = partials if partials is not None else B.partial_bars(ticks)
    p.createOrReplaceTempView("minute_bars")
    B.finalize(p).createOrReplaceTempView("minute_bars_final")


CURRENT_PRICE_SQL = """
SELECT max(minute) AS minute, max_by(open, minute) AS open FROM minute_bars_final WHERE symbol = :symbol"""

PRICE_RANGE_SQL = """
SELECT symbol, minute, open FROM minute_bars_final
WHERE symbol = :symbol AND minute >= CAST(:frm AS TIMESTAMP) AND minute <= CAST(:to AS TIMESTAMP)
ORDER BY minute DESC NULLS LAST"""

NOTIONAL_SQL = """
SELECT sum(volume * open) AS total_vol_usd FROM minute_bars_final
WHERE symbol = :symbol AND minute >= CAST(:frm AS TIMESTAMP) AND minute <= CAST(:to AS TIMESTAMP)"""


def ticker_report(spark: SparkSession, sql: str, **params) -> DataFrame:
    """Run one of the dashboard statements with bound parameters."""
    return spark.sql(sql, args=params)


def strategy_models(strategies: DataFrame, model_runs: DataFrame) -> DataFrame:
    """Each strategy with the latest run of the model it reads (config: strategy → model)."""
    from marketframe import config as C
    from marketframe.operators.ledger import latest_by_max
    latest = latest_by_max(model_runs, ["model_name"], ["trained_at", "run_id"],
                           ["s3_key", "test_accuracy", "retrain_interval"])
    names = F.create_map(*[F.lit(x) for k, v in C.STRATEGY_MODELS.items() for x in (k, f"{v}-{C.MODEL_TICKER}")])
    return strategies.withColumn("model_name", F.try_element_at(names, F.col("strategy_name"))).join(latest, "model_name", "left")
