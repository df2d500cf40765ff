"""Portfolio ledger (L1, L2), snapshots (R7), latest-per-key state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketframe import config as C
from marketframe.operators.asof import asof_join
from marketframe.operators.scan import Bounds, blocked_scan, with_blocks

KEYS = ["strategy_name", "symbol"]
ORDER = ["time", "seq"]
ROW = ["time", "seq", *KEYS, "cash_balance", "quantity", "market_value", "portfolio_value"]


def ledger(execution: DataFrame, bounds: Bounds, starting_cash: float = C.STARTING_CASH) -> DataFrame:
    """L1: running position per (strategy, symbol) over approved executions. ``bounds``: cuts per symbol.

    quantity += q; market_value += q·p; cash −= q·p; portfolio_value = cash + market_value
    (book value: cash + market_value stays at the starting cash until marked to market).
    """
    e = (execution.filter(F.col("approval_status") == "Y")
                  .withColumn("__flow", F.col("quantity") * F.col("executed_price")))
    e = with_blocks(e.select("time", "seq", *KEYS, "quantity", "__flow"), bounds, ["symbol"], "time", F.col("seq"))
    e = blocked_scan(e, KEYS, ORDER, sums={"quantity": "__qty", "__flow": "__book"})
    return e.select("time", "seq", "strategy_name", "symbol",
                    (F.lit(float(starting_cash)) - F.col("__book")).alias("cash_balance"),
                    F.col("__qty").alias("quantity"), F.col("__book").alias("market_value"),
                    F.lit(float(starting_cash)).alias("portfolio_value"))


def with_seeds(ledger_rows: DataFrame, seeds: DataFrame, ticks: DataFrame,
               starting_cash: float = C.STARTING_CASH) -> DataFrame:
    """Portfolio rows: the seeded portfolios, flat, from one second before the first tick (seq −1), and the ledger."""
    start = ticks.agg((F.min("timestamp") - F.expr("INTERVAL 1 SECOND"))).scalar()
    cash, zero = F.lit(float(starting_cash)), F.lit(0.0)
    flat = seeds.select(start.alias("time"), F.lit(-1).cast("long").alias("seq"), *KEYS, cash.alias("cash_balance"),
                        zero.alias("quantity"), zero.alias("market_value"), cash.alias("portfolio_value"))
    return flat.unionByName(ledger_rows.select(*ROW))


def mark_to_market(ledger_rows: DataFrame, ticks: DataFrame, bounds: Bounds) -> DataFrame:
    """L2: re-mark each ledger row at the latest tick price at its time: mv = qty·price, pv = cash + mv."""
    m = asof_join(ledger_rows, ticks, ["symbol"], "time", "timestamp", ["price"], "seq", prefix="mark_", bounds=bounds)
    mv = F.col("quantity") * F.col("mark_price")
    return m.select("time", "seq", "strategy_name", "symbol", "cash_balance", "quantity", "mark_price",
                    mv.alias("market_value"), (F.col("cash_balance") + mv).alias("portfolio_value"))


def snapshot_times(rows: DataFrame, ticks: DataFrame, period_s: int = C.SNAPSHOT_PERIOD_S) -> DataFrame:
    """One row per key and ``period_s`` grid time from the key's first row to the feed's last tick. Days first, then
    the day's grid times, so no row explodes into more than a day; a key that starts after the last tick has none."""
    us, day = period_s * 1_000_000, 86_400_000_000
    last = ticks.agg(F.max(F.unix_micros("timestamp"))).scalar()
    first = rows.groupBy(*KEYS).agg(F.min(F.unix_micros("time")).alias("__t0"))
    span = first.select(*KEYS, (F.ceil(F.col("__t0") / us) * us).cast("long").alias("lo"),
                        (F.floor(last / us) * us).cast("long").alias("hi")).filter("lo <= hi")
    days = span.select("*", F.explode(F.sequence(F.floor(F.col("lo") / day).cast("long"), F.floor(F.col("hi") / day).cast("long"))).alias("d"))
    a = F.greatest(F.col("lo"), (F.ceil(F.col("d") * day / us) * us).cast("long"))
    b = F.least(F.col("hi"), (F.ceil((F.col("d") + 1) * day / us) * us - us).cast("long"))
    return (days.select(*KEYS, a.alias("a"), b.alias("b")).filter("a <= b")
            .select(*KEYS, F.explode(F.sequence("a", "b", F.lit(us).cast("long"))).alias("t"))
            .select(*KEYS, F.timestamp_micros("t").alias("time")))


def snapshots(rows: DataFrame, ticks: DataFrame, period_s: int = C.SNAPSHOT_PERIOD_S, bounds: Bounds | None = None) -> DataFrame:
    """At every grid time the key's position, marked at the symbol's latest tick price (portfolio_ts rows); no
    row while the symbol has no price yet. The spine grows with the time span, not with tick volume.
    ``bounds``: cuts per symbol; by default those of the ticks."""
    spine = snapshot_times(rows, ticks, period_s)
    pos = asof_join(spine, rows, KEYS, "time", "time", ["cash_balance", "quantity"], "seq")
    # a symbol's grid is looked up once, whatever the number of its portfolios
    grid = spine.select("symbol", "time").distinct()
    marks = asof_join(grid, ticks, ["symbol"], "time", "timestamp", ["price"], "seq", prefix="mark_", bounds=bounds)
    px = pos.join(marks, ["symbol", "time"])
    mv = F.col("quantity") * F.col("mark_price")
    return (px.filter(F.col("mark_price").isNotNull())
              .select("time", "cash_balance", "symbol", "quantity", mv.alias("market_value"),
                      (F.col("cash_balance") + mv).alias("portfolio_value"), "strategy_name"))


def latest_by_max(rows: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """S16 replace-by-key: the newest row per key, by max_by. Partial aggregation makes a hot key cheap."""
    o = F.struct(*order)
    return rows.groupBy(*keys).agg(F.max(o).alias("__o"), F.max_by(F.struct(*cols), o).alias("__r")) \
               .select(*keys, *[F.col(f"__o.{c}").alias(c) for c in order], *[F.col(f"__r.{c}").alias(c) for c in cols])


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``latest_by_max`` with all columns, in their order."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    return latest_by_max(rows, keys, order, rest).select(*rows.columns)


def portfolio_key(rows: DataFrame, strategies: DataFrame, status_events: DataFrame | None = None) -> DataFrame:
    """S16 + K7: the current portfolio row per key with description and latest status. Without status events a
    portfolio is active once it has traded and closed before."""
    cur = latest_by_max(rows, KEYS, ORDER, ["cash_balance", "quantity", "market_value", "portfolio_value"])
    cur = cur.join(strategies.select("strategy_name", "strategy_description"), "strategy_name", "left")
    traded = F.when(F.col("seq") < 0, F.lit("closed")).otherwise(F.lit("active"))
    if status_events is not None:
        s = status_events.groupBy(*KEYS).agg(F.max_by("status", F.struct("time", "seq")).alias("__status"))
        cur, traded = cur.join(s, KEYS, "left"), F.coalesce("__status", traded)
    return cur.select(F.col("time").alias("last_updated"), "cash_balance", "symbol", "quantity", "market_value",
                      "portfolio_value", "strategy_name", "strategy_description", traded.alias("status"))
