"""Pre-trade checks K1–K5 and the execution record K6, set-based.

The modelled system checks each order against the portfolio row and the value series as they stand at that
moment. Here the recorded execution log gives both: ``portfolio_state`` looks up, for every order at once, the
newest portfolio row and snapshot strictly before it (J3, J4). A rejection changes no later state, because the
state comes from what was recorded. A check that cannot be made (missing row, NULL field) fails with its error
text, as in the modelled system: nothing is approved on missing state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketframe import config as C
from marketframe.functions.text import join_messages
from marketframe.operators.asof import asof_lookup

KEYS = ["strategy_name", "symbol"]
ORDER = ["time", "seq"]


def direction(signal: str = "signal") -> Column:
    return (F.when(F.col(signal) == "BUY", F.lit(1)).when(F.col(signal) == "SELL", F.lit(-1))
             .otherwise(F.lit(0)))


def portfolio_state(orders: DataFrame, rows: DataFrame, values: DataFrame) -> DataFrame:
    """Adds qty_before, cash_before, market_value and portfolio_value of the newest portfolio row before
    the order (NULL without one), and of the value series before it the maximum (pv_max) and the latest (pv_latest).
    One blocked scan over orders, rows and snapshots answers all."""
    r = rows.select(*KEYS, "time", "seq", "quantity", "cash_balance", "market_value", "portfolio_value")
    v = values.select(*KEYS, "time", F.lit(0).cast("long").alias("seq"), F.col("portfolio_value").alias("value"))
    o = asof_lookup(orders, {"row": r, "snap": v}, KEYS, "time", "time", "seq", strict=True, maxes={"value": "pv_max"})
    return o.select(*orders.columns, F.col("row.quantity").alias("qty_before"), F.col("row.cash_balance").alias("cash_before"),
                    F.col("row.market_value").alias("market_value"), F.col("row.portfolio_value").alias("portfolio_value"),
                    "pv_max", F.col("snap.value").alias("pv_latest"))


def state_of_few(orders: DataFrame, rows: DataFrame, values: DataFrame) -> DataFrame:
    """``portfolio_state`` for a bounded handful of orders (a top-k report), of different ``seq``: they are broadcast to
    the rows and snapshots, which come back as one pre-aggregated row an order; no scan over the whole history."""
    few = F.broadcast(orders.select(*[F.col(k).alias(f"__{k}") for k in KEYS], F.col("seq").alias("__order"), F.col("time").alias("__at")))
    mine = [F.col(k) == F.col(f"__{k}") for k in KEYS]

    def before(frame: DataFrame) -> DataFrame:
        return frame.join(few, mine).filter(F.col("time") < F.col("__at")).groupBy("__order")

    fields = ["quantity", "cash_balance", "market_value", "portfolio_value"]
    row = before(rows).agg(F.max_by(F.struct(*fields), F.struct("time", "seq")).alias("row"))
    snap = before(values).agg(F.max("portfolio_value").alias("pv_max"), F.max_by("portfolio_value", "time").alias("pv_latest"))
    o = orders.join(row, orders["seq"] == row["__order"], "left").drop("__order")
    o = o.join(snap, o["seq"] == snap["__order"], "left").drop("__order")
    return o.select(*orders.columns, F.col("row.quantity").alias("qty_before"), F.col("row.cash_balance").alias("cash_before"),
                    F.col("row.market_value").alias("market_value"), F.col("row.portfolio_value").alias("portfolio_value"), "pv_max", "pv_latest")


def _failed(error: Column, text: str, fail: Column, message: Column) -> Column:
    """The error text where the check could not be made, the message where it failed, NULL where it passed."""
    return F.when(error, F.lit(text)).when(F.coalesce(fail, F.lit(False)), message)


def check_position_size(max_allocation: float = C.MAX_ALLOCATION) -> Column:
    """K1: Long Only bypasses."""
    tv = F.abs(F.col("quantity") * F.col("model_price"))
    msg = F.format_string(C.MSG_POSITION, tv, F.lit(max_allocation * 100.0), F.col("portfolio_value"))
    check = _failed(tv.isNull() | F.col("portfolio_value").isNull(), C.ERR_POSITION,
                    tv > F.lit(max_allocation) * F.col("portfolio_value"), msg)
    return F.when(~F.col("strategy_name").eqNullSafe(F.lit(C.LONG_ONLY)), check)


def check_cash_balance() -> Column:
    """K2: a BUY costing more than the cash balance fails; only a BUY needs the balance."""
    cost = F.abs(F.col("quantity")) * F.col("model_price") * direction()
    buy = direction() == 1
    return _failed(cost.isNull() | (buy & F.col("cash_before").isNull()), C.ERR_CASH,
                   buy & (cost > F.col("cash_before")), F.format_string(C.MSG_CASH, cost, F.col("cash_before")))


def check_short_limit(max_short: float = C.MAX_SHORT) -> Column:
    """K3: a SELL that takes (position + trade) × price below −max_short fails; only a SELL needs the position."""
    sell = direction() == -1
    after = (F.col("qty_before") + F.col("quantity")) * F.col("model_price")
    msg = F.format_string(C.MSG_SHORT, F.col("qty_before").cast("string"), F.col("quantity").cast("string"))
    return _failed(F.col("quantity").isNull() | (sell & after.isNull()), C.ERR_QUANTITY, sell & (after < F.lit(-max_short)), msg)


def check_drawdown(max_drawdown: float = C.MAX_DRAWDOWN) -> Column:
    """K4: (max − latest) / max of the value series; no series or max <= 0 passes. Long Only bypasses."""
    some = F.coalesce(F.col("pv_max") > 0, F.lit(False))
    dd = F.try_divide(F.col("pv_max") - F.col("pv_latest"), F.col("pv_max"))
    check = _failed(some & F.col("pv_latest").isNull(), C.ERR_DRAWDOWN, some & (dd > F.lit(max_drawdown)),
                    F.format_string(C.MSG_DRAWDOWN, dd * F.lit(100.0), F.lit(max_drawdown * 100.0)))
    return F.when(~F.col("strategy_name").eqNullSafe(F.lit(C.LONG_ONLY)), check)


def risk_checks(state: DataFrame) -> DataFrame:
    """K5: run the four checks; approved iff none failed; comments joined in check order."""
    msgs = [check_position_size(), check_cash_balance(), check_short_limit(), check_drawdown()]
    names = ["position_msg", "cash_msg", "short_msg", "drawdown_msg"]
    s = state.select("*", *[m.alias(n) for m, n in zip(msgs, names)])
    any_fail = F.coalesce(*[F.col(n) for n in names]).isNotNull()
    return (s.withColumn("approval_status", F.when(any_fail, F.lit("N")).otherwise(F.lit("Y")))
             .withColumn("approval_comment", F.when(any_fail, join_messages(*names)).otherwise(F.lit("Approved"))))


def execution_log(checked: DataFrame, fill_price: str = "fill_price") -> DataFrame:
    """K6: one execution row per order. Rejected → executed_price NULL; Long Only and CLOSE fill at
    the model price; other approved orders at the fill price (J2). HOLD is recorded with quantity 0."""
    approved = F.col("approval_status") == "Y"
    at_model = (F.col("strategy_name") == C.LONG_ONLY) | (F.col("signal") == "CLOSE")
    px = F.when(approved, F.when(at_model, F.col("model_price")).otherwise(F.col(fill_price)))
    return checked.select("seq", "time", "symbol", "signal", "quantity", "model_price", px.alias("executed_price"),
                          "strategy_name", "approval_status", "approval_comment")
