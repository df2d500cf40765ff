"""Registered queries: as-of fills, risk checks, execution log, ledger, snapshots, signals and the
portfolio reports (J1–J7, K1–K7, L1–L8, R7, S16, W9, B7–B9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe import config as C
from marketframe.functions.text import raw_symbol
from marketframe.operators import ledger as LG
from marketframe.operators import risk as RK
from marketframe.operators import signals as SG
from marketframe.operators.asof import asof_join_offsets, missing_symbols
from marketframe.operators.scan import with_blocks
from marketframe.session import cut_lineage
from marketframe.plans import reports as R
from marketframe.plans.registry import register
from marketframe.plans.sql_views import with_views
from marketframe.sources import fixtures as X

_ROW_TYPES = ["timestamp", "long", "string", "string", "double", "double", "double", "double"]
KW = "PARTITION BY strategy_name, symbol ORDER BY time, seq"

# --- DuckDB CTE chain mirroring the Spark plan -----------------------------------------------
ORACLE_CTES = [
    ("fills", """
SELECT d.*, t1.price AS decision_price, t2.price AS fill_price
FROM (SELECT *, time + INTERVAL 1 SECOND AS fill_time FROM decisions) d
ASOF LEFT JOIN ticks t1 ON d.symbol = t1.symbol AND d.time >= t1.timestamp
ASOF LEFT JOIN ticks t2 ON d.symbol = t2.symbol AND d.fill_time >= t2.timestamp"""),
    ("recorded", f"""
SELECT seq, time, symbol, signal, quantity, model_price,
       CASE WHEN seq % {X.RECORDED_REJECT_EVERY} <> 0 THEN CASE WHEN strategy_name = '{C.LONG_ONLY}' THEN model_price ELSE fill_price END END
         AS executed_price, strategy_name, CASE WHEN seq % {X.RECORDED_REJECT_EVERY} <> 0 THEN 'Y' ELSE 'N' END AS approval_status
FROM fills"""),
    ("ledger", f"""
SELECT time, seq, strategy_name, symbol,
       {C.STARTING_CASH} - sum(quantity * executed_price) OVER wr AS cash_balance,
       sum(quantity) OVER wr AS quantity, sum(quantity * executed_price) OVER wr AS market_value,
       CAST({C.STARTING_CASH} AS DOUBLE) AS portfolio_value
FROM recorded WHERE approval_status = 'Y'
WINDOW wr AS ({KW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    ("portfolio_rows", f"""
SELECT (SELECT min(timestamp) - INTERVAL 1 SECOND FROM ticks) AS time, -1 AS seq, strategy_name, symbol,
       CAST({C.STARTING_CASH} AS DOUBLE) AS cash_balance, 0.0::DOUBLE AS quantity, 0.0::DOUBLE AS market_value,
       CAST({C.STARTING_CASH} AS DOUBLE) AS portfolio_value
FROM (VALUES {', '.join(f"('{n}', '{X.TICKER_EVENTS[t]}')" for n, t in C.SEED_PORTFOLIOS)}) AS v(strategy_name, symbol)
UNION ALL SELECT time, seq, strategy_name, symbol, cash_balance, quantity, market_value, portfolio_value FROM ledger"""),
    ("snap_spine", f"""
SELECT strategy_name, symbol, unnest(generate_series(lo, hi, INTERVAL {C.SNAPSHOT_PERIOD_S} SECOND)) AS time
FROM (SELECT strategy_name, symbol,
             make_timestamp(CAST(ceil(epoch_us(min(time)) / {C.SNAPSHOT_PERIOD_S}e6) AS BIGINT) * {C.SNAPSHOT_PERIOD_S}000000) AS lo,
             (SELECT make_timestamp(CAST(floor(epoch_us(max(timestamp)) / {C.SNAPSHOT_PERIOD_S}e6) AS BIGINT) * {C.SNAPSHOT_PERIOD_S}000000) FROM ticks) AS hi
      FROM portfolio_rows GROUP BY strategy_name, symbol)"""),
    ("portfolio_ts", """
SELECT s.time, l.cash_balance, s.symbol, l.quantity, l.quantity * t.price AS market_value,
       l.cash_balance + l.quantity * t.price AS portfolio_value, s.strategy_name
FROM snap_spine s
ASOF LEFT JOIN portfolio_rows l ON s.strategy_name = l.strategy_name AND s.symbol = l.symbol AND s.time >= l.time
ASOF LEFT JOIN ticks t ON s.symbol = t.symbol AND s.time >= t.timestamp
WHERE t.price IS NOT NULL"""),
    ("history", """
SELECT strategy_name, symbol, time, portfolio_value,
       max(portfolio_value) OVER (PARTITION BY strategy_name, symbol ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv_max
FROM portfolio_ts"""),
    ("state", """
SELECT f.*, r.quantity AS qty_before, r.cash_balance AS cash_before, r.market_value, r.portfolio_value,
       h.pv_max, h.portfolio_value AS pv_latest
FROM fills f
ASOF LEFT JOIN portfolio_rows r ON f.strategy_name = r.strategy_name AND f.symbol = r.symbol AND f.time > r.time
ASOF LEFT JOIN history h ON f.strategy_name = h.strategy_name AND f.symbol = h.symbol AND f.time > h.time"""),
    ("checks0", f"""
SELECT *,
  CASE WHEN strategy_name = '{C.LONG_ONLY}' THEN NULL
       WHEN quantity IS NULL OR model_price IS NULL OR portfolio_value IS NULL THEN '{C.ERR_POSITION}'
       WHEN abs(quantity * model_price) > {C.MAX_ALLOCATION} * portfolio_value
       THEN printf('{C.MSG_POSITION}', abs(quantity * model_price), {C.MAX_ALLOCATION * 100.0}, portfolio_value) END AS position_msg,
  CASE WHEN quantity IS NULL OR model_price IS NULL OR (signal = 'BUY' AND cash_before IS NULL) THEN '{C.ERR_CASH}'
       WHEN signal = 'BUY' AND abs(quantity) * model_price > cash_before
       THEN printf('{C.MSG_CASH}', abs(quantity) * model_price, cash_before) END AS cash_msg,
  CASE WHEN quantity IS NULL OR (signal = 'SELL' AND (qty_before IS NULL OR model_price IS NULL)) THEN '{C.ERR_QUANTITY}'
       WHEN signal = 'SELL' AND (qty_before + quantity) * model_price < -{C.MAX_SHORT}
       THEN printf('{C.MSG_SHORT}', CAST(qty_before AS VARCHAR), CAST(quantity AS VARCHAR)) END AS short_msg,
  CASE WHEN strategy_name = '{C.LONG_ONLY}' OR pv_max IS NULL OR pv_max <= 0 THEN NULL
       WHEN pv_latest IS NULL THEN '{C.ERR_DRAWDOWN}'
       WHEN (pv_max - pv_latest) / pv_max > {C.MAX_DRAWDOWN}
       THEN printf('{C.MSG_DRAWDOWN}', (pv_max - pv_latest) / pv_max * 100.0, {C.MAX_DRAWDOWN * 100.0}) END AS drawdown_msg
FROM state"""),
    ("checks", """
SELECT *,
  CASE WHEN coalesce(position_msg, cash_msg, short_msg, drawdown_msg) IS NULL THEN 'Y' ELSE 'N' END AS approval_status,
  CASE WHEN coalesce(position_msg, cash_msg, short_msg, drawdown_msg) IS NULL THEN 'Approved'
       ELSE concat_ws('; ', position_msg, cash_msg, short_msg, drawdown_msg) END AS approval_comment
FROM checks0"""),
    ("execution", f"""
SELECT seq, time, symbol, signal, quantity, model_price,
       CASE WHEN approval_status = 'Y' THEN
            CASE WHEN strategy_name = '{C.LONG_ONLY}' OR signal = 'CLOSE' THEN model_price ELSE fill_price END
       END AS executed_price, strategy_name, approval_status, approval_comment
FROM checks"""),
    ("portfolio_key", """
SELECT l.time AS last_updated, l.cash_balance, l.symbol, l.quantity, l.market_value, l.portfolio_value,
       l.strategy_name, s.strategy_description, CASE WHEN l.seq < 0 THEN 'closed' ELSE 'active' END AS status
FROM (SELECT * FROM portfolio_rows QUALIFY row_number() OVER (PARTITION BY strategy_name, symbol ORDER BY time DESC, seq DESC) = 1) l
LEFT JOIN strategies s ON s.strategy_name = l.strategy_name"""),
]
_NAMES = [n for n, _ in ORACLE_CTES]


def _tsql(select: str, upto: str) -> str:
    extra = ORACLE_CTES[: _NAMES.index(upto) + 1]
    return with_views(select, "decisions", extra=extra)


# --- Spark plan ---------------------------------------------------------------------------------
def ticks(spark, sf_dir):
    return X.ticks(spark, sf_dir).select("seq", "timestamp", "symbol", "price")


def fills(spark, sf_dir, decisions=None, bounds=None):
    """J1 + J2 in one scan: latest tick price at the decision and one second after it. Materialised: the recorded
    log and the checks both start here."""
    f = asof_join_offsets(X.decisions(spark, sf_dir) if decisions is None else decisions, ticks(spark, sf_dir), ["symbol"], "time", "timestamp", ["price"], "seq",
                          "seq", {"decision_": 0.0, "fill_": 1.0}, bounds=bounds or X.tick_bounds(spark, sf_dir))
    return cut_lineage(f)


def ledger(spark, sf_dir, filled=None, bounds=None):
    """Ledger of the recorded log, materialised: portfolio rows, snapshots and checks read it. A chain takes its
    symbols' ``bounds`` once."""
    bounds = bounds or X.tick_bounds(spark, sf_dir)
    filled = fills(spark, sf_dir, bounds=bounds) if filled is None else filled
    return cut_lineage(LG.ledger(X.recorded_executions(filled), bounds))


def portfolio_rows(spark, sf_dir, filled=None, bounds=None):
    return LG.with_seeds(ledger(spark, sf_dir, filled, bounds), X.seed_portfolios(spark), ticks(spark, sf_dir))


def snapshots(spark, sf_dir, rows=None, bounds=None):
    bounds = bounds or X.tick_bounds(spark, sf_dir)
    rows = portfolio_rows(spark, sf_dir, bounds=bounds) if rows is None else rows
    return LG.snapshots(rows, ticks(spark, sf_dir), bounds=bounds)


def state(spark, sf_dir):
    """Orders with the portfolio row and value series before them, materialised: risk, streak and sizing start here."""
    bounds = X.tick_bounds(spark, sf_dir)
    filled = fills(spark, sf_dir, bounds=bounds)
    rows = portfolio_rows(spark, sf_dir, filled, bounds)
    return cut_lineage(RK.portfolio_state(filled, rows, cut_lineage(snapshots(spark, sf_dir, rows, bounds))))


def checked(spark, sf_dir):
    return RK.risk_checks(state(spark, sf_dir))


def execution(spark, sf_dir):
    return RK.execution_log(checked(spark, sf_dir))


def portfolio_key(spark, sf_dir):
    return LG.portfolio_key(portfolio_rows(spark, sf_dir), X.strategies(spark))


@register("asof_fill", _tsql("SELECT seq, strategy_name, symbol, time, model_price, decision_price, fill_price FROM fills",
                             "fills"), ["model_price", "decision_price", "fill_price"], "J1 J2")
def asof_fill_q(spark, sf_dir):
    return fills(spark, sf_dir).select("seq", "strategy_name", "symbol", "time", "model_price", "decision_price",
                                       "fill_price")


_REQUIRED = ", ".join(f"('{s}')" for s in C.SYMBOLS_RAW)


@register("missing_symbols", with_views(f"""
SELECT r.raw_symbol FROM (VALUES {_REQUIRED}) AS r(raw_symbol)
WHERE NOT EXISTS (SELECT 1 FROM ticks t WHERE concat('BINANCE:', upper(t.symbol), 'USDT') = r.raw_symbol)""", "ticks"),
          [], "J5 J6")
def missing_symbols_q(spark, sf_dir):
    req = spark.createDataFrame([(s,) for s in C.SYMBOLS_RAW], "raw_symbol string")
    avail = X.ticks(spark, sf_dir).select(raw_symbol(F.upper("symbol")).alias("symbol"))
    return missing_symbols(req.withColumnRenamed("raw_symbol", "symbol"), avail).withColumnRenamed("symbol", "raw_symbol")


RISK_COLS = ["seq", "strategy_name", "symbol", "time", "position_msg", "cash_msg", "short_msg", "drawdown_msg",
             "approval_status", "approval_comment"]


@register("risk_checks", _tsql(f"SELECT {', '.join(RISK_COLS)} FROM checks", "checks"), [], "K1 K2 K3 K4 K5 F15 F16 F17")
def risk_checks_q(spark, sf_dir):
    return checked(spark, sf_dir).select(*RISK_COLS)


@register("drawdown", _tsql("""
SELECT strategy_name, symbol, min(portfolio_value) AS min_val, max(portfolio_value) AS max_val,
       arg_max(portfolio_value, time) AS latest_val
FROM portfolio_ts GROUP BY ALL""", "portfolio_ts"), ["min_val", "max_val", "latest_val"], "J4 A2 K4")
def drawdown_q(spark, sf_dir):
    s = snapshots(spark, sf_dir)
    return s.groupBy("strategy_name", "symbol").agg(
        F.min("portfolio_value").alias("min_val"), F.max("portfolio_value").alias("max_val"),
        F.max_by("portfolio_value", "time").alias("latest_val"))


EXEC_COLS = ["seq", "time", "symbol", "signal", "quantity", "model_price", "executed_price", "strategy_name",
             "approval_status", "approval_comment"]


@register("execution", _tsql(f"SELECT {', '.join(EXEC_COLS)} FROM execution", "execution"),
          ["quantity", "model_price", "executed_price"], "K6 S8")
def execution_q(spark, sf_dir):
    return execution(spark, sf_dir)


LEDGER_COLS = ["time", "seq", "strategy_name", "symbol", "cash_balance", "quantity", "market_value", "portfolio_value"]


@register("ledger", _tsql(f"SELECT {', '.join(LEDGER_COLS)} FROM ledger", "ledger"),
          ["cash_balance", "quantity", "market_value", "portfolio_value"], "L1 S21")
def ledger_q(spark, sf_dir):
    return ledger(spark, sf_dir)


@register("mark_to_market", _tsql("""
SELECT l.time, l.seq, l.strategy_name, l.symbol, l.cash_balance, l.quantity, t.price AS mark_price,
       l.quantity * t.price AS market_value, l.cash_balance + l.quantity * t.price AS portfolio_value
FROM ledger l ASOF LEFT JOIN ticks t ON l.symbol = t.symbol AND l.time >= t.timestamp""", "ledger"),
          ["cash_balance", "quantity", "mark_price", "market_value", "portfolio_value"], "L2 J1")
def mark_to_market_q(spark, sf_dir):
    bounds = X.tick_bounds(spark, sf_dir)
    return LG.mark_to_market(ledger(spark, sf_dir, bounds=bounds), ticks(spark, sf_dir), bounds)


SNAP_COLS = ["time", "cash_balance", "symbol", "quantity", "market_value", "portfolio_value", "strategy_name"]


@register("snapshots", _tsql(f"SELECT {', '.join(SNAP_COLS)} FROM portfolio_ts", "portfolio_ts"),
          ["cash_balance", "quantity", "market_value", "portfolio_value"], "R7 L2 J1")
def snapshots_q(spark, sf_dir):
    return snapshots(spark, sf_dir)


KEY_COLS = ["last_updated", "cash_balance", "symbol", "quantity", "market_value", "portfolio_value", "strategy_name",
            "strategy_description", "status"]


@register("portfolio_key", _tsql(f"SELECT {', '.join(KEY_COLS)} FROM portfolio_key", "portfolio_key"),
          ["cash_balance", "quantity", "market_value", "portfolio_value"], "S16 K7 J3 J7 T5")
def portfolio_key_q(spark, sf_dir):
    return portfolio_key(spark, sf_dir)


_STREAK_SQL = f"""
SELECT seq, strategy_name, symbol, time, raw_signal, run_pos, forced, streak,
       CASE WHEN forced THEN CASE raw_signal WHEN 'BUY' THEN 'SELL' WHEN 'SELL' THEN 'BUY'
                                 ELSE CASE WHEN seq % 2 = 0 THEN 'BUY' ELSE 'SELL' END END
            ELSE raw_signal END AS signal, confidence, allocation_pct, model_price, portfolio_value
FROM (
  SELECT *, CASE WHEN max_streak <= 1 THEN TRUE ELSE run_pos > 1 AND (run_pos - 1) % (max_streak - 1) = 0 END AS forced,
         CAST(CASE WHEN max_streak <= 1 THEN 1 ELSE (run_pos - 1) % (max_streak - 1) + 1 END AS INTEGER) AS streak
  FROM (
    SELECT *, CAST(rn - max(start) OVER ({KW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1 AS INTEGER) AS run_pos
    FROM (SELECT *, signal AS raw_signal, row_number() OVER ({KW}) AS rn,
                 CASE WHEN lag(signal) OVER ({KW}) IS NOT DISTINCT FROM signal THEN NULL
                      ELSE row_number() OVER ({KW}) END AS start
          FROM state WHERE strategy_name <> '{C.LONG_ONLY}')))"""


def streaks(spark, sf_dir, orders):
    """Runs of raw signals; they need nothing but the decisions, so ``orders`` may or may not carry a state."""
    s = orders.filter(F.col("strategy_name") != C.LONG_ONLY).withColumnRenamed("signal", "raw_signal")
    s = with_blocks(s, X.tick_bounds(spark, sf_dir), ["symbol"], "time", F.col("seq"))
    return SG.apply_streak(SG.run_positions(s, "raw_signal"))


@register("signal_streak", _tsql(
    "SELECT seq, strategy_name, symbol, time, raw_signal, run_pos, forced, streak, signal FROM (" + _STREAK_SQL + ")",
    "state"), [], "W9 L3 L4")
def signal_streak_q(spark, sf_dir):
    decided = cut_lineage(X.decisions(spark, sf_dir).select("seq", "strategy_name", "symbol", "time", "signal", "max_streak"))
    return streaks(spark, sf_dir, decided).select("seq", "strategy_name", "symbol", "time", "raw_signal", "run_pos", "forced",
                                                  "streak", "signal")


@register("order_sizing", _tsql(f"""
SELECT seq, strategy_name, symbol, signal, streak, size_factor,
       CASE WHEN signal IN ('BUY', 'SELL') THEN portfolio_value * allocation_pct * size_factor / model_price
            ELSE 0.0 END AS order_qty
FROM (SELECT *, CASE WHEN confidence > {C.CONF_HIGH} THEN {C.SIZE_HIGH} WHEN confidence > {C.CONF_MID} THEN {C.SIZE_MID}
                     ELSE {C.SIZE_LOW} END / streak AS size_factor
      FROM ({_STREAK_SQL}))""", "state"), ["size_factor", "order_qty"], "L5 L6")
def order_sizing_q(spark, sf_dir):
    s = streaks(spark, sf_dir, state(spark, sf_dir)).withColumn("size_factor", SG.size_factor())
    return s.select("seq", "strategy_name", "symbol", "signal", "streak", "size_factor",
                    SG.order_quantity().alias("order_qty"))


@register("long_only_orders", with_views(f"""
SELECT time, seq, strategy_name, symbol, 'BUY' AS signal,
       {C.STARTING_CASH} * allocation_pct / model_price * {C.LONG_ONLY_BUFFER} AS quantity, model_price
FROM decisions WHERE strategy_name = '{C.LONG_ONLY}'
QUALIFY row_number() OVER (PARTITION BY strategy_name, symbol ORDER BY time, seq) = 1""", "decisions"),
          ["quantity", "model_price"], "L7")
def long_only_orders_q(spark, sf_dir):
    return SG.long_only_orders(X.decisions(spark, sf_dir))


@register("close_orders", _tsql("""
SELECT last_updated AS time, strategy_name, symbol, 'CLOSE' AS signal, -quantity AS quantity,
       CASE WHEN quantity <> 0 THEN market_value / quantity ELSE 0.0 END AS model_price,
       CASE WHEN quantity <> 0 THEN market_value / quantity ELSE 0.0 END AS executed_price,
       'Y' AS approval_status, 'Closing Position' AS approval_comment
FROM portfolio_key""", "portfolio_key"), ["quantity", "model_price", "executed_price"], "L8")
def close_orders_q(spark, sf_dir):
    return SG.close_orders(portfolio_key(spark, sf_dir))


@register("portfolio_by_bucket", _tsql("""
SELECT time_bucket AS time, category AS metric, sum(avg_value) * 5 AS portfolio_value
FROM (SELECT time_bucket(INTERVAL 30 MINUTE, time) AS time_bucket,
             CASE WHEN starts_with(strategy_name, 'Long') THEN 'Long Only' ELSE 'ML Strategies' END AS category,
             avg(portfolio_value) AS avg_value
      FROM portfolio_ts GROUP BY ALL) GROUP BY ALL""", "portfolio_ts"), ["portfolio_value"], "B7 A8 F2 P14")
def portfolio_by_bucket_q(spark, sf_dir):
    return R.portfolio_by_bucket(snapshots(spark, sf_dir))


@register("portfolio_overview", _tsql("""
SELECT CASE WHEN starts_with(strategy_name, 'Long') THEN 'Long Only' ELSE 'ML Strategies' END AS strategy_group,
       sum(market_value) AS total_market_position, sum(cash_balance) AS total_cash_position,
       sum(portfolio_value) AS total_net_value
FROM portfolio_key GROUP BY 1""", "portfolio_key"),
          ["total_market_position", "total_cash_position", "total_net_value"], "B8 A18")
def portfolio_overview_q(spark, sf_dir):
    return R.portfolio_overview(portfolio_key(spark, sf_dir))


@register("recent_trades", _tsql("""
SELECT time, strategy_name, symbol, signal, quantity, executed_price * quantity AS trade_value, approval_status,
       approval_comment
FROM execution ORDER BY time DESC, strategy_name, symbol, seq DESC LIMIT 7""", "execution"), ["quantity", "trade_value"],
          "B9 T3 P13")
def recent_trades_q(spark, sf_dir):
    """The newest orders depend on the decisions alone, so they are chosen first; only their portfolios' fills, ledger
    and snapshots are built, and the state is looked up for these few orders."""
    decisions = X.decisions(spark, sf_dir)
    newest = cut_lineage(decisions.orderBy(F.desc("time"), "strategy_name", "symbol", F.desc("seq")).limit(R.RECENT_TRADES))
    keys = F.broadcast(newest.select(*RK.KEYS).distinct())                        # at most RECENT_TRADES rows
    bounds = X.tick_bounds(spark, sf_dir)
    filled = fills(spark, sf_dir, decisions.join(keys, RK.KEYS, "left_semi"), bounds)
    rows = cut_lineage(portfolio_rows(spark, sf_dir, filled, bounds).join(keys, RK.KEYS, "left_semi"))
    orders = filled.join(F.broadcast(newest.select("seq")), "seq", "left_semi")
    state = RK.state_of_few(orders, rows, snapshots(spark, sf_dir, rows, bounds))
    return R.recent_trades(RK.execution_log(RK.risk_checks(state)))


RESET_SQL = """
SELECT strategy_name, symbol, t AS reset_time, CAST(n AS BIGINT) AS reset_no FROM (
  WITH RECURSIVE dt AS (SELECT DISTINCT strategy_name, symbol, time AS t, CAST(reset_interval AS DOUBLE) AS iv
                        FROM decisions),
  r(strategy_name, symbol, t, n) AS (
    SELECT strategy_name, symbol, min(t), 0 FROM dt GROUP BY ALL
    UNION ALL
    SELECT r.strategy_name, r.symbol,
           (SELECT min(d.t) FROM dt d WHERE d.strategy_name = r.strategy_name AND d.symbol = r.symbol
              AND d.t > r.t + to_microseconds(CAST((SELECT max(iv) FROM dt x WHERE x.strategy_name = r.strategy_name
                                                    AND x.t = r.t AND x.symbol = r.symbol) * 1e6 AS BIGINT))),
           r.n + 1
    FROM r
    WHERE (SELECT min(d.t) FROM dt d WHERE d.strategy_name = r.strategy_name AND d.symbol = r.symbol
             AND d.t > r.t + to_microseconds(CAST((SELECT max(iv) FROM dt x WHERE x.strategy_name = r.strategy_name
                                                   AND x.t = r.t AND x.symbol = r.symbol) * 1e6 AS BIGINT))) IS NOT NULL)
  SELECT * FROM r) WHERE n > 0"""


@register("reset_points", with_views(RESET_SQL, "decisions"), [], "L9")
def reset_points_q(spark, sf_dir):
    d = X.decisions(spark, sf_dir).select("strategy_name", "symbol", "time", "reset_interval")
    return SG.reset_points(d, ["strategy_name", "symbol"])


@register("portfolio_status", with_views(f"""
SELECT strategy_name, symbol, arg_max(status, {{'t': time, 'o': o}}) AS status, max(time) AS status_time
FROM (SELECT strategy_name, symbol, time, 0 AS o, 'active' AS status FROM decisions
      UNION ALL
      SELECT strategy_name, symbol, (SELECT min(timestamp) - INTERVAL 1 SECOND FROM ticks), -1, 'closed'
      FROM (VALUES {', '.join(f"('{n}', '{X.TICKER_EVENTS[t]}')" for n, t in C.SEED_PORTFOLIOS)}) AS v(strategy_name, symbol)
      UNION ALL
      SELECT strategy_name, symbol, reset_time, 1, 'closed' FROM ({RESET_SQL}) AS rp)
GROUP BY strategy_name, symbol""", "decisions"), [], "K7 L8 L9")
def portfolio_status_q(spark, sf_dir):
    """K7: latest status event per portfolio: every decision marks it 'active'; a reset (L9) closes the
    position and marks it 'closed' after that iteration's 'active'. Grouped max_by, one row per key."""
    d = X.decisions(spark, sf_dir).select("strategy_name", "symbol", "time", "reset_interval")
    resets = SG.reset_points(d, ["strategy_name", "symbol"])
    seeds = LG.with_seeds(d.limit(0).select(*[F.lit(None).cast(t).alias(c) for c, t in zip(LG.ROW, _ROW_TYPES)]),
                          X.seed_portfolios(spark), ticks(spark, sf_dir))
    events = (d.select("strategy_name", "symbol", "time", F.lit(0).alias("o"), F.lit("active").alias("status"))
               .unionByName(seeds.select("strategy_name", "symbol", "time", F.lit(-1).alias("o"), F.lit("closed").alias("status")))
               .unionByName(resets.select("strategy_name", "symbol", F.col("reset_time").alias("time"),
                                          F.lit(1).alias("o"), F.lit("closed").alias("status"))))
    return events.groupBy("strategy_name", "symbol").agg(
        F.max_by("status", F.struct("time", "o")).alias("status"), F.max("time").alias("status_time"))
