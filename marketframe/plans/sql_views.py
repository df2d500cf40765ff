"""DuckDB-dialect definitions of the derived tables, used only by the oracle SQL.

They restate FIXTURES.md section 2 so that every oracle reads the same driver tables as the Spark
side. Each constant is a CTE body; ``with_views`` stitches the needed ones in front of a query.
"""

from __future__ import annotations

from marketframe import config as C

TICKS = """
SELECT event_id AS seq, ts AS timestamp, epoch_us(ts) // 1000 AS timestamp_ms, event_type AS symbol,
       value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
       ts + to_milliseconds(event_id % 1000) AS received_at,
       ts + to_milliseconds(event_id % 1000 + user_id) AS insert_time, user_id
FROM events"""

_strategy_rows = ", ".join(
    f"({i}, '{n}', '{d}', {ef}, CAST({a} AS DOUBLE), {ri}, {ms})"
    for i, (n, d, ef, a, ri, ms) in enumerate(C.STRATEGIES))
STRATEGIES = f"""
SELECT * FROM (VALUES {_strategy_rows})
  AS s(slot, strategy_name, strategy_description, execution_frequency, allocation_pct, reset_interval, max_streak)"""

DECISIONS = f"""
SELECT t.seq, t.timestamp AS time, t.symbol, CAST(t.volume % 3 AS INTEGER) AS pred_class,
       t.volume / 100.0 AS confidence,
       CAST((CAST(t.volume % 3 AS INTEGER) - 1) * (1 + t.seq % 10) AS DOUBLE) AS quantity,
       t.price AS model_price, s.strategy_name, s.strategy_description, s.execution_frequency,
       s.allocation_pct, s.reset_interval, s.max_streak,
       CASE CAST(t.volume % 3 AS INTEGER) WHEN 2 THEN 'BUY' WHEN 0 THEN 'SELL' ELSE 'HOLD' END AS signal
FROM ticks t JOIN strategies s ON s.slot = t.user_id % {len(C.STRATEGIES)}"""

# One-shot bars with the heavy-hitter open (most frequent price, lowest on ties).
BARS = """
SELECT b.minute, b.symbol, o.price AS open, b.high, b.low, b.close, b.avg, b.volume
FROM (SELECT date_trunc('minute', timestamp) AS minute, symbol, max(price) AS high, min(price) AS low,
             arg_max(price, {'ts': timestamp_ms, 'seq': seq}) AS close, avg(price) AS avg,
             sum(volume) AS volume
      FROM ticks GROUP BY 1, 2) b
JOIN (SELECT minute, symbol, price FROM (
        SELECT minute, symbol, price,
               row_number() OVER (PARTITION BY symbol, minute ORDER BY n DESC, price ASC) AS rn
        FROM (SELECT date_trunc('minute', timestamp) AS minute, symbol, price, count(*) AS n
              FROM ticks GROUP BY 1, 2, 3)) WHERE rn = 1) o
  ON o.minute = b.minute AND o.symbol = b.symbol"""

ORDER = ["ticks", "strategies", "decisions", "bars"]
BODIES = {"ticks": TICKS, "strategies": STRATEGIES, "decisions": DECISIONS, "bars": BARS}
DEPS = {"decisions": ["ticks", "strategies"], "bars": ["ticks"]}


def with_views(sql: str, *views: str, extra: list[tuple[str, str]] | None = None,
               recursive: bool = False) -> str:
    need: set[str] = set()

    def add(v):
        if v not in need:
            need.add(v)
            for dep in DEPS.get(v, []):
                add(dep)
    for v in views:
        add(v)
    ctes = [f"{v} AS ({BODIES[v]})" for v in ORDER if v in need]
    ctes += [f"{n} AS ({body})" for n, body in (extra or [])]
    if not ctes:
        return sql
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n" + sql
