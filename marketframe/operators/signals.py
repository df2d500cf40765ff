"""Signals and sizing (W9, L3–L8), set-based.

The modelled loop keeps ``last_signal`` and ``signal_streak`` and, after ``max_streak`` equal raw
signals, flips the signal (BUY↔SELL, HOLD→a random side) and resets the streak to 1. With p the
1-based position of a row inside its run of equal raw signals and M = max_streak >= 2 this is closed
form: forced = p > 1 and (p−1) mod (M−1) = 0, streak = (p−1) mod (M−1) + 1. M <= 1 forces every
row with streak 1. The random side of a forced HOLD is replaced by a deterministic rule on the
order id (even seq → BUY).

Run positions come from blocked scans, so one portfolio with a third of all decisions still runs
in parallel over its time blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from marketframe import config as C
from marketframe.operators import windows as W
from marketframe.operators.asof import asof_lookup
from marketframe.operators.scan import BLOCK, blocked_scan
from marketframe.session import cut_lineage, ship_package

KEYS = ["strategy_name", "symbol"]
ORDER = ["time", "seq"]


def class_to_signal(cls: str = "pred_class") -> Column:
    """L3: 2 → BUY, 0 → SELL, else HOLD."""
    return (F.when(F.col(cls) == C.BUY, F.lit("BUY")).when(F.col(cls) == C.SELL, F.lit("SELL"))
             .otherwise(F.lit("HOLD")))


def run_positions(df: DataFrame, value: str, keys=KEYS, order=ORDER, out: str = "run_pos") -> DataFrame:
    """W9 gaps-and-islands with blocked scans: position of each row in its run of equal values. ``df`` carries
    block numbers (``scan.with_blocks``)."""
    d = df.withColumn("__one", F.lit(1))
    d = blocked_scan(d, keys, order, sums={"__one": "__rn"}, prevs={value: "__prev"})
    d = cut_lineage(d.withColumn("__start", F.when((F.col("__rn") == 1) | ~F.col("__prev").eqNullSafe(F.col(value)), F.col("__rn"))))
    d = blocked_scan(d, keys, order, lasts={"__start": "__run_start"})
    return d.withColumn(out, (F.col("__rn") - F.col("__run_start") + 1).cast("int")) \
            .drop("__one", "__rn", "__prev", "__start", "__run_start", BLOCK)


def apply_streak(df: DataFrame, raw: str = "raw_signal", max_streak: str = "max_streak") -> DataFrame:
    """L4 on top of ``run_pos``: forced flag, final signal and streak."""
    p, m = F.col("run_pos"), F.col(max_streak)
    period = m - 1
    forced = F.when(m <= 1, F.lit(True)).otherwise((p > 1) & (((p - 1) % F.greatest(period, F.lit(1))) == 0))
    streak = F.when(m <= 1, F.lit(1)).otherwise(((p - 1) % F.greatest(period, F.lit(1))) + 1)
    flipped = (F.when(F.col(raw) == "BUY", F.lit("SELL")).when(F.col(raw) == "SELL", F.lit("BUY"))
                .otherwise(F.when(F.col("seq") % 2 == 0, F.lit("BUY")).otherwise(F.lit("SELL"))))
    return (df.withColumn("forced", forced).withColumn("streak", streak.cast("int"))
              .withColumn("signal", F.when(F.col("forced"), flipped).otherwise(F.col(raw))))


def size_factor(conf: str = "confidence", streak: str = "streak") -> Column:
    """1 / .5 / .25 by confidence band, divided by the streak."""
    base = (F.when(F.col(conf) > C.CONF_HIGH, F.lit(C.SIZE_HIGH)).when(F.col(conf) > C.CONF_MID, F.lit(C.SIZE_MID))
             .otherwise(F.lit(C.SIZE_LOW)))
    return base / F.col(streak)


def order_quantity(pv: str = "portfolio_value", alloc: str = "allocation_pct", factor: str = "size_factor",
                   price: str = "model_price", signal: str = "signal") -> Column:
    """Pv · allocation · factor / price for BUY/SELL, else 0 (NULL price → NULL)."""
    q = F.try_divide(F.col(pv) * F.col(alloc) * F.col(factor), F.col(price))
    return F.when(F.col(signal).isin("BUY", "SELL"), q).otherwise(F.lit(0.0))


def long_only_orders(decisions: DataFrame, starting_cash: float = C.STARTING_CASH) -> DataFrame:
    """Each Long Only key buys once, at its first decision, cash · allocation / price · .999999999."""
    lo = decisions.filter(F.col("strategy_name") == C.LONG_ONLY)
    first = lo.groupBy(*KEYS).agg(F.min(F.struct(*ORDER, "model_price", "allocation_pct")).alias("f"))
    qty = F.try_divide(F.lit(float(starting_cash)) * F.col("f.allocation_pct"), F.col("f.model_price")) \
        * F.lit(C.LONG_ONLY_BUFFER)
    return first.select(F.col("f.time").alias("time"), F.col("f.seq").alias("seq"), *KEYS,
                        F.lit("BUY").alias("signal"), qty.alias("quantity"), F.col("f.model_price").alias("model_price"))


def close_orders(portfolio_key: DataFrame) -> DataFrame:
    """Close every position: −quantity at market_value / quantity (0 when flat), always approved."""
    px = F.when(F.col("quantity") != 0, F.try_divide(F.col("market_value"), F.col("quantity"))).otherwise(F.lit(0.0))
    return portfolio_key.select(F.col("last_updated").alias("time"), "strategy_name", "symbol",
                                F.lit("CLOSE").alias("signal"), (-F.col("quantity")).alias("quantity"),
                                px.alias("model_price"), px.alias("executed_price"),
                                F.lit("Y").alias("approval_status"), F.lit("Closing Position").alias("approval_comment"))


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """For every time of a block the threshold that a schedule reset at it leaves the block with."""
    t, iv = pdf["t"].to_numpy(), pdf["iv"].to_numpy()
    order = np.argsort(t, kind="stable")
    t, leave = t[order], (t + iv)[order]
    nxt = np.searchsorted(t, leave, side="right")               # place of the first time beyond the threshold
    for i in range(len(t) - 1, -1, -1):
        if nxt[i] < len(t):
            leave[i] = leave[nxt[i]]
    return pd.DataFrame({"t": t, "leave": leave})


def _expand(pdf: pd.DataFrame, entry: int) -> np.ndarray:
    """The schedule's times inside one block, from the time it enters at."""
    t, iv = pdf["t"].to_numpy(), pdf["iv"].to_numpy()
    order = np.argsort(t, kind="stable")
    t, iv = t[order], iv[order]
    nxt, i, out = np.searchsorted(t, t + iv, side="right"), int(np.searchsorted(t, entry)), []
    while i < len(t):
        out.append(t[i])
        i = int(nxt[i])
    return np.array(out, dtype=np.int64)


def _reached(first: DataFrame, hops: DataFrame) -> DataFrame:
    """``(k, a)``: all nodes on the path from each key's first node along ``hops(k, a, b)``, by pointer doubling.

    Going up, level n holds hops of 2**n steps, cut to the nodes that such a hop still reaches (and the first ones),
    until none is left; going down, the nodes found so far are sent along each level. About log2 of the path's length
    rounds of equi-joins over single rows, so no task ever holds a key.
    """
    levels = []
    while not hops.isEmpty():
        levels.append(hops)
        twice = hops.join(hops.select("k", F.col("a").alias("b"), F.col("b").alias("c")), ["k", "b"]).select("k", "a", F.col("c").alias("b"))
        kept = first.unionByName(twice.select("k", F.col("b").alias("a"))).distinct()
        hops = cut_lineage(twice.join(kept, ["k", "a"], "left_semi"))
    path = first
    for level in reversed(levels):
        path = cut_lineage(path.unionByName(path.join(level, ["k", "a"]).select("k", F.col("b").alias("a"))))
    return path


def reset_points(times: DataFrame, keys: list[str], time_col: str = "time", interval_col: str = "reset_interval",
                 block_rows: int = 20_000) -> DataFrame:
    """L9 greedy reset schedule per key: start r0 = first time; each next reset is the first time strictly later
    than (previous reset + interval seconds). Returns the resets after r0 with their ordinal (r0 itself is the
    strategy start, not a reset). Rows without a time are ignored, no interval is 0; keys may be NULL.

    Exact, and no group is larger than ``block_rows``, whatever the key and the interval:
    1. a key's distinct times are cut into blocks of ``block_rows`` by rank; every (key, block) finds, for each of its
       times, the threshold that a schedule reset there leaves the block with;
    2. an as-of lookup finds the first time beyond each threshold: the hops between blocks. The times that the key's
       schedule enters its blocks at are the path from r0 along them (``_reached``), at most one a block;
    3. every entered (key, block) expands the schedule inside from its entry.
    """
    ship_package(times.sparkSession)
    t = (times.filter(F.col(time_col).isNotNull())
         .groupBy(*keys, F.col(time_col).alias("at")).agg(F.coalesce((F.max(interval_col).cast("double") * 1_000_000).cast("long"), F.lit(0)).alias("iv"))
         .withColumn("k", F.to_json(F.struct(*keys))))
    t = W.indexed(cut_lineage(t), ["k"], "at", "n")
    t = cut_lineage(t.select(*keys, "k", F.unix_micros("at").alias("t"), "iv", F.floor(F.col("n") / block_rows).cast("long").alias(BLOCK)))
    ends = t.groupBy("k").agg(F.min("t").alias("a"), F.max("t").alias("last"), *[F.first(c).alias(c) for c in keys])
    ends = cut_lineage(ends)                                    # one row a key
    first = ends.select("k", "a")

    def exits(pdf):
        return pd.concat([pdf[["k"]].iloc[:1].merge(_exits(pdf), how="cross")])

    def expand(pdf, own):
        at = _expand(pdf, int(own["a"].iloc[0])) if len(pdf) and len(own) else np.zeros(0, np.int64)
        return pdf[["k"]].iloc[:1].merge(pd.DataFrame({"t": at}), how="cross") if len(at) else pd.DataFrame(columns=["k", "t"])

    # thresholds that some later time of the key exceeds; the others end a schedule
    out = t.groupBy("k", BLOCK).applyInPandas(exits, "k string, t long, leave long").join(ends.select("k", "last"), "k")
    out = cut_lineage(out.filter("leave < last").select("k", F.col("t").alias("a"), "leave"))
    path = first
    if not out.isEmpty():
        # the first time after a threshold is the latest before it on the reversed axis
        back = lambda c: F.timestamp_micros(-F.col(c))          # noqa: E731
        after = asof_lookup(out.select("k", "leave", back("leave").alias("at")).distinct(),
                            {"next": t.select("k", back("t").alias("rt"), "t", F.lit(0).alias("o"))}, ["k"], "at", "rt", "o", strict=True)
        hops = out.join(after.select("k", "leave", F.col("next.t").alias("b")), ["k", "leave"]).select("k", "a", "b")
        hops = cut_lineage(hops)
        entered = first.unionByName(hops.select("k", F.col("b").alias("a"))).distinct()
        path = _reached(first, cut_lineage(hops.join(entered, ["k", "a"], "left_semi")))
    entry = path.join(t.select(F.col("k").alias("ek"), F.col("t").alias("et"), F.col(BLOCK).alias("eb")),
                      (F.col("k") == F.col("ek")) & (F.col("a") == F.col("et"))).select("ek", "eb", F.col("et").alias("a"))
    chain = t.groupBy("k", BLOCK).cogroup(entry.groupBy("ek", "eb")).applyInPandas(expand, "k string, t long")
    chain = cut_lineage(chain.select("k", F.timestamp_micros("t").alias("reset_time")))
    return (W.indexed(chain, ["k"], "reset_time", "reset_no").filter(F.col("reset_no") > 0)
             .join(ends.select("k", *keys), "k").select(*keys, "reset_time", "reset_no"))
