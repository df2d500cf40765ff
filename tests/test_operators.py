"""Bars, blocked scans, as-of joins, signals, ledger, messages, diagnostics, metrics and sinks."""

import dataclasses
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from conftest import SF001
from marketframe import config as C
from marketframe.operators import bars as B
from marketframe.operators import diagnostics as DG
from marketframe.operators import ledger as LG
from marketframe.operators import metrics as MT
from marketframe.operators import risk as RK
from marketframe.operators import scan
from marketframe.operators import signals as SG
from marketframe.operators.asof import asof_lookup, asof_join, asof_join_offsets, asof_lookup
from marketframe.operators.scan import BLOCK, blocked, blocked_scan, time_bounds, with_blocks
from marketframe.sources import fixtures as X
from marketframe.sources import messages as MS
from marketframe.sources import sinks as SK


# ---------------------------------------------------------------- bars
def test_partials_of_any_split_merge_to_one_shot(spark):
    t = X.ticks(spark, SF001)
    one = B.ohlcv(t)
    for k in (2, 3, 7):
        parts = [B.partial_bars(t.filter(F.col("seq") % k == i)) for i in range(k)]
        u = parts[0]
        for p in parts[1:]:
            u = u.unionByName(p)
        merged = B.finalize(u)
        assert merged.exceptAll(one.select(*merged.columns)).count() == 0
        assert merged.count() == one.count()
        # merging twice (compaction of an already merged table) changes nothing
        again = B.finalize(B.merge_partials(u))
        assert again.exceptAll(merged).count() == 0


def _ticks(spark, rows):
    return spark.createDataFrame(
        [(seq, pd.Timestamp(ts).to_pydatetime(), int(pd.Timestamp(ts).value // 1_000_000), "s", float(p), 1.0)
         for seq, ts, p in rows],
        "seq long, timestamp timestamp, timestamp_ms long, symbol string, price double, volume double")


def test_equal_ms_tie_break_and_heavy_open(spark):
    t = _ticks(spark, [(2, "2024-01-01 00:00:10", 5.0), (1, "2024-01-01 00:00:10", 6.0),
                       (3, "2024-01-01 00:00:20", 7.0), (4, "2024-01-01 00:00:30", 7.0),
                       (5, "2024-01-01 00:00:30", 4.0)])
    heavy = B.ohlcv(t).first()
    first = B.ohlcv(t, open_mode="first").first()
    assert heavy.open == 7.0            # most frequent price
    assert first.open == 6.0            # earliest ms, lowest seq
    assert heavy.close == 4.0           # latest ms, highest seq
    fin = B.finalize(B.partial_bars(t)).first()
    assert (fin.open, fin.close, fin.high, fin.low) == (7.0, 4.0, 7.0, 4.0)


def test_ticks_without_price_count_in_volume_only(spark):
    t = _ticks(spark, [(1, "2024-01-01 00:00:10", 5.0), (2, "2024-01-01 00:00:20", 6.0)])
    none = t.filter("seq = 2").withColumn("price", F.lit(None).cast("double")).withColumn("seq", F.lit(3).cast("long"))
    for got in (B.ohlcv(t.unionByName(none)), B.finalize(B.partial_bars(t).unionByName(B.partial_bars(none)))):
        r = got.first()
        assert (r.open, r.close, r.high, r.low, r.avg, r.volume) == (5.0, 6.0, 6.0, 5.0, 5.5, 3.0)
    only = B.ohlcv(none).first()
    assert (only.open, only.avg, only.volume) == (None, None, 1.0)


# ---------------------------------------------------------------- blocked scan
def _scan_rows(spark, n=3000):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        v = None if rng.random() < 0.1 else float(rng.randint(-5, 5))
        # half of the times fall into one burst of a minute
        second = 100_000 + rng.randint(0, 60) if rng.random() < 0.5 else rng.randint(0, 86400 * 3)
        rows.append((key, None if i % 97 == 0 else (pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=second)).to_pydatetime(), i, v))
    return spark.createDataFrame(rows, "k string, t timestamp, seq long, v double")


@pytest.mark.parametrize("min_rows", [10 ** 9, 300, 1])
def test_blocked_scan_equals_plain_windows_with_hot_key_and_burst(spark, min_rows):
    df = _scan_rows(spark)
    d = blocked(df, ["k"], "t", min_rows)
    biggest = d.groupBy("k", BLOCK).count().agg(F.max("count")).first()[0]
    assert biggest > 1500 if min_rows > 10 ** 6 else biggest < 700
    got = blocked_scan(d, ["k"], ["t", "seq"], sums={"v": "s"}, sums_excl={"v": "se"}, maxes={"v": "m"},
                       maxes_excl={"v": "me"}, lasts={"v": "l"}, prevs={"v": "p"}).drop(BLOCK)
    w = Window.partitionBy("k").orderBy("t", "seq")
    run, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.coalesce(F.sum("v").over(run), F.lit(0.0)).alias("s"),
                     F.coalesce(F.sum("v").over(before), F.lit(0.0)).alias("se"), F.max("v").over(run).alias("m"),
                     F.max("v").over(before).alias("me"), F.last("v", True).over(run).alias("l"),
                     F.lag("v").over(w).alias("p"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_blocks_of_a_key_are_even_and_ordered(spark):
    df = _scan_rows(spark, 6000).filter("t is not null and k = 'hot'")
    d = blocked(df, ["k"], "t", 100)
    per = d.groupBy(BLOCK).agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy(BLOCK).collect()
    assert len(per) >= 16 and all(a.hi < b.lo for a, b in zip(per, per[1:]))
    assert blocked(df.limit(0), ["k"], "t").count() == 0
    assert blocked(df.limit(0), [], "t").count() == 0


@pytest.mark.parametrize("spread", [1, 1_000_000])
def test_no_block_exceeds_twice_the_aim_with_half_of_a_key_in_one_instant_or_second(spark, spread):
    """200,000 rows of one key, half of them in one instant (then split by the tie) or one second: 400 blocks of 500."""
    h = lambda m: F.pmod(F.xxhash64("id"), F.lit(m))
    burst, month = F.lit(5_000_000_000) + h(spread), h(1_000_003) * 2_592_000
    d = spark.range(200_000).select(F.lit("a").alias("k"), F.timestamp_micros(F.when(F.col("id") % 2 == 0, burst).otherwise(month)).alias("t"),
                                    F.col("id").alias("seq"), F.lit(1).alias("one")).cache()
    b = blocked(d, ["k"], "t", tie="seq").cache()
    place = F.struct("t", "seq")
    per = b.groupBy(BLOCK).agg(F.count("*").alias("n"), F.min(place).alias("lo"), F.max(place).alias("hi")).orderBy(BLOCK).collect()
    assert max(r.n for r in per) <= 1000 and len(per) >= 200
    assert all(a.hi < b.lo for a, b in zip(per, per[1:]))
    got = blocked_scan(b, ["k"], ["t", "seq"], sums={"one": "s"}).agg(F.min("s"), F.max("s"), F.count_distinct("s")).first()
    assert tuple(got) == (1, 200_000, 200_000)


@pytest.fixture()
def no_small_tables(spark):
    """Spark takes no table for small, as with large inputs, where it can't tell that a table of cuts is."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _rows_a_task(df, key):
    return [r["count"] for r in df.groupBy(F.spark_partition_id(), key).count().filter(f"{key} = 'hot'").collect()]


def _hot_and_many(spark):
    """20,000 rows of one key, half of them in one instant, 400 rows of one without a name, and 100 keys of 200 rows."""
    n, i = 40_400, F.col("id")
    key = F.when(i < 20_000, F.lit("hot")).when(i >= 40_000, F.lit(None).cast("string")).otherwise(F.concat(F.lit("k"), (i % 100).cast("string")))
    second = F.when((i < 20_000) & (i % 2 == 0), F.lit(5_000)).otherwise(F.pmod(F.xxhash64(i), F.lit(2_592_000)))
    return spark.range(n, numPartitions=8).repartition(8).select(key.alias("k"), F.timestamp_seconds(second).alias("t"), i.alias("seq")).cache()


def test_rows_of_a_hot_key_stay_apart_when_they_meet_their_cuts(spark, no_small_tables):
    d = _hot_and_many(spark).filter("k = 'hot'")
    b = time_bounds(d, ["k"], "t", tie="seq")
    assert b.parts is not None
    per = _rows_a_task(with_blocks(d, b, ["k"], "t", F.col("seq")), "k")
    assert len(per) == 8 and max(per) < 4_000 and sum(per) == 20_000


def test_cuts_of_more_keys_than_are_broadcast_give_the_same_blocks(spark, no_small_tables, monkeypatch):
    d = _hot_and_many(spark)
    b = time_bounds(d, ["k"], "t", min_rows=10, tie="seq")
    sizes = sorted((r["__b_n"] for r in b.cells.collect()), reverse=True)
    assert sizes[:3] == [20_000, 400, 200] and b.light_cells == 0 and b.parts.count() > 3
    want = with_blocks(d, b, ["k"], "t", F.col("seq")).cache()
    monkeypatch.setattr(scan, "BROADCAST_CELLS", 2)
    monkeypatch.setattr(scan, "BROADCAST_PARTS", 3)
    few = time_bounds(d, ["k"], "t", min_rows=10, tie="seq")
    assert few.light_cells == 200 and few.light_parts > 0 and few.parts.filter(F.col("__b_m") > few.light_parts).count() <= 3
    got = with_blocks(d, dataclasses.replace(few, cells=b.cells, parts=b.parts), ["k"], "t", F.col("seq")).cache()
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    per = _rows_a_task(with_blocks(d, dataclasses.replace(few, cells=b.cells, parts=None), ["k"], "t", F.col("seq")), "k")
    assert len(per) >= 4 and max(per) < 10_000
    got = blocked_scan(got.withColumn("one", F.lit(1)), ["k"], ["t", "seq"], sums={"one": "s"}).groupBy("k").agg(F.count_distinct("s").alias("n"), F.max("s").alias("s"))
    assert {r["k"]: r["n"] for r in got.filter("n = s").collect()} == {r["k"]: r["count"] for r in d.groupBy("k").count().collect()}


@pytest.mark.parametrize("strict", [False, True])
def test_asof_inside_a_split_instant(spark, strict):
    """Rights of one instant lie in many blocks: a left row of that time sees the last of them, or with ``strict`` none."""
    at = pd.Timestamp("2024-01-02").to_pydatetime()
    r = spark.range(1, 20_001).select(F.lit("a").alias("sym"), F.lit(at).cast("timestamp").alias("ts"), F.col("id").alias("seq"), F.col("id").cast("double").alias("px"))
    early = spark.createDataFrame([("a", pd.Timestamp("2024-01-01").to_pydatetime(), 0, -1.0)], "sym string, ts timestamp, seq long, px double")
    left = spark.createDataFrame([("a", at, 1), ("a", pd.Timestamp("2024-01-03").to_pydatetime(), 2), ("a", pd.Timestamp("2023-01-03").to_pydatetime(), 3)],
                                 "sym string, t timestamp, id long")
    got = {x.id: x.r and x.r.px for x in asof_lookup(left, {"r": r.unionByName(early)}, ["sym"], "t", "ts", "seq", strict=strict).collect()}
    assert got == {1: -1.0 if strict else 20_000.0, 2: 20_000.0, 3: None}


# ---------------------------------------------------------------- as-of
def test_asof_equals_pandas_merge_asof(spark):
    rng = np.random.default_rng(0)
    n = 500
    right = pd.DataFrame({"sym": rng.choice(["a", "b"], n), "ts": pd.to_datetime(rng.integers(0, 10**6, n), unit="s"),
                          "seq": np.arange(n), "px": rng.normal(100, 1, n)})
    left = pd.DataFrame({"sym": rng.choice(["a", "b"], 200), "t": pd.to_datetime(rng.integers(0, 10**6, 200), unit="s"),
                         "id": np.arange(200)})
    r, l_ = spark.createDataFrame(right), spark.createDataFrame(left)
    for min_rows in (10 ** 9, 7):
        got = asof_join(l_, r, ["sym"], "t", "ts", ["px"], "seq", bounds=time_bounds(r, ["sym"], "ts", min_rows)).toPandas().sort_values("id")
        want = pd.merge_asof(left.sort_values("t"), right.sort_values(["ts", "seq"]), left_on="t", right_on="ts",
                             by="sym", direction="backward").sort_values("id")
        assert np.allclose(got["px"].to_numpy(), want["px"].to_numpy(), equal_nan=True)
    both = asof_join_offsets(l_, r, ["sym"], "t", "ts", ["px"], "seq", "id", {"a_": 0.0, "b_": 3600.0}).toPandas()
    l2 = left.assign(t=left["t"] + pd.Timedelta(hours=1)).sort_values("t")
    want2 = pd.merge_asof(l2, right.sort_values(["ts", "seq"]), left_on="t", right_on="ts", by="sym").sort_values("id")
    both = both.sort_values("id")
    assert np.allclose(both["a_px"].to_numpy(), want["px"].to_numpy(), equal_nan=True)
    assert np.allclose(both["b_px"].to_numpy(), want2["px"].to_numpy(), equal_nan=True)


def test_strict_lookup_does_not_see_its_own_time(spark):
    t = [pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=i) for i in range(3)]
    r = spark.createDataFrame([("a", t[0].to_pydatetime(), 0, 5.0), ("a", t[1].to_pydatetime(), 1, 3.0)], "k string, t timestamp, seq long, v double")
    l_ = spark.createDataFrame([("a", x.to_pydatetime(), i) for i, x in enumerate(t)] + [("b", t[2].to_pydatetime(), 9)], "k string, t timestamp, id int")
    got = {x.id: (x.r["v"] if x.r else None, x.top) for x in
           asof_lookup(l_, {"r": r}, ["k"], "t", "t", "seq", strict=True, maxes={"v": "top"}).collect()}
    assert got == {0: (None, None), 1: (5.0, 5.0), 2: (3.0, 5.0), 9: (None, None)}


# ---------------------------------------------------------------- signals
def loop_streak(signals, max_streak, seqs):
    """The modelled loop, restated (forced HOLD side by the same even-seq rule)."""
    last, streak, out = None, 1, []
    for s, q in zip(signals, seqs):
        streak = streak + 1 if s == last else 1
        last = s
        final = s
        if streak >= max_streak:
            final = {"BUY": "SELL", "SELL": "BUY"}.get(s, "BUY" if q % 2 == 0 else "SELL")
            streak = 1
        out.append((final, streak))
    return out


def _streak_df(spark, sigs, m):
    t0 = pd.Timestamp("2024-01-01")
    rows = [("x", "s", (t0 + pd.Timedelta(seconds=i)).to_pydatetime(), i, s, m) for i, s in enumerate(sigs)]
    df = spark.createDataFrame(rows, "strategy_name string, symbol string, time timestamp, seq long, raw_signal string, "
                                     "max_streak int")
    return SG.apply_streak(SG.run_positions(blocked(df, SG.KEYS, "time", 10), "raw_signal")).orderBy("seq").collect()


@pytest.mark.parametrize("block_rows", [10 ** 6, 7])
def test_reset_schedule_equals_greedy_loop(spark, block_rows):
    rng = random.Random(11)
    t0 = pd.Timestamp("2024-01-01")
    rows, want = [], set()
    for key, n, iv in (("x", 400, 3000), ("y", 150, 200_000), ("z", 1, 50), (None, 60, 0), ("v", 120, None)):
        at = sorted({t0 + pd.Timedelta(milliseconds=rng.randint(0, 500_000_000)) for _ in range(n)})
        each = [rng.choice((500, 40_000)) if iv is None else iv for _ in at]      # an interval of its own for every time
        rows += [(key, "s", t.to_pydatetime(), i) for t, i in zip(at, each)] + [(key, "s", at[0].to_pydatetime(), each[0])]
        last, no, wait = at[0], 0, each[0]
        for t, i in zip(at, each):
            if t > last + pd.Timedelta(seconds=wait):
                last, no, wait = t, no + 1, i
                want.add((key, t.to_pydatetime(), no))
    rows.append(("x", "s", None, 5))
    df = spark.createDataFrame(rows, "strategy_name string, symbol string, time timestamp, reset_interval int")
    got = SG.reset_points(df, SG.KEYS, block_rows=block_rows).collect()
    assert {(r.strategy_name, r.reset_time, r.reset_no) for r in got} == want and len(got) == len(want)


def test_reset_schedule_of_a_million_times_has_bounded_groups(spark, monkeypatch):
    interval, largest = 200_000, []                                               # about 100 blocks long
    us = spark.range(1_000_000).select(F.pmod(F.xxhash64("id"), F.lit(10 ** 12)).alias("us"))
    t = np.unique(us.toPandas()["us"].to_numpy())                                 # microseconds
    cut = SG.cut_lineage

    def watched(df):
        out = cut(df)
        if SG.BLOCK in out.columns:
            largest.append(out.groupBy("k", SG.BLOCK).count().agg(F.max("count")).first()[0])
        return out
    monkeypatch.setattr(SG, "cut_lineage", watched)
    df = us.select(
        F.lit("x").alias("strategy_name"), F.lit("s").alias("symbol"), F.timestamp_micros("us").alias("time"), F.lit(interval).alias("reset_interval"))
    got = SG.reset_points(df, SG.KEYS, block_rows=2000).select(F.unix_micros("reset_time").alias("t"), "reset_no").collect()
    want, i = [], 0
    while (i := int(np.searchsorted(t, t[i] + interval * 1_000_000, side="right"))) < len(t):
        want.append(int(t[i]))
    assert sorted((r.reset_no, r.t) for r in got) == list(enumerate(want, 1))
    assert largest and max(largest) <= 2000


def test_streak_closed_form_equals_loop(spark):
    rng = random.Random(7)
    for m in (2, 3, 5, 8):
        sigs = [rng.choice(["BUY", "SELL", "HOLD"]) if rng.random() < 0.3 else "BUY" for _ in range(120)]
        got = [(r.signal, r.streak) for r in _streak_df(spark, sigs, m)]
        assert got == loop_streak(sigs, m, range(len(sigs))), m


def test_twenty_equal_signals_flip_at_5_9_13_17(spark):
    got = _streak_df(spark, ["BUY"] * 20, 5)
    assert [i + 1 for i, r in enumerate(got) if r.forced] == [5, 9, 13, 17]


def test_size_factor_and_quantity(spark):
    df = spark.createDataFrame([(0.8, 1, 100000.0, 0.5, 10.0, "BUY"), (0.6, 2, 100000.0, 0.5, 10.0, "SELL"),
                                (0.1, 1, 100000.0, 0.5, 10.0, "HOLD")],
                               "confidence double, streak int, portfolio_value double, allocation_pct double, "
                               "model_price double, signal string")
    r = df.withColumn("size_factor", SG.size_factor()).withColumn("q", SG.order_quantity()).collect()
    assert [x.size_factor for x in r] == [1.0, 0.25, 0.25]
    assert [x.q for x in r] == [5000.0, 1250.0, 0.0]


# ---------------------------------------------------------------- ledger
def test_ledger_cash_plus_book_is_starting_cash_and_seeds_stay(spark):
    from marketframe.plans import q_trading as QT
    led = QT.ledger(spark, SF001)
    bad = led.filter(F.abs(F.col("cash_balance") + F.col("market_value") - F.lit(C.STARTING_CASH)) > 1e-6)
    assert bad.count() == 0
    rows = LG.with_seeds(led.filter("strategy_name <> 'SVM'"), X.seed_portfolios(spark), QT.ticks(spark, SF001))
    key = LG.portfolio_key(rows, X.strategies(spark)).collect()
    seeded = [r for r in key if r.strategy_name == "SVM"]
    assert [(r.status, r.quantity, r.portfolio_value) for r in seeded] == [("closed", 0.0, C.STARTING_CASH)]
    assert len(key) == rows.select("strategy_name", "symbol").distinct().count()


def _order(**kw):
    base = {"strategy_name": "LSTM", "signal": "BUY", "quantity": 1.0, "model_price": 10.0, "qty_before": 0.0, "cash_before": 1000.0,
            "portfolio_value": 1000.0, "pv_max": 1000.0, "pv_latest": 1000.0}
    return base | kw


def test_checks_fail_closed_and_pass_on_state(spark):
    cases = [(_order(), "Approved"), (_order(portfolio_value=None), C.ERR_POSITION),
             (_order(cash_before=None), C.ERR_CASH), (_order(signal="SELL", qty_before=None, quantity=-1.0), C.ERR_QUANTITY),
             (_order(pv_latest=None), C.ERR_DRAWDOWN), (_order(pv_max=None, pv_latest=None), "Approved"),
             (_order(quantity=None), f"{C.ERR_POSITION}; {C.ERR_CASH}; {C.ERR_QUANTITY}"),
             (_order(strategy_name=C.LONG_ONLY, portfolio_value=None, pv_latest=None), "Approved"),
             (_order(qty_before=None, cash_before=None, portfolio_value=None, pv_max=None, pv_latest=None), f"{C.ERR_POSITION}; {C.ERR_CASH}"),
             (_order(quantity=80.0), "Trade value 800.00 exceeds max allocation 50.0% of portfolio 1000.00."),
             (_order(pv_latest=400.0), "Max drawdown 60.00% exceeded limit 50%.")]
    cols = list(_order())
    schema = ", ".join(f"{c} {'string' if c in ('strategy_name', 'signal') else 'double'}" for c in cols) + ", id int"
    df = spark.createDataFrame([(*[o[c] for c in cols], i) for i, (o, _) in enumerate(cases)], schema)
    got = {r.id: r for r in RK.risk_checks(df).collect()}
    for i, (_, want) in enumerate(cases):
        assert got[i].approval_comment == want, i
        assert got[i].approval_status == ("Y" if want == "Approved" else "N")


def test_state_comes_from_rows_strictly_before(spark):
    t = [(pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=i)).to_pydatetime() for i in range(6)]
    rows = spark.createDataFrame([("s", "x", t[1], 1, 10.0, 900.0, 100.0, 1000.0), ("s", "x", t[3], 2, 20.0, 800.0, 200.0, 1000.0)],
                                 "strategy_name string, symbol string, time timestamp, seq long, quantity double, cash_balance double, "
                                 "market_value double, portfolio_value double")
    vals = spark.createDataFrame([("s", "x", t[1], 1500.0), ("s", "x", t[2], 700.0)], "strategy_name string, symbol string, time timestamp, portfolio_value double")
    orders = spark.createDataFrame([("s", "x", t[1], 1), ("s", "x", t[3], 2), ("s", "x", t[5], 3), ("s", "y", t[5], 4)],
                                   "strategy_name string, symbol string, time timestamp, id int")
    got = {r.id: (r.qty_before, r.cash_before, r.pv_max, r.pv_latest) for r in RK.portfolio_state(orders, rows, vals).collect()}
    assert got == {1: (None, None, None, None), 2: (10.0, 900.0, 1500.0, 700.0), 3: (20.0, 800.0, 1500.0, 700.0), 4: (None,) * 4}


def test_risk_messages_and_long_only_bypass(spark):
    from marketframe.plans import q_trading as QT
    chk = QT.checked(spark, SF001)
    lo = chk.filter(F.col("strategy_name") == C.LONG_ONLY)
    assert lo.filter(F.col("position_msg").isNotNull() | F.col("drawdown_msg").isNotNull()).count() == 0
    n = chk.filter((F.col("approval_status") == "N") & (F.col("approval_comment") == "Approved")).count()
    assert n == 0
    ex = RK.execution_log(chk)
    assert ex.filter((F.col("approval_status") == "N") & F.col("executed_price").isNotNull()).count() == 0


def test_snapshots_of_a_key_after_the_feed_and_before_any_price(spark):
    t0 = pd.Timestamp("2024-01-01")
    ticks = spark.createDataFrame([(1, (t0 + pd.Timedelta(minutes=12)).to_pydatetime(), "x", 2.0), (2, (t0 + pd.Timedelta(minutes=31)).to_pydatetime(), "x", 3.0)],
                                  "seq long, timestamp timestamp, symbol string, price double")
    at = lambda m: (t0 + pd.Timedelta(minutes=m)).to_pydatetime()
    rows = spark.createDataFrame([(at(1), 0, "s", "x", 100.0, 5.0, 0.0, 0.0), (at(90), 1, "late", "x", 100.0, 5.0, 0.0, 0.0), (at(1), 2, "s", "none", 1.0, 1.0, 0.0, 0.0)],
                                 "time timestamp, seq long, strategy_name string, symbol string, cash_balance double, quantity double, "
                                 "market_value double, portfolio_value double")
    got = sorted((r.time, r.portfolio_value) for r in LG.snapshots(rows, ticks).collect())
    assert got == [(at(m), 110.0) for m in (15, 20, 25, 30)]


# ---------------------------------------------------------------- messages
def test_envelope_filter_and_parse(spark):
    raw = spark.createDataFrame([
        ('{"type":"trade","data":[{"t":1704067200123,"s":"A","p":1.5,"v":2.0},{"t":1704067200999,"s":"B","p":3,"v":1}]}',),
        ('{"type":"ping"}',), ('garbage',)], "value string").withColumn("received_at", F.current_timestamp())
    t = MS.explode_envelopes(raw)
    assert sorted(r.symbol for r in t.collect()) == ["A", "B"]
    back = MS.valid(MS.parse_tick_messages(MS.tick_message_json(t)))
    assert back.count() == 2
    assert back.filter(F.col("timestamp_ms") == 1704067200123).first().timestamp.microsecond == 123000


# ---------------------------------------------------------------- diagnostics
def test_heartbeat_keeps_empty_windows(spark):
    t = X.ticks(spark, SF001).filter(F.col("insert_time") < F.lit("2024-01-02").cast("timestamp"))
    hb = DG.heartbeat(t, 60, start="2024-01-01 00:00:00", end="2024-01-02 00:00:00")
    assert hb.count() == 24 * 60 + 1
    empty = hb.filter(F.col("message_count") == 0)
    assert empty.filter(F.col("avg_websocket_lag").isNotNull() | F.col("avg_timestamp").isNotNull()).count() == 0
    assert hb.agg(F.sum("message_count")).first()[0] == t.count()
    none = t.limit(0)
    assert DG.heartbeat(none).count() == 0
    assert DG.heartbeat(none, 60, start="2024-01-01 00:00:00", end="2024-01-01 00:10:00").count() == 11


def test_heartbeat_means_are_exact_for_two_million_ticks(spark):
    base = "timestamp_micros(1704067200500000 + id * 7 % 59000000"
    t = spark.range(2_000_000).selectExpr(f"{base}) AS timestamp", f"{base} + 3) AS received_at", f"{base} + 3 + 11) AS insert_time")
    r = DG.heartbeat(t, 60).first()
    want = sum(i * 7 % 59_000_000 for i in range(2_000_000)) // 2_000_000
    assert r.message_count == 2_000_000
    assert round(r.avg_timestamp.timestamp() * 1e6) == 1_704_067_200_500_000 + want
    assert r.avg_websocket_lag == pytest.approx(3e-6) and r.avg_processing_lag == pytest.approx(11e-6)


def test_feed_gaps_per_symbol_and_global(spark):
    t = X.ticks(spark, SF001)
    pdf = t.select("timestamp").toPandas().sort_values("timestamp")
    expect = (pdf["timestamp"].diff().dt.total_seconds() > 90).sum()
    for min_rows in (10 ** 9, 50):
        assert DG.feed_gaps(t, 90, min_rows=min_rows).count() == expect
    assert DG.feed_gaps(t, 90, keys=["symbol"]).count() > 0


# ---------------------------------------------------------------- metrics
def test_counter_reset_handling_and_sliding_ranges(spark):
    t0 = pd.Timestamp("2024-01-01")
    vals = [1, 5, 9, 2, 6]   # reset after 9
    df = spark.createDataFrame([((t0 + pd.Timedelta(seconds=10 * i)).to_pydatetime(), "c", float(v), "x")
                                for i, v in enumerate(vals)], "ts timestamp, metric string, value double, series string")
    deltas = MT.counter_deltas(df, ["series"], ["ts"])
    assert [r.delta for r in deltas.orderBy("ts").collect()] == [None, 4.0, 4.0, 2.0, 4.0]
    inc = MT.increase(deltas, ["series"], 60, 60).first()
    assert inc.increase == 14.0
    got = {int((r.t - t0.to_pydatetime()).total_seconds()): r.increase for r in MT.increase(deltas, ["series"], 30, 10).collect()}
    assert got == {10: 4.0, 20: 8.0, 30: 10.0, 40: 10.0, 50: 6.0, 60: 4.0}
    rate = MT.rate(deltas, ["series"], 20, 10)
    last = {int((r.t - t0.to_pydatetime()).total_seconds()): r.x for r in MT.last_over_time(rate, ["series"], "rate", 30, 10, "x").collect()}
    assert last[50] == 0.2 and last[70] == 0.2 and 80 not in last
    avg = {r.t: (r.a, r.s) for r in MT.by_label(rate, [], "rate", {"a": "avg", "s": "sum"}).collect()}
    assert all(a == s for a, s in avg.values())
    with pytest.raises(ValueError):
        MT.increase(deltas, ["series"], 50, 20)


# ---------------------------------------------------------------- sinks
def test_archive_union_hot_is_original(spark, tmpdir_path):
    bars = B.ohlcv(X.ticks(spark, SF001))
    hot, arc = os.path.join(tmpdir_path, "hot"), os.path.join(tmpdir_path, "archive")
    SK.write_table(bars, hot, ts_col="minute", order=["symbol", "minute"])
    SK.archive(spark, hot, arc, "minute", "2024-01-20 12:00:00")
    h, a = spark.read.parquet(hot).drop("dt"), spark.read.parquet(arc).drop("dt")
    assert h.filter(F.col("minute") < F.lit("2024-01-20 12:00:00").cast("timestamp")).count() == 0
    assert a.filter(F.col("minute") >= F.lit("2024-01-20 12:00:00").cast("timestamp")).count() == 0
    u = h.unionByName(a)
    assert u.count() == bars.count() and u.exceptAll(bars.select(*u.columns)).count() == 0
    SK.archive(spark, hot, arc, "minute", "2024-01-20 12:00:00")   # rerun: nothing moves twice
    assert spark.read.parquet(arc).count() == a.count()


def test_archive_stopped_half_way_and_run_again(spark, tmpdir_path, monkeypatch):
    bars = B.ohlcv(X.ticks(spark, SF001))
    hot, arc = os.path.join(tmpdir_path, "hot"), os.path.join(tmpdir_path, "archive")
    SK.write_table(bars, hot, ts_col="minute", order=["symbol", "minute"])
    with monkeypatch.context() as m:
        m.setattr(SK, "scratch_path", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            SK.archive(spark, hot, arc, "minute", "2024-01-10 12:00:00")      # after the append
    SK.archive(spark, hot, arc, "minute", "2024-01-20 12:00:00")              # another cutoff on the next try
    u = spark.read.parquet(hot).drop("dt").unionByName(spark.read.parquet(arc).drop("dt"))
    assert u.count() == bars.count() and u.exceptAll(bars.select(*u.columns)).count() == 0


def test_retention_and_table_size(spark, tmpdir_path):
    t = X.ticks(spark, SF001)
    kept = SK.retention_filter(t, "timestamp", "2024-01-31 00:00:00", 9)
    assert kept.agg(F.min("timestamp")).first()[0] >= pd.Timestamp("2024-01-21 23:59:59").to_pydatetime()
    path = X.table_path(SF001, "events")
    assert SK.table_size_mb(spark, path, "events").first().size_mb == pytest.approx(os.path.getsize(path) / 2 ** 20, abs=0.005)
    out = os.path.join(tmpdir_path, "export")
    SK.export_parquet(t.coalesce(1), out, rows_per_file=400)
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) == -(-t.count() // 400)
    SK.truncate(spark, os.path.join(tmpdir_path, "t"), t.schema)
    assert spark.read.parquet(os.path.join(tmpdir_path, "t")).count() == 0


def test_trading_chain_is_the_same_for_any_blocks(spark):
    """One block, some and many give the same ledger, streaks and gaps."""
    from marketframe.plans import q_trading as QT
    r = lambda d: d.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])  # noqa
    filled, t = QT.fills(spark, SF001), X.ticks(spark, SF001).select("symbol", "timestamp")
    rec = X.recorded_executions(filled)
    raw = filled.withColumnRenamed("signal", "raw_signal").select("seq", "strategy_name", "symbol", "time", "raw_signal")
    out = []
    for min_rows in (10 ** 9, 30, 1):
        bounds = time_bounds(t, ["symbol"], "timestamp", min_rows)
        led = r(LG.ledger(rec, bounds)).cache()
        runs = SG.run_positions(with_blocks(raw, bounds, ["symbol"], "time"), "raw_signal").select("seq", "run_pos").cache()
        out.append((led, runs))
    for led, runs in out[1:]:
        assert led.exceptAll(out[0][0]).count() == 0 and led.count() == out[0][0].count()
        assert runs.exceptAll(out[0][1]).count() == 0
