"""The bar-state store, the archive's reads, quantiles under ties, states of a few orders, gaps from shards."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from marketframe.operators import bars as B
from marketframe.operators import diagnostics as DG
from marketframe.operators import risk as RK
from marketframe.operators import windows as W
from marketframe.sources import fixtures as X
from marketframe.sources import sinks as SK
from marketframe.sources.bar_store import BarStore
from marketframe.streaming import stateful as ST

COLS = ["seq", "timestamp", "timestamp_ms", "symbol", "price", "volume"]


def same(a, b):
    r = lambda d: d.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in sorted(d.dtypes)])
    return r(a).exceptAll(r(b)).count() == 0 and a.count() == b.count()


def test_store_appends_compacts_and_reads_a_range(spark, tmpdir_path):
    t = X.ticks(spark, SF001).select(*COLS).cache()
    store = BarStore(spark, os.path.join(tmpdir_path, "bars"))
    assert store.bars().count() == 0 and store.version() == 0 and store.compact() == []
    parts = [t.filter(F.col("seq") % 3 == k) for k in range(3)]
    assert store.append(parts[0], "a") and store.append(parts[1], "b") and not store.append(parts[0], "a")
    before = store.version()
    old = store.states()                                           # a reader of the version before
    days = store.compact()
    assert len(days) > 20 and store.version() == before + 1 and all(sum(d == e for _, e in store.live()) == 1 for d in days)
    assert not store.append(parts[0], "a")                         # also after its states were compacted
    assert same(B.finalize(old), store.bars())
    # a further batch touches one day: only that day is compacted again
    day = t.agg(F.min(F.to_date("timestamp"))).first()[0]
    store.append(parts[2].filter(F.to_date("timestamp") == F.lit(day)), "c1")
    assert store.compact() == [int(day.strftime("%Y%m%d"))]
    store.append(parts[2].filter(F.to_date("timestamp") != F.lit(day)), "c2")
    assert same(store.bars(), B.ohlcv(t))
    assert store.vacuum() > 0 and store.vacuum() == 0
    assert same(store.bars(), B.ohlcv(t)) and same(store.bars(open_mode="first"), B.ohlcv(t, open_mode="first"))
    lo, hi = "2024-01-05 10:00:00", "2024-01-07 12:00:00"
    part = store.bars(lo, hi)
    assert same(part, B.ohlcv(t).filter((F.col("minute") >= lo) & (F.col("minute") <= hi)))
    files = {f.split("day=")[1][:8] for f in part.inputFiles()}
    assert files <= {"20240105", "20240106", "20240107"}


def test_two_writers_cannot_take_one_version(spark, tmpdir_path):
    store = BarStore(spark, os.path.join(tmpdir_path, "bars"))
    store.append(X.ticks(spark, SF001).select(*COLS).limit(20), "a")
    at, parts = store.version(), store.live()
    store._commit(parts, at)
    with pytest.raises(Exception, match="[Ee]xist"):
        store._commit(parts, at)
    assert store.version() == at + 1 and store.live() == parts


def test_archive_compares_only_the_days_at_hand(spark, tmpdir_path, monkeypatch):
    hot, arc = os.path.join(tmpdir_path, "hot"), os.path.join(tmpdir_path, "archive")
    rows = B.ohlcv(X.ticks(spark, SF001))
    SK.write_table(rows, hot, ts_col="minute")
    SK.archive(spark, hot, arc, "minute", "2024-01-20 12:00:00")
    plans = []
    cut = SK.cut_lineage
    monkeypatch.setattr(SK, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    SK.archive(spark, hot, arc, "minute", "2024-01-21 12:00:00")
    filters = [x for p in plans for x in p.split("PartitionFilters: [")[1:]]
    assert any("20240120" in f and "20240121" in f and "20240105" not in f for f in (x.split("]")[0] for x in filters))
    both = spark.read.parquet(arc).drop("dt").unionByName(spark.read.parquet(hot).drop("dt"))
    assert same(both.select(*rows.columns), rows)


@pytest.mark.parametrize("equal", [0.0, 0.9, 1.0])
def test_quantiles_under_ties(spark, equal):
    rng = np.random.default_rng(4)
    v = np.where(rng.random(20_000) < equal, 0.25, rng.normal(size=20_000))
    df = spark.createDataFrame(pd.DataFrame({"s": "x", "v": v})).unionByName(spark.createDataFrame([("y", 1.0), ("y", 3.0), ("z", None)], "s string, v double"))
    probs = [0.0, 0.3, 0.5, 0.7, 1.0]
    got = {r.s: r for r in W.quantiles(df, ["s"], "v", probs, [f"q{i}" for i in range(5)]).collect()}
    np.testing.assert_allclose([got["x"][f"q{i}"] for i in range(5)], np.quantile(v, probs), rtol=1e-12)
    np.testing.assert_allclose([got["y"][f"q{i}"] for i in range(5)], np.quantile([1.0, 3.0], probs))
    assert set(got) == {"x", "y"}


def test_state_of_few_equals_the_scan(spark):
    from marketframe.plans import q_trading as QT
    filled = QT.fills(spark, SF001)
    rows = QT.portfolio_rows(spark, SF001, filled).cache()
    snaps = QT.snapshots(spark, SF001, rows).cache()
    few = filled.orderBy(F.xxhash64("seq")).limit(9).cache()
    cols = ["seq", "qty_before", "cash_before", "market_value", "portfolio_value", "pv_max", "pv_latest"]
    few = few.unionByName(few.limit(1).withColumn("seq", F.lit(-5).cast("long")).withColumn("time", F.lit("2000-01-01").cast("timestamp")))
    assert same(RK.state_of_few(few, rows, snaps).select(*cols), RK.portfolio_state(few, rows, snaps).select(*cols))


def test_gaps_from_sessions_of_shards(spark):
    t = X.ticks(spark, SF001).select("timestamp", "seq")
    one = t.withColumn("shard", F.col("seq") % 5)
    sessions = one.groupBy(F.session_window("timestamp", "90 seconds").alias("w"), "shard").agg(
        F.min("timestamp").alias("session_start"), F.max("timestamp").alias("last_tick"))
    assert same(ST.gaps_between(sessions), DG.feed_gaps(t))


def test_scratch_tables_go_when_the_application_ends(tmp_path):
    import subprocess
    import sys
    code = f"""
from marketframe.session import build_session, scratch_path
s = build_session("local[1]", 1, extra={{"spark.checkpoint.dir": "{tmp_path}"}})
p = scratch_path(s, "x"); s.range(3).write.parquet(p); print(s.read.parquet(p).count()); s.stop()
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=120)
    assert out.stdout.strip().endswith("3"), out.stderr[-500:]
    assert not os.path.exists(tmp_path / "tables" / "x")
