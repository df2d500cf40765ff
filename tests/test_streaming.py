"""Streaming forms agree with the batch forms (file source + availableNow as transport)."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from marketframe.operators import bars as B
from marketframe.operators import diagnostics as DG
from marketframe.sources import fixtures as X
from marketframe.sources import messages as MS
from marketframe.streaming import ingest as IN
from marketframe.streaming import stateful as ST


def _write_messages(spark, ticks, path):
    MS.tick_message_json(ticks).coalesce(1).write.mode("overwrite").text(path)


def test_ingest_quarantine_and_exactly_once(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    t = X.ticks(spark, SF001)
    _write_messages(spark, t.filter(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp")), src + "/a")
    bad = ['{"timestamp": "nope", "timestamp_ms": 1, "symbol": "x", "price": 1, "volume": 1, "received_at": "nope"}',
           '{not json', '{"timestamp": "2024-01-01T00:00:00+00:00", "timestamp_ms": 1, "symbol": "x", '
           '"price": "abc", "volume": 1, "received_at": "2024-01-01T00:00:00+00:00"}']
    spark.createDataFrame([(b,) for b in bad], "value string").coalesce(1).write.mode("overwrite").text(src + "/b")
    parsed = IN.parsed_ticks(IN.file_messages(spark, src + "/*"))
    out, quar, ck = (os.path.join(tmpdir_path, d) for d in ("ticks", "quarantine", "ck"))
    for q in IN.start_ingest(parsed, out, quar, ck):
        q.awaitTermination()
    stored = spark.read.parquet(out)
    n_good = t.filter(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp")).count()
    assert stored.count() == n_good
    errs = sorted(r.error for r in spark.read.parquet(quar).collect())
    assert errs == ["bad price", "bad timestamp", "malformed json"]
    # restart from the checkpoint with a new file: only the new rows are added
    _write_messages(spark, t.filter(F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp")), src + "/c")
    for q in IN.start_ingest(IN.parsed_ticks(IN.file_messages(spark, src + "/*")), out, quar, ck):
        q.awaitTermination()
    assert spark.read.parquet(out).count() == t.count()
    assert spark.read.parquet(quar).count() == 3


def test_stream_bars_equal_batch_for_closed_windows(spark, tmpdir_path):
    t = X.ticks(spark, SF001)
    path = os.path.join(tmpdir_path, "ticks")
    t.write.parquet(path)
    stream = spark.readStream.schema(t.schema).parquet(path)
    q = (ST.bars_watermarked(stream, "2 minutes").writeStream.format("memory").queryName("sbars")
         .outputMode("append").option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("sbars")
    batch = B.ohlcv(t)
    last = batch.agg(F.max("minute")).first()[0]
    closed = batch.filter(F.col("minute") < F.lit(last))
    assert got.count() >= closed.count() - 1
    diff = closed.select(*got.columns).exceptAll(got)
    assert diff.count() == 0


def test_partial_append_merges_late_ticks(spark, tmpdir_path):
    t = X.ticks(spark, SF001)
    part = os.path.join(tmpdir_path, "partials")
    write = ST.bars_partial_append(part, "run1")
    early = t.filter(F.col("seq") % 3 != 0)
    late = t.filter(F.col("seq") % 3 == 0)   # a later micro-batch carrying old ticks
    write(early, 0)
    write(late, 1)
    # another checkpoint counts its batches from 0 again: its states add to the stored ones
    more = t.limit(50)
    ST.bars_partial_append(part, "run2")(more.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 400 DAYS")), 0)
    stored = spark.read.parquet(part).drop("run_id", "batch_id")
    assert B.finalize(stored.filter("minute > '2025-01-01'")).agg(F.sum("volume")).first()[0] == more.agg(F.sum("volume")).first()[0]
    merged = B.finalize(stored.filter("minute < '2025-01-01'"))
    assert merged.exceptAll(B.ohlcv(t).select(*merged.columns)).count() == 0
    assert merged.count() == B.ohlcv(t).count()


def test_latest_prices_stream(spark, tmpdir_path):
    t = X.ticks(spark, SF001)
    path = os.path.join(tmpdir_path, "ticks")
    t.write.parquet(path)
    q = (ST.latest_prices(spark.readStream.schema(t.schema).parquet(path)).writeStream.format("memory")
         .queryName("latest").outputMode("complete").trigger(availableNow=True).start())
    q.awaitTermination()
    from marketframe.operators.asof import latest_per_symbol
    assert spark.table("latest").exceptAll(latest_per_symbol(t)).count() == 0


def test_portfolio_state_matches_batch_ledger(spark, tmpdir_path):
    from marketframe.operators import ledger as LG
    from marketframe.plans import q_trading as QT
    ex = X.recorded_executions(QT.fills(spark, SF001))
    path = os.path.join(tmpdir_path, "exec")
    ex.write.parquet(path)
    stream = spark.readStream.schema(ex.schema).parquet(path)
    chunk = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(chunk)
    spark.conf.set(chunk, "10")            # a key's rows come in many chunks
    q = (ST.portfolio_positions(stream).writeStream.format("memory").queryName("positions").outputMode("update")
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    spark.conf.set(chunk, before)
    got = spark.table("positions")
    batch = LG.ledger(ex, X.tick_bounds(spark, SF001)).select(*got.columns)
    r = lambda d: d.select(*[F.round(c, 6).alias(c) if c in ("quantity", "cash_balance", "market_value") else c  # noqa
                             for c in d.columns])
    assert r(got).exceptAll(r(batch)).count() == 0
    assert got.count() == batch.count()


def test_heartbeat_stream_equals_batch_also_on_the_boundary(spark, tmpdir_path):
    t = X.ticks(spark, SF001).select("timestamp", "received_at", "insert_time")
    edge = spark.createDataFrame([(x,) for x in ("2024-01-03 00:01:00", "2024-01-03 00:01:00.001", "2024-01-03 00:02:00")], "s string")
    edge = edge.select(*[F.col("s").cast("timestamp").alias(c) for c in t.columns])
    t = t.unionByName(edge)
    path = os.path.join(tmpdir_path, "ticks")
    t.write.parquet(path)
    q = (ST.heartbeat_stream(spark.readStream.schema(t.schema).parquet(path)).writeStream.format("memory").queryName("hb")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got, batch = spark.table("hb"), DG.heartbeat(t, keep_empty=False)
    assert got.count() >= batch.count() - 2
    assert got.exceptAll(batch).count() == 0


def test_feed_sessions_stream(spark, tmpdir_path):
    t = X.ticks(spark, SF001)
    path = os.path.join(tmpdir_path, "ticks")
    t.write.parquet(path)
    q = (ST.feed_sessions(spark.readStream.schema(t.schema).parquet(path)).writeStream.format("memory").queryName("sess")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("sess").count() > 0


def test_snapshot_writer_marks_every_key_without_ticks(spark, tmpdir_path):
    from marketframe.operators.asof import latest_per_symbol
    from marketframe.plans import q_trading as QT
    key, px = QT.portfolio_key(spark, SF001), latest_per_symbol(X.ticks(spark, SF001))
    kp, pp, out = (os.path.join(tmpdir_path, d) for d in ("keys", "prices", "snaps"))
    key.write.parquet(kp)
    px.write.parquet(pp)
    write = ST.snapshot_writer(kp, pp, out, "run1")
    for k in range(2):
        write(spark.range(0), k)           # the clock's batch holds no ticks
    snaps = spark.read.parquet(out)
    assert snaps.count() == 2 * key.count()
    ST.snapshot_writer(kp, pp, out, "run2")(spark.range(0), 0)       # a new checkpoint replaces nothing
    assert spark.read.parquet(out).count() == 3 * key.count()
    bad = snaps.filter(F.abs(F.col("portfolio_value") - F.col("cash_balance") - F.col("market_value")) > 1e-6)
    assert bad.count() == 0
