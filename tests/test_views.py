"""Temp views, parameterised SQL, config joins, feature dataset and compaction."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from marketframe.operators import bars as B
from marketframe.plans import views as V
from marketframe.plans import reports as R
from marketframe.sources import fixtures as X
from marketframe.sources import sinks as SK


def test_views_and_parameterised_sql(spark):
    t = X.ticks(spark, SF001)
    V.register_views(spark, t)
    cur = V.ticker_report(spark, V.CURRENT_PRICE_SQL, symbol="view").first()
    want = R.current_price(B.ohlcv(t), ["view"]).first()
    assert (cur.minute, cur.open) == (want.minute, want.open)
    rng = V.ticker_report(spark, V.PRICE_RANGE_SQL, symbol="view", frm="2024-01-01 00:00:00", to="2024-01-10 00:00:00")
    assert rng.count() == B.ohlcv(t).filter("symbol = 'view' AND minute <= '2024-01-10'").count()
    n = V.ticker_report(spark, V.NOTIONAL_SQL, symbol="view", frm="2024-01-01", to="2024-02-01").first()[0]
    want_n = R.notional_volume(B.ohlcv(t), symbols=["view"]).first().total_vol_usd
    assert abs(n - want_n) < 1e-6 * max(1.0, abs(want_n))
    # a hostile parameter stays a value
    assert V.ticker_report(spark, V.CURRENT_PRICE_SQL, symbol="x' OR '1'='1").first().open is None


def test_every_model_strategy_finds_its_run(spark):
    j = {r.strategy_name: r.s3_key for r in V.strategy_models(X.strategies(spark), X.model_runs(spark, SF001)).collect()}
    assert len(j) == 6 and j.pop("Long Only") is None
    assert all(v is not None for v in j.values()) and j["SVM"] == "models/SVM-(RBF-Kernel)-ETH-model.pkl"


def test_feature_dataset_and_compaction(spark, tmpdir_path):
    from marketframe.plans import q_features as QF
    lab = QF.labelled(spark, SF001)
    path = os.path.join(tmpdir_path, "features")
    SK.write_feature_dataset(lab, path)
    back = SK.read_feature_dataset(spark, path, ["minute", "rsi_14", "label"], symbols=["view"])
    assert back.count() == lab.filter("symbol = 'view'").count()
    t = X.ticks(spark, SF001)
    part = os.path.join(tmpdir_path, "partials")
    for i in range(3):
        B.partial_bars(t.filter(F.col("seq") % 3 == i)).write.mode("append").parquet(part)
    out = os.path.join(tmpdir_path, "compacted")
    SK.compact_partials(spark, part, out)
    c = spark.read.parquet(out).drop("dt")
    assert c.count() == B.partial_bars(t).count()
    assert B.finalize(c, merge=False).exceptAll(B.ohlcv(t).select(*B.finalize(c, merge=False).columns)).count() == 0
