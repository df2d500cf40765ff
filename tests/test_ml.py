"""Training, persistence and scoring of the MLlib classifiers on the labelled feature table."""

import os

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SF01
from marketframe.operators import evaluation as EV
from marketframe.operators import ml as ML
from marketframe.operators import trees as T
from marketframe.plans import q_features as QF


def _labelled(spark):
    return QF.labelled(spark, SF01).filter(F.col("symbol") == "view").cache()


def test_logistic_regression_fit_save_load_score(spark, tmpdir_path):
    lab = _labelled(spark)
    model, data = ML.train(lab, "logistic_regression", max_iter=50)
    assert model is not None
    m = ML.evaluate(model, data)
    assert all(0.0 <= v <= 1.0 for v in m.values())
    # evaluator and the grouped-aggregate metrics agree
    test = model.transform(data.filter(F.col("split") == "test")).withColumn("prediction", F.col("prediction").cast("int"))
    g = EV.weighted_metrics(test).first()
    assert abs(g["accuracy"] - m["test_accuracy"]) < 1e-9
    assert abs(g["recall"] - m["recall"]) < 1e-9
    assert abs(g["precision"] - m["precision"]) < 1e-9
    path = os.path.join(tmpdir_path, "lr")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = ML.probabilities(model.transform(data)).select("pred_class", "confidence")
    b = ML.probabilities(back.transform(data)).select("pred_class", "confidence")
    assert a.exceptAll(b).count() == 0
    scored = ML.probabilities(model.transform(data))
    assert set(r.pred_class for r in scored.select("pred_class").distinct().collect()) <= {0, 1, 2}
    run = ML.run_record(spark, "Logistic-Regression", "linear", "models/x", 4, m)
    assert run.count() == 1 and run.first()["model_name"] == "Logistic-Regression"
    log = os.path.join(tmpdir_path, "model_runs")
    for _ in range(2):
        ML.append_run(run, log)
    assert spark.read.parquet(log).count() == 2


def test_forest_svm_and_mlp(spark, tmpdir_path):
    lab = _labelled(spark)
    for kind, kw in [("random_forest", {"num_trees": 5, "max_depth": 6}), ("svm_rbf", {"max_iter": 20, "rff_components": 16}),
                     ("mlp", {"max_iter": 20})]:
        model, data = ML.train(lab, kind, **kw)
        m = ML.evaluate(model, data)
        assert 0.0 <= m["test_accuracy"] <= 1.0, kind


def test_softmax_boosting_lowers_the_loss_each_round_and_comes_back_from_its_table(spark, tmpdir_path):
    gbt, data = ML.train(_labelled(spark), "gbt", max_iter=4)
    train = data.filter(F.col("split") == "train").cache()
    hit = F.get("probability_array", F.col("label").cast("int"))
    losses = [gbt.transform(train, k).agg(F.avg(-F.log(hit))).first()[0] for k in range(5)]
    assert all(b < a for a, b in zip(losses, losses[1:])), losses
    # before the first round the probabilities are the (smoothed) class shares
    n = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    assert losses[0] == pytest.approx(-sum(n.get(c, 0) * gbt.start[c] for c in ML.CLASSES) / sum(n.values()))
    scored = ML.probabilities(gbt.transform(data))
    assert scored.filter(F.abs(F.aggregate("probability_array", F.lit(0.0), lambda a, x: a + x) - 1.0) > 1e-9).count() == 0
    gbt.save(os.path.join(tmpdir_path, "gbt"))
    back = ML.SoftmaxBoosting.load(os.path.join(tmpdir_path, "gbt"), gbt.features)
    assert back.rounds == gbt.rounds and back.start == gbt.start
    assert back.transform(data).select("prediction").exceptAll(gbt.transform(data).select("prediction")).count() == 0



def test_min_rows_gate(spark):
    lab = _labelled(spark)
    model, data = ML.train(lab, "logistic_regression", min_rows=10 ** 9)
    assert model is None and data is None


def test_gate_is_per_series(spark):
    lab = QF.labelled(spark, SF01).filter("symbol in ('view', 'click')")
    small = lab.filter("symbol = 'click'").limit(50).unionByName(lab.filter("symbol = 'view'"))
    model, data = ML.train(small, "logistic_regression", min_rows=100, max_iter=5)
    assert [r.symbol for r in data.select("symbol").distinct().collect()] == ["view"]


def test_newest_cap(spark):
    lab = _labelled(spark)
    d = ML.training_frame(lab, newest=100)
    assert d.count() == 100
    assert d.filter("split = 'test'").count() == 20


def test_registered_forest_has_the_documented_size(spark, monkeypatch):
    asked = {}

    def train(labelled, kind, *, min_rows, **kw):
        asked.update(kind=kind, **kw)
        return None, None
    monkeypatch.setattr(ML, "train", train)
    assert QF._scored(spark, SF01) == (None, None)
    forest = ML.BatchedForest(["x"], "nowhere")
    assert asked == {"kind": "random_forest"} and sum(forest.sizes) == 50 and forest.max_depth == 10


def test_forest_in_batches_is_the_mean_of_its_trees(spark, tmpdir_path):
    from pyspark.ml.classification import RandomForestClassificationModel
    model, data = ML.train(_labelled(spark), "random_forest", num_trees=5, max_depth=4, batch=2, path=os.path.join(tmpdir_path, "forest"))
    assert model.sizes == [2, 2, 1]
    scored = model.transform(data).limit(50).collect()
    parts = [RandomForestClassificationModel.load(model._folder(k)) for k in range(3)]
    assert [p.getNumTrees for p in parts] == [2, 2, 1] and all(t.depth <= 4 for p in parts for t in p.trees)
    scaler = PipelineModel.load(os.path.join(model.path, "scaler"))
    for r in scaler.transform(spark.createDataFrame(scored[:10])).collect():
        each = [list(p.predictProbability(r["features"])) for p in parts]
        want = [sum(n * e[c] for n, e in zip(model.sizes, each)) / 5 for c in range(3)]
        assert all(abs(a - b) < 1e-9 for a, b in zip(want, r["probability_array"]))
    # saved, logged, loaded
    back, log = ML.stored_and_logged(model, data, "Random-Forest", os.path.join(tmpdir_path, "kept"))
    assert log.count() == 1 and log.first()["model_name"] == "Random-Forest" and back.path != model.path and back.sizes == [2, 2, 1]


def test_registered_boosting_has_the_modelled_rounds(spark, monkeypatch):
    asked = {}

    def boost(features, **kw):
        asked.update(kw)
        raise InterruptedError
    monkeypatch.setattr(ML, "SoftmaxBoosting", type("Asked", (ML.SoftmaxBoosting,), {"__init__": lambda self, f, **kw: boost(f, **kw)}))
    monkeypatch.setattr(QF, "labelled", lambda s, d: _boosting_rows(s, 300).selectExpr(
        "*", "'a' AS symbol", "timestamp_seconds(id * 60) AS minute", "x AS returns", "y AS rsi_14"))
    with pytest.raises(InterruptedError):
        QF.boosted_model_audit_q(spark, SF01)
    assert ML.SoftmaxBoosting.__mro__[1](["x"], **asked).max_iter == 100


def _boosting_rows(spark, n, seed=7):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(0, 12, n) / 4.0, rng.integers(-9, 9, n) * 1.5
    label = np.where(x + rng.normal(0, 0.5, n) > 1.7, 2, np.where(y + rng.normal(0, 3, n) > 0, 1, 0))
    return spark.createDataFrame([(i, float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(x, y, label))], "id long, x double, y double, label int")


def test_boosting_grows_the_trees_of_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor
    rows = _boosting_rows(spark, 1500).cache()
    names = ["x", "y"]
    gbt = ML.SoftmaxBoosting(names, max_iter=3).fit(rows)

    def nodes(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return node.prediction()
        return [names[node.split().featureIndex()], node.split().threshold(), nodes(node.leftChild()), nodes(node.rightChild())]

    def flat(tree):
        return [tree] if not isinstance(tree, list) else [*tree[:2], *flat(tree[2]), *flat(tree[3])]
    for k in range(3):
        scored = VectorAssembler(inputCols=names, outputCol="features").transform(gbt.transform(rows, k))
        for c in ML.CLASSES:
            p = F.col("probability_array")[c]
            h = F.greatest(p * (1.0 - p), F.lit(1e-4))
            aim = scored.select("features", h.alias("h"), (((F.col("label") == c).cast("double") - p) / h).alias("aim"))
            want = nodes(DecisionTreeRegressor(labelCol="aim", weightCol="h", maxDepth=3).fit(aim)._java_obj.rootNode())
            assert flat(gbt.rounds[k][c]) == pytest.approx(flat(want)), (k, c)


def test_boosting_of_100_rounds_lowers_the_loss_to_the_end(spark, tmpdir_path):
    rows = _boosting_rows(spark, 600).cache()
    gbt = ML.SoftmaxBoosting(["x", "y"]).fit(rows)
    assert len(gbt.rounds) == 100 and all(len(r) == 3 for r in gbt.rounds)
    hit = F.get("probability_array", F.col("label"))
    losses = [gbt.transform(rows, k).agg(F.avg(-F.log(hit))).first()[0] for k in (0, 10, 40, 70, 99, 100)]
    assert all(b < a for a, b in zip(losses, losses[1:])), losses
    gbt.save(os.path.join(tmpdir_path, "gbt"))
    assert spark.read.parquet(os.path.join(tmpdir_path, "gbt")).count() == 303
    back = ML.SoftmaxBoosting.load(os.path.join(tmpdir_path, "gbt"), gbt.features)
    assert back.transform(rows).exceptAll(gbt.transform(rows)).count() == 0


def test_boosting_does_not_depend_on_when_scores_are_written(spark):
    rows = _boosting_rows(spark, 400).cache()
    a, b = (ML.SoftmaxBoosting(["x", "y"], max_iter=5, keep=k).fit(rows.repartition(p)) for k, p in ((1, 3), (9, 1)))
    score = [[r["probability_array"] for r in m.transform(rows).orderBy("id").collect()] for m in (a, b)]
    assert np.allclose(*score)


def test_boosting_of_one_class_flat_features_and_few_rows(spark):
    flat = spark.createDataFrame([(1.0, float("inf"), 2)] * 4, "x double, y double, label int")
    gbt = ML.SoftmaxBoosting(["x", "y"], max_iter=2).fit(flat)
    assert all(not isinstance(t, list) for trees in gbt.rounds for t in trees)
    assert all(r["prediction"] == 2.0 for r in gbt.transform(flat).collect())
    with pytest.raises(Exception, match="must not be null"):
        ML.SoftmaxBoosting(["x"], max_iter=1).fit(spark.createDataFrame([(None, 1), (2.0, 0)], "x double, label int"))


def test_thresholds_lie_between_values():
    assert T.cut_points(np.array([1.0, 2.0, 4.0]), np.array([5, 1, 1]), 32) == [1.5, 3.0]
    assert T.cut_points(np.array([3.0]), np.array([5]), 32) == []
    tight = np.array([1.0, np.nextafter(1.0, 2.0)])
    assert T.cut_points(tight, np.array([1, 1]), 32) == [1.0]
    many = T.cut_points(np.arange(1000.0), np.ones(1000, int), 8)
    assert many == pytest.approx([125 * k - 0.5 for k in range(1, 8)], abs=1)
    heavy = T.cut_points(np.arange(100.0), np.array([1] * 50 + [10 ** 6] + [1] * 49), 8)
    assert 0 < len(heavy) <= 7 and {49.5, 50.5} & set(heavy)


def test_tasks_of_a_pass_follow_the_rows_not_the_partitions(spark):
    rows = _boosting_rows(spark, 50).repartition(60)
    tasks = ML.SoftmaxBoosting(["x", "y"])._tasks
    assert [tasks(rows, n) for n in (1, 8192, 8193, 10 ** 6, 10 ** 9)] == [1, 1, 2, 8, 3815]
