"""Distributed classifiers over the labelled feature table (E9–E19, S24), with MLlib.

* split: chronological per symbol (W11), optional newest-n cap per symbol (W10) as in the modelled
  trainer for the two slow models;
* E9: VectorAssembler + StandardScaler(withMean, withStd) inside the saved pipeline (MLlib divides by
  the sample std; the modelled scaler by the population std — a constant factor per feature);
* E10: balanced class weights as ``weightCol`` (window aggregates, no join);
* E11 logistic regression, E12 random forest grown and stored in batches of trees (``BatchedForest``), E13 gradient boosting on
  the joint softmax loss (``SoftmaxBoosting``), E14 RBF-kernel SVM re-aimed as random Fourier features + logistic
  regression, E15 the sequence model re-aimed as a multilayer perceptron;
* E16 metrics through MulticlassClassificationEvaluator, E18 a ``model_runs`` row, S24 save/load,
  E19 scoring: probability → class (argmax) and confidence (max).
"""

from __future__ import annotations

import json
import math
import os
import uuid
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from marketframe import config as C
from marketframe.operators import trees as T
from marketframe.operators import windows as W
from marketframe.operators.evaluation import weighted_metrics
from marketframe.operators.labels import enough_rows, with_class_weight
from marketframe.schemas import FEATURE_COLUMNS
from marketframe.session import cut_lineage, scratch_path, ship_package

CLASSES = [C.SELL, C.HOLD, C.BUY]           # 0, 1, 2: the places in a probability array
EXCLUDED = ["price", "future_return", "label", "minute", "symbol", "split", "weight"]


def feature_columns(df: DataFrame) -> list[str]:
    """Every column except the target and bookkeeping columns (the trainer's dynamic list)."""
    return [c for c in df.columns if c not in EXCLUDED]


def training_frame(labelled: DataFrame, keys=("symbol",), test_fraction: float = C.TEST_FRACTION,
                   newest: int | None = None) -> DataFrame:
    """W10 (optional cap) + W11 split + E10 weights computed on the training rows' classes."""
    df = labelled
    if newest:
        df = W.tail_n(df, list(keys), ["minute"], newest)
    df = cut_lineage(W.chrono_split(cut_lineage(df), list(keys), "minute", test_fraction))
    train = with_class_weight(df.filter(F.col("split") == "train"), keys=list(keys))
    test = df.filter(F.col("split") == "test").withColumn("weight", F.lit(1.0))
    return train.unionByName(test)


def _scaled(features: list[str]) -> list:
    return [VectorAssembler(inputCols=features, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)]


def rff_transformer(train: DataFrame, features: list[str], n_components: int = 100, gamma: float | None = None,
                    seed: int = 42) -> SQLTransformer:
    """E14 re-aimed: random Fourier features z_k = sqrt(2/D) cos(w_k·x̃ + b_k) approximating the RBF
    kernel exp(−γ‖x̃−y‖²) on standardised x̃; γ defaults to 1/n_features ('scale' on unit variance).

    Standardisation uses the training split's mean/std (2·n_features numbers, a fixed-size statistic)
    and is folded into the projection, so the stage is plain SQL and persists with the pipeline.
    """
    g = gamma if gamma is not None else 1.0 / len(features)
    stats = train.agg(*[F.avg(c).alias(f"m_{c}") for c in features],
                      *[F.stddev_samp(c).alias(f"s_{c}") for c in features]).first()
    rng = np.random.default_rng(seed)
    wmat = rng.normal(0.0, math.sqrt(2.0 * g), size=(n_components, len(features)))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    scale = math.sqrt(2.0 / n_components)
    cols = []
    for k in range(n_components):
        terms, const = [], float(b[k])
        for i, c in enumerate(features):
            sd = stats[f"s_{c}"] or 1.0
            coef = float(wmat[k, i]) / sd
            const -= coef * float(stats[f"m_{c}"] or 0.0)
            terms.append(f"({coef!r}) * `{c}`")
        cols.append(f"{scale!r} * cos({' + '.join(terms)} + ({const!r})) AS rff_{k}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(cols)} FROM __THIS__")


def make_pipeline(kind: str, features: list[str], train: DataFrame | None = None, *, seed: int = 42,
                  max_iter: int | None = None, rff_components: int = 100, train_rows: int | None = None) -> Pipeline:
    """A Pipeline for one of: logistic_regression, svm_rbf, mlp (random_forest: BatchedForest, gbt: SoftmaxBoosting)."""
    if kind == "logistic_regression":
        # the modelled penalty (C = 1) is on the sum of losses, MLlib's on their mean
        clf = LogisticRegression(maxIter=max_iter or 500, family="multinomial", weightCol="weight",
                                 regParam=1.0 / max(train_rows or 1, 1))
        return Pipeline(stages=_scaled(features) + [clf])
    if kind == "svm_rbf":
        rff = rff_transformer(train, features, rff_components, seed=seed)
        asm = VectorAssembler(inputCols=[f"rff_{k}" for k in range(rff_components)], outputCol="features")
        clf = LogisticRegression(maxIter=max_iter or 500, family="multinomial", weightCol="weight", regParam=1.0 / max(train_rows or 1, 1))
        return Pipeline(stages=[rff, asm, clf])
    if kind == "mlp":
        clf = MultilayerPerceptronClassifier(layers=[len(features), 64, 32, 3], seed=seed, maxIter=max_iter or 100)
        return Pipeline(stages=_scaled(features) + [clf])
    raise ValueError(f"unknown model kind {kind}")


class BatchedForest:
    """``num_trees`` class-weighted trees, grown ``batch`` at a time from one checkpointed table. A batch is written
    to ``path`` when it is done and leaves the driver before the next one starts. A forest's probability is its trees' mean, so the mean over
    batches, weighted by their trees, is that of the one large forest.

    ``max_depth`` bounds a tree to ``2 ** (max_depth + 1)`` nodes: the driver and every scoring task hold trees, and
    unlimited ones grow with the rows.
    """

    def __init__(self, features: list[str], path: str, num_trees: int = 50, max_depth: int = 10, batch: int = 25, seed: int = 42):
        self.features, self.path, self.max_depth, self.seed = features, path, max_depth, seed
        self.sizes = [min(batch, num_trees - k) for k in range(0, num_trees, batch)]

    def _folder(self, k: int) -> str:
        return os.path.join(self.path, f"trees_{k}")

    def fit(self, train: DataFrame) -> "BatchedForest":
        scaler = Pipeline(stages=_scaled(self.features)).fit(train)
        scaler.write().overwrite().save(os.path.join(self.path, "scaler"))
        rows = cut_lineage(scaler.transform(train).select("features", "label", "weight"))
        for k, trees in enumerate(self.sizes):
            RandomForestClassifier(numTrees=trees, maxDepth=self.max_depth, seed=self.seed + k, weightCol="weight",
                                   featureSubsetStrategy="sqrt", cacheNodeIds=False, maxMemoryInMB=512) \
                .fit(rows).write().overwrite().save(self._folder(k))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability_array`` and ``prediction``, from the stored trees."""
        out = PipelineModel.load(os.path.join(self.path, "scaler")).transform(df)
        for k in range(len(self.sizes)):
            model = RandomForestClassificationModel.load(self._folder(k))
            model = model.setProbabilityCol(f"prob_{k}").setRawPredictionCol("").setPredictionCol("")
            out = model.transform(out)
        total = float(sum(self.sizes))
        each = [vector_to_array(F.col(f"prob_{k}")) for k in range(len(self.sizes))]
        probs = [sum((p[c] * F.lit(n / total) for p, n in zip(each, self.sizes, strict=True)), F.lit(0.0)) for c in range(3)]
        out = out.select(*df.columns, F.array(*probs).alias("probability_array"))
        return out.withColumn("prediction", (F.array_position("probability_array", F.array_max("probability_array")) - 1).cast("double"))

    def save(self, path: str) -> None:
        """A copy of the stored trees in another folder."""
        PipelineModel.load(os.path.join(self.path, "scaler")).write().overwrite().save(os.path.join(path, "scaler"))
        for k in range(len(self.sizes)):
            RandomForestClassificationModel.load(self._folder(k)).write().overwrite().save(os.path.join(path, f"trees_{k}"))

    @classmethod
    def load(cls, path: str, features: list[str]) -> "BatchedForest":
        """The forest stored in a folder, with as many batches as lie there."""
        out = cls(features, path, num_trees=0)
        sc = SparkSession.active().sparkContext
        fs = sc._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(sc._jsc.hadoopConfiguration())
        while fs.exists(sc._jvm.org.apache.hadoop.fs.Path(out._folder(len(out.sizes)))):
            out.sizes.append(RandomForestClassificationModel.load(out._folder(len(out.sizes))).getNumTrees)
        return out


class SoftmaxBoosting:
    """Three-class gradient boosting on the joint softmax loss, trees of depth 3, step .1 and no class weights, as the
    modelled booster. Scores start at the log class shares; every round fits one regression tree a class to the Newton
    step (residual / h, weighted by h = p(1 - p)), all three from the same probabilities.

    Features are binned once, into at most ``bins`` (256, a byte) between quantiles of all rows. The three trees of a round grow
    together and every level is one pass: tasks send sums a (class, feature, node, bin), at most 55,296 at 18 features and
    depth 3, and the driver chooses the splits from their totals. Scores are written every ``keep`` rounds; a pass adds the
    rounds since then.

    A tree has at most 15 nodes, so a fitted model is bounded by its rounds. Saved as a table of one row a tree.
    """

    def __init__(self, features: list[str], max_iter: int = 100, step: float = 0.1, max_depth: int = 3, bins: int = 256, keep: int = 10):
        self.features, self.max_iter, self.max_depth, self.bins, self.keep = features, max_iter, max_depth, bins, keep
        self.rate = step * (len(CLASSES) - 1) / len(CLASSES)
        self.start: list[float] = []                            # log share of each class
        self.rounds: list[list] = []                            # per round one tree a class

    def _cuts(self, train: DataFrame) -> list[list[float]]:
        """The thresholds of each feature: between all its values if they are few, else between 1,025 quantiles."""
        at = F.array(*[F.lit(k / 1024) for k in range(1025)])
        row = train.agg(*[F.approx_count_distinct(c).alias(f"__n_{c}") for c in self.features],
                        *[F.percentile_approx(c, at).alias(c) for c in self.features]).first()
        few = [c for c in self.features if row[f"__n_{c}"] <= 2 * self.bins]                      # some 2 * bins values at most
        seen = row.asDict() | (train.agg(*[F.collect_set(c).alias(c) for c in few]).first().asDict() if few else {})
        return [T.cut_points(*np.unique(np.array(seen[c], dtype=float), return_counts=True), self.bins) for c in self.features]

    def _tasks(self, df: DataFrame, n: int) -> int:
        """How many tasks share a pass: one a core, none under 8,192 rows (each sends its cells), none above 262,144."""
        return max(min(df.sparkSession.sparkContext.defaultParallelism, -(-n // 8192)), -(-n // 262144))

    def _sums(self, rows: DataFrame, done: list[list], routes: list, nodes: int) -> np.ndarray:
        """Residuals and weights summed a (class, feature, open node, bin)."""
        width = len(self.features)
        run = partial(T.histograms, width=width, bins=self.bins, rounds=done, rate=self.rate, routes=routes, nodes=nodes)
        cells = rows.mapInArrow(run, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        got = cells.coalesce(rows.sparkSession.sparkContext.defaultParallelism).toArrow()       # the cells are few, whatever the rows
        out = np.zeros((2, len(CLASSES) * width * nodes * self.bins))
        out[:, got["cell"].to_numpy()] = got["g"].to_numpy(), got["h"].to_numpy()
        return out.reshape(2, len(CLASSES), width, nodes, self.bins)

    def _round(self, rows: DataFrame, done: list[list]) -> list:
        """One tree a class, over bins. Until its level is done, an open node is its number in place of a leaf."""
        def route(tree):
            return [*tree[:2], *map(route, tree[2:])] if isinstance(tree, list) else tree if isinstance(tree, int) else -1

        roots = [[0] for _ in CLASSES]
        nodes = [[(root, 0)] for root in roots]
        for level in range(self.max_depth):
            sums = self._sums(rows, done, [route(root[0]) for root in roots], max(map(len, nodes)))
            for c, here in enumerate(nodes):
                nodes[c] = []
                for k, (parent, place) in enumerate(here):
                    g, h = sums[:, c, :, k]
                    parent[place] = split = T.best_split(g, h) or float(g[0].sum() / h[0].sum())
                    if isinstance(split, list) and level + 1 < self.max_depth:
                        for side in (2, 3):
                            split[side] = len(nodes[c])
                            nodes[c].append((split, side))
            if not any(nodes):
                break
        return [root[0] for root in roots]

    def fit(self, train: DataFrame) -> "SoftmaxBoosting":
        ship_package(train.sparkSession)
        n = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}          # one row a class
        self.start = [math.log((n.get(c, 0) + 1.0) / (sum(n.values()) + len(CLASSES))) for c in CLASSES]
        train = train.select(*[F.col(c).cast("double").alias(c) for c in self.features], F.col("label").cast("int"))
        cuts, width = self._cuts(train), len(self.features)
        rows = train.mapInArrow(partial(T.to_bins, cuts=cuts), "bins binary, label int")
        rows = rows.select("*", *[F.lit(x).alias(f"score_{c}") for c, x in zip(CLASSES, self.start, strict=True)])
        rows = cut_lineage(rows.repartition(self._tasks(train, sum(n.values()))))

        def named(tree):
            return [self.features[tree[0]], cuts[tree[0]][tree[1]], *map(named, tree[2:])] if isinstance(tree, list) else tree
        done: list[list] = []                                   # rounds that the written scores do not hold
        for _ in range(self.max_iter):
            if len(done) == self.keep:
                rows = cut_lineage(rows.mapInArrow(partial(T.with_scores, width=width, rounds=done, rate=self.rate), rows.schema))
                done = []
            done.append(self._round(rows, done))
            self.rounds.append([named(tree) for tree in done[-1]])
        return self

    def transform(self, df: DataFrame, rounds: int | None = None) -> DataFrame:
        """``df`` with ``probability_array`` and ``prediction`` after the first ``rounds`` rounds (default all)."""
        ship_package(df.sparkSession)
        run = partial(T.probabilities, start=self.start, rounds=self.rounds[:rounds], rate=self.rate)

        @F.arrow_udf("array<double>")
        def scored(x: pa.Array) -> pa.Array:
            return run(x)
        out = df.withColumn("probability_array", scored(F.struct(*[F.col(c).cast("double").alias(c) for c in self.features])))
        return out.withColumn("prediction", (F.array_position("probability_array", F.array_max("probability_array")) - 1).cast("double"))

    def save(self, path: str) -> None:
        """One row a tree (JSON nodes), round -1 holds the starting scores."""
        trees = [(k, c, json.dumps(t)) for k, ts in enumerate([self.start, *self.rounds], -1) for c, t in enumerate(ts)]
        SparkSession.active().createDataFrame(trees, "round int, class int, nodes string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, features: list[str]) -> "SoftmaxBoosting":
        trees = SparkSession.active().read.parquet(path).orderBy("round", "class").collect()   # three rows a round
        out, parts = cls(features), [json.loads(r["nodes"]) for r in trees]
        out.start, *out.rounds = [parts[i:i + len(CLASSES)] for i in range(0, len(parts), len(CLASSES))]
        out.max_iter = len(out.rounds)
        return out


def probabilities(scored: DataFrame) -> DataFrame:
    """Probability vector → array, class = argmax, confidence = max, signal (L3)."""
    p = F.col("probability_array") if "probability_array" in scored.columns else vector_to_array("probability")
    s = scored.withColumn("probability_array", p)
    cls = (F.array_position("probability_array", F.array_max("probability_array")) - 1).cast("int")
    s = s.withColumn("pred_class", cls).withColumn("confidence", F.array_max("probability_array"))
    return s.withColumn("signal", F.when(F.col("pred_class") == C.BUY, "BUY").when(F.col("pred_class") == C.SELL, "SELL")
                        .otherwise("HOLD"))


def evaluate(model, data: DataFrame) -> dict:
    """Accuracy on train and test, weighted precision/recall/F1 on test, from one scoring pass: the confusion counts
    per split are all that comes back."""
    scored = model.transform(data).withColumn("prediction", F.col("prediction").cast("int"))
    m = {r["split"]: r for r in weighted_metrics(scored, keys=["split"]).collect()}
    test = m.get("test")
    return {"train_accuracy": m["train"]["accuracy"] if "train" in m else 0.0,
            "test_accuracy": test["accuracy"] if test else 0.0,
            **{k: test[k] if test else 0.0 for k in ("precision", "recall", "f1")}}


def run_record(spark, name: str, description: str, key: str, retrain_hours: float, metrics: dict) -> DataFrame:
    """The ``model_runs`` row (run id and time stamped by Spark, S15)."""
    return spark.range(1).select(
        F.expr("uuid()").alias("run_id"), F.current_timestamp().alias("trained_at"), F.lit(name).alias("model_name"),
        F.lit(description).alias("model_description"), F.lit(key).alias("s3_key"),
        F.lit(float(retrain_hours)).alias("retrain_interval"),
        *[F.lit(float(metrics[m])).alias(m) for m in ("train_accuracy", "test_accuracy", "precision", "recall", "f1")])


def append_run(record: DataFrame, path: str) -> None:
    """Append the run's row to the ``model_runs`` log."""
    record.write.mode("append").parquet(path)


def stored_and_logged(model, data: DataFrame, name: str, folder: str) -> tuple[object, DataFrame]:
    """The model saved and loaded back, and the run log with this run's row."""
    meta = {n: (d, h) for n, d, h in C.MODELS}
    path, log = os.path.join(folder, "model"), os.path.join(folder, "model_runs")
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
        back = PipelineModel.load(path)
    else:
        model.save(path)
        back = type(model).load(path, model.features)
    append_run(run_record(data.sparkSession, name, *[meta[name][0], path, meta[name][1]], evaluate(model, data)), log)
    return back, data.sparkSession.read.parquet(log)


def train(labelled: DataFrame, kind: str, *, min_rows: int = C.MIN_TRAIN_ROWS, newest: int | None = None,
          **kw):
    """E8 gate per series + split + fit. Series with fewer than ``min_rows`` rows are left out; returns (model, data
    with split/weight), or (None, None) when none is left."""
    feats = [c for c in FEATURE_COLUMNS if c in labelled.columns]
    rows = cut_lineage(labelled)
    gate = enough_rows(rows, ["symbol"], min_rows).filter("trainable").select("symbol")
    # The labelled, split and weighted set is materialised once; the fit's passes and the scoring read that copy
    data = cut_lineage(training_frame(rows.join(gate, "symbol", "left_semi"), newest=newest))
    tr = data.filter(F.col("split") == "train")
    n = tr.count()
    if not n:
        return None, None
    if kind == "random_forest":
        path = kw.pop("path", None) or scratch_path(labelled.sparkSession, f"forest-{uuid.uuid4().hex}")
        return BatchedForest(feats, path, **kw).fit(tr), data
    if kind == "gbt":
        return SoftmaxBoosting(feats, max_iter=kw.get("max_iter") or 100).fit(tr), data
    return make_pipeline(kind, feats, tr, train_rows=n, **kw).fit(tr), data
