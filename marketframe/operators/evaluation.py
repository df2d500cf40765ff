"""Classification metrics as grouped aggregates (no driver-side loops)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketframe.operators.scan import blocked, blocked_scan
from marketframe.session import cut_lineage


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     keys: list[str] | None = None) -> DataFrame:
    """E17 counts per (true, predicted) class."""
    keys = keys or []
    return df.groupBy(*keys, F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
             .agg(F.count(F.lit(1)).alias("n"))


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     keys: list[str] | None = None) -> DataFrame:
    """E16 accuracy and support-weighted precision / recall / F1 with zero_division = 0.

    Built from the confusion counts: per class c, tp = n(c,c), support = Σ_pred n(c,·),
    predicted = Σ_true n(·,c); classes seen only in predictions have support 0 and weight 0.
    """
    keys = keys or []
    cm = confusion_matrix(df, label, prediction, keys)
    true_side = cm.groupBy(*keys, F.col("label").alias("cls")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))).alias("tp"))
    pred_side = cm.groupBy(*keys, F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = true_side.join(pred_side, keys + ["cls"], "full_outer").na.fill(0, ["support", "tp", "predicted"])
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    per = per.select(*keys, "support", "tp", prec.alias("p"), rec.alias("r"), f1.alias("f"))
    tot = F.sum("support")
    return per.groupBy(*keys).agg(
        (F.sum("tp") / tot).alias("accuracy"),
        (F.sum(F.col("p") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("r") * F.col("support")) / tot).alias("recall"),
        (F.sum(F.col("f") * F.col("support")) / tot).alias("f1"),
        tot.alias("n"))


def persistence_prediction(labelled: DataFrame, keys: list[str], time_col: str, label: str = "label",
                           out: str = "prediction") -> DataFrame:
    """A baseline classifier for the metric operators: predict the previous row's label (HOLD first)."""
    d = blocked_scan(blocked(cut_lineage(labelled), keys, time_col), keys, [time_col], prevs={label: "__prev"})
    return d.withColumn(out, F.coalesce("__prev", F.lit(1)).cast("int")).select(*labelled.columns, out)
