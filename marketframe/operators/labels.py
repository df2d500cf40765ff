"""Forward-return labels, class ratios, class weights, minimum-rows gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marketframe import config as C
from marketframe.operators import windows as W
from marketframe.session import cut_lineage

KEYS, ORDER = ["symbol"], ["minute"]


BLOCK_ROWS, HALO = 1500, 256


def create_labels(features: DataFrame, horizon: int = C.LABEL_HORIZON, buy_q: float = C.BUY_Q,
                  sell_q: float = C.SELL_Q, drop_unlabelled: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """future_return = price[t+h]/price[t] − 1 over the rows present (after the feature dropna),
    smoothed by EWM span 5 (so the last h rows carry the last value and keep a label); per-symbol
    quantile thresholds (linear interpolation, A16); label 2 above the upper, 0 below the lower, else 1.

    Windows run over (symbol, block) with the ``horizon`` rows after and ``HALO`` rows before each block (the
    EWM forgets in 100 rows, behind at most ``horizon`` rows without a value). The thresholds are one small row per
    symbol, joined back. The class-ratio rebalance in the modelled code can only tighten the bands at .7/.3 and
    changes no label, so it is reported (class_distribution), not applied.
    """
    bkeys = [*KEYS, "__hb"]
    place = W.indexed(cut_lineage(features), KEYS, "minute", "__at")
    df = W.halo_blocks(place, "__at", block_rows, back=min(HALO + horizon, block_rows), ahead=min(horizon, block_rows))
    w = W.series_window(bkeys, ORDER)
    df = df.withColumn("__fr", F.try_divide(W.lead("price", w, horizon), F.col("price")) - F.lit(1.0))
    # a row of the halo ahead has no value yet of its own: it must not enter the EWM as one
    last = F.max(F.when(~F.col("__halo"), F.col("__at"))).over(Window.partitionBy(*bkeys))
    df = df.withColumn("__ahead", F.col("__at") > last).filter(~F.col("__ahead")).drop("__ahead")
    if drop_unlabelled:
        df = df.filter(F.col("__fr").isNotNull())
    df = W.without_halo(W.ewm_many(df, [("__fr", "future_return", 5)], bkeys, ORDER).drop("__fr", "__at"))
    df = cut_lineage(df.na.drop("any", subset=["future_return"]))
    cuts = W.quantiles(df, KEYS, "future_return", [buy_q, sell_q], ["__upper", "__lower"])
    label = (F.when(F.col("future_return") > F.col("__upper"), F.lit(C.BUY))
              .when(F.col("future_return") < F.col("__lower"), F.lit(C.SELL)).otherwise(F.lit(C.HOLD)))
    return df.join(cuts, KEYS).withColumn("label", label.cast("int")).select(*df.columns, "label")


def class_distribution(labelled: DataFrame, label: str = "label", keys: list[str] | None = None,
                       min_ratio: float = C.MIN_CLASS_RATIO) -> DataFrame:
    """A17 / E7 value_counts(normalize=True) per key: share of each class, and whether it reaches the ratio that the
    modelled trainer asks for. The windows run over the few count rows."""
    keys = keys or []
    counts = labelled.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*keys))
    return counts.select(*keys, label, "n", share.alias("share")).withColumn("enough", F.col("share") >= F.lit(min_ratio))


def class_weights(labelled: DataFrame, label: str = "label", keys: list[str] | None = None) -> DataFrame:
    """E10 'balanced' weights n / (k · n_c) over the classes present, per key."""
    keys = keys or []
    counts = labelled.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n_c"))
    part = Window.partitionBy(*keys)
    n, k = F.sum("n_c").over(part), F.count(F.lit(1)).over(part)
    return counts.select(*keys, label, "n_c", (n / (k * F.col("n_c"))).alias("weight"))


def with_class_weight(labelled: DataFrame, label: str = "label", keys: list[str] | None = None,
                      out: str = "weight") -> DataFrame:
    """Attach the balanced weight n / (k · n_c) to each row: a join with one small row per (key, class)."""
    keys = keys or []
    w = class_weights(labelled, label, keys).select(*keys, label, F.col("weight").alias(out))
    return labelled.join(w, [*keys, label]).select(*labelled.columns, out)


def enough_rows(df: DataFrame, keys: list[str], min_rows: int = C.MIN_TRAIN_ROWS) -> DataFrame:
    """Keys with at least ``min_rows`` rows (the training gate), with their row counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("trainable", F.col("n_rows") >= F.lit(min_rows)))
