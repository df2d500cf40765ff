"""Metric-series operators (M1–M8) over a long table ``metric_samples(ts, metric, labels, value)``.

The dashboards' PromQL is re-aimed as DataFrame code: label selection (M1), counter increase/rate
with reset handling (M2–M3), aggregation by label (M4), last-over-time (M5), gauge ratios with
clamping (M6–M7) and last-not-null (M8). Labels needed for grouping or matching are pulled into
plain columns first. Range functions are evaluated on a fixed step grid; the boundary
extrapolation of the PromQL ``rate`` is left out (it only rescales partial windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketframe.operators.scan import BLOCK, MIN_BLOCK_ROWS, blocked, blocked_scan


def label(name: str) -> Column:
    return F.element_at(F.col("labels"), F.lit(name))


def select_series(samples: DataFrame, metric: str | None, eq: dict | None = None, regex: dict | None = None,
                  not_regex: dict | None = None) -> DataFrame:
    """M1: metric{l="v", l=~"re", l!~"re"}; regexes are anchored as in PromQL (metric None: any)."""
    s = samples if metric is None else samples.filter(F.col("metric") == metric)
    for k, v in (eq or {}).items():
        s = s.filter(label(k) == F.lit(v))
    for k, v in (regex or {}).items():
        s = s.filter(F.coalesce(label(k), F.lit("")).rlike(f"^(?:{v})$"))
    for k, v in (not_regex or {}).items():
        s = s.filter(~F.coalesce(label(k), F.lit("")).rlike(f"^(?:{v})$"))
    return s


def counter_deltas(series: DataFrame, series_keys: list[str], order: list[str], min_rows: int = MIN_BLOCK_ROWS) -> DataFrame:
    """Per-sample counter increase: v − prev, or v after a reset (v < prev); NULL for the first sample. ``order``: the
    sample time, then a number that makes it a total order. ``series`` is read three times."""
    s = blocked(series, series_keys, order[0], min_rows, tie=order[1] if len(order) > 1 else None)
    s = blocked_scan(s, series_keys, order, prevs={"value": "__prev"})
    delta = F.when(F.col("__prev").isNull(), F.lit(None).cast("double")) \
             .when(F.col("value") < F.col("__prev"), F.col("value")).otherwise(F.col("value") - F.col("__prev"))
    return s.withColumn("delta", delta).drop("__prev", BLOCK)


def increase(deltas: DataFrame, by: list[str], range_s: int, step_s: int) -> DataFrame:
    """M3 increase(c[range]) at every step of a grid, summed by the ``by`` labels (M4). The range is a multiple of
    the step: increments are first added up per step, then each step's sum counts at the range / step grid times
    whose window (t − range, t] holds it. Both are grouped sums, no window over a series."""
    if range_s % step_s:
        raise ValueError("the range must be a multiple of the step")
    step, rng = step_s * 1_000_000, range_s * 1_000_000
    at = (F.ceil(F.unix_micros("ts") / F.lit(step)) * F.lit(step)).cast("long")
    steps = deltas.filter(F.col("delta").isNotNull()).groupBy(*by, at.alias("__g")).agg(F.sum("delta").alias("delta"))
    seen = F.explode(F.sequence(F.col("__g"), F.col("__g") + (rng - step), F.lit(step).cast("long")))
    return (steps.withColumn("__t", seen).groupBy(*by, F.timestamp_micros("__t").alias("t"))
                 .agg(F.sum("delta").alias("increase")))


def rate(deltas: DataFrame, by: list[str], range_s: int, step_s: int) -> DataFrame:
    """M2 rate(c[range]) = increase / seconds, at every step."""
    return increase(deltas, by, range_s, step_s).withColumn("rate", F.col("increase") / F.lit(float(range_s)))


def by_label(df: DataFrame, by: list[str], value: str, outputs: dict[str, str]) -> DataFrame:
    """M4 sum/avg/max/min by (labels), at every step; no labels: over all series."""
    fns = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min}
    return df.groupBy(*by, "t").agg(*[fns[f](value).alias(o) for o, f in outputs.items()])


def last_over_time(df: DataFrame, keys: list[str], value: str, range_s: int, step_s: int, out: str) -> DataFrame:
    """M5 last_over_time(x[range]): at every step the latest non-NULL value within (t − range, t] per series; steps
    without one are absent. Each value is listed at the steps that see it and the latest wins, by a grouped max_by."""
    us = F.unix_micros("t")
    seen = F.explode(F.sequence(us, us + (range_s - step_s) * 1_000_000, F.lit(step_s * 1_000_000).cast("long")))
    return (df.filter(F.col(value).isNotNull()).select(*keys, us.alias("__at"), F.col(value).alias("__v"), seen.alias("__t"))
              .groupBy(*keys, F.timestamp_micros("__t").alias("t")).agg(F.max_by("__v", "__at").alias(out)))


def gauge_ratio(samples: DataFrame, num: str, den: str, keys: list[str], scale: float = 100.0) -> DataFrame:
    """M6–M7 clamp_min((1 − num/den) · scale, 0) for samples of the two gauges with equal (ts, labels).

    The two metrics are aligned with a pivot (one grouped aggregation), not a join.
    """
    wide = (samples.filter(F.col("metric").isin(num, den))
                   .groupBy("ts", *keys).agg(F.max(F.when(F.col("metric") == num, F.col("value"))).alias("__a"),
                                             F.max(F.when(F.col("metric") == den, F.col("value"))).alias("__b")))
    val = F.greatest((F.lit(1.0) - F.try_divide(F.col("__a"), F.col("__b"))) * F.lit(scale), F.lit(0.0))
    return wide.filter(F.col("__a").isNotNull() & F.col("__b").isNotNull()) \
               .select("ts", *keys, val.alias("value"))


def last_not_null(samples: DataFrame, keys: list[str]) -> DataFrame:
    """M8 stat-panel reduction lastNotNull per series."""
    s = samples.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return s.groupBy(*keys).agg(F.max("ts").alias("ts"), F.max_by("value", F.struct("ts", "seq")).alias("value"))
