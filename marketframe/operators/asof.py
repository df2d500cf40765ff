"""As-of lookups (J1, J2, R4 batch form).

``asof_join`` is a backward as-of join done as one union and a blocked last-non-NULL scan per key:
right rows carry their values packed in a struct, left rows carry NULL, and each left row takes
the last struct seen at or before its time (right rows sort before left rows at equal time). There is
no nested-loop or range join, and a hot key is split across blocks cut at its own quantiles of (time, order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketframe.operators.scan import Bounds, blocked_scan, time_bounds, with_blocks


def _shifted(time_col: str, seconds: Column) -> Column:
    return F.col(time_col) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def asof_lookup(left: DataFrame, rights: dict[str, DataFrame], on: list[str], left_time: str, right_time: str,
                right_order: str, *, strict: bool = False, bounds: Bounds | None = None,
                maxes: dict[str, str] | None = None) -> DataFrame:
    """``left`` with one struct column per entry of ``rights``: the latest row of that frame (all its columns
    but ``on``) with right_time <= left_time, or < with ``strict``; NULL without one. ``maxes`` maps a right
    column to the name of its running maximum over the rows that the left row can see.

    All lookups share one scan. ``right_order`` breaks ties between right rows at one time (later wins).
    ``bounds`` are the cuts of each ``on`` key (``scan.time_bounds``); by default those of the right rows.
    """
    side = 0 if strict else 1                                   # where left rows sort at equal time
    lcols = left.columns
    u = left.select(*lcols, F.col(left_time).alias("__t"), F.lit(side).alias("__side"), F.lit(0).cast("long").alias("__tb"),
                    F.lit(True).alias("__left"))
    for name, r in rights.items():
        vals = [c for c in r.columns if c not in on]
        own = [F.col(c).alias(f"__max_{c}") for c in (maxes or {}) if c in vals]
        u = u.unionByName(r.select(*on, F.col(right_time).alias("__t"), F.lit(1 - side).alias("__side"),
                                   F.col(right_order).cast("long").alias("__tb"), F.lit(False).alias("__left"),
                                   F.struct(*vals).alias(f"__val_{name}"), *own), allowMissingColumns=True)
    if bounds is None:
        every = None
        for r in rights.values():
            part = r.select(*on, F.col(right_time).alias("__t"), F.col(right_order).cast("long").alias("__tb"))
            every = part if every is None else every.unionByName(part)
        bounds = time_bounds(every, on, "__t", tie="__tb")
    # a left row lies after all right rows of its time, or with ``strict`` before them
    u = with_blocks(u, bounds, on, "__t", F.when(F.col("__left"), F.lit(-2.0 ** 63 if strict else 2.0 ** 63)).otherwise(F.col("__tb")))
    # all left rows sort together at one time; their order among themselves changes nothing
    s = blocked_scan(u, on, ["__t", "__side", "__tb"], lasts={f"__val_{n}": f"__hit_{n}" for n in rights},
                     maxes={f"__max_{c}": o for c, o in (maxes or {}).items()})
    return s.filter("__left").select(*lcols, *[F.col(f"__hit_{n}").alias(n) for n in rights], *(maxes or {}).values())


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str,
              values: list[str], right_order: str, *, prefix: str = "", bounds: Bounds | None = None) -> DataFrame:
    """For each left row, the right ``values`` of the latest right row with right_time <= left_time (same
    ``on`` keys). Unmatched left rows get NULLs."""
    cols = list(dict.fromkeys([*on, right_time, right_order, *values]))
    out = asof_lookup(left, {"__r": right.select(*cols)}, on, left_time, right_time, right_order, bounds=bounds)
    return out.select(*left.columns, *[F.col("__r")[v].alias(prefix + v) for v in values])


def asof_join_offsets(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str,
                      values: list[str], right_order: str, row_key: str, offsets: dict[str, float], *,
                      bounds: Bounds | None = None) -> DataFrame:
    """Several as-of lookups per left row in one scan, e.g. {"decision_": 0, "fill_": 1.0}: the price
    at the decision and one second later (J1 + J2).

    Each left row is exploded once per offset (only the first copy carries the left columns); one blocked
    scan resolves all lookups, and a group-by on ``row_key`` (unique per left row) folds the copies back.
    """
    lcols, names = left.columns, list(offsets)
    copies = F.explode(F.array(*[F.struct(F.lit(i).alias("tag"), F.lit(float(s)).alias("shift"))
                                 for i, s in enumerate(offsets.values())]))
    tagged = left.withColumn("__c", copies).select(
        *on, F.col(row_key).alias("__key"), F.col("__c.tag").alias("__tag"),
        _shifted(left_time, F.col("__c.shift")).alias("__lt"),
        F.when(F.col("__c.tag") == 0, F.struct(*lcols)).alias("__row"))
    hit = asof_join(tagged, right, on, "__lt", right_time, values, right_order, prefix="__v_", bounds=bounds)
    aggs = [F.max("__row").alias("__row")]
    aggs += [F.max(F.when(F.col("__tag") == i, F.col(f"__v_{v}"))).alias(p + v) for i, p in enumerate(names) for v in values]
    g = hit.groupBy("__key").agg(*aggs)
    return g.select(*[F.col(f"__row.{c}").alias(c) for c in lcols], *[p + v for p in names for v in values])


def latest_per_symbol(ticks: DataFrame, symbols=None) -> DataFrame:
    """R4 batch form: last numeric price per symbol in arrival order (received_at, then seq).

    P10: only ticks with a numeric price count; ``symbols`` restricts the set (J6 semi-join by isin).
    A grouped max_by combines map-side, so a hot symbol costs one partial row per task.
    """
    t = ticks.filter(F.col("price").isNotNull() & ~F.isnan("price"))
    if symbols:
        t = t.filter(F.col("symbol").isin(list(symbols)))
    return t.groupBy("symbol").agg(
        F.max_by("price", F.struct("received_at", "seq")).alias("price"),
        F.max("received_at").alias("received_at"))


def missing_symbols(required: DataFrame, available: DataFrame) -> DataFrame:
    """Required symbols with no available price (left anti join)."""
    return required.join(available.select("symbol").distinct(), "symbol", "left_anti")
