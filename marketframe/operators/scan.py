"""Blocked per-key scans: running sums, running max, last-non-null carry and lag across a key.

A plain ``Window.partitionBy(key).orderBy(t)`` puts every row of a key in one task, so a key that
holds a third of the data becomes a third of the job in one task. Here each key is cut into time
blocks, at every size and by one plan:

1. ``time_bounds`` cuts each key into cells at quantiles of its time, and each cell that is still large into
   parts at quantiles of (time, tie) inside it; ``with_blocks`` numbers the rows by them. A key of n rows gets
   about sqrt(n) blocks of about sqrt(n) rows (at least ``MIN_BLOCK_ROWS``), however its rows lie in time: a
   burst is split by its own times, and many rows of one instant by their tie, the second column of the order;
2. a window over (key, block) computes the in-block prefix, in parallel across blocks;
3. one summary row per (key, block), pre-aggregated from the same rows, goes through a window over the
   key's blocks to give each block its carry; that table has one row per (key, block);
4. the carry is joined back on (key, block) and combined with the in-block prefix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketframe.session import cut_lineage

UNB = Window.unboundedPreceding
CUR = Window.currentRow

BLOCK = "__blk"
MIN_BLOCK_ROWS = 500
CELLS = 64          # first level: cells of a key
PARTS = 512         # second level: parts of a large cell
BROADCAST_CELLS = 16_000    # keys whose cuts are broadcast, about 0.6 KB each
BROADCAST_PARTS = 2_000     # large cells whose cuts are broadcast, about 4 KB each
SPREAD = 4096


@dataclass(frozen=True)
class Bounds:
    """Cuts of every key (``cells``) and of every large cell (``parts``; None where there is none). Those of more rows than
    ``light_cells`` and ``light_parts`` are few enough to be broadcast."""

    cells: DataFrame
    parts: DataFrame | None
    light_cells: int = 0
    light_parts: int = 0


def _micros(time_col: str) -> Column:
    return F.unix_micros(F.col(time_col))


def _shares(n: int) -> Column:
    return F.array(*[F.lit(i / n) for i in range(1, n)])


def _place(rows: DataFrame, value: str, cuts: str, out: str, n: int) -> DataFrame:
    """``out``: how many of the n - 1 sorted ``cuts`` (n a power of two) are at or below ``value``, by bisection; one
    projection a step, so that all of it stays generated code. 0 without cuts or value."""
    rows, step = rows.withColumn(out, F.lit(0)), n // 2
    while step:
        below = F.get(cuts, F.col(out) + F.lit(step - 1)) <= F.col(value)
        rows = rows.withColumn(out, F.col(out) + F.when(below, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return rows


def _spread(time_col: str, tie: Column | None) -> Column:
    """A number that only rows of one time and tie have in common, which share a block anyway."""
    return F.xxhash64(F.col(time_col), F.lit(0) if tie is None else tie)


def _match(keys: list[str]) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"__bk{i}")) for i, k in enumerate(keys)]


def _light(cuts: DataFrame, size: str, most: int) -> int:
    """The ``size`` that at most ``most`` rows of ``cuts`` exceed: 0 where all are to be broadcast, -1 where there are none."""
    top = cuts.select(size).orderBy(F.desc(size)).limit(most + 1).agg(F.count(size).alias("n"), F.min(size).alias("least")).first()
    return -1 if not top["n"] else top["least"] if top["n"] > most else 0


def _meet(rows: DataFrame, cuts: DataFrame, on: list[Column], size: str, light: int, spread: Column) -> DataFrame:
    """``rows`` with the columns of their row of ``cuts``, NULL without one. Rows are never brought together by a key of many
    rows: its cuts are broadcast. Keys of at most ``light`` rows meet theirs in a shuffle, to which the other rows come
    dealt out by ``spread``."""
    j = rows.join(F.broadcast(cuts.filter(F.col(size) > light) if light else cuts), on, "left")
    if not light:
        return j
    met = F.when(F.col(size).isNotNull(), F.pmod(spread, F.lit(SPREAD)) + 1).otherwise(F.lit(0))
    j = j.select("*", met.alias("__b_met")).withColumnsRenamed({c: f"__h{c}" for c in cuts.columns})
    rest = cuts.filter(F.col(size) <= light).withColumn("__b_zero", F.least(F.col(size), F.lit(0)))     # no literal, so it stays a key
    j = j.join(rest, [*on, F.col("__b_met") == F.col("__b_zero")], "left")
    return j.select(*rows.columns, *[F.coalesce(F.col(f"__h{c}"), F.col(c)).alias(c) for c in cuts.columns])


def _in_cells(rows: DataFrame, cells: DataFrame, light: int, keys: list[str], time_col: str, tie: Column | None) -> DataFrame:
    """``rows`` with ``__b_cell`` and ``__b_x``, a number that rises with (time, tie) inside a cell: microseconds from the cell's
    first cut, and the tie as a fraction of its range, which is exact where a cell starts with a crowded instant."""
    own = ["__b_cuts", "__b_n", "__b_aim", "__b_t0", "__b_tie0", "__b_range"]
    if keys:
        b = cells.select(*[F.col(k).alias(f"__bk{i}") for i, k in enumerate(keys)], *own)
        j = _meet(rows, b, _match(keys), "__b_n", light, _spread(time_col, tie)).drop(*[f"__bk{i}" for i in range(len(keys))])
    else:                                                       # cells of the whole table: one row, a scalar subquery
        j = rows.withColumn("__b_s", cells.select(F.struct(*own)).scalar()).select(*rows.columns, "__b_s.*")
    j = _place(j.withColumn("__b_t", _micros(time_col)), "__b_t", "__b_cuts", "__b_at", CELLS)
    wanted = F.greatest(F.lit(1), F.least(F.lit(CELLS), F.ceil(F.col("__b_n") / F.col("__b_aim")))).cast("int")
    j = j.withColumn("__b_cell", F.coalesce(F.floor(F.col("__b_at") * wanted / CELLS).cast("int"), F.lit(0)))
    first = F.ceil(F.col("__b_cell") * CELLS / wanted).cast("int")                  # the cell's first place among the cuts
    lo = F.when(first > 0, F.get("__b_cuts", first - 1)).otherwise(F.col("__b_t0"))
    part = F.lit(0.0) if tie is None else (tie.cast("double") - F.col("__b_tie0")) / F.col("__b_range")
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(part, F.lit(0.0))))
    return j.withColumn("__b_x", (F.col("__b_t") - lo).cast("double") + part)


def time_bounds(rows: DataFrame, keys: list[str], time_col: str, min_rows: int = MIN_BLOCK_ROWS, tie: str | None = None) -> Bounds:
    """Cuts of every key of ``rows``, which is read twice. ``tie`` is the number that orders rows of one time.

    Both tables are materialised: approximate quantiles need not come out alike twice, and all parts of a scan have to
    agree on the blocks.
    """
    n, t = F.count(F.lit(1)), _micros(time_col)
    ties = F.lit(0.0) if tie is None else F.col(tie).cast("double")
    timed = rows.filter(F.col(time_col).isNotNull())
    cells = timed.groupBy(*keys).agg(
        F.percentile_approx(t, _shares(CELLS), F.lit(2000)).alias("__b_cuts"), n.alias("__b_n"), F.min(t).alias("__b_t0"),
        F.greatest(F.lit(float(min_rows)), F.sqrt(n.cast("double"))).alias("__b_aim"),
        F.min(ties).alias("__b_tie0"), (F.max(ties) - F.min(ties) + 1.0).alias("__b_range"))
    cells = cut_lineage(cells)
    light = max(0, _light(cells, "__b_n", BROADCAST_CELLS))
    placed = _in_cells(timed.select(*keys, time_col, *([tie] if tie else [])), cells, light, keys, time_col, None if tie is None else F.col(tie))
    large = placed.groupBy(*keys, "__b_cell").agg(n.alias("__b_m"), F.first("__b_aim").alias("__b_aim"),
                                                F.percentile_approx("__b_x", _shares(PARTS), F.lit(5000)).alias("__b_inner"))
    large = large.filter(F.col("__b_m") > 2 * F.col("__b_aim"))
    sub = F.least(F.lit(PARTS), F.ceil(F.col("__b_m") / F.col("__b_aim"))).cast("int")
    parts = cut_lineage(large.select(*keys, "__b_cell", "__b_inner", sub.alias("__b_sub"), "__b_m"))
    light_parts = _light(parts, "__b_m", BROADCAST_PARTS)
    return Bounds(cells, None if light_parts < 0 else parts, light, max(0, light_parts))


def with_blocks(rows: DataFrame, bounds: Bounds, keys: list[str], time_col: str, tie: Column | None = None) -> DataFrame:
    """``rows`` with ``__blk``, a number that never falls as (time, ``tie``) rises within a key; without ``tie`` rows of one
    time share a block. Rows without a time come first (-1); rows of a key without bounds share block 0."""
    j = _in_cells(rows, bounds.cells, bounds.light_cells, keys, time_col, tie)
    blk = F.col("__b_cell").cast("long") * PARTS
    if bounds.parts is not None:
        p = bounds.parts.select(*[F.col(k).alias(f"__bk{i}") for i, k in enumerate(keys)], F.col("__b_cell").alias("__b_pc"), "__b_inner", "__b_sub", "__b_m")
        j = _meet(j, p, [*_match(keys), F.col("__b_cell") == F.col("__b_pc")], "__b_m", bounds.light_parts, _spread(time_col, tie))
        j = _place(j, "__b_x", "__b_inner", "__b_in", PARTS)
        blk = blk + F.coalesce(F.floor(F.col("__b_in") * F.col("__b_sub") / PARTS), F.lit(0))
    return j.select(*rows.columns, F.when(F.col("__b_t").isNull(), F.lit(-1)).otherwise(blk).cast("long").alias(BLOCK))


def blocked(rows: DataFrame, keys: list[str], time_col: str, min_rows: int = MIN_BLOCK_ROWS, tie: str | None = None) -> DataFrame:
    """``rows`` numbered by their own bounds (reads ``rows`` three times: pass a table or a materialised frame)."""
    return with_blocks(rows, time_bounds(rows, keys, time_col, min_rows, tie), keys, time_col, None if tie is None else F.col(tie))


def blocked_scan(df: DataFrame, keys: list[str], order: list[str], *,
                 sums: dict[str, str] | None = None,
                 sums_excl: dict[str, str] | None = None,
                 maxes: dict[str, str] | None = None,
                 maxes_excl: dict[str, str] | None = None,
                 lasts: dict[str, str] | None = None,
                 prevs: dict[str, str] | None = None) -> DataFrame:
    """Per-key scans over rows ordered by ``order`` (must be a total order within a key). ``df`` carries
    ``__blk`` (``with_blocks``), which must not fall along ``order``; it is kept for later scans.

    sums: inclusive running sum (NULLs add nothing; 0 when no value yet)
    sums_excl: running sum over strictly earlier rows
    maxes / maxes_excl: running max, inclusive / strictly earlier rows (NULL when none)
    lasts: last non-NULL value up to and including the row
    prevs: the value on the previous row (lag 1), NULL on the key's first row
    """
    sums, sums_excl = sums or {}, sums_excl or {}
    maxes, maxes_excl = maxes or {}, maxes_excl or {}
    lasts, prevs = lasts or {}, prevs or {}
    bkeys = keys + [BLOCK]
    ordc = F.struct(*[F.col(c) for c in order])
    w = Window.partitionBy(*bkeys).orderBy(*order)
    run, before = w.rowsBetween(UNB, CUR), w.rowsBetween(UNB, -1)

    local = []
    for c, o in sums.items():
        local.append(F.coalesce(F.sum(c).over(run), F.lit(0)).alias(f"__ls_{o}"))
    for c, o in sums_excl.items():
        local.append(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__lse_{o}"))
    for c, o in maxes.items():
        local.append(F.max(c).over(run).alias(f"__lm_{o}"))
    for c, o in maxes_excl.items():
        local.append(F.max(c).over(before).alias(f"__lme_{o}"))
    for c, o in lasts.items():
        local.append(F.last(c, ignorenulls=True).over(run).alias(f"__ll_{o}"))
    for c, o in prevs.items():
        local.append(F.lag(c, 1).over(w).alias(f"__lp_{o}"))
    if prevs:
        local.append(F.row_number().over(w).alias("__rn"))
    wd = df.select("*", *local)

    sums_of, max_of = sorted({*sums, *sums_excl}), sorted({*maxes, *maxes_excl})
    summ = [F.sum(c).alias(f"__t_{c}") for c in sums_of]
    summ += [F.max(c).alias(f"__m_{c}") for c in max_of]
    summ += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordc)).alias(f"__l_{c}") for c in lasts]
    summ += [F.max_by(F.col(c), ordc).alias(f"__p_{c}") for c in prevs]
    s = df.groupBy(*bkeys).agg(*summ)
    wb = Window.partitionBy(*keys).orderBy(BLOCK)
    prior = wb.rowsBetween(UNB, -1)
    carry = [F.coalesce(F.sum(f"__t_{c}").over(prior), F.lit(0)).alias(f"__ct_{c}") for c in sums_of]
    carry += [F.max(f"__m_{c}").over(prior).alias(f"__cm_{c}") for c in max_of]
    carry += [F.last(f"__l_{c}", ignorenulls=True).over(prior).alias(f"__cl_{c}") for c in lasts]
    carry += [F.lag(f"__p_{c}", 1).over(wb).alias(f"__cp_{c}") for c in prevs]
    s = s.select(*[F.col(k).alias(f"__sk{i}") for i, k in enumerate(bkeys)], *carry)

    # null-safe keys: rows with a NULL key or time still get their block's carry
    cond = [F.col(k).eqNullSafe(F.col(f"__sk{i}")) for i, k in enumerate(bkeys)]
    j = wd.join(s, cond, "left")
    out = []
    for c, o in sums.items():
        out.append((F.col(f"__ls_{o}") + F.col(f"__ct_{c}")).alias(o))
    for c, o in sums_excl.items():
        out.append((F.col(f"__lse_{o}") + F.col(f"__ct_{c}")).alias(o))
    for c, o in maxes.items():
        out.append(F.greatest(F.col(f"__lm_{o}"), F.col(f"__cm_{c}")).alias(o))
    for c, o in maxes_excl.items():
        out.append(F.greatest(F.col(f"__lme_{o}"), F.col(f"__cm_{c}")).alias(o))
    for c, o in lasts.items():
        out.append(F.coalesce(F.col(f"__ll_{o}"), F.col(f"__cl_{c}")).alias(o))
    for c, o in prevs.items():
        out.append(F.when(F.col("__rn") == 1, F.col(f"__cp_{c}")).otherwise(F.col(f"__lp_{o}")).alias(o))
    return j.select(*df.columns, *out)
