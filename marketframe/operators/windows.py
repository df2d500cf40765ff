"""Row-based window operators over a time-ordered series per key.

All frames are ROWS frames over the bars that exist (minute gaps are not filled). A long series is never one
window partition: ``indexed`` numbers its rows by a blocked scan and ``halo_blocks`` cuts it into blocks that
carry the neighbouring rows their frames reach, so the window keys are (key, block).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from marketframe.operators.scan import BLOCK, MIN_BLOCK_ROWS, blocked, blocked_scan

UNB, CUR = Window.unboundedPreceding, Window.currentRow


def series_window(keys: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def full_window(x, w: WindowSpec, n: int) -> Column:
    """True when the last n rows hold n non-NULL values.

    Computed as the difference of the running non-NULL count now and n rows back: exact integer
    arithmetic in O(1) per row, where a sliding count frame would re-count n rows per row.
    """
    run = F.count(_c(x)).over(w.rowsBetween(UNB, CUR))
    return (run - F.coalesce(F.lag(run, n).over(w), F.lit(0))) == n


def rolling_mean(x, w: WindowSpec, n: int) -> Column:
    """W4 rolling(n).mean(): NULL until the frame holds n non-NULL values."""
    return F.when(full_window(x, w, n), F.avg(_c(x)).over(w.rowsBetween(-(n - 1), 0)))


def rolling_std(x, w: WindowSpec, n: int) -> Column:
    """W5 rolling(n).std() with ddof=1, same full-window rule."""
    return F.when(full_window(x, w, n), F.stddev_samp(_c(x)).over(w.rowsBetween(-(n - 1), 0)))


def lag(x, w: WindowSpec, n: int = 1) -> Column:
    """W1 shift(n)."""
    return F.lag(_c(x), n).over(w)


def lead(x, w: WindowSpec, n: int = 1) -> Column:
    """W2 shift(-n)."""
    return F.lead(_c(x), n).over(w)


def diff(x, w: WindowSpec, n: int = 1) -> Column:
    """W3 diff()."""
    return _c(x) - lag(x, w, n)


def pct_change(x, w: WindowSpec, n: int = 1) -> Column:
    """W3 pct_change(): x / x[-n] − 1; NULL where the earlier value is 0 (the float library gives inf)."""
    return F.try_divide(_c(x), lag(x, w, n)) - F.lit(1.0)


def ewm_block_size(alpha: float) -> int:
    """Rows per EWM block: (1-α)^B <= e^-40, so a block's carry never needs the block before it."""
    return max(64, math.ceil(40.0 / -math.log(1.0 - alpha)))


def _common_block(alphas: list[float]) -> int | None:
    """One block size valid for every α: (1-α)^B <= e^-40 and (1-α)^-B far from overflow."""
    b = max(ewm_block_size(a) for a in alphas)
    return b if all(b * -math.log(1.0 - a) < 600.0 for a in alphas) else None


def ewm_many(df: DataFrame, specs: list[tuple[str, str, float]], keys: list[str], order: list[str]) -> DataFrame:
    """W6 recursive EWMs (adjust=False) of (input column, output column, span) in shared window passes:
    y0 = x0, y_t = (1-α) y_{t-1} + α x_t, α = 2/(span+1). Leading NULLs stay NULL, later NULLs carry the previous
    value (the recursion runs over the non-NULL observations).

    Evaluated without recursion or a UDF, as a block scan inside each key (a halo block of a series):

    * j = index of the observation among the key's non-NULL values, block b = j div B, k = j mod B;
    * in-block value loc_j = d^k Σ_{i in block, i<=j} c_i x_i d^(-k_i)  (d = 1-α; c = 1 for j=0, else α);
    * y_j = loc_j + d^(k+1) · loc_end(b-1), the previous block's last in-block value, read by a range frame.

    Because d^B <= e^-40, the older carry is below double precision, and the result matches the sequential
    recursion to ~1e-15 relative. All specs use one block size when one fits every span,
    so EWMs of the same input share their running-count, block-sum and carry windows (three Window
    operators per distinct input instead of three per EWM), and the projections are batched into a
    few ``select``s rather than one plan node per column.
    """
    alphas = {out: 2.0 / (float(span) + 1.0) for _, out, span in specs}
    common = _common_block(list(alphas.values()))
    w = series_window(keys, order)
    inputs = sorted({x for x, _, _ in specs})
    tag = {x: f"__ewmin{i}" for i, x in enumerate(inputs)}
    # 1. running observation count per input
    df = df.select("*", *[F.count(x).over(w.rowsBetween(UNB, CUR)).alias(f"{tag[x]}_n") for x in inputs])
    # 2. observation index and block per (input, block size)
    blocks = {}
    cols = []
    for x, out, _ in specs:
        b = common or ewm_block_size(alphas[out])
        key = (x, b)
        if key not in blocks:
            name = f"{tag[x]}_{b}"
            blocks[key] = name
            j = F.col(f"{tag[x]}_n") - 1
            cols += [j.alias(f"{name}_j"), F.floor(j / b).alias(f"{name}_b"),
                     (j - F.floor(j / b) * b).alias(f"{name}_k")]
    df = df.select("*", *cols)
    # 3. in-block running sums (one Window per (input, block size))
    loc = []
    for x, out, _ in specs:
        a = alphas[out]
        d = 1.0 - a
        name = blocks[(x, common or ewm_block_size(a))]
        j, k = F.col(f"{name}_j"), F.col(f"{name}_k")
        coef = F.when(j == 0, F.lit(1.0)).otherwise(F.lit(a))
        term = F.coalesce(coef * F.col(x) * F.pow(F.lit(d), -k), F.lit(0.0))
        wb = Window.partitionBy(*keys, f"{name}_b").orderBy(*order).rowsBetween(UNB, CUR)
        loc.append((F.pow(F.lit(d), k) * F.sum(term).over(wb)).alias(f"__ewmloc_{out}"))
    df = df.select("*", *loc)
    # 4. previous block's end value (range frame over the block number) and the result
    res = []
    for x, out, _ in specs:
        d = 1.0 - alphas[out]
        name = blocks[(x, common or ewm_block_size(alphas[out]))]
        j, k = F.col(f"{name}_j"), F.col(f"{name}_k")
        prev_end = F.max_by(F.col(f"__ewmloc_{out}"), j).over(
            Window.partitionBy(*keys).orderBy(f"{name}_b").rangeBetween(-1, -1))
        y = F.col(f"__ewmloc_{out}") + F.coalesce(F.pow(F.lit(d), k + 1) * prev_end, F.lit(0.0))
        res.append(F.when(F.col(f"{tag[x]}_n") > 0, y).alias(out))
    df = df.select("*", *res)
    temp = [c for c in df.columns if c.startswith("__ewmin") or c.startswith("__ewmloc_")]
    return df.drop(*temp)


def indexed(df: DataFrame, keys: list[str], time_col: str, out: str, min_rows: int = MIN_BLOCK_ROWS) -> DataFrame:
    """``df`` (materialised: it is read twice) with each row's 0-based place in its key's time order, by a blocked scan."""
    d = blocked(df.withColumn("__one", F.lit(1)), keys, time_col, min_rows)
    return (blocked_scan(d, keys, [time_col], sums={"__one": "__n"})
            .withColumn(out, (F.col("__n") - 1).cast("long")).drop("__one", "__n", BLOCK))


def halo_blocks(df: DataFrame, index: str, rows: int, back: int = 0, ahead: int = 0) -> DataFrame:
    """Blocks of ``rows`` consecutive rows (``__hb``), each also given the ``back`` rows before and the ``ahead`` rows
    after it (``__halo``), so that windows over (key, block) see all they need and no task holds a whole series. Drop
    the halo rows after the last window."""
    if back > rows or ahead > rows:
        raise ValueError("a halo must fit into one block")
    b, k = F.floor(F.col(index) / rows).cast("long"), F.col(index) % rows
    own = F.struct(b.alias("b"), F.lit(False).alias("halo"))
    after = F.when(k >= rows - back, F.struct((b + 1).alias("b"), F.lit(True).alias("halo")))
    prior = F.when((k < ahead) & (b > 0), F.struct((b - 1).alias("b"), F.lit(True).alias("halo")))
    return (df.withColumn("__c", F.explode(F.array_compact(F.array(own, after, prior))))
              .select(*df.columns, F.col("__c.b").alias("__hb"), F.col("__c.halo").alias("__halo")))


def without_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("__halo")).drop("__hb", "__halo")


def tail_n(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """W10 tail(n) per key (a window group limit: Catalyst keeps only n rows per key per task)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def chrono_split(df: DataFrame, keys: list[str], time_col: str, test_fraction: float = 0.2, out: str = "split",
                 min_rows: int = MIN_BLOCK_ROWS) -> DataFrame:
    """W11 train_test_split(shuffle=False): the last ceil(f·n) rows of each key are 'test'. ``df`` is read three times."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    d = indexed(df, keys, time_col, "__at", min_rows).join(n, keys)
    train = F.col("__n") - F.ceil(F.col("__n") * F.lit(test_fraction))
    return d.withColumn(out, F.when(F.col("__at") >= train, F.lit("test")).otherwise(F.lit("train"))).select(*df.columns, out)


def quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], names: list[str]) -> DataFrame:
    """Exact interpolated quantiles per key, one row each. An approximate pass brackets each rank within 0.4 % of
    the key's rows; the bracket's rows are counted by value (map-side, so equal values are one row a task) and the
    ranks selected from the running counts of its different values. ``df`` is read twice."""
    eps, share = 0.002, [x for p in probs for x in (max(p - 0.002, 0.0), min(p + 0.002, 1.0))]
    d = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__v"))
    cuts = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"),
                                F.percentile_approx("__v", F.array(*[F.lit(s) for s in share]), F.lit(5000)).alias("__c"))
    few = F.col("__n") * eps < 4                                # brackets of under four ranks: take the whole range
    parts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"),
                               F.when(few, F.col("__lo")).otherwise(F.get("__c", F.lit(2 * i))).alias("lo"),
                               F.when(few, F.col("__hi")).otherwise(F.get("__c", F.lit(2 * i + 1))).alias("hi"))
                      for i, p in enumerate(probs)])
    j = d.join(cuts.select(*keys, "__n", parts.alias("__p")), keys)
    below = (j.select(*keys, F.explode("__p").alias("q"), "__v").groupBy(*keys, F.col("q.i").alias("i"))
             .agg(F.sum((F.col("__v") < F.col("q.lo")).cast("long")).alias("__below")))
    near = (j.select(*keys, "__n", "__v", F.explode(F.filter("__p", lambda q: (F.col("__v") >= q["lo"]) & (F.col("__v") <= q["hi"]))).alias("q"))
            .groupBy(*keys, F.col("q.i").alias("i"), "__v").agg(F.count(F.lit(1)).alias("__c"), F.max("__n").alias("__n"), F.max("q.p").alias("p")))
    upto = Window.partitionBy(*keys, "i").orderBy("__v").rowsBetween(UNB, CUR)      # the bracket's different values only
    rank = near.withColumn("__upto", F.sum("__c").over(upto)).join(below, [*keys, "i"]).withColumn("__upto", F.col("__upto") + F.col("__below"))
    at = (F.col("__n") - 1) * F.col("p")
    # the value of 0-based rank r is the first one with more than r rows up to it
    both = rank.groupBy(*keys, "i").agg(F.min(F.when(F.col("__upto") > F.floor(at), F.col("__v"))).alias("a"),
                                        F.min(F.when(F.col("__upto") > F.ceil(at), F.col("__v"))).alias("b"),
                                        F.max(at - F.floor(at)).alias("f"))
    got = both.withColumn("x", F.col("a") + (F.col("b") - F.col("a")) * F.col("f"))
    return got.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.col("x"))).alias(o) for i, o in enumerate(names)])
