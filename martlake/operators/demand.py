"""Demand series and its lag / rolling features (A3, W1–W6, J2) and the
scalable row index (W9).

Physical plan: the fact rows are first reduced to the (date, item) series by
a hash aggregate (map-side combine), so only the series is shuffled by item
for the windows.  All windows share one ``WindowSpec`` (item, date), so Spark
sorts the series once and evaluates every lag / rolling column in one Window
pass per frame.  Global quantile bounds are one-row aggregates joined back by
broadcast; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.scalars import STD_ZERO_GUARD, clip
from martlake.operators.clean import quantile_bounds
from martlake.session import drop_table, is_staged, passing_tables, stage_table

# Fixed values of the reference feature set (script form and notebook form).
FULL_LAGS = (1, 7, 14, 30, 60)
FULL_WINDOWS = (7, 14, 30, 60)
SIMPLE_LAGS = (1, 7, 30)
SIMPLE_WINDOWS = (7, 30)


def feature_names() -> list:
    """The features of the script form."""
    return ([f"Lag_{n}" for n in FULL_LAGS] + [f"PctChange_{n}" for n in FULL_LAGS if n != 1]
            + [f"{c}_{n}" for c in ("RollingNormMean", "RollingRange", "RollingPctChange") for n in FULL_WINDOWS])


def demand_series(df: DataFrame, ts: str = "InvoiceDate", item: str = "StockCode",
                  qty: str = "Quantity", price: str = "UnitPrice",
                  positive_only: bool = True) -> DataFrame:
    """A3: sum of quantity per (timestamp, item) over positive rows, named
    ``Quantity_Agg``.  Steps are transactions (timestamps), not days."""
    if positive_only:
        df = df.where((F.col(qty) > 0) & (F.col(price) > 0))
    return df.groupBy(ts, item).agg(F.sum(qty).alias("Quantity_Agg"))


def _item_blocks(series: DataFrame, item: str, ts: str, halo: int, block_size: int):
    """Series rows with their position inside the item (``_ipos``), cut into
    blocks of ``block_size`` positions per item; the last ``halo`` rows of a
    block are repeated in the next block (``_halo``).  Positions come from the
    distributed row index over (item, ts), so no task holds a whole item."""
    if block_size < halo:
        raise ValueError(f"block_size ({block_size}) must cover the look-back ({halo})")
    g = row_index(series, [item, ts], out="_gpos")
    start = g.groupBy(item).agg(F.min("_gpos").alias("_start"))     # one row per item
    g = g.join(start, item).withColumn("_ipos", F.col("_gpos") - F.col("_start")).drop("_gpos", "_start")
    blk = F.floor(F.col("_ipos") / block_size)
    own = g.withColumn("_blk", blk).withColumn("_halo", F.lit(False))
    tail = (g.where(F.pmod(F.col("_ipos"), F.lit(block_size)) >= block_size - halo)
            .withColumn("_blk", blk + 1).withColumn("_halo", F.lit(True)))
    w = Window.partitionBy(item, "_blk").orderBy("_ipos")
    return own.unionByName(tail), w


def demand_features(series: DataFrame, item: str = "StockCode", ts: str = "InvoiceDate",
                    x: str = "Quantity_Agg", lags=FULL_LAGS, windows=FULL_WINDOWS,
                    variant: str = "full", block_size: int | None = 1 << 16,
                    adaptive: bool = True, only=None) -> DataFrame:
    """W1–W6 over the series, one row per (ts, item); ``only`` names the features that are
    asked for, and what none of them needs is not computed.

    variant='full' (script form):
      Lag_n           lag by n rows, clipped to the series' [q01, q99], missing -> 0
      RollingNormMean mean / sample std over the last n rows (std missing -> 1,
                      0 -> 1e-9), clipped to its own [q01, q99]
      RollingRange    max - min over the last n rows, clipped to its own [q01, q99]
      RollingPctChange x / lag(x, n) - 1, missing -> 0, clipped to [-1, 1]
      PctChange_n     (Lag_1 - Lag_n) / Lag_n (0 -> missing -> 0), clipped to [-1, 1]
    variant='simple' (notebook form): the norm-mean has no zero guard (a zero
    std gives +inf, so the clip yields the upper bound) and is clipped with the
    series' quantity bounds; the range is clipped to [0, q99]; no pct change.

    ``block_size`` makes the windows skew-safe and exact via item blocks with
    a halo of the longest look-back; ``None`` windows by item only.  With
    ``adaptive`` the blocks are used only when the longest item series
    exceeds one block.  Quantile bounds are taken over own rows only (halo
    copies excluded).
    """
    table, finish = demand_windows(series, item, ts, x, lags, windows, variant, block_size, adaptive, only)
    return finish(table)


def demand_windows(series: DataFrame, item: str = "StockCode", ts: str = "InvoiceDate",
                   x: str = "Quantity_Agg", lags=FULL_LAGS, windows=FULL_WINDOWS,
                   variant: str = "full", block_size: int | None = 1 << 16,
                   adaptive: bool = True, only=None):
    """:func:`demand_features` in two steps: a table of what takes a window, (ts, item, x, plain lags, norm
    means and ranges), and the function that turns its columns into the features, row by
    row.  A join of the table carries less than one of the features."""
    asked = lambda name: only is None or name in only
    max_back = max(list(lags) + [n - 1 for n in windows] + [n for n in windows] + [0])
    # the series feeds the bounds, the block check and the windows: write it
    # once (it is an aggregate, far smaller than the facts) so every branch
    # starts from the table instead of re-running the upstream plan
    own = not is_staged(series)
    if own:
        series = stage_table(series, "demand")
    if block_size and adaptive:
        # runtime choice (one small aggregate): blocks only when some item's
        # series is longer than a block; both plans give identical results
        longest = series.groupBy(item).count().agg(F.max("count")).first()[0] or 0
        if longest <= block_size:
            block_size = None
    # of own rows: every row of the series once
    b0 = quantile_bounds(series, [x]).select(F.col(f"{x}_lo").alias("_q_lo"), F.col(f"{x}_hi").alias("_q_hi"))
    # a change needs its lag and the first one
    shown = [n for n in lags if asked(f"Lag_{n}") or asked(f"PctChange_{n}")
             or (n == 1 and any(asked(f"PctChange_{m}") for m in lags))]
    changes = [n for n in windows if variant == "full" and asked(f"RollingPctChange_{n}")]
    means = [n for n in windows if asked(f"RollingNormMean_{n}")]
    ranges = [n for n in windows if asked(f"RollingRange_{n}")]

    def windowed():
        if block_size:
            # skew-safe: windows run over (item, block of item positions) with a
            # halo of the preceding rows, so one hot item is split across tasks
            s, w = _item_blocks(series, item, ts, max_back, block_size)
        else:
            s, w = series, Window.partitionBy(item).orderBy(ts)
        cols = {f"_lag_{n}": F.lag(x, n).over(w) for n in sorted({*shown, *changes})}
        if variant != "full":
            s = s.crossJoin(F.broadcast(b0))
        for n in sorted({*means, *ranges}):
            frame = w.rowsBetween(-(n - 1), 0)
            mean = F.avg(x).over(frame)
            std = F.coalesce(F.stddev_samp(x).over(frame), F.lit(1.0))
            if n in ranges:
                cols[f"_rr_{n}"] = (F.max(x).over(frame) - F.min(x).over(frame)).cast("double")
            if n in means and variant == "full":
                cols[f"_rnm_{n}"] = mean / F.when(std == 0, F.lit(STD_ZERO_GUARD)).otherwise(std)
            elif n in means:
                # mean > 0 on positive series, so mean / 0 is +inf and clips to q_hi
                cols[f"_rnm_{n}"] = F.when(std == 0, F.col("_q_hi")).otherwise(mean / std)
        out = s.withColumns(cols)
        return (out.where(~F.col("_halo")) if block_size else out).select(ts, item, x, *cols)

    bounds = b0
    raw = [*(f"_rnm_{n}" for n in means), *(f"_rr_{n}" for n in ranges)] if variant == "full" else []
    if raw:
        # the windowed series feeds its own quantiles and the output
        with passing_tables() as passing:
            table = passing.keep(stage_table(windowed(), "series"))
        if own:
            drop_table(series)
        # second-stage quantiles of the rolling columns themselves (one row)
        bounds = bounds.crossJoin(quantile_bounds(table, raw))
    else:
        table = windowed()

    def finish(df):
        own = [c for c in df.columns if not c.startswith(("_lag_", "_rnm_", "_rr_"))]
        within = lambda c: clip(c, F.col(f"{c}_lo"), F.col(f"{c}_hi"))
        cols = {f"Lag_{n}": F.coalesce(clip(f"_lag_{n}", F.col("_q_lo"), F.col("_q_hi")), F.lit(0.0)) for n in shown}
        for n in windows:
            if n in changes:
                cols[f"RollingPctChange_{n}"] = clip(
                    F.coalesce(F.try_divide(F.col(x), F.col(f"_lag_{n}")) - 1, F.lit(0.0)), -1.0, 1.0)
            if n in means:
                cols[f"RollingNormMean_{n}"] = (within(f"_rnm_{n}") if variant == "full" else
                                                clip(f"_rnm_{n}", F.col("_q_lo"), F.col("_q_hi")))
            if n in ranges:
                cols[f"RollingRange_{n}"] = F.coalesce(within(f"_rr_{n}") if variant == "full" else
                                                       clip(f"_rr_{n}", F.lit(0.0), F.col("_q_hi")), F.lit(0.0))
        out = df.crossJoin(F.broadcast(bounds)).withColumns(cols)
        if 1 in lags:
            out = out.withColumns({f"PctChange_{n}": clip(F.coalesce(
                F.try_divide(F.col("Lag_1") - F.col(f"Lag_{n}"), F.nullif(F.col(f"Lag_{n}"), F.lit(0.0))),
                F.lit(0.0)), -1.0, 1.0) for n in shown if n != 1 and asked(f"PctChange_{n}")})
        made = ("Lag_", "RollingNormMean_", "RollingRange_", "RollingPctChange_", "PctChange_")
        return out.select(*own, *[c for c in out.columns if c not in own and c.startswith(made) and asked(c)])

    return table, finish


def join_series_features(facts: DataFrame, features: DataFrame, ts: str = "InvoiceDate",
                         item: str = "StockCode", finish=None) -> DataFrame:
    """Left join of the per-(ts, item) features back to the fact rows.
    The feature side has one row per key, so the fact row count is kept.

    With ``finish``, ``features`` is the table of ``demand_windows``: the features are computed
    after the join, and rows without a series entry are left out."""
    if finish is not None:
        return finish(facts.join(features, [ts, item]))
    return facts.join(features.drop("Quantity_Agg"), [ts, item], "left")


def row_index(df: DataFrame, order, out: str = "val_index",
              num_partitions: int | None = None, keep=None) -> DataFrame:
    """0-based position of every row in a total order (``order`` must be
    total, e.g. the date plus tie keys).  ``keep``: the columns of ``df`` that the
    result has, all when none are named.

    Scalable form, no single-partition window: range-partition on the full
    order (sampling splits even one hot date across tasks), sort within
    partitions, and take each row's position inside its partition; the
    partitions are written to the shared folder so positions are stable,
    then a tiny per-partition count table gives every partition its offset.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # read twice: for the range bounds, then for the sort
    src = df if is_staged(df) else stage_table(df, "unindexed")
    s = (src.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = stage_table(s if keep is None else s.select(*keep, "_pid", "_mid"), "indexed")
    if src is not df:
        drop_table(src)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: an unpartitioned window here is bounded by n
    offs = counts.select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt"))
                         .alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (s.join(F.broadcast(offs), "_pid")
            .withColumn(out, F.col("_off") + pos)
            .drop("_pid", "_mid", "_off"))
