"""Aggregations over the fact table.

Global statistics are one-row aggregates; when they feed back into rows they
are joined by broadcast (one row, size never grows).  Per-group statistics
are hash aggregates (partial + final), joined back on the group key, which
AQE can split when one key is hot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions import scalars as S
from martlake.session import passing_tables, stage_table

# Fixed label order of the reference weekday table (Monday first).
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def value_counts(df: DataFrame, col: str, share: bool = True) -> DataFrame:
    """A5: count per non-null value, descending (ties by value), optional share.
    The total is a one-row aggregate joined by broadcast (no single-partition
    window over the distinct values, whose number grows with the data)."""
    g = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if share:
        total = g.agg(F.sum("count").alias("_total"))
        g = g.crossJoin(F.broadcast(total)).withColumn("share", F.col("count") / F.col("_total")).drop("_total")
    return g.orderBy(F.desc("count"), F.asc(col))


def top_k_by_count(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k most frequent values (ties broken by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(k))


def flag_popular(df: DataFrame, col: str = "StockCode", k: int = 10,
                 out: str = "IsPopularItem", rows: DataFrame | None = None) -> DataFrame:
    """1 when the row's item is among the k most frequent items (of ``rows``,
    ``df`` itself when none are given), else 0.
    The top-k table has exactly k rows, so its broadcast is bounded."""
    top = top_k_by_count(df if rows is None else rows, col, k).select(col, F.lit(1).alias(out))
    return df.join(F.broadcast(top), col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def group_median(df: DataFrame, key: str, col: str, out: str = "median",
                 accuracy: int | None = None) -> DataFrame:
    """A10: median of ``col`` per ``key`` (exact, linear interpolation;
    ``accuracy`` gives ``percentile_approx`` instead); see ``clean.quantiles``."""
    from martlake.operators.clean import quantiles

    return quantiles(df, [col], [0.5], by=[key], accuracy=accuracy).withColumnRenamed(f"{col}_q0", out)


def flag_below_group_median(df: DataFrame, key: str = "StockCode", col: str = "UnitPrice",
                            out: str = "IsDiscounted") -> DataFrame:
    """1 when the value is below its group's median (NULL group -> 0).
    Aggregate + equi-join instead of a window, so a hot key is combined
    map-side and the join can be split by AQE's skew handling."""
    # a table of its own: the passes behind a median leave no shuffle files to the join
    with passing_tables() as passing:
        med = passing.keep(stage_table(group_median(df, key, col, "_grp_median"), "medians"))
    return (df.join(med, key, "left")
            .withColumn(out, F.coalesce((F.col(col) < F.col("_grp_median")).cast("int"), F.lit(0)))
            .drop("_grp_median"))


def mean_by(df: DataFrame, key_expr, col: str = "Quantity", key_name: str = "key",
            out: str = "mean_quantity") -> DataFrame:
    """A4: mean of ``col`` per calendar key (month number, weekday, year-month)."""
    return df.groupBy(key_expr.alias(key_name)).agg(F.avg(col).alias(out))


def weekday_means(df: DataFrame, ts: str = "InvoiceDate", col: str = "Quantity") -> DataFrame:
    """Weekday means reindexed to Monday..Sunday; absent days are NULL.
    The 7-row weekday dimension is generated in the plan and left-joined."""
    agg = df.groupBy(S.weekday_1_7(ts).alias("day_no")).agg(F.avg(col).alias("mean_quantity"))
    days = (df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(7))).alias("day_no"))
            .withColumn("weekday", F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]),
                                                F.col("day_no"))))
    return days.join(F.broadcast(agg), "day_no", "left").orderBy("day_no")


def top_sum(df: DataFrame, key: str = "Description", col: str = "Quantity", k: int = 10,
            out: str = "total_quantity") -> DataFrame:
    """Total per key, top k descending (ties by key)."""
    return (df.groupBy(key).agg(F.sum(col).alias(out))
            .orderBy(F.desc(out), F.asc_nulls_last(key)).limit(k))


def pivot_count(df: DataFrame, row: str, col: str, values) -> DataFrame:
    """Counts of row x col, one column per listed value, missing -> 0.
    The value list is given so Spark does not run a job to discover it."""
    p = df.groupBy(row).pivot(col, list(values)).count()
    return p.fillna(0, subset=[str(v) for v in values])


def profile_summary(df: DataFrame, cols) -> DataFrame:
    """Count, mean, std (sample), min, q25, median, q75, max per numeric
    column.  One aggregate pass for the moments (no unpivot of the facts),
    exact quartiles from ``clean.quantiles``; the one-row result is unpivoted
    with ``stack``."""
    from martlake.operators.clean import quantiles

    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    one = df.agg(*aggs).crossJoin(quantiles(df, cols, [0.25, 0.5, 0.75]))
    parts = ", ".join(
        f"'{c}', `{c}__count`, `{c}__mean`, `{c}__std`, `{c}__min`, `{c}_q0`, `{c}_q1`, "
        f"`{c}_q2`, `{c}__max`" for c in cols)
    return one.selectExpr(
        f"stack({len(cols)}, {parts}) as (column_name, count, mean, std, min, q25, q50, q75, max)")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from min to max, the last bin closed; only
    non-empty bins appear.  bin = least(floor((x-lo)/(hi-lo)*bins)+1, bins)."""
    mm = df.agg(F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))
    x = F.col(col).cast("double")
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / width * bins) + 1, F.lit(bins)))
    return (df.where(F.col(col).isNotNull()).crossJoin(F.broadcast(mm))
            .groupBy(b.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"), F.first("_lo").alias("lo"), F.first("_hi").alias("hi"))
            .select("bin", (F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins)
                    .alias("bin_start"), "count"))


# report section: (grouping column, rows ranked by, rows kept)
REPORT = {"country": ("Country", "n", None), "month": ("Month", None, None), "weekday": ("Weekday", None, None),
          "product": ("Description", "total", 10), "quantity": ("Quantity_", None, None)}


def exploration_report(df: DataFrame, ts: str = "InvoiceDate", col: str = "Quantity", bins: int = 50) -> DataFrame:
    """The tables behind the exploration charts as one long table (section, item, n, total, mean), from one
    scan of the facts: rows per country, mean quantity per month and weekday, the top products by quantity, the
    quantity histogram (item: number of the bin) and the totals (item: NULL).

    One aggregate over grouping sets combines all of it in the map tasks; what follows reads its result,
    one row per value.  A value of the quantity is a group of its own, so that the bins, whose bounds are
    known only afterwards, need no second scan."""
    from martlake.session import stage_table

    q = F.col(col)
    facts = df.select("Country", "Description", F.month(ts).alias("Month"), S.weekday_1_7(ts).alias("Weekday"),
                      q.alias("Quantity_"), q.alias("_q"))
    columns = [c for c, _, _ in REPORT.values()]
    sets = [[c] for c in columns] + [[]]
    grouped = facts.groupingSets([[F.col(c) for c in x] for x in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_id"), F.count(F.lit(1)).alias("n"), F.sum("_q").alias("total"), F.avg("_q").alias("mean"))
    grouped = stage_table(grouped, "report")
    every = (1 << len(columns)) - 1
    out = [grouped.where(F.col("_id") == every).select(F.lit("all").alias("section"), F.lit(None).cast("string").alias("item"),
                                                       "n", "total", "mean")]
    for i, (section, (c, order, k)) in enumerate(REPORT.items()):
        mine = grouped.where(F.col("_id") == every - (1 << (len(columns) - 1 - i)))
        if section == "quantity":
            x = F.col(c).cast("double")
            ends = mine.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
            at = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(F.least(
                F.floor((x - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins) + 1, F.lit(bins)))
            mine = (mine.where(F.col(c).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias(c))
                    .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).withColumn("mean", F.col("total") / F.col("n")))
        if k:
            mine = mine.orderBy(F.desc(order), F.asc_nulls_last(c)).limit(k)
        out.append(mine.select(F.lit(section).alias("section"), F.col(c).cast("string").alias("item"), "n", "total", "mean"))
    return reduce(DataFrame.unionByName, out)


def distinct_sketches(df: DataFrame, day, cols, lg_k: int = 14) -> DataFrame:
    """Per day, a mergeable sketch of the distinct values of each column; kept as a table, any range of days
    is answered from it.  The error of a merged count is about 1.04 / sqrt(2 ** lg_k): 0.8 percent."""
    return df.groupBy(day.alias("day")).agg(
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(c) for c in cols])


def merged_distinct(sketches: DataFrame, key, cols) -> DataFrame:
    """Approximate distinct counts of each group of days, from their sketches."""
    return sketches.groupBy(key).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in cols])
