"""RFM segmentation.

The customer table is an aggregate of the facts (one row per customer); the
reference date (max date + 1 day) is a one-row aggregate joined by broadcast.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.scalars import whole_days_between
from martlake.operators.clean import drop_nulls, quantiles, within_quantile_band
from martlake.session import drop_table, is_staged, stage_table

RFM_COLS = ("Recency", "Frequency", "Monetary")
# Reference k-means stopping rule: at most 300 iterations, stop when the
# summed squared centre shift <= 1e-4 x mean feature variance (1 after
# standard scaling).  Spark stops when EVERY centre moves <= tol, so
# tol = 1e-2 / sqrt(k) implies the reference condition.
KMEANS_MAX_ITER = 300


def kmeans_tol(k: int, rel_tol: float = 1e-4) -> float:
    return (rel_tol / k) ** 0.5


def rfm_input(df: DataFrame, customer: str = "CustomerID", qty: str = "Quantity",
              price: str = "UnitPrice") -> DataFrame:
    """P7 + P5 + P8: non-null customers, positive quantity and price, inside
    the [q01, q99] band of both (bounds computed before filtering)."""
    d = drop_nulls(df, [customer]).where((F.col(qty) > 0) & (F.col(price) > 0))
    # the filter of a staged table is read again, not copied
    return within_quantile_band(d, [qty, price], copy=not is_staged(df))


def rfm_table(df: DataFrame, customer: str = "CustomerID", invoice: str = "InvoiceNo",
              ts: str = "InvoiceDate", qty: str = "Quantity", price: str = "UnitPrice",
              as_of: str | None = None) -> DataFrame:
    """A1: Recency = whole days from the last purchase to (global max + 1 day);
    Frequency = distinct invoices; Monetary = sum of quantity x price.
    ``as_of`` leaves out rows from that time on, so that segments used as
    features of later rows do not know them."""
    if as_of is not None:
        df = df.where(F.col(ts) < F.lit(as_of).cast("timestamp_ntz"))
    ref = df.agg((F.max(ts) + F.expr("INTERVAL 1 DAY")).alias("_ref"))
    g = (df.where(F.col(customer).isNotNull())
         .groupBy(customer)
         .agg(F.max(ts).alias("_last"), F.count_distinct(invoice).alias("Frequency"),
              F.sum(F.col(qty) * F.col(price)).alias("Monetary")))
    return (g.crossJoin(F.broadcast(ref))
            .select(customer, whole_days_between("_last", "_ref").alias("Recency"),
                    "Frequency", "Monetary"))


def scaler_stats(df: DataFrame, cols) -> DataFrame:
    """M1/M2: one-row mean and population std per column (std 0 -> 1, as a
    standard scaler does for constant columns)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__sd")]
    one = df.agg(*aggs)
    return one.select(*[F.col(f"{c}__mean") for c in cols] + [
        F.when(F.col(f"{c}__sd") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__sd")).alias(f"{c}__sd")
        for c in cols])


def scale(df: DataFrame, stats: DataFrame, cols, suffix: str = "_scaled") -> DataFrame:
    """M1/M2: (x - mean) / std with statistics fitted elsewhere (e.g. the
    training side); ``stats`` is one row, joined by broadcast."""
    out = df.crossJoin(F.broadcast(stats)).withColumns(
        {f"{c}{suffix}": (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__sd") for c in cols})
    return out.drop(*stats.columns)


def unscale(df: DataFrame, stats: DataFrame, col: str, stat_col: str, out: str | None = None) -> DataFrame:
    """M2: inverse of ``scale`` for one column using the stats of ``stat_col``."""
    o = df.crossJoin(F.broadcast(stats.select(f"{stat_col}__mean", f"{stat_col}__sd")))
    return o.withColumn(out or col, F.col(col) * F.col(f"{stat_col}__sd") + F.col(f"{stat_col}__mean")) \
        .drop(f"{stat_col}__mean", f"{stat_col}__sd")


def rfm_scaled(rfm: DataFrame, cols=RFM_COLS) -> DataFrame:
    """M1 on the RFM table."""
    return scale(rfm, scaler_stats(rfm, cols), cols)


def rule_segments(rfm: DataFrame, col: str = "Monetary", out: str = "RFM_Cluster") -> DataFrame:
    """Deterministic 3-segment label by the 1/3 and 2/3 percentiles of
    Monetary (0 = low, 1 = mid, 2 = high); the SQL-checkable stand-in for
    the k-means label in the minimum slice."""
    cuts = quantiles(rfm, [col], [1 / 3, 2 / 3]).select(F.col(f"{col}_q0").alias("_c1"),
                                                         F.col(f"{col}_q1").alias("_c2"))
    return (rfm.crossJoin(F.broadcast(cuts))
            .withColumn(out, F.when(F.col(col) <= F.col("_c1"), F.lit(0))
                        .when(F.col(col) <= F.col("_c2"), F.lit(1)).otherwise(F.lit(2)))
            .drop("_c1", "_c2"))


def kmeans_segments(rfm: DataFrame, k: int = 3, seed: int = 42, cols=RFM_COLS,
                    out: str = "RFM_Cluster") -> DataFrame:
    """M3: k-means (MLlib) on standard-scaled R/F/M.  Cluster ids are
    relabelled by ascending mean Monetary, so ids are stable across runs."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    scaled = rfm_scaled(rfm, cols)
    # one row per customer; a table, because k-means passes over it many times
    feats = VectorAssembler(inputCols=[f"{c}_scaled" for c in cols], outputCol="_features") \
        .transform(stage_table(scaled, "rfm"))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="_raw",
                   maxIter=KMEANS_MAX_ITER, tol=kmeans_tol(k)).fit(feats)
    pred = model.transform(feats)
    # relabel: rank clusters by mean Monetary (k rows)
    order = pred.groupBy("_raw").agg(F.avg("Monetary").alias("_m"))
    order = order.withColumn(out, (F.row_number().over(Window.orderBy("_m", "_raw")) - 1).cast("int"))
    return (pred.join(F.broadcast(order.select("_raw", out)), "_raw")
            .drop("_raw", "_features", *[f"{c}_scaled" for c in cols]))


def _distance(cols, center):
    """Squared distance of a row to a centre."""
    return reduce(lambda x, y: x + y, [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v)))
                                       for c, v in zip(cols, center, strict=True)])


def _nearest(cols, centers):
    """(squared distance, number) of the nearest of a few centres; the first of equals."""
    return F.array_min(F.array(*[F.struct(_distance(cols, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)]))


def spread_centers(points: DataFrame, cols, k: int, seed: int = 42) -> list[tuple]:
    """k starting centres, spread as k-means++ does: each next one is a row drawn with a chance in
    proportion to its squared distance from those before.  A row's draw is a race, ``-ln(u) / distance``
    with u from a hash of the row, so each centre is one aggregate and a seed gives the same centres."""
    u = lambda n: (F.pmod(F.xxhash64(F.lit(seed + n), *cols), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    centers = [tuple(points.agg(F.min(F.struct(u(0).alias("u"), *cols)).alias("c")).first()["c"][1:])]
    while len(centers) < k:
        d = _nearest(cols, centers)["d"]
        race = F.when(d > 0, -F.log(u(len(centers))) / d)
        found = points.agg(F.min(F.when(race.isNotNull(), F.struct(race.alias("r"), *cols))).alias("c")).first()["c"]
        if found is None:       # fewer different rows than centres
            break
        centers.append(tuple(found[1:]))
    return centers


def lloyd_all(points: DataFrame, cols, starts: dict[int, list[tuple]], max_iter: int = KMEANS_MAX_ITER,
              tol: float = 1e-4) -> dict[int, tuple[list[tuple], float]]:
    """k-means for several k together: k -> (centres, within-cluster sum of squares).

    One aggregate per iteration over (k, cluster) serves every k that still moves: a task sums its rows
    for all of them, and the sums of the tasks meet by (k, cluster).  A k is done when its
    centres have moved by ``tol`` or less, squared and summed.  A cluster without rows keeps its centre.
    The last aggregate gives the costs of all k."""
    centers = {k: list(c) for k, c in starts.items()}

    cols = list(cols)

    def assigned(ks):
        held = {k: np.array(centers[k], np.float64) for k in ks}

        def sums(batches):
            total = {k: np.zeros((len(at), len(cols) + 2)) for k, at in held.items()}      # sums, rows, cost by cluster
            for batch in batches:
                x = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                for k, at in held.items():
                    d = reduce(np.add, [(v[:, None] - at[None, :, j]) ** 2 for j, v in enumerate(x)])
                    i = d.argmin(axis=1)        # the first of equals
                    parts = [*x, None, d[np.arange(len(i)), i]]
                    total[k] += np.column_stack([np.bincount(i, weights=p, minlength=len(at)) for p in parts])
            rows = [(k, i, *map(float, r)) for k, t in total.items() for i, r in enumerate(t) if r[len(cols)]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["k", "i", *cols, "n", "cost"])

        ddl = ", ".join(["k long", "i long", *[f"`{c}` double" for c in cols], "n double", "cost double"])
        return points.select(*cols).mapInArrow(sums, ddl).groupBy("k", "i").agg(
            *[(F.sum(c) / F.sum("n")).alias(c) for c in cols], F.sum("cost").alias("cost"))

    moving = sorted(k for k in centers if k > 0)
    for _ in range(max_iter):
        if not moving:
            break
        new = {k: list(centers[k]) for k in moving}
        for r in assigned(moving).collect():        # sum of all k rows
            new[r["k"]][r["i"]] = tuple(r[c] for c in cols)
        shift = {k: sum((x - y) ** 2 for a, b in zip(centers[k], new[k], strict=True) for x, y in zip(a, b, strict=True))
                 for k in moving}
        centers |= new
        moving = [k for k in moving if shift[k] > tol]
    costs: dict[int, float] = {}
    for r in assigned(sorted(centers)).collect():
        costs[r["k"]] = costs.get(r["k"], 0.0) + r["cost"]
    return {k: (centers[k], costs.get(k, 0.0)) for k in centers}


def elbow_table(rfm: DataFrame, ks=range(1, 11), seed: int = 42, cols=RFM_COLS) -> DataFrame:
    """M4: within-cluster sum of squares for each k on the scaled R/F/M, all k in one pass per iteration.

    The centres of a smaller k start as the first ones of the largest."""
    sc = [f"{c}_scaled" for c in cols]
    points = stage_table(rfm_scaled(rfm, cols).select(*sc).dropna(), "elbow")
    ks = sorted(set(ks))
    first = spread_centers(points, sc, ks[-1], seed) if not points.isEmpty() else []
    fits = lloyd_all(points, sc, {k: first[:k] for k in ks}) if first else {k: ([], 0.0) for k in ks}
    drop_table(points)
    return rfm.sparkSession.createDataFrame([(int(k), float(fits[k][1])) for k in ks], "k int, inertia double")


def cluster_profile(seg: DataFrame, key: str = "RFM_Cluster", customer: str = "CustomerID") -> DataFrame:
    """A2: customers and mean R/F/M per cluster."""
    return seg.groupBy(key).agg(F.count(customer).alias("Customers"),
                                F.avg("Recency").alias("Recency_Mean"),
                                F.avg("Frequency").alias("Frequency_Mean"),
                                F.avg("Monetary").alias("Monetary_Mean"))


def attach_segment(df: DataFrame, seg: DataFrame, customer: str = "CustomerID",
                   key: str = "RFM_Cluster") -> DataFrame:
    """Left join of the customer's segment onto the rows.  The segment
    table has one row per customer; AQE broadcasts it when it is small and
    keeps a shuffle join when the customer base is large."""
    return df.join(seg.select(customer, key), customer, "left")
