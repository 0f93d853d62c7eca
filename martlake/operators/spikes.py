"""Spike detection and segment lift.

Predictions are joined back to the feature rows by ``val_index`` (J5).
Scalar thresholds (cut-off date, prediction quantile) are one-row
aggregates joined by broadcast; the spike-date set is bounded by the number
of distinct dates, and the segment tables by the number of segments, so the
broadcasts there are size-bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.operators.clean import quantiles



def attach_rows(pred: DataFrame, full: DataFrame, cols, idx: str = "val_index") -> DataFrame:
    """Look up row attributes of the prediction positions."""
    return pred.join(full.select(idx, *cols), idx, "left")


def spike_dates(pred: DataFrame, ts: str = "InvoiceDate", yhat: str = "y_pred",
                days: int = 60, q: float = 0.99) -> DataFrame:
    """Cut-off = max date - ``days``; threshold = q-quantile of the
    predictions on or after the cut-off; distinct dates of those recent rows
    predicted above the threshold."""
    cut = pred.agg((F.max(ts) - F.make_interval(days=F.lit(days))).alias("_cut"))
    recent = pred.crossJoin(F.broadcast(cut)).where(F.col(ts) >= F.col("_cut"))
    thr = quantiles(recent, [yhat], [q]).select(F.col(f"{yhat}_q0").alias("_thr"))
    return (recent.crossJoin(F.broadcast(thr)).where(F.col(yhat) > F.col("_thr"))
            .select(ts).distinct())


def segment_lift(pred: DataFrame, full: DataFrame, dates: DataFrame, ts: str = "InvoiceDate",
                 customer: str = "CustomerID", seg: str = "RFM_Cluster") -> DataFrame:
    """Segment mix of the customers buying on spike dates vs all
    customers: NumClients, Share, TotalClients, TotalShare, Lift."""
    # Rows on spike dates (time stamps, so their number grows with the data: no hint)
    buyers = pred.join(dates, ts, "left_semi").select(customer) \
        .where(F.col(customer).isNotNull())
    # One segment row per customer (the segment is a function of the
    # customer, so min() is that value; an aggregate combines map-side)
    cust_seg = (full.select(customer, seg).where(F.col(customer).isNotNull())
                .groupBy(customer).agg(F.min(seg).alias(seg)))
    spike = (buyers.join(cust_seg, customer, "left").where(F.col(seg).isNotNull()).groupBy(seg)
             .agg(F.count_distinct(customer).alias("NumClients")))
    spike = spike.withColumn("Share", F.col("NumClients") / F.sum("NumClients").over(Window.partitionBy()))
    allc = (full.select(customer, seg).where(F.col(customer).isNotNull() & F.col(seg).isNotNull())
            .groupBy(seg).agg(F.count_distinct(customer).alias("TotalClients")))
    allc = allc.withColumn("TotalShare", F.col("TotalClients") / F.sum("TotalClients").over(Window.partitionBy()))
    # Two tables with one row per segment
    return (spike.join(F.broadcast(allc), seg, "left")
            .withColumn("Lift", F.try_divide(F.col("Share"), F.col("TotalShare"))))


def weekly_cluster_sunday(pred: DataFrame, ts: str = "InvoiceDate", seg: str = "RFM_Cluster",
                          yhat: str = "y_pred", top: int = 3) -> DataFrame:
    """A15(a): predictions summed by (date, segment), then by week labelled
    with its closing Sunday; only the ``top`` segments by total kept."""
    daily = pred.where(F.col(seg).isNotNull()).groupBy(ts, seg).agg(F.sum(yhat).alias(yhat))
    week = F.date_trunc("week", ts) + F.make_interval(days=F.lit(6))
    weekly = daily.groupBy(week.alias("week_end"), seg).agg(F.sum(yhat).alias(yhat))
    return _keep_top_segments(weekly, seg, yhat, top)


def weekly_cluster_monday(pred: DataFrame, ts: str = "InvoiceDate", seg: str = "RFM_Cluster",
                          y: str = "y_true", yhat: str = "y_pred", top: int = 3) -> DataFrame:
    """A15(b): sums of truth and prediction by (week start Monday, segment);
    top segments by predicted total."""
    weekly = (pred.where(F.col(seg).isNotNull())
              .groupBy(F.date_trunc("week", ts).alias("week_start"), seg)
              .agg(F.sum(y).alias("y_true_sum"), F.sum(yhat).alias("y_pred_sum")))
    return _keep_top_segments(weekly, seg, "y_pred_sum", top)


def _keep_top_segments(weekly: DataFrame, seg: str, val: str, top: int) -> DataFrame:
    tops = (weekly.groupBy(seg).agg(F.sum(val).alias("_t"))
            .orderBy(F.desc("_t"), F.asc(seg)).limit(top).select(seg))
    return weekly.join(F.broadcast(tops), seg, "left_semi")
