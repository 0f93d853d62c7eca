"""Retail operators against brute-force restatements on small frames."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from martlake.operators import aggregates as A
from martlake.operators import demand as D
from martlake.operators import evaluation as E
from martlake.operators import rfm as R
from martlake.operators import sequences as SQ


def test_rfm_recency_frequency_monetary(spark):
    rows = [("i1", 1, dt.datetime(2011, 1, 1, 10), 2, 3.0), ("i2", 1, dt.datetime(2011, 1, 5, 9), 1, 1.5),
            ("i3", 2, dt.datetime(2011, 1, 10, 8), 4, 2.0), ("i3", 2, dt.datetime(2011, 1, 10, 8), 1, 2.0)]
    df = spark.createDataFrame(rows, "InvoiceNo string, CustomerID long, InvoiceDate timestamp_ntz, "
                                     "Quantity long, UnitPrice double")
    got = {r.CustomerID: (r.Recency, r.Frequency, r.Monetary) for r in R.rfm_table(df).collect()}
    # reference date = 2011-01-11 08:00; customer 1 last 2011-01-05 09:00 -> 5 whole days
    assert got == {1: (5, 2, 7.5), 2: (1, 1, 10.0)}


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    got = [round(r.x_scaled, 9) for r in R.scale(df, R.scaler_stats(df, ["x"]), ["x"]).orderBy("x").collect()]
    s = np.std([1, 2, 3])
    assert got == [round(-1 / s, 9), 0.0, round(1 / s, 9)]


def test_weekday_means_fixed_dimension(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 2), (dt.datetime(2024, 1, 2), 4)],
                               "InvoiceDate timestamp_ntz, Quantity long")
    r = A.weekday_means(df).collect()
    assert [x.weekday for x in r][:2] == ["Monday", "Tuesday"] and len(r) == 7
    assert r[0].mean_quantity == 2.0 and r[6].mean_quantity is None


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 10]], "x double")
    h = {r.bin: r["count"] for r in A.histogram(df, "x", 5).collect()}
    assert h == {1: 2, 2: 1, 5: 1}


def test_pivot_fills_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (2, 2)], "Month int, c int")
    p = {r.Month: (r["0"], r["1"], r["2"]) for r in A.pivot_count(df, "Month", "c", [0, 1, 2]).collect()}
    assert p == {1: (1, 0, 1), 2: (0, 0, 1)}


def _series_pdf(seed=0, items=4, n=90):
    rng = np.random.default_rng(seed)
    recs = []
    for it in range(items):
        for d in sorted(rng.choice(400, size=n - it * 10, replace=False)):
            recs.append((dt.datetime(2010, 1, 1) + dt.timedelta(days=int(d)), f"s{it}", int(rng.integers(1, 30))))
    return pd.DataFrame(recs, columns=["InvoiceDate", "StockCode", "Quantity_Agg"])


def _between(values, p):
    """Linear quantile of a list, NaN left out."""
    v = sorted(x for x in values if x == x)
    at = (len(v) - 1) * p
    low = int(at)
    return v[low] if low + 1 == len(v) else v[low] + (at - low) * (v[low + 1] - v[low])


def _clip(x, lo, hi):
    return min(max(x, lo), hi)


def _looped_features(pdf):
    """SURVEY W1 to W6, one value after another: {(item, date): {feature: value}}."""
    series = {}
    for r in pdf.itertuples():
        series.setdefault(r.StockCode, []).append((r.InvoiceDate, r.Quantity_Agg))
    lo, hi = (_between([float(q) for q in pdf["Quantity_Agg"]], p) for p in (0.01, 0.99))
    out = {}
    for item, points in series.items():
        points.sort()
        q = [float(x) for _, x in points]
        for i, (day, _) in enumerate(points):
            f = out[item, day] = {}
            for n in (1, 7, 14, 30, 60):
                f[f"Lag_{n}"] = _clip(q[i - n], lo, hi) if i >= n else 0.0
            for n in (7, 14, 30, 60):
                past = q[max(0, i - n + 1):i + 1]
                mean = sum(past) / len(past)
                # the sample deviation of one value counts as 1, a zero one as 1e-9
                sd = (sum((x - mean) ** 2 for x in past) / (len(past) - 1)) ** 0.5 if len(past) > 1 else 1.0
                f[f"RollingNormMean_{n}"] = mean / (1e-9 if max(past) == min(past) and len(past) > 1 else sd)
                f[f"RollingRange_{n}"] = max(past) - min(past)
                f[f"RollingPctChange_{n}"] = _clip(q[i] / q[i - n] - 1, -1, 1) if i >= n else 0.0
                back = f[f"Lag_{n}"]
                f[f"PctChange_{n}"] = _clip((f["Lag_1"] - back) / back, -1, 1) if back else 0.0
    for name in [f"Rolling{k}_{n}" for k in ("NormMean", "Range") for n in (7, 14, 30, 60)]:
        column = [f[name] for f in out.values()]
        bounds = _between(column, 0.01), _between(column, 0.99)
        for f in out.values():
            f[name] = _clip(f[name], *bounds)
    return out


import pytest


@pytest.mark.parametrize("block_size", [None, 64, 1 << 16])
def test_demand_features_match_loops(spark, block_size):
    pdf = _series_pdf()
    sdf = spark.createDataFrame(pdf, "InvoiceDate timestamp_ntz, StockCode string, Quantity_Agg long")
    got = D.demand_features(sdf, block_size=block_size, adaptive=False).toPandas()
    assert len(got) == len(pdf)
    want = _looped_features(pdf)
    for r in got.to_dict("records"):
        for name, x in want[r["StockCode"], r["InvoiceDate"].to_pydatetime()].items():
            assert r[name] == pytest.approx(x, rel=1e-9, abs=1e-9), name


def test_row_index_matches_sorted_position(spark):
    df = spark.range(5000).select((F.col("id") % 37).alias("d"), F.col("id").alias("k"))
    got = D.row_index(df, ["d", "k"], num_partitions=7).toPandas()
    exp = got.sort_values(["d", "k"]).reset_index(drop=True)
    assert (exp["val_index"].to_numpy() == np.arange(5000)).all()


def test_rolling_mean_by_index_blocks_exact(spark):
    rng = np.random.default_rng(1)
    vals = rng.random(1000)
    vals[rng.choice(1000, 50, replace=False)] = np.nan
    pdf = pd.DataFrame({"val_index": np.arange(1000), "x": vals})
    sdf = spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None)))
    got = E.rolling_mean_by_index(sdf, "val_index", "x", 20, out="r", block_size=64) \
        .orderBy("val_index").toPandas()
    exp = pdf["x"].rolling(20).mean()
    np.testing.assert_allclose(got["r"].to_numpy(float), exp.to_numpy(float), equal_nan=True, rtol=1e-12)


def test_sequence_table_matches_bruteforce(spark):
    n, w = 300, 7
    pdf = pd.DataFrame({"val_index": np.arange(n), "a": np.arange(n) * 1.0, "b": np.arange(n) * 2.0,
                        "y": np.arange(n) + 0.5})
    got = SQ.sequence_table(spark.createDataFrame(pdf), ["a", "b"], "y", w, block_size=50) \
        .orderBy("val_index").collect()
    assert len(got) == n - w
    for r in got[:5] + got[-5:]:
        i = r.val_index
        assert [list(v) for v in r.seq] == [[float(j), 2.0 * j] for j in range(i - w, i)]
        assert r.label == i + 0.5


def test_time_series_folds_like_sklearn(spark):
    n, k = 103, 3
    df = spark.range(n).withColumnRenamed("id", "val_index")
    got = {r.fold: (r.val_start, r.val_end) for r in E.fold_summary(E.time_series_folds(df, k=k)).collect()}
    t = n // (k + 1)
    exp = {f + 1: (n - (k - f) * t, n - (k - f) * t + t - 1) for f in range(k)}
    assert got == exp


def test_regression_metrics_golden(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0), (0.0, 1.0)], "y_true double, y_pred double")
    m = E.regression_metrics(df).first()
    yt, yp = np.array([1, 2, 3, 0.0]), np.array([2, 2, 5, 1.0])
    e = yt - yp
    assert abs(m.MSE - np.mean(e ** 2)) < 1e-12 and abs(m.MAE - np.mean(abs(e))) < 1e-12
    assert abs(m.MedAE - np.median(abs(e))) < 1e-12 and m.MaxError == 2.0
    assert abs(m.R2 - (1 - np.sum(e ** 2) / np.sum((yt - yt.mean()) ** 2))) < 1e-12
    assert abs(m.MAPE - np.mean(abs(e) / np.maximum(abs(yt), np.finfo(float).eps)) * 100) < 1e-3


def test_seeded_sample_repeatable(spark):
    df = spark.range(1000)
    a = sorted(r.id for r in E.seeded_sample(df, 50, "id", 42).collect())
    b = sorted(r.id for r in E.seeded_sample(df, 50, "id", 42).collect())
    assert a == b and len(a) == 50 and E.seeded_sample(df, 5000, "id").count() == 1000


def test_hot_item_blocks_equal_plain_windows(spark):
    """One item holds a third of all series rows: the blocked windows split it
    across (item, block) partitions and must give exactly the per-item result."""
    rng = np.random.default_rng(3)
    base = dt.datetime(2010, 1, 1)
    recs = [(base + dt.timedelta(hours=int(h)), "hot", int(rng.integers(1, 50)))
            for h in rng.choice(100000, size=3000, replace=False)]
    for it in range(60):
        recs += [(base + dt.timedelta(hours=int(h)), f"c{it}", int(rng.integers(1, 50)))
                 for h in rng.choice(100000, size=100, replace=False)]
    sdf = spark.createDataFrame(pd.DataFrame(recs, columns=["InvoiceDate", "StockCode", "Quantity_Agg"]),
                                "InvoiceDate timestamp_ntz, StockCode string, Quantity_Agg long")
    plain = D.demand_features(sdf, block_size=None).toPandas()
    blocked = D.demand_features(sdf, block_size=256, adaptive=True).toPandas()   # hot item: 3000 > 256
    assert len(blocked) == len(plain) == 9000
    key = ["StockCode", "InvoiceDate"]
    a = plain.sort_values(key).reset_index(drop=True)
    b = blocked.sort_values(key).reset_index(drop=True)
    for c in [c for c in a.columns if c not in key]:
        np.testing.assert_allclose(a[c].to_numpy(float), b[c].to_numpy(float), rtol=1e-12, atol=1e-12, err_msg=c)


def test_some_columns_of_the_feature_table_have_its_rows(spark):
    """The chain pruned to a few columns gives these columns of the whole table."""
    from conftest import SF_SMALL
    from martlake.plans import retail as P
    from martlake.sources.tables import retail

    raw = retail(spark, SF_SMALL)
    columns = ["InvoiceNo", "StockCode", "InvoiceDate", "log_Quantity", "Lag_1", "PctChange_7", "RollingRange_14", "IsDiscounted",
               "RFM_Cluster", "Month"]
    whole = P.feature_table(raw, "rule").select(*columns)
    some = P.feature_table(raw, "rule", columns)
    assert some.columns == columns and some.count() == whole.count() > 0
    assert some.exceptAll(whole).isEmpty()
