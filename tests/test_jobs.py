"""Composite jobs end to end at sf0.001 (outputs written and re-read)."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlake.plans import jobs as J
from martlake.sources.tables import retail


def test_feature_and_forecast_jobs(spark, scratch):
    out = J.run_feature_job(retail(spark, SF_SMALL), scratch, segments="kmeans")
    final = spark.read.parquet(out["final_data"])
    n = final.count()
    assert n > 0 and final.select("val_index").distinct().count() == n
    assert final.agg({"val_index": "max"}).first()[0] == n - 1
    feats = json.loads(spark.read.text(out["good_features"]).first()[0])
    assert feats == out["features"] and len(feats) == 19 and feats[-4:] == [
        "HolidaySeason", "RFM_Cluster", "IsPopularItem", "IsDiscounted"]
    res = J.run_forecast_job(spark, out["final_data"], feats, scratch + "/fc", max_rounds=20, patience=5)
    m = res["cv_metrics"].orderBy("fold").collect()
    assert [r.fold for r in m] == [1, 2, 3] and sum(r.n for r in m) == n // 4 * 3
    # each fold's model is better than forecasting the mean of the rows before it
    idx = final.select("val_index", F.expm1("log_Quantity").alias("y"), F.col("log_Quantity").alias("l"))
    for r, k in zip(m, (3, 2, 1), strict=True):
        start = n - k * (n // 4)
        mean = idx.where(F.col("val_index") < start).agg(F.expm1(F.avg("l"))).first()[0]
        block = idx.where(F.col("val_index").between(start, start + n // 4 - 1))
        assert r.RMSE < block.agg(F.sqrt(F.avg((F.col("y") - mean) ** 2))).first()[0]
    metrics = json.loads(spark.read.text(scratch + "/fc/predictions_all_metrics").first()[0])
    assert set(metrics) >= {"MSE", "RMSE", "MAE", "MedAE", "R2", "MAPE", "MaxError"}
    lift = spark.read.parquet(res["lift"]).collect()
    assert all(r.Lift is None or r.Lift >= 0 for r in lift)


def test_price_job_saves_and_reports(spark, scratch):
    import os
    from pyspark.ml import PipelineModel
    from martlake.sources.tables import vehicles
    cars = vehicles(spark, SF_SMALL)
    src = os.path.join(scratch, "cars")
    os.makedirs(src)
    for i, r in enumerate(cars.drop("price_category").limit(4).collect()):
        with open(os.path.join(src, f"car_{i}.json"), "w") as fh:
            fh.write(json.dumps(r.asDict()))
    out = J.run_price_job(spark, cars, scratch + "/models", score_dir=src, models=["LogisticRegression"])
    assert out["best"] == "LogisticRegression"
    cv = out["cv"].first()
    assert 0.0 <= cv.acc_mean <= 1.0 and cv.best
    PipelineModel.load(out["model"])
    report = json.loads(spark.read.text(out["report"]).first()[0])
    assert sorted(report["predictions"]) == [f"car_{i}.json" for i in range(4)]
