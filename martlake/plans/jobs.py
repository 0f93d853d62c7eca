"""Composite jobs G3–G6 (G1/G2 are ``plans.web``).

Each job composes the operators and writes its outputs to shared storage;
the only driver-side values are bounded metadata (feature names, the best
fold, run folders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.functions.scalars import run_id
from martlake.operators import aggregates as A
from martlake.operators.demand import row_index
from martlake.operators import evaluation as E
from martlake.operators import forecast as FC
from martlake.operators import pricing as PR
from martlake.operators import selection as SEL
from martlake.operators import spikes as SP
from martlake.plans import retail as P
from martlake.session import stage_table
from martlake.sources import files as FL


def run_feature_job(raw: DataFrame, out_dir: str, segments: str = "kmeans", k: int = 15) -> dict:
    """Feature table with ``val_index`` (S7 Parquet) and the selected
    feature list (S9 JSON).  An empty table after NULL removal is an error."""
    final = stage_table(P.feature_table(raw, segments), "features")
    if final.isEmpty():
        raise ValueError("Dataset is empty after NA removal")
    indexed = row_index(final, list(P.ROW_ORDER))
    corr = SEL.target_correlation(final, P.TARGET, P.correlation_candidates(final))
    sel = SEL.select_features(corr, k, P.ALWAYS_SELECTED)
    FL.write_parquet(indexed, f"{out_dir}/final_data")
    FL.write_json_document(FL.feature_list_document(sel), f"{out_dir}/good_features")
    features = [r["feature"] for r in sel.orderBy("rank").collect()]
    return {"final_data": f"{out_dir}/final_data", "good_features": f"{out_dir}/good_features",
            "features": features}


def run_forecast_job(spark: SparkSession, final_path: str, features, out_dir: str,
                     target: str = P.TARGET, max_rounds: int = 5000, patience: int = 100) -> dict:
    """Time-series CV (fold predictions CSV, S8), best model saved (S16),
    all rows scored (M9: predictions CSV + metrics JSON), spike segment lift
    (M10/M11)."""
    df = spark.read.parquet(final_path)
    metrics, preds, best = FC.cross_validate(df, features, target, k=3, max_rounds=max_rounds, patience=patience)
    FL.write_csv(preds.select("fold", "val_index", F.col("y_true").alias("true"), F.col("y_pred").alias("pred")),
                 f"{out_dir}/cv_predictions")
    folder = FC.save_model(best, f"{out_dir}/models", target, features)
    model, cfg = FC.load_model(spark, FC.latest_model_folder(spark, f"{out_dir}/models"))
    scored = FC.score(model, df, cfg["target"])
    FL.write_csv(scored.select("val_index", F.col("y_true").alias("true"), F.col("y_pred").alias("prediction")),
                 f"{out_dir}/predictions_all")
    FL.write_json_document(FL.metrics_document(E.regression_metrics(scored).drop("n")),
                           f"{out_dir}/predictions_all_metrics")
    pred = FL.read_predictions_csv(spark, f"{out_dir}/predictions_all", scored=True)
    pred = SP.attach_rows(pred, df, ["InvoiceDate", "CustomerID", "StockCode"])
    lift = SP.segment_lift(pred, df, SP.spike_dates(pred))
    FL.write_parquet(lift, f"{out_dir}/segment_lift")
    return {"model": folder, "cv_metrics": metrics, "lift": f"{out_dir}/segment_lift"}


def run_exploration_job(raw: DataFrame, out_dir: str) -> str:
    """The exploration report as Parquet (S7); returns its folder."""
    FL.write_parquet(A.exploration_report(P.preprocess(raw)), f"{out_dir}/exploration")
    return f"{out_dir}/exploration"


def run_price_job(spark: SparkSession, cars: DataFrame, out_dir: str, score_dir: str | None = None,
                  models=None) -> dict:
    """4-fold model choice, refit of the best on all rows, model saved;
    optional directory scoring (M22) with the JSON predictions report (S9)."""
    choice = PR.cv_model_choice(cars, models=models).cache()
    best = choice.where("best").first()["model"]
    model = PR.fit_pipeline(PR.filter_columns(cars), best)
    run = run_id(fmt="yyyyMMddHHmmssSSSSSS")
    stamp = spark.range(1).select(run).first()[0]
    path = f"{out_dir}/cars_pipe_{stamp}"
    model.write().overwrite().save(path)
    out = {"best": best, "model": path, "cv": choice}
    if score_dir:
        scored = PR.score_directory(spark, model, score_dir)
        FL.write_json_document(PR.predictions_document(scored), f"{out_dir}/predictions_{stamp}")
        out["report"] = f"{out_dir}/predictions_{stamp}"
    return out
