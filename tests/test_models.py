"""Model operators: checked by properties."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlake.operators import pricing as PR
from martlake.operators import rfm as R
from martlake.plans import retail as P
from martlake.sources.tables import retail, vehicles


def _rfm(spark):
    return R.rfm_table(R.rfm_input(P.preprocess(retail(spark, SF_SMALL))))


def test_kmeans_segments_cover_customers(spark):
    rfm = _rfm(spark)
    seg = R.kmeans_segments(rfm, k=3)
    prof = R.cluster_profile(seg).orderBy("RFM_Cluster").collect()
    assert sum(r.Customers for r in prof) == rfm.count()
    assert [r.RFM_Cluster for r in prof] == [0, 1, 2]
    # relabelled by ascending mean Monetary
    assert [r.Monetary_Mean for r in prof] == sorted(r.Monetary_Mean for r in prof)


def test_elbow_cost_decreases_from_one(spark):
    e = {r.k: r.inertia for r in R.elbow_table(_rfm(spark), ks=[1, 2, 3]).collect()}
    assert e[1] > e[2] > 0 and e[1] > e[3]
    # k = 1 closed form: total sum of squares of the scaled features = 3 * n
    assert abs(e[1] - 3 * _rfm(spark).count()) < 1e-6 * e[1]


def test_all_k_together_equal_lloyd_by_hand(spark):
    import numpy as np

    r = np.random.default_rng(4)
    x = np.vstack([r.normal(c, 0.6, size=(40, 2)) for c in ((0, 0), (4, 1), (1, 5), (6, 6))])
    cols = ["a", "b"]
    points = spark.createDataFrame(x.tolist(), "a double, b double").repartition(3).cache()
    starts = R.spread_centers(points, cols, 6, 7)
    assert len(set(starts)) == 6 and starts == R.spread_centers(points, cols, 6, 7)
    got = R.lloyd_all(points, cols, {k: starts[:k] for k in (1, 2, 4, 6)})
    for k in (1, 2, 4, 6):
        c = np.array(starts[:k])
        for _ in range(300):
            at = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
            new = np.array([x[at == i].mean(0) if (at == i).any() else c[i] for i in range(k)])
            done = ((new - c) ** 2).sum() <= 1e-4
            c = new
            if done:
                break
        assert np.allclose(c, np.array(got[k][0])) and np.isclose(((x[:, None] - c[None]) ** 2).sum(-1).min(1).sum(), got[k][1])


def test_elbow_of_few_points(spark):
    rfm = spark.createDataFrame([(1, 1, 1, 1.0), (2, 2, 3, 5.0)], "CustomerID long, Recency int, Frequency long, Monetary double")
    assert [round(r.inertia, 6) for r in R.elbow_table(rfm, ks=[1, 2, 3]).orderBy("k").collect()] == [6.0, 0.0, 0.0]
    assert [r.inertia for r in R.elbow_table(rfm.limit(0), ks=[1, 2]).collect()] == [0.0, 0.0]


def test_stratified_folds_balanced(spark):
    v = PR.filter_columns(vehicles(spark, SF_SMALL)).select("price_category", "model", "year", "odometer")
    f = PR.stratified_folds(v, order=["model", "year", "odometer"])
    per = {}
    for r in f.groupBy("price_category", "fold").count().collect():
        per.setdefault(r.price_category, []).append(r["count"])
    for counts in per.values():
        assert len(counts) == 4 and max(counts) - min(counts) <= 1
    assert f.count() == v.count()


def test_pipeline_scores_unseen_categories(spark):
    v = PR.filter_columns(vehicles(spark, SF_SMALL))
    model = PR.fit_pipeline(v, "LogisticRegression")
    new = v.limit(5).withColumn("model", F.lit("never seen model")).withColumn("fuel", F.lit(None).cast("string"))
    out = PR.predict_categories(model, new).select("predicted_category").collect()
    assert len(out) == 5 and all(r.predicted_category in ("high", "low", "medium") for r in out)


def test_predictions_document(spark, scratch):
    v = vehicles(spark, SF_SMALL)
    model = PR.fit_pipeline(PR.filter_columns(v), "LogisticRegression")
    # reference layout: one JSON record per file
    import json, os
    for i, r in enumerate(v.drop("price_category").limit(3).collect()):
        with open(os.path.join(scratch, f"car_{i}.json"), "w") as fh:
            fh.write(json.dumps(r.asDict()))
    scored = PR.score_directory(spark, model, scratch)
    doc = json.loads(PR.predictions_document(scored).first().value)
    assert sorted(doc["predictions"]) == ["car_0.json", "car_1.json", "car_2.json"]
    assert all(len(x) == 1 for x in doc["predictions"].values())


def test_positions_and_vectors_equal_the_string_indexer(spark, scratch):
    """The dictionary table gives the positions and one-hot vectors that a fitted value list gives, and is saved."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    from martlake.operators.categories import CategoryIndex, fit_categories

    rows = [("b", "x"), ("a", "x"), ("b", "y"), ("c", None), ("a", "x"), (None, "z")]
    df = spark.createDataFrame(rows, "p string, q string")
    index = fit_categories(df, ["p", "q"], ["pi", "qi"])
    index.write().overwrite().save(scratch + "/index")
    index = CategoryIndex.load(scratch + "/index")
    full = df.dropna()
    listed = StringIndexer(inputCols=["p", "q"], outputCols=["pl", "ql"], handleInvalid="keep").fit(df.na.drop(subset=["p"])
                                                                                                   .fillna("z", ["q"]))
    got = index.transform(full).select("p", "q", "pi", "qi").distinct().collect()
    assert {(r.p, r.pi) for r in got} == {("a", 0.0), ("b", 1.0)} and {(r.q, r.qi) for r in got} == {("x", 0.0), ("y", 1.0)}
    assert index.getOrDefault("sizes") == [3, 3]
    enc = OneHotEncoder(inputCols=["pi"], outputCols=["pv"], handleInvalid="keep", dropLast=True)
    new = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("new", "x"), (None, None)], "p string, q string")
    model = enc.fit(index.transform(df.dropna(subset=["p"])))
    mine = {r.p: r.pv.toArray().tolist() for r in model.transform(index.transform(new)).collect()}
    enc = OneHotEncoder(inputCols=["pl"], outputCols=["pv"], dropLast=True)
    theirs = enc.fit(listed.transform(full)).transform(listed.transform(new.na.drop(subset=["p"])))
    assert {r.p: r.pv.toArray().tolist() for r in theirs.collect()} == {k: v for k, v in mine.items() if k}
    assert mine["new"] == mine[None] == [0.0, 0.0, 0.0]


def test_saved_pipeline_scores_the_same(spark, scratch):
    from pyspark.ml import PipelineModel

    v = PR.filter_columns(vehicles(spark, SF_SMALL)).limit(400)
    model = PR.fit_pipeline(v, "SVC")
    model.write().overwrite().save(scratch + "/model")
    again = PipelineModel.load(scratch + "/model")
    a, b = (sorted(PR.predict_categories(m, v).select("model", "odometer", "predicted_category").collect()) for m in (model, again))
    assert a == b


def test_unseen_category_is_all_zeros(spark):
    cars = vehicles(spark, SF_SMALL)
    from pyspark.ml import Pipeline

    train = PR.filter_columns(cars)
    pipe = Pipeline(stages=PR.fit_preprocessor(train)).fit(train)
    out = pipe.transform(train.limit(1).withColumn("fuel", F.lit("never seen before"))).first()
    assert out["fuel_f_v"].numNonzeros() == 0
