"""What the feature queries write and read on the way: each input once, and only the columns asked for."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlake.operators import clean as C
from martlake.operators import demand as D
from martlake.operators import rfm as R
from martlake.plans import catalog
from martlake.plans import retail as P
from martlake.sources.tables import retail
from martlake.session import stage_table
from martlake.session import checkpoint_dir, drop_table, passing_tables


@pytest.fixture
def staged(monkeypatch):
    """(label, columns) of every staged table, in order."""
    seen = []

    def record(df, label="stage"):
        seen.append((label, df.columns))
        return stage_table(df, label)

    for module in (C, D, R, P, catalog):
        monkeypatch.setattr(module, "stage_table", record, raising=False)
    return seen


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["train_test_scaling", "row_index"])
def test_split_queries_stage_only_what_they_need(spark, staged, name):
    catalog.REGISTRY[name](spark, SF_SMALL)
    columns = {c for _, cs in staged for c in cs}
    assert not columns & {"Description", "Country", "IsDiscounted", "IsPopularItem", "Month_sin"}
    rolling = {c for c in columns if c.startswith(("_rnm", "_rr", "Rolling")) and not c.endswith(("_lo", "_hi"))}
    assert rolling == ({"_rnm_7", "RollingNormMean_7"} if name == "train_test_scaling" else set())


def test_row_index_does_not_copy_a_staged_table(spark, staged):
    df = stage_table(spark.createDataFrame([(3,), (1,), (2,)], "a int"))
    got = D.row_index(df, ["a"])
    assert [label for label, _ in staged] == ["indexed"]
    assert sorted((r.a, r.val_index) for r in got.collect()) == [(1, 0), (2, 1), (3, 2)]


def test_quantiles_do_not_copy_a_staged_table(spark, staged):
    df = stage_table(spark.createDataFrame([(float(i),) for i in range(101)], "a double"))
    assert tuple(C.quantiles(df, ["a"], [0.25, 0.5]).first()) == (25.0, 50.0)
    assert staged == []


def test_customer_table_reads_the_clean_rows_once(spark, staged):
    got = catalog._rfm(spark, SF_SMALL)
    assert [label for label, _ in staged] == ["retail", "rfm"]
    assert "Join" not in plan(got) and got.count() > 0


def test_country_joins_the_orders_not_the_lines(spark):
    joins = plan(retail(spark, SF_SMALL).hint("merge")).count("Join")
    lines = retail(spark, SF_SMALL, ["InvoiceNo", "CustomerID", "Country"])._jdf.queryExecution().optimizedPlan().toString()
    top = next(x for x in lines.splitlines() if "Join" in x)
    assert joins == 4 and "_ok" in top      # the lines meet the orders last


@pytest.mark.parametrize("only", [["Lag_7"], ["PctChange_30", "RollingRange_7"], ["RollingNormMean_14", "RollingPctChange_60"]])
def test_asked_features_are_those_of_the_full_form(spark, only):
    days = [(f"1995-01-{d:02d}", i, (d * 7 + len(i)) % 11 + 1) for d in range(1, 29) for i in ("a", "bb")]
    s = spark.createDataFrame(days, "InvoiceDate string, StockCode string, Quantity_Agg long")
    key = ["InvoiceDate", "StockCode"]
    got = D.demand_features(s, only=only)
    assert set(got.columns) == {*key, "Quantity_Agg", *only}
    assert sorted(got.select(*key, *only).collect()) == sorted(D.demand_features(s).select(*key, *only).collect())


def test_candidates_from_the_schema_are_those_of_the_final_table(spark):
    raw = retail(spark, SF_SMALL)
    assert sorted(P.candidate_columns(raw)) == sorted(P.correlation_candidates(P.feature_table(raw, "rule")))


def test_rows_of_few_columns_where_texts_are_missing(spark):
    raw = retail(spark, SF_SMALL)
    for c in ("Description", "Country"):
        raw = raw.withColumn(c, F.when(F.pmod(F.hash("InvoiceNo", F.lit(c)), F.lit(3)) != 0, F.col(c)))
    keys = [*P.ROW_ORDER, "IsDiscounted", "IsPopularItem"]
    full = P.feature_table(raw, "rule").select(*keys).collect()
    assert 0 < len(full) and sorted(P.feature_table(raw, "rule", keys).collect()) == sorted(full)


def folders(spark, label):
    """Tables of a label that are still in the shared folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/{label}-*")
    return {str(f.getPath().getName()) for f in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or ()}


def shuffles(spark):
    """Number of shuffles whose files are kept."""
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_shuffle_files_go_with_the_write_of_a_table(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    known = shuffles(spark)
    table = stage_table(spark.range(1000).repartition(7, "id"), "freed")
    assert table.count() == 1000 and shuffles(spark) <= known + 1        # that of the count
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


def test_passing_tables_go_but_the_kept_one(spark):
    with passing_tables() as outer:
        with passing_tables() as inner:
            stage_table(spark.range(3), "lost")
            kept = inner.keep(stage_table(spark.range(4), "kept"))
        assert kept.count() == 4 and not folders(spark, "lost")
        last = outer.keep(stage_table(kept, "last"))
    assert last.count() == 4 and not folders(spark, "kept")
    drop_table(last)


LABELS = ("rows", "retail", "rfm", "segments", "demand", "labelled", "series", "unindexed", "quantiles", "medians")


@pytest.mark.parametrize(("name", "left"), [
    ("row_index", {"indexed"}), ("time_series_folds", {"indexed"}), ("chrono_holdout", {"indexed"}), ("train_test_scaling", {"indexed"}),
    ("spike_dates", {"predictions"}), ("segment_lift", {"predictions"}), ("rolling_error", {"predictions"}),
    ("prediction_tail", {"predictions"}), ("seeded_sample", {"predictions"}), ("weekly_cluster_sunday", {"predictions"}),
    ("feature_selection", {"labelled", "series"}), ("sequence_table", {"indexed"}), ("discount_flag", {"retail", "medians"})])
def test_only_the_tables_that_the_result_reads_are_left(spark, name, left):
    labels = (*LABELS, "indexed", "predictions", "final")
    before = {label: folders(spark, label) for label in labels}
    got = catalog.REGISTRY[name](spark, SF_SMALL)
    assert {label for label in labels if folders(spark, label) - before[label]} - {"quantiles"} == left
    assert not got.isEmpty()


def test_descriptions_after_the_dedup_give_the_same_rows(spark):
    schema = "InvoiceNo string, StockCode string, Quantity long, InvoiceDate timestamp, UnitPrice double, CustomerID long, Country string"
    rows = spark.createDataFrame([
        ("2", "a", 1), ("1", "a", 1), ("3", "a", 2), ("4", "b", 1), ("5", "b", 1), ("6", "c", 1), ("7", None, 1), ("8", None, 1), (None, "a", 2)],
        "InvoiceNo string, StockCode string, Quantity long").selectExpr(
        "*", "timestamp'1995-01-02' AS InvoiceDate", "2.5D AS UnitPrice", "1L AS CustomerID", "'X' AS Country")
    assert rows.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    # an item of two descriptions, one that comes twice, one without a text, one that is missing
    items = spark.createDataFrame([("a", "one"), ("a", "two"), ("a", "two"), ("b", None)], "StockCode string, Description string")
    columns = ["InvoiceNo", "StockCode", "Description", "Quantity"]
    text = lambda df: sorted(map(str, df.select(*columns).collect()))
    want = text(P.clean_rows(rows.join(items, "StockCode", "left")))
    assert text(P.clean_rows(rows, items.distinct())) == want and len(want) == 7
    got = P.staged_rows(rows, items.distinct(), columns)
    assert text(got) == want
    assert {r.StockCode for r in got.where("_whole").collect()} == {"a"}


def test_dedup_shuffles_the_invoice_once(spark):
    rows = spark.createDataFrame([("2", "a"), ("1", "a"), (None, "b"), ("3", "b")], "InvoiceNo string, StockCode string")
    got = C.dedup_keep_first(rows, ["StockCode"], ["InvoiceNo"])
    assert sorted(got.collect(), key=str) == sorted(spark.createDataFrame([("1", "a"), (None, "b")], rows.schema).collect(), key=str)
    assert "min_by" not in plan(got)


def test_features_after_the_join_are_those_before(spark):
    days = [(f"1995-01-{d:02d}", i, (d * 7 + len(i)) % 11 + 1) for d in range(1, 29) for i in ("a", "bb")]
    s = spark.createDataFrame(days, "InvoiceDate string, StockCode string, Quantity_Agg long")
    facts = s.select("InvoiceDate", "StockCode").unionByName(spark.createDataFrame([("1999-01-01", "a")], "InvoiceDate string, StockCode string"))
    want = D.join_series_features(facts, D.demand_features(s)).where("Lag_1 IS NOT NULL")
    table, finish = D.demand_windows(s)
    assert not [c for c in table.columns if "Change" in c]
    got = D.join_series_features(facts, table, finish=finish).drop("Quantity_Agg")
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


def test_rows_joined_part_by_part_are_the_same(spark, monkeypatch):
    columns = [*P.ROW_ORDER, "Month_sin", "IsDiscounted", "RFM_Cluster", "PctChange_7", "RollingNormMean_14", "RollingPctChange_60"]
    before = folders(spark, "joined")
    whole = sorted(P.feature_table(retail(spark, SF_SMALL), "rule", columns).collect())
    assert folders(spark, "joined") == before
    monkeypatch.setattr(P, "PART_ROWS", len(whole) // 4)
    left = folders(spark, "labelled") | folders(spark, "series")
    got = P.feature_table(retail(spark, SF_SMALL), "rule", columns)
    assert len(folders(spark, "joined") - before) == 1 and folders(spark, "labelled") | folders(spark, "series") == left
    assert len(whole) > 0 and sorted(got.collect()) == whole


@pytest.mark.parametrize("columns", [["InvoiceNo", "Month"], ["log_Quantity"], ["log_UnitPrice", "Lag_7"], ["Quantity", "DayOfYear", "Description"],
                                     ["TotalSum", "Country"]])
def test_few_columns_with_descriptions_by_item(spark, columns):
    lines = catalog._lines(spark, SF_SMALL)
    want = sorted(P.feature_table(retail(spark, SF_SMALL), "rule", columns).collect())
    assert len(want) > 0 and sorted(P.feature_table(segments="rule", columns=columns, **lines).collect()) == want
