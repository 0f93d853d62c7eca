"""Plan checks: pushdown, pruning, no single-partition windows over facts."""

from conftest import SF_SMALL
from martlake.operators import clean as C
from martlake.operators import demand as D
from martlake.operators import evaluation as E
from martlake.plans import retail as P
from martlake.sources.tables import retail


import json


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def unpartitioned_windows(df):
    """WindowExec nodes without a partition spec (they run in ONE task)."""
    nodes = json.loads(df._jdf.queryExecution().sparkPlan().toJSON())
    return [n for n in nodes if n.get("class", "").endswith("WindowExec") and not n.get("partitionSpec")]


def test_filter_on_stored_column_pushed_to_scan(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    p = plan(C.positive(li, ["l_quantity"]).select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,0.0)]" in p


def test_filter_on_derived_column_runs_in_scan_stage(spark):
    # Quantity / UnitPrice of the retail mapping are expressions over lineitem,
    # so the predicate cannot reach Parquet; it must still run in the scan's
    # codegen stage, before any exchange
    p = plan(C.positive(retail(spark, SF_SMALL, ["InvoiceNo", "Quantity", "UnitPrice"]), ["Quantity"]))
    assert "Filter" in p and "Exchange" not in p


def test_scan_prunes_columns(spark):
    p = plan(retail(spark, SF_SMALL, ["StockCode", "Quantity"]))
    assert "l_extendedprice" not in p.split("ReadSchema")[1].split("\n")[0]
    assert "orders" not in p and "customer" not in p and "part.parquet" not in p


def test_no_single_partition_window_in_features(spark):
    feats = D.demand_features(D.demand_series(P.preprocess(retail(spark, SF_SMALL))))
    assert unpartitioned_windows(feats) == []


def test_rolling_error_uses_block_partitions(spark):
    df = spark.range(1000).withColumnRenamed("id", "val_index").selectExpr("val_index", "rand(1) as x")
    out = E.rolling_mean_by_index(df, "val_index", "x", 20, out="r", block_size=128)
    assert unpartitioned_windows(out) == [] and "_blk" in plan(out)


def test_nation_join_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(retail(spark, SF_SMALL)) or "BroadcastExchange" in plan(retail(spark, SF_SMALL))


def test_key_guard_finds_a_key_of_another_day(spark, scratch):
    from pyspark.sql import functions as F
    from martlake.operators.warehouse import guarded_append
    spark.range(3000).select((F.col("id") % 30).alias("d"), F.col("id").cast("string").alias("k")) \
        .write.partitionBy("d").parquet(scratch + "/wh")
    target = spark.read.parquet(scratch + "/wh")
    staged = spark.createDataFrame([("f1", 29, "3"), ("f1", 3, "x"), ("f2", 4, "y")],
                                   "source_file string, d int, k string")
    _, out = guarded_append(staged, target, "k")
    assert sorted((r.source_file, r.dup_in_target, r.accepted) for r in out.collect()) == \
        [("f1", 1, False), ("f2", 0, True)]
