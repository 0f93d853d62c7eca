"""Warehouse load: file order in ranges, bucketed targets, loads that can be repeated, two ledger writers."""

import random

import pytest
from pyspark.sql import functions as F

from martlake.operators import ledger as L
from martlake.operators import warehouse as W
from martlake.plans import web as WEB
from martlake.sources.files import SESSIONS_TABLE


def in_order(claims):
    """Accepted files by the rule, one after another."""
    taken, out = set(), []
    for f in sorted({f for f, _ in claims}):
        keys = {k for g, k in claims if g == f}
        if not keys & taken:
            taken |= keys
            out.append(f)
    return out


def test_a_chain_of_files_takes_one_round(spark, monkeypatch):
    """1,000 files that each share a key with the next: decided in one range, every second one accepted."""
    tables = []
    stage = W.stage_table
    monkeypatch.setattr(W, "stage_table", lambda *a: tables.append(1) or stage(*a))
    claims = [(f"f{i:04d}", k) for i in range(1000) for k in (i, i + 1)]
    df = spark.createDataFrame(claims, "source_file string, key long").repartition(5)
    got = sorted(r[0] for r in W.first_claims(df, "source_file", "key").collect())
    assert got == [f"f{i:04d}" for i in range(0, 1000, 2)] and len(tables) == 2


@pytest.mark.parametrize("size", [7, 40, 1000])
def test_ranges_decide_as_one_after_another(spark, size):
    r = random.Random(size)
    claims = sorted({(f"f{r.randint(0, 40):02d}", r.randint(0, 60)) for _ in range(150)})
    df = spark.createDataFrame(claims, "source_file string, key long").repartition(4)
    got = sorted(x[0] for x in W.first_claims(df, "source_file", "key", range_claims=size).collect())
    assert got == in_order(claims)
    assert W.first_claims(df.limit(0), "source_file", "key").count() == 0


def sessions(spark, ids, file):
    row = [(i, "c", "2021-05-01", "10:00:00", 1, file) for i in ids]
    df = spark.createDataFrame(row, "session_id string, client_id string, visit_date string, visit_time string, "
                                    "visit_number int, source_file string")
    return df.withColumn("visit_date", F.to_date("visit_date")).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in SESSIONS_TABLE.fields if f.name not in df.columns})


def staged_sessions(spark, base, files):
    """Stage files {name: ids} and mark them transformed."""
    for name, ids in files.items():
        WEB.stage(sessions(spark, ids, name), f"{base}/staging", "sessions")
    flags = spark.createDataFrame([("sessions", n, True, True, True) for n in files],
                                  "dataset string, file_name string, loaded boolean, transformed boolean, saved boolean")
    L.update_ledger(spark, f"{base}/led", flags)


def load(spark, base):
    out = WEB.load_batch(spark, f"{base}/staging", f"{base}/wh", f"{base}/led", "sessions")
    return {r["source_file"]: r["reason"] for r in out.collect()}


def ids_of(spark, base):
    rows = WEB.target(spark, f"{base}/wh", "sessions")
    return sorted(r[0] for r in rows.select("session_id").collect()) if rows is not None else []


def in_db(spark, base):
    return {r["file_name"]: r["to_db"] for r in L.load_ledger(spark, f"{base}/led").collect()}


def test_a_crash_between_load_and_ledger_is_repaired(spark, scratch, monkeypatch):
    staged_sessions(spark, scratch, {"a.json": ["s1", "s2"]})
    monkeypatch.setattr(L, "update_ledger", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        load(spark, scratch)
    monkeypatch.undo()
    assert ids_of(spark, scratch) == ["s1", "s2"] and in_db(spark, scratch) == {"a.json": False}
    assert load(spark, scratch) == {}
    # loaded once, and no duplicate of itself
    assert ids_of(spark, scratch) == ["s1", "s2"] and in_db(spark, scratch) == {"a.json": True}


def test_a_crash_before_the_manifest_leaves_nothing_to_see(spark, scratch, monkeypatch):
    staged_sessions(spark, scratch, {"a.json": ["s1", "s2"]})
    from pyspark.sql import DataFrameWriter

    parquet = DataFrameWriter.parquet

    def stopped(self, path, *a, **k):
        if W.MANIFEST in path:
            raise RuntimeError("stopped")
        return parquet(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", stopped)
    with pytest.raises(RuntimeError):
        load(spark, scratch)
    monkeypatch.undo()
    assert ids_of(spark, scratch) == []
    assert load(spark, scratch) == {"a.json": "loaded"}
    assert ids_of(spark, scratch) == ["s1", "s2"] and in_db(spark, scratch) == {"a.json": True}


def test_loads_add_up_and_duplicates_are_refused(spark, scratch):
    staged_sessions(spark, scratch, {"a.json": ["s1", "s2"], "b.json": ["s2", "s3"]})
    assert load(spark, scratch) == {"a.json": "loaded", "b.json": "duplicate_key"}
    staged_sessions(spark, scratch, {"c.json": ["s4"], "d.json": ["s1"]})
    assert load(spark, scratch) == {"c.json": "loaded", "d.json": "duplicate_key"}
    assert ids_of(spark, scratch) == ["s1", "s2", "s4"]
    assert len(W.finished_loads(spark, f"{scratch}/wh")) == 2


def test_the_target_is_not_shuffled(spark, scratch):
    """Keys are looked up in the bucketed table as it lies: no exchange above its scan, only the key read."""
    staged_sessions(spark, scratch, {"a.json": [f"s{i}" for i in range(50)]})
    load(spark, scratch)
    target = WEB.target(spark, f"{scratch}/wh", "sessions")
    new = sessions(spark, ["s1", "x"], "n").select("session_id")
    conf = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = new.join(target.select("session_id").distinct(), "session_id", "left_semi") \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
    # the new rows come to the buckets; the scan, its distinct and its sort stay where they are
    assert "Bucketed: true" in plan and "ReadSchema: struct<session_id:string>" in plan
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("LocalTableScan" if "LocalTableScan" in plan
                                                                               else "Scan ExistingRDD") < plan.index("FileScan")


def test_two_writers_lose_no_update(spark, scratch):
    path = scratch + "/led"
    base = L.load_ledger(spark, path)
    flags = lambda f: spark.createDataFrame([("hits", f, True)], "dataset string, file_name string, loaded boolean")
    version = max(L.snapshots(spark, path)) + 1
    assert L.save_ledger(L.advance(base, flags("one")), path, version)
    # the other writer started from the same snapshot: its version is refused, its update merged anew
    assert not L.save_ledger(L.advance(base, flags("two")), path, version)
    L.update_ledger(spark, path, flags("two"))
    assert sorted(r["file_name"] for r in L.load_ledger(spark, path).collect()) == ["one", "two"]


def test_a_lock_without_its_version_is_finished(spark, scratch):
    path = scratch + "/led"
    L.load_ledger(spark, path)
    flags = spark.createDataFrame([("hits", "f", True)], "dataset string, file_name string, loaded boolean")
    new = L.advance(L.load_ledger(spark, path), flags)
    new.write.parquet(f"{path}/snapshot-x")
    with open(f"{path}/_v2.lock", "w") as f:        # a writer stopped here
        f.write("snapshot-x")
    L.update_ledger(spark, path, flags.withColumn("file_name", F.lit("g")))
    assert sorted(r["file_name"] for r in L.load_ledger(spark, path).collect()) == ["f", "g"]


def test_rows_are_dealt_alike_when_a_task_runs_again(spark):
    df = spark.range(100).withColumn("p", F.col("id") % 3)
    one, two = (WEB._by_partition(x, "p", 5).withColumn("t", F.spark_partition_id()).orderBy("id").collect()
                for x in (df, df.orderBy(F.desc("id"))))
    assert one == two
