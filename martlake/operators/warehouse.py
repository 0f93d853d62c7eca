"""Warehouse load with key guard and FK check.

A staged file is appended whole or refused whole.  Refusal reasons, per
file: a NOT NULL column is missing in some row, a primary key occurs twice
inside the file, already exists in the target or in an earlier accepted file
of the batch (the reference's "duplicate key" branch: refused, still marked
``to_db``), or a foreign key
has no parent (the reference's constraint-error branch: refused and left
pending).  All checks are joins/aggregates on the key, so the target is never
collected; the per-file outcome table has one row per file.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martlake.operators.ledger import path_exists
from martlake.session import cut_lineage, stage_table


def not_null_violations(df: DataFrame, cols) -> DataFrame:
    """Rows with a NULL in any NOT NULL column."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Child rows whose foreign key has no parent row (the key alone decides)."""
    return child.join(parent.select(F.col(pk or fk).alias(fk)), fk, "left_anti")


RANGE_CLAIMS = 1_000_000     # claims that one task decides, about


def _in_order(batches):
    """File names to accept from claims (file, key) in file order: a file that shares a key with an
    accepted file before it is refused."""
    import pyarrow as pa

    taken, mine, current, free = set(), [], None, True
    for batch in batches:
        out = []
        for name, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name != current:
                if free and mine:
                    out.append(current)
                    taken.update(mine)
                mine, current, free = [], name, True
            mine.append(key)
            free = free and key not in taken
        yield pa.RecordBatch.from_arrays([pa.array(out, batch.column(0).type)], [batch.schema.names[0]])
    if free and mine:
        yield pa.RecordBatch.from_arrays([pa.array([current])], [batch.schema.names[0]])


def first_claims(claims: DataFrame, source_col: str, key: str, range_claims: int = RANGE_CLAIMS) -> DataFrame:
    """Files (``source_col``) to accept, decided in file-name order: a file that shares a key with an
    earlier accepted file is refused.

    ``claims`` holds the distinct (file, key) of keys that several files claim.
    Files are cut, in name order, into ranges of about ``range_claims`` claims.
    A range is decided by one task in one pass over its sorted claims; the keys
    that it takes refuse files of the ranges after it, by a join.  The rounds are
    as many as the ranges, however long the chains of conflicts are.
    """
    from martlake.operators.demand import row_index

    left = claims.select(source_col, key)
    ranges = -(-left.count() // range_claims)
    if ranges > 1:
        placed = row_index(left, [source_col, key], out="_at")
        span = placed.groupBy(source_col).agg(F.expr(f"min(_at) div {range_claims}").alias("_range"))
        left = placed.drop("_at").join(span, source_col)
    else:
        left = left.withColumn("_range", F.lit(0))
    left = stage_table(left, "claims")
    kind = left.schema[source_col].dataType.simpleString()
    accepted = taken = None
    for i in range(max(ranges, 1)):
        mine = left.where(F.col("_range") == i)
        if taken is not None:
            lost = mine.join(taken, key, "left_semi").select(source_col).distinct()
            mine = mine.join(lost, source_col, "left_anti")
        won = stage_table(mine.select(source_col, key).repartition(1).sortWithinPartitions(source_col, key)
                          .mapInArrow(_in_order, f"`{source_col}` {kind}"), "claims")
        accepted = won if accepted is None else accepted.unionByName(won)
        if i + 1 < ranges:
            keys = left.where(F.col("_range") == i).join(won, source_col, "left_semi").select(key)
            taken = keys if taken is None else taken.unionByName(keys)
    return accepted


def guarded_append(staged: DataFrame, target: DataFrame | None, key: str, source_col: str = "source_file",
                   not_null=(), parent: DataFrame | None = None, fk: str | None = None,
                   parent_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S10 (+ J7, P13): split the staged rows into (accepted rows, per-file outcome).

    Outcome columns: source_file, rows, null_rows, dup_in_file, dup_in_target
    (rows whose key is in the target or in an earlier accepted file of the
    batch), orphan_rows, accepted, to_db, reason.  ``to_db`` follows the
    reference: True when loaded or refused for duplicate keys; False when
    refused for NULLs or missing parents (left pending for a retry).

    Keys decide alone: the target and the parent are joined on the key, whatever
    the day of the row.  One aggregate per (file, key), one per file; a target
    that is bucketed by its key (``open_target``) is not shuffled.
    """
    null_row = (reduce(lambda a, b: a | b, [F.col(c).isNull() for c in not_null]) if not_null else F.lit(False))
    per_key = staged.groupBy(source_col, key).agg(F.count(F.lit(1)).alias("_n"), F.count_if(null_row).alias("_nulls"))
    if target is not None:
        known = target.select(F.col(key)).distinct().withColumn("_known", F.lit(True))
        per_key = per_key.join(known, key, "left")
    else:
        per_key = per_key.withColumn("_known", F.lit(None).cast("boolean"))
    per_key = cut_lineage(per_key)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    out = per_key.groupBy(source_col).agg(
        total("_n").alias("rows"), total("_nulls").alias("null_rows"),
        total(F.when(F.col("_n") > 1, F.col("_n"))).alias("dup_in_file"),
        total(F.when(F.col("_known"), F.col("_n"))).alias("_in_target"))
    if parent is not None and fk:
        lost = orphans(staged.groupBy(source_col, fk).agg(F.count(F.lit(1)).alias("_n")), parent, fk, parent_key)
        out = out.join(lost.groupBy(source_col).agg(F.sum("_n").alias("orphan_rows")), source_col, "left")
    else:
        out = out.withColumn("orphan_rows", F.lit(0).cast("long"))
    out = cut_lineage(out.fillna(0, subset=["orphan_rows"]))
    bad_rows = (F.col("null_rows") > 0) | (F.col("orphan_rows") > 0)
    fine = out.where(~bad_rows & (F.col("dup_in_file") == 0) & (F.col("_in_target") == 0)).select(source_col)
    # keys that several files claim which could each be loaded: decided in file order
    claims = per_key.join(fine, source_col, "left_semi").select(source_col, key)
    shared = claims.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select(key)
    claims = cut_lineage(claims.join(shared, key, "left_semi"))
    won = first_claims(claims, source_col, key)
    refused = claims.join(won, source_col, "left_anti").select(source_col).distinct()
    # a key has one accepted file; it counts against the files after it
    taken = claims.join(won, source_col, "left_semi").select(key, F.col(source_col).alias("_taken_by"))
    late = (claims.join(refused, source_col, "left_semi").join(taken, key).where(F.col("_taken_by") < F.col(source_col))
            .groupBy(source_col).agg(F.count(F.lit(1)).alias("_late")))
    out = out.join(late, source_col, "left").withColumn(
        "dup_in_target", F.col("_in_target") + F.coalesce("_late", F.lit(0)))
    dup = (F.col("dup_in_file") > 0) | (F.col("dup_in_target") > 0)
    out = out.select(
        source_col, "rows", "null_rows", "dup_in_file", "dup_in_target", "orphan_rows",
        (~dup & ~bad_rows).alias("accepted"),
        (~bad_rows).alias("to_db"),
        F.when(bad_rows & (F.col("null_rows") > 0), F.lit("not_null"))
        .when(bad_rows, F.lit("foreign_key"))
        .when(dup, F.lit("duplicate_key"))
        .otherwise(F.lit("loaded")).alias("reason"))
    out = cut_lineage(out)
    return staged.join(out.where("accepted").select(source_col), source_col, "left_semi"), out


# ---- S11: target tables, bucketed by their key, with a manifest of finished loads ---------

BUCKETS = 16
MANIFEST = "_loads"


def finished_loads(spark: SparkSession, path: str) -> list[str]:
    """Names of the loads of a target that were written to the end, in order."""
    if not path_exists(spark, f"{path}/{MANIFEST}"):
        return []
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(p.getName() for p in (f.getPath() for f in fs.listStatus(at))
                  if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def _define(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int, loads: list[str]) -> str:
    """The table over ``path`` in this session's catalog, with the given loads as its partitions."""
    name = "target_" + hashlib.md5(path.encode()).hexdigest()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}, `load` string) USING parquet PARTITIONED BY (`load`) "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    for i in range(0, len(loads), 500):
        parts = " ".join(f"PARTITION (`load` = '{x}')" for x in loads[i:i + 500])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    return name


def open_target(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int = BUCKETS) -> DataFrame | None:
    """Rows of the finished loads of a target table, bucketed by ``key``; None before the first.

    What an unfinished load has written is not seen.  ``buckets`` belongs to the table for good."""
    loads = finished_loads(spark, path)
    if not loads:
        return None
    return spark.table(_define(spark, path, schema, key, buckets, loads)).drop("load")


def append_load(rows: DataFrame, outcome: DataFrame, path: str, schema: StructType, key: str, load: str,
                buckets: int = BUCKETS) -> None:
    """Write ``rows`` as one load of a target, then ``outcome`` as its entry in the manifest.

    The load counts once its entry is there; written again, after a crash before
    that, it takes the place of what it had written."""
    spark = rows.sparkSession
    name = _define(spark, path, schema, key, buckets, [])
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    typed.repartition(buckets, key).createOrReplaceTempView(f"{name}_rows")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`load` = '{load}') SELECT * FROM {name}_rows")
    spark.catalog.dropTempView(f"{name}_rows")
    outcome.coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}/{load}")


def load_outcomes_of(spark: SparkSession, path: str) -> DataFrame | None:
    """Per-file outcomes of all finished loads; None before the first."""
    loads = finished_loads(spark, path)
    return spark.read.parquet(*[f"{path}/{MANIFEST}/{x}" for x in loads]) if loads else None
