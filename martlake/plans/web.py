"""G1 / G2 and the load step: drop files -> staged tables -> warehouse.

Batch form (one run over whatever is pending) and the pieces the streaming
form (``martlake.streaming.ingest``) reuses per micro-batch.  Storage paths
are folders in shared storage (Parquet); the staging table is partitioned by
``source_file`` and written with dynamic partition overwrite, so re-running a
file replaces its partition instead of duplicating it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.operators import ledger as L
from martlake.operators import web as Wb
from martlake.operators.warehouse import append_load, guarded_append, load_outcomes_of, open_target
from martlake.session import cut_lineage, stage_table
from martlake.sources import drops as Dr
from martlake.sources.files import HITS_TABLE, SESSIONS_TABLE
from martlake.sources.tables import hits_raw, sessions_raw

DATASETS = {
    "sessions": dict(schema=Dr.SESSION_RECORD, required=Dr.SESSION_REQUIRED, key="session_id",
                     not_null=Wb.SESSION_NOT_NULL, columns=Wb.SESSION_COLUMNS, table=SESSIONS_TABLE),
    "hits": dict(schema=Dr.HIT_RECORD, required=Dr.HIT_REQUIRED, key="hit_id",
                 not_null=Wb.HIT_NOT_NULL, columns=Wb.HIT_COLUMNS, table=HITS_TABLE),
}


# --- drop documents built from the driver tables ---------------------------------------

def drop_documents_from_tables(spark: SparkSession, sf_dir: str, dataset: str,
                               keep_nulls: bool = False) -> DataFrame:
    """Drop documents (file_name, value) derived from ``events``: one JSON
    object ``{"<day>": [records]}`` per session and hourly file, records in
    event order.  Each document holds one session-hour, so no group grows
    with the table.  NULL fields are left out of the JSON unless
    ``keep_nulls`` (as many producers do)."""
    if dataset == "hits":
        raw = hits_raw(spark, sf_dir)
        fields = list(Dr.HIT_REQUIRED)
    else:
        raw = sessions_raw(spark, sf_dir)
        fields = list(Dr.SESSION_REQUIRED) + ["device_model"]
        raw = raw.withColumn("src_pos", F.lit(0))
    rec = F.struct(F.col("src_pos").alias("_pos"), F.struct(*fields).alias("r"))
    g = (raw.groupBy("source_file", "session_id", "src_day")
         .agg(F.array_sort(F.collect_list(rec)).alias("_recs")))
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    doc = F.to_json(F.create_map(F.col("src_day"), F.transform("_recs", lambda x: x["r"])), opts)
    return g.select(F.col("source_file").alias("file_name"), F.col("session_id").alias("_doc_key"),
                    doc.alias("value"))


def write_drops(docs: DataFrame, path: str) -> None:
    """Write documents as drop files, one object per line, one folder per
    file name (``<path>/<file_name>/part-*``)."""
    (docs.select("file_name", "value").repartition("file_name")
     .write.mode("append").partitionBy("file_name").text(path))


# --- transform (G1 / G2) ----------------------------------------------------------------

def transform_records(records: DataFrame, dataset: str, hit_mode: str = "keep_best") -> DataFrame:
    """Cleaning of flattened drop records of one dataset."""
    if dataset == "sessions":
        return Wb.clean_sessions(records)
    return Wb.clean_hits(records, mode=hit_mode, tie_col="src_pos")


def transform_drops(docs: DataFrame, dataset: str, hit_mode: str = "keep_best",
                    file_col: str = "file_name") -> tuple[DataFrame, DataFrame]:
    """S3 + S5 + G1/G2 over drop documents: (staged rows, per-file outcome).

    Files failing the contract (a required column absent from every record), with a
    broken document, or holding no records are not staged; outcome rows carry
    (dataset, file_name, n_records, missing, corrupt, ok)."""
    spec = DATASETS[dataset]
    contract = Dr.missing_columns(docs, spec["required"], file_col=file_col)
    line = next((c for c in ("line_no", "_doc_key") if c in docs.columns), None)
    recs = Dr.flatten_drops(docs, spec["schema"], file_col=file_col, line_col=line)
    if dataset == "hits":
        # source order inside a file: the document, the day and the record's place in it
        recs = recs.withColumn("src_pos", F.struct(*([line] if line else []), "day_pos", "rec_pos"))
    good = contract.where("ok").select(file_col)
    recs = recs.join(good, file_col, "left_semi").withColumn("source_file", F.col(file_col))
    staged = transform_records(recs, dataset, hit_mode)
    outcome = contract.select(F.lit(dataset).alias("dataset"), file_col, "n_records", "missing", "corrupt", "ok")
    return staged, outcome


def stage(staged: DataFrame, path: str, dataset: str) -> None:
    """Write staged rows partitioned by source file (dynamic overwrite).

    A file's rows are gathered before the write, so that a file makes one
    staged file, or one per ``rows_per_file`` rows, and not one per task."""
    cols = list(DATASETS[dataset]["columns"]) + ["source_file"]
    _by_partition(staged.select(*cols), "source_file").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("source_file").parquet(path)


def _by_partition(df: DataFrame, part: str, rows_per_file: int = 1_000_000) -> DataFrame:
    """Rows of one partition value together, large ones split by a hash of the row, sized by their rows.

    A hash, not a random number: a map task that runs again deals its rows alike."""
    counts = df.groupBy(part).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_pieces"))
    counts = counts.withColumnRenamed(part, "_part")
    salted = df.join(counts, F.col(part).eqNullSafe(F.col("_part"))).withColumn(
        "_salt", F.pmod(F.xxhash64(*df.columns), F.col("_pieces")))
    return salted.repartition(part, "_salt").drop("_part", "_pieces", "_salt")


def target(spark: SparkSession, path: str | None, dataset: str) -> DataFrame | None:
    """The dataset's warehouse table, bucketed by its key; None before its first load."""
    spec = DATASETS[dataset]
    return open_target(spark, path, spec["table"], spec["key"]) if path else None


def load(spark: SparkSession, staged: DataFrame, target_path: str | None, dataset: str,
         parent_path: str | None = None, name: str | None = None) -> DataFrame:
    """S10 + J7: append accepted files to the warehouse table as the load ``name``;
    return the per-file outcome.  Hits are checked against the loaded sessions, by
    the session alone."""
    spec = DATASETS[dataset]
    parent = None
    if dataset == "hits":
        # no sessions table yet means every hit is an orphan
        parent = target(spark, parent_path, "sessions")
        if parent is None:
            parent = spark.createDataFrame([], "session_id string")
    accepted, outcome = guarded_append(
        staged, target(spark, target_path, dataset), spec["key"], "source_file", not_null=spec["not_null"],
        parent=parent, fk="session_id" if dataset == "hits" else None)
    if target_path and not outcome.where("accepted").isEmpty():
        # the rows to write must not depend on the table while it is defined anew
        append_load(stage_table(accepted, "accepted"), outcome, target_path, spec["table"], spec["key"],
                    name or uuid.uuid4().hex)
    return outcome


# --- batch jobs -------------------------------------------------------------------------

def ingest_batch(spark: SparkSession, drops_path: str, staging_path: str, ledger_path: str,
                 dataset: str, hit_mode: str = "keep_best", layout: str = "folders") -> DataFrame:
    """T1 batch form: transform every drop file not yet in the ledger, stage
    it, then mark it loaded+transformed+saved (after the staging write, so a
    failed file is retried).  Returns the per-file outcome."""
    docs = Dr.drop_documents(spark, drops_path, whole_file=(layout == "files"), layout=layout)
    files = docs.select(F.lit(dataset).alias("dataset"), "file_name").distinct()
    led = L.load_ledger(spark, ledger_path)
    todo = L.pending_for_transform(files, led).select("file_name")
    docs = docs.join(todo, "file_name", "left_semi")
    staged, outcome = transform_drops(docs, dataset, hit_mode)
    outcome = cut_lineage(outcome)
    stage(staged, staging_path, dataset)
    L.update_ledger(spark, ledger_path, transform_flags(outcome))
    return outcome


def transform_flags(outcome: DataFrame) -> DataFrame:
    """Ledger flags of a transform: all of them hold only for files that were transformed and staged."""
    return outcome.select("dataset", "file_name", *[F.col("ok").alias(c) for c in ("loaded", "transformed", "saved")])


def load_batch(spark: SparkSession, staging_path: str, warehouse_path: str, ledger_path: str,
               dataset: str, parent_path: str | None = None) -> DataFrame:
    """T2 batch form: staged files that are transformed and not yet in the
    warehouse are appended whole or refused whole; the ledger records
    ``to_db``.  Sessions must be loaded before hits (FK)."""
    recover(spark, warehouse_path, ledger_path, dataset)
    led = L.load_ledger(spark, ledger_path)
    todo = L.pending_for_load(led.where(F.col("dataset") == dataset)).select("file_name")
    staged = spark.read.parquet(staging_path).join(
        todo.withColumnRenamed("file_name", "source_file"), "source_file", "left_semi")
    version = max(L.snapshots(spark, ledger_path))
    outcome = load(spark, staged, warehouse_path, dataset, parent_path, f"{dataset}-{version:09d}")
    L.update_ledger(spark, ledger_path, load_flags(outcome, dataset))
    return outcome


def load_flags(outcome: DataFrame, dataset: str) -> DataFrame:
    return outcome.select(F.lit(dataset).alias("dataset"), F.col("source_file").alias("file_name"), F.col("to_db"))


def recover(spark: SparkSession, warehouse_path: str, ledger_path: str, dataset: str) -> None:
    """Bring into the ledger what finished loads have decided, should a run have stopped between
    its load and its ledger: their files are loaded, and not duplicates of themselves."""
    done = load_outcomes_of(spark, warehouse_path)
    if done is None:
        return
    pending = L.pending_for_load(L.load_ledger(spark, ledger_path)).select("dataset", "file_name")
    missed = load_flags(done.where("accepted"), dataset).join(pending, ["dataset", "file_name"], "left_semi").distinct()
    missed = cut_lineage(missed)
    if not missed.isEmpty():
        L.update_ledger(spark, ledger_path, missed)


# --- whole-table pipeline on the driver tables (registered queries) ----------------------

def clean_tables(spark: SparkSession, sf_dir: str, hit_mode: str = "keep_best"):
    """G1 + G2 over the raw session / hit tables: (sessions, hits)."""
    s = Wb.clean_sessions(sessions_raw(spark, sf_dir))
    h = Wb.clean_hits(hits_raw(spark, sf_dir), mode=hit_mode)
    return s, h


def load_outcomes(spark: SparkSession, sf_dir: str, hit_mode: str = "drop_last") -> DataFrame:
    """Per-file load outcome of both datasets into an empty warehouse:
    sessions first, then hits checked against the accepted sessions."""
    s, h = clean_tables(spark, sf_dir, hit_mode)
    s_acc, s_out = guarded_append(s, None, "session_id", "source_file", not_null=Wb.SESSION_NOT_NULL)
    _, h_out = guarded_append(h, None, "hit_id", "source_file", not_null=Wb.HIT_NOT_NULL,
                              parent=s_acc, fk="session_id")
    return (s_out.withColumn("dataset", F.lit("sessions"))
            .unionByName(h_out.withColumn("dataset", F.lit("hits"))))


def run_from_drops(spark: SparkSession, sf_dir: str, hit_mode: str = "drop_last") -> tuple[DataFrame, DataFrame]:
    """One transform and load run over the drops of both datasets: (per-file transform outcome, per-file load
    outcome of the transformed files).  Producers leave NULL fields out, so that a file without any value of
    a required column breaks the contract; the drops of 13 h on days 7, 14, 21 and 28 are cut off."""
    done, staged = {}, {}
    for ds in DATASETS:
        docs = drop_documents_from_tables(spark, sf_dir, ds)
        cut = F.col("file_name").rlike(r"-(07|14|21|28)_13\.json$")
        docs = docs.withColumn("value", F.when(cut, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")))
        rows, outcome = transform_drops(stage_table(docs, "drops"), ds, hit_mode)
        staged[ds], done[ds] = rows, stage_table(outcome, "outcome")
    s_acc, s_out = guarded_append(staged["sessions"], None, "session_id", "source_file", not_null=Wb.SESSION_NOT_NULL)
    _, h_out = guarded_append(staged["hits"], None, "hit_id", "source_file", not_null=Wb.HIT_NOT_NULL,
                              parent=s_acc, fk="session_id")
    loaded = s_out.withColumn("dataset", F.lit("sessions")).unionByName(h_out.withColumn("dataset", F.lit("hits")))
    return done["sessions"].unionByName(done["hits"]), loaded
