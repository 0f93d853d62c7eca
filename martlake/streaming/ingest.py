"""Structured Streaming forms of the drop ingestion (T1) and the staged
load (T2).

T1: a file stream over the drop folder; every micro-batch runs the same
transform as the batch job (contract, cleaning, dedup), writes its staged
partitions (dynamic overwrite by ``source_file``) and merges the per-file
outcome into the ledger.  The stream checkpoint guarantees each drop file is
delivered once across runs; a replayed batch rewrites the same partitions and
ledger rows, so the sink is idempotent.  ``trigger(availableNow=True)``
processes what is there and stops (the reference's scheduled one-shot runs).

T2: a file stream over the staging table wakes the load; what a run loads is
read from the ledger (every file transformed and not yet in the warehouse), so
a file refused for missing parents is tried again in each run, also when no new
file came.  Rows pass the key guard and, for hits, the FK check against the
sessions already loaded.  Run sessions before hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlake.operators import ledger as L
from martlake.plans import web as WEB


def _drop_stream(spark: SparkSession, src: str, layout: str = "folders") -> DataFrame:
    """Documents of drop files with the drop's file name.

    ``layout='folders'``: one JSON object per line below a ``file_name=<name>``
    folder per drop; ``layout='files'``: ``*.json`` files of one object each, read
    whole (the reference's form; one file is one row, as its format demands)."""
    from martlake.sources.drops import drop_file_column
    r = spark.readStream.format("text")
    if layout == "files":
        r = r.option("wholetext", "true").option("pathGlobFilter", "*.json")
    else:
        r = r.option("recursiveFileLookup", "true")
    return r.load(src).select(drop_file_column().alias("file_name"), "value")


def ingest_stream(spark: SparkSession, src: str, staging: str, ledger_path: str, checkpoint: str,
                  dataset: str, hit_mode: str = "keep_best", available_now: bool = True,
                  counters: list | None = None, layout: str = "folders"):
    """Start the ingestion stream; returns the StreamingQuery.  Per-batch
    row counters (``DataFrame.observe``) are appended to ``counters``."""
    counters = counters if counters is not None else []

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        docs = batch.withColumn("line_no", F.monotonically_increasing_id()).cache()
        if docs.isEmpty():
            docs.unpersist()
            return
        staged, outcome = WEB.transform_drops(docs, dataset, hit_mode)
        # S15 inline: per-batch counters collected as the staging write runs
        obs = Observation(f"ingest_{dataset}_{epoch_id}")
        staged = staged.observe(obs, F.count(F.lit(1)).alias("staged_rows"))
        WEB.stage(staged, staging, dataset)
        counters.append({"epoch": epoch_id, **obs.get})
        L.update_ledger(spark, ledger_path, WEB.transform_flags(outcome))
        docs.unpersist()

    w = (_drop_stream(spark, src, layout).writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def load_stream(spark: SparkSession, staging: str, warehouse: str, ledger_path: str, checkpoint: str,
                dataset: str, parent: str | None = None, available_now: bool = True):
    """Start the load stream over the staging table; returns the StreamingQuery.

    Each start and each micro-batch loads what the ledger has pending."""
    schema = spark.read.parquet(staging).schema

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        WEB.load_batch(spark, staging, warehouse, ledger_path, dataset, parent)

    per_batch(None, -1)         # files left pending by earlier runs
    w = (spark.readStream.schema(schema).parquet(staging).writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
