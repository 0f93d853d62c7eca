"""Hits that wait for their session as stream state.

Hits and sessions come as two file streams.  A hit whose session has come, or
comes within ``wait`` of event time, is ``loaded``; one whose time passes
without a session is an ``orphan``.  Waiting hits and the sessions that they may
find are the state of a stream-stream outer join, dealt by session and dropped
by the watermark, so a run reads what is new and not all that is pending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def match_hits(hits: DataFrame, sessions: DataFrame, wait: str = "1 day") -> DataFrame:
    """``hits`` (session_id, hit_time, ...) with ``status``; ``sessions``: session_id, session_time.

    Streams, or tables.  A session that is delivered again within ``wait`` counts once."""
    s = sessions.select(F.col("session_id").alias("_sid"), F.col("session_time").alias("_at"))
    if sessions.isStreaming:
        s = s.withWatermark("_at", wait).dropDuplicatesWithinWatermark(["_sid"])
        hits = hits.withWatermark("hit_time", wait)
    else:
        s = s.dropDuplicates(["_sid"])
    near = (F.col("session_id") == F.col("_sid")) & F.expr(
        f"_at >= hit_time - interval {wait} and _at <= hit_time + interval {wait}")
    joined = hits.join(s, near, "left_outer")
    return joined.withColumn("status", F.when(F.col("_sid").isNull(), "orphan").otherwise("loaded")).drop("_sid", "_at")


def waiting_stream(spark: SparkSession, hits_path: str, hit_schema: StructType, sessions_path: str,
                   session_schema: StructType, out: str, checkpoint: str, wait: str = "1 day", available_now: bool = True):
    """Start the stream over two staged Parquet folders; decided hits are appended to ``out``.  Returns the
    StreamingQuery.  An orphan is written once later rows of both streams have moved the watermark past it."""
    read = lambda path, schema: spark.readStream.schema(schema).parquet(path)
    decided = match_hits(read(hits_path, hit_schema), read(sessions_path, session_schema), wait)
    w = decided.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
