"""Hits that wait for their session as stream state."""

from datetime import datetime

from pyspark.sql import functions as F

from martlake.streaming.waiting import match_hits, waiting_stream

HITS, SESSIONS = "hit_id string, session_id string, hit_time timestamp", "session_id string, session_time timestamp"


def day(n, hour=0):
    return datetime(2021, 5, n, hour)


def test_hits_before_after_and_without_their_session(spark, scratch):
    hits, sessions, out = (f"{scratch}/{x}" for x in ("hits", "sessions", "out"))

    def put(path, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def run():
        schemas = [spark.createDataFrame([], s).schema for s in (HITS, SESSIONS)]
        waiting_stream(spark, hits, schemas[0], sessions, schemas[1], out, f"{scratch}/chk").awaitTermination()
        return {r.hit_id: r.status for r in spark.read.parquet(out).collect()}

    put(hits, [("before", "s1", day(1, 5)), ("never", "s9", day(1, 6)), ("null", None, day(1, 6))], HITS)
    put(sessions, [("s0", day(1))], SESSIONS)
    assert run() == {}
    put(sessions, [("s1", day(1)), ("s1", day(1)), ("s2", day(2))], SESSIONS)
    assert run() == {"before": "loaded"}
    put(hits, [("after", "s2", day(2, 3)), ("too late for s0", "s0", day(8))], HITS)
    put(sessions, [("s8", day(8))], SESSIONS)
    got = run()
    assert got["after"] == "loaded" and got["never"] == "orphan" and got["null"] == "orphan"
    # nothing is written twice, and the last hit is decided when time has passed it
    put(hits, [("end", "s99", day(20))], HITS)
    put(sessions, [("end", day(20))], SESSIONS)
    got = run()
    assert got == {"before": "loaded", "after": "loaded", "never": "orphan", "null": "orphan", "too late for s0": "orphan"}
    assert spark.read.parquet(out).count() == 5


def test_tables_give_the_same_statuses(spark):
    hits = spark.createDataFrame([("a", "s1", day(1, 5)), ("b", "s2", day(1)), ("c", "s1", day(9))], HITS)
    sessions = spark.createDataFrame([("s1", day(1)), ("s1", day(1))], SESSIONS)
    got = {r.hit_id: r.status for r in match_hits(hits, sessions).select("hit_id", F.col("status")).collect()}
    assert got == {"a": "loaded", "b": "orphan", "c": "orphan"}
