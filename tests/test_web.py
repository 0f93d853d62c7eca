"""Drop files, contract, cleaning, key guard, ledger and streaming."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlake.operators import ledger as L
from martlake.operators.warehouse import guarded_append
from martlake.plans import web as WEB
from martlake.sources import drops as Dr


def _hit(session, number, referer="r", label="l"):
    rec = {"session_id": session, "hit_date": "2024-01-02", "hit_time": "10:00:00", "hit_number": number,
           "hit_type": "event", "hit_page_path": "/p", "event_category": "c", "event_action": "a",
           "event_value": 1.5}
    if referer is not None:
        rec["hit_referer"] = referer
    if label is not None:
        rec["event_label"] = label
    return rec


def _write(folder, name, obj):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj))


def test_read_drops_reference_format(spark, scratch):
    _write(scratch, "d1.json", {"2024-01-01": [_hit("s1", 1), _hit("s1", 2)], "2024-01-02": [_hit("s2", 1)]})
    _write(scratch, "d2.json", {"2024-01-03": []})
    _write(scratch, "notes.txt", "ignored")
    got = Dr.read_drops(spark, scratch, Dr.HIT_RECORD).select("file_name", "day", "day_pos", "rec_pos",
                                                              "session_id", "hit_number").collect()
    assert sorted(tuple(r) for r in got) == [("d1.json", "2024-01-01", 0, 0, "s1", 1),
                                             ("d1.json", "2024-01-01", 0, 1, "s1", 2),
                                             ("d1.json", "2024-01-02", 1, 0, "s2", 1)]


def test_missing_columns_union_of_keys(spark, scratch):
    # d1: referer present in one record only -> present; d2: no label anywhere -> missing
    _write(scratch, "d1.json", {"x": [_hit("s1", 1, referer=None), _hit("s1", 2)]})
    _write(scratch, "d2.json", {"x": [_hit("s2", 1, label=None)]})
    _write(scratch, "d3.json", {"x": []})
    docs = Dr.drop_documents(spark, scratch)
    got = {r.file_name: (r.n_records, list(r.missing), r.ok)
           for r in Dr.missing_columns(docs, Dr.HIT_REQUIRED).collect()}
    assert got == {"d1.json": (2, [], True), "d2.json": (1, ["event_label"], False), "d3.json": (0, [], False)}


def test_transform_drops_skips_bad_files(spark, scratch):
    _write(scratch, "a.json", {"x": [_hit("s1", 1, referer=None), _hit("s1", 1, referer="z"), _hit("s2", 3)]})
    _write(scratch, "b.json", {"x": [_hit("s3", 1, label=None)]})
    staged, outcome = WEB.transform_drops(Dr.drop_documents(spark, scratch), "hits", "keep_best")
    rows = {r.hit_id: r.hit_referer for r in staged.collect()}
    assert rows == {"s1_1": "z", "s2_3": "r"}
    assert {r.file_name: r.ok for r in outcome.collect()} == {"a.json": True, "b.json": False}


def test_guarded_append_reasons(spark):
    staged = spark.createDataFrame([("f1", "k1", "p1"), ("f1", "k2", "p1"), ("f2", "k3", "p9"),
                                    ("f3", "k4", "p1"), ("f3", "k4", "p1"), ("f4", "k5", "p1")],
                                   "source_file string, key string, parent string")
    target = spark.createDataFrame([("k5",)], "key string")
    parent = spark.createDataFrame([("p1",)], "parent string")
    acc, out = guarded_append(staged, target, "key", parent=parent, fk="parent")
    got = {r.source_file: (r.accepted, r.to_db, r.reason) for r in out.collect()}
    assert got == {"f1": (True, True, "loaded"), "f2": (False, False, "foreign_key"),
                   "f3": (False, True, "duplicate_key"), "f4": (False, True, "duplicate_key")}
    assert sorted(r.key for r in acc.collect()) == ["k1", "k2"]


def test_ledger_primary_backup_empty(spark, scratch):
    # 1) nothing anywhere -> empty ledger, saved
    p1 = os.path.join(scratch, "l1")
    assert L.load_ledger(spark, p1).count() == 0 and os.path.isdir(p1)
    # 2) backup JSON used and copied to the primary
    backup = os.path.join(scratch, "flags.json")
    _write(scratch, "flags.json", {"hits_data": {"a.pkl": {"loaded": True, "transformed": True,
                                                           "to_db": False, "saved": True}}})
    p2 = os.path.join(scratch, "l2")
    got = L.load_ledger(spark, p2, backup).collect()
    assert [(r.dataset, r.file_name, r.loaded, r.to_db) for r in got] == [("hits", "a.pkl", True, False)]
    # 3) primary present -> read as is (backup ignored)
    assert L.load_ledger(spark, p2, backup).count() == 1
    # state transitions: pending, then advance
    led = L.load_ledger(spark, p2)
    assert [r.file_name for r in L.pending_for_load(led).collect()] == ["a.pkl"]
    new = L.advance(led, spark.createDataFrame([("hits", "a.pkl", True)], "dataset string, file_name string, to_db boolean"))
    assert L.pending_for_load(new).count() == 0 and new.first().loaded is True


def test_stream_equals_batch_and_is_idempotent(spark, scratch):
    from martlake.streaming.ingest import ingest_stream, load_stream

    docs = WEB.drop_documents_from_tables(spark, SF_SMALL, "hits", keep_nulls=True)
    src = os.path.join(scratch, "drops")
    WEB.write_drops(docs, src)
    # batch form
    b = os.path.join(scratch, "batch")
    WEB.ingest_batch(spark, src, f"{b}/staging", f"{b}/ledger", "hits")
    # streaming form, run twice over the same folder
    s = os.path.join(scratch, "stream")
    counters = []
    for _ in range(2):
        ingest_stream(spark, src, f"{s}/staging", f"{s}/ledger", f"{s}/chk", "hits",
                      counters=counters).awaitTermination()
    cols = ["hit_id", "session_id", "hit_referer", "event_label", "source_file"]
    batch_rows = sorted(tuple(r) for r in spark.read.parquet(f"{b}/staging").select(*cols).collect())
    stream_rows = sorted(tuple(r) for r in spark.read.parquet(f"{s}/staging").select(*cols).collect())
    assert batch_rows == stream_rows and len(stream_rows) > 0
    assert len(stream_rows) == len(set(r[0] for r in stream_rows))          # keep_best: unique keys
    assert sum(c["staged_rows"] for c in counters) == len(stream_rows)     # second run: no batch
    # load: sessions absent -> every hit file refused for missing parents, kept pending
    load_stream(spark, f"{s}/staging", f"{s}/wh_hits", f"{s}/ledger", f"{s}/chk_load", "hits",
                parent=f"{s}/no_sessions").awaitTermination()
    led = L.load_ledger(spark, f"{s}/ledger")
    assert led.where("transformed AND NOT to_db").count() == led.count()


def test_stream_load_matches_whole_table_key_guard(spark, scratch):
    """T1 + T2 over drop files written from the tables: the sessions ledger
    (to_db per file) equals the whole-table key-guard outcome."""
    from martlake.streaming.ingest import ingest_stream, load_stream

    src = os.path.join(scratch, "drops")
    WEB.write_drops(WEB.drop_documents_from_tables(spark, SF_SMALL, "sessions", keep_nulls=True), src)
    b = os.path.join(scratch, "s")
    ingest_stream(spark, src, f"{b}/staging", f"{b}/ledger", f"{b}/chk_i", "sessions").awaitTermination()
    load_stream(spark, f"{b}/staging", f"{b}/wh", f"{b}/ledger", f"{b}/chk_l", "sessions").awaitTermination()
    led = {r.file_name: r.to_db for r in L.load_ledger(spark, f"{b}/ledger").collect()}
    kg = {r.source_file: r.to_db for r in WEB.load_outcomes(spark, SF_SMALL).where("dataset = 'sessions'").collect()}
    assert led == kg and any(led.values()) and not all(led.values())
    loaded = spark.read.parquet(f"{b}/wh")
    assert loaded.count() == loaded.select("session_id").distinct().count()


def test_cross_file_keys_in_file_order(spark):
    """f2 shares a key with f1 and is refused; f3 shares only with the refused f2 and is loaded;
    f5 comes before f6 but misses its parent, so f6 gets the key."""
    staged = spark.createDataFrame(
        [("f1", "a", "p"), ("f2", "a", "p"), ("f2", "b", "p"), ("f3", "b", "p"), ("f4", "c", "p"),
         ("f5", "d", "gone"), ("f6", "d", "p")], "source_file string, key string, parent string")
    acc, out = guarded_append(staged, None, "key", parent=spark.createDataFrame([("p",)], "parent string"), fk="parent")
    got = {r.source_file: (r.reason, r.dup_in_target) for r in out.collect()}
    assert got == {"f1": ("loaded", 0), "f2": ("duplicate_key", 1), "f3": ("loaded", 0), "f4": ("loaded", 0),
                   "f5": ("foreign_key", 0), "f6": ("loaded", 0)}
    assert sorted(r.key for r in acc.collect()) == ["a", "b", "c", "d"]


def _session(sid, day):
    return {"session_id": sid, "client_id": "c", "visit_date": day, "visit_time": "1:2:3", "visit_number": "4",
            **{c: "x" for c in Dr.SESSION_REQUIRED if c not in ("session_id", "client_id", "visit_date", "visit_time",
                                                               "visit_number")}}


def test_same_session_on_another_day_is_refused_and_midnight_hits_load(spark, scratch):
    run = lambda d, f, ds, parent=None: (
        WEB.ingest_batch(spark, d, f"{scratch}/st_{ds}", f"{scratch}/led_{ds}", ds, layout="files"),
        {r.source_file: r.reason for r in WEB.load_batch(spark, f"{scratch}/st_{ds}", f"{scratch}/wh_{ds}",
                                                         f"{scratch}/led_{ds}", ds, parent).collect()})[1]
    s = os.path.join(scratch, "sessions")
    _write(s, "2024-01-01.json", {"2024-01-01": [_session("s1", "2024-01-01")]})
    assert run(s, None, "sessions") == {"2024-01-01.json": "loaded"}
    _write(s, "2024-01-02.json", {"2024-01-02": [_session("s1", "2024-01-02")]})
    assert run(s, None, "sessions") == {"2024-01-02.json": "duplicate_key"}
    row = spark.read.parquet(f"{scratch}/wh_sessions").collect()
    assert len(row) == 1 and row[0].visit_number == 4           # a quoted number is a number
    h = os.path.join(scratch, "hits")
    _write(h, "a.json", {"2024-01-02": [_hit("s1", 1)]})        # the hit's day is not the session's
    assert run(h, None, "hits", f"{scratch}/wh_sessions") == {"a.json": "loaded"}


def test_pending_files_are_tried_again(spark, scratch):
    from martlake.streaming.ingest import ingest_stream, load_stream

    h, s = os.path.join(scratch, "hits"), os.path.join(scratch, "sessions")
    _write(h, "a.json", json.dumps({"2024-01-02": [_hit("s1", 1)]}, indent=2))      # one object over several lines
    _write(h, "bad.json", '{"2024-01-02": [{"session_id": ')
    _write(h, "notes.txt", "not a drop")
    ingest_stream(spark, h, f"{scratch}/st_h", f"{scratch}/led_h", f"{scratch}/c1", "hits", layout="files").awaitTermination()
    led = {r.file_name: r.transformed for r in L.load_ledger(spark, f"{scratch}/led_h").collect()}
    assert led == {"a.json": True, "bad.json": False}
    for want in (False, True):
        load_stream(spark, f"{scratch}/st_h", f"{scratch}/wh_h", f"{scratch}/led_h", f"{scratch}/c2", "hits",
                    f"{scratch}/wh_s").awaitTermination()
        got = {r.file_name: r.to_db for r in L.load_ledger(spark, f"{scratch}/led_h").collect()}
        assert got["a.json"] is want
        _write(s, "x.json", {"2024-01-02": [_session("s1", "2024-01-02")]})
        WEB.ingest_batch(spark, s, f"{scratch}/st_s", f"{scratch}/led_s", "sessions", layout="files")
        WEB.load_batch(spark, f"{scratch}/st_s", f"{scratch}/wh_s", f"{scratch}/led_s", "sessions")
    assert spark.read.parquet(f"{scratch}/wh_h").count() == 1


def test_ranked_dedup_does_not_depend_on_batches(spark, scratch):
    _write(scratch, "a.json", {"x": [_hit("s1", 1, referer=None), _hit("s1", 1, referer="z")]})
    _write(scratch, "b.json", {"x": [_hit("s1", 1, referer="y")]})
    docs = Dr.drop_documents(spark, scratch).cache()
    key = lambda df: sorted((r.source_file, r.hit_id, r.hit_referer) for r in df.collect())
    together = key(WEB.transform_drops(docs, "hits")[0])
    apart = sum((key(WEB.transform_drops(docs.where(F.col("file_name") == f), "hits")[0]) for f in ("a.json", "b.json")), [])
    assert together == sorted(apart) == [("a.json", "s1_1", "z"), ("b.json", "s1_1", "y")]
    last = key(WEB.transform_drops(docs, "hits", "drop_last")[0])
    assert last == [("a.json", "s1_1", "z"), ("b.json", "s1_1", "y")]
