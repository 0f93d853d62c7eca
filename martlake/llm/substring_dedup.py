"""Substring dedup by fixed-block anchors (operator 5).

A word is removed if a window of ``WINDOW`` consecutive words covers it whose
word sequence also starts at another place, in the same document or another.

1. *Pack.*  Documents are packed into batch rows of about ``PACK_BYTES`` of
   text, written once; a batch is the unit that later steps answer to.
2. *Index and probe.*  Every document is cut into non-overlapping reference
   blocks of ``BLOCK`` words, and every rolling window of ``BLOCK`` words is a
   probe.  As ``WINDOW >= 2 * BLOCK - 1``, a repeated window holds a whole block
   in each of its places, so a probe in every other place hits that block.
   A batch sends each distinct hash once, with marks for "is a block" and
   "occurs twice here"; hashes are dealt to buckets by their high bits.
3. *Hits.*  A bucket's task finds block hashes that occur at two places or more
   and answers to each batch that sent them.
4. *Extend.*  Hits are extended to both sides: every window of ``WINDOW`` words
   around a hit is hashed (96 bits) and matched exactly the same way; windows
   next to each other join to maximal repeats.
5. *Remove.*  Each batch drops the words of its repeated windows.

Scale: a sequence that a third of all documents share is sent once a batch, not
once a document, and no pairs are made.  A bucket holds about ``BUCKET_ROWS``
hashes at any size.  Only hashes and one copy of the packed texts per answer
are shuffled.  Probes use 48-bit hashes, whose chance meetings only cost a
check in step 4.

Edge cases: null and empty texts have no words and an empty kept text; texts
under ``WINDOW`` words lose none; repeated rows are documents of their own (and
so repeat each other); a very long text is a batch of its own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import arrow_batches, stage, table
from martlake.llm.wordhash import window_hashes, word_hashes, word_starts

WINDOW, BLOCK = 35, 18
PACK_BYTES = 2 << 20
BUCKET_ROWS = 250_000
ANCHOR_BITS = 48

PACKED = "batch long, n_words long, n_docs long, ids array<long>, sizes array<long>, packed binary"
SENT = "bucket long, batch long, hashes binary, marks binary, extra binary"
ANSWER = "batch long, hashes binary"


def pack(docs: DataFrame, rows: int = 500) -> DataFrame:
    """Batch rows of ``docs`` (doc_id, text): texts end to end, compressed; size -1 stands for a null text."""
    arrow_batches(docs.sparkSession, rows)

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def row():
            raw = [t or b"" for t in texts]
            data = b"\n".join(raw)
            return pa.RecordBatch.from_pylist([{
                "batch": (part << 32) + n, "n_words": len(data.split()), "n_docs": len(ids), "ids": ids,
                "sizes": [-1 if t is None else len(t) for t in texts],
                "packed": zstandard.compress(data, 3)}], schema=kinds)

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                held += len(t or b"")
                if held >= PACK_BYTES:
                    yield row()
                    ids, texts, held, n = [], [], 0, n + 1
        if ids:
            yield row()

    kinds = pa.schema([("batch", pa.int64()), ("n_words", pa.int64()), ("n_docs", pa.int64()),
                       ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("packed", pa.binary())])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, PACKED)


def unpack(packed: bytes, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Text bytes of a batch, and the number of words of each document."""
    data = zstandard.decompress(packed)
    ends = np.cumsum(np.maximum(sizes, 0) + 1)
    before = np.searchsorted(word_starts(data), ends)
    return data, np.diff(before, prepend=0)


def places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of a batch: words of its document from it to the end, and words before it."""
    n = int(counts.sum())
    end = np.repeat(np.cumsum(counts), counts)
    at = np.arange(n)
    return end - at, at - np.repeat(np.cumsum(counts) - counts, counts)


# --- what travels: sorted hashes as differences, in planes of bytes that compress well

def write_hashes(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def read_hashes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def send(batch: int, h: np.ndarray, bits: int, n_buckets: int, marks: np.ndarray, extra: np.ndarray | None):
    """Rows of SENT for one batch: its sorted hashes below 2**bits, cut at the buckets' borders."""
    bucket = ((h >> np.uint64(bits - 32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = [(int(bucket[a]), batch, write_hashes(h[a:b]), np.packbits(marks[a:b], axis=0).T.tobytes(),
             extra[a:b].tobytes() if extra is not None else None)
            for a, b in zip(cuts, np.append(cuts, len(h))[1:], strict=True)]
    names = [x.split()[0] for x in SENT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
        zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)], names)


def answer_bucket(group: pa.Table, need_mark: bool) -> pa.Table:
    """Hashes of one bucket that occur at two places or more, told to each batch that sent them.

    marks hold two planes of bits: the hash occurs twice in the batch; it is a
    block's.  With ``need_mark`` only hashes of which one is a block's count.
    """
    batch = group.column("batch").to_pylist()
    each = [read_hashes(x.as_py()) for x in group.column("hashes")]
    sizes = np.array([len(x) for x in each])
    extra = [np.frombuffer(x.as_py(), np.uint32) if x.as_py() is not None else np.zeros(n, np.uint32)
             for x, n in zip(group.column("extra"), sizes, strict=True)]
    marks = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8).reshape(2, -1), axis=1)[:, :n]
                            for x, n in zip(group.column("marks"), sizes, strict=True)], axis=1)
    h, low = np.concatenate(each), np.concatenate(extra)
    order = np.lexsort((low, h)) if low.any() else np.argsort(h, kind="stable")
    hs, ls = h[order], low[order]
    first = np.ones(len(hs), bool)
    first[1:] = (hs[1:] != hs[:-1]) | (ls[1:] != ls[:-1])
    at = np.flatnonzero(first)
    many = np.diff(np.append(at, len(hs))) > 1
    twice = np.logical_or.reduceat(marks[0][order], at) | many
    if need_mark:
        twice &= np.logical_or.reduceat(marks[1][order], at)
    hit = np.zeros(len(hs), bool)
    hit[order] = np.repeat(twice, np.diff(np.append(at, len(hs))))
    out, start = {"batch": [], "hashes": []}, 0
    for b, n in zip(batch, sizes, strict=True):
        own = hit[start:start + n]
        if own.any():
            out["batch"].append(b)
            out["hashes"].append(write_hashes(h[start:start + n][own]))
        start += n
    return pa.table(out, schema=pa.schema([("batch", pa.int64()), ("hashes", pa.binary())]))


def distinct(h: np.ndarray, low: np.ndarray | None, block: np.ndarray | None):
    """Sorted distinct hashes with their low parts and marks."""
    order = np.argsort(h, kind="stable") if low is None else np.lexsort((low, h))
    hs = h[order]
    first = np.ones(len(hs), bool)
    first[1:] = hs[1:] != hs[:-1]
    if low is not None:
        ls = low[order]
        first[1:] |= ls[1:] != ls[:-1]
    at = np.flatnonzero(first)
    marks = np.zeros((len(at), 2), bool)
    if len(at):
        marks[:, 0] = np.diff(np.append(at, len(hs))) > 1
        if block is not None:
            marks[:, 1] = np.logical_or.reduceat(block[order], at)
    return hs[at], None if low is None else ls[at], marks


def anchors(words: np.ndarray, counts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each rolling window of ``block`` words, whether it lies in one document, whether it is a block."""
    left, before = places(counts)
    h = window_hashes(words, block) >> np.uint64(64 - ANCHOR_BITS)
    whole = left[:len(h)] >= block
    return h, whole, whole & (before[:len(h)] % block == 0)


def probes(packed: DataFrame, n_buckets: int, block: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for r in rows_of(b):
                data, counts = unpack(r["packed"], np.array(r["sizes"], np.int64))
                h, whole, is_block = anchors(word_hashes(data), counts, block)
                h, _, marks = distinct(h[whole], None, is_block[whole])
                yield send(r["batch"], h, ANCHOR_BITS, n_buckets, marks, None)

    return packed.mapInArrow(run, SENT)


def known_hashes(parts) -> np.ndarray:
    return np.concatenate([read_hashes(p) for p in parts])


def rows_of(batch: pa.RecordBatch):
    """Rows as dicts, one in memory at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def window_pairs(data: bytes, words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of hash for each window: 64 and 32, from independent word hashes."""
    low = window_hashes(word_hashes(data, 1), window, 1)
    return window_hashes(words, window), (low >> np.uint64(32)).astype(np.uint32)


def around_hits(found: np.ndarray, n: int, reach: int) -> np.ndarray:
    """Windows i below n for which one of the anchors i..i+reach is a hit."""
    upto = np.concatenate([[0], np.cumsum(found)])
    i = np.arange(n)
    return upto[np.minimum(i + reach + 1, len(found))] > upto[np.minimum(i, len(found))]


def extensions(packed: DataFrame, n_buckets: int, window: int, block: int) -> DataFrame:
    """Hashes of all windows around hits; ``packed`` holds the hits of each batch in ``parts``."""
    def run(batches):
        for b in batches:
            for r in rows_of(b):
                if not r["parts"]:
                    continue
                data, counts = unpack(r["packed"], np.array(r["sizes"], np.int64))
                words = word_hashes(data)
                h, whole, _ = anchors(words, counts, block)
                found = whole & np.isin(h, known_hashes(r["parts"]))
                left, _ = places(counts)
                high, low = window_pairs(data, words, window)
                take = (left[:len(high)] >= window) & around_hits(found, len(high), window - block)
                high, low, marks = distinct(high[take], low[take], None)
                yield send(r["batch"], high, 64, n_buckets, marks, low)

    return packed.mapInArrow(run, SENT)


def covered_words(data: bytes, counts: np.ndarray, parts, window: int) -> np.ndarray:
    """Which words of a batch lie in a repeated window."""
    n = int(counts.sum())
    out = np.zeros(n + 1, np.int64)
    if parts:
        # the answers are windows of this very batch, so 64 bits tell them apart
        h = window_hashes(word_hashes(data), window)
        at = np.flatnonzero((places(counts)[0][:len(h)] >= window) & np.isin(h, known_hashes(parts)))
        out[at] += 1
        out[at + window] -= 1       # each index array is free of repeats
    return np.cumsum(out)[:n] > 0


def gather(packed: DataFrame, answers: DataFrame) -> DataFrame:
    """Adds ``parts``, the answers to each batch: never more than its own windows."""
    parts = answers.groupBy("batch").agg(F.collect_list("hashes").alias("parts"))
    return packed.select("batch", "ids", "sizes", "packed").join(parts, "batch", "left")


def repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Batches of ``docs`` with the hashes of their repeated windows in ``parts``."""
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block at every offset: window >= 2 * block - 1")
    packed = stage(pack(docs), "packed")
    total = packed.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    n_buckets = max(1, -(-total // BUCKET_ROWS))
    sent = probes(packed, n_buckets, block)
    hits = sent.groupBy("bucket").applyInArrow(lambda t: answer_bucket(t, True), ANSWER)
    sent = extensions(gather(packed, hits), n_buckets, window, block)
    found = sent.groupBy("bucket").applyInArrow(lambda t: answer_bucket(t, False), ANSWER)
    return gather(packed, found)


def documents_of(batch: dict, window: int):
    """(doc_id, words of the document, which of them repeat) for each document of a batch row."""
    data, counts = unpack(batch["packed"], np.array(batch["sizes"], np.int64))
    gone = covered_words(data, counts, batch["parts"], window)
    at = upto = 0
    for i, size, n in zip(batch["ids"], batch["sizes"], counts, strict=True):
        yield i, data[at:at + max(size, 0)].split(), gone[upto:upto + n]
        at += max(size, 0) + 1
        upto += n


def remove_repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space."""
    def run(batches):
        for b in batches:
            for r in rows_of(b):
                rows = {"doc_id": [], "n_words": [], "n_removed": [], "kept": []}
                for i, words, gone in documents_of(r, window):
                    rows["doc_id"].append(i)
                    rows["n_words"].append(len(words))
                    rows["n_removed"].append(int(gone.sum()))
                    rows["kept"].append(b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
                                        if gone.any() else b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["n_words"], pa.int64()),
                     pa.array(rows["n_removed"], pa.int64()), pa.array(rows["kept"], pa.binary()).cast(pa.string())],
                    list(rows))

    return repeats(docs, window, block).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
