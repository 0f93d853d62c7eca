"""Ranked lexical search by presence masks (operator 12).

The items of a query set are ranked against all documents; a document's score
for an item sums, over the item's terms, a weight times a saturating function
of the term's occurrences in the document, all in integers.

* Items come in blocks of a bounded number of (item, term) pairs; the terms of a
  block are what is broadcast.
* Postings: one pass over the documents keeps, for each, its number of terms and
  the occurrences of the block's terms, as a table.  The number of documents N,
  of terms L and each term's document frequency are sums over that table.
* Ranking: a task takes its documents in blocks.  Each term has a bitmap of the
  block's documents that hold it.  For an item the documents are split into
  those with and those without its terms, the term of the greatest possible
  contribution first, by bitmap operations; a group whose terms are all decided
  holds the documents of one mask of matched terms.  Groups are taken by
  descending maximum score (what the matched terms and those still open can add
  at most), only the documents of finished masks, or of groups of a few
  documents, are scored, and the item is done once the best open group lies
  below its k-th best score so far.  That score is carried on to the task's next
  block.
* The best k of each task and item meet in one ranking.

Edge cases: null and empty texts, and texts without terms, match nothing and are
no documents of N; an item without terms, or whose terms no document holds, has
no rows; documents and items that repeat an id are documents and items of their
own, equal rows of items are one item; ties are ordered by document id, null
last; empty tables give an empty result; a long text is counted in runs.  Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlake.llm.common import arrow_batches, drop_stage, stage, table

BLOCK_PAIRS = 200_000        # (item, term) pairs of a block of items, about
BLOCK_DOCS = 1 << 14         # documents ranked together in a task at most
BLOCK_POSTINGS = 1 << 21     # and their postings, about
FEW = 8                      # a group of so many documents is scored without splitting it further
RUN_BYTES = 4 << 20          # bytes of a text counted at a time
# Every byte that is no letter or digit of ASCII and no part of another character parts terms; A-Z are lower-cased.
TO_TERMS = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def count_terms(text: str) -> tuple[int, Counter]:
    """Number of terms of a text, and of each."""
    raw = text.encode().translate(TO_TERMS)
    n, seen, at = 0, Counter(), 0
    while at < len(raw):
        end = raw.find(b" ", at + RUN_BYTES)
        end = len(raw) if end < 0 else end
        terms = raw[at:end].split()
        n += len(terms)
        seen.update(terms)
        at = end
    return n, seen


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """key, item (a hash of key and text), term, q (occurrences) of each different row of the items."""
    spark = items.sparkSession
    arrow_batches(spark)
    rows = items.select(F.col(key).alias("item_id"), F.col(text).alias("text")).where("text is not null").distinct()
    kind = rows.schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            at, term, q = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                for w, c in count_terms(t)[1].items():
                    at.append(i)
                    term.append(w)
                    q.append(c)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), batch.column(1).take(pa.array(at, pa.int64())),
                 pa.array(term, pa.binary()).cast(pa.string()), pa.array(q, pa.int64())],
                ["item_id", "text", "term", "q"])

    return (rows.mapInArrow(run, f"item_id {kind}, text string, term string, q long")
            .select("item_id", F.sha2("text", 256).alias("item"), "term", "q"))


def postings(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """doc_id, n, terms (numbers), tf of each document with a term; terms of the vocabulary only."""
    spark = docs.sparkSession
    arrow_batches(spark, 500)
    held = spark.sparkContext.broadcast(vocabulary)
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches):
        number = held.value
        known = number.keys()
        for batch in batches:
            keep, n, terms, tf = [], [], [], []
            for i, t in enumerate(batch.column(1)):
                size, seen = count_terms(t.as_py())
                if size:
                    mine = sorted((number[w], w) for w in seen.keys() & known)
                    keep.append(i)
                    n.append(size)
                    terms.append([k for k, _ in mine])
                    tf.append([seen[w] for _, w in mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "tf"])

    return rows.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tf array<int>")


class Block:
    """Documents of a task that are ranked together."""

    def __init__(self, ids: list, n: np.ndarray, starts: np.ndarray, terms: np.ndarray, tf: np.ndarray,
                 n_docs: int, n_terms: int):
        self.ids = ids
        self.starts = starts.tolist()
        self.terms = terms
        if 75 * int(n.max()) * n_docs < 1 << 63:
            m = 25 + 75 * n * n_docs // n_terms
        else:
            m = np.array([25 + 75 * x * n_docs // n_terms for x in n.tolist()])
        sizes = np.diff(starts)
        self.part = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes))
        # by term: where its documents lie in the arrays sorted by term, and the greatest part
        order = np.argsort(terms, kind="stable")
        self.doc = np.repeat(np.arange(len(ids)), sizes)[order]
        present, at = np.unique(terms[order], return_index=True)
        most = np.maximum.reduceat(self.part[order], at) if len(at) else at
        ends = np.append(at, len(terms))[1:].tolist()
        self.of = {t: (a, b, m) for t, a, b, m in zip(present.tolist(), at.tolist(), ends, most.tolist(), strict=True)}
        self.bitmaps: dict[int, int] = {}

    def bitmap(self, term: int) -> int:
        """Documents with the term, as the bits of an integer."""
        found = self.bitmaps.get(term)
        if found is None:
            a, b, _ = self.of[term]
            has = np.zeros(len(self.ids), bool)
            has[self.doc[a:b]] = True
            found = self.bitmaps[term] = int.from_bytes(np.packbits(has, bitorder="little").tobytes(), "little")
        return found

    def rank(self, item: list[tuple[int, int]], best: list, k: int, weights: np.ndarray) -> None:
        """Bring the block's documents into ``best``, an item's first k as (-score, no id, id).

        ``item``: (term, weight times occurrences); ``weights``: zeros, one for each term.
        """
        open_ = sorted(((w * self.of[t][2], t) for t, w in item if w and t in self.of), reverse=True)
        if not open_:
            return
        rest = [0]
        for most, _ in reversed(open_):
            rest.append(rest[-1] + most)
        rest.reverse()
        for t, w in item:
            weights[t] = w
        groups = [(-rest[0], 0, 0, (1 << len(self.ids)) - 1)]
        while groups:
            bound, depth, matched, docs = heapq.heappop(groups)
            if not bound or len(best) == k and bound > best[-1][0]:
                break
            while depth < len(open_) and docs.bit_count() > FEW:
                most, term = open_[depth]
                has = docs & self.bitmap(term)
                depth += 1
                if has == docs:
                    matched += most
                elif has:
                    # those without the term wait with a smaller bound
                    heapq.heappush(groups, (-(matched + rest[depth]), depth, matched, docs ^ has))
                    docs, matched = has, matched + most
                elif groups and matched + rest[depth] < -groups[0][0]:
                    break
            if depth < len(open_) and docs.bit_count() > FEW:
                heapq.heappush(groups, (-(matched + rest[depth]), depth, matched, docs))
                continue
            while docs:
                low = docs & -docs
                docs ^= low
                d = low.bit_length() - 1
                a, b = self.starts[d], self.starts[d + 1]
                score = int(np.dot(weights[self.terms[a:b]], self.part[a:b]))
                if score:
                    insort(best, (-score, self.ids[d] is None, self.ids[d] if self.ids[d] is not None else 0))
                    del best[k:]
        for t, _ in item:
            weights[t] = 0


def best_documents(posted: DataFrame, items: list[list[tuple[int, int]]], size: int, n_docs: int, n_terms: int,
                   k: int) -> DataFrame:
    """item (its place), doc_id, score: at least the k best of each item, at most k a task."""
    spark = posted.sparkSession
    held = spark.sparkContext.broadcast(items)
    kind = posted.schema["doc_id"].dataType.simpleString()

    def run(batches):
        items = held.value
        best: list[list] = [[] for _ in items]
        weights = np.zeros(size, np.int64)
        got: list = []
        id_type = None

        def flush():
            ids = [i for b in got for i in b.column(0).to_pylist()]
            n = np.concatenate([b.column(1).to_numpy() for b in got])
            sizes = np.concatenate([np.diff(b.column(2).offsets.to_numpy()) for b in got])
            terms = np.concatenate([b.column(2).flatten().to_numpy() for b in got])
            tf = np.concatenate([b.column(3).flatten().to_numpy() for b in got]).astype(np.int64)
            block = Block(ids, n, np.concatenate([[0], np.cumsum(sizes)]), terms, tf, n_docs, n_terms)
            for item, b in zip(items, best, strict=True):
                block.rank(item, b, k, weights)
            got.clear()

        docs = held_postings = 0
        for batch in batches:
            id_type = batch.column(0).type
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, BLOCK_DOCS - docs)
                at += part.num_rows
                got.append(part)
                docs += part.num_rows
                held_postings += len(part.column(2).flatten())
                if docs >= BLOCK_DOCS or held_postings >= BLOCK_POSTINGS:
                    flush()
                    docs = held_postings = 0
        if got:
            flush()
        rows = [(i, None if no_id else d, -s) for i, b in enumerate(best) for s, no_id, d in b]
        if rows:
            at, ids, scores = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(ids, id_type),
                                              pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return posted.mapInArrow(run, f"item int, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of each item, those of score 0 left out."""
    spark = docs.sparkSession
    asked = stage(item_terms(items, item_key, item_text), "lexical-items")
    blocks = -(-asked.count() // BLOCK_PAIRS)
    out = None
    for block in range(max(blocks, 1)):
        # a block's items: about BLOCK_PAIRS rows, or one item
        mine = asked.where(F.expr(f"pmod(xxhash64(item_id, item), {max(blocks, 1)}) = {block}")).toArrow().combine_chunks()
        names = list(zip(mine["item_id"].to_pylist(), mine["item"].to_pylist(), strict=True))
        first = {name: i for i, name in reversed(list(enumerate(names)))}
        place = {name: i for i, name in enumerate(first)}
        words = sorted(set(mine["term"].to_pylist()))
        number = {w.encode(): i for i, w in enumerate(words)}
        posted = stage(postings(docs, number, key, text), "lexical-postings")
        n_docs, n_terms = posted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        held_by = dict(posted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())   # words rows
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in held_by.items()}
        wanted: list[list] = [[] for _ in place]
        for name, w, q in zip(names, mine["term"].to_pylist(), mine["q"].to_pylist(), strict=True):
            t = number[w.encode()]
            if t in weight:
                wanted[place[name]].append((t, weight[t] * q))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        best = best_documents(posted, wanted, len(words), n_docs, n_terms, k)
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ids = asked.select("item_id").schema
        known = spark.createDataFrame([(i, name[0]) for name, i in place.items()],
                                      f"item int, item_id {ids[0].dataType.simpleString()}")
        found = stage(ranked.join(F.broadcast(known), "item").select("item_id", "rank", "doc_id", "score"),
                      "lexical-best")
        drop_stage(posted)
        out = found if out is None else out.unionByName(found)
    drop_stage(asked)
    return out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"),
                  table(spark, sf_dir, "benchmark").select("item_id", "text"))
