"""Near-duplicate detection by SetSketch registers (operator 7).

A document's set holds its distinct 4-word shingles, A-Z lower-cased; with fewer
words the whole sequence is one shingle.  Documents of equal sets form a class;
classes are linked if ``100 * |intersection| >= 80 * |union|`` of the full sets.

1. One pass sketches each document (384 registers) and keeps its size, the
   digest of its set (the class; 128 bits) and the keys of its 50 bands of 6 registers.
2. *Stars.*  Each band key with two classes or more pairs its smallest class
   with every other, so a key's pairs grow with its classes.
3. *Verify.*  Pairs are confirmed on full sets; links make components.
4. *Cross.*  Where a key still holds two components, its classes meet in blocks:
   a task compares the sketches of two blocks, skips pairs of one component,
   takes a pair only in the first band that it shares and only if the joint
   likelihood of the registers does not rule it out, and confirms it on the full
   sets.  Only links leave the task, so no table of pairs is made.

So every pair of classes that shares a band key is linked, joined through
others, confirmed as no link, or ruled out.  A pair at similarity 0.8 shares no
key with a chance of ``(1 - 0.8**6)**50``, 2.5e-7, and less above.

Scale: only keys, ids and the texts of candidate classes are shuffled; copies
count once; sums by key are pre-aggregated; a key's rows are joined, not
gathered, except in blocks of ``BLOCK_ROWS`` classes.

Edge cases: null and empty texts have an empty set, are linked with nothing and
are kept; a null doc_id is never a component's name (kept only if no id is in
its component); repeated rows are copies; rows that repeat the kept doc_id are
all kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import setsketch
from martlake.llm.common import arrow_batches, free_names, stage, table
from martlake.llm.graph import components
from martlake.llm.wordhash import mix64, window_hashes, word_hashes, word_starts

SHINGLE, PERCENT = 4, 80
BLOCK_ROWS = 256            # classes of a key that meet in one task, twice at most


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, laid end to end, and how many each text has."""
    raw = [(t or b"").lower() for t in texts]
    data = b"\n".join(raw)
    ends = np.cumsum([len(t) + 1 for t in raw]) if raw else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(word_starts(data), ends), prepend=0) if raw else np.zeros(0, np.int64)
    words = word_hashes(data, seed)
    end = np.repeat(np.cumsum(counts), counts)
    doc = np.repeat(np.arange(len(raw)), counts)
    h = window_hashes(words, size, seed)
    whole = end[:len(h)] - np.arange(len(h)) >= size
    h, doc = h[whole], doc[:len(whole)][whole]
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        first = np.cumsum(counts) - counts
        short = [window_hashes(words[first[i]:first[i] + counts[i]], int(counts[i]), seed)[0] for i in few]
        h = np.concatenate([h, mix64(np.array(short, np.uint64) + counts[few].astype(np.uint64))])
        doc = np.concatenate([doc, few])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(raw))


def set_digests(elements: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set, whatever the order of its elements."""
    one = mix64(np.add.reduceat(mix64(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts))
    two = np.add.reduceat(mix64(elements + np.uint64(0x9E3779B97F4A7C15)), starts)
    return one.view(np.int64), mix64(two).view(np.int64)


def sketched(texts: list[bytes | None], seed: int):
    """Sizes, places of the non-empty sets, their digests and registers."""
    h, sizes = shingle_sets(texts, SHINGLE, seed)
    some = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[some]
    if not len(some):
        none = np.zeros(0, np.int64)
        return sizes, some, none, none, np.zeros((0, setsketch.REGISTERS), np.uint16)
    one, two = set_digests(h, starts)
    return sizes, some, one, two, setsketch.sketch(h, starts)


def sketch_documents(docs: DataFrame, seed: int = 0, bits: int = 64) -> DataFrame:
    """doc_id, n_shingles, the two digests of the set (null for an empty one; the first cut to ``bits``), band keys."""
    arrow_batches(docs.sparkSession, 500)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    id_type = rows.schema[0].dataType.simpleString()

    def run(batches):
        for b in batches:
            sizes, some, one, two, regs = sketched(b.column(1).to_pylist(), seed)
            first, check, keys = ([None] * b.num_rows for _ in range(3))
            for i, x, y, k in zip(some, cut(one, bits).tolist(), two.tolist(), setsketch.band_keys(regs), strict=True):
                first[i], check[i], keys[i] = x, y, k
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(check, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "one", "two", "keys"])

    return rows.mapInArrow(run, f"doc_id {id_type}, n_shingles long, one long, two long, keys array<long>")


def cut(digest: np.ndarray, bits: int) -> np.ndarray:
    return digest if bits == 64 else digest & ((1 << bits) - 1)


def named_classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with ``node``, the name of their class, and the classes: node, one, two, label).

    A class is a pair of digests, 128 bits; its name is the first digest.  Where two classes have one
    name, both take a new one, until all names differ."""
    rows = rows.withColumn("node", F.col("one"))
    while True:
        classes = stage(rows.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("label"), F.min(F.struct("one", "two")).alias("low"),
            F.max(F.struct("one", "two")).alias("high")), "classes")
        met = classes.where("low <> high").select(F.col("node").alias("met"))
        if met.isEmpty():
            return rows, classes.select("node", "low.one", "low.two", "label")
        rows = stage(rows.join(met, F.col("node") == F.col("met"), "left").withColumn(
            "node", F.when(F.col("met").isNull(), F.col("node")).otherwise(F.xxhash64("node", "one", "two"))).drop("met"),
            "sketched")


def class_texts(docs: DataFrame, wanted: DataFrame, seed: int, bits: int) -> DataFrame:
    """node, lower-cased compressed text of one document of each wanted class (node, one, two, label).

    Rows join by class and doc_id, so the copies of one class spread over tasks.
    """
    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            h, sizes = shingle_sets(texts, SHINGLE, seed)
            some = np.flatnonzero(sizes)
            if len(some):
                first, second = set_digests(h, (np.cumsum(sizes) - sizes)[some])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(some)), pa.array(cut(first, bits)), pa.array(second),
                     pa.array([zstandard.compress(texts[i].lower(), 3) for i in some], pa.binary())],
                    ["doc_id", "first", "second", "packed"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    id_type = rows.schema[0].dataType.simpleString()
    texts = rows.mapInArrow(run, f"doc_id {id_type}, first long, second long, packed binary")
    return (texts.join(wanted, (F.col("first") == F.col("one")) & (F.col("second") == F.col("two"))
                       & F.col("doc_id").eqNullSafe(F.col("label")))
            .select("node", "packed").dropDuplicates(["node"]))


def confirm(pairs: DataFrame, texts: DataFrame, seed: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                got = [zstandard.decompress(x) for c in (2, 3) for x in part.column(c).to_pylist()]
                h, sizes = shingle_sets(got, SHINGLE, seed)
                sets = np.split(h, np.cumsum(sizes)[:-1])
                n = part.num_rows
                keep = []
                for x, y in zip(sets[:n], sets[n:], strict=True):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda c: texts.select(F.col("node").alias(c), F.col("packed").alias(f"packed_{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.select("a", "b", "packed_a", "packed_b").mapInArrow(run, "a long, b long")


def sizes_allow(x: str, y: str) -> F.Column:
    return 100 * F.least(x, y) >= PERCENT * F.greatest(x, y)


def common_counts(x: int, others: np.ndarray, ranks: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                  seen: np.ndarray) -> np.ndarray:
    """Shared elements of set x and each of ``others``; sets are ranks of elements laid end to end."""
    mine = ranks[starts[x]:starts[x] + sizes[x]]
    seen[mine] = True
    at = np.repeat(starts[others] - np.cumsum(sizes[others]) + sizes[others], sizes[others]) + np.arange(sizes[others].sum())
    got = np.add.reduceat(seen[ranks[at]].astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
    seen[mine] = False
    return got


def cross_links(members: DataFrame, texts: DataFrame, seed: int) -> DataFrame:
    """Links (a, b) between classes that share a key but are in two components.

    ``members``: key, band, node, component, n, many (classes of the key).  Blocks of a key's classes
    meet in one task with their texts; sketches rule out most pairs, full sets decide the rest, and
    only links leave the task.
    """
    def compare(group: pa.Table) -> pa.Table:
        left = group.column("is_left").to_numpy().astype(bool)
        node, comp = group.column("node").to_numpy(), group.column("component").to_numpy()
        band = group.column("band")[0].as_py()
        same = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        out: dict[str, list] = {"a": [], "b": []}
        if len(np.unique(comp)) > 1:
            got = [zstandard.decompress(x) for x in group.column("packed").to_pylist()]
            h, n = shingle_sets(got, SHINGLE, seed)
            starts = np.cumsum(n) - n
            regs = setsketch.sketch(h, starts)
            values, ranks = np.unique(h, return_inverse=True)
            seen = np.zeros(len(values), bool)
            xs, ys = (np.arange(len(node)),) * 2 if same else (np.flatnonzero(left), np.flatnonzero(~left))
            for x in xs:
                y = ys[(comp[ys] != comp[x]) & (100 * np.minimum(n[ys], n[x]) >= PERCENT * np.maximum(n[ys], n[x]))]
                y = y[y > x] if same else y
                mine = np.broadcast_to(regs[x], (len(y), regs.shape[1]))
                # a pair that shares several keys is looked at in the first
                y = y[setsketch.first_shared_band(mine, regs[y]) == band]
                mine = np.broadcast_to(regs[x], (len(y), regs.shape[1]))
                y = y[setsketch.may_reach(mine, regs[y], np.full(len(y), n[x]), n[y], PERCENT / 100)]
                if len(y):
                    common = common_counts(x, y, ranks, starts, n, seen)
                    y = y[100 * common >= PERCENT * (n[x] + n[y] - common)]
                    out["a"] += [node[x]] * len(y)
                    out["b"] += node[y].tolist()
        return pa.table(out, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    blocks = F.ceil(F.col("many") / BLOCK_ROWS)
    own = F.pmod(F.xxhash64("node"), blocks)
    others = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda k: F.struct(
        F.least(own, k).alias("i"), F.greatest(own, k).alias("j"), (own <= k).alias("is_left")))
    spread = members.join(texts, "node").withColumn("block", F.explode(others))
    return (spread.select("key", "band", "node", "component", "packed", "block.*")
            .groupBy("key", "i", "j").applyInArrow(compare, "a long, b long"))


CLASS = ("__class_one", "__class_two")


def with_class(docs: DataFrame, seed: int, bits: int, names: list[str]) -> DataFrame:
    """``docs`` with the two digests of each row's set in the columns ``names``, null for an empty set."""
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = [None if t is None else t.encode() for t in b.column(at).to_pylist()]
            h, sizes = shingle_sets(texts, SHINGLE, seed)
            some = np.flatnonzero(sizes)
            one, two = [None] * b.num_rows, [None] * b.num_rows
            if len(some):
                first, second = set_digests(h, (np.cumsum(sizes) - sizes)[some])
                for i, x, y in zip(some, cut(first, bits).tolist(), second.tolist(), strict=True):
                    one[i], two[i] = x, y
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(one, pa.int64()), pa.array(two, pa.int64())],
                                             [*b.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, schema + "".join(f", `{n}` long" for n in names))


def drop_near_duplicates(docs: DataFrame, bits: int = 64) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, all columns kept: one row of each component, of
    the smallest doc_id; rows without words all stay."""
    one, two, name, x, y = free_names(docs.columns, [*CLASS, "__id", "__one", "__two"])
    judged = judge_rows(docs, bits)
    keep = judged.where("kept and one is not null").select(
        F.col("doc_id").alias(name), F.col("one").alias(x), F.col("two").alias(y)).distinct()
    rows = with_class(docs, 0, bits, [one, two])
    same = (F.col(one) == F.col(x)) & (F.col(two) == F.col(y)) & F.col("doc_id").eqNullSafe(F.col(name))
    first = rows.join(keep, same, "left_semi").dropDuplicates(["doc_id", one, two])
    return first.select(*docs.columns).unionByName(rows.where(F.col(one).isNull()).select(*docs.columns))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text)."""
    return judge_rows(docs).drop("one", "two")


def judge_rows(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, the digests of its class, n_shingles, component_id, kept for each row.  ``bits``: length
    of the first digest, shorter only to test that classes whose names meet are told apart."""
    docs, seed = docs.select("doc_id", "text"), 0
    rows, classes = named_classes(stage(sketch_documents(docs, seed, bits), "sketched"))
    bands = (rows.where("node is not null")
             .select("node", F.col("n_shingles").cast("int").alias("n"), F.posexplode("keys").alias("band", "key")))
    hub = (bands.groupBy("key").agg(F.min(F.struct("node", "n")).alias("hub"), F.max("node").alias("top"))
           .where("hub.node <> top").select("key", "hub"))
    members = stage(bands.join(hub, "key").groupBy("key", "node").agg(
        F.first("band").alias("band"), F.first("n").alias("n"), F.first("hub").alias("hub")), "members")
    stars = stage(members.where(F.col("node") != F.col("hub.node")).where(sizes_allow("n", "hub.n"))
                  .select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi")
    texts = stage(class_texts(docs, wanted, seed, bits), "class-texts")
    links = stage(confirm(stars, texts, seed), "links")
    found = components(links)
    placed = (members.join(found, "node", "left")
              .select("key", "band", "node", "n", F.coalesce("component", "node").alias("component")))
    mixed = (placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                       F.count("*").alias("many")).where("x <> y and many > 2").select("key", "many"))
    more = stage(cross_links(placed.join(mixed, "key"), texts, seed).distinct(), "links")
    if not more.isEmpty():
        found = components(links.unionByName(more))
    named = classes.join(found, "node", "left").select(
        "node", "label", F.coalesce("component", "node").alias("component"))
    names = named.groupBy("component").agg(F.min("label").alias("component_id"))
    by_class = named.join(names, "component").select("node", "component_id")
    rows = (rows.join(by_class, "node", "left")
            .select("doc_id", "one", "two", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
    return rows


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
