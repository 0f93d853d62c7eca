"""Nearest neighbours by a hash-prefix forest (operator 10).

Every tree gives a vector a string of ``BITS`` bits, the signs of random
projections; a tree is the array of these strings in order, so vectors that
share a prefix lie side by side.  A query descends in all trees to the longest
prefix that matches, then ascends in all trees at once, a bit at a time, until
the matching ranges together hold ``share`` of all vectors; everything in the
ranges is scored by the inner product.  Vectors are lengthened by one component
so that the largest inner product is the smallest angle.

Equal vectors are one class: a class is indexed and searched once and keeps its
``k + 1`` smallest ids, which is all that k nearest rows can need of it.

Layout: a tree is cut into units by its first bits, about ``UNIT_ROWS`` classes
each; a unit that holds more (close vectors that are not equal) is cut into
parts, and its queries likewise, so that no task holds more than a part.  A
task sorts its part, finds each query's range by binary search and returns the
best k + 1 classes of each query.  The counts of prefixes that steer the ascent
are a table of ``TREES * 2**COUNT_BITS`` rows at any size.

Recall: on the test vectors, which have hardly any structure, a share of 1.3
of the rows, summed over 12 trees with repeats, finds over 0.9 of the true
neighbours; vectors with clusters need much less.

Edge cases: vectors null, zero, or with null or non-finite components take no
part; vectors of different lengths are searched apart; a query's own id is
never among its neighbours; a row repeated with the same id counts once; equal
scores go to the smaller id; with fewer than k candidates all are returned; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlake.llm.common import arrow_batches, stage, table

TREES, BITS, COUNT_BITS = 12, 24, 12
SHARE = 1.3
UNIT_ROWS, QUERY_ROWS = 8192, 4096
SALTS = 64
SEED = 5


def planes(dim: int) -> np.ndarray:
    """Projections of all trees for vectors of ``dim`` components and the added one."""
    return np.random.default_rng((SEED, dim)).standard_normal((dim + 1, TREES * BITS)).astype(np.float32)


def codes(vectors: np.ndarray, added: np.ndarray) -> np.ndarray:
    """Hash strings (rows x TREES) as integers, the first bit highest."""
    sign = np.hstack([vectors, added[:, None]]).astype(np.float32) @ planes(vectors.shape[1]) > 0
    weight = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return sign.reshape(-1, TREES, BITS) @ weight


def usable(v) -> F.Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def vector_classes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: k1, k2 (its digest), vector, dim, norm, and its k + 1 smallest ids.

    Ids are cut to the smallest first within (vector, salt), then within the
    vector, so a vector that a third of the rows share is spread over tasks.
    """
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("id"))
    few = (rows.withColumn("salt", salt).withColumn("rank", rank("k1", "k2", "salt")).where(F.col("rank") <= k + 1)
           .withColumn("rank", rank("k1", "k2")).where(F.col("rank") <= k + 1))
    return few.groupBy("k1", "k2").agg(
        F.first("vector").alias("vector"), F.array_sort(F.collect_list("id")).alias("ids")).select(
        "k1", "k2", "vector", "ids", F.size("vector").alias("dim"),
        F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"))


def hashed(classes: DataFrame, longest: dict[int, float], query: bool) -> DataFrame:
    """class, dim, vector (float64 bytes), first id, codes: the TREES hash strings of each class."""
    def run(batches):
        for b in batches:
            dims = b.column(1).to_numpy()
            vectors = b.column(2).to_pylist()
            code = np.zeros((b.num_rows, TREES), np.int64)
            packed = [np.array(v, np.float64) for v in vectors]
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = np.stack([packed[i] for i in at])
                norm = np.linalg.norm(x, axis=1)
                if query:
                    code[at] = codes(x / norm[:, None], np.zeros(len(at)))
                else:
                    top = longest[int(d)]
                    code[at] = codes(x / top, np.sqrt(np.maximum(0, 1 - (norm / top) ** 2)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([v.tobytes() for v in packed], pa.binary()), b.column(3),
                 pa.array(code.tolist(), pa.list_(pa.int64()))], ["class", "dim", "vector", "first", "codes"])

    return classes.select("class", "dim", "vector", F.col("ids")[0].alias("first")).mapInArrow(
        run, "class long, dim int, vector binary, first long, codes array<long>")


def prefix_counts(index: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """(dim, tree) to the number of classes below each prefix of COUNT_BITS bits, summed up from the left."""
    got = (index.select("dim", F.posexplode("codes").alias("tree", "code"))
           .groupBy("dim", "tree", F.shiftright("code", BITS - COUNT_BITS).alias("prefix")).count().collect())
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in got:
        out.setdefault((r["dim"], r["tree"]), np.zeros((1 << COUNT_BITS) + 1, np.int64))[r["prefix"] + 1] += r["count"]
    return {key: np.cumsum(v) for key, v in out.items()}


def query_depths(code: np.ndarray, dim: int, counts: dict, share: float) -> np.ndarray:
    """For each query (codes: rows x TREES) the longest prefix at which the matching ranges of all
    trees together hold ``share`` of the classes."""
    need = share * counts[dim, 0][-1]
    depth = np.zeros(len(code), np.int64)
    for d in range(1, COUNT_BITS + 1):
        width = 1 << (COUNT_BITS - d)
        held = np.zeros(len(code), np.int64)
        for t in range(TREES):
            low = (code[:, t] >> (BITS - d)) * width
            held += counts[dim, t][low + width] - counts[dim, t][low]
        depth = np.where(held >= need, d, depth)
    return depth


def unit_bits(n: int) -> int:
    return min(COUNT_BITS, max(0, int(np.ceil(np.log2(max(1, n / UNIT_ROWS))))))


def best_of_part(index: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k + 1 best classes of a part for each of its queries."""
    kinds = pa.schema([("query", pa.int64()), ("class", pa.int64()), ("score", pa.float64())])
    out: dict[str, list] = {"query": [], "class": [], "score": []}
    if index.num_rows and queries.num_rows:
        code = index.column("code").to_numpy()
        first = index.column("first").to_numpy()
        order = np.lexsort((first, code))
        code, first, cls = code[order], first[order], index.column("class").to_numpy()[order]
        x = np.frombuffer(b"".join(index.column("vector").to_pylist()), np.float64).reshape(len(code), -1)[order]
        qs = np.frombuffer(b"".join(queries.column("vector").to_pylist()), np.float64).reshape(queries.num_rows, -1)
        length = np.linalg.norm(x, axis=1)
        own, depth = queries.column("code").to_numpy(), queries.column("depth").to_numpy()
        name = queries.column("class").to_numpy()
        low = own >> (BITS - depth) << (BITS - depth)
        a = np.searchsorted(code, low)
        b = np.searchsorted(code, low + (1 << (BITS - depth)))
        ranges = np.stack([a, b], axis=1)
        for lo, hi in np.unique(ranges, axis=0):
            if lo == hi:
                continue
            mine = np.flatnonzero((a == lo) & (b == hi))
            for at in range(0, len(mine), 256):
                part = mine[at:at + 256]
                score = qs[part] @ x[lo:hi].T
                # every class that can be among the best, however many tie at the edge: the products
                # of the block and the exact ones differ by rounding only
                m = min(hi - lo, k + 1)
                edge = np.partition(score, hi - lo - m, axis=1)[:, hi - lo - m]
                slack = 1e-12 * length[lo:hi].max() * np.linalg.norm(qs[part], axis=1)
                for row, q in enumerate(part):
                    cand = np.flatnonzero(score[row] >= edge[row] - slack[row]) + lo
                    exact = (x[cand] * qs[q]).sum(axis=1)
                    best = np.lexsort((first[cand], -exact))[:k + 1]
                    out["query"] += [name[q]] * len(best)
                    out["class"] += cls[cand[best]].tolist()
                    out["score"] += exact[best].tolist()
    return pa.table(out, schema=kinds)


def search(index: DataFrame, queries: DataFrame, k: int, share: float) -> DataFrame:
    """query, class, score: for each query class the best k + 1 classes of each part that it visits."""
    counts = prefix_counts(index)
    bits = {d: unit_bits(int(c[-1])) for (d, t), c in counts.items() if t == 0}

    def unit_sizes(d: int, t: int) -> np.ndarray:
        return np.diff(counts[d, t][::1 << (COUNT_BITS - bits[d])])

    row = "dim int, tree int, unit long, part int, slot int, class long, code long, vector binary"

    def place_queries(batches):
        for b in batches:
            code = np.array(b.column(4).to_pylist(), np.int64).reshape(-1, TREES)
            dims = b.column(1).to_numpy()
            vector = b.column(2).to_pylist()
            rows = []
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if (d, 0) not in counts:
                    continue
                depth = query_depths(code[at], d, counts, share)
                for i, dep in zip(at, depth.tolist(), strict=True):
                    wide = max(0, bits[d] - dep)
                    for t in range(TREES):
                        unit = int(code[i, t] >> (BITS - bits[d]) >> wide << wide)
                        rows += [(int(d), t, u, int(code[i, t]), dep, int(b.column(0)[i].as_py()), vector[i])
                                 for u in range(unit, unit + (1 << wide))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True) if rows else [()] * 7, (
                    pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)],
                ["dim", "tree", "unit", "code", "depth", "class", "vector"])

    placed = stage(queries.mapInArrow(
        place_queries, "dim int, tree int, unit long, code long, depth int, class long, vector binary"), "ann-queries")
    asked = {(r["dim"], r["tree"], r["unit"]): r["count"]     # TREES * 2**COUNT_BITS rows at most
             for r in placed.groupBy("dim", "tree", "unit").count().collect()}

    def cuts(d, t, u):
        """Parts of a unit's classes, and slots of its queries."""
        size = int(unit_sizes(d, t)[u])
        return max(1, -(-size // UNIT_ROWS)), max(1, -(-asked.get((d, t, u), 0) // QUERY_ROWS))

    def spread_index(batches):
        for b in batches:
            rows = []
            for c, d, v, first, code in zip(*(x.to_pylist() for x in b.columns), strict=True):
                for t, s in enumerate(code):
                    u = s >> (BITS - bits[d])
                    if (d, t, u) in asked:
                        parts, slots = cuts(d, t, u)
                        rows += [(d, t, u, c % parts, j, c, s, v, first) for j in range(slots)]
            yield batch(rows, ("dim", "tree", "unit", "part", "slot", "class", "code", "vector", "first"))

    def spread_queries(batches):
        for b in batches:
            rows = []
            for d, t, u, s, dep, c, v in zip(*(x.to_pylist() for x in b.columns), strict=True):
                parts, slots = cuts(d, t, u)
                rows += [(d, t, u, p, c % slots, c, s, v, dep) for p in range(parts)]
            yield batch(rows, ("dim", "tree", "unit", "part", "slot", "class", "code", "vector", "depth"))

    def batch(rows, names):
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(),
                 pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(
            zip(*rows, strict=True) if rows else [()] * 9, kinds, strict=True)], list(names))

    key = ["dim", "tree", "unit", "part", "slot"]
    left = index.mapInArrow(spread_index, row + ", first long").groupBy(*key)
    right = placed.mapInArrow(spread_queries, row + ", depth long").groupBy(*key)
    return left.cogroup(right).applyInArrow(lambda a, b: best_of_part(a, b, k),
                                            "query long, class long, score double")


def nearest(vectors: DataFrame, is_query, k: int = 20, share: float = SHARE, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row that ``is_query`` holds for."""
    arrow_batches(vectors.sparkSession)
    rows = (vectors.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
                    is_query.alias("asks"))
            .where(usable(F.col("vector")))
            .withColumns({"k1": F.xxhash64(F.lit(1), "vector"), "k2": F.xxhash64(F.lit(2), "vector")}))
    classes = vector_classes(rows.select("id", "vector", "k1", "k2").dropDuplicates(["id", "k1", "k2"]), k)
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "ann-classes")
    longest = {r["dim"]: r["m"] for r in classes.groupBy("dim").agg(F.max("norm").alias("m")).collect()}
    asking = stage(rows.where("asks").select(F.col("id").alias("query_id"), "k1", "k2").distinct()
                   .join(classes.select("k1", "k2", "class"), ["k1", "k2"]).select("query_id", "class"), "ann-asking")
    searched = classes.join(asking.select("class").distinct(), "class", "left_semi")
    index = stage(hashed(classes, longest, False), "ann-index")
    found = search(index, hashed(searched, longest, True), k, share)
    # a class is found in several trees with one and the same score
    found = found.groupBy("query", "class").agg(F.max("score").alias("score"))
    ids = classes.select("class", "ids")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    top = (found.join(ids, "class").withColumn("first", F.col("ids")[0])
           .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
           .select("query", "score", F.explode("ids").alias("vec_id")))
    top = top.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = (top.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).groupBy("query")
             .agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near")))
    mine = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (asking.join(lists, F.col("class") == F.col("query"))
            .select("query_id", F.posexplode(mine).alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    F.col("hit.score").alias("score")))


def op10_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
