"""Quality rules with an isolation forest on rule statistics (operator 9).

Statistics of a whole text (null: empty), words being maximal runs of characters
other than the space and ``\\t``..``\\r``:

* ``n_words``; ``word_chars`` (code points in words); ``n_symbols`` (``# * $ % & | < >``);
* ``n_dup_lines``: lines (cut at ``\\n``) with a word that equal an earlier line;
* ``n_repeat_words``: words inside 3-word windows that occur twice or more in the text.

``base_failed``: fewer than 50 words, or over half of the words repeat.

The method: isolation forests over the rates of these statistics (symbols a word,
equal lines, repeated words, characters a word), one forest for each rate and one
for all of them together.  They are grown from counts of all documents that pass
the base rules: the rates on a logarithmic scale are cut into steps, Spark counts
the documents of each step (of each rate, and of the wider joint cells), and the
trees split these weighted counts, so a kind of one document steers the cuts too.
A forest's score follows from the mean path length over its trees.  The
thresholds, one for each forest, are calibrated over all labelled rows: a
histogram of scores per label (fixed bins, made by one distributed aggregation)
gives the lowest score above which at most a forest's part of ``MAX_GOOD_LOSS`` of
the good rows lie and few enough rejected rows are good that all forests together
keep ``MIN_PRECISION``; the threshold lies halfway from it to the next lower score
of a labelled row.  Without such a score, or without labels, a forest rejects
nothing.  A document's ``score`` is the highest ratio of a forest's score to its
threshold: 1 and above is rejected.

Edge cases: null and empty texts have statistics 0 and fail the base rule;
repeated rows are judged alike; labels of unknown documents, null labels and
null ids are ignored; an empty table gives an empty result; other columns are
ignored (``keep_good`` returns them unchanged).
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import arrow_batches, stage, table

SYMBOLS = "#*$%&|<>"            # fixed values
BLANKS = " \t\n\v\f\r"          # fixed values
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
TREES, DEPTH = 100, 8
RATES = 4
FORESTS = RATES + 1             # one for each rate, one for all together
UNIT = 1 / 256                  # rates well below it are alike
FINE, WIDE = 16, 2              # steps of a rate's doubling: by itself, in the joint cells (below a million)
BINS = 2_000                    # of the score histogram
MAX_GOOD_LOSS, MIN_PRECISION = 0.001, 0.9
SEED = 11

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the number of lines with a word."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    dup = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeat = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        upto = 0        # words before this one are counted
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeat += i + 3 - max(i, upto)
                upto = i + 3
    return n, chars, symbols, dup, repeat, len(lines)


def document_stats(docs: DataFrame, keep=("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and STATS of each row; a map over rows, whole texts, one batch at a time."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    names = [x.split()[0] for x in STATS.split(", ")]

    def run(batches):
        for b in batches:
            got = [text_stats(t.as_py()) for t in b.column(len(keep))]
            stats = zip(*got, strict=True) if got else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keep))), *(pa.array(s, pa.int64()) for s in stats)],
                [*keep, *names])

    return rows.mapInArrow(run, f"{kept}, {STATS}")


def base_failed() -> F.Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def features(n, chars, symbols, dup, repeat, lines) -> np.ndarray:
    """The rules' rates on a logarithmic scale, one row per document; rates do not grow with length."""
    n, chars, symbols, dup, repeat, lines = (np.asarray(x, float) for x in (n, chars, symbols, dup, repeat, lines))
    one = np.maximum(n, 1)
    return np.log2(1 + np.stack([symbols / one, dup / np.maximum(lines, 1), repeat / one, chars / one], axis=1) / UNIT)


def harmonic_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow_tree(rows: np.ndarray, weights: np.ndarray, depth: int, rng, out: list) -> int:
    """Adds a tree over ``rows`` to ``out`` as (feature, cut, left, right, path length); returns its root."""
    spread = np.ptp(rows, axis=0) if len(rows) else np.zeros(rows.shape[1])
    at = len(out)
    if depth == 0 or not spread.any():
        out.append((-1, 0.0, at, at, harmonic_path(weights.sum())))
        return at
    out.append(None)
    f = int(rng.choice(np.flatnonzero(spread)))
    cut = rng.uniform(rows[:, f].min(), rows[:, f].max())
    low = rows[:, f] <= cut
    left = grow_tree(rows[low], weights[low], depth - 1, rng, out)
    right = grow_tree(rows[~low], weights[~low], depth - 1, rng, out)
    out[at] = (f, cut, left, right, 0.0)
    return at


def fit_forest(rows: np.ndarray, weights: np.ndarray | None = None, seed: int = SEED) -> dict:
    """Isolation forest: TREES trees, each over all ``rows``, which stand for ``weights`` documents each."""
    rng = np.random.default_rng(seed)
    weights = np.ones(len(rows)) if weights is None else np.asarray(weights, float)
    nodes: list = []
    roots = [grow_tree(rows, weights, DEPTH, rng, nodes) for _ in range(TREES)]
    f, cut, left, right, path = map(np.array, zip(*nodes, strict=True))
    return {"roots": roots, "feature": f, "cut": cut, "left": left, "right": right, "path": path,
            "depth": DEPTH, "norm": max(harmonic_path(weights.sum()), 1e-9)}


def anomaly_scores(forest: dict, rows: np.ndarray) -> np.ndarray:
    """2 ** -(mean path length / usual path length): near 1 for documents that are cut off early."""
    total = np.zeros(len(rows))
    each = np.arange(len(rows))
    for root in forest["roots"]:
        node = np.full(len(rows), root)
        depth = np.zeros(len(rows))
        for _ in range(forest["depth"]):
            f = forest["feature"][node]
            inner = f >= 0
            low = rows[each, np.maximum(f, 0)] <= forest["cut"][node]
            node = np.where(inner, np.where(low, forest["left"][node], forest["right"][node]), node)
            depth += inner
        total += depth + forest["path"][node]
    return 2.0 ** (-total / len(forest["roots"]) / forest["norm"])


def forest_scores(forests: dict, rows: np.ndarray) -> np.ndarray:
    """The scores of all forests, one row per row of :func:`features`."""
    out = np.empty((len(rows), FORESTS))
    for i, (least, scores) in enumerate(forests["single"]):
        step = np.floor(rows[:, i] * FINE).astype(np.int64) - least
        out[:, i] = scores[np.clip(step, 0, len(scores) - 1)]
    cells, place = np.unique(np.floor(rows * WIDE), axis=0, return_inverse=True)
    out[:, RATES] = anomaly_scores(forests["joint"], cells)[place.ravel()]
    return out


def highest(scores: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The highest ratio of a score to its threshold."""
    return (scores / limits).max(axis=1)


def add_scores(stats: DataFrame, column: str, kind: pa.DataType, score) -> DataFrame:
    """Adds ``column``, made by ``score`` from :func:`features`, to rows that hold STATS."""
    names = [x.split()[0] for x in STATS.split(", ")]

    def run(batches):
        for b in batches:
            rows = features(*(b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score(rows).tolist(), kind)],
                                             [*b.schema.names, column])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields)
    return stats.mapInArrow(run, f"{schema}, {column} {'double' if kind == pa.float64() else 'array<double>'}")


def cell_counts(stats: DataFrame) -> DataFrame:
    """forest, c0..c3, n: documents that pass the base rules in each step of a rate, and in each joint cell."""
    names = [x.split()[0] for x in STATS.split(", ")]

    def run(batches):
        for b in batches:
            rows = features(*(c.to_numpy(zero_copy_only=False) for c in b.columns))
            keys = []
            for i in range(RATES):
                single = np.zeros((len(rows), RATES + 1), np.int64)
                single[:, 0], single[:, 1] = i, np.floor(rows[:, i] * FINE)
                keys.append(single)
            keys.append(np.hstack([np.full((len(rows), 1), RATES), np.floor(rows * WIDE).astype(np.int64)]))
            cells, n = np.unique(np.concatenate(keys), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cells.T), pa.array(n)],
                                             ["forest", *(f"c{i}" for i in range(RATES)), "n"])

    key = ["forest", *(f"c{i}" for i in range(RATES))]
    return (stats.where(~base_failed()).select(*names)
            .mapInArrow(run, ", ".join(f"{c} long" for c in [*key, "n"])).groupBy(*key).agg(F.sum("n").alias("n")))


def fit_on(stats: DataFrame) -> dict | None:
    """The forests over all documents that pass the base rules."""
    cells = cell_counts(stats).toPandas()       # bounded by the steps, not by the rows
    if not len(cells):
        return None
    cells = cells.sort_values([c for c in cells.columns if c != "n"])
    places = [f"c{i}" for i in range(RATES)]
    single = []
    for i in range(RATES):
        mine = cells[cells["forest"] == i]
        forest = fit_forest(mine[["c0"]].to_numpy(float), mine["n"].to_numpy(), SEED + i)
        least, most = int(mine["c0"].min()), int(mine["c0"].max())
        single.append((least, anomaly_scores(forest, np.arange(least, most + 1, dtype=float)[:, None])))
    mine = cells[cells["forest"] == RATES]
    return {"single": single, "joint": fit_forest(mine[places].to_numpy(float), mine["n"].to_numpy(), SEED + RATES)}


def threshold(got: list[tuple[int, int, int]]) -> float:
    """Score above which a forest rejects, from (bin, good, all) of its labelled rows; infinite where they support none."""
    all_good = sum(g for _, g, _ in got)
    lowest, above_good, above = None, 0, 0
    for i, (_, g, n) in reversed(list(enumerate(got))):
        above_good, above = above_good + g, above + n
        if FORESTS * above_good > MAX_GOOD_LOSS * all_good:
            break
        if FORESTS * above_good <= (1 - MIN_PRECISION) * above:
            lowest = i
    if lowest is None:
        return math.inf
    # halfway to the next lower score that a labelled row has
    below = (got[lowest - 1][0] + 1) / BINS if lowest else 0.0
    return (below + got[lowest][0] / BINS) / 2


def calibrate(scored: DataFrame, labels: DataFrame) -> np.ndarray:
    """The threshold of each forest, from ``scores`` of all labelled rows."""
    good = (labels.where("doc_id is not null and quality is not null")
            .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    bins = (scored.where(~base_failed()).join(good, "doc_id")
            .select("quality", F.posexplode("scores").alias("forest", "score"))
            .groupBy("forest", F.floor(F.col("score") * BINS).alias("bin"))
            .agg(F.sum((F.col("quality") > 0).cast("long")).alias("good"), F.count("*").alias("n")))
    got = bins.collect()        # FORESTS * BINS rows at most
    return np.array([threshold(sorted((r["bin"], r["good"], r["n"]) for r in got if r["forest"] == i))
                     for i in range(FORESTS)])


def fit(stats: DataFrame, labels: DataFrame) -> tuple[dict | None, np.ndarray]:
    """Forests and thresholds from the statistics of all documents and from all labelled rows."""
    forests = fit_on(stats)
    if not forests:
        return None, np.full(FORESTS, math.inf)
    scored = add_scores(stats, "scores", pa.list_(pa.float64()), lambda rows: forest_scores(forests, rows))
    return forests, calibrate(scored, labels)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, STATS, score, base_failed and kept for each row of ``docs``."""
    stats = stage(document_stats(docs), "quality-stats")
    forests, limits = fit(stats, labels)
    scored = (add_scores(stats, "score", pa.float64(), lambda rows: highest(forest_scores(forests, rows), limits))
              if forests else stats.withColumn("score", F.lit(0.0)))
    return (scored.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") < 1)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The statistics are computed again where the texts are, so no text is shuffled.
    """
    forests, limits = fit(stage(document_stats(docs), "quality-stats"), labels)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            stats = np.array([text_stats(t.as_py()) for t in b.column(at)], dtype=np.int64).reshape(-1, 6)
            good = ((stats[:, 0] >= MIN_WORDS) & (100 * stats[:, 4] <= MAX_REPEAT_PERCENT * stats[:, 0]))
            if forests and len(stats):
                good &= highest(forest_scores(forests, features(*stats.T)), limits) < 1
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return judge(docs.select("doc_id", "text"), labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
