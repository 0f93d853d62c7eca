"""Phrase collocations by Toivonen's sampling (operator 13).

* Sample: a hash sample of the documents proposes phrases S, at a threshold
  below the expected count by a deviation.
* Full pass: counts, over all documents, every phrase of S and its negative
  border: phrases that are not in S but whose parts without the first and
  without the last word are (and every single word).  It counts them by a hash
  of 64 bits, which can only make a count too large.
* Expansion: where a phrase of the border turns out frequent, phrases that hold
  it have been left out so far.  A further full pass counts, exactly and by the
  phrase itself, every phrase whose count by hash is large enough, and every
  phrase not counted yet of which all parts can be frequent.  A frequent phrase
  has only frequent parts, so this pass closes the set.

Whether a phrase is in S, or frequent by its hash, is asked of a Bloom filter of
at most ``FILTER_BITS`` bits, the only thing that is broadcast.  A wrong yes only
means that a phrase is counted without need; what was counted in which pass
follows from the filters alone.  Counts are added up in the map tasks before the
shuffle, so that a frequent phrase is one entry for some millions of words.

Edge cases: null and empty texts, and texts of separators only, hold no words; a
null lang is ``und``; repeated rows are counted as often as they occur; an empty
table gives an empty result; long texts are taken in runs, which share their
last words; ties are broken by the phrase in byte order.  Other columns of the
table, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlake.llm.common import arrow_batches, drop_stage, stage, table

LONGEST = 5              # words of a phrase
SAMPLE = 8               # one document in so many proposes phrases
DEVIATIONS = 1           # the sample's threshold lies so many deviations below the expected count
FILTER_BITS = 1 << 28    # bits of a filter at most
BITS_A_PHRASE = 16
RUN_BYTES = 4 << 20      # bytes of text counted together
HELD = 1 << 21           # entries (hash, count) that a task holds before it hands them on
HELD_PHRASES = 1 << 19   # entries (phrase, count) likewise
PART_CHARS = 16 << 20    # characters of text for each part of the hashes that is summed in one group
SALTS = 16               # parts of the rows that look up one single word
# fixed values: what ends a piece, and what parts words
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
END = b"\xff"            # stands for the end of a piece; no UTF-8 text holds this byte
TO_PLAIN = bytes.maketrans(bytes(range(65, 91)) + ENDS + BLANKS, bytes(range(97, 123)) + b"\n" * 6 + b"\n" * 4 + b"  ")
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]   # odd multipliers


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    seed = xxh3_64_intdigest(lang.encode())
    return np.array([xxh3_64_intdigest(w, seed) for w in words], np.uint64)


def longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with a further word each."""
    return mixed(h * MIX[0] + word)


class Filter:
    """Bloom filter of phrases, from the words of its bitmap that are not zero."""

    def __init__(self, bits: int, at: np.ndarray, words: np.ndarray):
        self.bits = np.uint64(bits - 1)
        self.words = np.zeros(bits >> 6, np.uint64)
        self.words[at] = words

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in positions(h, self.bits):
            out &= (self.words[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def positions(h: np.ndarray, mask: np.uint64) -> list[np.ndarray]:
    return [h & mask, (h >> np.uint64(32)) & mask, mixed(h) & mask]


def step_back(text: bytes, at: int, cut: int) -> tuple[int, int]:
    """Where the last words before ``cut`` that a phrase across it can hold begin, and how many they are."""
    if text[cut:cut + 1] == b"\n":
        return cut, 0
    shared = min(len(text[max(text.rfind(b"\n", at, cut) + 1, at):cut].split()), LONGEST - 1)
    back = cut
    for _ in range(shared):
        end = len(text[at:back].rstrip(b" ")) + at if text[back - 1:back] == b" " else back
        back = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end), at - 1) + 1
    return back, shared


def runs(text: bytes, run_bytes: int):
    """A plain text cut into (run, words shared with the run before) of about ``run_bytes``;
    a run with a few very long words is longer."""
    at, shared, size = 0, 0, run_bytes
    while len(text) - at > size:
        cut = max(text.rfind(b"\n", at, at + size), text.rfind(b" ", at, at + size))
        back, again = step_back(text, at, cut) if cut > at else (at, 0)
        if back <= at:
            size *= 2
            continue
        yield text[at:cut], shared
        at, shared, size = back, again, run_bytes
    yield text[at:], shared


class Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def levels(text: bytes, lang: str, skip: int, steps: list, guess, longest: int, last: bool):
    """(phrase length, word numbers, hashes, places, words) of the phrases of a run that a pass counts.

    ``guess``: filter of S, or None for all; ``steps``: (longest phrase, filter of the frequent ones) of the
    passes before.  A pass counts what none has counted and whose parts can be frequent, up to ``longest``
    words; the ``last`` pass all that can be frequent.  ``skip``: words at the start that an earlier run has counted.
    """
    number = Numbers({END: 0})
    tokens = text.replace(b"\n", b" \xff ").split()
    a = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
    del tokens
    words = list(number)
    if not len(a):
        return
    value = word_hashes(lang, words)[a]
    valid = a != 0
    yield 0, a, value, np.flatnonzero(valid[skip:]), words
    h, may = value, None
    for k in range(1, LONGEST + 1):
        n = len(a) - k + 1
        if n <= 0:
            return
        if k > 1:
            valid = valid[:n] & (a[k - 1:] != 0)
            h = longer(h[:n], value[k - 1:])
        # by pass: phrases whose parts could be frequent after the passes before it
        inner = [valid if may is None else m[:-1] & m[1:] & valid for m in may or [None] * (len(steps) + 1)]
        may = [guess.has(h) & valid if guess else valid]
        counted = np.zeros(n, bool)
        for s, (most, known) in enumerate(steps):
            if k <= most:
                counted = counted | inner[s]
            may.append(np.where(counted, known.has(h), inner[s + 1]) & valid)
        now = may[-1] if last else inner[-1] & ~counted if k <= longest else np.zeros(n, bool)
        at = np.flatnonzero(now)
        yield k, a, h, at[at + k > skip], words
        if not any(m.any() for m in may):
            return


def count_run(text: bytes, lang: str, skip: int, steps: list, guess=None, longest: int = LONGEST, last: bool = True):
    """(phrase length, phrase, count) of the phrases of a run that a pass counts, and (0, b"", words)."""
    for k, a, h, at, words in levels(text, lang, skip, steps, guess, longest, last):
        if not k:
            yield 0, b"", len(at)
            continue
        for first, count in distinct(a, h, at, k):
            yield k, b" ".join([words[w] for w in a[first:first + k].tolist()]), count


def distinct(a: np.ndarray, h: np.ndarray, at: np.ndarray, k: int):
    """(a place, count) of each different phrase of ``k`` words at the places ``at``; told apart by its words."""
    if not len(at):
        return
    _, first, which, count = np.unique(h[at], return_index=True, return_inverse=True, return_counts=True)
    if all(np.array_equal(a[at + j], a[at[first][which] + j]) for j in range(k)):
        yield from zip(at[first].tolist(), count.tolist(), strict=True)
        return
    rows = np.stack([a[at + j] for j in range(k)], axis=1)     # two phrases of one hash
    _, first, count = np.unique(rows, axis=0, return_index=True, return_counts=True)
    yield from zip(at[first].tolist(), count.tolist(), strict=True)


def text_runs(batches):
    """(lang, plain text, words that an earlier run has counted) of about ``RUN_BYTES`` each, from batches (lang, text)."""
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_py().encode().translate(TO_PLAIN)
            if len(raw) > RUN_BYTES:
                for part, skip in runs(raw, RUN_BYTES):
                    yield lang, part, skip
                continue
            held.setdefault(lang, []).append(raw)
            size += len(raw)
            if size > RUN_BYTES:
                yield from ((lang, b"\n".join(texts), 0) for lang, texts in held.items())
                held.clear()
                size = 0
    yield from ((lang, b"\n".join(texts), 0) for lang, texts in held.items())


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(count, first)


def frequent_hashes(docs: DataFrame, steps: list, guess, longest: int, least: int, parts: int) -> DataFrame:
    """keys (bytes of 64-bit hashes) of the phrases that a pass counts ``least`` times or more, by hash.

    Map tasks add up the counts of some runs and hand them on in ``parts`` by the hash; each
    part is summed in a group of its own."""
    spark = docs.sparkSession
    arrow_batches(spark, 500)
    held = spark.sparkContext.broadcast((steps, guess))
    ends = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)

    def run(batches):
        steps, guess = held.value
        keys, counts, size = [], [], 0

        def handed():
            key, count = summed(keys, counts)
            cut = [0, *np.searchsorted(key, ends).tolist(), len(key)]
            full = [(i, x, y) for i, (x, y) in enumerate(zip(cut, cut[1:], strict=False)) if x < y]
            for group in range(0, len(full), 64):
                some = full[group:group + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _, _ in some], pa.int32()),
                     pa.array([key[x:y].tobytes() for _, x, y in some], pa.binary()),
                     pa.array([count[x:y].astype(np.uint32).tobytes() for _, x, y in some], pa.binary())],
                    ["part", "keys", "counts"])

        for lang, text, skip in text_runs(batches):
            mine = [h[at] for k, _, h, at, _ in levels(text, lang, skip, steps, guess, longest, False) if k and len(at)]
            if not mine:
                continue
            key, count = np.unique(np.concatenate(mine), return_counts=True)
            keys.append(key)
            counts.append(count)
            size += len(key)
            if size > HELD:
                yield from handed()
                keys.clear()
                counts.clear()
                size = 0
        if keys:
            yield from handed()

    def total(part):
        key, count = summed([np.frombuffer(v.as_py(), np.uint64) for v in part.column("keys")],
                            [np.frombuffer(v.as_py(), np.uint32).astype(np.int64) for v in part.column("counts")])
        return pa.table({"keys": pa.array([key[count >= least].tobytes()], pa.binary())})

    return (docs.mapInArrow(run, "part int, keys binary, counts binary")
            .groupBy("part").applyInArrow(total, "keys binary"))


def exact_counts(docs: DataFrame, steps: list, guess, least: int, parts: int) -> DataFrame:
    """lang, k, phrase, f of the phrases that can be frequent and occur ``least`` times or more; a row with
    k = 0 holds a language's words.

    As with the hashes, map tasks add up their runs and hand the phrases on in ``parts``."""
    spark = docs.sparkSession
    arrow_batches(spark, 500)
    held = spark.sparkContext.broadcast((steps, guess))

    def run(batches):
        from xxhash import xxh3_64_intdigest

        steps, guess = held.value
        found: dict[str, Counter] = {}

        def handed():
            for lang, seen in found.items():
                dealt: dict[int, tuple[list, list]] = {}
                for phrase, f in seen.items():
                    p, c = dealt.setdefault(xxh3_64_intdigest(phrase) % parts, ([], []))
                    p.append(phrase)
                    c.append(f)
                for part, (p, c) in dealt.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([lang]), pa.array([b"\n".join(p)], pa.binary()),
                         pa.array([c], pa.list_(pa.int64()))], ["part", "lang", "phrases", "counts"])
            found.clear()

        for lang, text, skip in text_runs(batches):
            mine = found.setdefault(lang, Counter())
            for _, phrase, f in count_run(text, lang, skip, steps, guess):
                mine[phrase] += f
            if sum(map(len, found.values())) > HELD_PHRASES:
                yield from handed()
        yield from handed()

    def total(part):
        sums: dict[str, Counter] = {}
        for lang, phrases, f in zip(part.column("lang").to_pylist(), part.column("phrases"), part.column("counts"), strict=True):
            mine = sums.setdefault(lang, Counter())
            for phrase, n in zip(phrases.as_py().split(b"\n"), f.as_py(), strict=True):
                mine[phrase] += n
        rows = [(lang, p.count(b" ") + 1 if p else 0, p.decode(), f)
                for lang, mine in sums.items() for p, f in mine.items() if f >= least or not p]
        return pa.table([pa.array(c, t) for c, t in zip(
            zip(*rows, strict=True) if rows else [()] * 4, (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)],
            ["lang", "k", "phrase", "f"])

    return (docs.mapInArrow(run, "part int, lang string, phrases binary, counts array<long>")
            .groupBy("part").applyInArrow(total, "lang string, k int, phrase string, f long"))


def build_filter(hashes: DataFrame) -> Filter:
    """Filter of the hashes in rows of keys.  Each sets three bits; bits of one word of the bitmap
    are joined before and after the shuffle, and the words that are not zero make the filter."""
    n = hashes.agg(F.sum(F.length("keys"))).first()[0] or 0
    bits = 1 << 12
    while bits < min(FILTER_BITS, n // 8 * BITS_A_PHRASE):
        bits *= 2
    mask = np.uint64(bits - 1)

    def run(batches):
        for batch in batches:
            for keys in batch.column(0):
                p = np.concatenate(positions(np.frombuffer(keys.as_py(), np.uint64), mask))
                at, which = np.unique((p >> np.uint64(6)).astype(np.int64), return_inverse=True)
                word = np.zeros(len(at), np.uint64)
                np.bitwise_or.at(word, which, np.uint64(1) << (p & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(word.view(np.int64))], ["at", "word"])

    words = (hashes.select("keys").mapInArrow(run, "at long, word long")
             .groupBy("at").agg(F.bit_or("word").alias("word")).toArrow())
    return Filter(bits, words["at"].to_numpy(), words["word"].to_numpy().view(np.uint64))


def frequent_phrases(docs: DataFrame, min_count: int, key: str = "doc_id", text: str = "text",
                     lang: str = "lang") -> DataFrame:
    """lang, k, phrase, f of every phrase of 1 to LONGEST words that occurs ``min_count`` times or more,
    with exact counts, and a row with k = 0 for each language's number of words."""
    rows = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"),
        F.xxhash64(F.col(key), F.col(text)).alias("draw"))
    some = rows.where(F.expr(f"pmod(draw, {SAMPLE}) = 0")).select("lang", "text")
    rows = rows.select("lang", "text")
    expected = min_count / SAMPLE
    least = max(2, int(expected - DEVIATIONS * expected ** 0.5))
    parts = 1 + (rows.agg(F.sum(F.length("text"))).first()[0] or 0) // PART_CHARS
    # the sample: single words and pairs, then longer phrases that the frequent pairs can make
    pairs = stage(frequent_hashes(some, [], None, 2, least, 1 + parts // SAMPLE), "phrases")
    more = stage(frequent_hashes(some, [(2, build_filter(pairs))], None, LONGEST, least, 1 + parts // SAMPLE), "phrases")
    guess = build_filter(pairs.unionByName(more))
    # what the sample proposes and its negative border, by hash, and what the frequent ones of these can make
    found = stage(frequent_hashes(rows, [], guess, LONGEST, min_count, parts), "phrases")
    known = build_filter(found)
    for t in (pairs, more, found):
        drop_stage(t)
    return stage(exact_counts(rows, [(LONGEST, known)], guess, min_count, parts), "phrases")


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000, cover: int = 100, key: str = "doc_id",
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases of 2 to LONGEST words.

    ``score`` is floor(1000 a n / (l r)) at the cut where it is least.  A phrase inside a longer
    candidate that has ``cover`` percent of its count or more is left out.
    """
    found = frequent_phrases(docs, min_count, key, text, lang)
    total = found.where("k = 0").select("lang", F.col("f").alias("n"))
    if total.count() <= 100_000:
        total = F.broadcast(total)
    phrases = found.where("k >= 2").select("lang", "k", "phrase", F.col("f").alias("a"))
    # a frequent single word is in many cuts: their rows are dealt to salts
    cuts = (phrases.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
            .withColumn("first", F.expr("substring_index(phrase, ' ', cut)"))
            .withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
            .withColumn("salt", F.expr(f"pmod(xxhash64(phrase), {SALTS})")))
    parts = (found.where(f"k between 1 and {LONGEST - 1}")
             .withColumn("salt", F.explode(F.expr(f"if(k = 1, sequence(0L, {SALTS - 1}L), array(0L))"))))
    for part, count, one in (("first", "l", "cut = 1"), ("rest", "r", "k - cut = 1")):
        side = parts.select("lang", F.col("phrase").alias(part), F.col("salt").alias("dealt"), F.col("f").alias(count))
        cuts = cuts.withColumn("dealt", F.expr(f"if({one}, salt, 0L)")).join(side, ["lang", part, "dealt"])
    big = "decimal(38,0)"
    scored = (cuts.join(total, "lang")
              .withColumn("score", F.expr(f"(cast(1000 as {big}) * a * n) div (cast(l as {big}) * r)"))
              .groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("at"))
              .select("lang", "phrase", "at.*"))
    inner = (phrases.where("k >= 3")
             .withColumn("size", F.explode(F.expr("sequence(2, k - 1)")))
             .withColumn("start", F.explode(F.expr("sequence(1, k - size + 1)")))
             .select("lang", F.expr("array_join(slice(split(phrase, ' '), start, size), ' ')").alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("held")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .where(f"held is null or cast(100 as {big}) * held < cast({int(cover)} as {big}) * a"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = collocations(docs)
    return out.withColumn("rank", F.col("rank").cast("long"))
