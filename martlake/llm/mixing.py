"""Mixing sources to target weights by a low-discrepancy schedule (operator 1).

1. Sizes (words) are summed per source; targets are weight shares of the total,
   capped at ``max_epochs`` times a source's size, the excess reshared by weight.
2. Each source's documents are shuffled by a hash and laid end to end; the
   stream is cut into blocks of equally many words.
3. Slot k of the schedule sits at the golden-ratio point ``frac(k * 0.618..)``;
   the point is mapped through the cumulative targets to a source.
4. Slots are ranked within their source; rank r takes block ``r mod n_blocks``.
   A slot past ``max_epochs`` passes takes nothing.
5. Blocks taken are joined to the parts of documents that they hold.

Scale: offsets come from prefix sums over (source, bucket of the shuffle hash)
and a small table of bucket totals, ranks from prefix sums over (source, run of
slots), so a source with a third of all rows is spread over many tasks.  Points
are exact integers modulo 2**40.  Blocks hold ``total / slots`` words, so the
schedule has about ``slots`` rows at any size and a source's taken words miss
its target by a few blocks, about 1e-5 of the total.  A source whose target is
less than ``LEAST_SLOTS`` such blocks has shorter blocks and a wider interval, so
that it has ``LEAST_SLOTS`` slots or more (one a word, if it has fewer words) and
misses its target by a few of its own blocks; the schedule grows by at most twice
``LEAST_SLOTS`` a source.

Edge cases: null or empty texts have size 0 and are never taken; a null source
is a source of its own, last in order; repeated rows are documents of their
own (ties in the shuffle are broken by doc_id, then size; what is left equal is
interchangeable); without any word every target is 0; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from martlake.llm.common import WORD, free_names, n_words, stage, table

SLOTS = 1 << 18          # slots in a schedule, about
LEAST_SLOTS = 1 << 10    # slots of a source, or one a word of its target
POINT_BITS = 40          # points are integers below 2**40
GOLDEN = 679_535_556_991  # 2**40 * (sqrt(5) - 1) / 2, cut to an odd integer
BUCKET_ROWS = 1_000      # documents in one shuffle bucket, about
GROUP_BUCKETS = 4096     # buckets whose words are summed up in one task
RUN = 4096               # slots in one ranking run
CELLS = 1 << 12          # cells of the unit interval, for the join of points to sources


def source_targets(sizes: DataFrame, weights=(1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """Per source: place in order, source_size, weight, target.

    The capped shares in closed form: sources fill up in order of
    ``cap / weight``; the first whose cap is not reached sets the level.
    One row per source, so the ordering windows hold no documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    per = (per.withColumn("place", place).withColumn("weight", pick)
           .withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size")))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    per = per.withColumn("own_level", level)
    fits = F.when(F.col("own_level") * F.col("weight") <= F.col("cap"), F.col("own_level"))
    whole = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("level", F.first(fits, ignorenulls=True).over(whole))
    return per.select("source", "place", "source_size", "weight", F.coalesce(
        F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def lay_out(sizes: DataFrame, targets: DataFrame, n_docs: int, seed: int) -> DataFrame:
    """Adds ``start``: words of the source's shuffled stream before the document."""
    spread = sizes.join(targets.select(F.col("source").alias("s"), "place"),
                        F.col("source").eqNullSafe(F.col("s"))).drop("s")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    n = max(1, -(-n_docs // BUCKET_ROWS))
    at = F.conv(F.substring("mix", 1, 8), 16, 10).cast("long")
    spread = spread.withColumn("mix", order).withColumn("bucket", F.shiftright(at * n, 32))
    spread = spread.where("size > 0")
    totals = spread.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
    # words ahead of a bucket: of the groups of buckets before its own, then of those before it in its group
    totals = totals.withColumn("group", F.floor(F.col("bucket") / GROUP_BUCKETS))
    groups = totals.groupBy("place", "group").agg(F.sum("words").alias("words"))
    earlier = Window.partitionBy("place").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("place", "group", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("earlier"))
    ahead = Window.partitionBy("place", "group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (totals.withColumn("near", F.coalesce(F.sum("words").over(ahead), F.lit(0))).join(groups, ["place", "group"])
              .select("place", "bucket", (F.col("earlier") + F.col("near")).alias("ahead")))
    within = (Window.partitionBy("place", "bucket").orderBy("mix", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (spread.withColumn("here", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(totals, ["place", "bucket"])
            .select("doc_id", "source", "place", "size", (F.col("ahead") + F.col("here")).alias("start")))


def golden_points(spark: SparkSession, n_slots: int) -> DataFrame:
    """Slots 0..n-1 with their golden-ratio points below 2**POINT_BITS, in exact integers."""
    one = 1 << POINT_BITS
    high, low = F.shiftright("id", 20), F.col("id").bitwiseAND((1 << 20) - 1)
    point = (high * F.lit((GOLDEN << 20) % one) % one + low * F.lit(GOLDEN) % one) % one
    return spark.range(n_slots).select(F.col("id").alias("slot"), point.alias("point"))


def with_blocks(targets: DataFrame, block: int) -> DataFrame:
    """Adds ``block``, the words in a source's blocks, and ``width``, its share of the schedule in words of ``block``."""
    own = F.least(F.lit(block), F.greatest(F.lit(1), F.floor(F.col("target") / LEAST_SLOTS))).cast("long")
    return targets.withColumn("block", own).withColumn("width", F.when(
        F.col("block") == block, F.col("target")).otherwise(F.col("target") * (F.lit(float(block)) / F.col("block"))))


def schedule(spark: SparkSession, targets: DataFrame, n_slots: int) -> DataFrame:
    """slot, place, rank: the source of each slot and its rank among the source's slots.

    A source's interval is as wide as its ``width`` among those of all sources.

    The points join the sources' intervals by the cell of the unit interval that
    both lie in, then by the interval's ends.
    """
    one = 1 << POINT_BITS
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cum = targets.where("target > 0").select(
        "place", F.sum("width").over(upto).alias("c"), F.sum("width").over(everything).alias("t"))
    last = F.max("place").over(everything)
    cum = cum.select("place", F.when(F.col("place") == last, F.lit(one)).otherwise(
        F.floor(F.col("c") / F.col("t") * one)).alias("hi"))
    ends = cum.select("place", F.coalesce(F.lag("hi").over(Window.orderBy("place")), F.lit(0)).alias("lo"), "hi")
    width = one // CELLS
    cells = ends.where("hi > lo").select("place", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))
    slots = (golden_points(spark, n_slots).withColumn("cell", F.floor(F.col("point") / width))
             .join(cells, "cell").where("point >= lo and point < hi")
             .select("slot", "place", F.floor(F.col("slot") / RUN).alias("run")))
    counts = slots.groupBy("place", "run").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("place").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("place", "run", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("place", "run").orderBy("slot")
    return (slots.withColumn("here", F.row_number().over(within) - 1).join(counts, ["place", "run"])
            .select("slot", "place", (F.col("ahead") + F.col("here")).alias("rank")))


def mix(sizes: DataFrame, weights=(1, 2, 3), max_epochs: int = 3, slots: int = SLOTS,
        seed: int = 7) -> dict[str, DataFrame]:
    """Mix documents given by ``sizes`` (doc_id, source, size).

    Returns ``targets`` (with ``block`` and ``width``), ``layout`` (documents with words, in shuffled order),
    ``draws`` (slot, source place, block, times the block was taken before) and
    ``taken`` (one row per row of ``sizes``: doc_id, size, source_size, target, taken).
    """
    spark = sizes.sparkSession
    sizes = stage(sizes.select("doc_id", "source", F.col("size").cast("long").alias("size")), "mix-sizes")
    n_docs, total = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = max(1, -(-total // slots))
    targets = stage(with_blocks(source_targets(sizes, weights, max_epochs), block), "mix-targets")
    n_slots = total
    if not targets.where(F.col("block") < block).isEmpty():
        n_slots = math.ceil(targets.agg(F.sum("width")).first()[0])
    layout = stage(lay_out(sizes, targets, n_docs, seed), "mix-layout")
    blocks = F.ceil(F.col("source_size") / F.col("block"))
    draws = (schedule(spark, targets, -(-n_slots // block) if total else 0)
             .join(targets.select("place", blocks.alias("n_blocks")), "place")
             .select("slot", "place", (F.col("rank") % F.col("n_blocks")).alias("block"),
                     F.floor(F.col("rank") / F.col("n_blocks")).alias("epoch"))
             .where(F.col("epoch") < max_epochs))
    times = draws.groupBy("place", "block").agg(F.count("*").alias("times"))
    end = F.col("start") + F.col("size")
    words_each = targets.select("place", F.col("block").alias("each"))
    parts = layout.join(words_each, "place").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / F.col("each")), F.floor((end - 1) / F.col("each")))))
    held = (F.least(end, (F.col("block") + 1) * F.col("each"))
            - F.greatest(F.col("start"), F.col("block") * F.col("each")))
    words = (parts.join(times, ["place", "block"]).groupBy("place", "start", "size", "doc_id")
             .agg(F.sum(held * F.col("times")).alias("taken")))
    known = layout.join(words.select(F.col("place").alias("p"), F.col("start").alias("s"), "taken"),
                        (F.col("place") == F.col("p")) & (F.col("start") == F.col("s")), "left")
    rows = (known.select("doc_id", "source", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
            .unionByName(sizes.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"))))
    taken = (rows.join(targets.select(F.col("source").alias("s"), "source_size", "target"),
                       F.col("source").eqNullSafe(F.col("s")))
             .select("doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken")))
    return {"targets": targets, "layout": layout, "draws": draws, "taken": taken}


def document_sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", n_words("text").alias("size"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document once for each time that all its words
    are taken, and the words taken of the last, unfinished pass as a shorter text.

    Rows are told apart by two independent hashes of all their columns; rows that
    are equal in all of them are drawn as one document as often as all of them together.
    """
    columns = docs.columns
    tag, n, got, rest_ = free_names(columns, ["__tag", "__size", "__taken", "__rest"])
    # a map has no hash of its own
    parts = [F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`")
             for f in docs.schema.fields]
    parts.append(F.array(*[F.col(f"`{c}`").isNull() for c in columns]))     # a hash passes over nulls
    rows = docs.withColumn(tag, F.concat_ws(":", *[F.hex(F.xxhash64(F.lit(i), *parts)) for i in (1, 2)]))
    sizes = rows.select(F.col(tag).alias("doc_id"), "source", n_words("text").alias("size"))
    taken = (mix(sizes, **options)["taken"].where("taken > 0").groupBy(F.col("doc_id").alias(tag))
             .agg(F.first("size").alias(n), F.sum("taken").alias(got)))
    drawn = rows.dropDuplicates([tag]).join(taken, tag)
    whole = F.floor(F.col(got) / F.col(n))
    rest = (F.col(got) % F.col(n)).cast("int")
    drawn = drawn.withColumn(rest_, F.explode(F.concat(
        F.array_repeat(F.lit(0), whole.cast("int")), F.when(rest > 0, F.array(rest)).otherwise(F.array()))))
    start = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col(rest_)), " ")
    drawn = drawn.withColumn("text", F.when(F.col(rest_) > 0, start).otherwise(F.col("text")))
    if "n_chars" in columns:
        drawn = drawn.withColumn("n_chars", F.when(F.col(rest_) > 0, F.length("text").cast("long"))
                                 .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return drawn.select(*columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(document_sizes(table(spark, sf_dir, "documents")))["taken"].select(
        "doc_id", "size", "source_size", "target", "taken")
