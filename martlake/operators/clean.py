"""Row cleaning, filtering, dedup and audits.

Dedup is written as an aggregate (``min_by`` per key) wherever only one row
per key survives: a hash aggregate combines map-side, so a key holding a third
of the rows is reduced in every task before the shuffle instead of being
sorted in one window partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, BooleanType, StringType

from martlake.functions.scalars import clip
from martlake.session import is_staged, stage_table


def require_columns(df: DataFrame, required) -> DataFrame:
    """S5 (frame form): raise when any required column is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"DataFrame must contain columns: {sorted(required)}; missing {missing}")
    return df


def drop_columns(df: DataFrame, cols, strict: bool = False) -> DataFrame:
    """Drop columns; ``strict`` raises on absent ones (pandas default)."""
    if strict:
        require_columns(df, cols)
    return df.drop(*[c for c in cols if c in df.columns])


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """NULL -> constant per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def sentinel_to_null(df: DataFrame, sentinel: str = "unknown", cols=None) -> DataFrame:
    """A sentinel text value becomes NULL on every (or the given) string column."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in cols})


def positive(df: DataFrame, cols=("UnitPrice",)) -> DataFrame:
    """P5: keep rows where every given column is > 0 (pushed to the scan)."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c) > 0 for c in cols]))


def in_range(df: DataFrame, bounds: dict) -> DataFrame:
    """Inclusive range filter, ``{col: (lo, hi)}``."""
    return df.where(reduce(lambda a, b: a & b,
                           [F.col(c).between(lo, hi) for c, (lo, hi) in bounds.items()]))


def drop_nulls(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows holding a NULL (or a float NaN, as pandas does) in the
    subset or in any column."""
    subset = list(subset or df.columns)
    return df.where(no_nulls(df, subset)) if subset else df


def no_nulls(df: DataFrame, subset) -> Column:
    """P7 as a condition: no column of ``subset`` is NULL (or a float NaN)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    conds = []
    for c in subset:
        cond = F.col(c).isNotNull()
        if isinstance(types[c], (DoubleType, FloatType)):
            cond = cond & ~F.isnan(F.col(c))
        conds.append(cond)
    return reduce(lambda a, b: a & b, conds)


# percentile_approx returns a value whose rank is off by at most n / SKETCH
SKETCH = 10_000


def quantiles(df: DataFrame, cols, probs, by=(), accuracy: int | None = None, copy: bool = True) -> DataFrame:
    """One row per ``by`` group with ``{col}_q{i}``, the exact quantile with
    linear interpolation, by one method at every size.

    NULL and NaN values are ignored; every group of ``df`` gets its row, a group
    without values has NULL quantiles; a NULL group key is a group.  ``accuracy``
    gives ``percentile_approx`` with that accuracy instead.

    A mergeable sketch brackets each quantile between two values of nearby
    ranks.  A second pass counts the values below the bracket and, grouped by
    value, those inside it, about ``4 / SKETCH`` of all; ranks inside the bracket
    are then exact.  No task holds a map of all values and no value is gathered,
    so neither a continuous column nor a value that most rows share is a problem.
    The columns are read three times; ``copy`` writes them as a table first, which a
    ``df`` that is a plain scan or a staged table does not need.
    """
    cols, probs, by = list(cols), [float(p) for p in probs], list(by)
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    key = [f"_g{i}" for i in range(len(by))]
    base = df.select(*[F.col(b).alias(k) for b, k in zip(by, key, strict=True)],
                     *[number(c).alias(f"_x{i}") for i, c in enumerate(cols)])
    names = [F.col(k).alias(b) for b, k in zip(by, key, strict=True)]
    if accuracy:
        out = base.groupBy(*key).agg(*[F.percentile_approx(f"_x{i}", probs, accuracy).alias(f"_a{i}")
                                       for i in range(len(cols))])
        return out.select(*names, *[F.col(f"_a{i}")[j].alias(f"{c}_q{j}")
                                    for i, c in enumerate(cols) for j in range(len(probs))])
    if copy and not is_staged(df):
        base = stage_table(base, "quantiles")
    ends = [p for q in probs for p in (max(0.0, q - 2 / SKETCH), min(1.0, q + 2 / SKETCH))]
    sketch = base.groupBy(*key).agg(
        *[F.percentile_approx(f"_x{i}", ends, SKETCH).alias(f"_a{i}") for i in range(len(cols))],
        *[F.count(f"_x{i}").alias(f"_n{i}") for i in range(len(cols))])
    if key:
        sketch = stage_table(sketch, "quantiles")
        side = sketch.select(*[F.col(k).alias(f"_s{k}") for k in key], *[f"_a{i}" for i in range(len(cols))])
        rows = base.join(side, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s{k}")) for k in key]))
        end = lambda i, at: F.col(f"_a{i}")[at]
    else:
        one, rows = sketch.first(), base        # a few numbers for each column
        end = lambda i, at: F.lit(one[f"_a{i}"][at] if one[f"_a{i}"] else None).cast("double")
    cells = [(i, j) for i in range(len(cols)) for j in range(len(probs))]
    x = lambda i: F.col(f"_x{i}")
    lo, hi = (lambda i, j: end(i, 2 * j)), (lambda i, j: end(i, 2 * j + 1))
    # around the bracket: how many values lie below, and the next values on both sides
    around = rows.groupBy(*key).agg(*[e for i, j in cells for e in (
        F.count_if(x(i) < lo(i, j)).alias(f"_b{i}_{j}"),
        F.max(F.when(x(i) < lo(i, j), x(i))).alias(f"_u{i}_{j}"),
        F.min(F.when(x(i) > hi(i, j), x(i))).alias(f"_o{i}_{j}"))])
    inside = F.filter(F.array(*[F.struct(
        F.lit(i).alias("i"), F.lit(j).alias("j"),
        F.when((x(i) >= lo(i, j)) & (x(i) <= hi(i, j)), x(i)).alias("v")) for i, j in cells]),
        lambda e: e["v"].isNotNull())
    # few rows lie in any bracket; only these build the array
    near = reduce(lambda a, b: a | b, [(x(i) >= lo(i, j)) & (x(i) <= hi(i, j)) for i, j in cells])
    counts = (rows.where(near).select(*key, F.explode(inside).alias("e")).select(*key, "e.*")
              .groupBy(*key, "i", "j", "v").agg(F.count(F.lit(1)).alias("c")))
    upto = F.sum("c").over(Window.partitionBy(*key, "i", "j").orderBy("v"))
    counts = counts.withColumn("upto", upto)
    if key:
        beside = around.select(*[F.col(k).alias(f"_s{k}") for k in key], *[c for c in around.columns if c not in key])
        known = sketch.join(beside, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s{k}")) for k in key]))
    else:
        known = around.withColumns({f"_n{i}": F.lit(one[f"_n{i}"]) for i in range(len(cols))})
    target = known.select(*key, F.explode(F.array(*[F.struct(
        F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"_n{i}").alias("n"),
        ((F.col(f"_n{i}") - 1) * F.lit(p)).alias("h"), F.col(f"_b{i}_{j}").alias("below"),
        F.col(f"_u{i}_{j}").alias("under"), F.col(f"_o{i}_{j}").alias("over"))
        for i in range(len(cols)) for j, p in enumerate(probs)])).alias("t")).select(*key, "t.*")
    target = target.select(*[F.col(k).alias(f"_s{k}") for k in key], F.col("i").alias("_i"), F.col("j").alias("_j"),
                           "n", "h", "below", "under", "over")
    on = (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j"))
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"_s{k}"))
    reached = lambda rank: F.min(F.when(F.col("below") + F.col("upto") > rank, F.col("v")))
    got = (target.join(counts, on, "left").groupBy(*[f"_s{k}" for k in key], "_i", "_j")
           .agg(reached(F.floor("h")).alias("a"), reached(F.ceil("h")).alias("b"),
                *[F.first(c).alias(c) for c in ("h", "below", "under", "over")]))
    first = F.when(F.floor("h") < F.col("below"), F.col("under")).otherwise(F.col("a"))
    second = F.coalesce(F.when(F.ceil("h") < F.col("below"), F.col("under")).otherwise(F.col("b")), F.col("over"))
    value = F.when(F.floor("h") == F.ceil("h"), F.coalesce(first, second)).otherwise(
        first + (F.col("h") - F.floor("h")) * (second - first))
    wide = (got.withColumn("q", value).groupBy(*[f"_s{k}" for k in key])
            .agg(*[F.max(F.when((F.col("_i") == i) & (F.col("_j") == j), F.col("q"))).alias(f"{c}_q{j}")
                   for i, c in enumerate(cols) for j in range(len(probs))]))
    out = [f"{c}_q{j}" for c in cols for j in range(len(probs))]
    if not key:
        # one row: known now, so that no plan that uses it holds this one again
        return df.sparkSession.createDataFrame([tuple(wide.select(*out).first())], ", ".join(f"`{c}` double" for c in out))
    return wide.select(*[F.col(f"_s{k}").alias(b) for b, k in zip(by, key, strict=True)], *out)


def quantile_bounds(df: DataFrame, cols, lo: float = 0.01, hi: float = 0.99,
                    accuracy: int | None = None, copy: bool = True) -> DataFrame:
    """One-row frame ``{col}_lo, {col}_hi`` (see ``quantiles``)."""
    q = quantiles(df, cols, [lo, hi], accuracy=accuracy, copy=copy)
    return q.select(*[e for c in cols for e in (F.col(f"{c}_q0").alias(f"{c}_lo"),
                                                F.col(f"{c}_q1").alias(f"{c}_hi"))])


def within_quantile_band(df: DataFrame, cols, lo: float = 0.01, hi: float = 0.99,
                         accuracy: int | None = None, copy: bool = True) -> DataFrame:
    """Keep rows with q_lo <= x <= q_hi on every column; all bounds are
    computed on the input before filtering.  The bounds are one row, joined
    by broadcast (its size never grows)."""
    b = quantile_bounds(df, cols, lo, hi, accuracy, copy)
    cond = reduce(lambda a, c: a & (F.col(c) >= F.col(f"{c}_lo")) & (F.col(c) <= F.col(f"{c}_hi")),
                  cols, F.lit(True))
    return df.crossJoin(F.broadcast(b)).where(cond).select(*df.columns)


def numeric_columns(df: DataFrame, exclude=()) -> list:
    """Numeric columns (booleans excluded) minus ``exclude``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)
            and f.name not in set(exclude)]


def dedup_keep_first(df: DataFrame, subset, order) -> DataFrame:
    """One row per ``subset`` key, the first by ``order`` (a list
    of columns giving a total order).  Aggregate form: map-side combine."""
    subset = list(subset)
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.select(*subset).distinct()
    order_struct = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    if set(rest) <= {c for c in order if isinstance(c, str)}:
        kept = F.min(order_struct).alias("_kept")       # the order holds all that is left
    else:
        kept = F.min_by(F.struct(*rest), order_struct).alias("_kept")
    return df.groupBy(*subset).agg(kept).select(*subset, "_kept.*").select(*df.columns)


def dedup_ranked(df: DataFrame, key, rank_cols, tie_col: str,
                 mode: str = "keep_best", sentinel: str = "unknown") -> DataFrame:
    """Ranked dedup of rows sharing ``key`` (a column or several).

    ``rank_cols`` are sorted ascending with the sentinel treated as NULL and
    NULLs last; ``tie_col`` is the source position, unique inside a key.
    ``mode='drop_last'`` (reference behaviour) removes only the last row of every
    duplicate group, ties removing the latest in the file, so a group of n keeps
    n-1.  ``mode='keep_best'`` keeps rank 1 only (known values first, then the
    earliest row), which satisfies the target primary key.

    Both are aggregates that combine before the shuffle, so a hot key is not
    gathered in one task.
    """
    key = [key] if isinstance(key, str) else list(key)
    known = [F.nullif(F.col(c), F.lit(sentinel)) for c in rank_cols]
    rank = F.struct(*[x for k in known for x in (k.isNull(), k)], F.col(tie_col))
    rest = [c for c in df.columns if c not in key]
    if mode == "keep_best":
        best = df.groupBy(*key).agg(F.min_by(F.struct(*rest), rank).alias("_best"))
        return best.select(*key, "_best.*").select(*df.columns)
    if mode == "drop_last":
        last = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.max(rank).alias("_last")).where("_n > 1")
        last = last.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], "_last")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)])
        return df.withColumn("_rank", rank).join(
            last, same & F.col("_rank").eqNullSafe(F.col("_last")), "left_anti").drop("_rank")
    raise ValueError(f"unknown mode {mode!r}")


def mark_duplicates(df: DataFrame, subset, out: str = "is_dup") -> DataFrame:
    """Flag every member of a duplicate group (keep=False).  Counts combine
    before the shuffle; their join back is one that skew handling can split."""
    subset = list(subset)
    many = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n"))
    many = many.where("_n > 1").select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(subset)], "_n")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(subset)])
    return (df.join(many, same, "left").withColumn(out, F.col("_n").isNotNull())
            .select(*df.columns, out))


def null_audit(df: DataFrame, cols=None) -> DataFrame:
    """NULL (and NaN) count per column, long format (column, null_count).
    One aggregate pass, then the single result row is unpivoted."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}

    def is_missing(c):
        m = F.col(c).isNull()
        if isinstance(types[c], (DoubleType, FloatType)):
            m = m | F.isnan(F.col(c))
        return m

    one = df.agg(*[F.count_if(is_missing(c)).alias(c) for c in cols])
    return one.unpivot([], cols, "column_name", "null_count")


def duplicate_audit(df: DataFrame, subset=None) -> DataFrame:
    """Total rows, rows in duplicate groups (keep=False) and later
    duplicates (keep='first'), with the percentage of later duplicates.
    Grouped counts first (combines map-side), then one global sum."""
    subset = list(subset or df.columns)
    g = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(
        F.sum("_n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("n_in_dup_groups"),
        F.sum(F.col("_n") - 1).alias("n_later_dups"),
    ).withColumn("pct_later_dups",
                 F.coalesce(F.try_divide(F.col("n_later_dups") * 100.0, F.col("n_rows")), F.lit(0.0)))
