"""Cleaning, dedup and audit operators: hand goldens."""

from pyspark.sql import functions as F

from martlake.operators import clean as C


def test_dedup_keep_first_by_order(spark):
    df = spark.createDataFrame([("B", "x", 1), ("A", "x", 1), ("C", "y", 2)], "inv string, item string, q int")
    got = sorted(tuple(r) for r in C.dedup_keep_first(df, ["item", "q"], ["inv"]).collect())
    assert got == [("A", "x", 1), ("C", "y", 2)]


def _hits(spark):
    rows = [  # hit_id, referer, label, pos
        ("h1", "unknown", "a", 1), ("h1", "b", "a", 2), ("h1", "a", "unknown", 3),   # triple
        ("h2", "x", "l", 4), ("h2", "x", "l", 5),                                    # exact tie
        ("h3", "z", "q", 6),                                                         # single
    ]
    return spark.createDataFrame(rows, "hit_id string, hit_referer string, event_label string, pos int")


def test_dedup_ranked_drop_last_reference(spark):
    # reference: sort ascending with 'unknown' as NULL last, drop the LAST row of
    # each duplicate group (ties: the latest in the file)
    out = C.dedup_ranked(_hits(spark), "hit_id", ["hit_referer", "event_label"], "pos", mode="drop_last")
    assert sorted(r.pos for r in out.collect()) == [2, 3, 4, 6]


def test_dedup_ranked_keep_best(spark):
    out = C.dedup_ranked(_hits(spark), "hit_id", ["hit_referer", "event_label"], "pos", mode="keep_best")
    assert sorted(r.pos for r in out.collect()) == [3, 4, 6]


def test_quantile_band_bounds_before_filter(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("a"), (100 - F.col("id")).cast("double").alias("b"))
    b = C.quantile_bounds(df, ["a"]).first()
    assert abs(b.a_lo - 1.0) < 1e-12 and abs(b.a_hi - 99.0) < 1e-12
    assert C.within_quantile_band(df, ["a", "b"]).count() == 99


def test_quantiles_equal_percentile(spark):
    """Against Spark's own percentile, with groups that are NULL, hold NaN or nothing, tiny groups and
    one value that a third of the rows share."""
    n = F.col("id")
    df = spark.range(30_000).select(
        F.when(n % 5 == 4, None).otherwise(n % 5).alias("g"),
        F.when(n % 3 == 0, 7.5).when(n % 11 == 0, None).when(n % 13 == 0, float("nan")).otherwise(F.rand(7) * 20).alias("x"),
        (F.randn(3)).alias("y"))
    extra = [(10, None, None), (11, float("nan"), 1.0), (12, 1.0, 2.0), (12, 5.0, 3.0), (13, 2.0, 0.0)]
    df = df.unionByName(spark.createDataFrame(extra, "g long, x double, y double")).cache()
    probs = [0.0, 0.01, 1 / 3, 0.5, 0.9, 0.99, 1.0]
    number = lambda c: F.when(~F.isnan(c), F.col(c))
    for by in ([], ["g"]):
        want = {r["g"] if by else None: r for r in df.groupBy(*by).agg(
            *[F.percentile(number(c), F.array(*map(F.lit, probs))).alias(c) for c in ("x", "y")]).collect()}
        got = {r["g"] if by else None: r for r in C.quantiles(df, ["x", "y"], probs, by=by).collect()}
        assert set(got) == set(want)
        for g, w in want.items():
            for c in ("x", "y"):
                mine = [got[g][f"{c}_q{j}"] for j in range(len(probs))]
                assert mine == (w[c] or [None] * len(probs)) or all(
                    abs(a - b) < 1e-9 for a, b in zip(mine, w[c], strict=True)), (g, c)
    assert C.quantiles(df.limit(0), ["x"], [0.5]).first().x_q0 is None


def test_null_and_duplicate_audit(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0), (None, float("nan"))], "a int, b double")
    na = {r.column_name: r.null_count for r in C.null_audit(df).collect()}
    assert na == {"a": 1, "b": 3}
    d = C.duplicate_audit(df).first()
    assert (d.n_rows, d.n_in_dup_groups, d.n_later_dups) == (4, 2, 1)


def test_drop_nulls_counts_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert C.drop_nulls(df).count() == 1


def test_mark_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert sorted((r.k, r.is_dup) for r in C.mark_duplicates(df, ["k"]).collect()) == \
        [("a", True), ("a", True), ("b", False)]
