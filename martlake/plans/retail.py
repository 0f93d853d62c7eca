"""The retail feature job as a chain of ``df.transform`` steps.

preprocess -> temporal features -> RFM segment -> demand features -> finalize.
Each step returns a lazy DataFrame, so the whole chain is one Catalyst plan;
the only materialisation is the checkpoint inside the scalable row index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.calendar import (add_calendar_flags, add_cyclic, add_log_features,
                                         add_time_parts)
from martlake.operators import aggregates as A
from martlake.operators import clean as C
from martlake.operators import demand as D
from martlake.operators import rfm as R
from martlake.session import drop_table, is_staged, passing_tables, stage_table

DEDUP_SUBSET = ("StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
                "CustomerID", "Country")
# Categorical features always kept by the script form of the selection.
ALWAYS_SELECTED = ("HolidaySeason", "RFM_Cluster", "IsPopularItem", "IsDiscounted")
TARGET = "log_Quantity"
# Measures that the final table leaves out; a missing value in another column drops the row.
RAW_MEASURES = ("Quantity", "TotalSum", "UnitPrice")


def clean_rows(raw: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Positive price, one row per all-columns-but-invoice (first invoice kept).

    ``items``: the distinct (StockCode, Description) for a ``raw`` without descriptions.  As these
    depend on the StockCode alone, joined to the rows that the dedup leaves they give the
    rows of a dedup with descriptions, and no text goes through its shuffle."""
    subset = [c for c in DEDUP_SUBSET if c in raw.columns]
    df = C.positive(raw, ["UnitPrice"])
    df = C.dedup_keep_first(df, subset, ["InvoiceNo"])
    return df if items is None else describe(df, items)


def describe(df: DataFrame, items: DataFrame) -> DataFrame:
    """Rows with the descriptions of their item; one that has none keeps its rows."""
    return df.join(items, "StockCode", "left")


def preprocess(raw: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """:func:`clean_rows` with log features, hour and day of year."""
    return clean_rows(raw, items).transform(add_log_features).transform(add_time_parts)


def row_features(df: DataFrame) -> DataFrame:
    """What follows from a row's own columns."""
    return df.transform(add_log_features).transform(date_features)


def date_features(df: DataFrame) -> DataFrame:
    """F9, F14–F18."""
    return df.transform(add_time_parts).transform(add_calendar_flags).transform(add_cyclic)


def temporal_features(df: DataFrame) -> DataFrame:
    """F14–F18, F9, F28, W10."""
    return (df.transform(add_calendar_flags).transform(add_cyclic)
            .transform(A.flag_popular).transform(A.flag_below_group_median))


def rfm_segments(df: DataFrame, method: str = "kmeans", k: int = 3, seed: int = 42) -> DataFrame:
    """A1 + M3 (or the rule-based stand-in) over the RFM input of ``df``."""
    rfm = R.rfm_table(R.rfm_input(df))
    if method == "kmeans":
        return R.kmeans_segments(rfm, k=k, seed=seed)
    return R.rule_segments(stage_table(rfm, "rfm"))      # one row per customer, read for the cuts and the labels


def with_segments(df: DataFrame, method: str = "kmeans") -> DataFrame:
    """Attach RFM_Cluster (NULL for rows without a customer)."""
    return R.attach_segment(df, rfm_segments(df, method))


def finalize(df: DataFrame) -> DataFrame:
    """P1 + P7: drop the raw measures and every row holding a missing value."""
    return C.drop_nulls(C.drop_columns(df, RAW_MEASURES))


# Columns that the segments, the series and their joins read.
FEATURE_KEYS = ("InvoiceNo", "StockCode", "InvoiceDate", "CustomerID", "Quantity", "UnitPrice")
# Rows that the join of the series features takes at once; more are joined part by part.
PART_ROWS = 1 << 25
# Row features made of the quantity and the price; the others are made of the date.
LOG_FEATURES = ("log_Quantity", "log_UnitPrice", "TotalSum", "log_TotalSum")


def staged_rows(raw: DataFrame, items: DataFrame | None, columns) -> DataFrame:
    """Those of ``columns`` that :func:`clean_rows` has, and ``_whole``, whether a row and its features hold no
    missing value, as a staged table.  The texts are carried along only where asked for, and the
    dedup's shuffle files are gone before the descriptions are joined."""
    def flagged(df):
        full = row_features(df)
        whole = C.no_nulls(full, [c for c in full.columns if c not in RAW_MEASURES])
        return full.withColumn("_whole", whole).select(*[c for c in df.columns if c in columns], "_whole")

    rows = flagged(clean_rows(raw))
    if items is None:
        return stage_table(rows, "retail")
    with passing_tables() as passing:
        rows = stage_table(rows, "rows")
        described = describe(rows, items).withColumn("_whole", F.col("_whole") & F.col("Description").isNotNull())
        return passing.keep(stage_table(described.select(*[c for c in described.columns if c in columns], "_whole"), "retail"))


def feature_table(raw: DataFrame, segments: str = "kmeans", columns=None, items: DataFrame | None = None) -> DataFrame:
    """Everything up to the final feature table (no row index, no selection).

    Stage boundaries are written as Parquet tables to the shared checkpoint
    folder, so each reader scans its own columns: the cleaned fact rows (read by the popularity, median, RFM
    and demand branches and the final join), the customer segments and the
    series features.  Each later stage then starts from a short plan; without
    the cuts every one-row statistic joined back (quantile bounds, reference
    date, cut points) embeds the whole upstream plan again and the plan grows
    multiplicatively.  A lost executor re-reads the table instead of
    recomputing the chain.

    ``columns``: only these of the table, with the same rows.  Flags, lags and
    windows that none of them needs are not computed; the stage tables hold
    what is needed alone.  What follows from a row's own columns, or from its
    windows, is computed after the joins, which carry less then.

    ``items``: see :func:`clean_rows`."""
    def segment_labels(df):
        with passing_tables() as passing:
            return passing.keep(stage_table(rfm_segments(df, segments).select("CustomerID", "RFM_Cluster"), "segments"))

    if columns is None:
        df = stage_table(preprocess(raw, items).transform(temporal_features), "retail")
        seg = segment_labels(df)
        with passing_tables() as passing:
            feats = passing.keep(stage_table(D.demand_features(D.demand_series(df)), "series-features"))
        return finalize(D.join_series_features(R.attach_segment(df, seg), feats))
    wanted = set(columns)
    logs = not wanted.isdisjoint(LOG_FEATURES)
    needed = {"InvoiceDate", "StockCode", *wanted, *(("Quantity", "UnitPrice") if logs else ())}
    df = staged_rows(raw, items, {*wanted, *FEATURE_KEYS})
    # each step's table takes the place of those that no later one reads
    with passing_tables() as passing:
        kept = df
        if "IsDiscounted" in wanted:
            kept = A.flag_below_group_median(kept)
        if "IsPopularItem" in wanted:
            kept = A.flag_popular(kept, rows=df)
        kept = R.attach_segment(kept.where("_whole"), segment_labels(df)).where("RFM_Cluster IS NOT NULL")
        kept = passing.keep(stage_table(kept.select(*[c for c in kept.columns if c in needed]), "labelled"))
        series = stage_table(D.demand_series(df), "demand")
        drop_table(df)
        backs = lambda *names: sorted({int(c.rsplit("_", 1)[1]) for c in wanted if c.startswith(tuple(f"{n}_" for n in names))})
        # a row without a series entry has no feature at all, so one lag tells which rows stay
        windows, finish = D.demand_windows(series, lags=sorted({1, *backs("Lag", "PctChange")}),
                                           windows=backs("RollingNormMean", "RollingRange", "RollingPctChange"),
                                           only={"Lag_1", *wanted})
        windows = passing.keep(windows if is_staged(windows) else stage_table(windows, "series"))
        n = -(-kept.count() // PART_ROWS)
        if n > 1:
            # the features are computed from the joined table: as many shuffle files at a time as a part has
            passing.kept.clear()
            part = lambda df, i: df.where(F.pmod(F.xxhash64("InvoiceDate", "StockCode"), F.lit(n)) == i)
            first, *more = [D.join_series_features(part(kept, i), part(windows, i), finish=lambda df: df) for i in range(n)]
            whole = passing.keep(stage_table(first, "joined", more))
    joined = finish(whole) if n > 1 else D.join_series_features(kept, windows, finish=finish)
    # the rows are whole but for the raw measures
    may_miss = [c for c in joined.columns if c not in (*kept.columns, "Quantity_Agg") or c in wanted.intersection(RAW_MEASURES)]
    final = row_features(joined) if logs else date_features(joined)
    if "TotalSum" in wanted:
        may_miss.append("TotalSum")
    return C.drop_nulls(final, may_miss).select(*columns)


# Numeric columns of the final table (schema walk order), the target and the
# categoricals excluded from the correlation ranking.
CATEGORICAL = ("HolidaySeason", "RFM_Cluster", "IsPopularItem", "IsDiscounted")
ROW_ORDER = ("InvoiceDate", "InvoiceNo", "StockCode", "log_Quantity", "log_UnitPrice")


def correlation_candidates(final: DataFrame) -> list:
    """Numeric columns (booleans excluded) minus the target and the
    categorical list."""
    return C.numeric_columns(final, exclude=(TARGET,) + CATEGORICAL)


def candidate_columns(raw: DataFrame) -> list:
    """The :func:`correlation_candidates` of the final table, from the schemas alone."""
    df = row_features(clean_rows(raw))
    return correlation_candidates(df.drop(*RAW_MEASURES)) + D.feature_names()


def indexed_feature_table(raw: DataFrame, segments: str = "kmeans", columns=None, items: DataFrame | None = None,
                          keep=None) -> DataFrame:
    """W9 on the final table: ``val_index`` = position by date (ties by the
    remaining order keys); ``columns`` must hold these keys.  ``keep``: the
    columns that the result has beside it.  The tables staged on the way are removed."""
    with passing_tables() as passing:
        final = passing.keep(stage_table(feature_table(raw, segments, columns, items), "unindexed"))
    out = D.row_index(final, list(ROW_ORDER), keep=keep)
    drop_table(final)
    return out


def stand_in_predictions(indexed: DataFrame, keep=()) -> DataFrame:
    """Prediction frame (val_index, y_true, y_pred) on the original scale with
    a naive trend forecast from the lags only (previous step times one plus
    the Lag_1-vs-Lag_7 change); used where a fitted model is not the point
    (metrics, spikes, roll-ups).  ``keep`` names row attributes to carry along."""
    return indexed.select("val_index", F.expm1("log_Quantity").alias("y_true"),
                          (F.col("Lag_1") * (1 + F.col("PctChange_7"))).alias("y_pred"), *keep)
