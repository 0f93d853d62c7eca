"""Registered queries against their DuckDB oracle SQL at sf0.001 (the
driver's check runs the same at sf0.01)."""

import math

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from martlake.sources.tables import TABLES

FAST = ["key_guard_incremental", "sequence_windows", "seeded_sample", "retail_clean", "retail_dedup", "log_features", "calendar_features", "popular_items",
        "discount_flag", "weekday_mean_demand", "top_products", "null_audit", "profile_summary",
        "histogram_quantity", "rfm_table", "rfm_scaled", "pivot_month_segment", "demand_lags",
        "rolling_norm_mean", "rolling_norm_mean_simple", "lag_pct_change", "sessions_clean",
        "hits_clean_drop_last", "hits_clean_keep_best", "orphan_hits", "key_guard", "pending_files",
        "run_counters", "json_flatten", "required_columns", "iqr_cap", "impute_mode", "stratified_folds",
        ]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, bool):
        return float(v)
    if isinstance(v, int):
        return float(v)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert [r.RFM_Cluster for r in df.collect()] == [0, 1, 2]


def test_every_query_has_oracle_or_is_model_or_stream():
    from martlake.plans.catalog import REGISTRY

    no_oracle = set(REGISTRY) - set(entry.oracle_sql())
    assert no_oracle <= {"rfm_kmeans", "elbow_table", "gbt_cv", "gbt_scoring", "price_model_choice", "sequence_table",
                         "price_scoring", "stream_ingest", "stream_load"}
    assert set(REGISTRY) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sp = entry.queries()[name](spark, SF_SMALL).toPandas()
    dd = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert rows(sp) == rows(dd)
