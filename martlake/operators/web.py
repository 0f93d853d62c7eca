"""Session and hit cleaning (G1, G2 record steps: P1, P2, P4, F12, F13, F21, W7b)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.scalars import hit_key, parse_date, parse_time_of_day
from martlake.operators.clean import dedup_ranked, drop_columns, fill_constant

# Columns filled with the sentinel, and the sentinel itself.
SESSION_FILL_UNKNOWN = ("utm_campaign", "utm_adcontent", "utm_keyword", "device_os",
                        "device_brand", "utm_source")
HIT_FILL_UNKNOWN = ("hit_referer", "event_label")
UNKNOWN = "unknown"
HIT_DROP = ("hit_time", "event_value", "hit_type")

# Target table columns (NOT NULL ones are checked at load).
SESSION_COLUMNS = ("session_id", "client_id", "visit_date", "visit_time", "visit_number",
                   "utm_source", "utm_medium", "utm_campaign", "utm_keyword", "utm_adcontent",
                   "device_category", "device_os", "device_brand", "device_screen_resolution",
                   "device_browser", "geo_country", "geo_city")
SESSION_NOT_NULL = ("session_id", "client_id", "visit_date", "visit_time", "visit_number")
HIT_COLUMNS = ("hit_id", "session_id", "hit_date", "hit_number", "hit_referer", "hit_page_path",
               "event_category", "event_action", "event_label")
HIT_NOT_NULL = ("hit_id", "session_id", "hit_date", "hit_number")


def clean_sessions(raw: DataFrame) -> DataFrame:
    """G1 record steps: NULL -> 'unknown' on six columns, visit_date parsed
    (bad -> NULL), ids as text, device_model dropped, visit_time parsed as
    H:M:S (bad -> NULL) and kept as HH:mm:ss text."""
    df = fill_constant(raw, {c: UNKNOWN for c in SESSION_FILL_UNKNOWN})
    df = df.withColumns({
        "visit_date": parse_date(F.col("visit_date")),
        "client_id": F.col("client_id").cast("string"),
        "session_id": F.col("session_id").cast("string"),
        "visit_time": parse_time_of_day(F.col("visit_time")),
        "visit_number": F.col("visit_number").cast("int"),
    })
    return drop_columns(df, ["device_model"])


def clean_hits(raw: DataFrame, mode: str = "keep_best", tie_col: str = "src_pos",
               file_col: str = "source_file") -> DataFrame:
    """G2 record steps: drop hit_time / event_value / hit_type, NULL ->
    'unknown' on referer and label, hit_date parsed, hit_id built, then the
    ranked dedup on hit_id inside each file, so that the result does not depend
    on which files one batch holds (``mode`` as in ``dedup_ranked``)."""
    df = drop_columns(raw, HIT_DROP)
    df = fill_constant(df, {c: UNKNOWN for c in HIT_FILL_UNKNOWN})
    df = df.withColumns({
        "hit_date": parse_date(F.col("hit_date")),
        "session_id": F.col("session_id").cast("string"),
        "hit_number": F.col("hit_number").cast("int"),
    }).withColumn("hit_id", hit_key("session_id", "hit_number"))
    return dedup_ranked(df, [file_col, "hit_id"], ["hit_referer", "event_label"], tie_col, mode=mode,
                        sentinel=UNKNOWN)
