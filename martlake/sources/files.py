"""File sinks and the CSV scan.

Writers take folders in shared storage (local paths in tests, ``s3a://`` or
HDFS on a cluster).  Single-document outputs (feature list, metrics) are one
small row, written as one file; tables are written in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, IntegerType, StringType, StructField, StructType)

# Warehouse table definitions (NOT NULL = nullable False; enforced at
# load by the reject filter, see operators.warehouse).
SESSIONS_TABLE = StructType(
    [StructField("session_id", StringType(), False), StructField("client_id", StringType(), False),
     StructField("visit_date", DateType(), False), StructField("visit_time", StringType(), False),
     StructField("visit_number", IntegerType(), False)]
    + [StructField(c, StringType(), True) for c in (
        "utm_source", "utm_medium", "utm_campaign", "utm_keyword", "utm_adcontent", "device_category",
        "device_os", "device_brand", "device_screen_resolution", "device_browser", "geo_country", "geo_city")])
HITS_TABLE = StructType(
    [StructField("hit_id", StringType(), False), StructField("session_id", StringType(), False),
     StructField("hit_date", DateType(), False), StructField("hit_number", IntegerType(), False)]
    + [StructField(c, StringType(), True) for c in (
        "hit_referer", "hit_page_path", "event_category", "event_action", "event_label")])


def write_parquet(df: DataFrame, path: str, partition_by=None) -> None:
    """Overwrite a Parquet table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header (one folder of part files)."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with header and an explicit schema (no inference pass)."""
    return spark.read.option("header", "true").schema(schema).csv(path)


def read_predictions_csv(spark: SparkSession, path: str, scored: bool = False) -> DataFrame:
    """S2 + P10 + P4: fold / scored prediction files re-read with the
    reference renames (true -> y_true, pred|prediction -> y_pred) and
    ``val_index`` as an integer."""
    if scored:
        df = read_csv(spark, path, "val_index string, true double, prediction double")
        df = df.withColumnRenamed("prediction", "y_pred")
    else:
        df = read_csv(spark, path, "fold int, val_index string, true double, pred double")
        df = df.withColumnRenamed("pred", "y_pred")
    return df.withColumnRenamed("true", "y_true").withColumn("val_index", F.col("val_index").cast("long"))


def write_json_document(doc: DataFrame, path: str) -> None:
    """A one-row, one-column (``value``) JSON text document."""
    doc.coalesce(1).write.mode("overwrite").text(path)


def feature_list_document(selection: DataFrame, name_col: str = "feature", order_col: str = "rank") -> DataFrame:
    """The selected feature names as one JSON array (ordered)."""
    return selection.agg(F.to_json(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(name_col).alias("n")))),
        lambda x: x["n"])).alias("value"))


def metrics_document(metrics: DataFrame) -> DataFrame:
    """A one-row metrics table as a JSON object."""
    return metrics.select(F.to_json(F.struct(*metrics.columns)).alias("value"))
