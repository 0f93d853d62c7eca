"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.session import checkpoint_dir

# A word is a maximal run of characters other than the space and \t..\r.
# Python's bytes.split() cuts at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text) -> F.Column:
    """Number of words of a text column; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of one Arrow batch, so that a Python task holds few texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def free_names(columns, names) -> list[str]:
    """``names``, each lengthened until no column has it."""
    out = []
    for n in names:
        while n.lower() in {c.lower() for c in columns}:
            n += "_"
        out.append(n)
    return out


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the table instead of computing it
    again.  The folder goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Remove a staged table that no later step reads."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(df._staged_at)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
