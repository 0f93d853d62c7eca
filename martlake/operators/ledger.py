"""Per-file status ledger.

The ledger is a small table (one row per drop file and dataset):
``dataset, file_name, loaded, transformed, to_db, saved``.  It is updated by
joining a batch's per-file outcomes onto the previous snapshot
(``coalesce(new, old)``) and written as a new snapshot, so a replay of the
same batch is idempotent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, MapType, StringType, StructField, StructType

FLAGS = ("loaded", "transformed", "to_db", "saved")
LEDGER_SCHEMA = StructType([StructField("dataset", StringType(), False),
                            StructField("file_name", StringType(), False)]
                           + [StructField(f, BooleanType(), True) for f in FLAGS])
_FLAG_STRUCT = StructType([StructField(f, BooleanType()) for f in FLAGS])


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def ledger_from_flags_json(spark: SparkSession, text_df: DataFrame, col: str = "value") -> DataFrame:
    """The JSON form ``{"<dataset>_data": {"<file>": {loaded, ...}}}`` as rows."""
    t = MapType(StringType(), MapType(StringType(), _FLAG_STRUCT))
    m = text_df.select(F.explode(F.from_json(F.col(col), t)).alias("ds", "files"))
    rows = m.select(F.regexp_replace("ds", "_data$", "").alias("dataset"),
                    F.explode("files").alias("file_name", "f"))
    return rows.select("dataset", "file_name",
                       *[F.coalesce(F.col(f"f.{f}"), F.lit(False)).alias(f) for f in FLAGS])


def flags_document(ledger: DataFrame) -> DataFrame:
    """S9 + S13: the ledger as one JSON text ``{"<dataset>_data": {"<file>": {loaded, ...}}}``, a row per file in
    one document, by design of the format."""
    files = ledger.groupBy("dataset").agg(F.map_from_entries(F.collect_list(F.struct(
        "file_name", F.struct(*FLAGS)))).alias("files"))
    return files.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(
        F.concat("dataset", F.lit("_data")), "files")))).alias("value"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads; other errors are raised."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def snapshots(spark: SparkSession, path: str) -> dict[int, str]:
    """Versions of the ledger under ``path`` and the folder of each, in order."""
    if not path_exists(spark, path):
        return {}
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(at) if f.isFile()]
    found = {}
    for name in names:
        version, _, folder = name.partition("--")
        if folder and version[:1] == "v" and version[1:].isdigit():
            found[int(version[1:])] = folder
    return dict(sorted(found.items()))


def _claim(spark: SparkSession, path: str, version: int, folder: str) -> bool:
    """Make ``folder`` the ledger's ``version``, unless there is one: of two writers the first lock file wins."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    lock = Path(f"{path}/_v{version}.lock")
    fs = lock.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = fs.create(lock, False)        # fails where the file is there
        out.write(bytearray(folder.encode()))
        out.close()
    except Exception as e:      # noqa: BLE001
        if "FileAlreadyExists" not in str(e) and not fs.exists(lock):
            raise
        # a writer that stopped between its lock and its version is finished by the next one
        text = fs.open(lock)
        winner = bytes(text.readAllBytes()).decode()
        text.close()
        if not winner:
            raise RuntimeError(f"{lock.toString()} is being written") from e
        fs.create(Path(f"{path}/v{version}--{winner}"), True).close()
        return winner == folder
    fs.create(Path(f"{path}/v{version}--{folder}"), True).close()
    return True


def load_ledger(spark: SparkSession, path: str, backup_json: str | None = None) -> DataFrame:
    """The newest snapshot of the primary ledger, else the JSON backup (copied
    to primary), else an empty ledger (saved).  ``path`` is a folder in shared
    storage; only a missing path counts as no ledger."""
    found = snapshots(spark, path)
    if not found:
        if backup_json and path_exists(spark, backup_json):
            led = ledger_from_flags_json(spark, spark.read.option("wholetext", "true").text(backup_json))
        else:
            led = empty_ledger(spark)
        save_ledger(led, path, 1)
        found = snapshots(spark, path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{path}/{found[max(found)]}")


def save_ledger(ledger: DataFrame, path: str, version: int | None = None) -> bool:
    """Write a new snapshot beside the old ones, which stay readable.  With ``version``,
    only if nobody has written that version: False where somebody has."""
    spark = ledger.sparkSession
    if version is None:
        version = max(snapshots(spark, path), default=0) + 1
    folder = f"snapshot-{uuid.uuid4().hex}"
    ledger.write.parquet(f"{path}/{folder}")
    return _claim(spark, path, version, folder)


def update_ledger(spark: SparkSession, path: str, outcomes: DataFrame) -> None:
    """Merge per-file outcomes into the newest snapshot.  Where another writer was faster,
    they are merged into what that one wrote, so that no update is lost."""
    while True:
        old = load_ledger(spark, path)
        version = max(snapshots(spark, path)) + 1
        if save_ledger(advance(old, outcomes), path, version):
            return


def pending_for_transform(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Drop files (dataset, file_name) not yet loaded."""
    done = ledger.where(F.col("loaded")).select("dataset", "file_name")
    return files.join(done, ["dataset", "file_name"], "left_anti")


def pending_for_load(ledger: DataFrame) -> DataFrame:
    """Files transformed but not yet in the warehouse."""
    return ledger.where(F.col("transformed") & ~F.coalesce(F.col("to_db"), F.lit(False)))


def advance(ledger: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Merge per-file outcomes (dataset, file_name, any of the flags) into
    the ledger; a flag absent from the outcome keeps its old value."""
    o = outcomes
    for f in FLAGS:
        if f not in o.columns:
            o = o.withColumn(f, F.lit(None).cast("boolean"))
    o = o.select("dataset", "file_name", *[F.col(f).alias(f"_n_{f}") for f in FLAGS])
    j = ledger.join(o, ["dataset", "file_name"], "full_outer")
    return j.select("dataset", "file_name",
                    *[F.coalesce(F.col(f"_n_{f}"), F.col(f), F.lit(False)).alias(f) for f in FLAGS])


def run_counters(outcomes: DataFrame) -> DataFrame:
    """Success / failure counts per dataset and stage from per-file
    outcome rows (dataset, stage, ok)."""
    return outcomes.groupBy("dataset", "stage").agg(
        F.count_if(F.col("ok")).alias("success"), F.count_if(~F.col("ok")).alias("failure"))
