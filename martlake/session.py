"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import threading
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings the operators assume.  UTC keeps calendar functions stable; AQE
# coalesces small shuffles, splits skewed join partitions and may switch a
# sort-merge join to a broadcast when a side turns out small at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoints of frames that went out of scope are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "martlake",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library's defaults.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # runtime-settable values are applied again in case the session existed
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins.  Only when it is unset (tests, local runs) a
    fallback is installed; never a machine-local temp folder on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    target = configured or fallback
    master = spark.sparkContext.master
    if target is None and (master == "local" or master.startswith("local[")):
        # single-machine run (tests, laptops): a temp folder is shared storage
        import tempfile
        target = tempfile.mkdtemp(prefix="martlake-checkpoints-")
    if target is None:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder (HDFS / object store)")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def cut_lineage(df, spark: SparkSession | None = None):
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint,
    survives executor loss) and return the re-read frame."""
    spark = spark or df.sparkSession
    checkpoint_dir(spark, fallback=os.environ.get("MARTLAKE_CHECKPOINT_DIR"))
    return df.checkpoint(eager=True)


def stage_table(df, label: str = "stage", more=()):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it
    back: cuts the lineage as ``cut_lineage`` does, and later readers scan only
    the columns and row groups that they need.  The shuffle files of the write are
    removed with its end, the table when the application ends, or before by
    ``drop_table`` and ``passing_tables``.

    The rows of ``more``, frames of the same columns, are written one frame after
    another: only one's shuffle files are there at a time."""
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark, fallback=os.environ.get('MARTLAKE_CHECKPOINT_DIR'))}/{label}-{uuid.uuid4().hex}"
    for part in (df, *more):
        with shuffles_freed(spark):
            part.write.mode("append").option("compression", "zstd").parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    if _passing.get() is not None:
        _passing.get().tables.append(out)
    return out


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing, _inside = threading.Lock(), [0]


@contextmanager
def shuffles_freed(spark):
    """Remove the shuffle files of each query that runs inside when it ends, not some time
    after the driver has forgotten it.  For queries whose result nothing runs again."""
    with _freeing:
        _inside[0] += 1
        if _inside[0] == 1:
            _inside[1:] = [spark.conf.get(_FREED, None)]
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _freeing:
            _inside[0] -= 1
            if not _inside[0]:
                spark.conf.unset(_FREED) if _inside[1] is None else spark.conf.set(_FREED, _inside[1])


_passing: ContextVar[passing_tables | None] = ContextVar("passing", default=None)


class passing_tables:
    """Context manager: tables staged inside are removed at its end, but for those named by
    ``keep``, which must not be read from the others any more: staged tables themselves."""

    def __init__(self):
        self.tables, self.kept = [], []

    def keep(self, df):
        self.kept.append(df)
        return df

    def __enter__(self):
        self.token = _passing.set(self)
        return self

    def __exit__(self, *exc):
        _passing.reset(self.token)
        kept = {df._staged_at for df in self.kept}
        for table in self.tables:
            if table._staged_at not in kept:
                drop_table(table)
            elif _passing.get() is not None:
                _passing.get().tables.append(table)
        return False


def is_staged(df) -> bool:
    """Whether ``df`` is a staged table itself: reading it again is a scan."""
    return hasattr(df, "_staged_at")


def drop_table(df) -> None:
    """Remove a staged table that no later step reads."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(df._staged_at)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def reuse(df):
    """Persist a frame that several branches of one job read (memory, then
    local disk).  Lost blocks are recomputed from lineage, so executor loss
    is survived; use ``cut_lineage`` where the lineage itself is long."""
    from pyspark import StorageLevel
    return df.persist(StorageLevel.MEMORY_AND_DISK)


class reused:
    """Context manager: persist ``df`` for the duration of a block unless the
    caller already cached it (then the caller's cache is left alone)."""

    def __init__(self, df):
        self.df = df
        self.owned = not df.is_cached

    def __enter__(self):
        if self.owned:
            reuse(self.df)
        return self.df

    def __exit__(self, *exc):
        if self.owned:
            self.df.unpersist()
        return False
