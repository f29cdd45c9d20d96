"""Session settings and the shared scratch space used to cut lineage."""

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans in this package rely on. Partition counts are upper bounds:
# AQE merges small shuffle partitions and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key that makes extra shuffling worthwhile is split even if the split
    # costs another exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Above this many rows a top-n is a distributed sort, not a per-task heap.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.pushdown.inFilterThreshold": "64",
}

_local_dirs: dict[str, str] = {}


def build_session(app="postlake", master=None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local session, where one machine is the whole cluster, may fall back to a
    temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="postlake-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """What is written inside leaves no shuffle files: they go when the write is done, and not
    when the driver happens to collect its garbage. A write has a plan of its own, so nothing
    else reads them."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def save(df: DataFrame, path: str, mode="error", by=()) -> None:
    """Write a table as Parquet, in folders by the columns given, in the compression that takes
    the least disk for texts."""
    with shuffles_removed(df.sparkSession):
        df.write.mode(mode).partitionBy(*by).parquet(path, compression="zstd")


def stage(df: DataFrame, name="stage", lean=False, by=()) -> DataFrame:
    """Write a frame once and read it back, so later uses do not recompute it.

    The written table lives in the shared folder, so it survives lost executors. `lean` tables
    are written by `save`, as those that hold texts should be, in folders by the columns given.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if lean:
        save(df, path, by=by)
    else:
        df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def drop_stage(*staged: DataFrame) -> None:
    """Remove the folders of staged frames, once what was made from them is written."""
    for df in staged:
        _delete(df.sparkSession, df.staged_path)


def drop_stage_part(staged: DataFrame, column: str, value) -> None:
    """Remove the rows of one value of a column that a frame was staged by."""
    _delete(staged.sparkSession, f"{staged.staged_path}/{column}={value}")


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
