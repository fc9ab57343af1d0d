"""Session settings and the shared work folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that hold at any size. Shuffle width is left to the cluster; AQE merges small partitions.
SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A query with several written tables compiles close to a hundred classes; the default cache holds a hundred in all.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Recording the Python call site of every column expression costs more than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "staywise", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster executors on other machines
    could not read it, so the setting is required there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="staywise-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the work folder that no other job uses."""
    return f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to this path to its end."""
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


# Paths written since each open ``scratch`` began, the innermost last.
_levels: ContextVar[tuple[list[str], ...]] = ContextVar("levels", default=())


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a result once and read it back.

    Cuts the lineage (an executor loss no longer replays the whole plan) and lets several readers share
    the work, each reading only the columns it needs.
    """
    path = fresh_path(df.sparkSession, name)
    if levels := _levels.get():
        levels[-1].append(path)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query go when it ends. A plan that is written once and read back from there needs them no longer;
    otherwise they fill the disks until the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables ``written`` inside are removed at the end, also after an error; the function it gives writes a table that stays.

    What stays must be written before the end, so that nothing left depends on a removed table. Blocks may be nested: what
    an inner one keeps belongs to the outer one.
    """
    outer, own = _levels.get(), []

    def keep(df: DataFrame, name: str) -> DataFrame:
        token = _levels.set(outer)
        try:
            return written(df, name)
        finally:
            _levels.reset(token)

    token = _levels.set((*outer, own))
    try:
        yield keep
    finally:
        _levels.reset(token)
        for path in own:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
