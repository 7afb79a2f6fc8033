"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders handed out since the innermost ``scratch`` began.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: UTC clock fields, runtime re-planning of skewed joins."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _root(spark: SparkSession) -> str:
    """The context's checkpoint folder, else spark.checkpoint.dir; a temporary one only where driver and tasks are one process."""
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not context.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-"))
    return context.getCheckpointDir().rstrip("/")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's checkpoint folder; all of them go when the application ends."""
    context = spark.sparkContext
    top = f"{_root(spark)}/tidewatch-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(top)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(path)
    folder = f"{top}/{name}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(folder)
    return folder


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder given by shared_folder once nothing reads it any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, all folders that shared_folder gives meanwhile; nothing may read them afterwards.

    For what runs again and again in one application: batches of streams, appends.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for folder in made:
            discard(spark, folder)


def release(spark: SparkSession) -> None:
    """Let go, on the driver, of what steps that have ended left: plans, broadcasts and shuffles that nothing names any more.

    Spark frees them once the JVM finds them unreachable, which it looks for only when its memory runs full; collected between
    steps, that memory goes back to the machine before the next step needs its own.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str, block: int | None = None) -> DataFrame:
    """Cut lineage: write to the shared folder and read back, so a lost executor costs no recompute.

    ``block``: bytes after which a file begins a part of its own, which a task can read alone; so few tasks that write can be followed by many that read.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    (df.write if block is None else df.write.option("parquet.block.size", block)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
