"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths staged in each open :func:`scratch` of this thread, the innermost last.
_threads = threading.local()


def _scopes() -> list[list[str]]:
    if not hasattr(_threads, "open"):
        _threads.open = []
    return _threads.open


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application in ``spark.checkpoint.dir``. Only a local session may leave that unset, and gets a folder of this machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tarnlake-")
        spark.conf.set("spark.checkpoint.dir", path)
    return f"{path.rstrip('/')}/tarnlake-{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor then costs a re-read and not a recomputation."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.option("compression", "zstd")
    if scopes := _scopes():
        scopes[-1].append(path)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator:
    """Deletes at its end what is staged within, but for what the function that it gives stages: ``with scratch(spark) as keep: ... out = keep(df, name)``.

    What is kept belongs to the scratch around it, if there is one. Frames made within must not be used after, but for those kept.
    """
    inside: list[str] = []
    scopes = _scopes()
    scopes.append(inside)

    def keep(df: DataFrame, name: str) -> DataFrame:
        scopes.pop()
        try:
            return staged(df, name)
        finally:
            scopes.append(inside)

    try:
        yield keep
    finally:
        scopes.pop()
        for path in inside:
            _delete(spark, path)


def clean_shared(spark: SparkSession) -> None:
    """Delete what this application staged. For callers whose results are written, as results are lazy."""
    _delete(spark, shared_dir(spark))
