"""What the operators need to know about the running session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it then gets its own folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="plumbline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Paths of the open scopes, innermost last; None outside of any.
_SCOPE: ContextVar[list[str] | None] = ContextVar("plumbline_scratch", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder; the open scope owns it."""
    path = f"{shared_folder(spark)}/plumbline/{label}-{uuid.uuid4().hex}"
    owned = _SCOPE.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Owns the intermediate datasets made inside the block and deletes them after it.

    Frames that read them must be written before the block ends. Yields the list of owned
    paths; one that is taken off the list is kept.
    """
    owned: list[str] = []
    token = _SCOPE.set(owned)
    try:
        yield owned
    finally:
        _SCOPE.reset(token)
        for path in owned:
            _delete(spark, path)


def hand_over(paths: list[str]) -> None:
    """Paths that an inner scope gave up belong to the open scope, if there is one."""
    owned = _SCOPE.get()
    if owned is not None:
        owned.extend(paths)


def _delete(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(location, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder once and read from there by all later passes."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
