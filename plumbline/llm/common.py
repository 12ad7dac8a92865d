"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import hand_over, scratch_path, scratch_scope

#: Bytes that separate words in most contracts: space, tab, newline, VT, FF and CR.
BLANK = r"[\x20\x09-\x0D]+"
#: Text handled at once in a task; the arrays made from it are several times larger.
SLICE_BYTES = 1 << 20


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(df: DataFrame, key: str, text: str, *extra: Column) -> DataFrame:
    """Key and text alone (null text: empty), so that other columns cannot clash."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    return df.select(F.col(key).cast("bigint").alias("doc_id"), body, *extra)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def alone(spark: SparkSession, label: str, make: Callable[[], DataFrame], keep: tuple[str, ...] = ()) -> DataFrame:
    """What ``make`` returns, written to the shared folder; what it wrote there on the way is deleted.

    Datasets with labels in ``keep`` stay and belong to the caller's scope.
    """
    path = scratch_path(spark, label)
    with scratch_scope(spark) as owned:
        df = make()
        df.write.parquet(path)
        kept = [p for p in owned if p.rsplit("/", 1)[1].rsplit("-", 1)[0] in keep]
        owned[:] = [p for p in owned if p not in kept]
    hand_over(kept)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000, size: str = "16m") -> Iterator[None]:
    """Smaller Arrow batches for the writes inside the block, where a row holds whole sets."""
    wanted = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": size,
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside the block go when it ends, not with a later collection."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    try:
        spark.conf.set(key, "true")
        yield
    finally:
        spark.conf.set(key, before)


_HELD: dict[str, object] = {}


def worker_memory(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps for its next tasks, until another operator's task comes."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def give_back() -> None:
    """Return freed memory to the system, as the next task may run in another worker."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES, keep: str = ""
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``limit`` bytes of ``column``, or one row.

    What the worker holds for other operators than ``keep`` is dropped first.
    """
    if any(name != keep for name in _HELD):
        _HELD.clear()
        give_back()
    for batch in batches:
        values = batch.column(column)
        start = held = 0
        for i in range(len(values)):
            size = len(values[i].as_buffer()) if values[i].is_valid else 0
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
        del batch, values
        pa.default_memory_pool().release_unused()
    give_back()


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Runs of anything but blanks."""
    return F.filter(F.split(text, BLANK), lambda w: w != "")
