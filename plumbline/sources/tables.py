"""Reading the modelling table and writing results."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

REPORT_TABLES = ("Summary_Stats", "Top_Vars", "Performance_metrics", "KS")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
) -> DataFrame:
    """Delimited text. Give a schema at scale: inferring one reads the files twice."""
    reader = spark.read.options(header=header, sep=sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Permanent Parquet table; with a path the files live there."""
    writer = df.write.format("parquet").mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_report(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """One dataset per result table below ``folder``; returns their paths."""
    missing = [t for t in REPORT_TABLES if t not in tables]
    if missing:
        raise ValueError(f"report lacks {', '.join(missing)}")
    paths = {}
    for name in REPORT_TABLES:
        paths[name] = f"{folder.rstrip('/')}/{name}"
        writer = tables[name].write.mode("overwrite").format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(paths[name])
    return paths


def read_report(spark: SparkSession, folder: str, table: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, inferSchema=True)
    return reader.load(f"{folder.rstrip('/')}/{table}")


@contextmanager
def cached_scope(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keeps frames cached (memory, then disk) inside the block and releases them after it."""
    for frame in frames:
        frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frames
    finally:
        for frame in frames:
            frame.unpersist()
