"""Folders of tables: listing, removing and replacing partitions.

Replacing goes by staging: the new partitions are written beside the table
first, and only then swapped in, folder by folder.  A run that fails while it
computes leaves the table as it was; one that fails in the swap is repeated.
Names that begin with an underscore are no part of any table read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted; none if it is absent."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def delete_empty(spark: SparkSession, path: str) -> None:
    """Delete a folder that holds nothing."""
    fs, p = _hadoop(spark, path)
    if fs.exists(p) and not len(fs.listStatus(p)):
        fs.delete(p, False)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, s = _hadoop(spark, source)
    t = _hadoop(spark, target)[1]
    fs.mkdirs(t.getParent())
    if not fs.rename(s, t):
        raise OSError(f"cannot rename {source} to {target}")


@contextmanager
def concurrent_writers(spark: SparkSession, files: int):
    """Writes inside keep up to ``files`` partitions of a task open at a time
    instead of sorting its rows by partition.  For layouts of few partitions."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(files))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def partition_value(folder: str) -> str | None:
    """``x`` of a folder ``column=x``; None for the partition of nulls."""
    value = unquote(folder.split("=", 1)[1])
    return None if value == NULL_PARTITION else value


def partitions(spark: SparkSession, path: str, column: str) -> dict[str | None, str]:
    """Values of the first partition column of a table and their folders."""
    return {partition_value(f): f for f in folders(spark, path) if f.startswith(f"{column}=")}


def within(days: tuple | None) -> Callable[[str | None], bool]:
    """Whether a partition's date belongs to ``days=(first, last)``; None: all do."""
    if days is None:
        return lambda value: True
    first, last = str(days[0]), str(days[1])
    return lambda value: value is not None and first <= value <= last


def stage(df: DataFrame, path: str, columns: list[str]) -> str:
    """Write ``df`` partitioned by ``columns`` to a new folder beside ``path``."""
    root, name = path.rstrip("/").rsplit("/", 1)
    staged = f"{root}/_staging/{name}-{uuid.uuid4().hex[:12]}"
    df.write.partitionBy(*columns).parquet(staged)
    return staged


def swap(spark: SparkSession, staged: str, path: str, column: str, covers: Callable[[str | None], bool] = lambda value: False) -> None:
    """Replace the partitions of ``path`` that ``staged`` holds, and remove
    those that the new data covers and no longer has."""
    new, old = partitions(spark, staged, column), partitions(spark, path, column)
    for value, folder in old.items():
        if value in new or covers(value):
            delete(spark, f"{path}/{folder}")
    for folder in new.values():
        rename(spark, f"{staged}/{folder}", f"{path}/{folder}")
    delete(spark, staged)


def replace_partitions(df: DataFrame, path: str, columns: list[str], covers: Callable[[str | None], bool] = lambda value: False) -> None:
    """Overwrite the partitions present in ``df`` and those it covers."""
    path = path.rstrip("/")
    swap(df.sparkSession, stage(df, path, columns), path, columns[0], covers)
