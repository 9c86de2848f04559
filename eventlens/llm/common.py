"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import posixpath
import re
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir

#: A word: a run of characters other than space, tab, \n, \v, \f and \r.
WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that
    their Python workers can import it whatever folder they run in."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(root)
    archive = os.path.join(tempfile.mkdtemp(), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for top, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(top, f), os.path.join(name, os.path.relpath(os.path.join(top, f), root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder for ``name`` below the shared checkpoint folder."""
    return work_dir(spark, "llm", name, unique=True)


def written(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, so
    a lost executor costs a re-read and never a recomputation.  ``release``
    lets Spark remove the shuffle files of finished steps at once; otherwise
    they stay until the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    if release:
        del df
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def aside(df: DataFrame):
    """``df`` with its columns that begin with two underscores, the names that
    operators give their own, under other names; and the function that gives
    such names back."""
    names, taken = {}, {c.lower() for c in df.columns}
    for c in df.columns:
        if c.startswith("__"):
            new = f"kept_{len(names)}"
            while new in taken:
                new += "_"
            names[c] = new
            taken.add(new)
    back = {new: c for c, new in names.items()}
    return df.withColumnsRenamed(names), lambda out: out.withColumnsRenamed(back)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def global_rank(df: DataFrame, order: list[Column], rank: str, name: str, weight: Column | None = None) -> DataFrame:
    """Adds ``rank``: 1, 2, ... over all rows in the order given; with a
    ``weight``, the running sum of it up to and including the row.

    The rows are range-partitioned by sampled splitters and written, so the
    partition numbers are fixed; a row's rank is its place in its partition
    plus the rows of the partitions before.  Only one sum per partition is
    gathered.  The rows must differ in ``order``: equal rows land in one task.
    """
    part, one = "__part", F.lit(1) if weight is None else weight
    parts = written(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), name)
    before = parts.groupBy(part).agg(F.sum(one).alias("__n")).select(
        part,
        (F.sum("__n").over(Window.orderBy(part)) - F.col("__n")).alias("__before"),
    )  # one row per partition
    place = F.sum(one).over(Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        parts.withColumn(rank, place)
        .join(F.broadcast(before), part)
        .withColumn(rank, F.col(rank).cast("long") + F.col("__before"))
        .drop(part, "__before")
    )


def open_fs(uri: str):
    """pyarrow file system and path of a shared folder, on driver or executor.
    Schemes: file, hdfs, s3, gs; a plain path is local."""
    from pyarrow import fs

    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", uri):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return fs.LocalFileSystem(), uri


def child(path: str, name: str) -> str:
    return posixpath.join(path.rstrip("/"), name)
