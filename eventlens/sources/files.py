"""File replay of the topic (S1b): the same ``(json, kafka_timestamp)``
contract as Kafka, from JSON-lines text files or parquet topic dumps.

Text files carry no broker time; the file's modification time (from the
hidden ``_metadata`` column) stands in for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MESSAGE
from pyspark.sql.types import StructField, TimestampType, StructType

#: rows of a stored file at most: small rows would else fill a file, and so the
#: task that reads it, by the million
FILE_ROWS = 500_000
TOPIC_DUMP = StructType(MESSAGE.fields + [StructField("kafka_timestamp", TimestampType(), True)])


def read_messages(
    spark: SparkSession,
    path: str,
    fmt: str = "text",
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Messages from a directory of text (one JSON object per line) or
    parquet (json, kafka_timestamp) files, as a batch or a stream."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "text":
        df = reader.format("text").load(path)
        return df.select(
            F.col("value").alias("json"),
            F.col("_metadata.file_modification_time").alias("kafka_timestamp"),
        )
    if fmt == "parquet":
        return reader.schema(TOPIC_DUMP).format("parquet").load(path)
    raise ValueError(f"unknown message file format {fmt!r}")


def write_messages(df: DataFrame, path: str, fmt: str = "text", mode: str = "overwrite") -> None:
    """Write a topic as replay files (text: JSON lines; parquet: both columns).

    Rows are range-partitioned on broker time so every file covers a time
    slice, like consecutive topic segments.  A hash of the message breaks
    ties, so one instant holding a large share of the messages is still
    split across tasks.  Messages repeat their field names and most of their
    values: text is written as gzip, and parquet as zstd.
    """
    ordered = df.repartitionByRange(F.col("kafka_timestamp"), F.xxhash64("json"))
    if fmt == "text":
        ordered.select("json").write.mode(mode).option("compression", "gzip").text(path)
    elif fmt == "parquet":
        ordered.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    else:
        raise ValueError(f"unknown message file format {fmt!r}")
