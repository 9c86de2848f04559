"""The message topic: ``(json string, kafka_timestamp timestamp)`` rows.

``encode_events`` is the producer's JSON encoding (S15) as a DataFrame
expression; ``stored_topic`` is the mixed topic made from the driver's
tables; ``replayed_topic`` models a consumer restarted from ``earliest``
(every message delivered twice, the second time later).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures
from .files import FILE_ROWS


def encode_events(df: DataFrame, time_col: str = "kafka_timestamp") -> DataFrame:
    """All columns but the broker time -> one JSON object per row."""
    payload = [c for c in df.columns if c != time_col]
    return df.select(
        F.to_json(F.struct(*payload)).alias("json"),
        F.col(time_col).alias("kafka_timestamp"),
    )


def project_message(df: DataFrame) -> DataFrame:
    """Broker record -> (json, kafka_timestamp)."""
    return df.selectExpr("CAST(value AS STRING) AS json", "CAST(timestamp AS TIMESTAMP) AS kafka_timestamp")


def replayed_topic(
    spark: SparkSession,
    sf_dir: str,
    delay: str = "INTERVAL 1 DAY",
) -> DataFrame:
    """The topic delivered twice: original, then a re-delivery ``delay`` later."""
    topic = stored_topic(spark, sf_dir)
    again = topic.select("json", (F.col("kafka_timestamp") + F.expr(delay)).alias("kafka_timestamp"))
    return topic.unionByName(again)


_STORED: dict[tuple[str, str], str] = {}


TOPIC_NAME = "events"


def as_broker_records(messages: DataFrame, topic: str = TOPIC_NAME, partition: int = 0) -> DataFrame:
    """(json, kafka_timestamp) -> the Kafka source's record layout (binary
    key/value, topic, partition, timestamp); ``project_message`` reverses it."""
    return messages.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode("json", "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(partition).alias("partition"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


def stored_topic_dir(spark: SparkSession, sf_dir: str) -> str:
    """The fixture topic written once per process and scale factor below the
    shared folder, as one mixed topic of broker records (Kafka source
    layout).  Readers scan all its records and project them as a Kafka read
    does, instead of re-deriving messages inside every plan."""
    from ..session import ensure_checkpoint_dir, work_dir

    key = (ensure_checkpoint_dir(spark), sf_dir)
    if key not in _STORED:
        path = work_dir(spark, "topic", unique=True)
        parts = [
            as_broker_records(encode_events(fixtures.VIEWS[k](spark, sf_dir)), partition=i)
            for i, k in enumerate(fixtures.VIEWS)
        ]
        topic = parts[0].unionByName(parts[1]).unionByName(parts[2])
        topic.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
        _STORED[key] = path
    return _STORED[key]


def stored_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages of the stored fixture topic, by the broker-record
    projection (S5); kinds are told apart by parsing, as on a broker."""
    return project_message(spark.read.parquet(stored_topic_dir(spark, sf_dir)))
