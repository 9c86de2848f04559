"""Kafka source and sink.

The Kafka connector is a separate package (spark-sql-kafka); the reader
and writer are built here with the reference options made parameters.
Without the connector on the classpath, ``load()``/``start()`` fail with
Spark's own "data source not found" error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .messages import encode_events, project_message


@dataclass(frozen=True)
class KafkaSource:
    bootstrap_servers: str
    topic: str
    starting_offsets: str = "earliest"  # S2: a new checkpoint reads the whole topic
    fail_on_data_loss: bool = False  # S3: tolerate offsets aged out of retention
    max_offsets_per_trigger: int | None = None  # S4: admission control per trigger; no limit unless given

    def options(self) -> dict[str, str]:
        opts = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.max_offsets_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return opts

    def reader(self, spark: SparkSession, streaming: bool = True):
        r = (spark.readStream if streaming else spark.read).format("kafka")
        opts = self.options()
        if not streaming:
            opts.pop("maxOffsetsPerTrigger", None)
        for k, v in opts.items():
            r = r.option(k, v)
        return r

    def read(self, spark: SparkSession, streaming: bool = True) -> DataFrame:
        """Topic -> (json, kafka_timestamp) (S1 + S5)."""
        return project_message(self.reader(spark, streaming).load())


def kafka_writer(df: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str | None = None):
    """Encode rows as JSON values and publish.  ``acks=all`` and
    producer retries mirror the producer's delivery settings."""
    encoded = encode_events(df).selectExpr("json AS value")
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }
    if df.isStreaming:
        w = encoded.writeStream.format("kafka")
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
    else:
        w = encoded.write.format("kafka")
    for k, v in opts.items():
        w = w.option(k, v)
    return w
