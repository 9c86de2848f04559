"""Sinks: re-delivered batches, empty batches, fallback, and options of the
external connectors (inspected only: no broker or database here)."""

import os

import pytest
from pyspark.sql import functions as F

from eventlens.contracts import CONTRACTS
from eventlens.sources.kafka import KafkaSource, kafka_writer
from eventlens.streaming.sinks import JdbcTableSink, ParquetTableSink


def _device_rows(spark):
    return spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 00:30:00", "mobile", 3, 66.67)],
        "window_start string, window_end string, device_type string, transaction_count int, success_rate double",
    ).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "device_type",
        "transaction_count",
        "success_rate",
    )


def test_redelivered_batch_is_written_once(spark, tmp_dir):
    sink = ParquetTableSink(tmp_dir, "device_stats")
    df = _device_rows(spark)
    sink(df, 7)
    sink(df, 7)  # retry of the same micro-batch
    assert spark.read.parquet(os.path.join(tmp_dir, "device_stats")).count() == 1


def test_empty_batch_is_skipped(spark, tmp_dir):
    sink = ParquetTableSink(tmp_dir, "device_stats")
    sink(_device_rows(spark).limit(0), 3)
    assert list(sink.stats) == [(3, "empty")]
    assert not os.path.exists(os.path.join(tmp_dir, "device_stats"))


class FailingSink(ParquetTableSink):
    def write(self, df, batch_id):
        raise IOError("target unavailable")


def test_failed_write_goes_to_fallback(spark, tmp_dir):
    sink = FailingSink(os.path.join(tmp_dir, "t"), "device_stats", fallback_root=os.path.join(tmp_dir, "fb"))
    sink(_device_rows(spark), 4)
    assert list(sink.stats) == [(4, "fallback")]
    assert spark.read.parquet(os.path.join(tmp_dir, "fb", "device_stats", "micro_batch=4")).count() == 1


def test_failed_fallback_raises_so_the_batch_is_retried(spark, tmp_dir):
    blocker = os.path.join(tmp_dir, "file")
    open(blocker, "w").close()  # a file where the fallback folder should be
    sink = FailingSink(os.path.join(tmp_dir, "t"), "device_stats", fallback_root=blocker)
    with pytest.raises(Exception):
        sink(_device_rows(spark), 5)


def test_quarantine_receives_lossy_rows(spark, tmp_dir):
    df = _device_rows(spark).withColumn("success_rate", F.lit(12345.0))  # exceeds DECIMAL(5,2)
    sink = ParquetTableSink(os.path.join(tmp_dir, "t"), "device_stats", quarantine_root=os.path.join(tmp_dir, "q"))
    sink(df, 1)
    assert spark.read.parquet(os.path.join(tmp_dir, "q", "device_stats")).count() == 1
    assert spark.read.parquet(os.path.join(tmp_dir, "t", "device_stats")).count() == 0


def test_lossy_rows_have_a_place_by_default(spark, tmp_dir):
    df = _device_rows(spark).withColumn("window_start", F.lit("junk"))
    sink = ParquetTableSink(tmp_dir, "device_stats")
    sink(df, 1)
    assert list(sink.stats) == [(1, "written")]
    assert spark.read.parquet(os.path.join(tmp_dir, "_quarantine", "device_stats")).first().window_start == "junk"


def test_failed_batch_is_in_the_fallback_only(spark, tmp_dir):
    class HalfSink(ParquetTableSink):
        def write(self, df, batch_id):
            super().write(df, batch_id)
            raise IOError("lost the target after writing")

    HalfSink(tmp_dir, "device_stats")(_device_rows(spark), 2)
    assert spark.read.parquet(os.path.join(tmp_dir, "_fallback", "device_stats")).count() == 1
    assert not os.path.exists(os.path.join(tmp_dir, "device_stats", "micro_batch=2"))


def test_jdbc_rows_already_held_are_dropped_null_safe(spark):
    rows = [("2024-01-01 00:00:00", "2024-01-01 01:00:00", c, k, 1) for c, k in (("a", None), (None, None), ("b", "x"))]
    cols = "window_start string, window_end string, user_city string, transaction_category string, transaction_count int"
    df = spark.createDataFrame(rows, cols).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    sink = JdbcTableSink("/unused", "transaction_hourly_stats", url="jdbc:x")
    assert sink.range_column == "window_start"
    assert sink.new_rows(df, df.filter("user_city is null or user_city = 'a'")).count() == 1
    plan = sink.new_rows(df, df)._jdf.queryExecution().optimizedPlan().toString()
    assert "<=>" in plan and "2024-01-01" in plan  # null-safe keys, literal bounds
    assert JdbcTableSink("/unused", "raw_sensors", url="jdbc:x").range_column == "kafka_timestamp"
    assert "metadata TEXT" in JdbcTableSink("/unused", "raw_transactions", url="jdbc:x").options()["createTableColumnTypes"]


def test_command_line_chooses_the_jdbc_sink(monkeypatch):
    from argparse import Namespace

    from eventlens.app import jdbc_sink_of

    monkeypatch.setenv("DB_PASSWORD", "secret")
    args = Namespace(jdbc_url="jdbc:postgresql://db/x", out="/o", fallback=None, quarantine=None, jdbc_user="u",
                     jdbc_password_env="DB_PASSWORD", jdbc_driver=None)
    sink = jdbc_sink_of(args)("device_stats")
    assert isinstance(sink, JdbcTableSink) and sink.options()["password"] == "secret"
    assert sink.quarantine_root == "/o/_quarantine"
    assert jdbc_sink_of(Namespace(jdbc_url=None)) is None


def test_kafka_source_options():
    src = KafkaSource("broker:9092", "user_transactions")
    assert src.options() == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "user_transactions",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    assert KafkaSource("b:1", "t", max_offsets_per_trigger=1000).options()["maxOffsetsPerTrigger"] == "1000"


def test_kafka_writer_encodes_json(spark):
    df = spark.createDataFrame([(1, "x")], "a int, kafka_timestamp string")
    w = kafka_writer(df, "broker:9092", "topic")
    assert w is not None


def test_jdbc_sink_options_carry_contract_types():
    sink = JdbcTableSink("/unused", "device_stats", url="jdbc:postgresql://db/x", user="u", password="p",
                         driver="org.postgresql.Driver")
    opts = sink.options()
    assert opts["dbtable"] == "device_stats"
    assert "success_rate DECIMAL(5,2)" in opts["createTableColumnTypes"]
    assert CONTRACTS["device_stats"].key == ("window_start", "window_end", "device_type")
