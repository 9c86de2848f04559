"""Shared queries at size: messages of other kinds are not parsed, a batch is
computed once without a cache, and the state of a backlog is kept off the heap."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventlens import session
from eventlens.operators import parse
from eventlens.streaming.runner import AVAILABLE_NOW, start_shared_pipeline, supervise
from eventlens.streaming.sinks import SharedSink

STATE = "spark.sql.streaming.stateStore"


def _messages(spark):
    texts = [
        '{"data_type":"transaction","transaction_id":"plain"}',
        '{"data_type":"tr\\u0061nsaction","transaction_id":"escaped"}',
        "{'data_type': 'transaction', 'transaction_id': 'quoted'}",
        '{"data_type":"activity","user_name":"transaction"}',
        '{"data_type":"sensor","unit":"\\u00b0C"}',
        '{"data_type":"sensor","sensor_id":"s"}',
        '{"data_type":"transaction","transaction_id":7,"user_age":"old"}',
        '{"data_type":"transact',
        "",
        None,
    ]
    return spark.createDataFrame([(t, None) for t in texts], "json string, kafka_timestamp timestamp")


def test_messages_that_cannot_be_of_a_kind_are_not_parsed(spark):
    messages = _messages(spark)
    passed = [r.json for r in messages.filter(parse.may_be("transaction")).collect()]
    assert len(passed) == 6 and '{"data_type":"sensor","sensor_id":"s"}' not in passed
    rows = parse.typed(messages, "transaction")
    assert sorted(r.transaction_id for r in rows.collect()) == ["7", "escaped", "plain", "quoted"]
    whole = messages.select(F.inline(F.array(F.from_json("json", parse.UNION))))
    for kind in parse.KINDS:
        assert parse.typed(messages, kind).count() == whole.filter(F.col("data_type") == kind).count()


@pytest.mark.parametrize("partition", [None, "kind"])
def test_a_shared_batch_is_computed_once_and_not_cached(spark, tmp_path, partition):
    batch = spark.range(100).select("id", F.expr("if(id % 2 = 0, 'a', 'b')").alias("kind"), F.expr("uuid()").alias("once"))
    seen = {}

    def sink(name):
        def write(df, batch_id):
            assert "InMemoryRelation" not in df._jdf.queryExecution().optimizedPlan().toString()
            assert df.columns == ["id", "kind", "once"]
            seen[name] = {r.id: r.once for r in df.collect()}

        return write

    tables = {"all": lambda df: df, "a": lambda df: df.filter("kind = 'a'"), "b": lambda df: df.filter("kind = 'b'")}
    SharedSink(tables, {t: sink(t) for t in tables}, str(tmp_path / "scratch"), partition)(batch, 0)
    assert len(seen["a"]) == len(seen["b"]) == 50 and seen["a"] | seen["b"] == seen["all"]
    assert not list((tmp_path / "scratch").iterdir())


def test_a_failed_shared_batch_leaves_no_files(spark, tmp_path):
    def broken(df, batch_id):
        raise OSError("target lost")

    with pytest.raises(OSError):
        SharedSink({"t": lambda df: df}, {"t": broken}, str(tmp_path))(spark.range(3).toDF("id"), 0)
    assert not list(tmp_path.iterdir())


def test_state_settings_hold_for_the_started_queries_only(spark, tmp_path):
    keys = [*session.LARGE_STATE, *session.LOCAL_FILES]
    before = {k: spark.conf.get(k, None) for k in keys}
    own = f"{STATE}.rocksdb.maxMemoryUsageMB"
    spark.conf.set(own, "77")
    try:
        with session.large_state(spark, str(tmp_path)):
            assert spark.conf.get(own) == "77"
            assert spark.conf.get(f"{STATE}.unloadOnCommit") == "true"
            assert spark.conf.get(next(iter(session.LOCAL_FILES))).endswith("FileSystemBasedCheckpointFileManager")
        assert spark.conf.get(own) == "77"
    finally:
        spark.conf.unset(own)
    assert {k: spark.conf.get(k, None) for k in keys} == before


def test_a_backlog_keeps_its_state_off_the_heap(spark, tmp_path):
    key = f"{STATE}.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        path = str(tmp_path / "topic")
        rows = [(f'{{"data_type":"transaction","transaction_id":"t{i}","device":"d","status":"success","transaction_date":"2024-01-01T0{i}:00:00"}}',) for i in range(5)]
        spark.createDataFrame(rows, "json string").withColumn("kafka_timestamp", F.lit(None).cast("timestamp")).write.parquet(path)
        messages = spark.readStream.schema("json string, kafka_timestamp timestamp").parquet(path)
        queries = start_shared_pipeline(messages, str(tmp_path / "out"), str(tmp_path / "ckpt"), ("payment_method_stats", "device_stats", "raw_transactions"), AVAILABLE_NOW)
        supervise(spark, queries)
    finally:
        if before is not None:
            spark.conf.set(key, before)
    offsets = next((tmp_path / "ckpt").glob("payment*/offsets/0")).read_text()
    assert "RocksDBStateStoreProvider" in offsets
    assert sum(e.stat().st_size > 0 for e in Path(tmp_path / "out").rglob("device_stats/*/part-*.parquet")) > 0
    assert not list((tmp_path / "out" / "_staging").iterdir())
