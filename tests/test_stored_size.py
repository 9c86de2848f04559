"""Stored copies of the topic are packed, files bounded, and nothing is read or parsed twice."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from eventlens import storage
from eventlens.operators import bronze, merge
from eventlens.sources import files

RAW = "transaction_id string, user_id string, kafka_timestamp timestamp"


def _messages(spark, n=3000, day="2024-01-05"):
    text = F.concat(F.lit('{"data_type":"transaction","batch_id":"b","user_email":"user@example.com","transaction_id":"tx_'), F.col("id").cast("string"), F.lit('"}'))
    return spark.range(0, n, 1, 2).select(text.alias("json"), (F.lit(f"{day} 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("id") % 3600)).alias("kafka_timestamp"))


def _bytes(path):
    return sum(f.stat().st_size for f in Path(path).rglob("part-*"))


def test_replay_text_is_packed(spark, tmp_path):
    messages = _messages(spark)
    files.write_messages(messages, str(tmp_path / "text"))
    plain = messages.agg(F.sum(F.length("json"))).first()[0]
    assert _bytes(tmp_path / "text") * 3 < plain
    back = files.read_messages(spark, str(tmp_path / "text"))
    assert sorted(r.json for r in back.collect()) == sorted(r.json for r in messages.collect())


def test_replay_parquet_is_packed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FILE_ROWS", 100)
    messages = _messages(spark)
    files.write_messages(messages, str(tmp_path / "dump"), "parquet")
    footers = [pq.read_metadata(f) for f in (tmp_path / "dump").rglob("*.parquet")]
    assert max(m.num_rows for m in footers) <= 100
    assert {m.row_group(0).column(0).compression for m in footers} == {"ZSTD"}
    assert sorted(files.read_messages(spark, str(tmp_path / "dump"), "parquet").collect()) == sorted(messages.collect())


def test_bronze_files_are_bounded_and_settings_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "FILE_ROWS", 100)
    bad = spark.createDataFrame([("junk", None)], "json string, kafka_timestamp timestamp")
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen = spark.conf.get(key, None), []
    inner = storage.concurrent_writers

    def watched(session, n):
        seen.append(n)
        return inner(session, n)

    monkeypatch.setattr(storage, "concurrent_writers", watched)
    bronze.write_bronze(_messages(spark, 1000).unionByName(bad), str(tmp_path / "bronze"))
    rows = [pq.read_metadata(f).num_rows for f in (tmp_path / "bronze").rglob("*.parquet")]
    assert sum(rows) == 1001 and max(rows) <= 100
    assert seen == [4] and spark.conf.get(key, None) == before


def test_only_days_landed_again_are_read(spark, tmp_path, monkeypatch):
    read, inner = [], bronze._landed

    def watched(session, path, folders):
        read.append(sorted(folders))
        return inner(session, path, folders)

    monkeypatch.setattr(bronze, "_landed", watched)
    path = str(tmp_path / "days" / "events")
    first, second = _messages(spark, 50), _messages(spark, 50, "2024-01-06")
    for rows in (first, second, second):
        bronze.write_bronze(rows, path, by_date=True)
    assert read == [[], [], [], [], ["landing_date=2024-01-06"], ["landing_date=2024-01-06"]]
    assert spark.read.parquet(path).count() == 100


def test_merge_reads_its_rows_once(spark, tmp_path):
    names = merge.CONTRACTS["raw_transactions"].names
    values = [("a", "u1", "2024-01-02"), ("a", "u2", "2024-01-01"), (None, "u3", "2024-01-01"), (None, "u3", "2024-01-01"), (None, "u3", "2024-01-02"), (None, None, None), (None, None, None)]
    rows = spark.createDataFrame([(t, u, d) for t, u, d in values], "transaction_id string, user_id string, d string")
    types = dict(merge.CONTRACTS["raw_transactions"].columns)
    held = {"transaction_id", "user_id"}
    full = rows.select(*[F.col(c) if c in held else F.col("d").cast("timestamp_ntz").alias(c) if c == "kafka_timestamp" else F.lit(None).cast(types[c]).alias(c) for c in names])
    full.write.parquet(str(tmp_path / "rows"))
    once = merge._once(spark.read.parquet(str(tmp_path / "rows")), "raw_transactions")
    assert once._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    got = sorted(((r.transaction_id, r.user_id, str(r.kafka_timestamp)[:10]) for r in once.collect()), key=str)
    assert got == sorted([("a", "u2", "2024-01-01"), (None, "u3", "2024-01-01"), (None, "u3", "2024-01-02"), (None, None, "None")], key=str)
