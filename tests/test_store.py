"""Run-keyed batches, their manifest, and compaction."""

import os

import pytest
from pyspark.sql import functions as F

from eventlens import storage
from eventlens.sources.files import read_messages
from eventlens.sources.messages import stored_topic
from eventlens.streaming import store
from eventlens.streaming.runner import AVAILABLE_NOW, start_table_query
from eventlens.streaming.sinks import ParquetTableSink
from tests.conftest import SF_SMALL


_TOPIC = []


def run(spark, out, checkpoint, table="payment_method_stats", files=1):
    if not _TOPIC:
        _TOPIC.append(f"{out}-topic")
        stored_topic(spark, SF_SMALL).repartitionByRange(3, "kafka_timestamp").write.parquet(_TOPIC[0])
    messages = read_messages(spark, _TOPIC[0], "parquet", streaming=True, max_files_per_trigger=files)
    q = start_table_query(messages, table, ParquetTableSink(out, table), checkpoint, AVAILABLE_NOW)
    q.awaitTermination()
    assert q.exception() is None


def content(df):
    return sorted(map(tuple, df.drop("processed_at", "event_date").collect()))


def test_a_new_checkpoint_keeps_the_old_run(spark, tmp_dir):
    out = f"{tmp_dir}/t"
    run(spark, out, f"{tmp_dir}/c1", "raw_transactions")
    first = content(store.stored(spark, out, "raw_transactions"))
    run(spark, out, f"{tmp_dir}/c1", "raw_transactions")  # a restart finds nothing new
    assert content(store.stored(spark, out, "raw_transactions")) == first
    run(spark, out, f"{tmp_dir}/c2", "raw_transactions")  # batch ids begin at 0 again
    both = store.stored(spark, out, "raw_transactions")
    assert content(both) == sorted(first * 2)
    assert len({e["run"] for e in store.entries(spark, out, "raw_transactions")}) == 2


def test_windows_of_two_runs_are_read_once(spark, tmp_dir):
    out = f"{tmp_dir}/t"
    run(spark, out, f"{tmp_dir}/c1")
    first = content(store.stored(spark, out, "payment_method_stats"))
    run(spark, out, f"{tmp_dir}/c2")
    assert content(store.stored(spark, out, "payment_method_stats")) == first
    assert len(content(store.stored(spark, out, "payment_method_stats", unique=False))) == 2 * len(first)


@pytest.mark.parametrize("target", [1 << 30, 3000])
def test_compaction_leaves_the_rows(spark, tmp_dir, target):
    out, table = f"{tmp_dir}/t", "raw_transactions"
    run(spark, out, f"{tmp_dir}/c1", table)
    n = len(store.entries(spark, out, table))
    before = content(store.stored(spark, out, table))
    assert n > 1
    entry = store.compact(spark, out, table, target_bytes=target)
    assert entry["rows"] == len(before) and len(entry["replaces"]) == n
    assert content(store.stored(spark, out, table)) == before
    assert [e["kind"] for e in store.entries(spark, out, table)] == ["compacted"]
    assert not [f for f in storage.folders(spark, f"{out}/{table}") if f.startswith("micro_batch")]
    dates = storage.folders(spark, f"{out}/{entry['path']}")
    assert all(d.startswith("event_date=") for d in dates)
    files = [f for _, _, fs in os.walk(f"{out}/{entry['path']}") for f in fs if f.endswith(".parquet")]
    assert len(files) == len(dates) if target > 1 << 20 else len(files) > len(dates)
    run(spark, out, f"{tmp_dir}/c2", table)
    assert content(store.stored(spark, out, table)) == sorted(before * 2)
    store.compact(spark, out, table, full=True)
    assert content(store.stored(spark, out, table)) == sorted(before * 2)
    assert store.compact(spark, out, table) is None


def test_readers_see_committed_batches_only(spark, tmp_dir):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' window_start, timestamp_ntz'2024-01-01 00:30:00' window_end, 'm' device_type, 3 transaction_count, 1.5D success_rate")

    class Cut(ParquetTableSink):
        def committed(self, *args):
            raise KeyboardInterrupt("killed between data and commit")

    ParquetTableSink(tmp_dir, "device_stats")(df, 0)
    with pytest.raises(KeyboardInterrupt):
        Cut(tmp_dir, "device_stats")(df, 1)
    assert spark.read.parquet(f"{tmp_dir}/device_stats").count() == 2
    assert store.stored(spark, tmp_dir, "device_stats").count() == 1
    ParquetTableSink(tmp_dir, "device_stats")(df, 1)  # the retry
    ParquetTableSink(tmp_dir, "device_stats")(df.where(F.lit(False)), 2)
    assert store.stored(spark, tmp_dir, "device_stats").count() == 2


def test_a_compaction_cut_before_its_entry_changes_nothing(spark, tmp_dir, monkeypatch):
    out, table = f"{tmp_dir}/t", "raw_transactions"
    run(spark, out, f"{tmp_dir}/c1", table)
    before = content(store.stored(spark, out, table))
    monkeypatch.setattr(store, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        store.compact(spark, out, table)
    monkeypatch.undo()
    assert content(store.stored(spark, out, table)) == before
    assert store.compact(spark, out, table)["batch"] == 1
    assert content(store.stored(spark, out, table)) == before


def test_shared_queries_give_the_tables_of_single_ones(spark, tmp_dir):
    from eventlens.operators import aggregates, parse
    from eventlens.streaming.runner import STREAM_TABLES, start_pipeline, start_shared_pipeline, supervise

    path = f"{tmp_dir}/topic"
    stored_topic(spark, SF_SMALL).repartitionByRange(2, "kafka_timestamp").write.parquet(path)
    source = lambda: read_messages(spark, path, "parquet", streaming=True, max_files_per_trigger=1)
    shared = start_shared_pipeline(source(), f"{tmp_dir}/a", f"{tmp_dir}/ca", trigger=AVAILABLE_NOW, name_prefix="s_")
    assert len(shared) == 6  # of 11 tables
    supervise(spark, shared)
    names = STREAM_TABLES + tuple(parse.RAW)
    supervise(spark, start_pipeline(source(), f"{tmp_dir}/b", f"{tmp_dir}/cb", trigger=AVAILABLE_NOW))
    for t in names:
        a, b = content(store.stored(spark, f"{tmp_dir}/a", t)), content(store.stored(spark, f"{tmp_dir}/b", t))
        assert a == b and (a or t.startswith("sensor_anomalies")), t
    assert ("sensor_anomalies", "sensor_anomalies_ext") in aggregates.shared_groups(STREAM_TABLES)


def test_a_failing_table_of_a_shared_query_fails_alone(spark, tmp_dir):
    from eventlens.streaming.sinks import SharedSink

    class Broken(ParquetTableSink):
        def write(self, df, batch_id):
            raise OSError("target lost")

    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' window_start, timestamp_ntz'2024-01-01 00:30:00' window_end, 'm' device_type, 3 transaction_count, 1.5D success_rate")
    sinks = {"a": Broken(f"{tmp_dir}/a", "device_stats"), "b": ParquetTableSink(f"{tmp_dir}/b", "device_stats")}
    SharedSink({t: (lambda batch: batch) for t in sinks}, sinks)(df, 0)
    assert [s.stats[-1][1] for s in sinks.values()] == ["fallback", "written"]
    assert spark.read.parquet(f"{tmp_dir}/a/_fallback/device_stats").count() == 1


def test_command_line_compacts_and_replays(spark, tmp_dir, capsys):
    import json

    from eventlens import app

    run(spark, f"{tmp_dir}/t", f"{tmp_dir}/c", "raw_sensors")
    n = store.stored(spark, f"{tmp_dir}/t", "raw_sensors").count()
    assert app.main(["compact", "--tables", f"{tmp_dir}/t", "--name", "raw_sensors", "device_stats"]) == 0
    assert app.main(["replay", "--tables", f"{tmp_dir}/t", "--name", "raw_sensors"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert lines == [{"table": "raw_sensors", "rows": n}, {"table": "raw_sensors", "taken": 0}]


def test_jdbc_reads_are_split_by_time(monkeypatch):
    from eventlens.plans.pipeline import JdbcTables
    from eventlens.streaming.sinks import JdbcTableSink

    tables = JdbcTables(None, "jdbc:x", partitions=4)
    monkeypatch.setattr(JdbcTables, "bounds", lambda self, name, column: ("2024-01-01", "2024-02-01"))
    assert tables.split("device_stats") == {"column": "window_start", "lowerBound": "2024-01-01", "upperBound": "2024-02-01", "numPartitions": 4}
    assert tables.split("hourly_metrics")["column"] == "hour"
    assert tables.split("raw_sensors")["column"] == "kafka_timestamp"
    monkeypatch.setattr(JdbcTables, "bounds", lambda self, name, column: (None, None))
    assert tables.split("device_stats") is None
    query = JdbcTableSink("/unused", "device_stats", url="jdbc:x", dbtable='public."Device_Stats"').catalog_query()
    assert query == "SELECT count(*) AS n FROM information_schema.tables WHERE lower(table_name) = 'device_stats' AND lower(table_schema) = 'public'"


def test_a_batch_that_fails_on_its_second_run_is_not_in_the_manifest(spark, tmp_dir):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' window_start, timestamp_ntz'2024-01-01 00:30:00' window_end, 'm' device_type, 3 transaction_count, 1.5D success_rate")

    class Lost(ParquetTableSink):
        def write(self, df, batch_id):
            raise OSError("target lost")

    ParquetTableSink(tmp_dir, "device_stats")(df, 0)
    ParquetTableSink(tmp_dir, "device_stats")(df, 1)
    Lost(tmp_dir, "device_stats")(df, 1)
    assert store.stored(spark, tmp_dir, "device_stats").count() == 1
