"""Streaming semantics: closing rule and late data, the A6 filter and the
watermark, restart from checkpoint, and supervision."""

import json
import os
import time

import pytest

from eventlens.sources.files import read_messages
from eventlens.plans.pipeline import Tables
from eventlens.streaming.runner import AVAILABLE_NOW, Trigger, start_table_query, supervise, table_stream
from eventlens.streaming.sinks import ParquetTableSink
from tests.test_edges import sensor, tx


def write_file(folder, name, objs):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path + ".tmp", "w", encoding="utf-8") as f:
        for o in objs:
            f.write(json.dumps(o, ensure_ascii=False) + "\n")
    os.rename(path + ".tmp", path)
    time.sleep(1.1)  # distinct modification times


def run_steps(spark, tmp_dir, table, steps):
    """Feed files one at a time into one query; return the table and query."""
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    stream = read_messages(spark, src, "text", streaming=True, max_files_per_trigger=1)
    sink = ParquetTableSink(os.path.join(tmp_dir, "out"), table)
    q = start_table_query(stream, table, sink, os.path.join(tmp_dir, "ckpt"), Trigger("1 second"))
    try:
        for i, objs in enumerate(steps):
            write_file(src, f"part-{i:03d}.json", objs)
            q.processAllAvailable()
        # wait for the no-data batch that applies the final watermark
        last_data = max(_as_dict(p)["batchId"] for p in q.recentProgress if _as_dict(p)["numInputRows"] > 0)
        deadline = time.time() + 15
        while time.time() < deadline and not any(
            _as_dict(p)["batchId"] > last_data for p in q.recentProgress
        ):
            time.sleep(0.5)
        q.processAllAvailable()
        progress = q.recentProgress
    finally:
        q.stop()
    out = os.path.join(tmp_dir, "out", table)
    rows = spark.read.parquet(out).collect() if os.path.exists(out) else []
    return rows, progress


def _as_dict(p):
    return p if isinstance(p, dict) else json.loads(p.json)


def test_late_row_dropped_and_closed_window_unchanged(spark, tmp_dir):
    from eventlens.streaming.runner import ProgressLog

    listener = ProgressLog().attach(spark)
    steps = [
        [tx(1, transaction_date="2024-01-01T00:10:00"), tx(2, transaction_date="2024-01-01T00:50:00")],
        [tx(3, transaction_date="2024-01-01T02:10:00")],  # watermark -> 01:10, closes 00:00-01:00
        [tx(4, transaction_date="2024-01-01T00:30:00"), tx(5, transaction_date="2024-01-01T02:20:00")],
    ]
    rows, progress = run_steps(spark, tmp_dir, "transaction_hourly_stats", steps)
    by_start = {r.window_start.strftime("%H:%M"): r.transaction_count for r in rows}
    assert by_start.get("00:00") == 2  # the late 00:30 row did not change it
    drops = sum(
        sum(op.get("numRowsDroppedByWatermark", 0) for op in _as_dict(p).get("stateOperators", []))
        for p in progress
    )
    assert drops >= 1
    time.sleep(1)  # listener events are delivered asynchronously
    listener.detach(spark)
    assert listener.totals["transaction_hourly_stats"]["dropped_by_watermark"] >= 1
    assert listener.totals["transaction_hourly_stats"]["input_rows"] == 5


def test_far_future_normal_reading_does_not_close_anomaly_windows(spark, tmp_dir):
    steps = [
        [sensor(1, "2024-01-01T00:01:00"), sensor(2, "2024-01-01T00:02:00", status="critical")],
        [sensor(3, "2024-01-01T05:00:00", status="normal")],
    ]
    rows, _ = run_steps(spark, tmp_dir, "sensor_anomalies", steps)
    assert rows == []  # only anomalous readings move this watermark


def test_anomaly_window_closes_on_anomalous_progress(spark, tmp_dir):
    steps = [
        [sensor(1, "2024-01-01T00:01:00"), sensor(2, "2024-01-01T00:02:00")],
        [sensor(3, "2024-01-01T00:25:00")],  # watermark 00:15 closes 00:00-00:10
    ]
    rows, _ = run_steps(spark, tmp_dir, "sensor_anomalies", steps)
    assert [(r.window_start.strftime("%H:%M"), r.reading_count) for r in rows] == [("00:00", 2)]


def test_restart_resumes_from_checkpoint_without_duplicates(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    write_file(src, "a.json", [tx(1, transaction_date="2024-01-01T00:10:00")])
    write_file(src, "b.json", [tx(2, transaction_date="2024-01-01T03:10:00")])

    def once():
        stream = read_messages(spark, src, "text", streaming=True)
        q = start_table_query(stream, "device_stats", ParquetTableSink(out, "device_stats"), ckpt, AVAILABLE_NOW)
        q.awaitTermination()
        assert q.exception() is None

    once()
    first = spark.read.parquet(os.path.join(out, "device_stats")).count()
    write_file(src, "c.json", [tx(3, transaction_date="2024-01-01T06:10:00")])
    once()
    rows = spark.read.parquet(os.path.join(out, "device_stats")).collect()
    keys = [(r.window_start, r.device_type) for r in rows]
    assert first == 1 and len(rows) == 2 and len(set(keys)) == len(keys)


def test_raw_stream_holds_each_key_once_when_read(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    write_file(src, "a.json", [tx(1), tx(1), tx(2)])
    stream = read_messages(spark, src, "text", streaming=True)
    sink = ParquetTableSink(os.path.join(tmp_dir, "out"), "raw_transactions")
    q = start_table_query(stream, "raw_transactions", sink, os.path.join(tmp_dir, "ckpt"), AVAILABLE_NOW)
    q.awaitTermination()
    out = os.path.join(tmp_dir, "out")
    assert spark.read.parquet(os.path.join(out, "raw_transactions")).count() == 3
    assert sorted(r.transaction_id for r in Tables(spark, out).table("raw_transactions").collect()) == ["t1", "t2"]


def test_raw_stream_loses_no_late_row_and_quarantines_bad_ones(spark, tmp_dir):
    """Input = written + quarantined + rejected, however late and broken."""
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    bad = [tx(10, transaction_date="junk"), tx(11, transaction_amount=1e15), tx(None, transaction_id=None), "{broken"]

    def once():
        for t in ("raw_transactions", "rejected_messages"):
            stream = read_messages(spark, src, "text", streaming=True)
            q = start_table_query(stream, t, ParquetTableSink(out, t), os.path.join(tmp_dir, "ckpt"), AVAILABLE_NOW)
            q.awaitTermination()
            assert q.exception() is None

    write_file(src, "a.json", [tx(1, transaction_date="2024-06-01T00:00:00"), *bad])
    once()
    write_file(src, "b.json", [tx(2, transaction_date="2024-01-01T00:00:00")])  # months late
    once()
    written = spark.read.parquet(os.path.join(out, "raw_transactions"))
    assert sorted(r.transaction_id for r in written.collect()) == ["t1", "t2"]
    assert spark.read.parquet(os.path.join(out, "_quarantine", "raw_transactions")).count() == 3
    assert spark.read.parquet(os.path.join(out, "rejected_messages")).count() == 1


def test_wide_totals_reach_the_quarantine(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    write_file(src, "a.json", [tx(i, transaction_amount=9e9) for i in range(3)] + [tx(9, payment_method="card", transaction_amount=5.0), tx(8, transaction_date="2024-01-02T00:00:00")])
    stream = read_messages(spark, src, "text", streaming=True)
    q = start_table_query(stream, "payment_method_stats", ParquetTableSink(out, "payment_method_stats"), os.path.join(tmp_dir, "ckpt"), AVAILABLE_NOW)
    q.awaitTermination()
    assert [str(r.total_amount) for r in spark.read.parquet(os.path.join(out, "payment_method_stats")).collect()] == ["5.00"]
    bad = spark.read.parquet(os.path.join(out, "_quarantine", "payment_method_stats")).collect()
    assert [str(r.total_amount) for r in bad] == ["27000000000.00"]


def test_supervisor_raises_and_stops_all_on_failure(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    write_file(src, "a.json", [tx(1), tx(2, transaction_date="2024-01-01T05:00:00")])

    def boom(df, batch_id):
        raise ValueError("sink down")

    stream = read_messages(spark, src, "text", streaming=True)
    bad = start_table_query(stream, "raw_transactions", boom, os.path.join(tmp_dir, "c1"), Trigger("1 second"))
    good = start_table_query(
        stream,
        "device_stats",
        ParquetTableSink(os.path.join(tmp_dir, "out"), "device_stats"),
        os.path.join(tmp_dir, "c2"),
        Trigger("1 second"),
    )
    with pytest.raises(RuntimeError, match="raw_transactions"):
        supervise(spark, [bad, good])
    assert not bad.isActive and not good.isActive


def test_bronze_fed_stream_equals_direct_stream(spark, tmp_dir):
    from eventlens.streaming.runner import start_pipeline, start_pipeline_via_bronze

    src = os.path.join(tmp_dir, "in")
    write_file(
        src,
        "a.json",
        [tx(i, transaction_date=f"2024-01-01T0{i % 6}:{i % 60:02d}:00", device=["mobile", "tablet"][i % 2]) for i in range(40)]
        + [sensor(i, f"2024-01-01T00:{i:02d}:00") for i in range(30)],
    )
    tables = ("device_stats", "sensor_anomalies", "raw_transactions")
    direct = start_pipeline(read_messages(spark, src, "text", streaming=True), f"{tmp_dir}/o1", f"{tmp_dir}/c1",
                            tables=tables, trigger=AVAILABLE_NOW)
    supervise(spark, direct)
    via = start_pipeline_via_bronze(read_messages(spark, src, "text", streaming=True), f"{tmp_dir}/bronze",
                                    f"{tmp_dir}/o2", f"{tmp_dir}/c2", tables=tables, trigger=AVAILABLE_NOW)
    supervise(spark, via)
    for t in tables:
        a = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/o1/{t}").drop("micro_batch", "processed_at").collect()))
        b = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/o2/{t}").drop("micro_batch", "processed_at").collect()))
        assert a == b and len(a) > 0, t


def test_split_into_ordered_files_gives_same_closed_windows(spark, tmp_dir):
    """Metamorphic: the same events in one file or in ordered per-hour files
    (one file per trigger) close the same windows with the same values."""
    events = [
        tx(i, transaction_date=f"2024-01-01T{i // 20:02d}:{(i * 7) % 60:02d}:00", device=["mobile", "desktop"][i % 2])
        for i in range(100)
    ]
    one, _ = run_steps(spark, f"{tmp_dir}/a", "device_stats", [events])
    split = [events[h * 20 : (h + 1) * 20] for h in range(5)]
    many, _ = run_steps(spark, f"{tmp_dir}/b", "device_stats", split)

    def key(rows):
        return sorted((r.window_start, r.device_type, r.transaction_count, r.success_rate) for r in rows)

    closed_in_one = {r.window_start for r in one}
    assert closed_in_one and key([r for r in many if r.window_start in closed_in_one]) == key(one)


def test_bronze_fed_pipeline_runs_continuously(spark, tmp_dir):
    """Processing-time trigger: the bronze query and the table queries run
    at the same time; table queries pick up bronze files as the file sink
    commits them."""
    from eventlens.streaming.runner import start_pipeline_via_bronze

    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    tables = ("device_stats", "raw_transactions")
    qs = start_pipeline_via_bronze(
        read_messages(spark, src, "text", streaming=True), f"{tmp_dir}/bronze", f"{tmp_dir}/out",
        f"{tmp_dir}/ck", tables=tables, trigger=Trigger("1 second"),
    )
    try:
        write_file(src, "a.json", [tx(i, transaction_date=f"2024-01-01T00:{i:02d}:00") for i in range(30)])
        write_file(src, "b.json", [tx(100 + i, transaction_date=f"2024-01-01T02:{i:02d}:00") for i in range(5)])
        for _ in range(3):
            for q in qs:
                q.processAllAvailable()
            time.sleep(1.5)
        assert all(q.isActive for q in qs)
    finally:
        for q in qs:
            q.stop()
    raw = spark.read.parquet(f"{tmp_dir}/out/raw_transactions").count()
    windows = {r.window_start.strftime("%H:%M") for r in spark.read.parquet(f"{tmp_dir}/out/device_stats").collect()}
    assert raw == 35
    assert windows == {"00:00"}  # 02:00 is still open: watermark 02:04 - 30 min


def test_rejected_messages_table_keeps_unroutable_input(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w", encoding="utf-8") as f:
        f.write('{not json\n{"data_type": "other", "x": 1}\n' + json.dumps(tx(1)) + "\n")
    stream = read_messages(spark, src, "text", streaming=True)
    sink = ParquetTableSink(os.path.join(tmp_dir, "out"), "rejected_messages")
    q = start_table_query(stream, "rejected_messages", sink, os.path.join(tmp_dir, "ckpt"), AVAILABLE_NOW)
    q.awaitTermination()
    rows = spark.read.parquet(os.path.join(tmp_dir, "out", "rejected_messages")).collect()
    assert sorted(r.json for r in rows) == ['{"data_type": "other", "x": 1}', "{not json"]


def test_streaming_dedup_of_a_hot_copy_group(spark, tmp_dir):
    """A third of the messages are copies of one transaction, in several
    files (different broker times): exactly one row per key survives."""
    src = os.path.join(tmp_dir, "in")
    for part in range(3):
        write_file(src, f"p{part}.json", [tx(99999) if i % 3 == 0 else tx(1000 * part + i) for i in range(60)])
    write_file(src, "none.json", [tx(0, transaction_id=None), tx(0, transaction_id=None)])
    stream = table_stream(read_messages(spark, src, "text", streaming=True), "raw_transactions", dedup_within="1 day")
    sink = ParquetTableSink(os.path.join(tmp_dir, "out"), "raw_transactions")
    q = start_table_query(None, "raw_transactions", sink, os.path.join(tmp_dir, "ckpt"), AVAILABLE_NOW, prepared=stream)
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(tmp_dir, "out", "_quarantine", "raw_transactions")).count() == 2
    ids = [r.transaction_id for r in spark.read.parquet(os.path.join(tmp_dir, "out", "raw_transactions")).collect()]
    assert len(ids) == len(set(ids)) and ids.count("t99999") == 1
    assert len(ids) == 1 + 3 * 40
