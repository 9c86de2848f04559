"""Late rows and corrections, replay, merged dates, offset gaps, rescued
fields and recent tables on hand-made input."""

import json
import os

import pytest
from pyspark.sql import functions as F

from eventlens import storage
from eventlens.contracts import CONTRACTS, conform
from eventlens.operators import merge, rescue, sketches
from eventlens.plans.pipeline import Pipeline, RecentTables, Tables
from eventlens.streaming import late, replay, store
from eventlens.streaming.offsets import Gap, OffsetLedger
from eventlens.streaming.sinks import MergedTableSink, ParquetTableSink

TABLE = "payment_method_stats"


def events(spark, rows):
    """(event time, amount) -> typed transactions."""
    df = spark.createDataFrame([(t, "cash", float(a)) for t, a in rows], "t string, payment_method string, transaction_amount double")
    return df.select(F.col("t").cast("timestamp").alias("event_time"), "payment_method", "transaction_amount")


def late_times(spark, root):
    rows = late.late_rows(spark, root, TABLE)
    return sorted(str(r.event_time)[11:16] for r in rows.collect()) if rows is not None else []


@pytest.mark.parametrize("through", [False, True])
def test_rows_behind_the_watermark(spark, tmp_dir, through):
    handler = late.LateRows(tmp_dir, TABLE, through)
    handler(events(spark, [("2024-01-01 10:05", 1), ("2024-01-01 12:00", 1)]), 0)
    first = ["10:05"] if through else []  # 10:30 <= 12:00 - 30 min, but the batch closes it itself
    assert late_times(spark, tmp_dir) == first
    second = events(spark, [("2024-01-01 10:10", 2), ("2024-01-01 11:00", 2), ("2024-01-01 11:40", 2), (None, 9)])
    handler(second, 1)
    expected = sorted([*first, "10:10", "11:00"])  # 11:30 <= 11:30 is closed, 12:00 is not
    assert late_times(spark, tmp_dir) == expected
    handler(second, 1)  # the batch again
    assert late_times(spark, tmp_dir) == expected
    handler(events(spark, []), 2)
    handler(events(spark, [("2024-01-01 11:15", 2)]), 3)  # the mark outlives a batch without rows
    assert late_times(spark, tmp_dir) == sorted([*expected, "11:15"])


def test_corrections_replace_touched_windows_and_add_missing_ones(spark, tmp_dir):
    all_rows = [("2024-01-01 10:05", 1), ("2024-01-01 10:06", 5), ("2024-01-01 11:10", 2), ("2024-01-01 15:00", 3)]
    stored = events(spark, [all_rows[0], all_rows[3]])
    from eventlens.operators import aggregates

    ParquetTableSink(tmp_dir, TABLE)(aggregates.build(TABLE, stored, conform_output=False), 0)
    handler = late.LateRows(tmp_dir, TABLE, through=False)
    handler(stored, 0)
    handler(events(spark, all_rows[1:3]), 1)
    days = []

    def of(d):
        days.append(tuple(map(str, d)))
        return events(spark, all_rows)

    assert late.correct(spark, tmp_dir, TABLE, of) == 2
    assert late.correct(spark, tmp_dir, TABLE, of) == 0 and days == [("2024-01-01", "2024-01-01")]
    got = late.corrected(spark, tmp_dir, TABLE)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, aggregates.build(TABLE, events(spark, all_rows)).collect()))
    all_rows.append(("2024-01-01 11:20", 7))  # later still: the window is corrected again
    handler(events(spark, all_rows[-1:]), 2)
    assert late.correct(spark, tmp_dir, TABLE, of) == 1
    got = late.corrected(spark, tmp_dir, TABLE)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, aggregates.build(TABLE, events(spark, all_rows)).collect()))


def devices(spark, rows):
    cols = "window_start string, device_type string, transaction_count int, success_rate double"
    df = spark.createDataFrame([(f"2024-01-01 {h}:00:00" if h else "junk", d, n, r) for h, d, n, r in rows], cols)
    end = (F.col("window_start").try_cast("timestamp_ntz") + F.expr("interval 30 minutes")).cast("string")
    return df.withColumn("window_end", end)


class Flaky(ParquetTableSink):
    fails = (1,)

    def write(self, df, batch_id):
        super().write(df, batch_id)
        if batch_id in self.fails:
            raise OSError("target lost")


def content(spark, root):
    return sorted(map(tuple, conform(store.stored(spark, root, "device_stats"), "device_stats").collect()))


def test_replay_of_the_fallback_equals_a_clean_run(spark, tmp_dir):
    batches = [devices(spark, [("10", "a", 1, 1.0)]), devices(spark, [("11", "a", 2, 2.0), ("11", "b", 2, 12345.0)]), devices(spark, [("11", "a", 2, 2.0), ("12", None, 3, 3.0)])]
    for sink in (Flaky(f"{tmp_dir}/x", "device_stats"), ParquetTableSink(f"{tmp_dir}/y", "device_stats")):
        for i, b in enumerate(batches):
            sink(b, i)
    # the row of batch 1 that batch 2 delivered again is held already
    assert replay.replay(spark, f"{tmp_dir}/x", "device_stats") == 0
    assert content(spark, f"{tmp_dir}/x") == sorted(set(content(spark, f"{tmp_dir}/y")))
    assert [tuple(r) for r in replay.ledger(spark, f"{tmp_dir}/x", "device_stats").collect()] == [("_fallback", "micro_batch=1", 0, 1, 1)]
    # what did not fit is in quarantine; mended there, it comes back once
    mend = lambda rows: rows.withColumn("success_rate", F.least("success_rate", F.lit(100.0)))
    assert replay.replay(spark, f"{tmp_dir}/x", "device_stats", replay.QUARANTINE) == 0
    assert replay.replay(spark, f"{tmp_dir}/x", "device_stats", replay.QUARANTINE, mend) == 1
    assert replay.replay(spark, f"{tmp_dir}/x", "device_stats", replay.QUARANTINE, mend) == 0
    assert [str(r[4]) for r in content(spark, f"{tmp_dir}/x") if r[2] == "b"] == ["100.00"]


def test_a_replay_that_breaks_off_is_run_again(spark, tmp_dir, monkeypatch):
    sink = Flaky(tmp_dir, "device_stats")
    for i in (0, 1):
        sink(devices(spark, [(str(10 + i), None, 1, 1.0)]), i)
    commit = store.commit
    monkeypatch.setattr(store, "commit", lambda *a: (commit(*a), (_ for _ in ()).throw(KeyboardInterrupt())))
    with pytest.raises(KeyboardInterrupt):
        replay.replay(spark, tmp_dir, "device_stats")
    monkeypatch.undo()
    assert replay.replay(spark, tmp_dir, "device_stats") == 1
    assert len(content(spark, tmp_dir)) == 2  # null keys included, each once


def raw(spark, rows):
    """(id, event time, broker time) -> conformed raw transactions."""
    values = {"transaction_id": "id", "transaction_date": "t", "kafka_timestamp": "k"}
    df = spark.createDataFrame(rows, "id string, t string, k string")
    cols = [(F.col(values[c]) if c in values else F.lit(None)).cast(d).alias(c) for c, d in CONTRACTS["raw_transactions"].columns]
    return df.select(*cols)


def test_merge_touches_the_dates_it_must(spark, tmp_dir):
    t = "raw_transactions"
    merge.merge(raw(spark, [("a1", "2024-01-01 10:00", "2024-01-01 10:01"), ("a2", "2024-01-02 10:00", "2024-01-02 10:01"), ("b1", "2024-01-03 10:00", "2024-01-03 10:01"), ("b2", "2024-01-03 11:00", "2024-01-03 11:01")]), tmp_dir, t)
    files = lambda d: set(os.listdir(f"{tmp_dir}/{t}/event_date={d}"))
    before = {d: files(f"2024-01-0{d}") for d in (1, 2, 3)}
    # b2 again a day later; a2 again with another time: its first delivery stays
    touched = merge.merge(raw(spark, [("b2", "2024-01-03 11:00", "2024-01-04 11:01"), ("a2", "2024-01-03 09:00", "2024-01-04 09:00")]), tmp_dir, t)
    assert touched == ["2024-01-02", "2024-01-03"]
    assert files("2024-01-01") == before[1] and files("2024-01-03") != before[3]
    rows = spark.read.parquet(f"{tmp_dir}/{t}")
    assert sorted((r.transaction_id, str(r.transaction_date)) for r in rows.collect()) == [("a1", "2024-01-01 10:00:00"), ("a2", "2024-01-02 10:00:00"), ("b1", "2024-01-03 10:00:00"), ("b2", "2024-01-03 11:00:00")]
    # an earlier delivery that arrives late moves the row to its date
    merge.merge(raw(spark, [("b1", "2024-01-01 08:00", "2024-01-01 08:01")]), tmp_dir, t)
    moved = spark.read.parquet(f"{tmp_dir}/{t}").where("transaction_id = 'b1'").first()
    assert str(moved.event_date) == "2024-01-01"
    assert Tables(spark, tmp_dir).table(t).count() == 4
    plan = Tables(spark, tmp_dir).table(t)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan  # a read groups nothing


def test_merge_reads_by_partition_and_key_range(spark, tmp_dir):
    t = "raw_transactions"
    merge.merge(raw(spark, [(f"a{d}", f"2024-01-0{d} 10:00", "2024-01-09 10:01") for d in range(1, 8)]), tmp_dir, t)
    dates = merge.read_dates(spark, f"{tmp_dir}/{t}", ["2024-01-02"])
    plan = dates._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date" in plan.split("PartitionFilters")[1][:200]
    assert dates.count() == 1
    batch = raw(spark, [("a5", "2024-01-06 00:00", "2024-01-10 00:00")])
    assert merge.dates_of_keys(spark, f"{tmp_dir}/{t}", t, batch, ["2024-01-06"]) == ["2024-01-05"]
    assert merge.dates_of_keys(spark, f"{tmp_dir}/{t}", t, raw(spark, []), []) == []


def test_rows_without_a_key_are_merged_once_per_delivery(spark, tmp_dir):
    rows = [(None, None, 1.0, "2024-01-01 10:00"), (None, None, 1.0, "2024-01-01 11:00")]
    df = spark.createDataFrame(rows, "id string, t string, v double, k string")
    values = {"sensor_id": "id", "timestamp": "t", "value": "v", "kafka_timestamp": "k"}
    sensors = df.select(*[(F.col(values[c]) if c in values else F.lit(None)).cast(d).alias(c) for c, d in CONTRACTS["raw_sensors"].columns])
    for batch in (0, 0, 1):  # a retry, and the same messages again
        sink = MergedTableSink(tmp_dir, "raw_sensors")
        sink(sensors, batch)
        assert sink.stats[-1] == (batch, "written")
    assert Tables(spark, tmp_dir).table("raw_sensors").count() == 2


def test_offset_gaps():
    told = []
    ledger = OffsetLedger(told.append)

    def progress(batch, start, end, rows=None):
        source = {"startOffset": json.dumps({"t": start}) if start else None, "endOffset": {"t": end}, "numInputRows": sum(end.values()) - sum((start or end).values()) if rows is None else rows}
        return {"name": "q", "batchId": batch, "sources": [source]}

    assert ledger.record(progress(0, None, {"0": 10, "1": 7})) == []
    assert ledger.record(progress(1, {"0": 10, "1": 7}, {"0": 20, "1": 9})) == []
    assert ledger.record(progress(2, {"0": 26, "1": 9}, {"0": 30, "1": 9})) == [Gap("q", 2, "t", 0, 20, 26)]
    found = ledger.record(progress(3, {"0": 30, "1": 9}, {"0": 40, "1": 9}, rows=4))
    assert [(g.partition, g.lost) for g in found] == [(None, 6)]
    assert ledger.record({"name": "files", "batchId": 0, "sources": [{"startOffset": None, "endOffset": {"logOffset": 3}, "numInputRows": 5}]}) == []
    assert list(ledger.gaps) == told and len(told) == 2


def test_offset_ledger_follows_real_progress(spark, tmp_dir):
    ledger = OffsetLedger()
    spark.streams.addListener(ledger)
    try:
        q = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 5).load().writeStream.format("noop").option("checkpointLocation", tmp_dir).trigger(availableNow=True).start()
        q.awaitTermination(60)
    finally:
        spark.streams.removeListener(ledger)
    assert not ledger.gaps


def test_rescue_keeps_what_types_lose(spark):
    rows = ['{"data_type":"sensor","sensor_id":"s","value":"hot","battery_level":3.5,"extra":{"a":[1]}}', '{"data_type":"sensor","sensor_id":"s","value":1.5,"unit":null}', '{"data_type":"sensor"', None]
    df = spark.createDataFrame([(r,) for r in rows], "json string").withColumn("kafka_timestamp", F.lit("2024-01-01").cast("timestamp"))
    got = [r.rescued for r in rescue.typed_with_rescue(df, "sensor").collect()]
    assert got == [{"value": "hot", "battery_level": "3.5", "extra": '{"a":[1]}'}, {}]


def test_sketches_of_spans(spark):
    rows = [(f"2024-01-0{1 + i % 2} {i % 24:02d}:30", f"u{i % 700}") for i in range(9000)]
    df = spark.createDataFrame(rows, "t string, user_id string").select(F.col("t").cast("timestamp").alias("event_time"), "user_id")
    s = sketches.hourly_user_sketches(df)
    for r in sketches.active_users(s, "day").collect():
        exact = len({u for t, u in rows if t.startswith(str(r.period)[:10])})
        assert abs(r.active_users - exact) <= max(1, sketches.RELATIVE_BOUND * exact) and r.hours == 12
    one = sketches.active_users_between(s, "2024-01-01 00:00:00", "2024-01-01 03:00:00").first()
    assert one.hours == 2 and abs(one.active_users - len({u for t, u in rows if t[:13] in ("2024-01-01 00", "2024-01-01 02")})) <= 20
    assert sketches.active_users_between(s, "2030-01-01", "2030-01-02").first().active_users == 0


def test_recent_tables_read_the_last_dates(spark, tmp_dir):
    messages = [(json.dumps({"data_type": "transaction", "transaction_id": str(i), "device": "d", "status": "success", "transaction_date": f"2024-01-{1 + i:02d}T12:00:00"}), "2024-01-01") for i in range(9)]
    df = spark.createDataFrame(messages, "json string, k string").select("json", F.col("k").cast("timestamp").alias("kafka_timestamp"))
    Pipeline.from_messages(spark, df).materialize(tmp_dir, ("device_stats",), by_date=True)
    recent = RecentTables(spark, tmp_dir, 24).table("device_stats")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters")[1][:200] and "2024-01-08" in plan
    assert [str(r.window_start) for r in recent.collect()] == ["2024-01-09 12:00:00"]
    assert RecentTables(spark, tmp_dir, 25).table("device_stats").count() == 2
    assert not storage.folders(spark, f"{tmp_dir}/none")


def test_bronze_keeps_rescued_fields(spark, tmp_dir):
    from eventlens.operators.bronze import read_kind, write_bronze

    rows = ['{"data_type":"sensor","sensor_id":"s","value":"hot","extra":1}', '{"data_type":"sensor","sensor_id":"t","value":1.5}']
    df = spark.createDataFrame([(r,) for r in rows], "json string").withColumn("kafka_timestamp", F.lit("2024-01-01").cast("timestamp"))
    write_bronze(df, f"{tmp_dir}/b/events", by_date=True, rescued=True)
    got = {r.sensor_id: r.rescued for r in spark.read.parquet(f"{tmp_dir}/b/events").collect()}
    assert got == {"s": {"value": "hot", "extra": "1"}, "t": {}}
    assert read_kind(spark, f"{tmp_dir}/b/events", "sensor", days=("2024-01-01", "2024-01-01")).count() == 2


def test_command_line_with_late_rows_and_merged_raw_tables(spark, tmp_dir, capsys):
    """Two deliveries, the second late: streamed, corrected and read, the
    aggregates of closed windows are those of a batch over all events."""
    from eventlens import app
    from eventlens.operators import aggregates
    from eventlens.operators.bronze import write_bronze

    def message(i, t):
        return json.dumps({"data_type": "transaction", "transaction_id": f"t{i}", "payment_method": "cash", "transaction_amount": 1.0 + i, "transaction_date": t})

    deliveries = [[message(i, f"2024-01-01T{h:02d}:05:00") for i, h in enumerate(range(8, 14))], [message(20, "2024-01-01T08:10:00"), message(21, "2024-01-01T09:40:00"), message(0, "2024-01-01T08:05:00")]]
    every = []
    for n, lines in enumerate(deliveries):
        os.makedirs(f"{tmp_dir}/in", exist_ok=True)
        with open(f"{tmp_dir}/in/{n}.json", "w") as f:
            f.write("\n".join(lines))
        every += lines
        args = ["stream", "--files", f"{tmp_dir}/in", "--out", f"{tmp_dir}/t", "--checkpoints", f"{tmp_dir}/c", "--available-now", "--late", "--merge-raw"]
        assert app.main([*args, "--tables", TABLE, "raw_transactions"]) == 0
    df = spark.createDataFrame([(x,) for x in every[:-1]], "json string").withColumn("kafka_timestamp", F.lit("2024-01-02").cast("timestamp"))
    write_bronze(df, f"{tmp_dir}/b/events", by_date=True)
    assert app.main(["correct", "--tables", f"{tmp_dir}/t", "--bronze", f"{tmp_dir}/b/events", "--name", TABLE]) == 0
    capsys.readouterr()
    tables = Tables(spark, f"{tmp_dir}/t")
    batch = aggregates.build(TABLE, aggregates.prepare(df, "transaction")).where("window_end <= timestamp_ntz'2024-01-01 12:35:00'")
    assert sorted(map(tuple, tables.table(TABLE).collect())) == sorted(map(tuple, batch.collect()))
    assert sorted(r.transaction_id for r in tables.table("raw_transactions").collect()) == sorted(f"t{i}" for i in [*range(6), 20, 21])


def test_user_sketches_are_a_table(spark, tmp_dir):
    df = spark.createDataFrame([(json.dumps({"data_type": "transaction", "transaction_id": str(i), "user_id": f"u{i % 7}", "transaction_date": f"2024-01-0{1 + i % 3}T0{i % 5}:00:00"}), "2024-01-05") for i in range(90)], "json string, k string")
    messages = df.select("json", F.col("k").cast("timestamp").alias("kafka_timestamp"))
    Pipeline.from_messages(spark, messages).materialize(tmp_dir, (sketches.TABLE,), by_date=True)
    days = sketches.active_users(Tables(spark, tmp_dir).table(sketches.TABLE)).collect()
    assert [r.active_users for r in days] == [7, 7, 7]
