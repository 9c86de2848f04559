"""Recomputing days and landing days again: nothing stale, nothing lost."""

import json
import os

import pytest
from pyspark.sql import functions as F

from eventlens import storage
from eventlens.operators.bronze import write_bronze
from eventlens.plans.pipeline import Pipeline


def messages(spark, rows):
    """(id, event time, amount, broker time) -> transactions as messages."""
    out = [
        (json.dumps({"data_type": "transaction", "transaction_id": i, "user_id": "u", "transaction_date": t, "transaction_amount": a}), k)
        for i, t, a, k in rows
    ]
    return spark.createDataFrame(out, "json string, k string").select("json", F.col("k").cast("timestamp").alias("kafka_timestamp"))


def ids(spark, path):
    if not storage.folders(spark, path):
        return {}
    return {r.transaction_id: str(r.event_date) for r in spark.read.parquet(path).collect()}


ROWS = [
    ("t1", "2024-01-01T10:00:00", 5.0, "2024-01-01 10:00:01"),
    ("t2", "2024-01-01T11:00:00", 1e15, "2024-01-01 11:00:01"),
    ("t3", "2024-01-02T10:00:00", 5.0, "2024-01-02 10:00:01"),
    ("t4", "2024-01-02T11:00:00", 1e15, "2024-01-02 11:00:01"),
    ("t5", "junk", 5.0, "2024-01-02 12:00:00"),
]


def test_other_days_keep_their_quarantine_and_untimed_rows_have_a_place(spark, tmp_dir):
    bronze, root = f"{tmp_dir}/b/events", f"{tmp_dir}/t"
    write_bronze(messages(spark, ROWS), bronze, by_date=True)
    for day in ("2024-01-01", "2024-01-02"):
        Pipeline.from_bronze(spark, bronze, days=(day, day)).materialize(root, ("raw_transactions",), by_date=True)
    assert ids(spark, f"{root}/raw_transactions") == {"t1": "2024-01-01", "t3": "2024-01-02"}
    assert ids(spark, f"{root}/_quarantine/raw_transactions") == {"t2": "2024-01-01", "t4": "2024-01-02", "t5": "2024-01-02"}


def test_mended_rows_leave_the_quarantine_and_empty_dates_the_table(spark, tmp_dir):
    bronze, root = f"{tmp_dir}/b/events", f"{tmp_dir}/t"
    write_bronze(messages(spark, ROWS), bronze, by_date=True)
    Pipeline.from_bronze(spark, bronze).materialize(root, ("raw_transactions",), by_date=True)
    # the landing of the 2nd again: t3 belongs to the 1st, t4's amount is mended
    again = [("t3", "2024-01-01T23:00:00", 5.0, "2024-01-02 10:00:01"), ("t4", "2024-01-01T23:30:00", 7.0, "2024-01-02 12:00:00")]
    write_bronze(messages(spark, again), bronze, by_date=True)
    Pipeline.from_bronze(spark, bronze, days=("2024-01-01", "2024-01-02")).materialize(root, ("raw_transactions",), by_date=True)
    assert ids(spark, f"{root}/raw_transactions") == {"t1": "2024-01-01", "t3": "2024-01-01", "t4": "2024-01-01"}
    assert ids(spark, f"{root}/_quarantine/raw_transactions") == {"t2": "2024-01-01"}
    assert not os.path.exists(f"{root}/raw_transactions/event_date=2024-01-02")


def test_a_corrected_landing_replaces_all_it_landed(spark, tmp_dir):
    bronze = f"{tmp_dir}/b/events"
    write_bronze(messages(spark, ROWS[:2]), bronze, by_date=True)
    write_bronze(messages(spark, [("t1", "2024-01-02T10:00:00", 5.0, "2024-01-01 10:00:01"), ROWS[1]]), bronze, by_date=True)
    got = {r.transaction_id: str(r.event_date) for r in spark.read.parquet(bronze).collect()}
    assert got == {"t1": "2024-01-02", "t2": "2024-01-01"}


def test_part_of_a_landed_day_is_refused(spark, tmp_dir):
    bronze = f"{tmp_dir}/b/events"
    write_bronze(messages(spark, ROWS), bronze, by_date=True)
    with pytest.raises(ValueError, match="2024-01-02"):
        write_bronze(messages(spark, ROWS[2:3]), bronze, by_date=True)
    assert spark.read.parquet(bronze).count() == 5
    write_bronze(messages(spark, ROWS[2:3]), bronze, by_date=True, partial=True)
    assert spark.read.parquet(bronze).count() == 3
    assert storage.folders(spark, f"{tmp_dir}/b/_staging") == []


def test_full_runs_clear_an_old_quarantine(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    Pipeline.from_messages(spark, messages(spark, ROWS)).materialize(root, ("raw_transactions",))
    assert spark.read.parquet(f"{root}/_quarantine/raw_transactions").count() == 3
    Pipeline.from_messages(spark, messages(spark, ROWS[:1])).materialize(root, ("raw_transactions",))
    assert not os.path.exists(f"{root}/_quarantine/raw_transactions")
