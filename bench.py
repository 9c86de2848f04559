"""Benchmark the headline work at one scale factor and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_EVENT_LOG_DIR (optional: write Spark's event log there).  Stages, each timed separately:

  (setup)         the fixture topic stored once as messages (json, kafka_timestamp)
  bronze          stored topic (JSON text) -> parse once -> typed parquet by kind
  tables          bronze -> all result tables written as parquet
  reports         all dashboard reports over the written tables
  flagship_json   amount-by-city end to end from the JSON-lines topic files (no bronze)
  stream          every result table as a named append-mode streaming query
                  over the JSON-lines replay of the topic (availableNow)
  stream_via_bronze  the same tables, with one query parsing the topic once
                  into a bronze stream that feeds the table queries
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from eventlens.operators.bronze import write_bronze
    from eventlens.plans import reports
    from eventlens.plans.pipeline import ALL_TABLES, Pipeline, Tables
    from eventlens.registry import QUERIES
    from eventlens.session import build_session, work_dir
    from eventlens.sources.files import read_messages, write_messages
    from eventlens.sources.messages import stored_topic, stored_topic_dir
    from eventlens.streaming.runner import AVAILABLE_NOW, start_pipeline, start_pipeline_via_bronze, supervise

    conf = {}
    event_log = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_log:  # stage and task times, read from the log afterwards (no UI)
        os.makedirs(event_log, exist_ok=True)
        conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log}
    spark = build_session(f"local[{cpus}]", app_name="eventlens-bench", shuffle_partitions=cpus, conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    run = work_dir(spark, "bench", unique=True)
    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return out

    messages = spark.read.parquet(f"{sf_dir}/events.parquet").count() * 3

    # warm-up: JVM class loading and codegen caches, excluded from timings
    QUERIES["rpt_amount_by_city"](spark, sf_dir).collect()

    # setup, untimed: the topic as stored messages, as a broker or landing
    # folder would hold them (derived by Spark from the driver's tables)
    stored_topic_dir(spark, sf_dir)
    bronze = f"{run}/bronze"
    timed("bronze", lambda: write_bronze(stored_topic(spark, sf_dir), bronze))
    tables_root = f"{run}/tables"
    names = ALL_TABLES + ("hourly_metrics_ext",)
    timed("tables", lambda: Pipeline.from_bronze(spark, bronze).materialize(tables_root, names))
    stored = Tables(spark, tables_root)
    timed("reports", lambda: reports.refresh(stored, f"{run}/panels", concurrent_jobs=cpus))
    replay = f"{run}/replay"
    write_messages(stored_topic(spark, sf_dir), replay, "text")
    timed(
        "flagship_json",
        lambda: reports.rpt_amount_by_city(
            Pipeline.from_messages(spark, read_messages(spark, replay, "text"))
        ).collect(),
    )

    def stream():
        src = read_messages(spark, replay, "text", streaming=True)
        qs = start_pipeline(src, f"{run}/stream_tables", f"{run}/checkpoints", trigger=AVAILABLE_NOW)
        supervise(spark, qs)

    timed("stream", stream)

    def stream_bronze():
        src = read_messages(spark, replay, "text", streaming=True)
        qs = start_pipeline_via_bronze(
            src, f"{run}/stream_bronze", f"{run}/stream_tables_b", f"{run}/checkpoints_b", trigger=AVAILABLE_NOW
        )
        supervise(spark, qs)

    timed("stream_via_bronze", stream_bronze)

    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "pipeline_total_sec",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                "messages": messages,
                "batch_messages_per_sec": round(messages / (timings["bronze"] + timings["tables"]), 1),
                "stream_messages_per_sec": round(messages / min(timings["stream"], timings["stream_via_bronze"]), 1),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
