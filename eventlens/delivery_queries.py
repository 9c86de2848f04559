"""Named queries over deliveries that go wrong: late rows, batches that fail,
rows delivered again, values of the wrong type; and over what is stored.
Registered with those of ``registry``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contracts import conform
from .operators import aggregates, bronze, parse, rescue, sketches
from .plans import reports
from .plans.pipeline import Pipeline, RecentTables
from .registry import active_users_exact, bronze_dir, query, replay_dir, run_stream_table
from .session import work_dir
from .sources.edge import edge_topic, mistyped_topic
from .sources.files import FILE_ROWS, read_messages
from .sources.messages import stored_topic
from .streaming import late, replay, store
from .streaming.runner import AVAILABLE_NOW, STREAM_TABLES, start_late_query, start_shared_pipeline, start_table_query, supervise
from .streaming.sinks import MergedTableSink, ParquetTableSink

#: Transactions whose id leaves this remainder arrive after all others.
LATE_EVERY, LATE_REMAINDER = 97, 5


def _finish(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _late_run(spark: SparkSession, sf_dir: str, table: str) -> tuple[str, str]:
    """Stream a table over the topic with planted late transactions, in two
    deliveries; returns the folder of the tables and the bronze of all."""
    base = work_dir(spark, "late", unique=True)
    topic, root, days = f"{base}/topic", f"{base}/tables", f"{base}/bronze/events"
    messages = stored_topic(spark, sf_dir)
    eid = F.regexp_extract("json", '"transaction_id":"tx_([0-9]+)"', 1)
    behind = F.when(eid != "", eid.cast("long") % LATE_EVERY == LATE_REMAINDER).otherwise(F.lit(False))
    bronze.write_bronze(messages, days, by_date=True)
    prefix = f"q{uuid.uuid4().hex[:8]}_"
    for number, part in enumerate((~behind, behind)):
        messages.filter(part).write.parquet(f"{topic}/delivery={number}")
        stream = read_messages(spark, f"{topic}/*", "parquet", streaming=True)
        sink = ParquetTableSink(root, table)
        _finish(start_table_query(stream, table, sink, f"{base}/checkpoints", AVAILABLE_NOW, prefix))
        events = aggregates.prepare(stream, aggregates.SPECS[table].kind)
        _finish(start_late_query(events, table, root, f"{base}/checkpoints", AVAILABLE_NOW, through=False, name_prefix=prefix))
    return root, days


@query("late_rows_payment_method_stats")
def late_rows_payment_method_stats(spark, sf_dir):
    """The side output: transactions behind the aggregate's watermark."""
    root, _ = _late_run(spark, sf_dir, "payment_method_stats")
    rows = late.late_rows(spark, root, "payment_method_stats")
    return rows.select("transaction_id", "payment_method", "event_time")


@query("late_corrected_payment_method_stats")
def late_corrected_payment_method_stats(spark, sf_dir):
    """A3 streamed with late rows dropped, and its windows corrected
    from bronze; a second correction finds nothing to do."""
    table = "payment_method_stats"
    root, days = _late_run(spark, sf_dir, table)
    for _ in range(2):
        late.correct(spark, root, table, lambda d: bronze.read_kind(spark, days, aggregates.SPECS[table].kind, days=d))
    return late.corrected(spark, root, table)


class _Broken(ParquetTableSink):
    """Fails in the middle of a batch, after its data."""

    def committed(self, *args) -> None:
        raise OSError("target lost")


def _broken_run(spark: SparkSession, messages: DataFrame, table: str, broken: bool = True) -> str:
    """Stream a raw table whose target fails; returns its folder."""
    base = work_dir(spark, "broken", unique=True)
    messages.write.parquet(f"{base}/topic")
    sink = (_Broken if broken else ParquetTableSink)(f"{base}/tables", table)
    stream = read_messages(spark, f"{base}/topic", "parquet", streaming=True)
    _finish(start_table_query(stream, table, sink, f"{base}/checkpoints", AVAILABLE_NOW, f"q{uuid.uuid4().hex[:8]}_"))
    return f"{base}/tables"


@query("replayed_raw_transactions")
def replayed_raw_transactions(spark, sf_dir):
    """Every batch failed and went to the fallback; replayed twice."""
    table = "raw_transactions"
    root = _broken_run(spark, stored_topic(spark, sf_dir), table)
    for _ in range(2):
        replay.replay(spark, root, table)
    return conform(store.stored(spark, root, table), table)


@query("replayed_quarantine")
def replayed_quarantine(spark, sf_dir):
    """S11/2.7: quarantined raw transactions of the faulty topic, amounts
    capped and times taken from the broker, replayed twice; rows without id
    still do not fit and stay in quarantine."""
    table = "raw_transactions"
    root = _broken_run(spark, edge_topic(spark, sf_dir), table, broken=False)

    def mend(rows: DataFrame) -> DataFrame:
        timed = F.when(F.col("transaction_date").try_cast("timestamp_ntz").isNull(), F.date_format("kafka_timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
        return rows.withColumns({"transaction_amount": F.least("transaction_amount", F.lit(9e9)), "transaction_date": F.coalesce(timed, "transaction_date")})

    for _ in range(2):
        replay.replay(spark, root, table, replay.QUARANTINE, mend)
    rows = store.stored(spark, root, table)
    return rows.select("transaction_id", "transaction_amount", "transaction_date", "kafka_timestamp")


@query("merged_raw_transactions")
def merged_raw_transactions(spark, sf_dir):
    """The raw table merged in three deliveries by the streaming sink, the
    last a day later and of everything; read without grouping."""
    table = "raw_transactions"
    base, topic = work_dir(spark, "merged", unique=True), stored_topic(spark, sf_dir)
    early = F.day("kafka_timestamp") <= 15
    again = topic.select("json", (F.col("kafka_timestamp") + F.expr("INTERVAL 1 DAY")).alias("kafka_timestamp"))
    prefix = f"q{uuid.uuid4().hex[:8]}_"
    for number, part in enumerate((topic.filter(early), topic.filter(~early), again)):
        part.write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{base}/topic/delivery={number}")
        stream = read_messages(spark, f"{base}/topic/*", "parquet", streaming=True)
        _finish(start_table_query(stream, table, MergedTableSink(f"{base}/tables", table), f"{base}/checkpoints", AVAILABLE_NOW, prefix))
    return conform(spark.read.parquet(f"{base}/tables/{table}"), table)


@query("batch_hourly_metrics_mixed")
def batch_hourly_metrics_mixed(spark, sf_dir):
    """A7x in one aggregate over the mixed topic, without a join."""
    return aggregates.hourly_metrics_mixed(aggregates.mixed_from_messages(stored_topic(spark, sf_dir)))


@query("stream_hourly_metrics_ext")
def stream_hourly_metrics_ext(spark, sf_dir):
    """A7x streamed: exact columns, and the user estimate within tolerance."""
    streamed = run_stream_table(spark, sf_dir, "hourly_metrics_ext")
    exact = active_users_exact(spark, sf_dir).withColumnRenamed("active_users", "exact_users")
    within = F.abs(F.col("active_users") - F.col("exact_users")) <= F.greatest(F.lit(1.0), F.col("exact_users") * 0.15)
    return streamed.join(exact, on="hour", how="left").select(
        "hour", "total_transactions", "total_amount", "avg_transaction_amount", "anomaly_count", F.coalesce(within, F.lit(False)).alias("active_users_within_tolerance")
    )


@query("stream_shared_tables")
def stream_shared_tables(spark, sf_dir):
    """All tables by the shared queries: rows and, where the table has
    one, total of what each wrote."""
    base, prefix = work_dir(spark, "shared", unique=True), f"q{uuid.uuid4().hex[:8]}_"
    messages = read_messages(spark, replay_dir(spark, sf_dir, "parquet"), "parquet", streaming=True)
    supervise(spark, start_shared_pipeline(messages, f"{base}/tables", f"{base}/checkpoints", trigger=AVAILABLE_NOW, name_prefix=prefix))
    totals = {"transaction_hourly_stats": "total_amount", "top_users": "total_spent", "payment_method_stats": "total_amount", "hourly_metrics": "total_amount", "raw_transactions": "transaction_amount"}
    parts = []
    for t in STREAM_TABLES + tuple(parse.RAW):
        total = F.sum(totals[t]) if t in totals else F.lit(None)
        parts.append(store.stored(spark, f"{base}/tables", t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), total.cast("decimal(30,2)").alias("total")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("users_by_day_from_sketches")
def users_by_day_from_sketches(spark, sf_dir):
    """Daily users as the union of stored hourly sketches, against the
    exact count: within the stated bound."""
    transactions = Pipeline.from_bronze(spark, bronze_dir(spark, sf_dir)).events("transaction")
    path = work_dir(spark, "sketches", unique=True)
    sketches.hourly_user_sketches(transactions).write.parquet(path)
    days = sketches.active_users(spark.read.parquet(path), "day")
    exact = transactions.groupBy(F.date_trunc("day", "event_time").cast("timestamp_ntz").alias("period")).agg(F.count_distinct("user_id").alias("exact_users"))
    bound = F.greatest(F.lit(1.0), F.col("exact_users") * sketches.RELATIVE_BOUND)
    return days.join(exact, "period").select("period", "hours", "exact_users", (F.abs(F.col("active_users") - F.col("exact_users")) <= bound).alias("within_bound"))


@query("rescued_transaction_fields")
def rescued_transaction_fields(spark, sf_dir):
    """2.7: wrong-typed and undeclared fields of the faulty topic, as they came."""
    return rescue.rescued_fields(mistyped_topic(spark, sf_dir), "transaction", "transaction_id")


@query("parse_transactions_mistyped")
def parse_transactions_mistyped(spark, sf_dir):
    """P3 beside the rescue: the typed columns are those of the plain parse."""
    typed = rescue.typed_with_rescue(mistyped_topic(spark, sf_dir), "transaction")
    return typed.select("transaction_id", "user_age", "transaction_amount", "payment_method", F.size(rescue.RESCUED).alias("n_rescued"))


@query("range_last_24h_stored")
def range_last_24h_stored(spark, sf_dir):
    """K4 over date-partitioned tables: only the last dates are read."""
    root = work_dir(spark, "recent", unique=True)
    Pipeline.from_bronze(spark, bronze_dir(spark, sf_dir)).materialize(root, ("device_stats",), by_date=True)
    return reports.rpt_success_over_time(RecentTables(spark, root, 24))


