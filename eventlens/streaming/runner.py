"""Running the pipeline as Structured Streaming queries.

Every query is named and has its own checkpoint folder below one root, so
a restart resumes from its committed offsets and state instead of
re-reading the topic (F1).  Queries run under one supervisor that waits
for *any* termination and stops the rest on failure (S16, F8).
"""

from __future__ import annotations

import logging
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import aggregates, bronze, dedup, parse, sketches
from ..schemas import BY_TYPE
from ..session import large_state
from .late import LateRows, LateRowsOfKind
from .sinks import ParquetTableSink, SharedSink

log = logging.getLogger(__name__)

STREAM_TABLES = (
    "transaction_hourly_stats",
    "top_users",
    "payment_method_stats",
    "device_stats",
    "activity_stats",
    "sensor_anomalies",
    "sensor_anomalies_ext",
    "hourly_metrics",
)


@dataclass(frozen=True)
class Trigger:
    """processing_time like "30 seconds" (the reference) or available_now
    for replay and tests (S7)."""

    processing_time: str | None = "30 seconds"
    available_now: bool = False

    def apply(self, writer):
        if self.available_now:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.processing_time)


AVAILABLE_NOW = Trigger(processing_time=None, available_now=True)


REJECTED_TABLE = "rejected_messages"
#: hourly metrics with the anomaly count of the sensors (opt-in)
EXTENDED_TABLE = "hourly_metrics_ext"


def table_stream(messages: DataFrame, table: str, dedup_within: str | None = None) -> DataFrame:
    """Streaming DataFrame for one result table, from JSON messages.  Aggregates
    keep their full width: the sink casts and quarantines what does not fit.
    Raw tables are stateless; ``dedup_within`` opts into streaming dedup.
    ``rejected_messages`` (opt-in) keeps messages no route takes: malformed
    JSON, missing or unknown kind, with their raw text."""
    if table == REJECTED_TABLE:
        return parse.rejected(parse.parsed(messages))
    if table == EXTENDED_TABLE:
        return aggregates.hourly_metrics_mixed(aggregates.mixed_from_messages(messages), conform_output=False)
    if table == sketches.TABLE:
        return sketches.hourly_user_sketches(aggregates.prepare(messages, "transaction"))
    if table in aggregates.SPECS:
        spec = aggregates.SPECS[table]
        return aggregates.build(spec, aggregates.prepare(messages, spec.kind), conform_output=False)
    if table in parse.RAW:
        raw = parse.raw_from_messages(messages, table)
        return dedup.first_delivery(raw, table, dedup_within) if dedup_within else raw
    raise KeyError(table)


def table_stream_from_events(events_of, table: str, dedup_within: str | None = None) -> DataFrame:
    """Streaming DataFrame for one result table, from typed events
    (``events_of(kind)``, e.g. the bronze stream)."""
    if table == EXTENDED_TABLE:
        rows = aggregates.mixed_from_events(events_of("transaction"), events_of("sensor"))
        return aggregates.hourly_metrics_mixed(rows, conform_output=False)
    if table == sketches.TABLE:
        return sketches.hourly_user_sketches(events_of("transaction"))
    if table in aggregates.SPECS:
        spec = aggregates.SPECS[table]
        return aggregates.build(spec, events_of(spec.kind), conform_output=False)
    if table in parse.RAW:
        raw = parse.RAW[table](events_of(parse.RAW_KIND[table]))
        return dedup.first_delivery(raw, table, dedup_within) if dedup_within else raw
    raise KeyError(table)


def start_table_query(
    messages: DataFrame,
    table: str,
    sink,
    checkpoint_root: str,
    trigger: Trigger = Trigger(),
    name_prefix: str = "",
    prepared: DataFrame | None = None,
) -> StreamingQuery:
    """One named append-mode query feeding ``sink`` through foreachBatch.
    ``prepared``: the table's streaming DataFrame when already built (e.g.
    from bronze); otherwise it is built from ``messages``."""
    name = f"{name_prefix}{table}"
    spark = (prepared if prepared is not None else messages).sparkSession
    # with the FAIR scheduler each query has a pool, so a long batch of one
    # does not hold up the others
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
    df = prepared if prepared is not None else table_stream(messages, table)
    writer = (
        df.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}")
        .foreachBatch(sink)
    )
    try:
        return trigger.apply(writer).start()
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def start_late_query(
    events: DataFrame,
    table: str,
    root: str,
    checkpoint_root: str,
    trigger: Trigger = Trigger(),
    through: bool = True,
    name_prefix: str = "",
) -> StreamingQuery:
    """The late-row side output of one aggregate, over its typed events."""
    name = f"{name_prefix}late_{table}"
    writer = (
        events.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}")
        .foreachBatch(LateRows(root, table, through))
    )
    return trigger.apply(writer).start()


def start_late_pipeline(
    events_of,
    root: str,
    checkpoint_root: str,
    tables=STREAM_TABLES,
    trigger: Trigger = Trigger(),
    through: bool = True,
    name_prefix: str = "",
) -> list[StreamingQuery]:
    """Late rows of all aggregates, one query per kind over ``events_of(kind)``."""
    queries, kinds = [], {}
    for t in tables:
        if t in aggregates.SPECS:
            kinds.setdefault(aggregates.SPECS[t].kind, []).append(t)
    try:
        for kind, names in kinds.items():
            name = f"{name_prefix}late_{kind}"
            handler = LateRowsOfKind(tuple(LateRows(root, t, through) for t in names))
            writer = events_of(kind).writeStream.queryName(name).outputMode("append").option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}")
            queries.append(trigger.apply(writer.foreachBatch(handler)).start())
    except Exception:
        for q in queries:
            q.stop()
        raise
    return queries


def start_pipeline_via_bronze(
    messages: DataFrame,
    bronze_path: str,
    out_root: str,
    checkpoint_root: str,
    tables=STREAM_TABLES + tuple(parse.RAW),
    trigger: Trigger = Trigger(),
    fallback_root: str | None = None,
    quarantine_root: str | None = None,
    max_files_per_trigger: int | None = None,
    sink_of=None,
) -> list[StreamingQuery]:
    """one query parses each message once into bronze (parquet by
    kind, exactly-once file sink); each table query streams its kind's
    partition and columns from bronze.  With ``availableNow`` bronze is
    run to completion first, so the table queries see all of it."""
    spark = messages.sparkSession
    ckpt = checkpoint_root.rstrip("/")
    q_bronze = bronze.start_bronze_stream(messages, bronze_path, f"{ckpt}/bronze", trigger)
    if trigger.available_now:
        supervise(spark, [q_bronze])
    queries = [] if trigger.available_now else [q_bronze]
    try:
        for t in tables:
            df = table_stream_from_events(
                lambda kind: bronze.read_kind(
                    spark, bronze_path, kind, streaming=True, max_files_per_trigger=max_files_per_trigger
                ),
                t,
            )
            sink = sink_of(t) if sink_of else ParquetTableSink(out_root, t, fallback_root, quarantine_root)
            queries.append(start_table_query(None, t, sink, checkpoint_root, trigger, prepared=df))
    except Exception:
        for q in queries:
            q.stop()
        raise
    return queries


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows the query dropped, summed over its recent progress."""
    total = 0
    for p in query.recentProgress:
        d = p if isinstance(p, dict) else __import__("json").loads(p.json)
        total += sum(op.get("numRowsDroppedByWatermark", 0) for op in d.get("stateOperators", []))
    return total


def start_pipeline(
    messages: DataFrame,
    out_root: str,
    checkpoint_root: str,
    tables=STREAM_TABLES + tuple(parse.RAW),
    trigger: Trigger = Trigger(),
    fallback_root: str | None = None,
    quarantine_root: str | None = None,
    sink_of=None,
) -> list[StreamingQuery]:
    """One query per table, each parsing the topic itself.  ``sink_of(table)``
    chooses another sink than the parquet table below ``out_root``."""
    queries = []
    try:
        for t in tables:
            sink = sink_of(t) if sink_of else ParquetTableSink(out_root, t, fallback_root, quarantine_root)
            queries.append(start_table_query(messages, t, sink, checkpoint_root, trigger))
    except Exception:
        for q in queries:
            q.stop()
        raise
    return queries


def start_shared_pipeline(
    messages: DataFrame,
    out_root: str,
    checkpoint_root: str,
    tables=STREAM_TABLES + tuple(parse.RAW),
    trigger: Trigger = Trigger(),
    fallback_root: str | None = None,
    quarantine_root: str | None = None,
    sink_of=None,
    name_prefix: str = "",
) -> list[StreamingQuery]:
    """The same tables with fewer scans of the topic: aggregates of one kind
    and window share a stateful query, and the raw tables one stateless query
    that parses each message once.  Closing rules are those of the single
    queries, as tables of different windows, and so delays, do not share."""
    spark, queries = messages.sparkSession, []
    scratch = f"{out_root.rstrip('/')}/_staging"

    def sink(t):
        return sink_of(t) if sink_of else ParquetTableSink(out_root, t, fallback_root, quarantine_root)

    def start(name: str, df: DataFrame, handler) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            writer = df.writeStream.queryName(name).outputMode("append").option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}")
            queries.append(trigger.apply(writer.foreachBatch(handler)).start())
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    def raw_rows(table: str):
        kind = parse.RAW_KIND[table]
        fields = [f.name for f in BY_TYPE[kind].fields]
        return lambda batch: parse.RAW[table](batch.filter(F.col(bronze.PARTITION) == kind).select(*fields, "kafka_timestamp"))

    try:
        with large_state(spark, checkpoint_root) if trigger.available_now else nullcontext():
            for group in aggregates.shared_groups([t for t in tables if t in aggregates.SPECS]):
                if len(group) == 1:
                    queries.append(start_table_query(messages, group[0], sink(group[0]), checkpoint_root, trigger, name_prefix))
                    continue
                df = aggregates.build_shared(group, aggregates.prepare(messages, aggregates.SPECS[group[0]].kind))
                split = {t: (lambda batch, t=t, group=group: aggregates.split_shared(group, batch, t)) for t in group}
                start(f"{name_prefix}{'+'.join(group)}", df, SharedSink(split, {t: sink(t) for t in group}, scratch))
            raws = [t for t in tables if t in parse.RAW]
            if raws:
                rows = bronze.bronze_rows(messages).drop("event_time", "rejected_json")  # no raw table has them
                start(f"{name_prefix}{'+'.join(raws)}", rows, SharedSink({t: raw_rows(t) for t in raws}, {t: sink(t) for t in raws}, scratch, bronze.PARTITION))
            for t in tables:
                if t not in aggregates.SPECS and t not in parse.RAW:
                    queries.append(start_table_query(messages, t, sink(t), checkpoint_root, trigger, name_prefix))
    except Exception:
        for q in queries:
            q.stop()
        raise
    return queries


def supervise(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until any query ends.  A failure stops all queries and is
    raised naming the failed query; with ``availableNow`` every query ends
    on its own and the call returns when all have."""
    from pyspark.errors import StreamingQueryException

    def failed() -> None:
        for q in queries:
            if not q.isActive and q.exception() is not None:
                raise RuntimeError(f"query {q.name} failed: {q.exception()}")

    import time

    deadline = None if timeout is None else time.monotonic() + timeout
    # awaitAnyTermination is session-wide; only our queries' states count,
    # read through isActive/exception(), so earlier terminations are cleared.
    spark.streams.resetTerminated()
    try:
        while any(q.isActive for q in queries):
            if deadline is not None and time.monotonic() >= deadline:
                return
            try:
                # Poll: a query ending between two waits is seen by isActive.
                spark.streams.awaitAnyTermination(1.0)
            except StreamingQueryException:
                pass  # another query of the session failed; ours are checked next
            failed()
            spark.streams.resetTerminated()
        failed()
    except BaseException:
        for q in queries:
            if q.isActive:
                q.stop()
        raise


try:
    from pyspark.sql.streaming import StreamingQueryListener
except ImportError:  # pragma: no cover
    StreamingQueryListener = object  # type: ignore[assignment,misc]


class ProgressLog(StreamingQueryListener):
    """Per-query running totals from query progress (W3, S10): input rows,
    rows dropped as later than the watermark, and the last batch id.  It
    reads the progress events Spark already produces, so no extra job runs;
    memory is one entry per query."""

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark listener API
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        name = p.name or str(p.id)
        t = self.totals.setdefault(name, {"input_rows": 0, "dropped_by_watermark": 0, "batch_id": -1})
        t["input_rows"] += int(p.numInputRows)
        t["dropped_by_watermark"] += sum(int(op.numRowsDroppedByWatermark) for op in p.stateOperators)
        t["batch_id"] = int(p.batchId)
        log.info("query %s batch %s: %s rows in, %s late rows dropped", name, p.batchId,
                 p.numInputRows, t["dropped_by_watermark"])

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def attach(self, spark: SparkSession) -> "ProgressLog":
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)
