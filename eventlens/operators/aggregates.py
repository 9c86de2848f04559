"""Event-time tumbling-window aggregates (A1-A7, A6x, A7x).

An aggregate is a small declarative spec.  ``build`` turns a spec and a
typed event DataFrame into the result table, for batch or streaming input:
on a stream it adds the watermark (delay = window, as the reference) and is
run in append mode, so a window is emitted once, after
``window_end <= max(event_time) - delay``.

Plan shape: parse -> project -> partial aggregate -> shuffle on
(window, keys) -> final aggregate.  Partial aggregation combines rows of a
hot key before the shuffle, so one key holding a third of all rows
shuffles one partial row per input partition, not a third of the data.

Money is summed as DECIMAL(12,2) and averages are decimal averages, so
results do not depend on row order; a bad or overflowing amount becomes
NULL (``try_cast``) and is skipped by the aggregates like SQL NULLs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import conform
from ..functions.lookups import ANOMALY_STATUSES
from ..functions.time import parse_event_time, to_wall_clock
from ..schemas import EVENT_TIME_FIELD, UNION
from .parse import typed, with_event_time

AggFn = Callable[[bool], Column]  # streaming flag -> aggregate column


@dataclass(frozen=True)
class AggSpec:
    name: str  # result table (contract) name
    kind: str  # transaction | activity | sensor
    window: str
    keys: tuple[tuple[str, str], ...]  # (source column, output name)
    aggs: tuple[tuple[str, AggFn], ...]
    pre_filter: Callable[[], Column] | None = None
    window_output: tuple[str, ...] = ("window_start", "window_end")
    constants: tuple[tuple[str, object], ...] = field(default=())

    @property
    def delay(self) -> str:
        return self.window


def _amount() -> Column:
    return F.col("transaction_amount").try_cast("decimal(12,2)")


def _count(_s: bool) -> Column:
    return F.count(F.lit(1))


def _sum_amount(_s: bool) -> Column:
    return F.sum(_amount())


def _avg_amount(_s: bool) -> Column:
    return F.avg(_amount())


def _min_amount(_s: bool) -> Column:
    return F.min(_amount())


def _max_amount(_s: bool) -> Column:
    return F.max(_amount())


def _success_rate(_s: bool) -> Column:
    return F.sum(F.when(F.col("status") == "success", 1).otherwise(0)) / F.count(F.lit(1)) * 100


def _avg_session(_s: bool) -> Column:
    return F.avg(F.col("session_duration").cast("decimal(10,0)"))


def _avg_value(_s: bool) -> Column:
    # the full value, as the deviation uses; only the result is cut to the
    # contract's places.  Decimals add up alike in any row order.
    return F.avg(F.col("value").try_cast("decimal(30,9)"))


def _std_value(_s: bool) -> Column:
    return F.stddev_samp("value")


def _avg_signal(_s: bool) -> Column:
    return F.avg(F.col("signal_strength").cast("decimal(10,0)"))


def _avg_battery(_s: bool) -> Column:
    return F.avg(F.col("battery_level").cast("decimal(10,0)"))


def _active_users(streaming: bool) -> Column:
    # Exact distinct is not supported on streams; HyperLogLog++ there.
    if streaming:
        return F.approx_count_distinct("user_id")
    return F.count_distinct("user_id")


def _anomalous() -> Column:
    return F.col("status").isin(*ANOMALY_STATUSES)


SENSOR_KEYS = (
    ("sensor_id", "sensor_id"),
    ("sensor_type", "sensor_type"),
    ("sensor_location", "sensor_location"),
    ("status", "status"),
)
SENSOR_AGGS = (
    ("reading_count", _count),
    ("avg_value", _avg_value),
    ("std_value", _std_value),
)

SPECS: dict[str, AggSpec] = {
    s.name: s
    for s in [
        AggSpec(
            "transaction_hourly_stats",
            "transaction",
            "1 hour",
            keys=(("user_city", "user_city"), ("transaction_category", "transaction_category")),
            aggs=(
                ("transaction_count", _count),
                ("total_amount", _sum_amount),
                ("avg_amount", _avg_amount),
                ("min_amount", _min_amount),
                ("max_amount", _max_amount),
            ),
        ),
        AggSpec(
            "top_users",
            "transaction",
            "1 hour",
            keys=(("user_id", "user_id"), ("user_name", "user_name"), ("user_city", "user_city")),
            aggs=(("total_spent", _sum_amount), ("transaction_count", _count)),
        ),
        AggSpec(
            "payment_method_stats",
            "transaction",
            "30 minutes",
            keys=(("payment_method", "payment_method"),),
            aggs=(
                ("transaction_count", _count),
                ("total_amount", _sum_amount),
                ("avg_amount", _avg_amount),
            ),
        ),
        AggSpec(
            "device_stats",
            "transaction",
            "30 minutes",
            keys=(("device", "device_type"),),
            aggs=(("transaction_count", _count), ("success_rate", _success_rate)),
        ),
        AggSpec(
            "activity_stats",
            "activity",
            "30 minutes",
            keys=(("activity_type", "activity_type"), ("location.city", "city")),
            aggs=(("activity_count", _count), ("avg_session_duration", _avg_session)),
        ),
        # The status filter is written before the aggregate: it decides which
        # readings advance the watermark (only anomalous ones do).
        AggSpec(
            "sensor_anomalies",
            "sensor",
            "10 minutes",
            keys=SENSOR_KEYS,
            aggs=SENSOR_AGGS,
            pre_filter=_anomalous,
        ),
        AggSpec(
            "sensor_anomalies_ext",
            "sensor",
            "10 minutes",
            keys=SENSOR_KEYS,
            aggs=SENSOR_AGGS
            + (("signal_strength", _avg_signal), ("battery_level", _avg_battery)),
            pre_filter=_anomalous,
        ),
        AggSpec(
            "hourly_metrics",
            "transaction",
            "1 hour",
            keys=(),
            aggs=(
                ("total_transactions", _count),
                ("total_amount", _sum_amount),
                ("avg_transaction_amount", _avg_amount),
                ("active_users", _active_users),
            ),
            window_output=("hour",),
            constants=(("anomaly_count", 0),),
        ),
    ]
}


def prepare(messages: DataFrame, kind: str) -> DataFrame:
    """Typed events of one kind with a parsed ``event_time``."""
    return with_event_time(typed(messages, kind, with_kafka_time=True), kind)


def build(spec: AggSpec | str, events: DataFrame, conform_output: bool = True) -> DataFrame:
    """Spec + typed events (with ``event_time``) -> result table."""
    spec = SPECS[spec] if isinstance(spec, str) else spec
    streaming = events.isStreaming
    df = events
    if spec.pre_filter is not None:
        df = df.filter(spec.pre_filter())
    if streaming:
        df = df.withWatermark("event_time", spec.delay)
    groups = [F.window("event_time", spec.window).alias("window")]
    groups += [F.col(src).alias(out) for src, out in spec.keys]
    agg = df.groupBy(*groups).agg(*[fn(streaming).alias(name) for name, fn in spec.aggs])
    if spec.window_output == ("hour",):
        win = [to_wall_clock(F.col("window.start")).alias("hour")]
    else:
        win = [
            to_wall_clock(F.col("window.start")).alias("window_start"),
            to_wall_clock(F.col("window.end")).alias("window_end"),
        ]
    out = agg.select(
        *win,
        *[F.col(out) for _, out in spec.keys],
        *[F.col(name) for name, _ in spec.aggs],
        *[F.lit(v).alias(n) for n, v in spec.constants],
    )
    return conform(out, spec.name) if conform_output else out


def from_messages(spec: AggSpec | str, messages: DataFrame) -> DataFrame:
    spec = SPECS[spec] if isinstance(spec, str) else spec
    return build(spec, prepare(messages, spec.kind))


def hourly_anomaly_counts(sensors: DataFrame) -> DataFrame:
    """Anomalous sensor readings per event-time hour (typed sensor events)."""
    s = sensors.filter(_anomalous())
    return s.groupBy(F.window("event_time", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("anomalies")
    ).select(to_wall_clock(F.col("w.start")).alias("hour"), "anomalies")


def hourly_metrics_ext(transactions: DataFrame, sensors: DataFrame, conform_output: bool = True) -> DataFrame:
    """A7x (batch): hourly metrics with the real anomaly count, left-joined
    on ``hour``; both sides are one row per hour, so the join input is
    bounded by the number of hours, not by the number of events."""
    base = build("hourly_metrics", transactions, conform_output=False).drop("anomaly_count")
    anomalies = hourly_anomaly_counts(sensors)
    joined = base.join(anomalies, on="hour", how="left").withColumn(
        "anomaly_count", F.coalesce(F.col("anomalies"), F.lit(0))
    )
    return conform(joined, "hourly_metrics") if conform_output else joined.drop("anomalies")


def shared_groups(names) -> list[tuple[str, ...]]:
    """Specs that one stateful query can compute: same kind, window, delay and
    filter.  Sketch buffers would be kept for every group of the others, so a
    spec with one stays alone."""
    groups: dict[tuple, list[str]] = {}
    for n in names:
        s = SPECS[n]
        alone = n if any(fn is _active_users for _, fn in s.aggs) else None
        groups.setdefault((s.kind, s.window, s.delay, s.pre_filter, alone), []).append(n)
    return [tuple(g) for g in groups.values()]


def _grouping_sets(specs) -> list[tuple]:
    sets: list[tuple] = []
    for s in specs:
        if (keys := tuple(src for src, _ in s.keys)) not in sets:
            sets.append(keys)
    return sets


def build_shared(names, events: DataFrame) -> DataFrame:
    """Several aggregates of one kind and window in one pass: every event is
    expanded to one row per distinct set of grouping columns (at most one per
    spec), and one aggregate computes each function of any spec once.
    ``split_shared`` takes a table out of the result."""
    specs = [SPECS[n] for n in names]
    sets, streaming = _grouping_sets(specs), events.isStreaming
    functions = list(dict.fromkeys(fn for s in specs for _, fn in s.aggs))
    df = events if specs[0].pre_filter is None else events.filter(specs[0].pre_filter())
    if streaming:
        df = df.withWatermark("event_time", specs[0].delay)
    width = max(len(k) for k in sets)
    members = [
        F.struct(F.lit(i).alias("_set"), *[(F.col(keys[j]) if j < len(keys) else F.lit(None)).cast("string").alias(f"_k{j}") for j in range(width)])
        for i, keys in enumerate(sets)
    ]
    df = df.withColumn("_member", F.explode(F.array(*members)))
    groups = [F.window("event_time", specs[0].window).alias("window"), F.col("_member._set").alias("_set")]
    groups += [F.col(f"_member._k{j}").alias(f"_k{j}") for j in range(width)]
    return df.groupBy(*groups).agg(*[fn(streaming).alias(f"_a{i}") for i, fn in enumerate(functions)])


def split_shared(names, shared: DataFrame, name: str) -> DataFrame:
    """One table of ``build_shared``, before the contract's casts."""
    specs, spec = [SPECS[n] for n in names], SPECS[name]
    functions = list(dict.fromkeys(fn for s in specs for _, fn in s.aggs))
    number = _grouping_sets(specs).index(tuple(src for src, _ in spec.keys))
    start, end = to_wall_clock(F.col("window.start")), to_wall_clock(F.col("window.end"))
    win = [start.alias("hour")] if spec.window_output == ("hour",) else [start.alias("window_start"), end.alias("window_end")]
    return shared.filter(F.col("_set") == number).select(
        *win,
        *[F.col(f"_k{j}").alias(out) for j, (_, out) in enumerate(spec.keys)],
        *[F.col(f"_a{functions.index(fn)}").alias(out) for out, fn in spec.aggs],
        *[F.lit(v).alias(n) for n, v in spec.constants],
    )


def mixed_from_messages(messages: DataFrame) -> DataFrame:
    """Rows of both kinds that hourly metrics count, from one parse of the
    mixed topic: transactions, and anomalous sensor readings."""
    data = messages.select(F.inline(F.array(F.from_json("json", UNION))))
    tx = F.col("data_type") == "transaction"
    rows = data.filter(tx | (F.col("data_type") == "sensor") & _anomalous())
    text = F.when(tx, F.col(EVENT_TIME_FIELD["transaction"])).otherwise(F.col(EVENT_TIME_FIELD["sensor"]))
    return rows.select("data_type", parse_event_time(text).alias("event_time"), "user_id", "transaction_amount")


def mixed_from_events(transactions: DataFrame, sensors: DataFrame) -> DataFrame:
    """The same rows from typed events, such as those of bronze."""
    nothing = [F.lit(None).cast("string").alias("user_id"), F.lit(None).cast("double").alias("transaction_amount")]
    return transactions.select(F.lit("transaction").alias("data_type"), "event_time", "user_id", "transaction_amount").unionByName(
        sensors.filter(_anomalous()).select(F.lit("sensor").alias("data_type"), "event_time", *nothing)
    )


def hourly_metrics_mixed(rows: DataFrame, conform_output: bool = True) -> DataFrame:
    """A7x in one aggregate over both kinds: conditional counts instead of a
    join, so it runs as one stateful query.  One watermark covers the union:
    an hour closes an hour after the latest event of either kind.  Hours
    without transactions have no row, as in ``hourly_metrics_ext``."""
    tx = F.col("data_type") == "transaction"
    amount = F.when(tx, _amount())
    df = rows.withWatermark("event_time", "1 hour") if rows.isStreaming else rows
    distinct = F.approx_count_distinct if rows.isStreaming else F.count_distinct
    agg = df.groupBy(F.window("event_time", "1 hour").alias("window")).agg(
        F.count_if(tx).alias("total_transactions"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("avg_transaction_amount"),
        distinct(F.when(tx, F.col("user_id"))).alias("active_users"),
        F.count_if(~tx).alias("anomaly_count"),
    )
    out = agg.filter("total_transactions > 0").select(
        to_wall_clock(F.col("window.start")).alias("hour"), "total_transactions", "total_amount", "avg_transaction_amount", "active_users", "anomaly_count"
    )
    return conform(out, "hourly_metrics") if conform_output else out
