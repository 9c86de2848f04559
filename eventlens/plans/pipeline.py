"""Batch pipeline: topic -> parse -> typed kinds -> result tables.

``Pipeline`` is lazy: each table is a DataFrame plan built on demand from
the message source, so a report that needs one column of one table reads
and parses only what that column needs.  ``materialize`` writes the
tables as parquet (the reporting layer's storage) and returns readers of
the written tables, which also cuts the lineage.
"""

from __future__ import annotations

from datetime import timedelta
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import storage
from ..contracts import CONTRACTS, lossy_flag, split_lossy
from ..functions.time import parse_event_time
from ..operators import aggregates, bronze, dedup, merge, parse, sketches
from ..operators.bronze import DATE
from ..schemas import EVENT_TIME_FIELD
from ..sources.messages import stored_topic
from ..streaming import late, store

AGGREGATE_TABLES = (
    "transaction_hourly_stats",
    "top_users",
    "payment_method_stats",
    "device_stats",
    "activity_stats",
    "sensor_anomalies",
    "sensor_anomalies_ext",
    "hourly_metrics",
)
RAW_TABLES = ("raw_transactions", "raw_activities", "raw_sensors")
ALL_TABLES = AGGREGATE_TABLES + RAW_TABLES
QUARANTINE = "_quarantine"


class Pipeline:
    """Result tables over a per-kind source of typed events.

    ``events(kind)`` returns typed events of one kind with ``event_time``
    and ``kafka_timestamp``: parsed from JSON messages, or read from the
    bronze layer (parsed once, columnar, pruned by kind and column).
    """

    def __init__(self, spark: SparkSession, events_of: Callable[[str], DataFrame], days: tuple | None = None):
        self.spark, self.days = spark, days
        self._events_of = events_of
        self._cache: dict[str, DataFrame] = {}

    @classmethod
    def from_messages(cls, spark: SparkSession, messages) -> "Pipeline":
        """``messages``: a mixed topic DataFrame; every table reads it and
        routes its kind."""
        return cls(spark, lambda kind: aggregates.prepare(messages, kind))

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> "Pipeline":
        return cls.from_messages(spark, stored_topic(spark, sf_dir))

    @classmethod
    def from_bronze(cls, spark: SparkSession, path: str, days: tuple | None = None) -> "Pipeline":
        """From bronze; ``days=(first, last)`` limits a date-partitioned
        bronze to those UTC days (partition pruning), and to the untimed rows
        that landed on them.  Windows of 10, 30 and 60 minutes never cross a
        UTC day boundary, so whole days give whole windows."""
        return cls(spark, lambda kind: bronze.read_kind(spark, path, kind, days=days), days)

    def events(self, kind: str) -> DataFrame:
        return self._events_of(kind)

    def computed(self, name: str) -> DataFrame:
        """A table's rows before the contract's casts, at full width."""
        if name not in self._cache:
            if name in aggregates.SPECS:
                spec = aggregates.SPECS[name]
                df = aggregates.build(spec, self.events(spec.kind), conform_output=False)
            elif name in parse.RAW:
                df = parse.RAW[name](self.events(parse.RAW_KIND[name]))
            elif name == "hourly_metrics_ext":
                df = aggregates.hourly_metrics_ext(
                    self.events("transaction"), self.events("sensor"), conform_output=False
                )
            elif name == sketches.TABLE:
                df = sketches.hourly_user_sketches(self.events("transaction"))
            else:
                raise KeyError(name)
            self._cache[name] = df
        return self._cache[name]

    @staticmethod
    def date_of(name: str):
        """The UTC date a row of a table belongs to: of its window, or of the
        event time its bronze date was made from; without one, of its landing."""
        from pyspark.sql import functions as F

        if name in parse.RAW:
            event = parse_event_time(F.col(EVENT_TIME_FIELD[parse.RAW_KIND[name]]))
            return F.coalesce(F.to_date(event), F.to_date("kafka_timestamp"))
        return F.to_date("hour" if name.startswith("hourly_") else "window_start")

    @staticmethod
    def contract(name: str) -> str:
        return "hourly_metrics" if name == "hourly_metrics_ext" else name

    def table(self, name: str) -> DataFrame:
        """Rows that fit the contract; raw tables hold each key once."""
        good, _ = split_lossy(self.computed(name), self.contract(name))
        return dedup.first_delivery(good, name) if name in parse.RAW else good

    def quarantined(self, name: str) -> DataFrame:
        """Rows that lose a value in the contract's casts, or lack a NOT NULL
        value, as computed."""
        return split_lossy(self.computed(name), self.contract(name))[1]

    def tables(self, names=ALL_TABLES) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in names}

    def materialize(
        self,
        root: str,
        names=ALL_TABLES,
        mode: str = "overwrite",
        concurrent_jobs: int = 4,
        by_date: bool = False,
    ) -> "Tables":
        """Write result tables as parquet; return a reader over them.

        The tables are independent jobs, submitted from a few driver threads
        so their stages share the executors instead of queuing; no data
        passes through the driver.  Rows that do not fit the contract go to
        ``<root>/_quarantine/<table>``; they are counted while the table is
        written, and computed again only where there are some.

        With ``by_date`` tables and quarantine are partitioned by the UTC date
        of the row's window or event time; raw rows without a valid time
        belong to the day they landed on.  An overwrite replaces the dates
        written and removes those of the pipeline's ``days`` that have become
        empty, in the table and in the quarantine alike, and leaves all other
        dates: a day-range recompute is incremental and idempotent."""
        from concurrent.futures import ThreadPoolExecutor

        from pyspark.sql import Observation
        from pyspark.sql import functions as F

        covers = storage.within(self.days)

        def write(n: str) -> None:
            path, contract, seen = f"{root.rstrip('/')}/{n}", self.contract(n), Observation()
            aside = f"{root.rstrip('/')}/{QUARANTINE}/{n}"
            rows = self.computed(n)
            if by_date:
                rows = rows.withColumn(DATE, self.date_of(n))
            keep = (DATE,) if by_date else ()
            counted = rows.observe(seen, F.sum(lossy_flag(contract).cast("int")).alias("lossy"))
            df = split_lossy(counted, contract, keep)[0]
            if n in parse.RAW:
                df = dedup.first_delivery(df, n)
            if by_date and mode == "overwrite":
                storage.replace_partitions(df, path, [DATE], covers)
            else:
                df.write.mode(mode).partitionBy(*keep).parquet(path)
            if seen.get.get("lossy"):
                bad = split_lossy(rows, contract)[1]
                if by_date and mode == "overwrite":
                    storage.replace_partitions(bad, aside, [DATE], covers)
                else:
                    bad.write.mode(mode).partitionBy(*keep).parquet(aside)
            elif mode == "overwrite":
                for value, folder in storage.partitions(self.spark, aside, DATE).items():
                    if by_date and covers(value):
                        storage.delete(self.spark, f"{aside}/{folder}")
                if not by_date:
                    storage.delete(self.spark, aside)

        for n in names:  # build plans on this thread; only execution is parallel
            self.computed(n)
        with ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
            for f in [pool.submit(write, n) for n in names]:
                f.result()
        return Tables(self.spark, root)


class Tables:
    """Result tables read from storage (parquet folders by table name).
    Tables of the streaming sink are read by their manifest and carry
    ``processed_at``, which reports never reference; windows that late rows
    changed are read as corrected.  Raw tables are appended as delivered and
    hold each key once when read here."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        if merge.is_merged(self.spark, self.root, name):
            return self.spark.read.parquet(f"{self.root}/{name}")  # each key once as stored
        if name in aggregates.SPECS and late.is_corrected(self.spark, self.root, name):
            return late.corrected(self.spark, self.root, name)
        if store.has_manifest(self.spark, self.root, name):
            df = store.stored(self.spark, self.root, name)
        else:
            df = self.spark.read.parquet(f"{self.root}/{name}")
        return dedup.first_delivery(df, name) if name in parse.RAW else df


class RecentTables(Tables):
    """Date-partitioned tables cut to their last hours (K4).

    The anchor is the greatest time in the newest date partition, which is
    found by listing folders; only that partition is read for it, and the
    tables are then read from the first date needed (partition filter)."""

    def __init__(self, spark: SparkSession, root: str, hours: int):
        super().__init__(spark, root)
        self.hours = hours

    def table(self, name: str) -> DataFrame:
        from pyspark.sql import functions as F

        df, path = super().table(name), f"{self.root}/{name}"
        time = next(c for c in ("window_start", "hour", "transaction_date", "timestamp") if c in df.columns)
        anchor = None
        for newest in sorted((d for d in storage.partitions(self.spark, path, DATE) if d is not None), reverse=True):
            anchor = df.filter(F.col(DATE) == F.lit(newest).cast("date")).agg(F.max(time)).first()[0]
            if anchor is not None:
                break
        if anchor is None:
            return df
        start = anchor - timedelta(hours=self.hours)
        return df.filter((F.col(DATE) >= F.lit(start.date())) & (F.col(time) > F.lit(start)))


class JdbcTables:
    """Result tables read over JDBC (S14).  Reports select few columns and
    Spark pushes column pruning and filters into the database query.  A read
    is split over ``partitions`` tasks by the table's time column, between the
    bounds that one aggregate query in the database gives; ``partitioning``
    names another column and bounds for a table."""

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str] | None = None,
                 partitioning: dict[str, dict] | None = None, partitions: int = 8):
        self.spark, self.url = spark, url
        self.properties = dict(properties or {})
        self.partitioning = partitioning or {}
        self.partitions = partitions

    @staticmethod
    def time_column(name: str) -> str | None:
        """The window or hour, of raw tables the broker time; rows without one
        are read by the first task."""
        names = CONTRACTS[name].names if name in CONTRACTS else ()
        return next((c for c in ("window_start", "hour", "kafka_timestamp") if c in names), None)

    def bounds(self, name: str, column: str) -> tuple:
        query = f"SELECT min({column}) AS lo, max({column}) AS hi FROM {name}"
        row = self.spark.read.format("jdbc").options(url=self.url, query=query, **self.properties).load().first()
        return row[0], row[1]

    def split(self, name: str) -> dict | None:
        """Arguments that split a table's read; None: one task reads it."""
        part = self.partitioning.get(name)
        if part:
            return {"column": part["column"], "lowerBound": part["lower"], "upperBound": part["upper"], "numPartitions": part.get("partitions", self.partitions)}
        column = self.time_column(name)
        if column is None or self.partitions < 2:
            return None
        low, high = self.bounds(name, column)
        if low is None or low == high:
            return None
        return {"column": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": self.partitions}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, name, **(self.split(name) or {}), properties=self.properties)
