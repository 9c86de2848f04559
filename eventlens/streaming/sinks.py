"""Micro-batch sinks for ``foreachBatch``.

``foreachBatch`` is at-least-once: after a failure Spark re-runs the last
batch with the same ``batch_id``.  Every sink here is therefore keyed by run
and ``batch_id`` (``streaming.store``): the parquet sink overwrites
``<table>/micro_batch=<run>-<id>``, so a retry replaces its own earlier
attempt and never duplicates rows, and a query with a new checkpoint, whose
ids count from 0 again, has folders of its own.

Per batch: one pass writes the rows that fit the contract and observes how
many rows came and how many lose a value in its casts; only if there are some
are they computed again, for the quarantine folder.  Empty batches leave
nothing.  What is written is then committed to the table's manifest.  If any
of this fails, the whole batch goes to the fallback folder as it came (same
layout), and what the table got of it is taken back where the sink can; if the
fallback fails too the error is raised, so the batch is retried rather than
silently committed.  Both folders lie below the table root unless others are
named: no row is ever left without a place.
"""

from __future__ import annotations

import logging
import uuid
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import storage
from ..contracts import CONTRACTS, lossy_flag, split_lossy
from ..operators import merge
from ..session import work_dir
from . import store

log = logging.getLogger(__name__)


def run_of(df: DataFrame) -> str | None:
    """Id of the streaming query whose batch ``df`` is: it belongs to the
    checkpoint and stays over restarts.  None outside a query."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


@dataclass
class ParquetTableSink:
    """Idempotent parquet result table with quarantine and fallback."""

    root: str
    table: str
    fallback_root: str | None = None  # default <root>/_fallback
    quarantine_root: str | None = None  # default <root>/_quarantine
    # outcome of recent batches (bounded: a stream runs for months)
    stats: deque = field(default_factory=lambda: deque(maxlen=1000))
    processed_at: bool = True

    def __post_init__(self) -> None:
        self.fallback_root = self.fallback_root or f"{self.root.rstrip('/')}/_fallback"
        self.quarantine_root = self.quarantine_root or f"{self.root.rstrip('/')}/_quarantine"

    def path(self, root: str, df: DataFrame, batch_id: int) -> str:
        return f"{root.rstrip('/')}/{store.batch_path(self.table, run_of(df), batch_id)}"

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self.path(self.root, df, batch_id))

    def take_back(self, df: DataFrame, batch_id: int) -> None:
        """Empty what a failed batch may have left in the table, so that the
        fallback is its only place until it is replayed."""
        store.retract(df.sparkSession, self.root, self.table, run_of(df), batch_id)
        storage.delete(df.sparkSession, self.path(self.root, df, batch_id))

    def committed(self, df: DataFrame, batch_id: int, rows: int, lossy: int) -> None:
        run = run_of(df)
        entry = {"kind": "batch", "run": run, "batch": int(batch_id), "path": store.batch_path(self.table, run, batch_id), "rows": rows - lossy, "lossy": lossy, "replaces": []}
        store.commit(df.sparkSession, self.root, self.table, entry)

    def _stamp(self, df: DataFrame) -> DataFrame:
        """``processed_at``: write time of the row (not part of any key)."""
        return df.withColumn("processed_at", F.current_timestamp()) if self.processed_at else df

    def _deliver(self, batch_df: DataFrame, batch_id: int) -> str:
        known, seen = self.table in CONTRACTS, Observation()
        flag = lossy_flag(self.table).cast("int") if known else F.lit(0)
        counted = batch_df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(flag), F.lit(0)).alias("lossy"))
        good = split_lossy(counted, self.table)[0] if known else counted
        self.write(self._stamp(good), batch_id)
        rows, lossy = int(seen.get["rows"]), int(seen.get["lossy"])
        if rows == 0:
            self.take_back(batch_df, batch_id)
            storage.delete_empty(batch_df.sparkSession, f"{self.root.rstrip('/')}/{self.table}")
            log.info("table %s batch %s empty, skipped", self.table, batch_id)
            return "empty"
        log.info("table %s batch %s: %s rows, %s quarantined", self.table, batch_id, rows, lossy)
        if log.isEnabledFor(logging.DEBUG):
            # bounded preview of the batch (5 rows), as the reference logs
            log.debug("table %s batch %s preview: %s", self.table, batch_id, batch_df.take(5))
        if lossy:
            split_lossy(batch_df, self.table)[1].write.mode("overwrite").parquet(self.path(self.quarantine_root, batch_df, batch_id))
        self.committed(batch_df, batch_id, rows, lossy)
        return "written"

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        try:
            status = self._deliver(batch_df, batch_id)
        except Exception as err:  # noqa: BLE001 - any error goes to fallback
            log.warning("table %s batch %s failed (%s); writing fallback", self.table, batch_id, err)
            batch_df.write.mode("overwrite").parquet(self.path(self.fallback_root, batch_df, batch_id))
            self.take_back(batch_df, batch_id)
            status = "fallback"
        self.stats.append((batch_id, status))


@dataclass
class SharedSink:
    """Gives the tables of one shared query's batch to their sinks.  The batch
    is computed once, into files below ``scratch`` that go with it, and each
    table reads its rows from there: a backlog arrives as one batch, which the
    executors' memory need not hold.  Each sink writes, falls back and commits
    for itself, so one table's failure is no other's."""

    tables: dict[str, Callable[[DataFrame], DataFrame]]  # table -> its rows of a batch
    sinks: dict[str, Callable[[DataFrame, int], None]]
    scratch: str | None = None  # default below the session's shared folder
    partition: str | None = None  # a column of few values by which tables take their rows

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        path = f"{(self.scratch or work_dir(spark, 'batches')).rstrip('/')}/{uuid.uuid4().hex}"
        try:
            if self.partition is None:
                batch_df.write.parquet(path)
            else:
                with storage.concurrent_writers(spark, len(self.tables) + 1):
                    batch_df.write.partitionBy(self.partition).parquet(path)
            batch = spark.read.schema(batch_df.schema).parquet(path).select(*batch_df.columns)
            for table, rows in self.tables.items():
                self.sinks[table](rows(batch), batch_id)
        finally:
            storage.delete(spark, path)


@dataclass
class MergedTableSink(ParquetTableSink):
    """Merges the batches of a raw table into its dates (``operators.merge``):
    each key is stored once, and a batch that runs again changes nothing."""

    processed_at: bool = False

    def write(self, df: DataFrame, batch_id: int) -> None:
        merge.merge(df, self.root, self.table)

    def take_back(self, df: DataFrame, batch_id: int) -> None:
        """Rows already merged stay: merging them again changes nothing."""

    def committed(self, df: DataFrame, batch_id: int, rows: int, lossy: int) -> None:
        """The dates are swapped in whole; there are no batch folders."""


@dataclass
class JdbcTableSink(ParquetTableSink):
    """Append to a JDBC table (S6), with the contract's column types used
    when the table is created.  Idempotence by key: rows whose key is
    already in the target (a batch delivered again, or half delivered) are
    dropped by a null-safe left anti-join against the target's keys.  The
    keys are read for the batch's range only, bounded on both sides on a time
    column where the table has one (``range_column``), by pushed-down literal
    filters.  The target's existence is asked from the database; any other
    error is raised."""

    url: str = ""
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    dbtable: str | None = None

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.dbtable or self.table}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver:
            opts["driver"] = self.driver
        if self.table in CONTRACTS:
            opts["createTableColumnTypes"] = CONTRACTS[self.table].ddl()
        return opts

    def take_back(self, df: DataFrame, batch_id: int) -> None:
        """Rows already appended stay: a replay of the batch skips them by key."""

    def committed(self, df: DataFrame, batch_id: int, rows: int, lossy: int) -> None:
        """The database commits its own rows."""

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        """The batch is read twice, for the range of its keys and to be
        written, so it is cached."""
        batch_df.persist()
        try:
            super().__call__(batch_df, batch_id)
        finally:
            batch_df.unpersist()

    @property
    def range_column(self) -> str | None:
        """The column that bounds the key read: window start, hour or broker time."""
        names = CONTRACTS[self.table].names if self.table in CONTRACTS else []
        return next((c for c in ("window_start", "hour", "kafka_timestamp") if c in names), None)

    def reader_options(self) -> dict[str, str]:
        return {k: v for k, v in self.options().items() if k != "createTableColumnTypes"}

    def catalog_query(self) -> str:
        """Whether the target is there, asked from the standard catalog view."""
        name = (self.dbtable or self.table).replace('"', "").split(".")
        names = [n.lower().replace("'", "''") for n in name]
        where = f"lower(table_name) = '{names[-1]}'"
        if len(names) > 1:
            where += f" AND lower(table_schema) = '{names[-2]}'"
        return f"SELECT count(*) AS n FROM information_schema.tables WHERE {where}"

    def target_exists(self, df: DataFrame) -> bool:
        options = {k: v for k, v in self.reader_options().items() if k != "dbtable"}
        return df.sparkSession.read.format("jdbc").options(**options, query=self.catalog_query()).load().first()[0] > 0

    def new_rows(self, df: DataFrame, target: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key ``target`` does not hold; NULLs are equal.
        The target's rows without a time are read only for a batch that has
        such rows."""
        key, col = list(CONTRACTS[self.table].key), self.range_column
        if col is not None:
            lo, hi, nulls = df.agg(F.min(col), F.max(col), F.count_if(F.col(col).isNull())).first()
            bound = F.lit(False) if lo is None else F.col(col).between(F.lit(lo), F.lit(hi))
            target = target.filter(bound | F.col(col).isNull() if nulls else bound)
        held = target.select(*[F.col(k).alias(f"_t_{k}") for k in key])
        same = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in key]
        cond = same[0]
        for c in same[1:]:
            cond = cond & c
        return df.join(held, cond, "left_anti")

    def write(self, df: DataFrame, batch_id: int) -> None:
        out = df
        if self.table in CONTRACTS and self.target_exists(df):
            target = df.sparkSession.read.format("jdbc").options(**self.reader_options()).load()
            out = self.new_rows(df, target)
        out.write.format("jdbc").mode("append").options(**self.options()).save()
