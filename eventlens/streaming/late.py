"""Late rows of windowed aggregates: a side output and corrected windows.

An append-mode aggregate drops rows whose window is closed.  ``LateRows`` is
the handler of a stateless query over the same events.  It follows the
aggregate's watermark, the greatest event time so far less the delay, and
keeps the rows that come behind it in ``<root>/_late/<table>``.

The watermark a batch is judged by is that before the batch (``through=False``),
which is the aggregate's own where both see the same batches, or that after it
(``through=True``, the default): the aggregate may cut the source into smaller
or larger batches, and a row can only be dropped by rows that stand before it,
all of which are in this batch or an earlier one.  Then every dropped row is
kept, and some that were not; those cost a recomputation and change nothing.

The greatest event time is written with each batch, keyed by run and batch like
the rows, so a batch that runs again is judged as it was before.

``correct`` computes the windows that late rows touched again, whole, from the
stored events, and writes them as a correction.  ``corrected`` reads a table
with its corrections: of each window the last correction, else what was
stored.  The windows touched are the only thing gathered: event dates and
window starts, bounded by the time range, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.time import to_wall_clock
from ..operators import aggregates
from . import store
from .sinks import run_of

LATE, SEEN, CORRECTIONS = "_late", "_seen", "_corrections"


def _window_column(spec: aggregates.AggSpec) -> str:
    return spec.window_output[0]


@dataclass
class LateRows:
    """``foreachBatch`` handler: rows of typed events behind the watermark of ``table``."""

    root: str
    table: str
    through: bool = True

    @property
    def spec(self) -> aggregates.AggSpec:
        return aggregates.SPECS[self.table]

    def _folder(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/{kind}/{self.table}"

    def _seen(self, spark: SparkSession, run: str | None, batch_id: int):
        """Greatest event time of the batches before this one of the same run."""
        before = [f for f in storage.folders(spark, self._folder(SEEN)) if _of_run(f, run) and _number(f) < batch_id]
        if not before:
            return None
        last = max(before, key=_number)
        return spark.read.parquet(f"{self._folder(SEEN)}/{last}").first()[0]

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark, run = batch_df.sparkSession, run_of(batch_df)
        events = batch_df if self.spec.pre_filter is None else batch_df.filter(self.spec.pre_filter())
        before = self._seen(spark, run, batch_id)
        here = events.agg(F.max("event_time")).first()[0]
        after = max((t for t in (before, here) if t is not None), default=None)
        mark = after if self.through else before
        name = store.batch_path("x", run, batch_id).split("/", 1)[1]
        if mark is not None:
            end = F.window("event_time", self.spec.window).getField("end")
            closed = end <= F.lit(mark) - F.expr(f"INTERVAL {self.spec.delay}")
            late = events.filter(F.col("event_time").isNotNull()).filter(closed)
            late.write.mode("overwrite").parquet(f"{self._folder(LATE)}/{name}")
        if after is not None:  # last: a batch that fails before is judged anew
            for old in storage.folders(spark, self._folder(SEEN)):
                if _of_run(old, run) and _number(old) < batch_id - 1:
                    storage.delete(spark, f"{self._folder(SEEN)}/{old}")
            spark.range(1).select(F.lit(after).alias("seen")).write.mode("overwrite").parquet(f"{self._folder(SEEN)}/{name}")


@dataclass
class LateRowsOfKind:
    """The late rows of several tables of one kind, from one pass over a batch."""

    handlers: tuple[LateRows, ...]

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            for handler in self.handlers:
                handler(batch_df, batch_id)
        finally:
            batch_df.unpersist()


def _number(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1].rsplit("-", 1)[-1])


def _of_run(folder: str, run: str | None) -> bool:
    value = folder.split("=", 1)[1]
    return value.rsplit("-", 1)[0] == run if run else "-" not in value


def late_rows(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The side output of a table, with the batch that each row came in."""
    path = f"{root.rstrip('/')}/{LATE}/{table}"
    return spark.read.parquet(path) if storage.folders(spark, path) else None


def correct(spark: SparkSession, root: str, table: str, events: Callable[[tuple], DataFrame]) -> int:
    """Compute the windows touched by late rows that no correction has seen.

    ``events(days)`` gives the typed events of whole UTC days, (first, last),
    for example from bronze; only runs of touched days are asked for.  Returns
    the number of windows corrected."""
    root, spec = root.rstrip("/"), aggregates.SPECS[table]
    late = late_rows(spark, root, table)
    if late is None:
        return 0
    folder = f"{root}/{CORRECTIONS}/{table}"
    done = [f for f in storage.folders(spark, folder) if f.startswith("number=")]
    seen = {r[0] for f in done for r in spark.read.parquet(f"{folder}/_batches/{f}").collect()}  # names of batches
    new = [f for f in storage.folders(spark, f"{root}/{LATE}/{table}") if f.startswith("micro_batch=") and f not in seen]
    if not new:
        return 0
    late = spark.read.parquet(*[f"{root}/{LATE}/{table}/{f}" for f in new])
    start = F.window("event_time", spec.window).getField("start")
    touched = late.select(start.alias("start")).distinct()
    days = sorted({r[0] for r in touched.select(F.to_date("start")).distinct().collect()})
    number = 1 + max((int(f.split("=")[1]) for f in done), default=-1)
    windows = 0
    if days:
        touched = touched.select(to_wall_clock(F.col("start")).alias(_window_column(spec)))
        windows = touched.count()
        rows = None
        for first, last in _runs(days):
            part = aggregates.build(spec, events((first, last)), conform_output=False)
            rows = part if rows is None else rows.unionByName(part)
        rows.join(touched, _window_column(spec), "left_semi").write.mode("overwrite").parquet(f"{folder}/_rows/number={number}")
        touched.write.mode("overwrite").parquet(f"{folder}/_windows/number={number}")
    spark.createDataFrame([(f,) for f in new], "batch string").write.mode("overwrite").parquet(f"{folder}/_batches/number={number}")
    # the folder that counts is made last
    spark.range(1).select(F.lit(windows).alias("windows")).write.mode("overwrite").parquet(f"{folder}/number={number}")
    return windows


def _runs(days: list) -> list[tuple]:
    """Consecutive days as (first, last)."""
    out = []
    for d in days:
        if out and (d - out[-1][1]).days == 1:
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def is_corrected(spark: SparkSession, root: str, table: str) -> bool:
    return storage.exists(spark, f"{root.rstrip('/')}/{CORRECTIONS}/{table}")


def corrected(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The stored table with its corrections, conformed to the contract."""
    root, spec = root.rstrip("/"), aggregates.SPECS[table]
    streamed = store.has_manifest(spark, root, table)
    base = aggregates.conform(store.stored(spark, root, table) if streamed else spark.read.parquet(f"{root}/{table}"), table)
    folder, column = f"{root}/{CORRECTIONS}/{table}", _window_column(spec)
    done = [f for f in storage.folders(spark, folder) if f.startswith("number=") and storage.exists(spark, f"{folder}/_windows/{f}")]
    if not done:
        return base

    def numbered(kind: str) -> DataFrame:
        parts = [spark.read.parquet(f"{folder}/{kind}/{f}").withColumn("number", F.lit(int(f.split("=")[1]))) for f in done]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    last = numbered("_windows").groupBy(column).agg(F.max("number").alias("number"))
    renewed = numbered("_rows").join(last, [column, "number"], "left_semi")
    return base.join(last, column, "left_anti").unionByName(aggregates.conform(renewed, table))
