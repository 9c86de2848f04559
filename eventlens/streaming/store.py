"""Tables of streaming batches: run-keyed folders, a manifest of what is
committed, and compaction into date partitions.

A batch of a query is written to ``<table>/micro_batch=<run>-<n>``.  The run
is the id that the query's checkpoint carries: it stays over restarts, so
a batch that runs again replaces itself, and a new checkpoint, whose batches
count from 0 again, writes beside the old run instead of over it.

After its data a batch commits one small JSON file below ``_manifest/<table>``.
``stored`` reads the folders that the manifest names and nothing else, so it
never sees half a batch.  ``compact`` merges committed batches into files of
about ``target_bytes`` below ``_compacted/<table>/<n>/event_date=...``; its own
manifest entry names what it replaces, and only then are the old folders
removed.  A compaction that fails before that entry has changed nothing.

The manifest has one entry per batch since the last compaction and one per
compaction; reading it lists paths, never rows of data.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..contracts import CONTRACTS

MANIFEST, COMPACTED, DATE = "_manifest", "_compacted", "event_date"
TARGET_BYTES = 128 << 20
_ENTRY = "kind string, run string, batch long, path string, rows long, lossy long, replaces array<string>"
#: Columns that give a row's date, by preference.
_TIMES = ("window_start", "hour", "transaction_date", "timestamp", "kafka_timestamp")


def batch_path(table: str, run: str | None, batch: int) -> str:
    """Folder of a batch below the root; sinks outside a query have no run."""
    return f"{table}/micro_batch={run}-{int(batch)}" if run else f"{table}/micro_batch={int(batch)}"


def _entry_name(kind: str, run: str | None, batch: int) -> str:
    return f"{kind}-{run or 'none'}-{int(batch)}.json"


def retract(spark: SparkSession, root: str, table: str, run: str | None, batch: int) -> None:
    """Take back the entry of a batch whose data goes."""
    storage.delete(spark, f"{root.rstrip('/')}/{MANIFEST}/{table}/{_entry_name('batch', run, batch)}")


def commit(spark: SparkSession, root: str, table: str, entry: dict) -> None:
    """Write one manifest entry in one piece: to a hidden name, then renamed."""
    folder = f"{root.rstrip('/')}/{MANIFEST}/{table}"
    name = _entry_name(entry["kind"], entry["run"], entry["batch"])
    fs, path = storage._hadoop(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(path, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    storage.delete(spark, f"{folder}/{name}")
    storage.rename(spark, path.toString(), f"{folder}/{name}")


def entries(spark: SparkSession, root: str, table: str) -> list[dict]:
    """Committed entries that no later compaction replaces."""
    folder = f"{root.rstrip('/')}/{MANIFEST}/{table}"
    if not storage.exists(spark, folder):
        return []
    found = [r.asDict() for r in spark.read.schema(_ENTRY).json(folder).collect()]  # one per batch since the last compaction
    gone = {p for e in found for p in e["replaces"] or ()}
    return sorted((e for e in found if e["path"] not in gone), key=lambda e: (e["kind"], e["run"] or "", e["batch"]))


def has_manifest(spark: SparkSession, root: str, table: str) -> bool:
    return storage.exists(spark, f"{root.rstrip('/')}/{MANIFEST}/{table}")


def _read(spark: SparkSession, root: str, found: Iterable[dict]) -> DataFrame | None:
    root, found = root.rstrip("/"), list(found)
    batches = [f"{root}/{e['path']}" for e in found if e["kind"] == "batch" and e["rows"]]
    parts = [spark.read.parquet(*batches)] if batches else []
    for e in found:
        if e["kind"] == "compacted" and e["rows"]:
            parts.append(spark.read.parquet(f"{root}/{e['path']}"))
    out = None
    for p in parts:
        p = p.drop(DATE) if DATE in p.columns else p
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def stored(spark: SparkSession, root: str, table: str, unique: bool | None = None) -> DataFrame:
    """The committed rows of a table.

    A run from a new checkpoint that reads the source from its start writes
    windows again that an earlier run had written.  ``unique`` keeps the row
    written last of each natural key (by ``processed_at``, then the whole row,
    as a partial aggregate); by default that is done for aggregate tables with
    rows of several runs."""
    found = entries(spark, root, table)
    rows = _read(spark, root, found)
    if rows is None:
        columns = [F.lit(None).cast(t).alias(c) for c, t in CONTRACTS[table].columns] if table in CONTRACTS else []
        return spark.range(0).select(*columns)
    contract = CONTRACTS.get(table)
    if unique is None:
        runs = {r for e in found for r in (e["run"] or "").split("+")}
        unique = len(runs) > 1 and contract is not None and not table.startswith("raw_")
    if not unique or contract is None:
        return rows
    rest = [c for c in rows.columns if c not in contract.key]
    first = [c for c in ("processed_at",) if c in rest]
    best = F.max(F.struct(*first, *[c for c in rest if c not in first])).alias("_last")
    return rows.groupBy(*contract.key).agg(best).select(*[F.col(c) if c in contract.key else F.col(f"_last.{c}").alias(c) for c in rows.columns])


def compact(spark: SparkSession, root: str, table: str, target_bytes: int = TARGET_BYTES, full: bool = False) -> dict | None:
    """Merge the committed batches (with ``full`` also earlier compactions)
    into date partitions, in files of about ``target_bytes``.

    Rows are range-partitioned by date and key into as many parts as the
    folders' bytes ask for, so small dates share a part and a large date is
    split over several.  Returns the entry committed, None if there is nothing
    to merge."""
    root = root.rstrip("/")
    found = [e for e in entries(spark, root, table) if e["kind"] == "batch" or full]
    rows = _read(spark, root, found)
    if rows is None or len(found) < 2:
        return None
    time = next((c for c in _TIMES if c in rows.columns), None)
    dated = rows.withColumn(DATE, F.to_date(F.col(time)) if time else F.lit(None).cast("date"))
    size = 0
    for e in found:
        fs, path = storage._hadoop(spark, f"{root}/{e['path']}")
        size += fs.getContentSummary(path).getLength()
    key = [c for c in (CONTRACTS[table].key if table in CONTRACTS else ()) if c in rows.columns]
    parts = max(1, math.ceil(size / target_bytes))
    number = 1 + max((int(f) for f in storage.folders(spark, f"{root}/{COMPACTED}/{table}") if f.isdigit()), default=-1)
    target = f"{COMPACTED}/{table}/{number}"
    dated.repartitionByRange(parts, DATE, *key).sortWithinPartitions(DATE, *key).write.partitionBy(DATE).mode("overwrite").parquet(f"{root}/{target}")
    entry = {
        "kind": "compacted", "run": "+".join(sorted({r for e in found for r in (e["run"] or "").split("+")})), "batch": number, "path": target,
        "rows": sum(e["rows"] for e in found), "lossy": 0, "replaces": [e["path"] for e in found],
    }
    commit(spark, root, table, entry)
    clean(spark, root, table)
    return entry


def clean(spark: SparkSession, root: str, table: str) -> None:
    """Remove folders that a committed compaction has replaced."""
    root = root.rstrip("/")
    folder = f"{root}/{MANIFEST}/{table}"
    found = [r.asDict() for r in spark.read.schema(_ENTRY).json(folder).collect()]
    gone = {p for e in found for p in e["replaces"] or ()}
    for path in gone:
        storage.delete(spark, f"{root}/{path}")
    for e in found:
        if e["path"] in gone:
            storage.delete(spark, f"{folder}/{_entry_name(e['kind'], e['run'], e['batch'])}")
