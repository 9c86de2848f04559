"""Replay of the fallback and quarantine folders (S11, 2.7).

A batch that a sink could not write lies in ``_fallback`` as it came, and rows
that lost a value in the contract's casts lie in ``_quarantine``.  ``replay``
takes them back into the table: it mends them with a function of the caller,
splits them by the contract again, writes what fits as a batch of its own and
leaves the rest in quarantine.

It is idempotent by (batch, natural key).  The batch that a replay writes is
named after the folder it came from, so a replay that runs again replaces its
own rows; rows whose natural key the table already holds are left out (nulls
in a key are no value, and such rows stay); and a ledger, written after the
table, names the folders done, so a second replay does nothing.  A replay that
fails anywhere is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..contracts import CONTRACTS, conform, lossy_flag, split_lossy
from . import store

LEDGER = "_replayed"
FALLBACK, QUARANTINE = "_fallback", "_quarantine"


def ledger(spark: SparkSession, root: str, table: str) -> DataFrame:
    """What was replayed: source, batch, rows taken, rows held already, rows left."""
    path = f"{root.rstrip('/')}/{LEDGER}/{table}"
    if not storage.folders(spark, path):
        return spark.createDataFrame([], "source string, batch string, taken long, held long, remaining long")
    return spark.read.parquet(*[f"{path}/{f}" for f in storage.folders(spark, path)])


def _absent(rows: DataFrame, held: DataFrame, key: list[str]) -> DataFrame:
    """Rows of which ``held`` has no natural key.  Rows of one key within the
    batch stay one, the whole least of them."""
    null = F.greatest(*[F.col(k).isNull().cast("int") for k in key], F.lit(0)) > 0
    rest = [c for c in rows.columns if c not in key]
    first = F.min(F.struct(*[F.col(c) for c in rest])).alias("_first") if rest else F.count(F.lit(1)).alias("_first")
    once = rows.groupBy(*key, F.when(null, F.monotonically_increasing_id()).alias("_alone")).agg(first)
    once = once.select(*[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in rows.columns])
    return once.join(held.select(*key).distinct(), key, "left_anti")  # a null key equals nothing


def replay(
    spark: SparkSession,
    root: str,
    table: str,
    source: str = FALLBACK,
    mend: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    source_root: str | None = None,
) -> int:
    """Take the batches of one source folder back; returns the rows taken.

    Quarantine is worth replaying once ``mend``, or the contract, has changed:
    rows that still do not fit stay where they are, their folder is not marked
    as done and will be tried again."""
    root = root.rstrip("/")
    folder = f"{(source_root or f'{root}/{source}').rstrip('/')}/{table}"
    done = {r.batch for r in ledger(spark, root, table).where(F.col("source") == source).select("batch").collect()}  # names of folders
    contract, taken = CONTRACTS[table], 0
    for batch in storage.folders(spark, folder):
        if batch in done or not batch.startswith("micro_batch="):
            continue
        name = f"{source.strip('_')}-{batch.split('=', 1)[1]}"
        rows = mend(spark.read.parquet(f"{folder}/{batch}"))
        good, bad = split_lossy(rows, table)
        path = f"{table}/micro_batch={name}"
        # an earlier, unfinished attempt of this replay does not count as held
        held = [e for e in store.entries(spark, root, table) if e["path"] != path]
        before = store._read(spark, root, held)
        new = good if before is None else _absent(good, conform(before, table), list(contract.key))
        new.withColumn("processed_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{root}/{path}")
        written = spark.read.parquet(f"{root}/{path}").count()
        fitting, remaining = (rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(lossy_flag(table).cast("int")), F.lit(0))).first())
        fitting -= remaining
        run, number = name.rsplit("-", 1) if "-" in name else (name, "0")
        store.commit(spark, root, table, {"kind": "batch", "run": run, "batch": int(number), "path": path, "rows": written, "lossy": 0, "replaces": []})
        if remaining and source == FALLBACK:
            bad.write.mode("overwrite").parquet(f"{root}/{QUARANTINE}/{table}/micro_batch={name}")
        if not remaining or source == FALLBACK:
            entry = [(source, batch, written, fitting - written, remaining)]
            spark.createDataFrame(entry, "source string, batch string, taken long, held long, remaining long").write.mode("overwrite").parquet(f"{root}/{LEDGER}/{table}/{name}")
        taken += written
    return taken
