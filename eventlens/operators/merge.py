"""Raw tables as merged dates (S12, S13): every key once, kept so on write.

A raw table that is appended as delivered has to be grouped over all its
history on every read.  Here a batch is merged when it arrives, and a read is
a plain, date-pruned scan.  The table is partitioned by event date (landing
date for rows without a valid time); files are sorted by key, so their footers
bound the keys they hold.

A merge rewrites only the dates it touches:

- the dates of the batch's rows;
- dates in which a key of the batch lies already, for example because a
  re-delivery carries a corrected time.  They are found by reading the key
  columns of the other dates, only in the key range of the batch, which Parquet
  skips by footer where it cannot match, and a semi join with the batch's keys.

Of each key the first delivery stays (``dedup.first_delivery``); rows without
a whole key are no copies of each other, only the same message of the same
broker time is.  A merge that runs again gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..contracts import CONTRACTS
from . import dedup
from .bronze import DATE

MERGED = "_merged"
_TIME = {"raw_transactions": "transaction_date", "raw_activities": "timestamp", "raw_sensors": "timestamp"}


def is_merged(spark: SparkSession, root: str, table: str) -> bool:
    return storage.exists(spark, f"{root.rstrip('/')}/{MERGED}/{table}")


def _once(rows: DataFrame, table: str) -> DataFrame:
    """Each key once; rows without a whole key once per delivery.  One aggregate
    for both, so the batch is parsed, or the dates are read, once."""
    return dedup.first_delivery(rows, table, alone=F.struct(*rows.columns))


def read_dates(spark: SparkSession, path: str, dates: list[str]) -> DataFrame:
    """The rows of some dates, by partition filter."""
    return spark.read.parquet(path).filter(F.col(DATE).isin([F.lit(d).cast("date") for d in dates]))


def dates_of_keys(spark: SparkSession, path: str, table: str, batch: DataFrame, besides: list[str]) -> list[str]:
    """Stored dates, besides those given, that hold a key of the batch."""
    key = list(CONTRACTS[table].key)
    low, high = batch.agg(F.min(key[0]), F.max(key[0])).first()
    others = sorted(d for d in storage.partitions(spark, path, DATE) if d is not None and d not in besides)
    if low is None or not others:
        return []
    held = read_dates(spark, path, others).filter(F.col(key[0]).between(F.lit(low), F.lit(high))).select(*key, DATE)
    hit = held.join(batch.select(*key), key, "left_semi").select(F.col(DATE).cast("string").alias("d")).distinct()
    return sorted(r.d for r in hit.collect())  # dates, not rows


def merge(rows: DataFrame, root: str, table: str) -> list[str]:
    """Merge conformed raw rows into ``<root>/<table>``; returns the dates rewritten."""
    spark, path = rows.sparkSession, f"{root.rstrip('/')}/{table}"
    contract = CONTRACTS[table]
    dated = _once(rows.select(*contract.names), table).withColumn(DATE, F.coalesce(F.to_date(_TIME[table]), F.to_date("kafka_timestamp")))
    staged = f"{root.rstrip('/')}/_staging/{table}-batch"
    dated.write.mode("overwrite").parquet(staged)  # computed once; read three times below
    batch = spark.read.schema(dated.schema).parquet(staged)
    dates = sorted(r.d for r in batch.select(F.coalesce(F.col(DATE).cast("string"), F.lit("")).alias("d")).distinct().collect())
    if not dates:
        return []
    if storage.partitions(spark, path, DATE):
        dates = sorted({*dates, *dates_of_keys(spark, path, table, batch, dates)})
        old = read_dates(spark, path, [d for d in dates if d])
        if "" in dates:
            old = old.unionByName(spark.read.parquet(path).filter(F.col(DATE).isNull()))
        batch = _once(old.select(*batch.columns).unionByName(batch), table)
    ordered = batch.repartitionByRange(DATE, *contract.key).sortWithinPartitions(DATE, *contract.key)
    storage.replace_partitions(ordered, path, [DATE], lambda value: (value or "") in dates)
    spark.range(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{MERGED}/{table}")
    storage.delete(spark, staged)
    return dates
