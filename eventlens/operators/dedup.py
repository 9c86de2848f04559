"""Natural-key de-duplication (S13): at-least-once delivery made
idempotent.

Batch: per key keep the first delivery (earliest broker time, ties broken
by the whole row), as ``min`` of a struct.  ``min`` is a partial
aggregate, so a hot key is reduced map-side before the shuffle instead of
gathering all its copies in one task.

Rows with a NULL in the key are no copies of each other (UNIQUE permits
repeated NULLs): each has a group of its own and stays.

Stream (opt-in): the raw tables are appended without state and are
de-duplicated when they are read, so no late row is lost.  For consumers
that need unique rows at once, and accept that rows later than the horizon
are dropped, ``dropDuplicatesWithinWatermark`` runs on the key, with the
watermark on broker time; state for a key lives as long as re-deliveries
may arrive.
Streaming dedup has no map-side combine, so a key re-delivered en masse
would send all its copies to one task.  It runs in two stages: first on
(key, salt), where the salt spreads a key's copies over ``salt_buckets``
tasks, then on the key, which then receives at most ``salt_buckets`` rows
per key and batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import CONTRACTS


def first_delivery(raw: DataFrame, table: str, within: str = "1 day", salt_buckets: int = 16, alone: Column | None = None) -> DataFrame:
    """``alone``: what tells rows without a whole key apart in a batch; each
    row is one of its own unless given."""
    key = list(CONTRACTS[table].key)
    no_key = F.greatest(*[F.col(k).isNull().cast("int") for k in key], F.lit(0)) > 0
    if raw.isStreaming:
        # NULL keys: a key of their own, so they pass
        alone = F.when(no_key, F.expr("uuid()"))
        timed = raw.withColumn("_alone", alone).withWatermark("kafka_timestamp", within)
        key = [*key, "_alone"]
        if salt_buckets <= 1:
            return timed.dropDuplicatesWithinWatermark(key).drop("_alone")
        # copies differ in broker time or arrive in different input partitions
        salt = F.pmod(F.xxhash64("kafka_timestamp") + F.spark_partition_id(), F.lit(salt_buckets))
        spread = timed.withColumn("_salt", salt).dropDuplicatesWithinWatermark([*key, "_salt"])
        return spread.dropDuplicatesWithinWatermark(key).drop("_salt", "_alone")
    rest = [c for c in raw.columns if c not in key and c != "kafka_timestamp"]
    best = F.min(F.struct(F.col("kafka_timestamp"), *[F.col(c) for c in rest])).alias("_first")
    out = raw.groupBy(*key, F.when(no_key, F.monotonically_increasing_id() if alone is None else alone).alias("_alone")).agg(best)
    return out.select(*key, *[F.col(f"_first.{c}").alias(c) for c in ["kafka_timestamp", *rest]]).select(
        *raw.columns
    )
