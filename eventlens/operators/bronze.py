"""Bronze layer (F7): every message JSON-parsed once, stored as typed
parquet partitioned by ``data_type``.

The reference parses each message once per query (ten queries, two parses
per row).  Here one pass parses with the union schema and writes all
kinds into one dataset; each aggregate then reads only its kind's
partition (partition pruning) and only the columns it uses (column
pruning), instead of JSON text.  Messages of no known kind are kept, with
their raw text, in the ``data_type=__rejected__`` partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.time import parse_event_time
from ..schemas import BY_TYPE, UNION
from ..sources.files import FILE_ROWS
from . import parse, rescue

REJECTED = "__rejected__"
PARTITION = "data_type"
DATE = "event_date"
LANDING = "landing_date"


def bronze_rows(messages: DataFrame, by_date: bool = False, rescued: bool = False) -> DataFrame:
    """messages -> one row per message: union fields, event time, broker time
    (and the UTC broker and event dates when the layout is partitioned by date).
    ``rescued`` adds the map of fields that the typed ones lost."""
    p = parse.parsed(messages)
    extra = [rescue.lost_fields(rescue.raw_fields("json"), "data", UNION).alias(rescue.RESCUED)] if rescued else []
    dtype = F.col("data.data_type")
    known = dtype.isin(*BY_TYPE)
    event_text = F.when(dtype == "transaction", F.col("data.transaction_date")).otherwise(
        F.col("data.timestamp")
    )
    fields = [F.col(f"data.{f.name}").alias(f.name) for f in UNION.fields if f.name != PARTITION]
    return p.select(
        *fields,
        *extra,
        parse_event_time(event_text).alias("event_time"),
        "kafka_timestamp",
        F.when(known, F.lit(None).cast("string")).otherwise(F.col("json")).alias("rejected_json"),
        F.when(known, dtype).otherwise(F.lit(REJECTED)).alias(PARTITION),
        *(
            [F.to_date("kafka_timestamp").alias(LANDING), F.to_date(parse_event_time(event_text)).alias(DATE)]
            if by_date
            else []
        ),
    )


def write_bronze(
    messages: DataFrame, path: str, mode: str = "overwrite", by_date: bool = False, partial: bool = False, rescued: bool = False
) -> None:
    """Write bronze partitioned by kind: a task writes its kinds side by side,
    without sorting their rows, into files of bounded length.  With ``by_date`` it is partitioned by
    landing (broker) date, kind and event date, and a landing date in
    ``messages`` replaces everything that it landed before, of all kinds and
    event dates: a message whose event date was corrected leaves its old one.
    Late events of a day, and the untimed and rejected messages of each
    landing, stand beside those of other landings.

    ``messages`` must hold whole broker days.  A delivery that reaches less far
    than the stored landing of a day (by first and last broker time) is refused,
    as it would drop the rest of that day; ``partial`` replaces it all the same."""
    if not by_date:
        rows = bronze_rows(messages, rescued=rescued)
        with storage.concurrent_writers(messages.sparkSession, len(BY_TYPE) + 1):
            rows.write.mode(mode).option("maxRecordsPerFile", FILE_ROWS).partitionBy(PARTITION).parquet(path)
        return
    path, columns = path.rstrip("/"), [LANDING, PARTITION, DATE]
    rows = bronze_rows(messages, by_date, rescued)
    if mode != "overwrite":
        rows.write.mode(mode).partitionBy(*columns).parquet(path)
        return
    spark = messages.sparkSession
    staged = storage.stage(rows, path, columns)
    if not partial:
        old, new = storage.partitions(spark, path, LANDING), storage.partitions(spark, staged, LANDING)
        again = sorted(d for d in old.keys() & new.keys() if d is not None)
        old, new = _landed(spark, path, [old[d] for d in again]), _landed(spark, staged, [new[d] for d in again])
        short = sorted(str(d) for d in old.keys() & new.keys() if new[d][0] > old[d][0] or new[d][1] < old[d][1])
        if short:
            storage.delete(spark, staged)
            raise ValueError(f"landing of {', '.join(short[:5])} covers less than the one stored; pass partial=True to replace it")
    storage.swap(spark, staged, path, LANDING)


def _landed(spark: SparkSession, path: str, folders: list[str]) -> dict:
    """First and last broker time by landing date: one small row per date.
    Only the folders named are listed and read."""
    if not folders:
        return {}
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in folders]).where(F.col("kafka_timestamp").isNotNull()).groupBy(F.col(LANDING).cast("string").alias("d"))
    return {r.d: (r.first, r.last) for r in rows.agg(F.min("kafka_timestamp").alias("first"), F.max("kafka_timestamp").alias("last")).collect()}


def start_bronze_stream(messages: DataFrame, path: str, checkpoint: str, trigger=None, name: str = "bronze"):
    """Streaming bronze: the file sink commits each micro-batch exactly once."""
    w = (
        bronze_rows(messages)
        .writeStream.queryName(name)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(PARTITION)
        .outputMode("append")
    )
    if trigger is not None:
        w = trigger.apply(w)
    return w.start()


def bronze_schema(spark: SparkSession, by_date: bool = False):
    """Schema of the bronze dataset, for streaming reads."""
    empty = spark.createDataFrame([], "json string, kafka_timestamp timestamp")
    return bronze_rows(empty, by_date).schema


def read_kind(
    spark: SparkSession, path: str, kind: str, streaming: bool = False, days: tuple | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Typed events of one kind from bronze (declared fields, event_time,
    kafka_timestamp, data_type).  ``days=(first, last)`` (inclusive, UTC)
    on a date-partitioned bronze reads only those event days' partitions, of all
    landings, and of the landings of those days the rows without a valid event
    time, which have no other day.  ``max_files_per_trigger`` bounds a
    streaming batch."""
    if streaming:
        reader = spark.readStream.schema(bronze_schema(spark, by_date=days is not None))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        df = reader.parquet(path)
    else:
        df = spark.read.parquet(path)
    df = df.filter(F.col(PARTITION) == kind)
    if days is not None:
        first, last = (F.lit(str(d)).cast("date") for d in days)
        untimed = F.col(DATE).isNull() & F.col(LANDING).between(first, last)
        df = df.filter(F.col(DATE).between(first, last) | untimed)
    cols = [f.name for f in BY_TYPE[kind].fields]
    return df.select(*cols, "event_time", "kafka_timestamp")
