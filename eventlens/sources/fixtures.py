"""Deterministic event streams derived from the driver's tables.

``events`` joined to ``customer`` and ``nation`` gives the three event
kinds of the producer (transaction, activity, sensor) with the same field
meaning.  Event time is dense so windows hold several rows:
transactions and activities at 2024-01-01 + event_id * 10 s, sensor
readings at 2024-01-01 + event_id * 1 s.  The broker time of every message
is the event row's own ``ts``.

Joins are plain equi-joins: Catalyst broadcasts a dimension only when its
size estimate is under ``spark.sql.autoBroadcastJoinThreshold`` and uses a
shuffled sort-merge join otherwise; AQE splits skewed user keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lookups import sensor_unit
from ..functions.time import hour_batch_id, iso_text
from .tables import table

EPOCH_2024 = 1704067200  # 2024-01-01 00:00:00 UTC
TX_STEP_SECONDS = 10
SENSOR_STEP_SECONDS = 1

# Constant text fields of the fixture events.
USER_EMAIL = "user@example.com"
MERCHANT = "Example Merchant"
IP_ADDRESS = "10.0.0.1"
COUNTRY = "Russia"
TIMEZONE = "Europe/Moscow"
PAGE_URL_PREFIX = "https://shop.example.com/"
BROWSERS = ["Chrome", "Firefox", "Safari", "Edge"]
OSES = ["Windows", "macOS", "Linux", "Android", "iOS"]
PAYMENT_METHODS = ["credit_card", "debit_card", "digital_wallet", "cash"]
DEVICES = ["mobile", "desktop", "tablet"]
SENSOR_TYPES = ["temperature", "humidity", "pressure", "vibration", "power_consumption"]
SENSOR_LOCATIONS = ["factory_floor", "warehouse", "office", "server_room"]
SENSOR_COUNT = 20


def _pick(index: Column, values: list[str]) -> Column:
    """values[index] for a small fixed list, as a CASE expression."""
    expr = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(index == i, F.lit(v))
    return expr


def dense_time(event_id: Column, step_seconds: int) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH_2024) + event_id * F.lit(step_seconds))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", "c_name", "c_mktsegment", "n_name"
    )


def _events_with_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    users = _users(spark, sf_dir)
    return events.join(users, events.user_id == users.c_custkey)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture view T: one transaction per event row."""
    e = _events_with_users(spark, sf_dir)
    eid = F.col("event_id")
    amount = (F.col("value").cast("decimal(12,2)") * 100).cast("double")
    event_time = dense_time(eid, TX_STEP_SECONDS)
    status_bucket = eid % 100
    return e.select(
        F.concat(F.lit("tx_"), eid.cast("string")).alias("transaction_id"),
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("n_name").alias("user_city"),
        (F.lit(18) + F.col("user_id") % 53).cast("int").alias("user_age"),
        F.lit(USER_EMAIL).alias("user_email"),
        amount.alias("transaction_amount"),
        F.lit("RUB").alias("transaction_currency"),
        F.col("c_mktsegment").alias("transaction_category"),
        F.lit(MERCHANT).alias("merchant"),
        iso_text(event_time).alias("transaction_date"),
        _pick(eid % 4, PAYMENT_METHODS).alias("payment_method"),
        F.when(status_bucket < 90, "success")
        .when(status_bucket < 97, "pending")
        .otherwise("failed")
        .alias("status"),
        _pick(eid % 3, DEVICES).alias("device"),
        F.lit(IP_ADDRESS).alias("ip_address"),
        F.struct(
            (F.lit(1) + eid % 10).cast("int").alias("items_count"),
            (eid % 2 == 0).alias("discount_applied"),
            F.floor(amount / 100).cast("int").alias("loyalty_points_earned"),
        ).alias("metadata"),
        F.lit("transaction").alias("data_type"),
        hour_batch_id(event_time).alias("batch_id"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
    )


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture view A: one activity per event row."""
    e = _events_with_users(spark, sf_dir)
    eid = F.col("event_id")
    event_time = dense_time(eid, TX_STEP_SECONDS)
    return e.select(
        F.concat(F.lit("ac_"), eid.cast("string")).alias("activity_id"),
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("event_type").alias("activity_type"),
        F.concat(F.lit(PAGE_URL_PREFIX), F.col("event_type")).alias("page_url"),
        (F.lit(10) + eid % 3591).cast("int").alias("session_duration"),
        iso_text(event_time).alias("timestamp"),
        F.create_map(
            F.lit("browser"), _pick(eid % 4, BROWSERS), F.lit("os"), _pick(eid % 5, OSES)
        ).alias("device_info"),
        # The producer sends a timezone the consumer schema does not declare.
        F.struct(
            F.col("n_name").alias("city"),
            F.lit(COUNTRY).alias("country"),
            F.lit(TIMEZONE).alias("timezone"),
        ).alias("location"),
        F.lit("activity").alias("data_type"),
        hour_batch_id(event_time).alias("batch_id"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture view N: one reading per event row; 20 sensors whose type and
    location are functions of the sensor."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    eid = F.col("event_id")
    sensor_no = F.col("user_id") % SENSOR_COUNT
    event_time = dense_time(eid, SENSOR_STEP_SECONDS)
    status_bucket = eid % 20
    sensor_type = _pick(F.col("user_id") % 5, SENSOR_TYPES)
    return e.select(
        F.concat(F.lit("sensor_"), F.lpad(sensor_no.cast("string"), 4, "0")).alias("sensor_id"),
        sensor_type.alias("sensor_type"),
        _pick(F.col("user_id") % 4, SENSOR_LOCATIONS).alias("sensor_location"),
        iso_text(event_time).alias("timestamp"),
        F.col("value").alias("value"),
        sensor_unit(sensor_type).alias("unit"),
        F.when(status_bucket == 0, "critical")
        .when(status_bucket <= 2, "warning")
        .otherwise("normal")
        .alias("status"),
        (F.lit(10) + eid % 91).cast("int").alias("battery_level"),
        (F.lit(1) + eid % 5).cast("int").alias("signal_strength"),
        F.lit("sensor").alias("data_type"),
        hour_batch_id(event_time).alias("batch_id"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
    )


VIEWS = {"transaction": transactions, "activity": activities, "sensor": sensors}
