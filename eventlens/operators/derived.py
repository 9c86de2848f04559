"""Derived fields and data-quality rules (R1-R4) from the producer's
domains.  Rule counts are one-pass conditional sums, unpivoted to
(stream, rule, violations, checked)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions.time import hour_batch_id, parse_event_time
from ..schemas import EVENT_TIME_FIELD
from . import parse


def loyalty_check(tx: DataFrame) -> DataFrame:
    """Expected points int(amount / 100) vs metadata's reported points.
    Points beyond an int are NULL; they are compared before they are narrowed."""
    expected = F.floor(F.col("transaction_amount") / 100)
    reported = F.get_json_object("metadata", "$.loyalty_points_earned").try_cast("long")
    return tx.select(
        "transaction_id",
        expected.try_cast("int").alias("expected_points"),
        reported.try_cast("int").alias("reported_points"),
        expected.eqNullSafe(reported).alias("consistent"),
    )


def batch_id_check(messages: DataFrame) -> DataFrame:
    """R2: per kind, messages whose envelope batch id equals the hour batch
    id of their event time.  One parse and one aggregation for all kinds."""
    p = parse.parsed(messages).select("data.*")
    dtype = F.col("data_type")
    event_text = F.when(dtype == "transaction", F.col(EVENT_TIME_FIELD["transaction"])).otherwise(
        F.col(EVENT_TIME_FIELD["activity"])
    )
    derived = hour_batch_id(parse_event_time(event_text))
    return (
        p.filter(dtype.isin(*EVENT_TIME_FIELD))
        .groupBy("data_type")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.sum(derived.eqNullSafe(F.col("batch_id")).cast("int")).alias("matching"),
        )
    )


def sensor_unit_check(sensors: DataFrame) -> DataFrame:
    """Readings per type with the expected unit and how many match it."""
    expected = L.sensor_unit(F.col("sensor_type"))
    return sensors.groupBy("sensor_type").agg(
        F.first(expected).alias("expected_unit"),
        F.count(F.lit(1)).alias("readings"),
        F.sum(F.when(F.col("unit") == expected, 1).otherwise(0)).alias("unit_matches"),
    )


def _outside(col: Column, lo, hi) -> Column:
    return col.isNull() | ~col.between(lo, hi)


def _not_in(col: Column, values) -> Column:
    return col.isNull() | ~col.isin(*values)


def transaction_rules() -> dict[str, Column]:
    t = F.col
    return {
        "amount_out_of_range": _outside(t("transaction_amount"), *L.AMOUNT_RANGE),
        "bad_currency": _not_in(t("transaction_currency"), [L.CURRENCY]),
        "bad_payment_method": _not_in(t("payment_method"), L.PAYMENT_METHODS),
        "bad_status": _not_in(t("status"), L.TRANSACTION_STATUSES),
        "bad_device": _not_in(t("device"), L.DEVICES),
        "age_out_of_range": _outside(t("user_age"), *L.AGE_RANGE),
        "bad_event_time": parse_event_time(t("transaction_date")).isNull(),
        "missing_id": t("transaction_id").isNull(),
    }


def activity_rules() -> dict[str, Column]:
    t = F.col
    return {
        "session_out_of_range": _outside(t("session_duration"), *L.SESSION_RANGE),
        "bad_event_time": parse_event_time(t("timestamp")).isNull(),
        "missing_city": t("location.city").isNull(),
        "missing_id": t("activity_id").isNull(),
    }


def sensor_rules() -> dict[str, Column]:
    t = F.col
    in_range = L.value_in_type_range(t("sensor_type"), t("value"))
    return {
        "bad_sensor_type": _not_in(t("sensor_type"), L.SENSOR_TYPES),
        "bad_location": _not_in(t("sensor_location"), L.SENSOR_LOCATIONS),
        "bad_status": _not_in(t("status"), L.SENSOR_STATUSES),
        "battery_out_of_range": _outside(t("battery_level"), *L.BATTERY_RANGE),
        "signal_out_of_range": _outside(t("signal_strength"), *L.SIGNAL_RANGE),
        "value_out_of_type_range": in_range.isNull() | ~in_range,
        "unit_mismatch": ~t("unit").eqNullSafe(L.sensor_unit(t("sensor_type"))),
        "bad_event_time": parse_event_time(t("timestamp")).isNull(),
    }


RULES = {"transaction": transaction_rules, "activity": activity_rules, "sensor": sensor_rules}


def quality_report(messages: DataFrame) -> DataFrame:
    """R4 in one pass: each message is parsed once; every (kind, rule) is a
    conditional sum in a single global aggregate (partial per task, one
    row shuffled per task), then unpivoted to (stream, rule, violations,
    checked)."""
    p = parse.parsed(messages).select("data.*")
    dtype = F.col("data_type")
    sums, cells = [], []
    for kind, rules in RULES.items():
        is_kind = dtype == kind
        sums.append(F.sum(is_kind.cast("int")).alias(f"{kind}__checked"))
        for name, cond in rules().items():
            col = f"{kind}__{name}"
            sums.append(F.sum((is_kind & cond).cast("int")).alias(col))
            cells.append((kind, name, col))
    wide = p.agg(*sums)
    stack = ", ".join(f"'{k}', '{r}', `{c}`, `{k}__checked`" for k, r, c in cells)
    return wide.selectExpr(f"stack({len(cells)}, {stack}) AS (stream, rule, violations, checked)").select(
        "stream",
        "rule",
        F.coalesce(F.col("violations"), F.lit(0)).cast("bigint").alias("violations"),
        F.coalesce(F.col("checked"), F.lit(0)).cast("bigint").alias("checked"),
    )
