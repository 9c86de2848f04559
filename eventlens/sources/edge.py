"""The fixture topic with faults, derived from the same tables: bad times,
amounts that overflow a row or only their sum, missing ids, wrong derived
fields and malformed JSON, at fixed remainders of the event id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import parse_event_time
from . import fixtures
from .messages import encode_events

#: remainder of the event id by EVERY -> fault
EVERY = 50
BAD_TIME, LARGE, OVERFLOW, NO_ID, MALFORMED, WRONG_POINTS, WRONG_BATCH, WRONG_UNIT = range(1, 9)
LARGE_AMOUNT = 9e9  # fits a row, not the sum of two
OVERFLOW_AMOUNT = 1e15


def _is(eid: Column, fault: int) -> Column:
    return eid % EVERY == fault


def edge_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.transactions(spark, sf_dir)
    eid = F.substring_index("transaction_id", "_", -1).cast("long")
    amount = F.when(_is(eid, LARGE), F.lit(LARGE_AMOUNT)).when(_is(eid, OVERFLOW), F.lit(OVERFLOW_AMOUNT))
    points = F.when(_is(eid, WRONG_POINTS), F.lit(-1)).otherwise(F.col("metadata.loyalty_points_earned"))
    return t.withColumns(
        {
            "_eid": eid,
            "transaction_date": F.when(_is(eid, BAD_TIME), F.lit("junk")).otherwise(F.col("transaction_date")),
            "transaction_amount": F.coalesce(amount, F.col("transaction_amount")),
            "metadata": F.col("metadata").withField("loyalty_points_earned", points),
            "batch_id": F.when(_is(eid, WRONG_BATCH), F.lit("batch_x")).otherwise(F.col("batch_id")),
            "transaction_id": F.when(~_is(eid, NO_ID), F.col("transaction_id")),
        }
    )


def edge_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fixtures.sensors(spark, sf_dir)
    eid = F.unix_timestamp(parse_event_time(F.col("timestamp"))) - F.lit(fixtures.EPOCH_2024)
    return s.withColumns(
        {
            "unit": F.when(_is(eid, WRONG_UNIT), F.lit("K")).otherwise(F.col("unit")),
            "timestamp": F.when(_is(eid, BAD_TIME), F.lit("")).otherwise(F.col("timestamp")),
        }
    )


def edge_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(json, kafka_timestamp): faulty transactions and sensor readings."""
    t = edge_transactions(spark, sf_dir)
    encoded = encode_events(t.drop("_eid")).columns
    payload = [c for c in t.columns if c not in ("_eid", "kafka_timestamp")]
    text = F.when(_is(F.col("_eid"), MALFORMED), F.lit('{"data_type": "transaction", "user')).otherwise(F.to_json(F.struct(*payload)))
    return t.select(text.alias("json"), "kafka_timestamp").select(*encoded).unionByName(encode_events(edge_sensors(spark, sf_dir)))


#: remainder of the event id by EVERY -> a field of the wrong type, or unknown
AGE_TEXT, AMOUNT_TEXT, UNDECLARED, NAME_NUMBER = 10, 11, 12, 13


def mistyped_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(json, kafka_timestamp): the fixture transactions with ages and amounts
    as text, a field that no schema declares, and a number as a name (which
    reads as text and is not lost)."""
    topic = encode_events(fixtures.transactions(spark, sf_dir))
    number = F.regexp_extract("json", '"transaction_id":"tx_([0-9]+)"', 1)
    eid, text = number.cast("long"), F.col("json")

    def field(name: str, pattern: str, value: Column) -> Column:
        return F.regexp_replace(text, F.lit(f'"{name}":{pattern}'), F.concat(F.lit(f'"{name}":'), value))

    age = F.regexp_extract("json", '"user_age":([0-9]+)', 1)
    wrong = (
        F.when(_is(eid, AGE_TEXT), field("user_age", "[0-9]+", F.concat(F.lit('"'), age, F.lit(' years"'))))
        .when(_is(eid, AMOUNT_TEXT), field("transaction_amount", "[0-9.E]+", F.concat(F.lit('"lost '), number, F.lit('"'))))
        .when(_is(eid, UNDECLARED), F.concat(F.lit('{"coupon":"C'), number, F.lit('",'), F.substring(text, 2, 1 << 30)))
        .when(_is(eid, NAME_NUMBER), field("user_name", '"[^"]*"', number))
        .otherwise(text)
    )
    return topic.select(wrong.alias("json"), "kafka_timestamp")
