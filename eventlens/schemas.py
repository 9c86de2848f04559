"""Declared event schemas.  Fixed up front, all fields nullable: unknown
JSON fields are dropped, missing ones become NULL, a wrong-typed field
becomes NULL while the rest of the record is kept."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _fields(*pairs) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in pairs])


S, I, D = StringType(), IntegerType(), DoubleType()

# Field names, order and types of the three event kinds and
# the envelope must equal the producer's messages.
ENVELOPE = _fields(("data_type", S), ("batch_id", S))

TRANSACTION = _fields(
    ("transaction_id", S),
    ("user_id", S),
    ("user_name", S),
    ("user_city", S),
    ("user_age", I),
    ("user_email", S),
    ("transaction_amount", D),
    ("transaction_currency", S),
    ("transaction_category", S),
    ("merchant", S),
    ("transaction_date", S),
    ("payment_method", S),
    ("status", S),
    ("device", S),
    ("ip_address", S),
    ("metadata", S),
    ("data_type", S),
    ("batch_id", S),
)

LOCATION = _fields(("city", S), ("country", S), ("coordinates", S))

ACTIVITY = _fields(
    ("activity_id", S),
    ("user_id", S),
    ("user_name", S),
    ("activity_type", S),
    ("page_url", S),
    ("session_duration", I),
    ("timestamp", S),
    ("device_info", MapType(S, S)),
    ("location", LOCATION),
    ("data_type", S),
    ("batch_id", S),
)

SENSOR = _fields(
    ("sensor_id", S),
    ("sensor_type", S),
    ("sensor_location", S),
    ("timestamp", S),
    ("value", D),
    ("unit", S),
    ("status", S),
    ("battery_level", I),
    ("signal_strength", I),
    ("data_type", S),
    ("batch_id", S),
)

BY_TYPE = {"transaction": TRANSACTION, "activity": ACTIVITY, "sensor": SENSOR}

# Name of the event-time text field per kind.
EVENT_TIME_FIELD = {
    "transaction": "transaction_date",
    "activity": "timestamp",
    "sensor": "timestamp",
}


def union_schema() -> StructType:
    """All fields of all kinds in one struct, so each message is parsed
    once.  Field types agree across kinds (checked here), so parsing with
    the union gives every kind the same values as its own schema."""
    seen: dict[str, StructField] = {}
    for schema in (ENVELOPE, TRANSACTION, ACTIVITY, SENSOR):
        for field in schema.fields:
            prior = seen.get(field.name)
            if prior is not None and prior.dataType != field.dataType:
                raise TypeError(
                    f"field {field.name!r} has two types: {prior.dataType} and {field.dataType}"
                )
            seen.setdefault(field.name, field)
    return StructType(list(seen.values()))


UNION = union_schema()

# Message layout on the topic: JSON text plus broker time.
MESSAGE = _fields(("json", S))
