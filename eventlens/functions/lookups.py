"""Value domains of the event producer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit by sensor type, with 'unit' for any other type.
SENSOR_UNITS = {
    "temperature": "°C",
    "humidity": "%",
    "pressure": "hPa",
    "vibration": "m/s²",
    "power_consumption": "W",
}
DEFAULT_UNIT = "unit"

# Producer domains.
PAYMENT_METHODS = ["credit_card", "debit_card", "digital_wallet", "cash"]
TRANSACTION_STATUSES = ["success", "pending", "failed"]
DEVICES = ["mobile", "desktop", "tablet"]
SENSOR_TYPES = ["temperature", "humidity", "pressure", "vibration", "power_consumption"]
SENSOR_LOCATIONS = ["factory_floor", "warehouse", "office", "server_room"]
SENSOR_STATUSES = ["normal", "warning", "critical"]
ANOMALY_STATUSES = ["warning", "critical"]
CURRENCY = "RUB"
AMOUNT_RANGE = (100.0, 50000.0)
SESSION_RANGE = (10, 3600)
BATTERY_RANGE = (10, 100)
SIGNAL_RANGE = (1, 5)
AGE_RANGE = (18, 70)
# Value range of a reading by sensor type (inclusive).
SENSOR_VALUE_RANGES = {
    "temperature": (-10.0, 40.0),
    "humidity": (30.0, 90.0),
    "pressure": (950.0, 1050.0),
    "vibration": (0.0, 10.0),
    "power_consumption": (0.0, 1000.0),
}


def sensor_unit(sensor_type: Column) -> Column:
    """Unit for a sensor type via a map literal; unknown types -> 'unit'."""
    units = F.create_map(*[F.lit(x) for kv in SENSOR_UNITS.items() for x in kv])
    return F.coalesce(F.element_at(units, sensor_type), F.lit(DEFAULT_UNIT))


def value_in_type_range(sensor_type: Column, value: Column) -> Column:
    """TRUE when a reading lies in its type's range, NULL for unknown types."""
    expr = None
    for kind, (lo, hi) in SENSOR_VALUE_RANGES.items():
        cond = sensor_type == F.lit(kind)
        res = value.between(lo, hi)
        expr = F.when(cond, res) if expr is None else expr.when(cond, res)
    return expr
