"""Result-table contracts (S12): column names, types, NOT NULL and the
natural key of every table the pipeline writes.

``conform`` turns a computed DataFrame into the declared layout using
``try_cast`` (ANSI-safe); ``split_lossy`` separates rows in which a cast
lost a value (overflow, bad text) so they can be quarantined instead of
failing the whole batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    not_null: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]

    def ddl(self) -> str:
        """Column types for JDBC ``createTableColumnTypes``."""
        return ", ".join(f"{c} {_jdbc_type(t)}" for c, t in self.columns)


def _jdbc_type(spark_type: str) -> str:
    return {
        "string": "TEXT",
        "binary": "BYTEA",
        "int": "INTEGER",
        "bigint": "BIGINT",
        "timestamp_ntz": "TIMESTAMP",
        "timestamp": "TIMESTAMP",
        "double": "DOUBLE PRECISION",
    }.get(spark_type, spark_type.upper())


WS = (("window_start", "timestamp_ntz"), ("window_end", "timestamp_ntz"))

# Table names, columns, precisions and unique keys of the
# result tables.
CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in [
        Contract(
            "transaction_hourly_stats",
            WS
            + (
                ("user_city", "string"),
                ("transaction_category", "string"),
                ("transaction_count", "int"),
                ("total_amount", "decimal(12,2)"),
                ("avg_amount", "decimal(10,2)"),
                ("min_amount", "decimal(10,2)"),
                ("max_amount", "decimal(10,2)"),
            ),
            key=("window_start", "window_end", "user_city", "transaction_category"),
            not_null=("window_start", "window_end"),
        ),
        Contract(
            "top_users",
            WS
            + (
                ("user_id", "string"),
                ("user_name", "string"),
                ("user_city", "string"),
                ("total_spent", "decimal(12,2)"),
                ("transaction_count", "int"),
            ),
            # the grouping: a user may appear with two names or cities
            key=("window_start", "window_end", "user_id", "user_name", "user_city"),
            not_null=("window_start", "window_end"),
        ),
        Contract(
            "activity_stats",
            WS
            + (
                ("activity_type", "string"),
                ("city", "string"),
                ("activity_count", "int"),
                ("avg_session_duration", "decimal(10,2)"),
            ),
            key=("window_start", "window_end", "activity_type", "city"),
            not_null=("window_start", "window_end"),
        ),
        Contract(
            "sensor_anomalies",
            WS
            + (
                ("sensor_id", "string"),
                ("sensor_type", "string"),
                ("sensor_location", "string"),
                ("status", "string"),
                ("reading_count", "int"),
                ("avg_value", "decimal(10,3)"),
                ("std_value", "decimal(10,3)"),
            ),
            # The reference declares (window, sensor_id) unique while it groups
            # by type, location and status too; the key here is the grouping.
            key=(
                "window_start",
                "window_end",
                "sensor_id",
                "sensor_type",
                "sensor_location",
                "status",
            ),
            not_null=("window_start", "window_end"),
        ),
        Contract(
            "sensor_anomalies_ext",
            WS
            + (
                ("sensor_id", "string"),
                ("sensor_type", "string"),
                ("sensor_location", "string"),
                ("status", "string"),
                ("reading_count", "int"),
                ("avg_value", "decimal(10,3)"),
                ("std_value", "decimal(10,3)"),
                ("signal_strength", "decimal(10,2)"),
                ("battery_level", "decimal(10,2)"),
            ),
            key=(
                "window_start",
                "window_end",
                "sensor_id",
                "sensor_type",
                "sensor_location",
                "status",
            ),
            not_null=("window_start", "window_end"),
        ),
        Contract(
            "payment_method_stats",
            WS
            + (
                ("payment_method", "string"),
                ("transaction_count", "int"),
                ("total_amount", "decimal(12,2)"),
                ("avg_amount", "decimal(10,2)"),
            ),
            key=("window_start", "window_end", "payment_method"),
            not_null=("window_start", "window_end"),
        ),
        Contract(
            "device_stats",
            WS
            + (
                ("device_type", "string"),
                ("transaction_count", "int"),
                ("success_rate", "decimal(5,2)"),
            ),
            key=("window_start", "window_end", "device_type"),
            not_null=("window_start", "window_end"),
        ),
        Contract(
            "hourly_metrics",
            (
                ("hour", "timestamp_ntz"),
                ("total_transactions", "int"),
                ("total_amount", "decimal(12,2)"),
                ("active_users", "int"),
                ("avg_transaction_amount", "decimal(10,2)"),
                ("anomaly_count", "int"),
            ),
            key=("hour",),
            not_null=("hour",),
        ),
        Contract(
            "raw_transactions",
            (
                ("transaction_id", "string"),
                ("user_id", "string"),
                ("user_name", "string"),
                ("user_city", "string"),
                ("user_age", "int"),
                ("user_email", "string"),
                ("transaction_amount", "decimal(12,2)"),
                ("transaction_currency", "string"),
                ("transaction_category", "string"),
                ("merchant", "string"),
                ("transaction_date", "timestamp_ntz"),
                ("payment_method", "string"),
                ("status", "string"),
                ("device", "string"),
                ("ip_address", "string"),
                ("metadata", "string"),
                ("data_type", "string"),
                ("batch_id", "string"),
                ("kafka_timestamp", "timestamp_ntz"),
            ),
            key=("transaction_id",),
            not_null=("transaction_id",),
        ),
        Contract(
            "raw_activities",
            (
                ("activity_id", "string"),
                ("user_id", "string"),
                ("user_name", "string"),
                ("activity_type", "string"),
                ("page_url", "string"),
                ("session_duration", "int"),
                ("timestamp", "timestamp_ntz"),
                ("device_info", "string"),
                ("location", "string"),
                ("data_type", "string"),
                ("batch_id", "string"),
                ("kafka_timestamp", "timestamp_ntz"),
            ),
            key=("activity_id",),
            not_null=("activity_id",),
        ),
        Contract(
            "raw_sensors",
            (
                ("sensor_id", "string"),
                ("sensor_type", "string"),
                ("sensor_location", "string"),
                ("timestamp", "timestamp_ntz"),
                ("value", "decimal(10,3)"),
                ("unit", "string"),
                ("status", "string"),
                ("battery_level", "int"),
                ("signal_strength", "int"),
                ("data_type", "string"),
                ("batch_id", "string"),
                ("kafka_timestamp", "timestamp_ntz"),
            ),
            key=("sensor_id", "timestamp"),
        ),
    ]
}

# mergeable sketches of an hour's users, for counts over any range
CONTRACTS["hourly_user_sketches"] = Contract(
    "hourly_user_sketches", (("hour", "timestamp_ntz"), ("users", "binary"), ("events", "bigint")), key=("hour",), not_null=("hour",)
)
# the same table with the real anomaly count
CONTRACTS["hourly_metrics_ext"] = replace(CONTRACTS["hourly_metrics"], name="hourly_metrics_ext")


def _cast(col: Column, dtype: str) -> Column:
    """ANSI-safe cast: a value that does not fit, or a text that is no time,
    gives NULL, which ``lossy_flag`` then finds.  Timestamps are session-zone
    (UTC) instants; the tables store UTC wall-clock time without a zone."""
    return col.try_cast(dtype)


def conform(df: DataFrame, contract: Contract | str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select the contract's columns in order, cast to the declared types."""
    c = CONTRACTS[contract] if isinstance(contract, str) else contract
    return df.select([_cast(F.col(name), dtype).alias(name) for name, dtype in c.columns] + [F.col(k) for k in keep])


def lossy_flag(contract: Contract | str) -> Column:
    """TRUE when a declared cast turns a non-NULL value into NULL or a NOT
    NULL column is NULL."""
    c = CONTRACTS[contract] if isinstance(contract, str) else contract
    lost = [
        (F.col(name).isNotNull() & _cast(F.col(name), dtype).isNull())
        for name, dtype in c.columns
    ] + [F.col(name).isNull() for name in c.not_null]
    return F.greatest(*[x.cast("int") for x in lost]) > 0


def split_lossy(df: DataFrame, contract: Contract | str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) rows by ``lossy_flag``; good rows conformed, with
    the columns ``keep`` behind those of the contract."""
    c = CONTRACTS[contract] if isinstance(contract, str) else contract
    flagged = df.withColumn("_lossy", lossy_flag(c))
    good = conform(flagged.filter(~F.col("_lossy")), c, keep)
    bad = flagged.filter(F.col("_lossy")).drop("_lossy")
    return good, bad
