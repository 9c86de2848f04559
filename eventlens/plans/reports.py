"""Reporting queries (D1-D28) and their post-processing (K1-K5).

Each report takes a ``tables`` object with ``table(name) -> DataFrame``
(a lazy ``Pipeline`` or stored ``Tables``) and returns a DataFrame.  The
sort orders of the panels are kept; top-k panels break ties on the table
key so their output is stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import kpi_band, severity_rank
from ..functions.lookups import ANOMALY_STATUSES


def _t(tables, name) -> DataFrame:
    return tables.table(name)


# -- transaction panels -----------------------------------------------------

def rpt_amount_by_hour(tables) -> DataFrame:  # D1
    return _t(tables, "transaction_hourly_stats").select(
        F.col("window_start").alias("time"), "total_amount"
    ).orderBy("time")


def rpt_amount_by_city(tables) -> DataFrame:  # D2
    return (
        _t(tables, "transaction_hourly_stats")
        .groupBy("user_city")
        .agg(F.sum("total_amount").alias("total"))
        .orderBy(F.desc("total"))
    )


def rpt_amount_by_category(tables) -> DataFrame:  # D3
    return (
        _t(tables, "transaction_hourly_stats")
        .groupBy("transaction_category")
        .agg(F.sum("total_amount").alias("total"))
    )


def rpt_top10_users(tables) -> DataFrame:  # D4: top-k, a user may repeat
    return (
        _t(tables, "top_users")
        .orderBy(F.desc("total_spent"), "window_start", "user_id", "user_name", "user_city")
        .limit(10)
        .select("user_name", "user_city", "total_spent", "transaction_count")
    )


def rpt_count_by_payment(tables) -> DataFrame:  # D8
    return (
        _t(tables, "payment_method_stats")
        .groupBy("payment_method")
        .agg(F.sum("transaction_count").alias("count"))
        .orderBy(F.desc("count"))
    )


# -- activity panels --------------------------------------------------------

def rpt_total_activities(tables) -> DataFrame:  # D5
    return _t(tables, "activity_stats").agg(F.sum("activity_count").alias("total_activities"))


def rpt_avg_session(tables) -> DataFrame:  # D6: mean of window means
    return _t(tables, "activity_stats").agg(F.avg("avg_session_duration").alias("avg_duration"))


def rpt_activities_by_type(tables) -> DataFrame:  # D24
    return (
        _t(tables, "activity_stats")
        .groupBy("activity_type")
        .agg(F.sum("activity_count").alias("total_activities"))
        .orderBy(F.desc("total_activities"))
    )


def rpt_avg_session_monitoring(tables) -> DataFrame:  # D27
    return _t(tables, "activity_stats").agg(F.avg("avg_session_duration").alias("avg_session"))


# -- sensor panels ----------------------------------------------------------

def rpt_latest_anomalies(tables) -> DataFrame:  # D7: latest 20 rows
    return (
        _t(tables, "sensor_anomalies")
        .orderBy(F.desc("window_start"), "sensor_id", "status", "sensor_type", "sensor_location")
        .limit(20)
        .select(
            "sensor_id",
            "sensor_type",
            "sensor_location",
            "status",
            "avg_value",
            "reading_count",
            "window_start",
        )
    )


def rpt_anomaly_total(tables) -> DataFrame:  # D22
    return (
        _t(tables, "sensor_anomalies")
        .filter(F.col("status").isin(*ANOMALY_STATUSES))
        .agg(F.count(F.lit(1)).alias("total_anomalies"))
    )


def rpt_mean_signal(tables) -> DataFrame:  # D23, answered by the extended table
    return _t(tables, "sensor_anomalies_ext").agg(F.avg("signal_strength").alias("avg_signal"))


def rpt_anomalies_by_type(tables) -> DataFrame:  # D25
    return (
        _t(tables, "sensor_anomalies")
        .filter(F.col("status").isin(*ANOMALY_STATUSES))
        .groupBy("sensor_type")
        .agg(F.count(F.lit(1)).alias("anomaly_count"))
    )


def rpt_battery_over_time(tables) -> DataFrame:  # D26, answered by the extended table
    return _t(tables, "sensor_anomalies_ext").select(
        F.col("window_start").alias("time"), "sensor_id", "battery_level"
    ).orderBy("time")


def rpt_unique_sensors(tables) -> DataFrame:  # D28
    return _t(tables, "sensor_anomalies").agg(F.count_distinct("sensor_id").alias("unique_sensors"))


# -- hourly panels ----------------------------------------------------------

def _hourly(tables, col) -> DataFrame:
    return _t(tables, "hourly_metrics").select(F.col("hour").alias("time"), col).orderBy("time")


def rpt_tx_by_hour(tables) -> DataFrame:  # D9
    return _hourly(tables, "total_transactions")


def rpt_total_by_hour(tables) -> DataFrame:  # D10
    return _hourly(tables, "total_amount")


def rpt_active_users_by_hour(tables) -> DataFrame:  # D11
    return _hourly(tables, "active_users")


def rpt_avg_amount_by_hour(tables) -> DataFrame:  # D12
    return _hourly(tables, "avg_transaction_amount")


def rpt_all_transactions(tables) -> DataFrame:  # D13
    return _t(tables, "hourly_metrics").agg(F.sum("total_transactions").alias("total_all_transactions"))


def rpt_all_amount(tables) -> DataFrame:  # D14
    return _t(tables, "hourly_metrics").agg(F.sum("total_amount").alias("total_all_amount"))


def rpt_mean_active_users(tables) -> DataFrame:  # D15
    return _t(tables, "hourly_metrics").agg(F.avg("active_users").alias("avg_active_users"))


def rpt_mean_amount(tables) -> DataFrame:  # D16
    return _t(tables, "hourly_metrics").agg(
        F.avg("avg_transaction_amount").alias("avg_transaction_amount")
    )


# -- device panels ----------------------------------------------------------

def rpt_tx_by_device(tables) -> DataFrame:  # D17
    return (
        _t(tables, "device_stats")
        .groupBy("device_type")
        .agg(F.sum("transaction_count").alias("total_transactions"))
        .orderBy(F.desc("total_transactions"))
    )


def rpt_success_by_device(tables) -> DataFrame:  # D18
    return (
        _t(tables, "device_stats")
        .groupBy("device_type")
        .agg(F.avg("success_rate").alias("avg_success_rate"))
        .orderBy(F.desc("avg_success_rate"))
    )


def rpt_success_over_time(tables) -> DataFrame:  # D19
    return _t(tables, "device_stats").select(
        F.col("window_start").alias("time"), "device_type", "success_rate"
    ).orderBy("time")


def rpt_device_total(tables) -> DataFrame:  # D20
    return _t(tables, "device_stats").agg(F.sum("transaction_count").alias("total_transactions"))


def rpt_mean_success(tables) -> DataFrame:  # D21
    return _t(tables, "device_stats").agg(F.avg("success_rate").alias("avg_success_rate"))


REPORTS = {
    name: fn
    for name, fn in globals().items()
    if name.startswith("rpt_") and callable(fn)
}


def refresh(tables, out: str, names=None, concurrent_jobs: int = 8) -> dict[str, str]:
    """Run dashboard panels as concurrent Spark jobs, as a dashboard refresh
    does, and write each to ``<out>/<panel>``; returns the folders.  Some
    panels are series over all history, so none is gathered on the driver."""
    from concurrent.futures import ThreadPoolExecutor

    names = list(names or REPORTS)
    paths = {n: f"{out.rstrip('/')}/{n}" for n in names}
    plans = {n: REPORTS[n](tables) for n in names}
    with ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
        futures = [pool.submit(plans[n].write.mode("overwrite").parquet, paths[n]) for n in names]
        for f in futures:
            f.result()
    return paths


def rows(tables, name: str):
    """A panel's rows one by one, a partition at a time on the driver."""
    return REPORTS[name](tables).toLocalIterator()


# -- post-processing (K1-K5) -----------------------------------------------

def with_band(df: DataFrame, value_col: str, steps, name: str = "band") -> DataFrame:
    """K1: colour band of a KPI value."""
    return df.withColumn(name, kpi_band(F.col(value_col), steps))


def last_not_null(df: DataFrame, value_col: str, time_col: str = "time") -> DataFrame:
    """K2: the value at the latest time among rows where it is not NULL."""
    return df.filter(F.col(value_col).isNotNull()).agg(
        F.max_by(value_col, time_col).alias(value_col),
        F.max(time_col).alias(time_col),
    )


def pivot_wide(df: DataFrame, time_col: str, series_col: str, value_col: str, series: list[str]) -> DataFrame:
    """K3: long -> wide time series with one column per named series.
    The series values are given, so Spark plans the pivot without an extra
    distinct-values job."""
    return df.groupBy(time_col).pivot(series_col, series).agg(F.max(value_col))


def last_range(df: DataFrame, time_col: str, hours: int, anchor=None) -> DataFrame:
    """K4: rows with time > anchor - hours.  The anchor is an argument
    (default: the latest time in the data), never the wall clock."""
    limit_expr = F.expr(f"INTERVAL {int(hours)} HOURS")
    if anchor is None:
        # Scalar subquery: one aggregate job, no join and no driver round trip.
        latest = df.agg(F.max(time_col)).scalar()
        return df.filter(F.col(time_col) > latest - limit_expr)
    return df.filter(F.col(time_col) > F.lit(anchor) - limit_expr)


def by_severity(df: DataFrame, status_col: str = "status") -> DataFrame:
    """K5: severity rank (critical < warning < normal) as a sort key."""
    return df.withColumn("severity_rank", severity_rank(F.col(status_col))).orderBy(
        "severity_rank", F.desc("window_start")
    )
