"""Report post-processing on columns: KPI bands (K1) and severity order (K5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Threshold steps of the report panels, (colour, lower bound);
# the first step is the base band with no lower bound.
KPI_STEPS = {
    "total_anomalies": [("green", None), ("orange", 10), ("red", 50)],
    "avg_signal": [("red", None), ("orange", 2), ("green", 4)],
    "avg_session_monitoring": [("blue", None), ("green", 300), ("red", 1200)],
    "unique_sensors": [("blue", None), ("green", 50), ("red", 200)],
    "total_activities": [("blue", None), ("green", 1000), ("red", 5000)],
    "avg_duration": [("blue", None), ("green", 500), ("red", 1500)],
    "top_user_spend": [("green", None), ("orange", 100000), ("red", 500000)],
    "total_all_transactions": [("blue", None), ("green", 1000), ("red", 5000)],
    "total_all_amount": [("blue", None), ("green", 100000), ("red", 500000)],
    "avg_active_users": [("blue", None), ("green", 50), ("red", 200)],
    "avg_transaction_amount": [("blue", None), ("green", 1000), ("red", 5000)],
    "device_total_transactions": [("blue", None), ("green", 1000), ("red", 5000)],
    # Listed 90 before 70 on the panel; bands are taken in ascending order.
    "avg_success_rate": [("blue", None), ("green", 90), ("red", 70)],
}

# Display order of sensor statuses.
SEVERITY = {"critical": 0, "warning": 1, "normal": 2}


def kpi_band(value: Column, steps) -> Column:
    """Colour of the highest step whose lower bound is <= value.

    Steps are sorted by bound, so a list given out of order behaves as the
    panel does.  NULL value -> NULL band.
    """
    if isinstance(steps, str):
        steps = KPI_STEPS[steps]
    base = [c for c, b in steps if b is None]
    bounded = sorted(((b, c) for c, b in steps if b is not None), reverse=True)
    expr = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, colour in bounded:
        expr = expr.when(value >= F.lit(bound), F.lit(colour))
    return expr.otherwise(F.lit(base[0] if base else None))


def severity_rank(status: Column) -> Column:
    expr = None
    for name, rank in SEVERITY.items():
        expr = F.when(status == name, rank) if expr is None else expr.when(status == name, rank)
    return expr.otherwise(F.lit(len(SEVERITY)))
