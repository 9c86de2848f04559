"""eventlens: typed JSON event ingestion, event-time windowed aggregates,
idempotent result tables and reporting queries on Apache Spark.

Every aggregate is declared once (``operators.aggregates``) and runs as a
batch DataFrame or as a Structured Streaming query in append mode.
"""

__all__ = ["session", "schemas", "contracts"]
