"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_time(text: Column) -> Column:
    """ISO-8601 text without zone -> TIMESTAMP in the session zone (UTC).

    ``try_to_timestamp`` keeps the non-ANSI behaviour of the producer era:
    junk, empty or NULL text gives NULL instead of failing the query.
    Accepts ``T`` or space separators, with or without fractional seconds.
    """
    return F.try_to_timestamp(text)


def iso_text(ts: Column, fraction: bool = False) -> Column:
    """TIMESTAMP -> ISO text as the producer writes it."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" if fraction else "yyyy-MM-dd'T'HH:mm:ss"
    return F.date_format(ts, pattern)


def hour_batch_id(ts: Column) -> Column:
    """Hour batch id ``batch_YYYYMMDD_HH`` of an event time (R2)."""
    return F.concat(F.lit("batch_"), F.date_format(ts, "yyyyMMdd_HH"))


def to_wall_clock(ts: Column) -> Column:
    """Session-zone instant -> zone-less wall-clock timestamp for tables."""
    return ts.cast("timestamp_ntz")
