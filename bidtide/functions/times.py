"""Event-time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SERVING_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def from_millis(millis: Column | str) -> Column:
    return F.timestamp_millis(millis)


def slice_start(time: Column, width_ms: int) -> Column:
    """Start (epoch ms) of the fixed-width slice ``time`` falls in."""
    ms = F.unix_millis(time)
    return ms - F.pmod(ms, F.lit(width_ms).cast("long"))


def serving_text(time: Column | str) -> Column:
    return F.date_format(time, SERVING_TIME_FORMAT)


def from_serving_text(text: Column | str) -> Column:
    return F.to_timestamp(text, SERVING_TIME_FORMAT)


def milliseconds(width_ms: int) -> Column:
    """A day-time interval literal of ``width_ms``; streaming joins recognise time bounds only as literals."""
    return F.expr(f"INTERVAL '{width_ms / 1000:.3f}' SECOND")
