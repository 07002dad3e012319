"""Time buckets on zone-free event time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(ts: Column | str, unit: str) -> Column:
    return F.date_trunc(unit, _col(ts)).cast(NTZ)


def day(ts: Column | str) -> Column:
    return _col(ts).cast("date")


def epoch_minute(ts: Column | str) -> Column:
    """Whole minutes since the epoch, the grain of sliding counters."""
    return F.floor(epoch_second(ts) / 60).cast("long")


def epoch_second(ts: Column | str) -> Column:
    return F.unix_seconds(_col(ts).cast("timestamp"))


def period_start(ts: Column | str, period: Column) -> Column:
    """Budget period: the day, the ISO week's Monday, otherwise the first of the month."""
    c = _col(ts)
    return (
        F.when(period == "daily", c.cast("date"))
        .when(period == "weekly", F.date_trunc("week", c).cast("date"))
        .otherwise(F.date_trunc("month", c).cast("date"))
    )


def latency_ms(given: Column, started: Column, ended: Column) -> Column:
    """The reported latency, or the distance between start and end when absent."""
    micros = F.unix_micros(ended.cast("timestamp")) - F.unix_micros(started.cast("timestamp"))
    return F.coalesce(given, micros / F.lit(1000.0))


def hours_between(later: Column, earlier: Column) -> Column:
    seconds = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return seconds / F.lit(3_600_000_000.0)
