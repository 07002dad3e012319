"""Trace, correlation, message and archive identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..catalogs import ARCHIVE_PREFIX, DATED_ARCHIVE_PREFIX, DEFAULT_ARCHIVE_PREFIX


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def last_header(headers: Column, key: str) -> Column:
    """Value of the last non-null header with this key, as text."""
    hits = F.filter(headers, lambda h: (h["key"] == key) & h["value"].isNotNull())
    return F.try_element_at(hits, F.lit(-1))["value"].cast("string")


def trace_from_header(traceparent: Column, trace_id: Column, parent_span_id: Column) -> tuple[Column, Column]:
    """(trace_id, parent_span_id), filled from `00-<32>-<16>-<flags>` only where empty."""
    parts = F.split(traceparent, "-", -1)
    valid = (F.size(parts) == 4) & (F.length(F.get(parts, 1)) == 32)
    return (
        F.coalesce(_filled(trace_id), F.when(valid, F.get(parts, 1)), trace_id),
        F.coalesce(_filled(parent_span_id), F.when(valid, F.get(parts, 2)), parent_span_id),
    )


def correlation_id(given: Column, event_id: Column) -> Column:
    """A well-formed id is reused; otherwise one is derived from the event id."""
    ok = given.rlike("^CORR_[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    digest = F.sha2(event_id, 256)
    pieces = [F.substring(digest, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(ok, given).otherwise(F.concat(F.lit("CORR_"), F.concat_ws("-", *pieces)))


def stable_event_id(event_id: Column, *parts: Column) -> Column:
    """The given id, or one derived from the message so that a replay gets the same."""
    return F.coalesce(event_id, F.sha2(F.concat_ws("|", *parts), 256))


def message_key(key: Column, correlation: Column, event_id: Column) -> Column:
    return F.coalesce(_filled(key), _filled(correlation), event_id)


def archive_prefix(field: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ARCHIVE_PREFIX.items() for x in pair])
    return F.coalesce(F.try_element_at(known, field), F.lit(DEFAULT_ARCHIVE_PREFIX))


def archive_key(field: Column, event_id: Column) -> Column:
    return F.concat(archive_prefix(field), F.lit("/"), event_id, F.lit("/"), field, F.lit(".txt"))


def dated_archive_key(event_type: Column, ts: Column, application: Column, correlation: Column) -> Column:
    """Partitioned layout; null for event types that are not archived."""
    known = F.create_map(*[F.lit(x) for pair in DATED_ARCHIVE_PREFIX.items() for x in pair])
    return F.concat(
        F.try_element_at(known, event_type),
        F.date_format(ts, "'/year='yyyy'/month='MM'/day='dd"),
        F.lit("/application_id="), F.coalesce(application, F.lit("unknown")),
        F.lit("/correlation_id="), F.coalesce(correlation, F.lit("unknown")),
        F.lit("/"), F.lower(event_type), F.lit(".json"),
    )
