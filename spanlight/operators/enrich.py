"""The enrichment stages over validated events, as one chain of column expressions and small joins."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import catalogs
from ..functions import ids, money, sampling, text
from ..contract import ENVELOPE_FIELDS, TERMINAL_REQUEST_EVENTS
from ..session import computed_once, small_side
from . import budget, lookups, rule_index

VARIANT_MAP = "map<string,variant>"


@dataclass
class Dimensions:
    """What enrichment looks up. Every table may be missing; its stage is then skipped."""

    apps: DataFrame | None = None
    prices: DataFrame | None = None
    # A list, or a table of any size (`catalogs.error_rules_from_table`), for which each batch is gone through twice.
    rules: list[catalogs.ErrorRule] | DataFrame = field(default_factory=list)


@dataclass
class Settings:
    redact_max_chars: int | None = None
    redact_exclude: tuple[str, ...] = ()
    archive_threshold_bytes: int = catalogs.ARCHIVE_THRESHOLD_BYTES
    archive_fields: tuple[str, ...] = tuple(catalogs.ARCHIVE_FIELDS)
    archive_root: str | None = None  # where the bodies are stored; without it every text stays in its event
    quality_sample_pct: float = 5.0


def payload_text(key: str) -> Column:
    return F.col("payload")[key].try_cast("string")


def payload_as(key: str, sql_type: str) -> Column:
    return F.col("payload")[key].try_cast(sql_type)


def is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def redacted_payload(settings: Settings) -> Column:
    """Payload with every top-level text redacted; the envelope's user_id is not part of it."""
    excluded = F.array(*[F.lit(k) for k in settings.redact_exclude]).cast("array<string>")

    def clean(k: Column, v: Column) -> Column:
        redacted = text.redact(v.cast("string"), settings.redact_max_chars)
        return F.when(is_text(v) & ~F.array_contains(excluded, k), redacted.cast("variant")).otherwise(v)

    return F.transform_values("payload", clean)


def put_all(events: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Set payload keys in one rewrite; a null value leaves its key as it was."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("variant").alias("value")) for k, v in values.items()])
    new = F.filter(entries, lambda e: e["value"].isNotNull())
    named = computed_once(events, _new=new)
    named = computed_once(named, _names=F.transform("_new", lambda e: e["key"]))
    kept = F.map_filter("payload", lambda k, _: ~F.array_contains("_names", k))
    # Readers of several keys would each rebuild the map.
    return computed_once(named, payload=F.map_concat(kept, F.map_from_entries("_new"))).drop("_new", "_names")


def hash_prompts(events: DataFrame, field: str = "prompt_text") -> DataFrame:
    """Raw prompt text leaves the payload; its hash stays under `prompt_hash`."""
    hashed = put_all(events, {"prompt_hash": F.when(is_text(F.col("payload")[field]), text.short_hash(payload_text(field)))})
    return hashed.withColumn("payload", F.map_filter("payload", lambda k, _: k != field))


def oversized(events: DataFrame, settings: Settings) -> DataFrame:
    """Side table (archive_key, event_id, field, body) of payload texts beyond the threshold."""
    fields = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.when(is_text(F.col("payload")[f]), payload_text(f)).alias("body"))
        for f in settings.archive_fields
    ]))
    return (
        events.select("event_id", fields.alias("_f")).select("event_id", "_f.field", "_f.body")
        .where(F.octet_length("body") > settings.archive_threshold_bytes)
        .select(ids.archive_key(F.col("field"), F.col("event_id")).alias("archive_key"), "event_id", "field", "body",
                ids.archive_prefix(F.col("field")).alias("prefix"))
    )


def pointer_values(settings: Settings) -> dict[str, Column]:
    """Pointers into the archive for oversized payload texts, and their size in bytes; none without an archive."""
    if not settings.archive_root:
        return {}
    updates: dict[str, Column] = {}
    for f in settings.archive_fields:
        body = F.when(is_text(F.col("payload")[f]), payload_text(f))
        large = F.octet_length(body) > settings.archive_threshold_bytes
        pointer = F.concat(F.lit(settings.archive_root.rstrip("/") + "/"), ids.archive_key(F.lit(f), F.col("event_id")))
        updates[f] = F.when(large, pointer)
        updates[f"{f}_bytes"] = F.when(large, F.octet_length(body))
    return updates


def enrich(valid: DataFrame, dims: Dimensions, settings: Settings | None = None, now: Column | None = None) -> DataFrame:
    """The stages in their fixed order: trace, redact, metadata, errors, cost, archive, sample.

    No stage can lose an event: lookups are left joins and all casts are try-casts. A stage whose
    input was unusable is named in `stage_errors` and leaves its part of the event as it was: a broken trace
    header, a text left unredacted for its length, unreadable token counts, a bulky payload value that is no text,
    a negative latency. Lookup and error rules have no such case: what they do not know they leave alone.
    """
    settings = settings or Settings()
    out, carried = valid, [*valid.columns, "stage_errors"]
    header = ids.last_header(F.col("headers"), "traceparent") if "headers" in valid.columns else F.lit(None).cast("string")
    trace, parent = ids.trace_from_header(header, F.col("trace_id"), F.col("parent_span_id"))
    out = out.withColumns({"trace_id": trace, "parent_span_id": parent})
    out = computed_once(out, payload=redacted_payload(settings))
    out = computed_once(
        out, error_message=payload_text("error_message"), model_name=payload_text("model_name"),
        input_tokens=payload_as("input_tokens", "bigint"), output_tokens=payload_as("output_tokens", "bigint"),
        event_date=F.to_date(F.try_to_timestamp("timestamp")),
    )
    unreadable_tokens = F.lit(False)
    for side in ("input_tokens", "output_tokens"):
        present = F.map_contains_key("payload", F.lit(side)) & (F.schema_of_variant(F.col("payload")[side]) != "VOID")
        unreadable_tokens = unreadable_tokens | (F.coalesce(present, F.lit(False)) & F.col(side).isNull())
    payload, archives = F.col("payload"), settings.archive_root is not None
    bulky = [~is_text(payload[f]) & (F.octet_length(F.to_json(payload[f])) > settings.archive_threshold_bytes) for f in settings.archive_fields]
    too_long = F.lit(False) if settings.redact_max_chars is None else F.exists(
        F.map_values("payload"), lambda v: is_text(v) & (F.length(v.try_cast("string")) > settings.redact_max_chars))
    problems = {
        "stage2-trace": F.size(F.split(header, "-", -1)) != 4,
        "stage3-pii": too_long,
        "stage6-cost": F.col("event_type").startswith("LLM_") & unreadable_tokens,
        "stage7-s3": lookups.any_of([F.coalesce(b, F.lit(False)) for b in bulky]) if archives else F.lit(False),
        "stage8-slo": F.col("event_type").isin(TERMINAL_REQUEST_EVENTS) & F.col("application_id").isNotNull() & (F.col("latency_ms") < 0),
    }
    problems = {name: F.coalesce(c, F.lit(False)) for name, c in problems.items()}
    out = out.withColumn("stage_errors", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in problems.items()])))
    updates: dict[str, Column] = {}
    if dims.apps is not None:
        out = lookups.with_registry(out, dims.apps)
        # An event without an application is not looked up, so nothing is said about it.
        known = F.when(F.nullif("application_id", F.lit("")).isNotNull(), F.col("app_registered"))
        updates |= {
            "usecase_id": F.when(known & ~F.map_contains_key("payload", F.lit("usecase_id")), F.col("usecase_id")),
            "app_owner_team": F.when(known, F.col("app_owner_team")),
            "app_criticality": F.when(known, F.col("app_criticality")),
            "app_registered": F.when(~known, F.lit(False)),
        }
    if dims.rules is not None and (isinstance(dims.rules, DataFrame) or dims.rules):
        out = rule_index.with_error_code(out, dims.rules) if isinstance(dims.rules, DataFrame) else lookups.with_error_code(out, dims.rules)
        updates |= {c: F.col(c) for c in ("raw_error_code", "error_category", "error_retryable")}
    if dims.prices is not None:
        out = lookups.with_prices(out, dims.prices)
        cost = money.token_cost(*[F.col(c) for c in ("input_tokens", "output_tokens", "input_usd_per_1k", "output_usd_per_1k")])
        applies = F.col("event_type").startswith("LLM_") & F.col("input_usd_per_1k").isNotNull() & (
            F.col("input_tokens").isNotNull() | F.col("output_tokens").isNotNull())
        updates |= {"estimated_cost_usd": F.when(applies, cost), "cost_source": F.when(applies, "control_plane")}
    updates |= pointer_values(settings)
    picked = sampling.quality_sample(F.col("event_type"), F.col("status"), F.col("event_id"), settings.quality_sample_pct)
    updates["quality_sample"] = F.when(picked, F.lit(True))
    if now is not None:
        updates["enriched_at"] = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return put_all(out, updates).select(*carried)


def charged(enriched: DataFrame) -> DataFrame:
    """What an enriched event costs, as the budgets count it."""
    return enriched.where(F.col("event_type").startswith("LLM_")).select(
        "event_id", F.try_to_timestamp("timestamp").cast("timestamp_ntz").alias("event_ts"), "application_id",
        payload_text("model_name").alias("model_name"), payload_as("estimated_cost_usd", "decimal(28,8)").alias("cost_usd"))


def with_budget_flags(enriched: DataFrame, limits: DataFrame, opening: DataFrame | None = None, unique: bool = False) -> DataFrame:
    """Events on which a limit's alert share or cap was reached carry `budget_alert` and `budget_cap_breached`."""
    flags = budget.flags(charged(enriched), limits, opening, unique)
    joined = enriched.join(small_side(flags), "event_id", "left")
    return put_all(joined, {
        "budget_alert": F.when(F.col("budget_alert").isNotNull(), F.to_variant_object("budget_alert")),
        "budget_cap_breached": F.when(F.col("budget_cap_breached"), F.lit(True)),
    }).select(*enriched.columns)


def stage_error_rows(enriched: DataFrame) -> DataFrame:
    """(event_id, event_ts, application_id, stage): one row per stage an event was unusable for."""
    return enriched.select("event_id", F.try_to_timestamp("timestamp").cast("timestamp_ntz").alias("event_ts"), "application_id",
                           F.explode("stage_errors").alias("stage"))


def to_message(enriched: DataFrame) -> DataFrame:
    """Processed messages: key, JSON value, headers."""
    key = F.col("key").cast("string") if "key" in enriched.columns else F.lit(None).cast("string")
    columns = [F.col(f) for f, _ in ENVELOPE_FIELDS] + [F.col("payload")]
    headers = [F.col("headers")] if "headers" in enriched.columns else []
    return enriched.select(
        ids.message_key(key, F.col("correlation_id"), F.col("event_id")).alias("key"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"),
        *headers,
    )
