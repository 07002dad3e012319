"""Contract validation of raw JSON messages: typed envelope plus a list of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract
from ..functions import ids
from ..session import computed_once

STAGE = "stage1-validate"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_BROKEN = "_refused"
_VOCABULARIES = {
    "event_type": contract.EVENT_TYPES,
    "service_name": contract.SERVICE_NAMES,
    "telemetry_type": contract.TELEMETRY_TYPES,
}


def _violation(field: str, wanted: str, rule: str, vocabularies: dict[str, list[str]]) -> str:
    """SQL for the first broken rule of a member. Its kind is VOID for JSON null, NULL when absent."""
    kind, text = f"_read.kinds.{field}", f"_read.texts.{field}"
    number = f"({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT', 'BOOLEAN') OR startswith({kind}, 'DECIMAL'))"
    well_typed = {
        "string": f"{kind} = 'STRING'",
        "object": f"startswith({kind}, 'OBJECT')",
        "number": f"{number} OR ({kind} = 'STRING' AND try_cast(trim({text}) AS double) IS NOT NULL)",
        # Whole numbers, also as text.
        "integer": f"({number} AND try_cast({text} AS double) = floor(try_cast({text} AS double)))"
                   f" OR ({kind} = 'STRING' AND {text} RLIKE '^[ ]*[+-]?[0-9]+([.]0*)?[ ]*$')",
    }[wanted]
    null_ok = f" AND {kind} <> 'VOID'" if rule == "optional" else ""
    arms = [f"WHEN {kind} IS NULL THEN '{field}: missing'"] if rule == "required" else []
    arms.append(f"WHEN {kind} IS NOT NULL{null_ok} AND NOT ({well_typed}) THEN '{field}: must be {wanted}'")
    if field in vocabularies:
        known = ", ".join(f"'{v}'" for v in vocabularies[field])
        arms.append(f"WHEN {kind} = 'STRING' AND {text} NOT IN ({known}) THEN '{field}: not in vocabulary'")
    return f"CASE {' '.join(arms)} END"


def validate(raw: DataFrame, event_types: list[str] | None = None, strict: bool = False,
             now: Column | None = None) -> DataFrame:
    """Parse `value` and check it against the contract.

    Adds the typed envelope columns, `payload` as map<string,variant>, and `violations`: an empty
    array marks a good message. `strict` also requires correlation_id and a known status.
    """
    vocabularies = {**_VOCABULARIES, "event_type": event_types or contract.EVENT_TYPES}
    if strict:
        vocabularies["status"] = contract.STRICT_STATUSES
    rules = [
        (f, k, "required" if strict and f == "correlation_id" else r) for f, k, r in contract.ENVELOPE_RULES
    ]
    body = F.col("value").cast("string")
    # Members are read as variants: that keeps a JSON null, a number and a numeric text apart, which
    # plain typed columns would not.
    members = ", ".join(f"{f} variant" for f, _, _ in rules) + f", {_BROKEN} string"
    document = computed_once(raw, _doc=F.from_json(
        body, members, {"columnNameOfCorruptRecord": _BROKEN, "allowSingleQuotes": "false"}))
    kinds = ", ".join(f"'{f}', schema_of_variant(_doc.{f})" for f, _, _ in rules)
    texts = ", ".join(f"'{f}', try_cast(_doc.{f} AS string)" for f, kind, _ in rules if kind != "object")
    parsed = computed_once(document, _read=F.expr(
        f"named_struct('kinds', named_struct({kinds}), 'texts', named_struct({texts}))"))
    # Only what the member reader refused is parsed a second time, to tell why.
    # The readers stop after the first value, so text behind it is looked for by counting values.
    one_value = F.coalesce(F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1, F.lit(False))
    one_value = one_value & F.is_valid_utf8(body)
    refused = F.col("_doc").isNull() | F.col(f"_doc.{_BROKEN}").isNotNull() | ~one_value
    other_json = one_value & F.try_parse_json(body).isNotNull()
    found = F.expr(f"array_compact(array({', '.join(_violation(f, k, r, vocabularies) for f, k, r in rules)}))")
    checked = computed_once(parsed, violations=(
        F.when(refused, F.array(F.when(other_json, "contract violation: not an object").otherwise("not JSON")))
        .otherwise(F.transform(found, lambda v: F.concat(F.lit("contract violation: "), v)))
    ))
    now = F.current_timestamp() if now is None else now
    now_text = F.date_format(now, TIME_FORMAT)
    origin = [F.col(c).cast("string") for c in ("value", "topic", "partition", "offset") if c in raw.columns]

    def text(f: str) -> Column:
        return F.col(f"_read.texts.{f}")

    values = {
        "event_id": ids.stable_event_id(text("event_id"), *origin),
        "schema_version": F.coalesce(text("schema_version"), F.lit(contract.SCHEMA_VERSION)),
        "telemetry_type": F.coalesce(text("telemetry_type"), F.lit("event")),
        "timestamp": F.coalesce(text("timestamp"), now_text),
        "emitted_at": F.coalesce(text("emitted_at"), now_text),
        "latency_ms": F.trim(text("latency_ms")).try_cast("double"),
        "http_status": F.trim(text("http_status")).try_cast("double").cast("int"),
    }
    envelope = [values.get(f, text(f)).alias(f) for f, _ in contract.ENVELOPE_FIELDS]
    names = {f for f, _ in contract.ENVELOPE_FIELDS} | {"payload", "violations"}
    carried = [F.col(c).alias(f"source_{c}") if c in names else F.col(c) for c in raw.columns]
    payload = F.coalesce(
        F.when(F.col("_read.kinds.payload").startswith("OBJECT"), F.col("_doc.payload").try_cast("map<string,variant>")),
        F.expr("CAST(map() AS map<string,variant>)"))
    return checked.select(*carried, *envelope, payload.alias("payload"), "violations")


def good(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("violations") == 0).drop("violations")


def dead_letters(validated: DataFrame, now: Column | None = None) -> DataFrame:
    """Quarantined messages as (key, value): value is JSON {reason, failed_at, original}."""
    now = F.current_timestamp() if now is None else now
    bad = validated.where(F.size("violations") > 0)
    body = F.make_valid_utf8(F.col("value").cast("string"))
    fallback = F.to_json(F.struct(body.alias("_unparseable")))
    parsed = F.try_parse_json(body)
    original = F.coalesce(parsed, F.try_parse_json(fallback))
    reason = F.concat(F.lit(f"{STAGE}: "), F.concat_ws("; ", "violations"))
    record = F.to_json(F.struct(
        reason.alias("reason"),
        F.date_format(now, TIME_FORMAT).alias("failed_at"),
        original.alias("original"),
    ))
    key = F.col("key") if "key" in validated.columns else F.lit(None).cast("string")
    return bad.select(key.alias("key"), record.alias("value"))


def reason_stage(reason: Column) -> Column:
    """The stage label in front of a quarantine reason."""
    return F.split_part(reason, F.lit(":"), F.lit(1))


def replay(dead: DataFrame, reason_contains: str | None = None, limit: int | None = None) -> DataFrame:
    """Dead letters back as raw messages (key, value, headers); broken wrappers are skipped."""
    doc = dead.withColumn("_w", F.try_parse_json(F.col("value").cast("string"))).withColumns({
        "_reason": F.expr("coalesce(try_variant_get(_w, '$.reason', 'string'), '')"),
        "_orig": F.expr("try_variant_get(_w, '$.original', 'variant')"),
    }).where(F.expr("schema_of_variant(_orig)").startswith("OBJECT"))
    if reason_contains:
        doc = doc.where(F.contains("_reason", F.lit(reason_contains)))
    if limit:  # the oldest letters first, ties by content
        doc = doc.orderBy(F.expr("coalesce(try_variant_get(_w, '$.failed_at', 'string'), '')"), "value").limit(limit)
    part = lambda f: F.expr(f"try_variant_get(_orig, '$.{f}', 'string')")
    header = F.struct(F.lit("dlq_replayed").alias("key"), F.lit("true").cast("binary").alias("value"))
    return doc.select(
        F.coalesce(F.nullif(part("correlation_id"), F.lit("")), part("event_id"), F.lit("")).alias("key"),
        F.to_json("_orig").alias("value"),
        F.array(header).alias("headers"),
        F.col("_reason").alias("reason"),
    )


def request_outcome(http_status: Column) -> Column:
    return F.when(http_status >= 500, "failed").otherwise("success")


def without_operational_paths(requests: DataFrame, path: str = "path") -> DataFrame:
    return requests.where(~F.coalesce(F.col(path).isin(contract.OPERATIONAL_PATHS), F.lit(False)))


def known_feedback_type(feedback_type: Column, vocabulary: list[str] | None = None) -> tuple[Column, Column]:
    """(type with unknown ones as 'other', flag that it was unknown)."""
    unknown = ~F.coalesce(feedback_type.isin(vocabulary or contract.FEEDBACK_TYPES), F.lit(False))
    return F.when(unknown, "other").otherwise(feedback_type), unknown
