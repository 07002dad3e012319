"""Queries over validation, enrichment stages, registries and prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import catalogs, contract
from ..functions import ids, money, sampling, text, times
from ..operators import enrich, lookups, rule_index, store, validate
from .registry import Context, query
from .reliability import _matched

_T = ", ".join(f"'{t}'" for t in contract.EVENT_TYPES)
_S = ", ".join(f"'{s}'" for s in contract.SERVICE_NAMES)

# The contract's rules in SQL: one boolean per violation the derived messages can contain.
_BROKEN = {
    "event_id": "json_type(value, '$.event_id') IS NOT NULL AND json_type(value, '$.event_id') <> 'VARCHAR'",
    "event_type": f"json_type(value, '$.event_type') IS NULL OR json_extract_string(value, '$.event_type') NOT IN ({_T})",
    "telemetry_type": "json_type(value, '$.telemetry_type') IS NOT NULL AND json_extract_string(value, '$.telemetry_type') NOT IN ('event', 'log', 'metric')",
    "service_name": f"json_type(value, '$.service_name') = 'NULL' OR json_extract_string(value, '$.service_name') NOT IN ({_S})",
    "application_id": "json_type(value, '$.application_id') NOT IN ('VARCHAR', 'NULL')",
    "status": "json_type(value, '$.status') IS NULL",
    "latency_ms": "json_type(value, '$.latency_ms') = 'VARCHAR' AND TRY_CAST(json_extract_string(value, '$.latency_ms') AS DOUBLE) IS NULL",
    "http_status": "json_type(value, '$.http_status') = 'DOUBLE'",
    "payload": "json_type(value, '$.payload') IS NOT NULL AND json_type(value, '$.payload') <> 'OBJECT'",
}
_COUNT = " + ".join(f"CAST(coalesce({c}, FALSE) AS INT)" for c in _BROKEN.values())
_GOOD = f"is_json AND root = 'OBJECT' AND ({_COUNT}) = 0"


@query("validate_messages", "B1", f"""
SELECT seq, CASE WHEN NOT is_json THEN 'not JSON' WHEN root <> 'OBJECT' THEN 'not an object'
                 WHEN ({_COUNT}) = 0 THEN 'good' ELSE 'contract violation' END AS outcome,
  CASE WHEN NOT is_json OR root <> 'OBJECT' THEN n(1) ELSE n({_COUNT}) END AS violations,
  CASE WHEN {_GOOD} THEN TRY_CAST(json_extract_string(value, '$.latency_ms') AS DOUBLE) END AS latency_ms
FROM raw_checked""")
def _(c: Context):
    v = c.validated
    first = F.get("violations", 0)
    outcome = (F.when(F.size("violations") == 0, "good").when(first == "not JSON", "not JSON")
               .when(first.endswith("not an object"), "not an object").otherwise("contract violation"))
    return v.select("seq", outcome.alias("outcome"), F.size("violations").alias("violations"),
                    F.when(F.size("violations") == 0, F.col("latency_ms")).alias("latency_ms"))


@query("violations_by_field", "B1 B2", "\nUNION ALL\n".join(
    f"SELECT '{f}' AS field, n(count(*)) AS messages FROM raw_checked WHERE is_json AND root = 'OBJECT' AND ({cond})"
    for f, cond in _BROKEN.items()))
def _(c: Context):
    fields = c.validated.select(F.explode("violations").alias("v")).where(F.col("v").contains(": "))
    fields = fields.withColumn("field", F.split_part("v", F.lit(": "), F.lit(2))).where("field <> 'not an object'")
    return fields.groupBy("field").agg(F.count(F.lit(1)).alias("messages"))


@query("strict_validation", "B12", f"""
SELECT CASE WHEN json_type(value, '$.status') IS NULL THEN 'missing' ELSE 'unknown' END AS status, n(count(*)) AS messages FROM raw_checked
WHERE is_json AND root = 'OBJECT' AND coalesce(json_extract_string(value, '$.status'), 'failed') = 'failed' GROUP BY ALL""")
def _(c: Context):
    odd = F.replace(F.col("value"), F.lit('"status":"failed"'), F.lit('"status":"odd"')).alias("value")
    checked = validate.validate(c.raw_events.select("seq", odd), strict=True)
    kinds = checked.select(F.explode("violations").alias("v")).where(F.col("v").contains(": status: "))
    return kinds.groupBy(F.when(F.col("v").endswith("missing"), "missing").otherwise("unknown").alias("status")).agg(
        F.count(F.lit(1)).alias("messages"))


@query("dead_letters_by_stage", "B2 S3 A31", f"""
SELECT 'stage1-validate' AS stage, CASE WHEN is_json AND root = 'OBJECT' THEN 'parsed' WHEN is_json THEN 'parsed' ELSE 'unparseable' END AS original_kind,
  n(count(*)) AS letters FROM raw_checked WHERE NOT coalesce({_GOOD}, FALSE) GROUP BY ALL""")
def _(c: Context):
    dead = validate.dead_letters(c.validated, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    doc = F.try_parse_json("value")
    reason = F.try_variant_get(doc, "$.reason", "string")
    lost = F.try_variant_get(doc, "$.original._unparseable", "string")
    return dead.groupBy(
        validate.reason_stage(reason).alias("stage"), F.when(lost.isNull(), "parsed").otherwise("unparseable").alias("original_kind")
    ).agg(F.count(F.lit(1)).alias("letters"))


@query("dead_letter_replay", "S4", """
SELECT CASE WHEN is_json THEN coalesce(nullif(json_extract_string(value, '$.correlation_id'), ''), '') ELSE '' END AS key, n(count(*)) AS messages
FROM raw_checked WHERE is_json AND root = 'OBJECT' AND coalesce(json_type(value, '$.payload'), 'OBJECT') <> 'OBJECT' GROUP BY ALL""")
def _(c: Context):
    dead = validate.dead_letters(c.validated, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return validate.replay(dead, "payload: must be object").groupBy("key").agg(F.count(F.lit(1)).alias("messages"))


@query("dead_letters_reprocessed", "S16", f"""
SELECT n(seq) AS dead_id, seq % 4 = 0 AS reprocessed,
  CASE WHEN seq % 4 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' END AS reprocessed_at
FROM raw_checked WHERE NOT coalesce({_GOOD}, FALSE)""")
def _(c: Context):
    dead = c.validated.where(F.size("violations") > 0).select(F.col("seq").alias("dead_id"))
    replayed = c.raw_events.where("seq % 4 = 0").select(
        F.col("seq").alias("dead_id"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("replayed_at"))
    return store.with_replay_state(dead, replayed)


# Good messages after enrichment, as the last of these tables.
_ENRICHED = f"""good AS (SELECT * FROM raw_checked WHERE {_GOOD}),
p AS (SELECT seq, json_extract_string(value, '$.event_type') AS event_type, json_extract_string(value, '$.status') AS status,
        json_extract_string(value, '$.application_id') AS application_id, json_extract_string(value, '$.payload.error_message') AS error_message,
        CAST(NULL AS VARCHAR) AS error_code, json_extract_string(value, '$.payload.model_name') AS model_name,
        CAST(json_extract_string(value, '$.payload.input_tokens') AS INT) AS input_tokens,
        CAST(json_extract_string(value, '$.payload.output_tokens') AS INT) AS output_tokens,
        CAST(substr(json_extract_string(value, '$.timestamp'), 1, 10) AS DATE) AS event_date, json_extract_string(value, '$.event_id') AS event_id FROM good),
e AS (SELECT o.seq, o.event_type, r.lob, r.owner_team AS app_owner_team,
  CASE WHEN o.status = 'failed' THEN CASE {" ".join(f"WHEN regexp_matches(concat(': ', coalesce(o.error_message, '')), '(?i){r.pattern}') THEN '{r.error_code}'" for r in catalogs.error_rules())} END END AS error_code,
  CASE WHEN o.event_type LIKE 'LLM\\_%' ESCAPE '\\' AND o.input_tokens IS NOT NULL THEN dbl(round((CAST(o.input_tokens AS DECIMAL(12,0)) * pr.input_usd_per_1k
     + CAST(o.output_tokens AS DECIMAL(12,0)) * pr.output_usd_per_1k) * CAST(0.001 AS DECIMAL(3,3)), 8)) END AS estimated_cost_usd,
  CASE WHEN o.model_name IS NOT NULL THEN 'mail [REDACTED:email] or [REDACTED:phone]' END AS note, o.event_id, o.model_name, o.application_id, o.event_date
FROM p o LEFT JOIN app_registry r ON o.application_id = r.application_id
ASOF LEFT JOIN prices pr ON o.model_name = pr.model_name AND o.event_date >= pr.effective_from)"""


@query("enriched_messages", "R1 R3 C16 J1 J4 J3 C6 W2", f"""
WITH {_ENRICHED},
enriched_spend AS (SELECT application_id, model_name, event_id, CAST(event_date AS TIMESTAMP) AS event_ts, CAST(estimated_cost_usd AS DECIMAL(28,8)) AS cost_usd FROM e WHERE estimated_cost_usd IS NOT NULL),
{_matched('budgets', 'enriched_spend')},
k AS (SELECT event_id, period, max_spend_usd, running, running >= line AND running - cost_usd < line AS alerts, running >= max_spend_usd AND running - cost_usd < max_spend_usd AS caps
  FROM (SELECT *, CAST(max_spend_usd * alert_at_pct AS DECIMAL(28,8)) * CAST(0.01 AS DECIMAL(3,2)) AS line FROM r)),
f AS (SELECT event_id, arg_max(period, (max_spend_usd, period)) FILTER (alerts) AS budget_alert_period, arg_max(dbl(running), (max_spend_usd, period)) FILTER (alerts) AS budget_alert_spend_usd,
  bool_or(caps) AS budget_cap_breached FROM k WHERE alerts OR caps GROUP BY event_id)
SELECT e.seq, e.event_type, e.lob, e.app_owner_team, e.error_code, e.estimated_cost_usd, e.note, f.budget_alert_period, f.budget_alert_spend_usd, coalesce(f.budget_cap_breached, FALSE) AS budget_cap_breached
FROM e LEFT JOIN f ON f.event_id = e.event_id""")
def _(c: Context):
    alert = F.col("payload")["budget_alert"]
    return enrich.with_budget_flags(c.enriched, c.budgets).select(
        "seq", "event_type", "lob", enrich.payload_text("app_owner_team").alias("app_owner_team"), "error_code",
        enrich.payload_as("estimated_cost_usd", "decimal(20,8)").alias("estimated_cost_usd"), enrich.payload_text("note").alias("note"),
        F.try_variant_get(alert, "$.period", "string").alias("budget_alert_period"), F.try_variant_get(alert, "$.spend_usd", "double").alias("budget_alert_spend_usd"),
        F.coalesce(enrich.payload_as("budget_cap_breached", "boolean"), F.lit(False)).alias("budget_cap_breached"))


@query("registry_context", "J1 S10", """
SELECT o.event_id, coalesce(nullif(o.lob, ''), r.lob) AS lob, r.usecase_id, r.owner_team AS app_owner_team, r.criticality AS app_criticality,
  r.application_id IS NOT NULL AS app_registered
FROM obs o LEFT JOIN app_registry r ON o.application_id = r.application_id""")
def _(c: Context):
    return lookups.with_registry(c.obs, c.app_registry).select(
        "event_id", "lob", "usecase_id", "app_owner_team", "app_criticality", "app_registered")


@query("agent_tool_context", "J2 W7", """
WITH a AS (SELECT * FROM agent_registry WHERE status = 'active' QUALIFY row_number() OVER (PARTITION BY agent_id ORDER BY agent_version DESC) = 1),
t AS (SELECT * FROM tool_registry WHERE status = 'active' QUALIFY row_number() OVER (PARTITION BY tool_id ORDER BY tool_version DESC) = 1)
SELECT o.event_id, a.agent_name, n(a.agent_version) AS agent_version, t.tool_name, n(t.sla_latency_ms) AS tool_sla_ms,
  CASE WHEN t.tool_id IS NOT NULL THEN coalesce(o.latency_ms > t.sla_latency_ms, FALSE) END AS sla_breached
FROM obs o LEFT JOIN a ON o.agent_id = a.agent_id LEFT JOIN t ON o.tool_id = t.tool_id""")
def _(c: Context):
    return lookups.with_agent_and_tool(c.obs, c.agent_registry, c.tool_registry).select(
        "event_id", "agent_name", "agent_version", "tool_name", "tool_sla_ms", "sla_breached")


@query("model_call_cost", "J3 C6", """
SELECT event_id, model_name, dbl(estimated_cost_usd) AS estimated_cost_usd, cost_source FROM costed WHERE event_type LIKE 'LLM%'""")
def _(c: Context):
    return c.costed.where("event_type LIKE 'LLM%'").select("event_id", "model_name", "estimated_cost_usd", "cost_source")


@query("producer_estimate", "C7", "SELECT event_id, dbl(CASE model_name " + " ".join(
    f"WHEN '{m}' THEN round((input_tokens * CAST({i} AS DECIMAL(12,8)) + output_tokens * CAST({o} AS DECIMAL(12,8))) * CAST(0.001 AS DECIMAL(3,3)), 8)"
    for m, i, o, _ in catalogs.MODEL_PRICES) + """ ELSE round((input_tokens * CAST(0.005 AS DECIMAL(12,8)) + output_tokens * CAST(0.015 AS DECIMAL(12,8))) * CAST(0.001 AS DECIMAL(3,3)), 8) END) AS estimate_usd,
  n(input_tokens + output_tokens) AS total_tokens FROM obs""")
def _(c: Context):
    i, o = F.col("input_tokens"), F.col("output_tokens")
    return c.obs.select("event_id", money.producer_estimate(F.col("model_name"), i, o).alias("estimate_usd"),
                        money.total_tokens(F.lit(None).cast("int"), i, o).alias("total_tokens"))


@query("error_normalisation", "J4 C9 T4", """
SELECT event_id, error_code, CASE WHEN rule_code IS NOT NULL AND rule_code IS DISTINCT FROM given_code THEN given_code END AS raw_error_code,
  error_category, error_retryable FROM full_events""")
def _(c: Context):
    return c.coded.select("event_id", "error_code", "raw_error_code", "error_category", "error_retryable")


@query("error_normalisation_indexed", "J4 T4", """
SELECT event_id, error_code, CASE WHEN rule_code IS NOT NULL AND rule_code IS DISTINCT FROM given_code THEN given_code END AS raw_error_code,
  error_category, error_retryable FROM full_events""")
def _(c: Context):
    """The seed and a rule for every supplier and part, by name and in last place, matched by the index."""
    cols = ["error_code", "category", "pattern", "priority", "retryable"]
    seed = c.spark.createDataFrame([(r.error_code, r.category, r.pattern, r.priority, r.retryable) for r in catalogs.error_rules()],
                                   "error_code string, category string, pattern string, priority int, retryable boolean")

    def named(t, name):
        return t.select(F.col(name).alias("error_code"), F.lit("named").alias("category"), F.concat(F.lit("failed for "), F.col(name), F.lit("[.!]?")).alias("pattern"),
                        F.lit(9999).alias("priority"), F.lit(False).alias("retryable"))

    rules = seed.unionByName(named(c.supplier, "s_name")).unionByName(named(c.part, "p_name").distinct())
    return rule_index.with_error_code(c.obs, rules.select(*cols)).select("event_id", "error_code", "raw_error_code", "error_category", "error_retryable")


@query("trace_context", "C1", """
SELECT event_id, CASE WHEN seq % 5 = 0 THEN 'given' WHEN seq % 3 = 0 THEN NULL ELSE repeat('a', 32) END AS trace_id,
  CASE WHEN seq % 3 = 0 THEN NULL ELSE concat('b', CAST(seq AS VARCHAR)) END AS parent_span_id FROM obs""")
def _(c: Context):
    header = F.when(F.col("seq") % 3 == 0, F.lit("00-short-b-01")).otherwise(
        F.concat(F.lit("00-" + "a" * 32 + "-b"), F.col("seq").cast("string"), F.lit("-01")))
    pair = F.array(*[
        F.struct(F.lit("traceparent").alias("key"), F.lit("00-early-x-01").cast("binary").alias("value")),
        F.struct(F.lit("traceparent").alias("key"), header.cast("binary").alias("value")),
        F.struct(F.lit("traceparent").alias("key"), F.lit(None).cast("binary").alias("value"))])
    rows = c.obs.withColumns({"headers": pair, "trace_id": F.when(F.col("seq") % 5 == 0, "given").when(F.col("seq") % 7 == 0, "")})
    trace, parent = ids.trace_from_header(
        ids.last_header(F.col("headers"), "traceparent"), F.col("trace_id"), F.lit(None).cast("string"))
    return rows.select("event_id", F.nullif(trace, F.lit("")).alias("trace_id"), parent.alias("parent_span_id"))



def _sql_redact(column: str, rules, label: str) -> str:
    for name, pattern in rules:
        column = f"regexp_replace({column}, '{pattern}', '{label.format(name)}', 'g')"
    return column


# The same redaction without Unicode word boundaries, which the checking engine lacks: a boundary is a character
# of the class W or its absence, captured and put back.
_W = r"\p{L}\p{M}\p{N}\p{Pc}"
_BOUNDED = [
    ("email", rf"(^|[^{_W}])[{_W}][{_W}.+-]*@[{_W}-]+\.[{_W}.-]*[{_W}]", r"\1[REDACTED:email]"),
    ("card", rf"(^|[^{_W}])(?:[0-9][ -]?){{12,15}}[0-9](?:[ -]([{_W}])|($|[^{_W}]))", r"\1[REDACTED:card]\2\3"),
    ("ssn", rf"(^|[^{_W}])[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}($|[^{_W}])", r"\1[REDACTED:ssn]\2"),
    ("phone", rf"\+?[0-9]{{1,3}}[ -.]?\(?[0-9]{{2,4}}\)?(?:[ -.]?[0-9]{{2,4}}){{2,3}}($|[^{_W}])", r"[REDACTED:phone]\1"),
]


def _sql_redact_unicode(column: str) -> str:
    # Cards twice: a card's first digit may have been the boundary of the card before it.
    for _, pattern, replacement in [_BOUNDED[0], _BOUNDED[1], *_BOUNDED[1:]]:
        column = f"regexp_replace({column}, '{pattern}', '{replacement}', 'g')"
    return column


@query("redact_documents", "C2", f"""
SELECT doc_id, sha256({_sql_redact_unicode('text')}) AS redacted_hash, {_sql_redact_unicode('text')} <> text AS changed FROM documents""")
def _(c: Context):
    clean = text.redact(F.col("text"))
    return c.documents.select("doc_id", F.sha2(clean, 256).alias("redacted_hash"), (clean != F.col("text")).alias("changed"))


@query("redact_folded_documents", "C2", f"""
SELECT doc_id, sha256({_sql_redact('text', text.REDACTIONS, '[REDACTED:{}]')}) AS redacted_hash FROM ascii_documents""")
def _(c: Context):
    return c.ascii_documents.select("doc_id", F.sha2(text.redact(F.col("text")), 256).alias("redacted_hash"))


@query("redact_extended", "C3", f"""
SELECT doc_id, sha256({_sql_redact('text', text.EXTENDED_REDACTIONS, '[{}]')}) AS redacted_hash FROM ascii_documents""")
def _(c: Context):
    return c.ascii_documents.select("doc_id", F.sha2(text.redact_extended(F.col("text")), 256).alias("redacted_hash"))


@query("redact_nested_payloads", "C3", f"""
SELECT doc_id, sha256({_sql_redact('text', text.EXTENDED_REDACTIONS, '[{}]')}) AS deep_hash, sha256(text) AS skipped_hash FROM ascii_documents""")
def _(c: Context):
    body = F.to_json(F.struct(F.col("text").alias("event_id"), F.struct(F.array(F.struct(F.col("text").alias("note"))).alias("steps")).alias("detail")))
    clean = c.ascii_documents.select("doc_id", F.try_parse_json(text.redact_nested(body)).alias("d"))
    deep, skipped = (F.try_variant_get("d", p, "string") for p in ("$.detail.steps[0].note", "$.event_id"))
    return clean.select("doc_id", F.sha2(deep, 256).alias("deep_hash"), F.sha2(skipped, 256).alias("skipped_hash"))


@query("stripped_prompts", "C8", """
SELECT n(conv_id) AS conv_id, n(turn) AS turn, substr(sha256(text), 1, 16) AS prompt_hash, FALSE AS raw_left, n(turn) AS kept FROM conversations""")
def _(c: Context):
    events = c.conversations.withColumn("payload", F.create_map(
        F.lit("prompt_text"), F.col("text").cast("variant"), F.lit("turn"), F.col("turn").cast("variant")))
    return enrich.hash_prompts(events).select(
        "conv_id", "turn", enrich.payload_text("prompt_hash").alias("prompt_hash"),
        F.map_contains_key("payload", F.lit("prompt_text")).alias("raw_left"), enrich.payload_as("turn", "bigint").alias("kept"))


@query("prompt_hashes", "C4", "SELECT n(conv_id) AS conv_id, n(turn) AS turn, substr(sha256(text), 1, 16) AS prompt_hash FROM conversations")
def _(c: Context):
    return c.conversations.select("conv_id", "turn", text.short_hash(F.col("text")).alias("prompt_hash"))


@query("user_pseudonyms", "C5", """
SELECT concat('sha256_', substr(sha256(user_id), 1, 16)) AS user_hash, n(count(*)) AS events FROM obs GROUP BY user_id""")
def _(c: Context):
    return c.obs.groupBy(text.pseudonym(F.col("user_id")).alias("user_hash")).agg(F.count(F.lit(1)).alias("events"))


@query("period_starts", "C10", """
SELECT event_date, event_date AS daily, CAST(date_trunc('week', event_date) AS DATE) AS weekly, CAST(date_trunc('month', event_date) AS DATE) AS monthly,
  n(count(*)) AS events FROM obs GROUP BY ALL""")
def _(c: Context):
    return c.obs.groupBy("event_date", *[
        times.period_start("event_ts", F.lit(p)).alias(p) for p in ("daily", "weekly", "monthly")]).agg(F.count(F.lit(1)).alias("events"))


@query("derived_latency", "C11", """
SELECT event_id, r6(CASE WHEN seq % 2 = 0 THEN latency_ms ELSE CAST(latency_ms * 2 AS DECIMAL(18,3)) END) AS latency_ms FROM obs""")
def _(c: Context):
    ended = F.col("event_ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("latency_ms") * 2 / 1000.0).cast("decimal(18,6)"))
    given = F.when(F.col("seq") % 2 == 0, F.col("latency_ms"))
    return c.obs.select("event_id", times.latency_ms(given, F.col("event_ts"), ended).alias("latency_ms"))


@query("archived_texts", "C12 S9", """
SELECT concat('redacted-prompts/doc-', CAST(doc_id AS VARCHAR), '/prompt.txt') AS archive_key, 'redacted-prompts' AS prefix,
  n(strlen(text)) AS bytes, sha256(text) AS body_hash
FROM documents WHERE strlen(text) > 2048""")
def _(c: Context):
    docs = c.documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("event_id"),
        F.create_map(F.lit("prompt"), F.col("text").cast("variant"), F.lit("note"), F.lit(1).cast("variant")).alias("payload"))
    side = enrich.oversized(docs, enrich.Settings())
    return side.select("archive_key", "prefix", F.octet_length("body").alias("bytes"), F.sha2("body", 256).alias("body_hash"))


@query("dated_archive_keys", "C13", """
SELECT event_id, CASE event_type WHEN 'LLM_CALL_COMPLETED' THEN 'redacted-prompts' WHEN 'RAG_RETRIEVAL_COMPLETED' THEN 'rag-contexts' ELSE 'raw-traces' END
  || strftime(event_ts, '/year=%Y/month=%m/day=%d') || '/application_id=' || application_id || '/correlation_id=' || correlation_id
  || '/' || lower(event_type) || '.json' AS archive_key
FROM obs WHERE event_type IN ('LLM_CALL_COMPLETED', 'RAG_RETRIEVAL_COMPLETED', 'AGENT_COMPLETED')""")
def _(c: Context):
    key = ids.dated_archive_key(*[F.col(x) for x in ("event_type", "event_ts", "application_id", "correlation_id")])
    return c.obs.select("event_id", key.alias("archive_key")).where("archive_key IS NOT NULL")


@query("feedback_sentiment", "C14", """
SELECT feedback_id, CASE WHEN rating >= 4 OR thumbs = 'up' THEN 'positive' WHEN rating <= 2 OR thumbs = 'down' THEN 'negative' ELSE 'neutral' END AS sentiment FROM feedback
""")
def _(c: Context):
    return c.feedback.select("feedback_id", text.sentiment(F.col("rating"), F.col("thumbs")).alias("sentiment"))


@query("correlation_ids", "C15", """
SELECT event_id, 'CORR_' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS correlation_id
FROM (SELECT event_id, CASE WHEN seq % 2 = 0 THEN sha256(event_id) ELSE repeat('0123456789abcdef', 2) END AS h FROM obs) x""")
def _(c: Context):
    given = F.when(F.col("seq") % 2 == 1, "CORR_01234567-89ab-cdef-0123-456789abcdef").when(F.col("seq") % 4 == 0, "bad-id")
    return c.obs.select("event_id", ids.correlation_id(given, F.col("event_id")).alias("correlation_id"))


@query("message_keys", "S2", """
SELECT event_id, CASE WHEN seq % 3 = 0 THEN 'k' WHEN seq % 2 = 0 THEN correlation_id ELSE event_id END AS key FROM obs""")
def _(c: Context):
    key = F.when(F.col("seq") % 3 == 0, "k").when(F.col("seq") % 5 == 0, "")
    corr = F.when(F.col("seq") % 2 == 0, F.col("correlation_id"))
    return c.obs.select("event_id", ids.message_key(key, corr, F.col("event_id")).alias("key"))


@query("error_fingerprints", "C21", """
SELECT substr(sha256(concat_ws(':', coalesce(error_code, ''), regexp_replace(lower(coalesce(error_message, '')), '[0-9]+', '#', 'g'))), 1, 16) AS fingerprint,
  n(count(*)) AS errors FROM full_events WHERE status = 'failed' GROUP BY ALL""")
def _(c: Context):
    failed = c.coded.where("status = 'failed'")
    return failed.groupBy(text.error_fingerprint(F.col("error_code"), F.col("error_message")).alias("fingerprint")).agg(
        F.count(F.lit(1)).alias("errors"))


_BUCKET = "CAST(('0x' || substr(sha256(event_id), 1, 7)) AS BIGINT) % 10000"


@query("quality_sample", "C22 C23", f"""
SELECT event_id, event_type IN ('LLM_CALL_COMPLETED', 'RAG_RETRIEVAL_COMPLETED') AND status = 'success' AND {_BUCKET} < 500 AS quality_sample,
  CASE event_type WHEN 'RAG_RETRIEVAL_COMPLETED' THEN TRUE WHEN 'LLM_CALL_COMPLETED' THEN {_BUCKET} < 1000 ELSE FALSE END AS eval_sample FROM obs""")
def _(c: Context):
    t, e = F.col("event_type"), F.col("event_id")
    return c.obs.select("event_id", sampling.quality_sample(t, F.col("status"), e).alias("quality_sample"),
                        sampling.stratified_sample(t, e).alias("eval_sample"))


@query("request_outcomes", "B6 B7", """
SELECT CASE WHEN http_status >= 500 THEN 'failed' ELSE 'success' END AS outcome, n(count(*)) AS requests
FROM obs WHERE event_type LIKE 'REQUEST%' AND seq % 5 <> 1 GROUP BY ALL""")
def _(c: Context):
    path = F.when(F.col("seq") % 5 == 1, "/health").when(F.col("seq") % 5 == 2, "/generate")
    rows = c.obs.where("event_type LIKE 'REQUEST%'").withColumn("path", path)
    return validate.without_operational_paths(rows).groupBy(
        validate.request_outcome(F.col("http_status")).alias("outcome")).agg(F.count(F.lit(1)).alias("requests"))


@query("cheaper_model", "J12", "SELECT event_id, dbl(estimated_cost_usd) AS estimated_cost_usd, arg_max(m, (c, m)) AS alternative_model, dbl(max(c)) AS alternative_cost_usd FROM (\n"
       + "\nUNION ALL\n".join(
           f"SELECT event_id, estimated_cost_usd, '{m}' AS m, round((input_tokens * CAST({i} AS DECIMAL(12,8)) + output_tokens * CAST({o} AS DECIMAL(12,8))) * CAST(0.001 AS DECIMAL(3,3)), 8) AS c FROM spend"
           for m, i, o, _ in catalogs.MODEL_PRICES) + "\n) x WHERE c < estimated_cost_usd GROUP BY event_id, estimated_cost_usd")
def _(c: Context):
    offers = [(m, i, o) for m, i, o, _ in catalogs.MODEL_PRICES]
    return lookups.with_cheaper_model(c.spend, offers).where("alternative_model IS NOT NULL").select(
        "event_id", "estimated_cost_usd", "alternative_model", "alternative_cost_usd")


@query("visible_events", "J16 K5", """
SELECT event_id, application_id, CASE WHEN FALSE THEN error_message END AS error_message FROM obs WHERE lob = 'lob-1' OR application_id = 'app-2'""")
def _(c: Context):
    return lookups.scoped(c.obs, c.access_policy, "ann").select("event_id", "application_id", "error_message")


@query("visible_payloads", "K5", "SELECT event_id, error_message FROM obs WHERE application_id = 'app-4'")
def _(c: Context):
    return lookups.scoped(c.obs, c.access_policy, "bob").select("event_id", "error_message")


@query("visible_to_agent_owner", "K5", """
SELECT event_id, agent_id, CASE WHEN agent_id = 'agent-3' THEN error_message END AS error_message FROM obs WHERE agent_id IN ('agent-2', 'agent-3')""")
def _(c: Context):
    return lookups.scoped(c.obs, c.access_policy, "cy").select("event_id", "agent_id", "error_message")


@query("visible_logs", "K5", """
SELECT event_id, CASE WHEN application_id = 'app-5' THEN concat('line ', event_id) END AS log FROM obs WHERE application_id IN ('app-5', 'app-6')""")
def _(c: Context):
    lines = c.obs.select("event_id", "application_id", "lob", F.concat(F.lit("line "), "event_id").alias("log"))
    return lookups.scoped(lines, c.access_policy, "dee").select("event_id", "log")
