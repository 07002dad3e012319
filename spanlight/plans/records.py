"""Queries over stored tables, traces, feedback, quality, causes and governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import catalogs, contract
from ..catalogs import MODEL_PRICES
from ..functions import text, vectors
from ..operators import feedback, governance, lookups, metrics, quality, rca, store, traces, vector_search
from ..sources import logs, lookup, tables
from . import pages
from .registry import Context, query, run_folder
from .reliability import _SCORES

def _n():
    return F.count(F.lit(1))


# ------------------------------------------------------------------ stored tables
@query("index_routes", "S7", """
SELECT index_family, concat('ai-obs-', coalesce(lob, 'shared'), '-', index_family, '-', strftime(event_date, '%Y.%m.%d')) AS index_name, n(count(*)) AS events
FROM (SELECT *, CASE WHEN status = 'failed' THEN 'errors' WHEN event_type LIKE 'LLM_CALL%' THEN 'llm-calls' WHEN event_type LIKE 'RAG%' THEN 'rag-events'
  WHEN event_type LIKE 'TOOL_CALL%' THEN 'tool-calls' WHEN event_type LIKE 'AGENT%' THEN 'agent-steps' WHEN event_type LIKE 'GUARDRAIL%' THEN 'guardrail-events'
  WHEN event_type LIKE 'FEEDBACK%' THEN 'feedback' ELSE 'requests' END AS index_family FROM obs) x GROUP BY ALL""")
def _(c: Context):
    return store.routed(c.obs).groupBy("index_family", "index_name").agg(_n().alias("events"))


def _payload_events(c: Context):
    """Typed envelope with a payload map, as the stored events have it."""
    as_variant = lambda x: F.col(x).cast("variant")
    pairs = [("model_name", "model_name"), ("input_tokens", "input_tokens"), ("output_tokens", "output_tokens"), ("agent_id", "agent_id"),
             ("rag_id", "rag_id"), ("tool_id", "tool_id"), ("agent_execution_mode", "service_name"), ("step_count", "step_count"),
             ("avg_relevance_score", "avg_relevance_score"), ("rating", "rating"), ("error_retryable", "truncation_flag"),
             ("citation_coverage_pct", "citation_coverage"), ("prompt_template_id", "prompt_template_id")]
    entries = [x for key, column in pairs for x in (F.lit(key), as_variant(column))]
    return c.obs.withColumn("payload", F.create_map(*entries))


@query("llm_events_table", "B3 S8 U4", """
SELECT event_id, event_ts, model_name, prompt_template_id, n(input_tokens) AS input_tokens, n(output_tokens) AS output_tokens, status FROM obs WHERE event_type LIKE 'LLM%'""")
def _(c: Context):
    return store.domain_tables(_payload_events(c))["llm_events"].select(
        "event_id", "event_ts", "model_name", "prompt_template_id", "input_tokens", "output_tokens", "status")


@query("agent_events_table", "B3 S8", """
SELECT event_id, agent_id, service_name AS execution_mode, n(step_count) AS step_count FROM obs WHERE event_type LIKE 'AGENT%'""")
def _(c: Context):
    return store.domain_tables(_payload_events(c))["agent_events"].select("event_id", "agent_id", "execution_mode", "step_count")


@query("rag_events_table", "B3 S8", """
SELECT event_id, rag_id, r6(avg_relevance_score) AS avg_relevance_score, r6(citation_coverage) AS citation_coverage FROM obs WHERE event_type LIKE 'RAG%'""")
def _(c: Context):
    return store.domain_tables(_payload_events(c))["rag_events"].select("event_id", "rag_id", "avg_relevance_score", "citation_coverage")


@query("feedback_events_table", "B3 S8", "SELECT event_id, agent_id, n(rating) AS rating FROM obs WHERE event_type LIKE 'FEEDBACK%'")
def _(c: Context):
    return store.domain_tables(_payload_events(c))["feedback_events"].select("event_id", "agent_id", "rating")


def _family_value(name: str, sql_type: str) -> str:
    """A value for a promoted column, in SQL that both engines run."""
    if sql_type == "string":
        return f"concat('{name}-', CAST(seq % 7 AS STRING))"
    if sql_type == "boolean":
        return "seq % 2 = 0"
    if sql_type in ("double", "float") or sql_type.startswith("decimal"):
        return "CAST(seq % 8 AS DOUBLE) / 8e0"
    return "CAST(seq % 100 AS INT)"


def _family_sql(columns: list) -> str:
    shown = {"double": "r6({})", "float": "r6({})", "boolean": "{}", "string": "{}"}
    out = []
    for name, kind in columns:
        value = "concat('a', CAST(seq % 3 AS STRING), ',b')" if kind.startswith("array") else _family_value(name, kind)
        form = shown.get(kind, f"dbl(CAST({{}} AS {kind}))" if kind.startswith("decimal") else "{}" if kind.startswith("array") else "n({})")
        lost = "seq % 5 = 0" if kind in ("string",) or kind.startswith("array") else "seq % 5 = 0 OR seq % 11 = 0"
        out.append(f"CASE WHEN NOT ({lost}) THEN {form.format(value)} END AS {name}")
    return "SELECT event_id, " + ", ".join(out) + " FROM obs"


def _family_payload(columns: list):
    """Payload with every key of a family: missing on each fifth event, a text where a number belongs on each eleventh."""
    entries = []
    for name, kind in columns:
        key = contract.COLUMN_ALIASES.get(name, [name])[-1]
        value = F.expr("array(concat('a', CAST(seq % 3 AS STRING)), 'b')" if kind.startswith("array") else _family_value(name, kind)).cast("variant")
        if kind != "string" and not kind.startswith("array"):
            value = F.when(F.col("seq") % 11 == 0, F.lit("many").cast("variant")).otherwise(value)
        entries += [F.lit(key), F.when(F.col("seq") % 5 != 0, value)]
    return F.create_map(*entries)


def _register_family(family: str, columns: list) -> None:
    @query(f"family_{family.replace('-', '_')}", "B4 B3", _family_sql(columns))
    def _(c: Context):
        rows = store.domain_projection(c.obs.select("event_id", "seq").withColumn("payload", _family_payload(columns)), family)
        return rows.select("event_id", *[F.array_join(n, ",").alias(n) if k.startswith("array") else F.col(n) for n, k in columns])


for _family, _columns in contract.FAMILY_COLUMNS.items():
    _register_family(_family, _columns)


@query("signal_tables", "S13", """
SELECT CASE WHEN seq % 3 = 0 THEN 'metrics' ELSE 'logs' END AS signal, service_name, n(count(*)) AS rows FROM obs WHERE seq % 3 <> 2 GROUP BY ALL""")
def _(c: Context):
    events = _payload_events(c).withColumns({
        "telemetry_type": F.when(F.col("seq") % 3 == 0, "metric").when(F.col("seq") % 3 == 1, "log").otherwise("event"),
        "environment": F.lit("dev"), "component": F.lit(None).cast("string")})
    out = store.signal_tables(events)
    parts = [df.groupBy(F.lit(name).alias("signal"), "service_name").agg(_n().alias("rows")) for name, df in out.items()]
    return parts[0].unionByName(parts[1])


@query("named_filters", "B5", """
SELECT 'errors' AS name, n(count(*)) AS rows FROM full_events WHERE error_code IS NOT NULL
UNION ALL SELECT 'no_result', n(count(*)) FROM obs WHERE event_type = 'RAG_NO_RESULT'
UNION ALL SELECT 'negative_feedback', n(count(*)) FROM feedback WHERE thumbs = 'down' OR (rating <= 2 AND thumbs IS DISTINCT FROM 'up')
UNION ALL SELECT 'bad_quality', n(count(*)) FROM obs WHERE event_type LIKE 'RAG%' AND (avg_relevance_score < 0.5e0 OR truncation_flag)
UNION ALL SELECT 'breached', n(count(*)) FROM obs WHERE latency_ms > 1500""")
def _(c: Context):
    rag = c.obs.where("event_type LIKE 'RAG%'").withColumns({
        "no_result_flag": F.col("event_type") == "RAG_NO_RESULT", "score": F.col("avg_relevance_score"), "hallucination_flag": F.col("truncation_flag")})
    fb = c.feedback.withColumn("sentiment", text.sentiment(F.col("rating"), F.col("thumbs")))
    slow = c.obs.withColumn("breached", F.col("latency_ms") > 1500)
    sides = {"errors": c.coded, "no_result": rag, "negative_feedback": fb, "bad_quality": rag, "breached": slow}
    out = None
    for name, df in sides.items():
        one = store.named_filter(df, name).agg(F.lit(name).alias("name"), _n().alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


def _with_copies(c: Context):
    copies = c.obs.where("seq % 20 = 0").withColumn("event_ts", F.col("event_ts") + F.make_dt_interval(F.lit(1)))
    return c.obs.unionByName(copies).withColumn("emitted_at", F.col("event_ts"))


@query("first_write_kept", "U2 S5", "SELECT event_id, event_ts FROM obs")
def _(c: Context):
    return store.first_per_key(_with_copies(c), ["event_id"], ["event_ts"]).select("event_id", "event_ts")


@query("last_write_kept", "U2", """
SELECT feedback_id, soe_id, correlation_id FROM feedback QUALIFY row_number() OVER (PARTITION BY soe_id, correlation_id ORDER BY created_at DESC, feedback_id DESC) = 1""")
def _(c: Context):
    return feedback.latest_per_user(c.feedback).select("feedback_id", "soe_id", "correlation_id")


@query("new_events_only", "J14 S5", "SELECT event_id FROM obs WHERE event_date > DATE '2024-01-10' OR seq % 2 = 1")
def _(c: Context):
    stored = c.obs.where("event_date <= DATE '2024-01-10' AND seq % 2 = 0")
    return store.not_yet_stored(c.obs, stored, ["event_id"]).select("event_id")


@query("dual_write_differences", "U3", """
SELECT event_id, CASE WHEN seq % 37 = 0 THEN 'target' ELSE 'source' END AS missing_in FROM obs WHERE (seq % 37 = 0) <> (seq % 41 = 0)""")
def _(c: Context):
    return governance.reconcile(c.obs.where("seq % 41 <> 0"), c.obs.where("seq % 37 <> 0"))


@query("dual_write_digests", "U3", """
WITH s AS (SELECT event_id, latency_ms, status FROM obs WHERE seq % 41 <> 0),
t AS (SELECT event_id, CASE WHEN seq % 53 = 0 THEN coalesce(latency_ms, 0) + 1 ELSE latency_ms END AS latency_ms, status FROM obs, range(0, 2) r(k) WHERE seq % 37 <> 0 AND (k = 0 OR seq % 59 = 0)),
a AS (SELECT event_id, count(*) AS n, list_sort(list(DISTINCT concat(coalesce(latency_ms, -1), '|', status))) AS v FROM s GROUP BY ALL),
b AS (SELECT event_id, count(*) AS n, list_sort(list(DISTINCT concat(coalesce(latency_ms, -1), '|', status))) AS v FROM t GROUP BY ALL)
SELECT event_id, CASE WHEN b.n IS NULL THEN 'missing in target' WHEN a.n IS NULL THEN 'missing in source' WHEN a.v <> b.v THEN 'changed' ELSE 'repeated' END AS state,
  n(coalesce(a.n, 0)) AS source_rows, n(coalesce(b.n, 0)) AS target_rows FROM a FULL JOIN b USING (event_id) WHERE a.n IS DISTINCT FROM b.n OR a.v IS DISTINCT FROM b.v""")
def _(c: Context):
    """The second store lacks some events, holds some twice and some with another latency."""
    rows = c.obs.select("seq", "event_id", "latency_ms", "status")
    latency = F.when(F.col("seq") % 53 == 0, F.coalesce("latency_ms", F.lit(0)) + 1).otherwise(F.col("latency_ms"))
    copies = F.when(F.col("seq") % 59 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    other = rows.where("seq % 37 <> 0").withColumn("latency_ms", latency).select("*", F.explode(copies)).drop("col")
    return governance.reconcile_rows(rows.where("seq % 41 <> 0"), other, "event_id", ["latency_ms", "status"])


@query("trace_lookup", "U1 Q8 S15", """
WITH ids AS (SELECT DISTINCT correlation_id FROM obs WHERE event_type = 'REQUEST_FAILED' AND latency_ms > 3000)
SELECT correlation_id, event_id, event_type, event_ts, status FROM obs WHERE correlation_id IN (SELECT correlation_id FROM ids)""")
def _(c: Context):
    """The events of failed slow requests, by the index of an event table that was stored in two batches."""
    run = run_folder(c)
    stored = c.obs.select("event_id", "event_type", "event_ts", "event_date", "status", "correlation_id", "application_id", F.col("event_ts").alias("emitted_at"),
                          F.date_format("event_ts", "yyyy-MM").alias("event_month"), "seq")
    for part in (stored.where("seq % 3 <> 0"), stored.where("seq % 3 = 0")):
        tables.append_events(part, f"{run}/events")
        lookup.update(c.spark, f"{run}/events", f"{run}/index")
    ids = c.obs.where("event_type = 'REQUEST_FAILED' AND latency_ms > 3000").select("correlation_id")
    return lookup.events_of(c.spark, f"{run}/events", f"{run}/index", ids).select("correlation_id", "event_id", "event_type", "event_ts", "status")


@query("incident_export", "S15", """
WITH ids AS (SELECT DISTINCT correlation_id FROM obs WHERE event_type = 'REQUEST_FAILED' AND latency_ms > 3000)
SELECT 'events' AS table_name, correlation_id, n(count(*)) AS rows FROM obs WHERE correlation_id IN (SELECT correlation_id FROM ids) GROUP BY ALL
UNION ALL SELECT 'model_calls', correlation_id, n(count(*)) FROM obs WHERE event_type LIKE 'LLM%' AND correlation_id IN (SELECT correlation_id FROM ids) GROUP BY ALL""")
def _(c: Context):
    ids = c.obs.where("event_type = 'REQUEST_FAILED' AND latency_ms > 3000").select("correlation_id")
    out = store.incident_rows({"events": c.obs, "model_calls": c.obs.where("event_type LIKE 'LLM%'")}, ids)
    parts = [df.groupBy(F.lit(name).alias("table_name"), "correlation_id").agg(_n().alias("rows")) for name, df in out.items()]
    return parts[0].unionByName(parts[1])


@query("container_logs", "S12", """
SELECT n(seq) AS seq, CASE seq % 2 WHEN 0 THEN 'stdout' ELSE 'stderr' END AS stream, CASE WHEN seq % 11 <> 0 THEN correlation_id END AS correlation_id,
  CASE WHEN seq % 11 = 0 THEN 'plain text' END AS log, FALSE AS has_secret, date_trunc('second', event_ts) AS event_ts
FROM obs WHERE seq % 13 <> 0""")
def _(c: Context):
    body = F.when(F.col("seq") % 11 == 0, F.lit("plain text")).otherwise(F.to_json(F.struct(
        "correlation_id", "seq", F.lit("s3cret").alias("password"), F.lit("k").alias("api_key"), F.lit("Bearer x").alias("authorization"))))
    line = F.concat_ws(" ", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.when(F.col("seq") % 2 == 0, "stdout").otherwise("stderr"), F.lit("F"), body)
    lines = c.obs.select("seq", F.when(F.col("seq") % 13 == 0, "broken").otherwise(line).alias("value"))
    secret = F.coalesce(F.exists(F.map_keys("fields"), lambda k: k.isin(logs.SECRET_KEYS)), F.lit(False))
    return logs.parse(lines).select(
        "seq", "stream", logs.field("correlation_id").alias("correlation_id"), "log", secret.alias("has_secret"), "event_ts")


# ------------------------------------------------------------------ traces
@query("span_assembly", "W9", """
WITH s AS (SELECT correlation_id, span_id, min(event_ts) FILTER (phase = 'STARTED') AS start_ts, max(event_ts) FILTER (phase = 'TERMINAL') AS end_ts,
  coalesce(max(status) FILTER (phase = 'TERMINAL'), 'open') AS status, max(parent_span_id) AS parent_span_id FROM span_events GROUP BY ALL)
SELECT correlation_id, span_id, parent_span_id, start_ts, end_ts, status, r6((epoch_us(end_ts) - epoch_us(start_ts)) / 1000.0e0) AS duration_ms FROM s""")
def _(c: Context):
    return traces.assemble(c.span_events)


@query("span_trees", "W8", """
WITH RECURSIVE linked AS (SELECT s.correlation_id, s.span_id, s.latency_ms, p.span_id AS parent FROM spans s
    LEFT JOIN spans p ON p.correlation_id = s.correlation_id AND p.span_id = s.parent_span_id),
t AS (SELECT correlation_id, span_id, 0 AS depth, span_id AS root_span_id, span_id AS path FROM linked WHERE parent IS NULL
  UNION ALL SELECT l.correlation_id, l.span_id, t.depth + 1, t.root_span_id, t.path || '/' || l.span_id FROM t JOIN linked l ON l.correlation_id = t.correlation_id AND l.parent = t.span_id),
k AS (SELECT correlation_id, parent, count(*) AS c, sum(CAST(latency_ms AS DECIMAL(18,3))) AS ms FROM linked WHERE parent IS NOT NULL GROUP BY ALL)
SELECT t.correlation_id, t.span_id, n(t.depth) AS depth, t.root_span_id, t.path, n(coalesce(k.c, 0)) AS child_count,
  r6(CAST(l.latency_ms AS DECIMAL(18,3)) - coalesce(k.ms, 0)) AS self_ms
FROM t JOIN linked l ON l.correlation_id = t.correlation_id AND l.span_id = t.span_id LEFT JOIN k ON k.correlation_id = t.correlation_id AND k.parent = t.span_id""")
def _(c: Context):
    return traces.tree(c.spans, with_path=True).select("correlation_id", "span_id", "depth", "root_span_id", "path", "child_count", "self_ms")


@query("trace_tree", "W8 Q8", """
WITH RECURSIVE ids AS (SELECT DISTINCT correlation_id FROM spans WHERE latency_ms > 6500),
chosen AS (SELECT * FROM spans WHERE correlation_id IN (SELECT correlation_id FROM ids)),
linked AS (SELECT s.correlation_id, s.span_id, p.span_id AS parent FROM chosen s
    LEFT JOIN chosen p ON p.correlation_id = s.correlation_id AND p.span_id = s.parent_span_id),
t AS (SELECT correlation_id, span_id, 0 AS depth, span_id AS root_span_id, span_id AS path FROM linked WHERE parent IS NULL
  UNION ALL SELECT l.correlation_id, l.span_id, t.depth + 1, t.root_span_id, t.path || '/' || l.span_id FROM t JOIN linked l ON l.correlation_id = t.correlation_id AND l.parent = t.span_id),
k AS (SELECT correlation_id, parent, count(*) AS c FROM linked WHERE parent IS NOT NULL GROUP BY ALL)
SELECT t.correlation_id, t.span_id, n(t.depth) AS depth, t.root_span_id, t.path, n(coalesce(k.c, 0)) AS child_count
FROM t LEFT JOIN k ON k.correlation_id = t.correlation_id AND k.parent = t.span_id""")
def _(c: Context):
    """The trees of the traces with a very slow span, walked from their roots."""
    ids = c.spans.where("latency_ms > 6500").select("correlation_id")
    return traces.tree_of(c.spans, ids, with_path=True).select("correlation_id", "span_id", "depth", "root_span_id", "path", "child_count")


@query("waterfall", "W10 Q8", """
SELECT correlation_id, event_id, r6((epoch_us(event_ts) - epoch_us(min(event_ts) OVER (PARTITION BY correlation_id))) / 1000.0e0) AS offset_ms,
  n(row_number() OVER w) AS position, n(sum(input_tokens + output_tokens) OVER w) AS running_tokens
FROM spans WINDOW w AS (PARTITION BY correlation_id ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING)""")
def _(c: Context):
    return traces.waterfall(c.spans).select("correlation_id", "event_id", "offset_ms", "position", "running_tokens")


@query("trace_summaries", "J7", """
WITH s AS (SELECT correlation_id, count(*) AS scores, min(avg_relevance_score) AS worst, count(*) FILTER (truncation_flag) AS h FROM obs WHERE event_type LIKE 'RAG%' GROUP BY ALL),
f AS (SELECT correlation_id, count(*) AS cases, min(rating) AS worst FROM obs WHERE event_type LIKE 'FEEDBACK%' GROUP BY ALL)
SELECT o.correlation_id, n(count(*)) AS events, n(count(*) FILTER (status = 'failed')) AS failures, min(event_ts) AS started, max(event_ts) AS ended,
  n(coalesce(any_value(s.scores), 0)) AS scores, r6(any_value(s.worst)) AS worst_score, n(coalesce(any_value(s.h), 0)) AS hallucinations,
  n(coalesce(any_value(f.cases), 0)) AS feedback_cases, n(any_value(f.worst)) AS worst_rating
FROM obs o LEFT JOIN s ON s.correlation_id = o.correlation_id LEFT JOIN f ON f.correlation_id = o.correlation_id GROUP BY o.correlation_id""")
def _(c: Context):
    scores = c.obs.where("event_type LIKE 'RAG%'").select(
        "correlation_id", F.col("avg_relevance_score").alias("score"), F.col("truncation_flag").alias("hallucination_flag"))
    cases = c.obs.where("event_type LIKE 'FEEDBACK%'").select("correlation_id", "rating")
    return traces.summaries(c.obs, scores, cases)


@query("trace_events", "U1 Q8", """
SELECT CASE WHEN event_type LIKE 'LLM%' THEN 'llm' WHEN event_type LIKE 'TOOL%' THEN 'tool' ELSE 'agent' END AS family, correlation_id, event_id,
  CASE WHEN event_type LIKE 'LLM%' THEN model_name END AS model_name, CASE WHEN event_type LIKE 'TOOL%' THEN tool_id END AS tool_id
FROM obs WHERE event_type LIKE 'LLM%' OR event_type LIKE 'TOOL%' OR event_type LIKE 'AGENT%'""")
def _(c: Context):
    families = {
        "llm": c.obs.where("event_type LIKE 'LLM%'").select("correlation_id", "event_id", "model_name"),
        "tool": c.obs.where("event_type LIKE 'TOOL%'").select("correlation_id", "event_id", "tool_id"),
        "agent": c.obs.where("event_type LIKE 'AGENT%'").select("correlation_id", "event_id")}
    return traces.trace_events(families)


@query("chain_completeness", "B14", """
WITH f AS (SELECT correlation_id, min(event_ts) FILTER (event_type = 'REQUEST_RECEIVED') AS a, CAST(NULL AS TIMESTAMP) AS b,
  min(event_ts) FILTER (event_type IN ('LLM_CALL_COMPLETED', 'TOOL_CALL_COMPLETED')) AS w, min(event_ts) FILTER (event_type = 'AGENT_COMPLETED') AS d FROM obs GROUP BY ALL)
SELECT correlation_id, n(2 + (a IS NULL)::INT + (w IS NULL)::INT + (d IS NULL)::INT) AS missing_steps,
  coalesce(a <= w, TRUE) AND coalesce(w <= d, TRUE) AND coalesce(a <= d, TRUE) AS in_order, FALSE AS complete FROM f""")
def _(c: Context):
    return traces.chain_completeness(c.obs).select("correlation_id", "missing_steps", "in_order", "complete")


# ------------------------------------------------------------------ feedback
_RATES = """n(count(*)) AS total, n(count(*) FILTER (correctness)) AS correct_count, n(count(*) FILTER (NOT correctness)) AS incorrect_count,
  r6(round(count(*) FILTER (correctness) / nullif(count(correctness), 0), 4)) AS correctness_rate, r6(((200 * sum(CAST(round(confidence_score * 100) AS BIGINT)) + count(confidence_score)) // (2 * count(confidence_score))) / 10000.0e0) AS avg_confidence"""


@query("feedback_summary", "A27 Q9", f"""
SELECT {_RATES}, n(count(*) FILTER (status = 'open')) AS open_count, n(count(*) FILTER (status = 'reviewed')) AS reviewed_count, n(count(*) FILTER (status = 'fixed')) AS fixed_count FROM feedback""")
def _(c: Context):
    return feedback.summary(c.feedback)


@query("feedback_daily_trend", "A27", f"""
SELECT CAST(created_at AS DATE) AS day, {_RATES}, n(count(*) - count(correctness)) AS no_correctness FROM feedback GROUP BY day""")
def _(c: Context):
    return feedback.daily_trend(c.feedback)


@query("feedback_by_type", "A28 B13", """
SELECT CASE WHEN feedback_type = 'Wrong' THEN 'other' ELSE feedback_type END AS kind, n(count(*) FILTER (feedback_type = 'Wrong')) AS unknown,
  n(count(*)) AS total, n(count(*) FILTER (correctness)) AS correct_count, n(count(*) FILTER (NOT correctness)) AS incorrect_count,
  r6(((200 * sum(CAST(round(confidence_score * 100) AS BIGINT)) + count(confidence_score)) // (2 * count(confidence_score))) / 10000.0e0) AS avg_confidence FROM feedback GROUP BY kind""")
def _(c: Context):
    known = feedback.normalised_types(c.feedback)
    unknown = known.groupBy("feedback_type").agg(F.count_if("unknown_type").alias("unknown"))
    return feedback.by_type(known).join(unknown, "feedback_type").withColumnRenamed("feedback_type", "kind")


@query("feedback_page_after", "T1", """
SELECT feedback_id, created_at FROM feedback WHERE created_at < TIMESTAMP '2024-01-20 00:00:00' OR (created_at = TIMESTAMP '2024-01-20 00:00:00' AND feedback_id > 'fb-3')
ORDER BY created_at DESC, feedback_id LIMIT 40""")
def _(c: Context):
    return feedback.page_after(c.feedback, F.lit("2024-01-20").cast("timestamp_ntz"), F.lit("fb-3"), 40).select("feedback_id", "created_at")


@query("feedback_page", "T1", """
SELECT feedback_id, created_at, n((SELECT count(*) FROM feedback WHERE status = 'open')) AS total, 100 < (SELECT count(*) FROM feedback WHERE status = 'open') AS has_next
FROM feedback WHERE status = 'open' ORDER BY created_at DESC, feedback_id LIMIT 50 OFFSET 50""")
def _(c: Context):
    return feedback.page(feedback.selected(c.feedback, status="open"), 2, 50).select("feedback_id", "created_at", "total", "has_next")


@query("feedback_problems", "T2", """
SELECT feedback_id, usecase_id, comments IS NOT NULL AS has_comments FROM feedback WHERE correctness = FALSE ORDER BY created_at DESC, feedback_id LIMIT 20""")
def _(c: Context):
    return feedback.problems(c.feedback, 1, 20).select("feedback_id", "usecase_id", "has_comments")


@query("feedback_anonymised", "K7", """
SELECT feedback_id, CASE WHEN seq % 7 = 0 THEN 'ANONYMISED' ELSE soe_id END AS soe_id, CASE WHEN seq % 7 <> 0 THEN comments END AS comments,
  CASE WHEN seq % 7 = 0 THEN sha256('<anonymised>') ELSE sha256(prompt) END AS prompt_hash FROM feedback""")
def _(c: Context):
    out = feedback.anonymise(c.feedback, c.feedback.where("seq % 7 = 0"))
    return out.select("feedback_id", "soe_id", "comments", F.sha2("prompt", 256).alias("prompt_hash"))


@query("feedback_attribution", "J8 Q23", """
WITH f AS (SELECT event_id, correlation_id, rating FROM obs WHERE event_type = 'FEEDBACK_SUBMITTED'),
p AS (SELECT DISTINCT correlation_id, 'agent' AS kind, agent_id AS component FROM obs WHERE event_type LIKE 'AGENT%'
  UNION SELECT correlation_id, 'model', model_name FROM obs WHERE event_type LIKE 'LLM%' UNION SELECT correlation_id, 'tool', tool_id FROM obs WHERE event_type LIKE 'TOOL%'
  UNION SELECT correlation_id, 'knowledge_base', rag_id FROM obs WHERE event_type LIKE 'RAG%')
SELECT kind, component, n(count(*)) AS feedback_count, n(count(*) FILTER (rating <= 2)) AS negative_count, r6(davg(rating)) AS avg_rating
FROM f JOIN p ON p.correlation_id = f.correlation_id GROUP BY kind, component""")
def _(c: Context):
    submitted = c.obs.where("event_type = 'FEEDBACK_SUBMITTED'").select("event_id", "correlation_id", "rating")
    return feedback.attribution(submitted, c.obs)


_CASES = """SELECT concat('case-', CAST(o_custkey AS {s})) AS case_id, o_orderdate AS changed_at, o_orderkey AS change_id,
  CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'reviewed' WHEN 'F' THEN 'fixed' ELSE 'in_progress' END AS status FROM """


@query("feedback_cases", "K6 A36", f"""
WITH h AS ({_CASES.format(s='VARCHAR')} orders),
s AS (SELECT case_id, min(changed_at) AS opened_at, arg_max(status, (changed_at, change_id)) AS status, count(*) AS changes, max(changed_at) FILTER (status = 'fixed') AS closed FROM h GROUP BY ALL)
SELECT case_id, opened_at, status, n(changes) AS changes, CASE WHEN status = 'fixed' THEN closed END AS resolved_at,
  r6(CASE WHEN status = 'fixed' THEN (epoch_us(closed) - epoch_us(opened_at)) / 3.6e9 END) AS cycle_hours FROM s""")
def _(c: Context):
    history = c.spark.sql(_CASES.format(s="STRING") + "{orders}", orders=c.orders)
    return feedback.case_state(history)


@query("case_resolution_times", "A36 K6", f"""
WITH h AS ({_CASES.format(s='VARCHAR')} orders),
s AS (SELECT case_id, min(changed_at) AS opened_at, arg_max(status, (changed_at, change_id)) AS status, max(changed_at) FILTER (status = 'fixed') AS closed FROM h GROUP BY ALL),
d AS (SELECT status, CASE WHEN status = 'fixed' THEN (epoch_us(closed) - epoch_us(opened_at)) / 3.6e9 END AS hours FROM s)
SELECT status, n(count(*)) AS cases, r6(CAST(sum(CAST(hours AS DECIMAL(18,6))) AS DOUBLE) / nullif(count(hours), 0)) AS mttr_hours FROM d GROUP BY ALL""")
def _(c: Context):
    history = c.spark.sql(_CASES.format(s="STRING") + "{orders}", orders=c.orders)
    return feedback.mean_time_to_resolve(feedback.case_state(history))


# ------------------------------------------------------------------ quality
_TOK = r"list_distinct(list_filter(regexp_split_to_array(lower({}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda t: t <> ''))"


@query("answer_faithfulness", "C17", f"""
WITH t AS (SELECT conv_id, turn, {_TOK.format('context')} AS c, {_TOK.format('response')} AS r FROM qa_pairs)
SELECT n(conv_id) AS conv_id, n(turn) AS turn, r6(len(list_intersect(c, r)) / nullif(len(r), 0)) AS faithfulness, r6(len(list_intersect(c, r)) / nullif(len(c), 0)) AS context_utilisation FROM t""")
def _(c: Context):
    return quality.answer_quality(c.qa_pairs).select("conv_id", "turn", "faithfulness", "context_utilisation")


@query("response_entropy", "C18", r"""
WITH w AS (SELECT conv_id, turn, unnest(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM conversations WHERE role = 'assistant'),
c AS (SELECT conv_id, turn, t, count(*) AS k FROM w WHERE t <> '' GROUP BY ALL),
s AS (SELECT conv_id, turn, sum(k) AS tokens, count(*) AS d, sum(k * log2(k)) AS x FROM c GROUP BY ALL)
SELECT n(conv_id) AS conv_id, n(turn) AS turn, n(tokens) AS tokens, n(d) AS distinct_tokens, r6(log2(tokens) - x / tokens) AS entropy_bits FROM s""")
def _(c: Context):
    return quality.token_entropy(c.conversations.where("role = 'assistant'"), ["conv_id", "turn"], "text")


@query("document_entropy", "C18", r"""
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM ascii_documents),
c AS (SELECT doc_id, t, count(*) AS k FROM w WHERE t <> '' GROUP BY ALL),
s AS (SELECT doc_id, sum(k) AS tokens, count(*) AS d, sum(k * log2(k)) AS x FROM c GROUP BY ALL)
SELECT n(doc_id) AS doc_id, n(tokens) AS tokens, CASE WHEN round(log2(tokens) - x / tokens, 9) < 3 THEN 'repetitive' WHEN round(log2(tokens) - x / tokens, 9) > 9 THEN 'incoherent' ELSE 'normal' END AS flag FROM s""")
def _(c: Context):
    e = quality.token_entropy(c.ascii_documents, ["doc_id"], "text")
    return e.select("doc_id", "tokens", quality.entropy_flag(F.col("entropy_bits"), 3.0, 9.0).alias("flag"))


@query("embedding_norms", "C19", """
SELECT n(vec_id) AS vec_id, r6(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))) AS norm FROM embeddings""")
def _(c: Context):
    return c.embeddings.select("vec_id", vectors.l2_norm(F.col("embedding")).alias("norm"))


_CHUNKS = """SELECT vec_id, concat('corpus-', CAST(label % 4 AS {s})) AS corpus, CAST(vec_id % 4 AS BIGINT) AS week, embedding,
  {day0} + {hours} AS created_at FROM """
_DUCK_CHUNKS = _CHUNKS.format(s="VARCHAR", day0="TIMESTAMP '2024-01-01 00:00:00'", hours="to_hours(CAST(vec_id % 200 AS INT))")
_SPARK_CHUNKS = _CHUNKS.format(s="STRING", day0="TIMESTAMP_NTZ'2024-01-01 00:00:00'", hours="make_dt_interval(0, CAST(vec_id % 200 AS INT))") + "{embeddings}"


@query("vector_health", "A21 C20", f"""
WITH c AS ({_DUCK_CHUNKS} embeddings)
SELECT corpus, max(created_at) AS last_indexed_at, n(count(*)) AS chunk_count,
  r6(avg(CAST(round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 9) AS DECIMAL(18,9)))) AS avg_norm,
  r6((epoch_us(TIMESTAMP '2024-01-10 08:30:00') - epoch_us(max(created_at))) / 3.6e9) AS hours_since_indexed,
  (epoch_us(TIMESTAMP '2024-01-10 08:30:00') - epoch_us(max(created_at))) / 3.6e9 > 24 AS freshness_breach FROM c GROUP BY ALL""")
def _(c: Context):
    chunks = c.spark.sql(_SPARK_CHUNKS, embeddings=c.embeddings)
    return quality.vector_health(chunks, F.lit("2024-01-10 08:30:00").cast("timestamp_ntz"))


@query("embedding_drift", "A22 C19", f"""
WITH c AS ({_DUCK_CHUNKS} embeddings),
p AS (SELECT corpus, week, generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS x FROM c),
m AS (SELECT corpus, week, pos, CAST(sum(CAST(x AS DECIMAL(18,9))) AS DOUBLE) / count(*) AS m FROM p GROUP BY ALL),
j AS (SELECT a.corpus, a.week, a.m AS a, b.m AS b FROM m a JOIN m b ON b.corpus = a.corpus AND b.pos = a.pos AND b.week = a.week - 1)
SELECT corpus, n(week) AS week, n(week - 1) AS previous_week, r6(1.0 - sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b)))) AS cosine_shift, r6(sqrt(sum((a - b) * (a - b)))) AS l2_shift
FROM j GROUP BY corpus, week""")
def _(c: Context):
    return quality.embedding_drift(c.spark.sql(_SPARK_CHUNKS, embeddings=c.embeddings))


@query("recall_at_k", "A23", """
WITH r AS (SELECT DISTINCT l_orderkey AS q, l_partkey AS d, first(l_extendedprice ORDER BY l_extendedprice DESC) OVER (PARTITION BY l_orderkey, l_partkey) AS s FROM lineitem),
top AS (SELECT q, d FROM r QUALIFY row_number() OVER (PARTITION BY q ORDER BY s DESC, d) <= 3),
rel AS (SELECT DISTINCT concat('corpus-', CAST(l_orderkey % 5 AS VARCHAR)) AS corpus, l_orderkey AS q, l_partkey AS d FROM lineitem WHERE l_returnflag = 'N'),
w AS (SELECT corpus, q, count(*) AS wanted FROM rel GROUP BY ALL), h AS (SELECT rel.q, count(*) AS hits FROM rel JOIN top ON top.q = rel.q AND top.d = rel.d GROUP BY ALL)
SELECT corpus, n(count(*)) AS queries, r6(avg(CAST(round(coalesce(h.hits, 0) / w.wanted, 9) AS DECIMAL(18,9)))) AS recall_at_k FROM w LEFT JOIN h ON h.q = w.q GROUP BY corpus""")
def _(c: Context):
    lines = c.lineitem.select(F.col("l_orderkey").alias("query_id"), F.col("l_partkey").alias("doc_id"), F.col("l_extendedprice").alias("score"), "l_returnflag")
    retrieved = lines.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    corpus = F.concat(F.lit("corpus-"), (F.col("query_id") % 5).cast("string")).alias("corpus")
    relevant = lines.where("l_returnflag = 'N'").select(corpus, "query_id", "doc_id")
    return quality.recall_at_k(retrieved, relevant, 3)


@query("nearest_vectors", "A23", """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id, round(list_cosine_similarity(q.e, r.e), 9) AS similarity
  FROM v q JOIN v r ON r.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, neighbour_id) AS rank FROM s)
SELECT n(query_id) AS query_id, n(neighbour_id) AS neighbour_id, r6(similarity) AS similarity, n(rank) AS rank FROM t WHERE rank <= 10""")
def _(c: Context):
    v = vector_search.usable(c.embeddings)
    centres = vector_search.fit_cells(v)
    return vector_search.nearest(vector_search.index(v, centres), centres, v.where("id % 100 = 0"), 10, len(centres))


@query("vector_search_recall", "A23")
def _(c: Context):
    keys = c.embeddings.select(F.concat(F.lit("corpus-"), (F.col("label") % 4).cast("string")).alias("corpus"), F.col("vec_id").alias("query_id"))
    return vector_search.search_recall(vector_search.usable(c.embeddings), F.col("id") % 100 == 0, keys)


@query("daily_rag_quality", "A20", """
SELECT rag_id, event_date AS day, r6(davg(avg_relevance_score)) AS avg_faithfulness, r6(davg(citation_coverage)) AS avg_precision, n(count(*)) AS sample_count
FROM obs WHERE event_type = 'RAG_RETRIEVAL_COMPLETED' GROUP BY ALL""")
def _(c: Context):
    scores = c.obs.where("event_type = 'RAG_RETRIEVAL_COMPLETED'").selectExpr(
        "rag_id", "event_ts", "avg_relevance_score AS faithfulness", "citation_coverage AS precision")
    return quality.daily_quality(scores)


@query("prompt_drift", "W18", """
WITH k AS (SELECT application_id, prompt_template_id, CAST(date_trunc('week', event_ts) AS DATE) AS week, substr(sha256(prompt_template_id || prompt_version), 1, 16) AS h, count(*) AS n
  FROM obs WHERE event_type LIKE 'LLM%' GROUP BY ALL),
m AS (SELECT application_id, prompt_template_id, week, count(*) AS d, arg_min(h, (-n, h)) AS main_hash FROM k GROUP BY ALL),
w AS (SELECT *, lag(main_hash) OVER (PARTITION BY application_id, prompt_template_id ORDER BY week) AS previous_hash FROM m)
SELECT application_id, prompt_template_id, week, n(d) AS distinct_hashes, main_hash, previous_hash, previous_hash IS NOT NULL AND previous_hash <> main_hash AS changed FROM w""")
def _(c: Context):
    calls = c.obs.where("event_type LIKE 'LLM%'").withColumn("prompt_hash", text.short_hash(F.concat("prompt_template_id", "prompt_version")))
    return quality.prompt_drift(calls)


@query("evaluated_events", "J10", """
SELECT n(s.seq) AS eval_id, o.event_type, o.event_id IS NULL AS orphan FROM obs s LEFT JOIN obs o ON o.seq = s.seq + 5 AND s.seq % 3 <> 0 WHERE s.event_type LIKE 'RAG%'""")
def _(c: Context):
    target = F.when(F.col("seq") % 3 == 0, F.lit("evt-gone")).otherwise(F.concat(F.lit("evt-"), (F.col("seq") + 5).cast("string")))
    scores = c.obs.where("event_type LIKE 'RAG%'").select(F.col("seq").alias("eval_id"), target.alias("evaluated_event_id"))
    return quality.evaluated(scores, c.obs).select("eval_id", "event_type", "orphan")


# ------------------------------------------------------------------ causes
@query("error_clusters", "A29", "\nUNION ALL\n".join(
    f"(SELECT '{d}' AS dimension, {d} AS name, n(count(*)) AS errors FROM full_events WHERE status = 'failed' AND {d} IS NOT NULL GROUP BY {d} ORDER BY errors DESC, name LIMIT 20)"
    for d in ("error_code", "application_id", "tool_id")))
def _(c: Context):
    parts = [rca.clusters(c.coded, d).select(F.lit(d).alias("dimension"), F.col(d).alias("name"), "errors") for d in ("error_code", "application_id", "tool_id")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_LAST = """SELECT error_code, correlation_id, max(event_ts) AS last_seen FROM full_events WHERE status = 'failed' AND error_code IS NOT NULL GROUP BY ALL"""


@query("latest_traces_per_error", "T5", f"""
SELECT error_code, correlation_id, last_seen, n(row_number() OVER w) AS rank FROM ({_LAST}) x
WINDOW w AS (PARTITION BY error_code ORDER BY last_seen DESC, correlation_id) QUALIFY row_number() OVER w <= 5""")
def _(c: Context):
    return rca.latest_traces(c.coded)


_INC = """i AS (SELECT e.application_id, e.event_date AS day, e.error_code, count(*) AS errors, count(DISTINCT correlation_id) AS traces
  FROM full_events e WHERE status = 'failed' AND error_code IS NOT NULL GROUP BY ALL), d AS (SELECT application_id, event_date AS day, count(*) AS day_events FROM obs GROUP BY ALL)"""


@query("incidents", "J9", f"""WITH {_INC}
SELECT i.application_id, i.day, i.error_code, n(errors) AS errors, n(traces) AS traces, n(day_events) AS day_events, r6(100.0 * errors / day_events) AS impact_pct
FROM i JOIN d ON d.application_id = i.application_id AND d.day = i.day""")
def _(c: Context):
    return rca.incidents(rca.day_facts(c.coded))


_HYP = """tl AS (SELECT application_id, event_date AS day, tool_id, quantile_cont(latency_ms, 0.95) AS p FROM obs WHERE event_type LIKE 'TOOL%' GROUP BY ALL),
tool AS (SELECT application_id, day, least(1.0, max(p) / 10000.0) AS s FROM tl GROUP BY ALL),
ver AS (SELECT application_id, event_date AS day, prompt_template_id AS t, prompt_version AS v, count(*) AS c FROM obs WHERE event_type LIKE 'LLM%' GROUP BY ALL),
mv AS (SELECT application_id, day, t, arg_min(v, (-c, v)) AS main FROM ver GROUP BY ALL),
pv AS (SELECT *, lag(main) OVER (PARTITION BY application_id, t ORDER BY day) AS previous FROM mv),
drift AS (SELECT ver.application_id, ver.day, sum(CASE WHEN v <> previous THEN c ELSE 0 END) / sum(c) AS s FROM ver JOIN pv ON pv.application_id = ver.application_id AND pv.day = ver.day AND pv.t = ver.t GROUP BY ALL),
stale AS (SELECT application_id, event_date AS day, count(*) FILTER (event_type = 'RAG_NO_RESULT') / count(*) AS s FROM obs WHERE event_type LIKE 'RAG%' GROUP BY ALL),
e AS (SELECT application_id, event_date AS day, count(*) AS errors FROM obs WHERE status = 'failed' GROUP BY ALL),
l AS (SELECT e.*, 'tool_degradation' AS hypothesis, round(s, 3) AS score FROM e JOIN tool x ON x.application_id = e.application_id AND x.day = e.day
  UNION ALL SELECT e.*, 'model_drift', round(s, 3) FROM e JOIN drift x ON x.application_id = e.application_id AND x.day = e.day
  UNION ALL SELECT e.*, 'rag_staleness', round(s, 3) FROM e JOIN stale x ON x.application_id = e.application_id AND x.day = e.day),
h AS (SELECT *, row_number() OVER (PARTITION BY application_id, day ORDER BY score DESC, hypothesis) AS rank FROM l WHERE score > 0.1)"""


@query("cause_hypotheses", "W15", f"""WITH {_HYP}
SELECT application_id, day, n(errors) AS errors, hypothesis, r6(score) AS score, n(rank) AS rank FROM h""")
def _(c: Context):
    return rca.hypotheses(c.obs)


@query("weekly_digest", "W16 Q27", f"""WITH {_INC}, {_HYP},
w AS (SELECT i.*, CAST(date_trunc('week', day) AS DATE) AS week FROM i)
SELECT w.week, w.application_id, w.day, w.error_code, n(w.errors) AS errors, n(row_number() OVER o) AS rank, h.hypothesis AS likely_cause, r6(h.score) AS cause_score
FROM w LEFT JOIN h ON h.application_id = w.application_id AND h.day = w.day AND h.rank = 1
WINDOW o AS (PARTITION BY w.week ORDER BY w.errors DESC, w.application_id, w.day, w.error_code) QUALIFY row_number() OVER o <= 5""")
def _(c: Context):
    return pages.nightly_report(c.coded)["digest"].select(
        "week", "application_id", "day", "error_code", "errors", "rank", "likely_cause", "cause_score")


# ------------------------------------------------------------------ governance
_CHECKED = {
    "prompt_audit": ("obs", """SELECT seq AS audit_id, CASE WHEN seq % 97 = 0 THEN 'deleted' WHEN seq % 7 = 0 THEN 'rolled_back' ELSE 'activated' END AS action FROM obs"""),
    "dashboard_config": ("pages", "SELECT page_id AS widget_id, CASE page_id % 5 WHEN 0 THEN 'platform' WHEN 1 THEN 'lob' WHEN 2 THEN 'team' WHEN 3 THEN 'public' END AS visibility FROM pages"),
    "feedback_events": ("obs", "SELECT event_id, CASE WHEN seq % 13 = 0 THEN 9 ELSE rating END AS rating FROM obs WHERE event_type LIKE 'FEEDBACK%'"),
    "quality_scores": ("conversations", "SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'faithfulness' WHEN 1 THEN 'hallucination' ELSE 'style' END AS eval_type FROM conversations"),
    "metric_catalog": ("obs", "SELECT DISTINCT model_name AS metric_id, CASE WHEN model_name = 'unpriced-model' THEN 'spreadsheet' ELSE 'obs_events' END AS source_system FROM obs"),
    "alert_rules": ("obs", "SELECT DISTINCT tool_id AS alert_id, CASE WHEN tool_id = 'tool-1' THEN '=>' ELSE '>=' END AS comparator FROM obs"),
}
_NAMED = {"tool_registry": "tool_registry", "prompt_registry": "prompt_registry", "budget_limits": "budgets", "feedback_case": "feedback", "slo_definitions": "slos"}


def _checked_sql() -> str:
    source = {**{t: v for t, v in _NAMED.items()}, **{t: f"({text})" for t, (_, text) in _CHECKED.items()}}
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, n(count(*)) AS row_count, n(count(*) FILTER (NOT ({predicate}))) AS bad_rows FROM {source[table]}"
        for table, rule, predicate in contract.CHECK_RULES)


@query("check_report", "B8", _checked_sql())
def _(c: Context):
    derived = {t: c.spark.sql(text.replace(f"FROM {base}", f"FROM {{{base}}}"), **{base: getattr(c, base)}) for t, (base, text) in _CHECKED.items()}
    return governance.check_report({**{t: getattr(c, v) for t, v in _NAMED.items()}, **derived})


@query("duplicate_keys", "B9", """
SELECT 'feedback' AS source, soe_id || '/' || correlation_id AS key, n(count(*)) AS copies FROM feedback GROUP BY soe_id, correlation_id HAVING count(*) > 1
UNION ALL SELECT 'prompts', template_id || '/' || coalesce(ab_bucket, ''), n(count(*)) FROM prompt_registry WHERE status = 'active' GROUP BY template_id, coalesce(ab_bucket, '') HAVING count(*) > 1""")
def _(c: Context):
    records = governance.duplicate_keys(c.feedback, ["soe_id", "correlation_id"])
    prompts = governance.active_prompt_conflicts(c.prompt_registry)
    return records.select(F.lit("feedback").alias("source"), F.concat_ws("/", "soe_id", "correlation_id").alias("key"), "copies").unionByName(
        prompts.select(F.lit("prompts").alias("source"), F.concat_ws("/", "template_id", "ab_bucket").alias("key"), "copies"))


@query("unresolved_references", "B10", """
SELECT 'event application' AS reference, application_id AS missing_key, n(count(*)) AS rows FROM obs WHERE application_id NOT IN (SELECT application_id FROM app_registry) GROUP BY ALL
UNION ALL SELECT 'order customer', CAST(o_custkey AS VARCHAR), n(count(*)) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY ALL
UNION ALL SELECT 'agent application', application_id, n(count(*)) FROM agent_registry WHERE application_id NOT IN (SELECT application_id FROM app_registry) GROUP BY ALL
UNION ALL SELECT 'budget application', application_id, n(count(*)) FROM budgets WHERE application_id NOT IN (SELECT application_id FROM app_registry) GROUP BY ALL
UNION ALL SELECT 'slo application', application_id, n(count(*)) FROM slos WHERE application_id NOT IN (SELECT application_id FROM app_registry) GROUP BY ALL
UNION ALL SELECT 'compliance slo', slo_id, n(count(*)) FROM (SELECT concat('slo-', seq % 17) AS slo_id FROM obs) x WHERE slo_id NOT IN (SELECT slo_id FROM slos) GROUP BY ALL
UNION ALL SELECT 'alert metric', metric_id, n(count(*)) FROM (VALUES """ + ", ".join(f"('{r[1]}')" for r in catalogs.ALERT_RULES) + """) a(metric_id) WHERE metric_id NOT IN (""" + ", ".join(f"'{m[0]}'" for m in catalogs.METRIC_CATALOG) + """) GROUP BY ALL
UNION ALL SELECT 'kpi metric', metric_id, n(count(*)) FROM (SELECT CASE seq % 4 WHEN 0 THEN 'made_up' ELSE 'request_count' END AS metric_id FROM obs) k WHERE metric_id <> 'request_count' GROUP BY ALL""")
def _(c: Context):
    checks = [("event application", c.obs, c.app_registry, "application_id", "application_id"),
              ("order customer", c.orders.withColumn("o_custkey", F.col("o_custkey").cast("string")),
               c.customer.withColumn("c_custkey", F.col("c_custkey").cast("string")), "o_custkey", "c_custkey"),
              ("agent application", c.agent_registry, c.app_registry, "application_id", "application_id"),
              ("budget application", c.budgets, c.app_registry, "application_id", "application_id"),
              ("slo application", c.slos, c.app_registry, "application_id", "application_id"),
              ("compliance slo", c.obs.select(F.concat(F.lit("slo-"), F.col("seq") % 17).alias("slo_id")), c.slos, "slo_id", "slo_id"),
              ("alert metric", catalogs.alert_rule_table(c.spark), metrics.catalog_table(c.spark), "metric_id", "metric_id"),
              ("kpi metric", c.obs.select(F.when(F.col("seq") % 4 == 0, "made_up").otherwise("request_count").alias("metric_id")),
               metrics.catalog_table(c.spark), "metric_id", "metric_id")]
    out = None
    for name, child, parent, ck, pk in checks:
        one = governance.unresolved(child, parent, ck, pk).select(F.lit(name).alias("reference"), "missing_key", "rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("catalog_differences", "B11", """
WITH l AS (SELECT DISTINCT model_name, 1 AS v FROM obs), r AS (SELECT DISTINCT model_name, CASE WHEN count(*) OVER (PARTITION BY model_name) > 1 THEN 2 ELSE 1 END AS v FROM prices)
SELECT coalesce(l.model_name, r.model_name) AS model_name, CASE WHEN r.model_name IS NULL THEN 'left only' WHEN l.model_name IS NULL THEN 'right only' ELSE 'different' END AS state
FROM l FULL JOIN r ON l.model_name = r.model_name WHERE l.v IS DISTINCT FROM r.v""")
def _(c: Context):
    used = c.obs.select("model_name").distinct().withColumn("v", F.lit(1))
    listed = c.prices.groupBy("model_name").agg(F.when(_n() > 1, 2).otherwise(1).alias("v"))
    return governance.catalog_differences(used, listed, "model_name", ["v"]).select("model_name", "state")


@query("service_vocabulary", "B11", """
WITH u AS (SELECT DISTINCT CASE WHEN seq % 19 = 0 THEN 'shadow-service' ELSE service_name END AS service_name FROM obs WHERE service_name <> 'gssp-rs'),
k(service_name) AS (VALUES """ + ", ".join(f"('{s}')" for s in contract.SERVICE_NAMES) + """)
SELECT coalesce(u.service_name, k.service_name) AS service_name, CASE WHEN k.service_name IS NULL THEN 'left only' ELSE 'right only' END AS state
FROM u FULL JOIN k ON u.service_name = k.service_name WHERE u.service_name IS NULL OR k.service_name IS NULL""")
def _(c: Context):
    used = c.obs.where("service_name <> 'gssp-rs'").select(
        F.when(F.col("seq") % 19 == 0, "shadow-service").otherwise(F.col("service_name")).alias("service_name")).distinct()
    known = catalogs.literal_table(c.spark, [(s,) for s in contract.SERVICE_NAMES], "service_name string")
    return governance.catalog_differences(used, known, "service_name", []).select("service_name", "state")


@query("price_drift", "B11", """
WITH l AS (SELECT model_name, input_usd_per_1k AS i, output_usd_per_1k AS o FROM prices QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY effective_from DESC) = 1),
r(model_name, i, o) AS (VALUES """ + ", ".join(f"('{m}', CAST({i} AS DECIMAL(12,8)), CAST({o} AS DECIMAL(12,8)))" for m, i, o, _ in MODEL_PRICES) + """),
u AS (SELECT DISTINCT model_name FROM obs)
SELECT l.model_name, 'different' AS state FROM l JOIN r ON l.model_name = r.model_name JOIN u ON u.model_name = l.model_name WHERE l.i <> r.i OR l.o <> r.o""")
def _(c: Context):
    """Latest control-plane prices of the models in use against the producer's table."""
    prices = ["input_usd_per_1k", "output_usd_per_1k"]
    latest = lookups.price_intervals(c.prices).where("effective_to IS NULL").join(c.obs.select("model_name").distinct(), "model_name", "left_semi")
    producer = catalogs.price_table(c.spark).join(latest.select("model_name"), "model_name", "left_semi")
    return governance.catalog_differences(latest, producer, "model_name", prices).select("model_name", "state")


@query("lifecycle_plan", "K8 S14", """
SELECT event_date, n(count(*)) AS events, n(DATE '2024-02-01' - event_date) AS age_days,
  CASE WHEN DATE '2024-02-01' - event_date >= 30 THEN 'delete' WHEN DATE '2024-02-01' - event_date >= 2 THEN 'warm' ELSE 'hot' END AS action FROM obs GROUP BY ALL""")
def _(c: Context):
    return governance.lifecycle_plan(c.obs.groupBy("event_date").agg(_n().alias("events")), F.lit("2024-02-01").cast("date"))


@query("month_retention", "K8 S14", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS event_month, n(count(*)) AS rows, 'archive_then_drop' AS action FROM orders
WHERE date_trunc('month', o_orderdate) < TIMESTAMP '1998-05-01' GROUP BY ALL""")
def _(c: Context):
    months = c.orders.groupBy(F.date_trunc("month", "o_orderdate").cast("date").alias("event_month")).agg(_n().alias("rows"))
    return governance.month_retention(months, F.lit("1998-08-02").cast("date"), 3)


@query("storage_tiers", "K9", """
WITH a AS (SELECT CASE event_type WHEN 'LLM_CALL_COMPLETED' THEN 'audit-evidence' WHEN 'AGENT_COMPLETED' THEN 'debug-bundles' ELSE 'raw-traces' END AS prefix, DATE '2024-04-15' - event_date AS age FROM obs)
SELECT prefix, CASE prefix WHEN 'debug-bundles' THEN CASE WHEN age >= 90 THEN 'expired' WHEN age >= 30 THEN 'infrequent' ELSE 'standard' END
  WHEN 'audit-evidence' THEN CASE WHEN age >= 90 THEN 'cold' WHEN age >= 30 THEN 'infrequent' ELSE 'standard' END
  ELSE CASE WHEN age >= 180 THEN 'cold' WHEN age >= 30 THEN 'infrequent' ELSE 'standard' END END AS tier, n(count(*)) AS objects FROM a GROUP BY ALL""")
def _(c: Context):
    prefix = F.when(F.col("event_type") == "LLM_CALL_COMPLETED", "audit-evidence").when(
        F.col("event_type") == "AGENT_COMPLETED", "debug-bundles").otherwise("raw-traces")
    rows = c.obs.select(prefix.alias("prefix"), F.datediff(F.lit("2024-04-15").cast("date"), F.col("event_date")).alias("age"))
    return rows.groupBy("prefix", governance.storage_tier(F.col("prefix"), F.col("age")).alias("tier")).agg(_n().alias("objects"))


_AUDIT = """SELECT seq AS audit_id, prompt_template_id AS template_id, CAST(seq % 5 AS BIGINT) AS version, event_ts AS occurred_at,
  CASE seq % 7 WHEN 0 THEN 'rolled_back' WHEN 1 THEN 'archived' ELSE 'activated' END AS action FROM """


@query("active_prompt_versions", "K10", f"""
WITH a AS ({_AUDIT} obs), p AS (SELECT * FROM a WHERE action IN ('activated', 'rolled_back') AND occurred_at <= TIMESTAMP '2024-01-20 00:00:00')
SELECT template_id, n(arg_max(version, (occurred_at, audit_id))) AS version, arg_max(action, (occurred_at, audit_id)) AS action, max(occurred_at) AS since FROM p GROUP BY ALL""")
def _(c: Context):
    return governance.active_version_at(c.spark.sql(_AUDIT + "{obs}", obs=c.obs), F.lit("2024-01-20").cast("timestamp_ntz"))


@query("prompt_version_history", "K10", f"""
WITH a AS ({_AUDIT} obs)
SELECT template_id, n(version) AS version, action, occurred_at AS valid_from, lead(occurred_at) OVER (PARTITION BY template_id ORDER BY occurred_at, audit_id) AS valid_to
FROM a WHERE action IN ('activated', 'rolled_back')""")
def _(c: Context):
    return governance.version_history(c.spark.sql(_AUDIT + "{obs}", obs=c.obs))


@query("index_freshness", "C20", """
SELECT rag_id, max(event_ts) AS last_indexed_at, r6((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(event_ts))) / 3.6e9) AS hours_since_indexed,
  (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(event_ts))) / 3.6e9 > CASE rag_id WHEN 'kb-0' THEN 1 WHEN 'kb-1' THEN 2000 ELSE 24 END AS freshness_breach
FROM obs WHERE event_type LIKE 'RAG%' AND seq % 4 <> 3 GROUP BY rag_id""")
def _(c: Context):
    indexed = c.obs.where("event_type LIKE 'RAG%' AND seq % 4 <> 3").groupBy("rag_id").agg(F.max("event_ts").alias("last_indexed_at"))
    limits = catalogs.literal_table(c.spark, [("kb-0", 1), ("kb-1", 2000)], "rag_id string, freshness_sla_hours int")
    return quality.freshness(indexed, limits, F.lit("2024-02-01").cast("timestamp_ntz")).drop("freshness_sla_hours")


@query("prompt_hash_integrity", "K12", """
SELECT n(conv_id) AS conv_id, n(turn) AS turn, substr(sha256(text), 1, 16) AS expected_hash FROM conversations WHERE turn % 3 = 0""")
def _(c: Context):
    stored = F.when(F.col("turn") % 3 == 0, F.lit("0" * 16)).otherwise(text.short_hash(F.col("text")))
    rows = c.conversations.withColumns({"template_text": F.col("text"), "prompt_hash": stored})
    return governance.hash_mismatches(rows).select("conv_id", "turn", "expected_hash")


@query("sla_breach_page", "Q14 J2", """
WITH t AS (SELECT tool_id, sla_latency_ms FROM tool_registry WHERE tool_version = 2)
SELECT o.tool_id, n(t.sla_latency_ms) AS tool_sla_ms, n(count(*)) AS calls, n(count(*) FILTER (latency_ms > sla_latency_ms)) AS breaches,
  r6(100.0 * count(*) FILTER (latency_ms > sla_latency_ms) / count(*)) AS breach_pct FROM obs o JOIN t ON t.tool_id = o.tool_id WHERE event_type LIKE 'TOOL%' GROUP BY ALL""")
def _(c: Context):
    return pages.get_sla_breach_summary(c.obs, c.agent_registry, c.tool_registry)


@query("cost_summary_page", "Q10", """
WITH o AS (""" + "\nUNION ALL\n".join(
    f"SELECT event_id, '{m}' AS m, round((input_tokens * CAST({i} AS DECIMAL(12,8)) + output_tokens * CAST({o} AS DECIMAL(12,8))) * CAST(0.001 AS DECIMAL(3,3)), 8) AS c FROM spend"
    for m, i, o, _ in MODEL_PRICES) + """),
a AS (SELECT s.event_id, max(o.c) AS c FROM spend s JOIN o ON o.event_id = s.event_id AND o.c < s.estimated_cost_usd GROUP BY ALL)
SELECT s.application_id, s.model_name, n(count(*)) AS calls, dbl(sum(s.estimated_cost_usd)) AS cost_usd, dbl(sum(coalesce(a.c, s.estimated_cost_usd))) AS cheaper_usd
FROM spend s LEFT JOIN a ON a.event_id = s.event_id GROUP BY ALL""")
def _(c: Context):
    return pages.get_cost_summary(c.costed, [(m, i, o) for m, i, o, _ in MODEL_PRICES])


@query("top_anomalies_page", "Q12", f"""WITH {_SCORES}
SELECT event_id, application_id, r6(raw_score) AS anomaly_score FROM s WHERE NOT none AND raw_score > 0 ORDER BY raw_score DESC, event_id LIMIT 20""")
def _(c: Context):
    return pages.get_top_anomalies(c.obs.where("event_type LIKE 'REQUEST%'")).select("event_id", "application_id", "anomaly_score")


