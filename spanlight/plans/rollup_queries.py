"""Queries over hourly and daily rollups, catalog metrics and reports built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import catalogs

from ..functions import text
from ..operators import alerts, anomaly, budget, metrics, quality, rollups, sketches, slo
from .registry import Context, query, run_folder
from .reliability import _BURN, _DAILY, _matched

_WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower({}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda t: t <> ''))"

_HOUR = "date_trunc('hour', event_ts) AS hour"
_RUN = "event_type IN ('AGENT_COMPLETED', 'AGENT_FAILED', 'AGENT_TIMEOUT')"
_REQ = "event_type IN ('REQUEST_COMPLETED', 'REQUEST_FAILED')"
_TOK = "(CAST(coalesce(input_tokens, 0) AS BIGINT) + coalesce(output_tokens, 0))"
_HOURLY_APP = f"""
SELECT {{keys}}, {_HOUR}, n(count(*) FILTER ({_REQ})) AS request_count, n(count(*) FILTER (event_type = 'REQUEST_COMPLETED')) AS success_count,
  n(count(*) FILTER (event_type = 'REQUEST_FAILED')) AS error_count, r6(davg(CASE WHEN {_REQ} THEN latency_ms END)) AS avg_latency_ms,
  n(coalesce(sum({_TOK}) FILTER (event_type LIKE 'LLM%'), 0)) AS total_tokens, dbl(coalesce(sum(estimated_cost_usd), 0)) AS total_cost_usd,
  r6(quantile_cont(latency_ms, 0.5) FILTER ({_REQ})) AS p50_latency_ms, r6(quantile_cont(latency_ms, 0.95) FILTER ({_REQ})) AS p95_latency_ms,
  r6(quantile_cont(latency_ms, 0.99) FILTER ({_REQ})) AS p99_latency_ms
FROM costed WHERE {_REQ} OR event_type LIKE 'LLM%' GROUP BY {{keys}}, hour"""


@query("hourly_application_metrics", "A1", _HOURLY_APP.format(keys="application_id"))
def _(c: Context):
    return rollups.hourly_application(c.costed)


@query("hourly_agent_metrics", "A2", f"""
SELECT agent_id, {_HOUR}, n(count(*) FILTER ({_RUN})) AS run_count, n(count(*) FILTER (event_type = 'AGENT_COMPLETED')) AS success_count,
  n(count(*) FILTER (event_type = 'AGENT_FAILED')) AS failure_count, n(count(*) FILTER (event_type = 'AGENT_TIMEOUT')) AS timeout_count,
  r6(davg(step_count)) AS avg_steps, r6(davg(loop_count)) AS avg_loop_count, n(sum(handoff_count)) AS handoff_count,
  r6(davg(latency_ms)) AS avg_latency_ms, 0.0::DOUBLE AS total_cost_usd
FROM obs WHERE event_type LIKE 'AGENT\\_%' ESCAPE '\\' GROUP BY agent_id, hour""")
def _(c: Context):
    return rollups.hourly_agent(c.costed)


@query("hourly_tool_metrics", "A3", f"""
WITH rows AS (SELECT *, {_HOUR} FROM full_events WHERE event_type IN ('TOOL_CALL_COMPLETED', 'TOOL_CALL_FAILED', 'TOOL_CALL_TIMEOUT')),
top AS (SELECT tool_id, hour, error_code FROM (SELECT tool_id, hour, error_code, count(*) AS c FROM rows WHERE status = 'failed' AND error_code IS NOT NULL GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY tool_id, hour ORDER BY c DESC, error_code) = 1)
SELECT r.tool_id, r.hour, n(count(*)) AS call_count, n(count(*) FILTER (event_type = 'TOOL_CALL_FAILED')) AS failure_count,
  n(count(*) FILTER (event_type = 'TOOL_CALL_TIMEOUT')) AS timeout_count, n(sum(retry_count)) AS retry_count,
  r6(quantile_cont(latency_ms, 0.95)) AS p95_latency_ms, any_value(top.error_code) AS top_error_code
FROM rows r LEFT JOIN top ON r.tool_id = top.tool_id AND r.hour = top.hour GROUP BY r.tool_id, r.hour""")
def _(c: Context):
    return rollups.hourly_tool(c.full)


@query("hourly_llm_metrics", "A4", f"""
SELECT model_name, prompt_template_id, agent_id, coalesce(application_id, '*') AS application_id, {_HOUR},
  n(count(*) FILTER (event_type IN ('LLM_CALL_COMPLETED', 'LLM_CALL_FAILED'))) AS call_count,
  n(count(*) FILTER (event_type = 'LLM_CALL_FAILED')) AS failure_count, n(count(*) FILTER (event_type = 'LLM_RATE_LIMITED')) AS rate_limit_count,
  n(count(*) FILTER (event_type = 'LLM_SAFETY_BLOCKED')) AS safety_block_count, n(sum(input_tokens)) AS input_tokens, n(sum(output_tokens)) AS output_tokens,
  dbl(sum(estimated_cost_usd)) AS total_cost_usd, r6(davg(time_to_first_token_ms)) AS avg_ttft_ms,
  r6(quantile_cont(latency_ms, 0.5)) AS p50_latency_ms, r6(quantile_cont(latency_ms, 0.99)) AS p99_latency_ms
FROM costed WHERE event_type LIKE 'LLM%' GROUP BY ALL""")
def _(c: Context):
    return rollups.hourly_llm(c.costed)


@query("hourly_rag_metrics", "A5", f"""
SELECT rag_id, {_HOUR}, n(count(*)) AS retrieval_count, n(count(*) FILTER (event_type = 'RAG_NO_RESULT')) AS no_result_count, n(0) AS failure_count,
  r6(davg(avg_relevance_score)) AS avg_relevance_score, r6(davg(citation_coverage)) AS avg_citation_coverage,
  n(count(*) FILTER (truncation_flag)) AS truncation_count, r6(quantile_cont(latency_ms, 0.95)) AS p95_latency_ms
FROM obs WHERE event_type LIKE 'RAG%' GROUP BY ALL""")
def _(c: Context):
    return rollups.hourly_rag(c.obs)


@query("daily_feedback_metrics", "A6", """
WITH f AS (SELECT agent_id, event_date AS day, feedback_category AS k, rating FROM obs WHERE event_type = 'FEEDBACK_SUBMITTED'),
g AS (SELECT agent_id, day, string_agg(k || '=' || c, ',' ORDER BY k) AS category_counts FROM (SELECT agent_id, day, k, count(*) AS c FROM f GROUP BY ALL) GROUP BY ALL)
SELECT f.agent_id, f.day, n(count(*)) AS feedback_count, n(count(*) FILTER (rating >= 4)) AS positive_count, n(count(*) FILTER (rating <= 2)) AS negative_count,
  r6(sum(rating) / count(rating)) AS avg_rating, any_value(g.category_counts) AS category_counts
FROM f JOIN g ON f.agent_id = g.agent_id AND f.day = g.day GROUP BY f.agent_id, f.day""")
def _(c: Context):
    pairs = F.transform(F.map_entries("category_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return rollups.daily_feedback(c.obs).withColumn("category_counts", F.array_join(pairs, ","))


_KPIS = """
SELECT 'request_count' AS metric_id, application_id, event_date AS day, CAST(count(*) AS DOUBLE) AS value FROM costed WHERE event_type = 'REQUEST_COMPLETED' GROUP BY ALL
UNION ALL SELECT 'error_rate_pct', application_id, event_date, 100.0 * count(*) FILTER (event_type = 'REQUEST_FAILED') / count(*) FROM costed GROUP BY ALL
UNION ALL SELECT 'llm_cost_usd', application_id, event_date, CAST(sum(estimated_cost_usd) AS DOUBLE) FROM costed WHERE event_type LIKE 'LLM%' GROUP BY ALL
UNION ALL SELECT 'llm_tokens_total', application_id, event_date, CAST(sum(CAST(coalesce(input_tokens, 0) AS BIGINT) + coalesce(output_tokens, 0)) AS DOUBLE) FROM costed WHERE event_type LIKE 'LLM%' GROUP BY ALL"""


def _kpi_values(c: Context):
    return metrics.daily_values(c.costed, ["request_count", "error_rate_pct", "llm_cost_usd", "llm_tokens_total"])


@query("daily_kpi_status", "A7 K3", f"""
WITH v AS ({_KPIS})
SELECT v.metric_id, v.application_id, v.day, r6(v.value) AS value,
  CASE WHEN t.higher_is_worse THEN CASE WHEN v.value >= t.breached THEN 'breached' WHEN v.value >= t.warning THEN 'warning' ELSE 'ok' END
       ELSE CASE WHEN v.value <= t.breached THEN 'breached' WHEN v.value <= t.warning THEN 'warning' ELSE 'ok' END END AS threshold_status
FROM v LEFT JOIN kpi_thresholds t ON v.metric_id = t.metric_id""")
def _(c: Context):
    return rollups.daily_kpi(_kpi_values(c), c.kpi_thresholds)


@query("kpi_trend", "W13 Q24", f"""
WITH v AS ({_KPIS}), w AS (SELECT *, lag(value) OVER (PARTITION BY metric_id, application_id ORDER BY day) AS previous FROM v)
SELECT metric_id, application_id, day, r6(value) AS value, r6(previous) AS previous,
  CASE WHEN value > previous THEN 'up' WHEN value < previous THEN 'down' WHEN previous IS NOT NULL THEN 'flat' END AS trend FROM w""")
def _(c: Context):
    return anomaly.trend(_kpi_values(c), ["metric_id", "application_id"], "value")


@query("hourly_summary", "A8", f"""
SELECT {_HOUR}, application_id, service_name, CASE WHEN event_type LIKE 'REQUEST%' THEN 'request' WHEN event_type LIKE 'TOOL%' THEN 'tool' WHEN event_type LIKE 'LLM%' THEN 'llm'
   WHEN event_type LIKE 'RAG%' THEN 'rag' WHEN event_type LIKE 'AGENT%' THEN 'agent' WHEN event_type LIKE 'GUARD%' THEN 'guardrail' ELSE 'feedback' END AS event_type_group,
  n(count(*)) AS event_count, n(count(*) FILTER (status = 'success')) AS success_count, n(count(*) FILTER (status = 'failed')) AS failure_count,
  r6(davg(latency_ms)) AS avg_latency_ms, n(coalesce(sum({_TOK}) FILTER (event_type LIKE 'LLM%'), 0)) AS total_tokens,
  dbl(coalesce(sum(estimated_cost_usd), 0)) AS total_cost_usd, r6(quantile_cont(latency_ms, 0.95)) AS p95_latency_ms
FROM costed GROUP BY ALL""")
def _(c: Context):
    return rollups.hourly_summary(c.costed)


@query("service_overview", "A19 Q15", f"""
WITH h AS ({_HOURLY_APP.format(keys="application_id, service_name")})
SELECT service_name, n(sum(request_count)) AS total_requests, r6(sum(success_count) / nullif(sum(request_count), 0)) AS success_rate,
  r6(sum(error_count) / nullif(sum(request_count), 0)) AS error_rate, r6(max(p95_latency_ms)) AS p95_latency, n(sum(total_tokens)) AS total_tokens, r6(sum(total_cost_usd)) AS total_cost
FROM h GROUP BY service_name""")
def _(c: Context):
    return rollups.service_overview(rollups.hourly_application(c.costed, ["service_name"])).withColumn("total_cost", F.col("total_cost").cast("double"))


_METRIC_SQL = {
    "request_count": ("application_id, lob", "n(count(*))", "event_type = 'REQUEST_COMPLETED'", "A9"),
    "error_rate_pct": ("application_id, lob", "r6(100.0 * count(*) FILTER (event_type = 'REQUEST_FAILED') / count(*))", "TRUE", "A10"),
    "p95_latency_ms": ("application_id, service_name", "r6(quantile_cont(latency_ms, 0.95))", "TRUE", "A11"),
    "llm_cost_usd": ("application_id, model_name", "dbl(sum(estimated_cost_usd))", "event_type LIKE 'LLM%'", "A12"),
    "llm_tokens_total": ("application_id, model_name", f"n(sum({_TOK}))", "event_type LIKE 'LLM%'", "A12"),
    "agent_success_rate_pct": ("agent_id", f"r6(100.0 * count(*) FILTER (event_type = 'AGENT_COMPLETED') / nullif(count(*) FILTER ({_RUN}), 0))", "event_type LIKE 'AGENT%'", "A13"),
    "rag_no_result_rate_pct": ("rag_id", "r6(100.0 * count(*) FILTER (event_type = 'RAG_NO_RESULT') / count(*))", "event_type LIKE 'RAG%'", "A14"),
    "rag_avg_relevance": ("rag_id", "r6(davg(avg_relevance_score))", "event_type LIKE 'RAG%'", "A14"),
    "feedback_avg_rating": ("application_id, agent_id", "r6(davg(rating))", "event_type LIKE 'FEEDBACK%'", "A15"),
}
for _id, (_dims, _value, _where, _row) in _METRIC_SQL.items():
    def _build(c: Context, metric_id=_id, dims=_dims):
        return metrics.metric(c.costed, metric_id, dims.split(", "), grain="day")

    query(f"metric_{_id}", f"{_row} Q1", f"""
SELECT '{_id}' AS metric_id, {_dims}, date_trunc('day', event_ts) AS period, {_value} AS value FROM costed WHERE {_where} GROUP BY {_dims}, period""")(_build)


@query("metric_lookup", "Q2", """
WITH c(metric_id, metric_name, unit, syn) AS (VALUES """ + ", ".join(
    f"('{m}', '{n}', '{u}', [{', '.join(repr(x) for x in s.split(','))}])" for m, n, u, _, _, s in catalogs.METRIC_CATALOG) + """),
t AS (SELECT DISTINCT error_message AS words FROM obs UNION SELECT 'slow usage and spend per failure rate')
SELECT words, metric_id, unit FROM t JOIN c ON len(list_filter(syn, lambda s: contains(' ' || lower(words) || ' ', ' ' || s || ' '))) > 0""")
def _(c: Context):
    words = c.obs.select(F.col("error_message").alias("words")).distinct().union(
        c.spark.sql("SELECT 'slow usage and spend per failure rate'")).distinct()
    ids = words.select("words", F.explode(metrics.matching_ids(F.col("words"))).alias("metric_id"))
    return ids.join(F.broadcast(metrics.catalog_table(c.spark).select("metric_id", "unit")), "metric_id")


_ROLLED = f"""SELECT application_id, date_trunc('hour', event_ts) AS hour, davg(CASE WHEN {_REQ} THEN latency_ms END) AS a, quantile_cont(latency_ms, 0.95) FILTER ({_REQ}) AS p
  FROM costed WHERE {_REQ} OR event_type LIKE 'LLM%' GROUP BY ALL"""


@query("document_metrics", "A17", f"""
WITH RECURSIVE e AS (SELECT * FROM costed), h AS ({_ROLLED}), {_matched('budgets', 'spend')}, {_BURN}, dc AS ({_DAILY}),
bt AS (SELECT max_spend_usd, sum(cost_usd) AS spend_usd FROM m GROUP BY application_id, limit_model, period, period_start, max_spend_usd, alert_at_pct),
qa AS (SELECT {_WORDS.format('context')} AS c, {_WORDS.format('response')} AS r FROM qa_pairs), qf AS (SELECT len(list_intersect(c, r)) / nullif(len(r), 0) AS f FROM qa)
SELECT 'Request Count' AS metric_name, dbl(count(*) FILTER (event_type IN ('REQUEST_COMPLETED', 'REQUEST_FAILED'))) AS value FROM e
UNION ALL SELECT 'Success Rate', r6(100.0 * count(*) FILTER (event_type = 'REQUEST_COMPLETED') / count(*) FILTER (event_type IN ('REQUEST_COMPLETED', 'REQUEST_FAILED'))) FROM e
UNION ALL SELECT 'Error Rate', r6(100.0 * count(*) FILTER (event_type = 'REQUEST_FAILED') / count(*) FILTER (event_type IN ('REQUEST_COMPLETED', 'REQUEST_FAILED'))) FROM e
UNION ALL SELECT 'Avg Latency', r6(CAST(sum(CAST(a AS DECIMAL(18,6))) AS DOUBLE) / count(a)) FROM h
UNION ALL SELECT 'P95 Latency', r6(max(p)) FROM h
UNION ALL SELECT 'Agent Success Rate', r6(100.0 * count(*) FILTER (event_type = 'AGENT_COMPLETED') / count(*)) FROM e WHERE event_type LIKE 'AGENT%'
UNION ALL SELECT 'Agent Failure Rate', r6(100.0 * count(*) FILTER (event_type <> 'AGENT_COMPLETED') / count(*)) FROM e WHERE event_type LIKE 'AGENT%'
UNION ALL SELECT 'Tool Failure Rate', r6(100.0 * count(*) FILTER (event_type = 'TOOL_CALL_FAILED') / count(*)) FROM e WHERE event_type LIKE 'TOOL%'
UNION ALL SELECT 'Tool Timeout Rate', 0.0::DOUBLE
UNION ALL SELECT 'LLM Total Tokens', dbl(sum(input_tokens + output_tokens)) FROM e WHERE event_type LIKE 'LLM%'
UNION ALL SELECT 'LLM Cost', r6(sum(estimated_cost_usd)) FROM e WHERE event_type LIKE 'LLM%'
UNION ALL SELECT 'LLM Error Rate', r6(100.0 * count(*) FILTER (event_type = 'LLM_CALL_FAILED') / count(*)) FROM e WHERE event_type LIKE 'LLM_CALL%'
UNION ALL SELECT 'RAG No Result Rate', r6(100.0 * count(*) FILTER (event_type = 'RAG_NO_RESULT') / count(*)) FROM e WHERE event_type LIKE 'RAG%'
UNION ALL SELECT 'RAG Faithfulness Score', r6(CAST(sum(CAST(f AS DECIMAL(18,9))) AS DOUBLE) / count(f)) FROM qf
UNION ALL SELECT 'Positive Feedback Rate', r6(100.0 * count(*) FILTER (rating >= 4) / count(*)) FROM e WHERE event_type LIKE 'FEEDBACK%'
UNION ALL SELECT 'Negative Feedback Rate', r6(100.0 * count(*) FILTER (rating <= 2) / count(*)) FROM e WHERE event_type LIKE 'FEEDBACK%'
UNION ALL SELECT 'Budget Utilization', r6(100.0 * CAST(sum(spend_usd) AS DOUBLE) / CAST(sum(max_spend_usd) AS DOUBLE)) FROM bt
UNION ALL SELECT 'SLO Compliance', r6(100.0 * count(*) FILTER (100.0 * good_events / total_events >= CAST(target_pct AS DOUBLE)) / count(*)) FROM dc""".replace("WITH RECURSIVE e", "WITH e").replace("e AS (SELECT s.slo_id", "se AS (SELECT s.slo_id").replace("FROM e x JOIN e y", "FROM se x JOIN se y").replace("b AS (SELECT e.*,", "b AS (SELECT se.*,").replace("FROM e JOIN w ON w.slo_id = e.slo_id AND w.event_id = e.event_id", "FROM se JOIN w ON w.slo_id = se.slo_id AND w.event_id = se.event_id"))
def _(c: Context):
    e = c.costed
    return metrics.document_metrics(
        e, rollups.hourly_application(e), quality.answer_quality(c.qa_pairs), budget.totals(c.spend, c.budgets),
        slo.daily_counts(c.obs, c.slos))


@query("guardrail_block_rate", "A18", """
SELECT n(count(*) FILTER (event_type = 'GUARDRAIL_BLOCKED')) AS blocked, n(count(*) FILTER (event_type = 'GUARDRAIL_EVALUATED')) AS total,
  r6(count(*) FILTER (event_type = 'GUARDRAIL_BLOCKED') / count(*) FILTER (event_type = 'GUARDRAIL_EVALUATED')) AS block_rate FROM obs""")
def _(c: Context):
    return alerts.block_rate(c.obs)


_GUARD = """SELECT *, concat('pol-', CAST(seq % 3 AS {s})) AS policy_id, 'v1' AS policy_version,
  CASE WHEN event_type = 'GUARDRAIL_BLOCKED' THEN 'block' ELSE 'allow' END AS decision,
  CASE seq % 4 WHEN 0 THEN 'pii' WHEN 1 THEN 'bias' ELSE 'toxicity' END AS violation_type,
  CASE seq % 2 WHEN 0 THEN 'input' ELSE 'output' END AS blocked_stage, seq % 7 = 0 AS false_positive_feedback, avg_relevance_score AS risk_score FROM """


@query("guardrail_outcomes", "A42 B4", f"""
WITH g AS ({_GUARD.format(s='VARCHAR')} obs WHERE event_type LIKE 'GUARDRAIL%')
SELECT policy_id, policy_version, decision, violation_type, blocked_stage, n(count(*)) AS evaluations, n(count(*) FILTER (false_positive_feedback)) AS false_positives,
  r6(100.0 * count(*) FILTER (false_positive_feedback) / count(*)) AS false_positive_pct, r6(davg(risk_score)) AS avg_risk_score FROM g GROUP BY ALL""")
def _(c: Context):
    return rollups.guardrail_outcomes(c.spark.sql(_GUARD.format(s="STRING") + "{obs}", obs=c.obs))


@query("compliance_counters", "A43", f"""
WITH g AS ({_GUARD.format(s='VARCHAR')} obs)
SELECT application_id, n(count(*) FILTER (event_type = 'GUARDRAIL_BLOCKED' AND violation_type = 'bias')) AS bias_blocks,
  n(count(DISTINCT prompt_template_id || prompt_version)) AS prompt_versions, n(count(DISTINCT model_name)) AS models FROM g GROUP BY ALL""")
def _(c: Context):
    g = c.spark.sql(_GUARD.format(s="STRING") + "{obs}", obs=c.obs)
    blocks = g.groupBy("application_id").agg(
        F.count_if((F.col("event_type") == "GUARDRAIL_BLOCKED") & (F.col("violation_type") == "bias")).alias("bias_blocks"))
    # Distinct versions and models are few per application; reduce to them before counting.
    kinds = g.select("application_id", F.concat("prompt_template_id", "prompt_version").alias("p"), "model_name").distinct()
    distinct = kinds.groupBy("application_id").agg(
        F.count_distinct("p").alias("prompt_versions"), F.count_distinct("model_name").alias("models"))
    return blocks.join(distinct, "application_id")


@query("tool_reliability", "A30 Q21 Q5", """
WITH r AS (SELECT * FROM full_events WHERE event_type LIKE 'TOOL\\_CALL%' ESCAPE '\\'),
top AS (SELECT application_id, agent_id, tool_id, error_code FROM (SELECT application_id, agent_id, tool_id, error_code, count(*) AS c FROM r WHERE status = 'failed' GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY application_id, agent_id, tool_id ORDER BY c DESC, error_code) = 1)
SELECT r.application_id, r.agent_id, r.tool_id, n(count(*)) AS calls, n(count(*) FILTER (status = 'failed')) AS failures,
  r6(100.0 * count(*) FILTER (status = 'failed') / count(*)) AS failure_pct,
  arg_max(correlation_id, (event_ts, event_id)) FILTER (status = 'failed') AS last_failed_trace,
  r6(quantile_cont(latency_ms, 0.95)) AS p95_latency_ms, any_value(top.error_code) AS top_error
FROM r LEFT JOIN top ON r.application_id = top.application_id AND r.agent_id = top.agent_id AND r.tool_id = top.tool_id GROUP BY r.application_id, r.agent_id, r.tool_id""")
def _(c: Context):
    return rollups.tool_reliability(c.full)


_DIMS = ["application_id", "agent_id", "tool_id", "model_name", "user_id", "error_code"]


@query("error_distributions", "A36 Q4 Q22", "\nUNION ALL\n".join(
    f"SELECT '{d}' AS dimension, {d} AS value, n(count(*)) AS errors FROM full_events WHERE status = 'failed' AND {d} IS NOT NULL GROUP BY {d}" for d in _DIMS))
def _(c: Context):
    return rollups.distribution(c.full, _DIMS)


@query("http_classes", "A36", """
SELECT concat(CAST(http_status // 100 AS VARCHAR), 'xx') AS http_class, n(count(*)) AS responses FROM obs GROUP BY ALL""")
def _(c: Context):
    return rollups.http_split(c.obs)


@query("top_failing", "T3", "\nUNION ALL\n".join(
    f"(SELECT '{d}' AS dimension, {d} AS name, n(count(*) FILTER (status = 'failed')) AS failures FROM obs GROUP BY {d} ORDER BY failures DESC, name LIMIT 5)"
    for d in ("application_id", "agent_id", "tool_id")))
def _(c: Context):
    out = None
    for d in ("application_id", "agent_id", "tool_id"):
        rows = rollups.top_n(c.obs.groupBy(F.col(d).alias("name")).agg(F.count_if(F.col("status") == "failed").alias("failures")), "failures", "name")
        rows = rows.withColumn("dimension", F.lit(d))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("top_lists", "T3 Q16", """
(SELECT 'expensive agents' AS list, agent_id AS name, r6(sum(estimated_cost_usd)) AS measure FROM costed GROUP BY agent_id ORDER BY sum(estimated_cost_usd) DESC, name LIMIT 5)
UNION ALL (SELECT 'empty knowledge bases', rag_id, dbl(count(*) FILTER (event_type = 'RAG_NO_RESULT')) AS m FROM costed WHERE event_type LIKE 'RAG%' GROUP BY rag_id ORDER BY m DESC, rag_id LIMIT 5)
UNION ALL (SELECT 'failed queries', q, dbl(count(*)) AS m FROM (SELECT substr(sha256(concat(prompt_template_id, error_message)), 1, 16) AS q FROM costed WHERE status = 'failed' AND event_type LIKE 'LLM%') x
  GROUP BY q ORDER BY m DESC, q LIMIT 5)""")
def _(c: Context):
    e = c.costed
    query_hash = text.short_hash(F.concat("prompt_template_id", "error_message"))
    lists = {
        "expensive agents": e.groupBy(F.col("agent_id").alias("name")).agg(F.sum("estimated_cost_usd").alias("measure")),
        "empty knowledge bases": e.where("event_type LIKE 'RAG%'").groupBy(F.col("rag_id").alias("name")).agg(
            F.count_if(F.col("event_type") == "RAG_NO_RESULT").alias("measure")),
        "failed queries": e.where("status = 'failed' AND event_type LIKE 'LLM%'").groupBy(query_hash.alias("name")).agg(F.count(F.lit(1)).alias("measure")),
    }
    out = None
    for name, df in lists.items():
        rows = rollups.top_n(df, "measure", "name").select(F.lit(name).alias("list"), "name", F.col("measure").cast("double").alias("measure"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("prompt_comparison", "A35 J11", """
WITH r AS (SELECT * FROM costed WHERE event_type IN ('LLM_CALL_COMPLETED', 'LLM_CALL_FAILED'))
SELECT r.prompt_template_id, r.prompt_version, n(count(*)) AS calls, r6(100.0 * count(*) FILTER (event_type = 'LLM_CALL_FAILED') / count(*)) AS failure_pct,
  dbl(sum(estimated_cost_usd)) AS total_cost_usd, r6(davg(latency_ms)) AS avg_latency_ms, r6(quantile_cont(latency_ms, 0.95)) AS p95_latency_ms,
  any_value(p.status) AS prompt_status, any_value(p.ab_bucket) AS ab_bucket
FROM r LEFT JOIN prompt_registry p ON r.prompt_template_id = p.template_id AND r.prompt_version = CAST(p.version AS VARCHAR) GROUP BY r.prompt_template_id, r.prompt_version""")
def _(c: Context):
    return rollups.prompt_comparison(c.costed, c.prompt_registry)


@query("attachment_telemetry", "A37", """
SELECT application_id, n(count(*)) AS requests, n(count(*) FILTER (handoff_count > 0)) AS requests_with_files, n(count(*) FILTER (handoff_count = 0)) AS requests_without_files,
  n(sum(handoff_count)) AS files, n(sum(handoff_count // 2)) AS images, n(sum(handoff_count - handoff_count // 2)) AS docs,
  n(sum(input_tokens * handoff_count)) AS total_bytes, n(max(input_tokens)) AS largest_bytes FROM obs WHERE event_type = 'REQUEST_RECEIVED' GROUP BY ALL""")
def _(c: Context):
    rows = c.obs.where("event_type = 'REQUEST_RECEIVED'").selectExpr(
        "application_id", "handoff_count AS file_count", "handoff_count div 2 AS image_count", "handoff_count - handoff_count div 2 AS doc_count",
        "CAST(input_tokens * handoff_count AS BIGINT) AS total_file_size_bytes", "input_tokens AS largest_file_bytes")
    return rollups.attachments(rows)


@query("document_ingestion", "A38", """
SELECT lang AS document_format, concat('parser-', CAST(doc_id % 3 AS VARCHAR)) AS parser_used, n(count(*)) AS documents, n(sum(strlen(text))) AS bytes,
  n(sum(n_chars // 3000 + 1)) AS pages, n(sum(n_chars // 512 + 1)) AS chunks, r6(100.0 * count(*) FILTER (doc_id % 17 = 0) / count(*)) AS failure_pct FROM documents GROUP BY ALL""")
def _(c: Context):
    jobs = c.documents.selectExpr(
        "lang AS document_format", "concat('parser-', doc_id % 3) AS parser_used", "CAST(octet_length(text) AS BIGINT) AS document_size_bytes",
        "n_chars div 3000 + 1 AS page_count", "n_chars div 512 + 1 AS chunk_count", "CASE WHEN doc_id % 17 = 0 THEN 'failed' ELSE 'success' END AS extraction_status")
    return rollups.ingestion(jobs)


@query("weekly_adoption_from_hours", "A39 A43 Q26", """
WITH a AS (SELECT application_id, count(DISTINCT user_id) AS n FROM obs WHERE seq % 3 = 0 GROUP BY ALL),
u AS (SELECT application_id, CAST(date_trunc('week', event_ts) AS DATE) AS period_start, count(*) AS events, count(DISTINCT user_id) AS users,
  count(DISTINCT user_id) FILTER (user_id IN (SELECT user_id FROM obs i WHERE i.seq % 3 = 0 AND i.application_id = obs.application_id)) AS shared
  FROM obs GROUP BY ALL)
SELECT u.application_id, period_start, n(events) AS events, n(users) AS active_users, n(a.n) AS users_with_access, CASE WHEN a.n IS NOT NULL THEN n(shared) END AS active_with_access,
  r6(100.0 * shared / a.n) AS adoption_pct FROM u LEFT JOIN a ON a.application_id = u.application_id""")
def _(c: Context):
    """Weekly users of an application, and those among the users with access, from stored hourly sketches."""
    path = f"{run_folder(c)}/hourly"
    sketches.hourly_sketches(c.obs.where("application_id IS NOT NULL"), ["application_id"]).write.parquet(path)
    access = sketches.user_set(c.obs.where("seq % 3 = 0 AND application_id IS NOT NULL"), ["application_id"])
    return sketches.adoption(sketches.over_period(c.spark.read.parquet(path), ["application_id"], "week"), access, ["application_id"])


@query("adoption", "A39 Q26", """
WITH a AS (SELECT n_name AS country, count(*) AS users_with_access FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
u AS (SELECT n_name AS country, count(DISTINCT o_custkey) AS active_users FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY ALL)
SELECT a.country, n(a.users_with_access) AS users_with_access, n(coalesce(u.active_users, 0)) AS active_users, r6(100.0 * coalesce(u.active_users, 0) / a.users_with_access) AS adoption_pct
FROM a LEFT JOIN u ON a.country = u.country""")
def _(c: Context):
    from ..session import small_side

    users = c.customer.join(small_side(c.nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("country"), F.col("c_custkey").alias("user_id"))
    recent = c.orders.where("o_orderdate >= TIMESTAMP_NTZ'1997-01-01 00:00:00'").select(F.col("o_custkey").alias("user_id")).distinct()
    return rollups.adoption(users, users.join(recent, "user_id", "left_semi"), ["country"])


@query("productivity", "A40 Q26", """
SELECT lob, n(count(*)) AS cases, r6(CAST(sum(CAST(input_tokens - output_tokens AS DECIMAL(18,3))) AS DOUBLE)) AS minutes_saved,
  r6(CAST(sum(CAST(input_tokens - output_tokens AS DECIMAL(18,3))) AS DOUBLE) / 60.0 / 160.0) AS fte_saved FROM obs GROUP BY lob""")
def _(c: Context):
    cases = c.obs.selectExpr("lob", "CAST(input_tokens AS DOUBLE) AS baseline_minutes", "CAST(output_tokens AS DOUBLE) AS actual_minutes")
    return rollups.productivity(cases, ["lob"])


@query("guardrail_effectiveness", "A41 Q26", """
SELECT application_id, n(count(*) FILTER (event_type = 'GUARDRAIL_BLOCKED')) AS numerator, n(count(*) FILTER (event_type LIKE 'GUARDRAIL%')) AS denominator,
  r6(100.0 * count(*) FILTER (event_type = 'GUARDRAIL_BLOCKED') / nullif(count(*) FILTER (event_type LIKE 'GUARDRAIL%'), 0)) AS effectiveness_pct FROM obs GROUP BY ALL""")
def _(c: Context):
    t = F.col("event_type")
    return rollups.ratio_kpi(c.obs, ["application_id"], t == "GUARDRAIL_BLOCKED", t.startswith("GUARDRAIL"), "effectiveness_pct")


@query("feedback_rate_per_1000", "A41", """
SELECT application_id, n(count(*) FILTER (event_type LIKE 'FEEDBACK%')) AS numerator, n(count(*) FILTER (event_type LIKE 'REQUEST%')) AS denominator,
  r6(1000.0 * count(*) FILTER (event_type LIKE 'FEEDBACK%') / nullif(count(*) FILTER (event_type LIKE 'REQUEST%'), 0)) AS feedback_per_1000 FROM obs GROUP BY ALL""")
def _(c: Context):
    t = F.col("event_type")
    return rollups.ratio_kpi(c.obs, ["application_id"], t.startswith("FEEDBACK"), t.startswith("REQUEST"), "feedback_per_1000", 1000.0)


@query("compare_weeks", "W12 Q11", """
WITH d AS (SELECT application_id, event_date AS day, count(*) FILTER (status = 'failed') AS failures FROM obs GROUP BY ALL),
p AS (SELECT application_id, coalesce(sum(failures) FILTER (day >= DATE '2024-01-15' AND day < DATE '2024-01-22'), 0) AS current,
        coalesce(sum(failures) FILTER (day >= DATE '2024-01-08' AND day < DATE '2024-01-15'), 0) AS previous
      FROM d WHERE day >= DATE '2024-01-08' AND day < DATE '2024-01-22' GROUP BY ALL)
SELECT application_id, n(current) AS current, n(previous) AS previous, n(current - previous) AS delta, r6(100.0 * (current - previous) / nullif(previous, 0)) AS delta_pct FROM p""")
def _(c: Context):
    daily = c.obs.groupBy("application_id", F.col("event_date").alias("day")).agg(F.count_if(F.col("status") == "failed").alias("failures"))
    return anomaly.compare_periods(daily, ["application_id"], "failures", "2024-01-15")


@query("platform_overview_page", "Q16 Q3", f"""
SELECT {_HOUR}, coalesce(lob, 'shared') AS lob, n(count(*) FILTER ({_REQ})) AS requests, n(count(*) FILTER (event_type = 'REQUEST_FAILED')) AS errors,
  dbl(coalesce(sum(estimated_cost_usd), 0)) AS cost_usd, n(count(*) FILTER (event_type = 'GUARDRAIL_BLOCKED')) AS guardrail_blocks,
  n(count(*) FILTER (event_type = 'FEEDBACK_SUBMITTED' AND rating >= 4)) AS positive, n(count(*) FILTER (event_type = 'FEEDBACK_SUBMITTED' AND rating <= 2)) AS negative
FROM costed GROUP BY ALL""")
def _(c: Context):
    from . import pages

    return pages.platform_overview(c.costed)


@query("llm_usage_page", "Q6 Q10 Q19", """
SELECT model_name, n(count(*)) AS calls, n(sum(input_tokens)) AS input_tokens, n(sum(output_tokens)) AS output_tokens, dbl(sum(estimated_cost_usd)) AS cost_usd,
  r6(CAST(sum(estimated_cost_usd) AS DOUBLE) / nullif(count(*) FILTER (event_type = 'LLM_CALL_COMPLETED'), 0)) AS cost_per_success,
  n(count(*) FILTER (event_type = 'LLM_RATE_LIMITED')) AS rate_limited, r6(quantile_cont(latency_ms, 0.5)) AS p50, r6(quantile_cont(latency_ms, 0.95)) AS p95, r6(quantile_cont(latency_ms, 0.99)) AS p99
FROM spend GROUP BY ALL""")
def _(c: Context):
    from . import pages

    return pages.llm_usage(c.costed)


@query("agent_page", "Q18", """
SELECT agent_id, n(count(*)) AS runs, r6(100.0 * count(*) FILTER (event_type = 'AGENT_COMPLETED') / count(*)) AS success_pct, r6(davg(step_count)) AS avg_steps,
  n(sum(loop_count)) AS loops, n(sum(handoff_count)) AS handoffs, n(count(*) FILTER (event_type = 'AGENT_TIMEOUT')) AS timeouts,
  r6(davg(latency_ms)) AS avg_latency_ms, r6(quantile_cont(latency_ms, 0.95)) AS p95_latency_ms
FROM obs WHERE event_type IN ('AGENT_COMPLETED', 'AGENT_FAILED', 'AGENT_TIMEOUT') GROUP BY ALL""")
def _(c: Context):
    from . import pages

    return pages.agents(c.obs)


@query("application_page", "Q17", f"""
SELECT application_id, n(count(*) FILTER ({_REQ})) AS requests, n(count(*) FILTER (event_type = 'REQUEST_FAILED')) AS errors,
  r6(count(*) FILTER ({_REQ}) / nullif(count(*) FILTER (event_type = 'REQUEST_FAILED'), 0)) AS request_to_error,
  r6(davg(CASE WHEN {_REQ} THEN latency_ms END)) AS avg_ms, r6(max(CASE WHEN {_REQ} THEN latency_ms END)) AS max_ms, dbl(coalesce(sum(estimated_cost_usd), 0)) AS cost_usd,
  r6(quantile_cont(latency_ms, 0.95) FILTER ({_REQ})) AS p95_ms FROM costed GROUP BY ALL""")
def _(c: Context):
    from . import pages

    return pages.applications(c.costed)


@query("rag_page", "Q7 Q20", """
SELECT rag_id, n(count(*)) AS retrievals, r6(100.0 * count(*) FILTER (event_type = 'RAG_RETRIEVAL_COMPLETED') / count(*)) AS success_pct,
  r6(100.0 * count(*) FILTER (event_type = 'RAG_NO_RESULT') / count(*)) AS no_result_pct, r6(davg(latency_ms)) AS avg_ms, r6(davg(avg_relevance_score)) AS avg_relevance,
  r6(100.0 * davg(citation_coverage)) AS citation_coverage_pct, r6(100.0 * count(*) FILTER (truncation_flag) / count(*)) AS truncation_pct,
  n(count(*) FILTER (avg_relevance_score < 0.3)) AS low_confidence FROM obs WHERE event_type LIKE 'RAG%' GROUP BY ALL""")
def _(c: Context):
    from . import pages

    return pages.retrieval(c.obs)


