"""Page data and question functions: thin compositions over the operators.

Each takes typed events (already filtered by time, application or line of business by the caller;
those filters push down to the scan) and returns the rows a page or an answer shows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import TERMINAL_REQUEST_EVENTS
from ..functions import money
from ..functions.times import bucket
from ..operators import anomaly, feedback, lookups, rca, rollups, traces
from ..operators.order_stats import exact_avg, ratio, with_percentiles


def _type(*names: str) -> Column:
    return F.col("event_type").isin(*names)


def _request() -> Column:
    return _type(*TERMINAL_REQUEST_EVENTS)


def _cost() -> Column:
    return F.coalesce(F.sum("estimated_cost_usd"), F.lit(0)).cast(money.TOTAL)


def in_window(events: DataFrame, start: str | None = None, end: str | None = None, **equals) -> DataFrame:
    """Time window [start, end) and equality filters, pushed to the scan by Catalyst."""
    out = events
    if start:
        out = out.where(F.col("event_ts") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        out = out.where(F.col("event_ts") < F.lit(end).cast("timestamp_ntz"))
    for name, value in equals.items():
        out = out.where(F.col(name) == F.lit(value))
    return out


def platform_overview(events: DataFrame) -> DataFrame:
    """Requests, errors, cost, blocks and feedback per hour and line of business."""
    submitted = F.col("event_type") == "FEEDBACK_SUBMITTED"
    return events.groupBy(bucket("event_ts", "hour").alias("hour"), F.coalesce("lob", F.lit("shared")).alias("lob")).agg(
        F.count_if(_request()).alias("requests"), F.count_if(_type("REQUEST_FAILED")).alias("errors"), _cost().alias("cost_usd"),
        F.count_if(_type("GUARDRAIL_BLOCKED")).alias("guardrail_blocks"),
        F.count_if(submitted & (F.col("rating") >= 4)).alias("positive"),
        F.count_if(submitted & (F.col("rating") <= 2)).alias("negative"))


def applications(events: DataFrame) -> DataFrame:
    """Requests, errors, latency and cost per application."""
    latency = F.when(_request(), F.col("latency_ms"))
    errors = F.count_if(_type("REQUEST_FAILED"))
    base = events.groupBy("application_id").agg(
        F.count_if(_request()).alias("requests"), errors.alias("errors"),
        ratio(F.count_if(_request()), errors).alias("request_to_error"),
        exact_avg(latency).alias("avg_ms"), F.max(latency).alias("max_ms"), _cost().alias("cost_usd"))
    return with_percentiles(base, events.where(_request()), ["application_id"], "latency_ms", {"p95_ms": 0.95})


def agents(events: DataFrame) -> DataFrame:
    """Runs, success, steps, loops, handoffs and latency per agent."""
    rows = events.where(_type("AGENT_COMPLETED", "AGENT_FAILED", "AGENT_TIMEOUT"))
    base = rows.groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("runs"), ratio(F.count_if(_type("AGENT_COMPLETED")), F.count(F.lit(1)), 100.0).alias("success_pct"),
        exact_avg("step_count").alias("avg_steps"), F.sum("loop_count").alias("loops"), F.sum("handoff_count").alias("handoffs"),
        F.count_if(_type("AGENT_TIMEOUT")).alias("timeouts"), exact_avg("latency_ms").alias("avg_latency_ms"))
    return with_percentiles(base, rows, ["agent_id"], "latency_ms", {"p95_latency_ms": 0.95})


def llm_usage(events: DataFrame) -> DataFrame:
    """Calls, tokens, cost, cost per success and latency per model."""
    rows = events.where(F.col("event_type").startswith("LLM_"))
    base = rows.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
        _cost().alias("cost_usd"),
        (F.sum("estimated_cost_usd").cast("double") / F.nullif(F.count_if(_type("LLM_CALL_COMPLETED")), F.lit(0))).alias("cost_per_success"),
        F.count_if(_type("LLM_RATE_LIMITED")).alias("rate_limited"))
    return with_percentiles(base, rows, ["model_name"], "latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def retrieval(events: DataFrame) -> DataFrame:
    """Volume, success, relevance, coverage and truncation per knowledge base."""
    every = F.count(F.lit(1))
    return events.where(F.col("event_type").startswith("RAG_")).groupBy("rag_id").agg(
        every.alias("retrievals"), ratio(F.count_if(_type("RAG_RETRIEVAL_COMPLETED")), every, 100.0).alias("success_pct"),
        ratio(F.count_if(_type("RAG_NO_RESULT")), every, 100.0).alias("no_result_pct"), exact_avg("latency_ms").alias("avg_ms"),
        exact_avg("avg_relevance_score").alias("avg_relevance"),
        (F.lit(100.0) * exact_avg("citation_coverage")).alias("citation_coverage_pct"),
        ratio(F.count_if("truncation_flag"), every, 100.0).alias("truncation_pct"),
        F.count_if(F.col("avg_relevance_score") < 0.3).alias("low_confidence"))


# The question functions by name; filters come from `in_window`.
def get_request_metrics(events, **window):
    return applications(in_window(events, **window))


def get_error_summary(events, dimensions=("application_id", "agent_id", "tool_id", "error_code"), **window):
    return rollups.distribution(in_window(events, **window), dimensions)


def get_tool_failure_summary(events, **window):
    return rollups.tool_reliability(in_window(events, **window))


def get_llm_token_usage(events, **window):
    return llm_usage(in_window(events, **window))


def get_rag_quality_metrics(events, **window):
    return retrieval(in_window(events, **window))


def get_agent_trace(spans, correlation_id: str):
    """Tree and waterfall of one trace."""
    one = spans.where(F.col("correlation_id") == correlation_id)
    shape = traces.tree(one, with_path=True).select("correlation_id", "span_id", "depth", "root_span_id", "child_count", "path", "self_ms")
    return traces.waterfall(one).join(shape, ["correlation_id", "span_id"])


def get_feedback_summary(records, **filters):
    return feedback.summary(feedback.selected(records, **filters))


def get_cost_summary(events, catalog, **window):
    """Cost per application and model with the next cheaper model's price for the same tokens."""
    rows = lookups.with_cheaper_model(in_window(events, **window).where(F.col("event_type").startswith("LLM_")), catalog)
    return rows.groupBy("application_id", "model_name").agg(
        F.count(F.lit(1)).alias("calls"), _cost().alias("cost_usd"),
        F.sum(F.coalesce("alternative_cost_usd", "estimated_cost_usd")).cast(money.TOTAL).alias("cheaper_usd"))


def compare_periods(daily, keys, measure, split, days=7):
    return anomaly.compare_periods(daily, keys, measure, split, days)


def get_top_anomalies(events, keys=("application_id",), value="latency_ms", n=20, **window):
    return anomaly.top_anomalies(anomaly.scored(in_window(events, **window), list(keys), value), n)


def get_sla_breach_summary(events, agents_registry, tools_registry, **window):
    """Tool calls over their registered latency target, per tool."""
    rows = lookups.with_agent_and_tool(in_window(events, **window).where(F.col("event_type").startswith("TOOL_")), agents_registry, tools_registry)
    return rows.groupBy("tool_id", "tool_sla_ms").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if("sla_breached").alias("breaches"),
        ratio(F.count_if("sla_breached"), F.count(F.lit(1)), 100.0).alias("breach_pct"))


def get_service_health(events, **window):
    return rollups.service_overview(rollups.hourly_application(in_window(events, **window), ["service_name"]))


def nightly_report(events):
    """Ranked causes per application and day, and the weekly digest built on them."""
    facts = rca.day_facts(events)
    ranked, found = rca.hypotheses(events, facts), rca.incidents(facts)
    return {"incidents": found, "hypotheses": ranked, "digest": rca.weekly_digest(found, ranked)}
