"""Hourly and daily rollups. Inputs are typed events with promoted payload columns.

Counts and sums use Spark's two-phase aggregation. Percentiles are exact (see order_stats) unless
`approximate` is set, which streams use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import FAMILY_OF_TYPE, TERMINAL_REQUEST_EVENTS
from ..functions import money
from ..functions.times import bucket, day
from .order_stats import exact_avg, ratio, with_percentiles


def _is(*types: str) -> Column:
    return F.col("event_type").isin(*types)


def _family(prefix: str) -> Column:
    return F.col("event_type").startswith(prefix)


def _when(condition: Column, c: str) -> Column:
    return F.when(condition, F.col(c))


def _tokens() -> Column:
    return F.coalesce("input_tokens", F.lit(0)).cast("long") + F.coalesce("output_tokens", F.lit(0)).cast("long")


def _cost(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("estimated_cost_usd"))), F.lit(0)).cast(money.TOTAL)


def hourly_application(events: DataFrame, extra_keys: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Requests, errors, latency percentiles, cost and tokens per application and hour."""
    request, call = _is(*TERMINAL_REQUEST_EVENTS), _family("LLM_")
    rows = events.where(request | call).withColumn("hour", bucket("event_ts", "hour"))
    keys = ["application_id", *extra_keys, "hour"]
    base = rows.groupBy(*keys).agg(
        F.count_if(request).alias("request_count"),
        F.count_if(_is("REQUEST_COMPLETED")).alias("success_count"),
        F.count_if(_is("REQUEST_FAILED")).alias("error_count"),
        exact_avg(_when(request, "latency_ms")).alias("avg_latency_ms"),
        F.coalesce(F.sum(F.when(call, _tokens())), F.lit(0)).alias("total_tokens"),
        _cost(call).alias("total_cost_usd"),
    )
    return with_percentiles(base, rows.where(request), keys, "latency_ms", {
        "p50_latency_ms": 0.5, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99}, approximate)


def hourly_agent(events: DataFrame, max_steps: Column | None = None) -> DataFrame:
    """Runs, outcomes, steps, loops, handoffs, latency and cost per agent and hour."""
    run = _is("AGENT_COMPLETED", "AGENT_FAILED", "AGENT_TIMEOUT")
    rows = events.where(_family("AGENT_")).withColumn("hour", bucket("event_ts", "hour"))
    return rows.groupBy("agent_id", "hour").agg(
        F.count_if(run).alias("run_count"),
        F.count_if(_is("AGENT_COMPLETED")).alias("success_count"),
        F.count_if(_is("AGENT_FAILED")).alias("failure_count"),
        F.count_if(_is("AGENT_TIMEOUT")).alias("timeout_count"),
        exact_avg(_when(run, "step_count")).alias("avg_steps"),
        exact_avg(_when(run, "loop_count")).alias("avg_loop_count"),
        F.coalesce(F.sum("handoff_count"), F.lit(0)).cast("long").alias("handoff_count"),
        exact_avg(_when(run, "latency_ms")).alias("avg_latency_ms"),
        _cost(F.lit(True)).alias("total_cost_usd"),
    )


def most_frequent(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The most frequent value per key, ties to the smaller value; counted before it is ranked."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(name))


def hourly_tool(events: DataFrame, top_error: bool = True) -> DataFrame:
    """Calls, failures, timeouts, retries, p95 and the most frequent error per tool and hour."""
    done = _is("TOOL_CALL_COMPLETED", "TOOL_CALL_FAILED", "TOOL_CALL_TIMEOUT")
    rows = events.where(done).withColumn("hour", bucket("event_ts", "hour"))
    keys = ["tool_id", "hour"]
    base = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("call_count"),
        F.count_if(_is("TOOL_CALL_FAILED")).alias("failure_count"),
        F.count_if(_is("TOOL_CALL_TIMEOUT")).alias("timeout_count"),
        F.coalesce(F.sum("retry_count"), F.lit(0)).cast("long").alias("retry_count"),
    )
    out = with_percentiles(base, rows, keys, "latency_ms", {"p95_latency_ms": 0.95})
    if not top_error:
        return out
    return out.join(most_frequent(rows.where("status = 'failed'"), keys, "error_code", "top_error_code"), keys, "left")


def hourly_llm(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Usage, cost and reliability per model, template, agent, application and hour; '*' for missing keys."""
    keys = ["model_name", "prompt_template_id", "agent_id", "application_id", "hour"]
    call = _is("LLM_CALL_COMPLETED", "LLM_CALL_FAILED")
    rows = events.where(_family("LLM_")).withColumns({
        **{k: F.coalesce(k, F.lit("*")) for k in keys[:-1]}, "hour": bucket("event_ts", "hour")})
    base = rows.groupBy(*keys).agg(
        F.count_if(call).alias("call_count"),
        F.count_if(_is("LLM_CALL_FAILED")).alias("failure_count"),
        F.count_if(_is("LLM_RATE_LIMITED")).alias("rate_limit_count"),
        F.count_if(_is("LLM_SAFETY_BLOCKED")).alias("safety_block_count"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).cast("long").alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).cast("long").alias("output_tokens"),
        _cost(F.lit(True)).alias("total_cost_usd"),
        exact_avg("time_to_first_token_ms").alias("avg_ttft_ms"),
    )
    return with_percentiles(base, rows, keys, "latency_ms", {"p50_latency_ms": 0.5, "p99_latency_ms": 0.99}, approximate)


def hourly_rag(events: DataFrame) -> DataFrame:
    """Retrievals, empty results, failures, relevance, coverage, truncation and p95 per knowledge base."""
    rows = events.where(_family("RAG_")).withColumn("hour", bucket("event_ts", "hour"))
    keys = ["rag_id", "hour"]
    base = rows.groupBy(*keys).agg(
        F.count_if(_is("RAG_RETRIEVAL_COMPLETED", "RAG_RETRIEVAL_FAILED", "RAG_NO_RESULT")).alias("retrieval_count"),
        F.count_if(_is("RAG_NO_RESULT")).alias("no_result_count"),
        F.count_if(_is("RAG_RETRIEVAL_FAILED")).alias("failure_count"),
        exact_avg("avg_relevance_score").alias("avg_relevance_score"),
        exact_avg("citation_coverage").alias("avg_citation_coverage"),
        F.count_if("truncation_flag").alias("truncation_count"),
    )
    return with_percentiles(base, rows, keys, "latency_ms", {"p95_latency_ms": 0.95})


def daily_feedback(events: DataFrame) -> DataFrame:
    """Feedback counts, sentiment split, rating and a count map per category.

    Counted per category first, so the map is built from one row per category.
    """
    rows = events.where(_is("FEEDBACK_SUBMITTED")).withColumn("day", day("event_ts"))
    per_category = rows.groupBy("agent_id", "day", "feedback_category").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("rating") >= 4).alias("pos"),
        F.count_if(F.col("rating") <= 2).alias("neg"),
        F.sum("rating").alias("stars"), F.count("rating").alias("rated"),
    )
    entry = F.struct(F.coalesce("feedback_category", F.lit("uncategorised")).alias("k"), F.col("n").alias("v"))
    return per_category.groupBy("agent_id", "day").agg(
        F.sum("n").alias("feedback_count"), F.sum("pos").alias("positive_count"), F.sum("neg").alias("negative_count"),
        ratio(F.sum("stars"), F.sum("rated")).alias("avg_rating"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("category_counts"),
    )


def event_group(event_type: Column) -> Column:
    """Family of an event type, from the vocabulary."""
    known = F.create_map(*[F.lit(x) for pair in FAMILY_OF_TYPE.items() for x in pair])
    return F.coalesce(F.try_element_at(known, event_type), F.lit("other"))


def hourly_summary(events: DataFrame) -> DataFrame:
    """Volume, outcome, latency, tokens and cost per application, service and event group."""
    keys = ["hour", "application_id", "service_name", "event_type_group"]
    rows = events.withColumns({"hour": bucket("event_ts", "hour"), "event_type_group": event_group(F.col("event_type"))})
    base = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col("status") == "success").alias("success_count"),
        F.count_if(F.col("status") == "failed").alias("failure_count"),
        exact_avg("latency_ms").alias("avg_latency_ms"),
        F.coalesce(F.sum(F.when(_family("LLM_"), _tokens())), F.lit(0)).alias("total_tokens"),
        _cost(_family("LLM_")).alias("total_cost_usd"),
    )
    return with_percentiles(base, rows, keys, "latency_ms", {"p95_latency_ms": 0.95})


def service_overview(hourly: DataFrame) -> DataFrame:
    """Per service: ratios of sums, worst hourly p95, totals. Input: hourly_application by service."""
    requests = F.sum("request_count")
    return hourly.groupBy("service_name").agg(
        requests.alias("total_requests"),
        ratio(F.sum("success_count"), requests).alias("success_rate"),
        ratio(F.sum("error_count"), requests).alias("error_rate"),
        F.max("p95_latency_ms").alias("p95_latency"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("total_cost_usd").alias("total_cost"),
    )


def daily_kpi(values: DataFrame, thresholds: DataFrame) -> DataFrame:
    """KPI values (metric_id, application_id, day, value) with status ok, warning or breached."""
    from ..session import small_side

    sign = F.when(F.col("higher_is_worse"), F.lit(1.0)).otherwise(F.lit(-1.0))
    joined = values.join(small_side(thresholds), "metric_id", "left")
    status = (
        F.when(F.col("value") * sign >= F.col("breached") * sign, "breached")
        .when(F.col("value") * sign >= F.col("warning") * sign, "warning").otherwise("ok")
    )
    return joined.withColumn("threshold_status", status).drop("warning", "breached", "higher_is_worse")


def guardrail_outcomes(events: DataFrame) -> DataFrame:
    """Guardrail decisions per policy, version, decision, violation type and stage."""
    rows = events.where(_family("GUARDRAIL_"))
    return rows.groupBy("policy_id", "policy_version", "decision", "violation_type", "blocked_stage").agg(
        F.count(F.lit(1)).alias("evaluations"),
        F.count_if("false_positive_feedback").alias("false_positives"),
        ratio(F.count_if("false_positive_feedback"), F.count(F.lit(1)), 100.0).alias("false_positive_pct"),
        exact_avg("risk_score").alias("avg_risk_score"),
    )


def tool_reliability(events: DataFrame) -> DataFrame:
    """Per application, agent and tool: calls, failures, p95, top error and the last failed trace."""
    done = _is("TOOL_CALL_COMPLETED", "TOOL_CALL_FAILED", "TOOL_CALL_TIMEOUT")
    rows = events.where(done)
    keys = ["application_id", "agent_id", "tool_id"]
    failed = F.col("status") == "failed"
    base = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(failed).alias("failures"),
        ratio(F.count_if(failed), F.count(F.lit(1)), 100.0).alias("failure_pct"),
        F.max_by(F.when(failed, F.col("correlation_id")), F.when(failed, F.struct("event_ts", "event_id"))).alias("last_failed_trace"),
    )
    out = with_percentiles(base, rows, keys, "latency_ms", {"p95_latency_ms": 0.95})
    return out.join(most_frequent(rows.where(failed), keys, "error_code", "top_error"), keys, "left")


def distribution(events: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Long table (dimension, value, errors): one pass over failed events for all dimensions."""
    failed = events.where("status = 'failed'")
    pairs = F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions]))
    return failed.select(pairs.alias("p")).groupBy("p.dimension", "p.value").agg(F.count(F.lit(1)).alias("errors")).where(
        F.col("value").isNotNull())


def http_split(events: DataFrame) -> DataFrame:
    """Responses by status class, 2xx to 5xx."""
    return events.where(F.col("http_status").isNotNull()).groupBy(
        F.concat((F.floor(F.col("http_status") / 100)).cast("string"), F.lit("xx")).alias("http_class")
    ).agg(F.count(F.lit(1)).alias("responses"))


def top_n(df: DataFrame, measure: str, key: str, n: int = 5) -> DataFrame:
    """Highest n rows, ties by key; Spark keeps n rows per task (TakeOrdered)."""
    return df.orderBy(F.col(measure).desc(), F.col(key)).limit(n)


def prompt_comparison(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Cost, latency and failures per prompt version and experiment bucket."""
    from ..session import small_side

    dim = small_side(registry.select(
        F.col("template_id").alias("prompt_template_id"), F.col("version").cast("string").alias("prompt_version"),
        "status", "ab_bucket").withColumnRenamed("status", "prompt_status"))
    rows = events.where(_is("LLM_CALL_COMPLETED", "LLM_CALL_FAILED"))
    keys = ["prompt_template_id", "prompt_version"]
    base = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"),
        ratio(F.count_if(_is("LLM_CALL_FAILED")), F.count(F.lit(1)), 100.0).alias("failure_pct"),
        _cost(F.lit(True)).alias("total_cost_usd"), exact_avg("latency_ms").alias("avg_latency_ms"))
    out = with_percentiles(base, rows, keys, "latency_ms", {"p95_latency_ms": 0.95})
    return out.join(dim, keys, "left")


def attachments(events: DataFrame) -> DataFrame:
    """Attachment telemetry per application: requests with and without files, sizes, kinds."""
    return events.groupBy("application_id").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.coalesce("file_count", F.lit(0)) > 0).alias("requests_with_files"),
        F.count_if(F.coalesce("file_count", F.lit(0)) == 0).alias("requests_without_files"),
        F.sum("file_count").alias("files"), F.sum("image_count").alias("images"), F.sum("doc_count").alias("docs"),
        F.sum("total_file_size_bytes").alias("total_bytes"), F.max("largest_file_bytes").alias("largest_bytes"),
    )


def ingestion(jobs: DataFrame) -> DataFrame:
    """Document ingestion per format and parser: documents, pages, chunks, failures."""
    return jobs.groupBy("document_format", "parser_used").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("document_size_bytes").alias("bytes"),
        F.sum("page_count").alias("pages"), F.sum("chunk_count").alias("chunks"),
        ratio(F.count_if(F.col("extraction_status") == "failed"), F.count(F.lit(1)), 100.0).alias("failure_pct"),
    )


def adoption(access: DataFrame, active: DataFrame, keys: Sequence[str], approximate: bool = False) -> DataFrame:
    """Active users against users with access. Distinct users are counted by (key, user) first."""
    users = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    with_access = access.groupBy(*keys).agg(users.alias("users_with_access"))
    using = active.groupBy(*keys).agg(users.alias("active_users"))
    return with_access.join(using, list(keys), "left").withColumn(
        "active_users", F.coalesce("active_users", F.lit(0))
    ).withColumn("adoption_pct", ratio(F.col("active_users"), F.col("users_with_access"), 100.0))


def ratio_kpi(rows: DataFrame, keys: Sequence[str], numerator: Column, denominator: Column, name: str,
              scale: float = 100.0) -> DataFrame:
    """Generic ratio: scale * rows matching numerator / rows matching denominator."""
    return rows.groupBy(*keys).agg(
        F.count_if(numerator).alias("numerator"), F.count_if(denominator).alias("denominator"),
    ).withColumn(name, ratio(F.col("numerator"), F.col("denominator"), scale))


def productivity(cases: DataFrame, keys: Sequence[str], hours_per_fte: float = 160.0) -> DataFrame:
    """Time saved against the baseline handling time, and the same in full-time equivalents."""
    saved = F.sum((F.col("baseline_minutes") - F.col("actual_minutes")).cast("decimal(18,3)"))
    return cases.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cases"), saved.cast("double").alias("minutes_saved"),
    ).withColumn("fte_saved", F.col("minutes_saved") / 60.0 / F.lit(hours_per_fte))


