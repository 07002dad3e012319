"""The metric catalog: metric id -> expression, allowed dimensions, synonyms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalogs
from ..functions import money
from . import lookups
from .order_stats import exact_avg, percentiles, ratio


def _type(*names: str) -> Column:
    return F.col("event_type").isin(*names)


def _calls() -> Column:
    return F.col("event_type").startswith("LLM_")


@dataclass(frozen=True)
class Metric:
    metric_id: str
    name: str
    unit: str
    dimensions: tuple[str, ...]
    synonyms: tuple[str, ...]
    rows: Column | None = None
    value: Column | None = None
    percentile: tuple[str, float] | None = None
    daily: Column | None = None  # the value over rows of any kind, its own ones picked inside


def registry() -> dict[str, Metric]:
    """Catalog metrics; needs a running session because it holds column expressions."""
    every = F.count(F.lit(1))
    runs = _type("AGENT_COMPLETED", "AGENT_FAILED", "AGENT_TIMEOUT")
    tokens = F.coalesce("input_tokens", F.lit(0)).cast("long") + F.coalesce("output_tokens", F.lit(0)).cast("long")
    built = {
        "request_count": (_type("REQUEST_COMPLETED"), every, None),
        "error_rate_pct": (None, ratio(F.count_if(_type("REQUEST_FAILED")), every, 100.0), None),
        "p95_latency_ms": (None, None, ("latency_ms", 0.95)),
        "llm_cost_usd": (_calls(), F.sum("estimated_cost_usd").cast(money.TOTAL), None),
        "llm_tokens_total": (_calls(), F.sum(tokens), None),
        "agent_success_rate_pct": (F.col("event_type").startswith("AGENT_"), ratio(F.count_if(_type("AGENT_COMPLETED")), F.count_if(runs), 100.0), None),
        "rag_no_result_rate_pct": (F.col("event_type").startswith("RAG_"), ratio(F.count_if(_type("RAG_NO_RESULT")), every, 100.0), None),
        "rag_avg_relevance": (F.col("event_type").startswith("RAG_"), exact_avg("avg_relevance_score"), None),
        "feedback_avg_rating": (F.col("event_type").startswith("FEEDBACK_"), exact_avg("rating"), None),
        "kafka_consumer_lag": (None, F.max_by("lag", F.struct("event_ts", "seq")), None),
    }
    inside = {
        "request_count": F.count_if(_type("REQUEST_COMPLETED")),
        "error_rate_pct": built["error_rate_pct"][1],
        "llm_cost_usd": F.sum(F.when(_calls(), F.col("estimated_cost_usd"))).cast(money.TOTAL),
        "llm_tokens_total": F.sum(F.when(_calls(), tokens)),
    }
    out = {}
    for metric_id, name, unit, _, dims, synonyms in catalogs.METRIC_CATALOG:
        rows, value, pct = built[metric_id]
        out[metric_id] = Metric(metric_id, name, unit, tuple(dims.split(",")), tuple(synonyms.split(",")), rows, value, pct, inside.get(metric_id))
    out["request_error_rate_pct"] = Metric(
        "request_error_rate_pct", "Request error rate", "pct", ("application_id", "lob", "service_name"), (),
        _type("REQUEST_COMPLETED", "REQUEST_FAILED"), ratio(F.count_if(_type("REQUEST_FAILED")), every, 100.0))
    return out


def metric(events: DataFrame, metric_id: str, dims: Sequence[str] = (), filters: Column | None = None,
           grain: str | None = None) -> DataFrame:
    """A catalog metric by allowed dimensions and an optional time grain (hour, day, week, month)."""
    known = registry()
    if metric_id not in known:
        raise KeyError(f"unknown metric {metric_id}")
    m = known[metric_id]
    refused = [d for d in dims if d not in m.dimensions]
    if refused:
        raise ValueError(f"{metric_id} has no dimension {', '.join(refused)}; allowed: {', '.join(m.dimensions)}")
    rows = events if filters is None else events.where(filters)
    rows = rows if m.rows is None else rows.where(m.rows)
    keys = list(dims)
    if grain:
        rows = rows.withColumn("period", F.date_trunc(grain, "event_ts").cast("timestamp_ntz"))
        keys.append("period")
    if m.percentile:
        out = percentiles(rows, keys, m.percentile[0], {"value": m.percentile[1]})
    else:
        out = rows.groupBy(*keys).agg(m.value.alias("value"))
    return out.select(F.lit(metric_id).alias("metric_id"), *keys, "value")


def daily_values(events: DataFrame, metric_ids: Sequence[str]) -> DataFrame:
    """Catalog metrics per application and day, (metric_id, application_id, day, value): the same expressions as
    `metric`, all in one pass. A metric has no value on a day without rows of its kind."""
    known = registry()
    aggregates = []
    for i, metric_id in enumerate(metric_ids):
        m = known[metric_id]
        if m.percentile or m.daily is None or "application_id" not in m.dimensions:
            raise ValueError(f"{metric_id} has no daily value per application")
        rows = F.lit(True) if m.rows is None else m.rows
        aggregates += [F.when(F.count_if(rows) > 0, m.daily.cast("double")).alias(f"m{i}")]
    wide = events.groupBy("application_id", F.col("event_ts").cast("date").alias("day")).agg(*aggregates)
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("metric_id"), F.col(f"m{i}").alias("value")) for i, n in enumerate(metric_ids)]))
    return wide.select("application_id", "day", pairs.alias("p")).select("p.metric_id", "application_id", "day", "p.value").where("value IS NOT NULL")


def catalog_table(spark: SparkSession) -> DataFrame:
    rows = catalogs.METRIC_CATALOG
    flat = catalogs.literal_table(
        spark, rows, "metric_id string, metric_name string, unit string, aggregation string, dims string, syn string")
    return flat.withColumns({"dimensions": F.split("dims", ","), "synonyms": F.split("syn", ",")}).drop("dims", "syn")


def lookup(catalog: DataFrame, words: str) -> DataFrame:
    """Metric ids with a synonym that equals the text, or one of its words, or is a phrase in it."""
    text = F.lower(F.lit(words))
    hit = F.exists("synonyms", lambda s: F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), s, F.lit(" "))))
    return catalog.where(hit).select("metric_id", "metric_name", "unit")


def matching_ids(words: Column) -> Column:
    """Metric ids whose synonyms occur in a text column; the catalog is folded into the expression."""
    spaced = F.concat(F.lit(" "), F.lower(words), F.lit(" "))
    hits = [
        F.when(lookups.any_of([F.contains(spaced, F.lit(f" {s} ")) for s in synonyms.split(",")]), F.lit(metric_id))
        for metric_id, _, _, _, _, synonyms in catalogs.METRIC_CATALOG
    ]
    return F.array_compact(F.array(*hits))


def document_metrics(events: DataFrame, application: DataFrame, scores: DataFrame, spend: DataFrame, compliance: DataFrame) -> DataFrame:
    """The second metric set, long form: (metric_name, value).

    Ratios of sums need no rollup in between and come from one pass over the events. `application` is the
    hourly application rollup (mean and worst hourly latency), `scores` has (faithfulness), `spend` is `budget.totals`,
    `compliance` the daily counts of objectives (`slo.daily_counts`, or `slo.daily_compliance` where it is stored anyway).
    """
    t = F.col("event_type")

    def n(*names: str) -> Column:
        return F.count_if(_type(*names))

    def family(prefix: str) -> Column:
        return F.count_if(t.startswith(prefix))

    tokens = F.coalesce("input_tokens", F.lit(0)).cast("long") + F.coalesce("output_tokens", F.lit(0)).cast("long")
    requests = n("REQUEST_COMPLETED", "REQUEST_FAILED")
    runs = n("AGENT_COMPLETED", "AGENT_FAILED", "AGENT_TIMEOUT")
    tool_calls = n("TOOL_CALL_COMPLETED", "TOOL_CALL_FAILED", "TOOL_CALL_TIMEOUT")
    retrievals = n("RAG_RETRIEVAL_COMPLETED", "RAG_RETRIEVAL_FAILED", "RAG_NO_RESULT")
    feedback = n("FEEDBACK_SUBMITTED")
    given = t == "FEEDBACK_SUBMITTED"
    passes = [
        (events, {
            "Request Count": requests.cast("double"),
            "Success Rate": ratio(n("REQUEST_COMPLETED"), requests, 100.0),
            "Error Rate": ratio(n("REQUEST_FAILED"), requests, 100.0),
            "Agent Success Rate": ratio(n("AGENT_COMPLETED"), runs, 100.0),
            "Agent Failure Rate": ratio(n("AGENT_FAILED", "AGENT_TIMEOUT"), runs, 100.0),
            "Tool Failure Rate": ratio(n("TOOL_CALL_FAILED"), tool_calls, 100.0),
            "Tool Timeout Rate": ratio(n("TOOL_CALL_TIMEOUT"), tool_calls, 100.0),
            "LLM Total Tokens": F.sum(F.when(t.startswith("LLM_"), tokens)).cast("double"),
            "LLM Cost": F.sum(F.when(t.startswith("LLM_"), F.col("estimated_cost_usd"))).cast("double"),
            "LLM Error Rate": ratio(n("LLM_CALL_FAILED"), n("LLM_CALL_COMPLETED", "LLM_CALL_FAILED"), 100.0),
            "RAG No Result Rate": ratio(n("RAG_NO_RESULT"), retrievals, 100.0),
            "Positive Feedback Rate": ratio(F.count_if(given & (F.col("rating") >= 4)), feedback, 100.0),
            "Negative Feedback Rate": ratio(F.count_if(given & (F.col("rating") <= 2)), feedback, 100.0)}),
        (application, {"Avg Latency": exact_avg("avg_latency_ms", 6), "P95 Latency": F.max("p95_latency_ms")}),
        (scores, {"RAG Faithfulness Score": exact_avg("faithfulness", 9)}),
        (spend, {"Budget Utilization": ratio(F.sum("spend_usd").cast("double"), F.sum("max_spend_usd").cast("double"), 100.0)}),
        (compliance, {"SLO Compliance": ratio(F.count_if(F.col("sli_pct") >= F.col("target_pct").cast("double")), F.count("sli_pct"), 100.0)}),
    ]
    out = None
    for df, metrics in passes:
        one = df.agg(*[c.alias(f"m{i}") for i, c in enumerate(metrics.values())])
        pairs = F.explode(F.array(*[
            F.struct(F.lit(name).alias("metric_name"), F.col(f"m{i}").alias("value")) for i, name in enumerate(metrics)]))
        rows = one.select(pairs.alias("p")).select("p.metric_name", "p.value")
        out = rows if out is None else out.unionByName(rows)
    return out
