"""Catalog seeds as DataFrames: error rules, metrics, prices, alert rules, retention.

Everything here is bounded configuration (tens of rows), never data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession

# --------------------------------------------------------------------------
# Error taxonomy.  code | category | pattern | priority | severity | retryable
# Evaluation order is (priority, code); patterns match case-insensitively anywhere.
# --------------------------------------------------------------------------
ERROR_RULES = [
    ("L0001", "llm", "(RateLimit|429|ResourceExhausted)", 10, "warning", True),
    ("L0002", "llm", "(SafetyError|blocked by safety|content filter)", 10, "warning", False),
    ("L0003", "llm", "(context.length|token limit|maximum context)", 10, "error", False),
    ("L0004", "llm", "(503|ServiceUnavailable|connection.*(vertex|model))", 20, "critical", True),
    ("L0999", "llm", "LLM", 90, "error", False),
    ("T0001", "tool", "(TimeoutError|ReadTimeout|deadline)", 10, "error", True),
    ("T0002", "tool", "(401|403|Unauthorized|Forbidden)", 10, "error", False),
    ("T0003", "tool", "(ValidationError|invalid input schema)", 10, "error", False),
    ("T0999", "tool", "Tool", 90, "error", False),
    ("A0001", "agent", "(max.steps|step limit|loop limit)", 10, "error", False),
    ("A0002", "agent", "handoff", 20, "error", True),
    ("A0003", "agent", "(AgentTimeout|execution deadline)", 10, "error", True),
    ("A0999", "agent", "Agent", 90, "error", False),
    ("R0001", "rag", "(index unavailable|pgvector|vector.*connect)", 10, "critical", True),
    ("R0002", "rag", "(embedding.*(fail|error))", 10, "error", True),
    ("R0999", "rag", "(RAG|retriev)", 90, "error", False),
    ("G0001", "guardrail", "(policy violation|guardrail)", 10, "warning", False),
    ("P0001", "platform", "(500|502|504|Internal Server Error)", 50, "error", True),
    ("P0002", "platform", "(asyncpg|psycopg|OperationalError|deadlock)", 20, "critical", True),
    ("K0001", "kafka", "(KafkaException|BufferError|broker)", 20, "critical", True),
    ("P0999", "platform", ".*", 999, "error", False),
]

# Usd per 1000 tokens.  model | input | output | provider
MODEL_PRICES = [
    ("gemini-1.5-pro", "0.00125", "0.005", "vertexai"),
    ("gemini-1.5-flash", "0.000075", "0.0003", "vertexai"),
    ("gemini-2.0-flash", "0.0001", "0.0004", "vertexai"),
    ("claude-sonnet-4-5", "0.003", "0.015", "anthropic"),
    ("claude-haiku-4-5", "0.001", "0.005", "anthropic"),
    ("llama-3-70b", "0.00265", "0.0035", "r2d2"),
    ("text-embedding-004", "0.000025", "0.0", "vertexai"),
]
# The producer's price for a model it does not know.
DEFAULT_PRICE = ("0.005", "0.015")
SEED_PRICE_DATE = "2026-01-01"

# Metric catalog.  id | name | unit | aggregation | dimensions | synonyms
METRIC_CATALOG = [
    ("request_count", "Request count", "count", "sum", "application_id,lob,service_name", "requests,traffic,volume"),
    ("error_rate_pct", "Error rate", "pct", "avg", "application_id,lob", "errors,failure rate"),
    ("p95_latency_ms", "P95 latency", "ms", "p95", "application_id,service_name", "latency,response time,slow"),
    ("llm_cost_usd", "LLM cost", "usd", "sum", "application_id,model_name,agent_id", "cost,spend,budget,bill"),
    ("llm_tokens_total", "Total tokens", "tokens", "sum", "application_id,model_name", "tokens,usage"),
    ("agent_success_rate_pct", "Agent success rate", "pct", "avg", "agent_id,application_id", "agent success"),
    ("rag_no_result_rate_pct", "RAG no-result rate", "pct", "avg", "rag_id", "no results,empty retrieval"),
    ("rag_avg_relevance", "RAG relevance", "count", "avg", "rag_id", "relevance,retrieval quality"),
    ("feedback_avg_rating", "Average rating", "count", "avg", "application_id,agent_id", "rating,satisfaction,csat"),
    ("kafka_consumer_lag", "Consumer lag", "count", "last", "group_id,topic", "lag,backlog,behind"),
]

# Named alerts.  id | metric | comparator | threshold | window minutes
ALERT_RULES = [
    ("high_error_rate", "request_error_rate_pct", ">", 5.0, 15),
    ("llm_latency_spike", "llm_p95_latency_ms", ">", 700.0, 15),
    ("tool_failure_spike", "tool_failure_rate_pct", ">", 10.0, 15),
    ("rag_no_result_spike", "rag_no_result_rate_pct", ">", 20.0, 15),
    ("token_cost_anomaly", "cost_vs_previous_day", ">=", 2.0, 1440),
    ("guardrail_block_spike", "guardrail_blocks_vs_previous_day", ">=", 3.0, 1440),
    ("kafka_lag", "kafka_consumer_lag", ">", 1000.0, 10),
    ("negative_feedback_spike", "negative_feedback_pct", ">", 20.0, 60),
    ("loop_agent_stuck", "agent_loops_at_max", ">=", 3.0, 60),
    ("prompt_template_error", "prompt_template_errors", ">", 0.0, 15),
    ("archive_failure", "archive_failures", ">", 0.0, 60),
    ("rollup_missing", "missing_rollup_hours", ">", 0.0, 120),
    ("ingestion_drop", "sink_missing_rows", ">", 0.0, 60),
]

# Burn-rate alert levels.  level | 1 h threshold | 6 h threshold
BURN_LEVELS = [("page", 14.4, 6.0), ("ticket", 3.0, 1.0)]
DAILY_BREACH_BURN_1H = 14.4

# Lifecycle.  policy | warm after days | delete after days
LIFECYCLE_POLICIES = [("hot-warm-30d", 2, 30), ("compliance-180d", 7, 180)]
# Archive prefix -> (infrequent-access days, cold days, expiry days)
TIERING_DEFAULT = (30, 180, None)
TIERING_BY_PREFIX = {
    "debug-bundles": (30, 180, 90),
    "audit-evidence": (30, 90, None),
}
# Payload field -> archive prefix, and the size in bytes beyond which it moves.
ARCHIVE_PREFIX = {
    "prompt": "redacted-prompts",
    "response": "redacted-responses",
    "raw_response": "redacted-responses",
    "rag_context": "rag-contexts",
    "trace_json": "raw-traces",
}
DEFAULT_ARCHIVE_PREFIX = "rag-contexts"
ARCHIVE_FIELDS = ["prompt", "response", "rag_context", "raw_response", "trace_json"]
ARCHIVE_THRESHOLD_BYTES = 2048
# Event type -> prefix of the dated archive layout.
DATED_ARCHIVE_PREFIX = {
    "LLM_CALL_COMPLETED": "redacted-prompts",
    "RAG_RETRIEVAL_COMPLETED": "rag-contexts",
    "AGENT_COMPLETED": "raw-traces",
}
# Upper bounds in seconds of the batch-latency histogram.
LATENCY_BUCKETS_S = [0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]


@dataclass(frozen=True)
class ErrorRule:
    error_code: str
    category: str
    pattern: str
    priority: int
    severity: str
    retryable: bool


def error_rules(rows: Iterable[Sequence] = ERROR_RULES) -> list[ErrorRule]:
    """Rules in evaluation order; ties on priority break by code."""
    return sorted((ErrorRule(*r) for r in rows), key=lambda r: (r.priority, r.error_code))


# Rules beyond this number are not folded into an expression but matched by the index of `rule_index`; the result is the same.
FOLDED_RULES = 200


def error_rules_from_table(df: DataFrame) -> list[ErrorRule] | DataFrame:
    """Active rules of a catalog table: as a list if they are few, else as a table, both fit for enrichment."""
    cols = ["error_code", "category", "pattern", "priority", "severity", "retryable"]
    active = df.where("status = 'active'") if "status" in df.columns else df
    compiler = df.sparkSession._jvm.java.util.regex.Pattern

    def usable(pattern: str) -> bool:  # one bad catalog row must not stop enrichment
        try:
            compiler.compile(pattern)
            return True
        except IllegalArgumentException:
            return False

    rows = active.select(*cols).limit(FOLDED_RULES + 1).collect()
    if len(rows) > FOLDED_RULES:
        return active.select(*cols)
    return error_rules(tuple(r) for r in rows if usable(r["pattern"]))


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A configuration table from literals, typed by a DDL string."""
    names = [part.strip().split(" ")[0] for part in _split_ddl(schema)]
    types = [part.strip().split(" ", 1)[1] for part in _split_ddl(schema)]
    body = ", ".join("(" + ", ".join(_literal(v, t) for v, t in zip(row, types)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def _split_ddl(schema: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for char in schema:
        depth += (char in "(<") - (char in ")>")
        if char == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += char
    return parts + [current]


def _literal(value, sql_type: str) -> str:
    if value is None:
        return f"CAST(NULL AS {sql_type})"
    text = str(value).replace("'", "\\'") if not isinstance(value, bool) else str(value).lower()
    return f"CAST('{text}' AS {sql_type})"


def price_table(spark: SparkSession, rows: Sequence[Sequence] | None = None) -> DataFrame:
    """Effective-dated prices; the default is the seed from its own date on."""
    rows = rows or [(m, SEED_PRICE_DATE, i, o) for m, i, o, _ in MODEL_PRICES]
    return literal_table(
        spark, rows,
        "model_name string, effective_from date, input_usd_per_1k decimal(12,8), output_usd_per_1k decimal(12,8)",
    )


def alert_rule_table(spark: SparkSession, rows: Sequence[Sequence] = ALERT_RULES) -> DataFrame:
    """Alert rules; a row may go on with application, line of business, severity and whether it is enabled."""
    defaults = (None, None, "warning", True)
    return literal_table(
        spark, [(*r, *defaults[len(r) - 5:]) for r in rows],
        "alert_id string, metric_id string, comparator string, threshold double, window_minutes int, "
        "scope_application_id string, scope_lob string, severity string, enabled boolean",
    )
