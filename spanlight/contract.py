"""The event contract: envelope schema, closed vocabularies, rule tables."""

from __future__ import annotations

# --------------------------------------------------------------------------
# Contract 1.0 vocabularies.
# --------------------------------------------------------------------------
EVENT_TYPES_BY_FAMILY = {
    "request": [
        "REQUEST_RECEIVED",
        "REQUEST_COMPLETED",
        "REQUEST_FAILED",
        "RESPONSE_DELIVERED",
    ],
    "orchestration": [
        "AUTH_COMPLETED",
        "CONFIG_LOADED",
        "PLAN_CREATED",
        "AGENT_EXECUTION_REQUEST_PRODUCED",
        "FINAL_RESPONSE_CONSUMED",
        "RESPONSE_BUILT",
    ],
    "kafka": [
        "KAFKA_MESSAGE_PRODUCED",
        "KAFKA_MESSAGE_CONSUMED",
        "KAFKA_MESSAGE_DLQ",
        "KAFKA_LAG_RECORDED",
    ],
    "agent": [
        "AGENT_STARTED",
        "AGENT_STEP_STARTED",
        "AGENT_STEP_COMPLETED",
        "AGENT_LOOP_ITERATION",
        "AGENT_HANDOFF",
        "AGENT_COMPLETED",
        "AGENT_FAILED",
        "AGENT_TIMEOUT",
    ],
    "llm": [
        "LLM_CALL_STARTED",
        "LLM_CALL_COMPLETED",
        "LLM_CALL_FAILED",
        "LLM_RATE_LIMITED",
        "LLM_SAFETY_BLOCKED",
    ],
    "tool": [
        "TOOL_CALL_STARTED",
        "TOOL_CALL_COMPLETED",
        "TOOL_CALL_FAILED",
        "TOOL_CALL_TIMEOUT",
    ],
    "rag": [
        "RAG_RETRIEVAL_STARTED",
        "RAG_RETRIEVAL_COMPLETED",
        "RAG_RETRIEVAL_FAILED",
        "RAG_NO_RESULT",
        "RAG_INDEX_HEALTH_CHECKED",
    ],
    "guardrail": [
        "GUARDRAIL_EVALUATED",
        "GUARDRAIL_BLOCKED",
        "GUARDRAIL_REDACTED",
        "GUARDRAIL_ESCALATED",
    ],
    "feedback": [
        "FEEDBACK_SUBMITTED",
        "FEEDBACK_REVIEWED",
        "FEEDBACK_CLOSED",
    ],
    "document": [
        "DOCUMENT_UPLOADED",
        "DOCUMENT_STORED_IN_S3",
        "DOCUMENT_EXTRACTION_STARTED",
        "DOCUMENT_EXTRACTION_COMPLETED",
        "DOCUMENT_EXTRACTION_FAILED",
        "DOCUMENT_INDEXED",
        "DOCUMENT_EMBEDDING_CREATED",
    ],
}
SERVICE_NAMES = [
    "agentic-orchestration",
    "agent-executor",
    "gssp-gs",
    "gssp-qs",
    "gssp-rs",
    "consumer-service",
    "data-ingestion",
    "user-feedback",
]
TELEMETRY_TYPES = ["event", "log", "metric"]
STRICT_STATUSES = ["success", "failed", "partial", "timeout", "info"]
FEEDBACK_TYPES = [
    "incorrect_response",
    "incomplete",
    "low_confidence",
    "slow",
    "tool_failed",
    "unsafe",
    "rag_missing",
    "formatting",
    "other",
]
FEEDBACK_STATUSES = ["open", "reviewed", "in_progress", "fixed", "wont_fix"]
OPERATIONAL_PATHS = ["/metrics", "/health", "/ready", "/livez"]
TERMINAL_REQUEST_EVENTS = ["REQUEST_COMPLETED", "REQUEST_FAILED"]
QUALITY_EVENTS = ["LLM_CALL_COMPLETED", "RAG_RETRIEVAL_COMPLETED"]

# Event-type prefix -> index family, first match wins, otherwise "requests".
INDEX_ROUTES = [
    ("LLM_CALL", "llm-calls"),
    ("RAG_", "rag-events"),
    ("TOOL_CALL", "tool-calls"),
    ("AGENT", "agent-steps"),
    ("GUARDRAIL", "guardrail-events"),
    ("FEEDBACK", "feedback"),
    ("DOCUMENT", "requests"),
    ("REQUEST", "requests"),
    ("KAFKA", "requests"),
]
DEFAULT_INDEX_FAMILY = "requests"

# Envelope field -> (JSON kind it must have, rule).
#   required: must be present; defaulted: may be absent, must not be null; optional: may be null.
ENVELOPE_RULES = [
    ("event_id", "string", "defaulted"),
    ("schema_version", "string", "defaulted"),
    ("event_type", "string", "required"),
    ("telemetry_type", "string", "defaulted"),
    ("timestamp", "string", "defaulted"),
    ("emitted_at", "string", "defaulted"),
    ("correlation_id", "string", "optional"),
    ("request_id", "string", "optional"),
    ("trace_id", "string", "optional"),
    ("span_id", "string", "optional"),
    ("parent_span_id", "string", "optional"),
    ("service_name", "string", "required"),
    ("component", "string", "optional"),
    ("environment", "string", "required"),
    ("application_id", "string", "optional"),
    ("lob", "string", "optional"),
    ("tenant_id", "string", "optional"),
    ("user_id", "string", "optional"),
    ("status", "string", "required"),
    ("latency_ms", "number", "optional"),
    ("error_code", "string", "optional"),
    ("http_status", "integer", "optional"),
    ("payload", "object", "defaulted"),
]
SCHEMA_VERSION = "1.0"

# Payload columns promoted per family, (name, type).
FAMILY_COLUMNS = {
    "requests": [
        ("method", "string"),
        ("path", "string"),
        ("usecase_id", "string"),
    ],
    "errors": [
        ("error_message", "string"),
        ("error_category", "string"),
        ("error_fingerprint", "string"),
        ("stack_hash", "string"),
        ("retryable", "boolean"),
        ("runbook_url", "string"),
    ],
    "agent-steps": [
        ("agent_id", "string"),
        ("agent_version", "string"),
        ("agent_type", "string"),
        ("execution_mode", "string"),
        ("step_count", "int"),
        ("loop_count", "int"),
        ("handoff_count", "int"),
        ("handoff_to_agent", "string"),
        ("planner_decision", "string"),
        ("termination_reason", "string"),
        ("tools_used", "array<string>"),
        ("models_used", "array<string>"),
        ("estimated_cost_usd", "decimal(12,8)"),
    ],
    "llm-calls": [
        ("agent_id", "string"),
        ("model_provider", "string"),
        ("model_name", "string"),
        ("model_version", "string"),
        ("prompt_template_id", "string"),
        ("prompt_version", "string"),
        ("prompt_hash", "string"),
        ("temperature", "float"),
        ("input_tokens", "int"),
        ("output_tokens", "int"),
        ("total_tokens", "int"),
        ("estimated_cost_usd", "decimal(12,8)"),
        ("time_to_first_token_ms", "double"),
        ("retry_count", "smallint"),
        ("rate_limit_hit", "boolean"),
        ("safety_blocked", "boolean"),
        ("finish_reason", "string"),
        ("llm_error_code", "string"),
    ],
    "tool-calls": [
        ("tool_id", "string"),
        ("tool_name", "string"),
        ("tool_version", "string"),
        ("tool_type", "string"),
        ("called_by_agent_id", "string"),
        ("input_schema_valid", "boolean"),
        ("retry_count", "smallint"),
        ("response_size_bytes", "bigint"),
        ("http_status_upstream", "smallint"),
    ],
    "rag-events": [
        ("rag_id", "string"),
        ("knowledge_base", "string"),
        ("vector_db_index", "string"),
        ("embedding_model", "string"),
        ("query_hash", "string"),
        ("top_k", "smallint"),
        ("chunk_count", "int"),
        ("no_result_flag", "boolean"),
        ("avg_relevance_score", "double"),
        ("reranker_score", "double"),
        ("citation_coverage", "double"),
        ("context_tokens", "int"),
        ("truncation_flag", "boolean"),
        ("source_docs_used", "array<string>"),
    ],
    "guardrail-events": [
        ("policy_id", "string"),
        ("policy_version", "string"),
        ("decision", "string"),
        ("risk_score", "double"),
        ("violation_type", "string"),
        ("redaction_applied", "boolean"),
        ("blocked_stage", "string"),
        ("false_positive_feedback", "boolean"),
    ],
    "feedback": [
        ("agent_id", "string"),
        ("feedback_id", "string"),
        ("usecase_id", "string"),
        ("response_id", "string"),
        ("rating", "smallint"),
        ("thumbs", "string"),
        ("sentiment", "string"),
        ("feedback_category", "string"),
        ("free_text_redacted", "string"),
        ("resolution_status", "string"),
    ],
    "traces": [
        ("span_name", "string"),
        ("span_kind", "string"),
        ("child_count", "int"),
        ("depth", "smallint"),
        ("start_ts", "string"),
        ("end_ts", "string"),
        ("trace_s3_key", "string"),
    ],
    "quality-scores": [
        ("eval_id", "string"),
        ("evaluated_event_id", "string"),
        ("agent_id", "string"),
        ("rag_id", "string"),
        ("eval_type", "string"),
        ("score", "double"),
        ("hallucination_flag", "boolean"),
        ("judge_model", "string"),
        ("judge_prompt_version", "string"),
        ("rationale_s3_key", "string"),
        ("sampled_pct", "float"),
    ],
    "slo-history": [
        ("slo_id", "string"),
        ("sli_pct", "decimal(6,3)"),
        ("burn_rate_1h", "decimal(10,4)"),
        ("burn_rate_6h", "decimal(10,4)"),
        ("error_budget_consumed_pct", "decimal(6,2)"),
        ("breached", "boolean"),
    ],
    "anomalies": [
        ("detector", "string"),
        ("anomaly_score", "double"),
        ("metric_id", "string"),
        ("observed_value", "double"),
        ("expected_value", "double"),
        ("window_start", "string"),
        ("window_end", "string"),
    ],
}
# Producers spell some promoted columns differently; first present key wins.
COLUMN_ALIASES = {
    "execution_mode": ["execution_mode", "agent_execution_mode"],
    "retryable": ["retryable", "error_retryable"],
    "knowledge_base": ["knowledge_base", "rag_knowledge_base"],
    "chunk_count": ["chunk_count", "retrieved_chunk_count"],
    "citation_coverage": ["citation_coverage", "citation_coverage_pct"],
    "truncation_flag": ["truncation_flag", "context_truncation_flag"],
}
# Event-type prefix -> domain table. Scores and objective history are written by their own jobs,
# with the columns of the families quality-scores and slo-history.
DOMAIN_TABLES = {
    "llm_events": ("LLM_", "llm-calls"),
    "agent_events": ("AGENT_", "agent-steps"),
    "rag_events": ("RAG_", "rag-events"),
    "feedback_events": ("FEEDBACK_", "feedback"),
    "tool_events": ("TOOL_", "tool-calls"),
    "guardrail_events": ("GUARDRAIL_", "guardrail-events"),
}

EVENT_TYPES = [t for names in EVENT_TYPES_BY_FAMILY.values() for t in names]
FAMILY_OF_TYPE = {t: fam for fam, names in EVENT_TYPES_BY_FAMILY.items() for t in names}

_SPARK_TYPE = {"string": "string", "number": "double", "integer": "int"}
ENVELOPE_FIELDS = [(name, _SPARK_TYPE[kind]) for name, kind, _ in ENVELOPE_RULES if kind != "object"]
ENVELOPE_DDL = ", ".join(f"{n} {t}" for n, t in ENVELOPE_FIELDS) + ", payload map<string,variant>"
HEADERS_TYPE = "array<struct<key:string,value:binary>>"

# Data rules on the stored tables: (table, rule name, SQL predicate a good row satisfies).
CHECK_RULES = [
    ("tool_registry", "tool_type_known", "tool_type IN ('REST','DB','ServiceNow','RAG','InternalAPI')"),
    ("prompt_registry", "status_known", "status IN ('draft','active','archived')"),
    ("prompt_registry", "traffic_pct_range", "traffic_pct BETWEEN 0 AND 100"),
    ("prompt_audit", "action_known", "action IN ('activated','archived','rolled_back')"),
    ("budget_limits", "period_known", "period IN ('daily','weekly','monthly')"),
    ("budget_limits", "max_spend_positive", "max_spend_usd > 0"),
    ("budget_limits", "alert_pct_range", "alert_at_pct BETWEEN 1 AND 100"),
    ("alert_rules", "comparator_known", "comparator IN ('>','>=','<','<=','==')"),
    ("dashboard_config", "visibility_known", "visibility IN ('platform','lob','team')"),
    ("feedback_case", "rating_range", "rating BETWEEN 1 AND 5"),
    ("feedback_case", "status_known", "status IN ('open','reviewed','in_progress','fixed','wont_fix')"),
    ("feedback_events", "rating_range", "rating BETWEEN 1 AND 5"),
    ("slo_definitions", "sli_type_known", "sli_type IN ('availability','latency','quality','cost')"),
    ("slo_definitions", "target_range", "target_pct > 0 AND target_pct <= 100"),
    ("quality_scores", "eval_type_known", "eval_type IN ('faithfulness','hallucination','answer_relevance','custom')"),
    ("metric_catalog", "source_known", "source_system IN ('obs_events','elasticsearch','prometheus','observability')"),
]
