"""Reference-shaped data derived from the given tables, in SQL that Spark and DuckDB both run.

Each view is one SELECT over the driver's tables. `{name}` placeholders stand for the few
expressions the two dialects spell differently. No view samples, caps or filters rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import catalogs

_DIALECT = {
    "spark": {
        "day0": "TIMESTAMP_NTZ'2024-01-01 00:00:00'",
        "hours": "make_dt_interval(0, CAST(({0}) AS INT))",
        "millis": "make_dt_interval(0, 0, 0, CAST(({0}) / 1000.0 AS DECIMAL(18,6)))",
        "idiv": "(({0}) div ({1}))",
        "ascii": "regexp_replace({0}, '[^\\\\x00-\\\\x7F]', 'x')",
    },
    "duckdb": {
        "day0": "TIMESTAMP '2024-01-01 00:00:00'",
        "hours": "to_hours(CAST(({0}) AS INT))",
        "millis": "to_microseconds(CAST(({0}) * 1000 AS BIGINT))",
        "idiv": "(({0}) // ({1}))",
        "ascii": "regexp_replace({0}, '[^\\x00-\\x7F]', 'x', 'g')",
    },
}

OBS = """
SELECT
  event_id                                                   AS seq,
  concat('evt-', event_id)                                   AS event_id,
  CASE event_type
    WHEN 'click'    THEN CASE WHEN event_id % 2 = 0 THEN 'REQUEST_RECEIVED' ELSE 'REQUEST_COMPLETED' END
    WHEN 'error'    THEN CASE WHEN event_id % 3 = 0 THEN 'REQUEST_FAILED'
                              WHEN event_id % 3 = 1 THEN 'TOOL_CALL_FAILED' ELSE 'LLM_RATE_LIMITED' END
    WHEN 'purchase' THEN CASE WHEN event_id % 9 = 0 THEN 'LLM_CALL_FAILED' ELSE 'LLM_CALL_COMPLETED' END
    WHEN 'view'     THEN CASE WHEN event_id % 7 = 0 THEN 'RAG_NO_RESULT' ELSE 'RAG_RETRIEVAL_COMPLETED' END
    ELSE CASE event_id % 6 WHEN 0 THEN 'AGENT_COMPLETED' WHEN 1 THEN 'AGENT_TIMEOUT'
                           WHEN 2 THEN 'TOOL_CALL_COMPLETED' WHEN 3 THEN 'GUARDRAIL_BLOCKED'
                           WHEN 4 THEN 'GUARDRAIL_EVALUATED' ELSE 'FEEDBACK_SUBMITTED' END
  END                                                        AS event_type,
  ts                                                         AS event_ts,
  CAST(ts AS DATE)                                           AS event_date,
  concat('corr-', user_id, '-', CAST(CAST(date_trunc('week', ts) AS DATE) AS STRING)) AS correlation_id,
  concat('sp-', event_id)                                    AS span_id,
  concat('app-', user_id % 12)                               AS application_id,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('lob-', user_id % 3) END AS lob,
  CASE user_id % 8 WHEN 0 THEN 'agentic-orchestration' WHEN 1 THEN 'agent-executor' WHEN 2 THEN 'gssp-gs'
       WHEN 3 THEN 'gssp-qs' WHEN 4 THEN 'gssp-rs' WHEN 5 THEN 'consumer-service'
       WHEN 6 THEN 'data-ingestion' ELSE 'user-feedback' END AS service_name,
  concat('user-', user_id)                                   AS user_id,
  CASE WHEN event_type = 'error' OR (event_type = 'purchase' AND event_id % 9 = 0)
            OR (event_type = 'signup' AND event_id % 6 = 1) THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN event_type = 'error' OR (event_type = 'purchase' AND event_id % 9 = 0)
            OR (event_type = 'signup' AND event_id % 6 = 1) THEN 500 ELSE 200 END AS http_status,
  CAST(round(value * 20, 3) AS DOUBLE)                       AS latency_ms,
  CASE event_id % 8 WHEN 0 THEN 'gemini-1.5-pro' WHEN 1 THEN 'gemini-1.5-flash' WHEN 2 THEN 'gemini-2.0-flash'
       WHEN 3 THEN 'claude-sonnet-4-5' WHEN 4 THEN 'claude-haiku-4-5' WHEN 5 THEN 'llama-3-70b'
       WHEN 6 THEN 'text-embedding-004' ELSE 'unpriced-model' END AS model_name,
  CAST(floor(value * 10) AS INT)                             AS input_tokens,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)          AS output_tokens,
  CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN 'ResourceExhausted' END AS error_code,
  CASE event_id % 6 WHEN 0 THEN '429 RateLimit from provider' WHEN 1 THEN 'ReadTimeout: deadline exceeded'
       WHEN 2 THEN '503 ServiceUnavailable' WHEN 3 THEN 'psycopg OperationalError'
       WHEN 4 THEN 'policy violation' ELSE '' END            AS error_message,
  concat('agent-', user_id % 6)                              AS agent_id,
  concat('tool-', event_id % 5)                              AS tool_id,
  concat('kb-', event_id % 4)                                AS rag_id,
  concat('tpl-', event_id % 3)                               AS prompt_template_id,
  CAST(event_id % 2 + 1 AS STRING)                           AS prompt_version,
  (CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 100) / 100.0e0 AS avg_relevance_score,
  (event_id % 10) / 10.0e0                                   AS citation_coverage,
  event_id % 11 = 0                                          AS truncation_flag,
  CAST(event_id % 5 + 1 AS INT)                              AS rating,
  CASE event_id % 4 WHEN 0 THEN 'wrong-answer' WHEN 1 THEN 'slow' WHEN 2 THEN 'tool-failed' ELSE 'irrelevant' END AS feedback_category,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 12     AS step_count,
  CAST(event_id % 4 AS INT)                                  AS loop_count,
  CAST(event_id % 3 AS INT)                                  AS handoff_count,
  CAST(event_id % 3 AS INT)                                  AS retry_count,
  round(value, 2)                                            AS time_to_first_token_ms
FROM events
"""

# Spans: trees of 32 spans per trace; even traces are binary, odd traces are chains,
# a few spans point at a parent that never arrived.
SPANS = """
SELECT seq, event_id, event_type, event_ts, application_id, status, latency_ms, input_tokens, output_tokens,
  concat('trc-', CAST({idiv:seq|32} AS STRING)) AS correlation_id,
  concat('sp-', CAST(seq AS STRING)) AS span_id,
  CASE WHEN seq % 32 = 0 THEN NULL
       WHEN seq % 301 = 0 THEN 'sp-lost'
       WHEN {idiv:seq|32} % 2 = 1 THEN concat('sp-', CAST(seq - 1 AS STRING))
       ELSE concat('sp-', CAST(seq - seq % 32 + {idiv:(seq % 32) - 1|2} AS STRING)) END AS parent_span_id
FROM obs
"""

# Started and terminal events of the same span.
SPAN_EVENTS = """
SELECT correlation_id, span_id, parent_span_id, concat(event_id, '-s') AS event_id,
       CAST('STARTED' AS STRING) AS phase, event_ts, CAST(NULL AS STRING) AS status, CAST(NULL AS DOUBLE) AS latency_ms
FROM spans
UNION ALL
SELECT correlation_id, span_id, parent_span_id, concat(event_id, '-t') AS event_id,
       CAST('TERMINAL' AS STRING) AS phase, event_ts + {millis:latency_ms} AS event_ts, status, latency_ms
FROM spans WHERE seq % 13 <> 0
"""

# Raw JSON messages, with every kind of damage the validator has to name.
RAW_EVENTS = """
SELECT seq, CASE WHEN seq % 70 = 0 THEN substr(j, 1, {idiv:length(j)|2})
                 WHEN seq % 71 = 0 THEN concat('[', j, ']') ELSE j END AS value
FROM (
  SELECT seq, concat('{{"event_id":', CASE WHEN seq % 60 = 0 THEN CAST(seq AS STRING) ELSE concat('"', event_id, '"') END,
    CASE WHEN seq % 80 = 0 THEN '' ELSE concat(',"event_type":"', CASE WHEN seq % 50 = 0 THEN 'NOT_A_TYPE' ELSE event_type END, '"') END,
    CASE WHEN seq % 90 = 0 THEN ',"service_name":null' ELSE concat(',"service_name":"', CASE WHEN seq % 55 = 0 THEN 'other' ELSE service_name END, '"') END,
    ',"environment":"dev"',
    CASE WHEN seq % 100 = 0 THEN '' ELSE concat(',"status":"', status, '"') END,
    CASE WHEN seq % 65 = 0 THEN ',"telemetry_type":"trace"' WHEN seq % 3 = 0 THEN ',"telemetry_type":"metric"' ELSE '' END,
    ',"timestamp":"', CAST(event_date AS STRING), 'T00:00:00Z"',
    ',"latency_ms":', CASE WHEN seq % 75 = 0 THEN '"slow"' WHEN seq % 4 = 0 THEN concat('"', CAST(input_tokens AS STRING), '"')
                           WHEN seq % 7 = 0 THEN 'null' ELSE CAST(input_tokens AS STRING) END,
    ',"http_status":', CASE WHEN seq % 85 = 0 THEN '200.5' WHEN seq % 9 = 0 THEN '"200"' ELSE CAST(http_status AS STRING) END,
    ',"application_id":', CASE WHEN seq % 95 = 0 THEN '7' WHEN seq % 8 = 0 THEN 'null' ELSE concat('"', application_id, '"') END,
    ',"correlation_id":"', correlation_id, '"',
    CASE WHEN seq % 45 = 0 THEN ',"payload":null' WHEN seq % 46 = 0 THEN ',"payload":[1]' WHEN seq % 5 = 0 THEN ''
         ELSE concat(',"payload":{{"model_name":"', model_name, '","input_tokens":', CAST(input_tokens AS STRING),
                     ',"output_tokens":', CAST(output_tokens AS STRING), ',"error_message":"', error_message,
                     '","note":"mail u', CAST(seq AS STRING), '@corp.com or 415-555-1234"}}') END,
    '}}') AS j
  FROM obs) x
"""

# Feedback records out of documents and their labels.
FEEDBACK = """
SELECT d.doc_id AS seq, concat('fb-', CAST(d.doc_id AS STRING)) AS feedback_id,
  concat('chat-', CAST({idiv:d.doc_id|3} AS STRING)) AS correlation_id,
  concat('trace-', CAST(d.doc_id AS STRING)) AS trace_id,
  concat('uc-', d.source) AS usecase_id, concat('soe-', CAST(d.doc_id % 2 AS STRING)) AS soe_id,
  CASE WHEN l.toxic = 1 THEN 'unsafe' WHEN d.lang = 'en' THEN 'incorrect_response' WHEN d.lang = 'de' THEN 'Wrong'
       WHEN d.lang = 'fr' THEN 'slow' ELSE 'rag_missing' END AS feedback_type,
  CASE WHEN l.quality = 1 THEN TRUE WHEN l.quality = 0 THEN FALSE END AS correctness,
  CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE (d.n_chars % 100) / 100.0e0 END AS confidence_score,
  CASE d.doc_id % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'reviewed' WHEN 2 THEN 'fixed' ELSE 'open' END AS status,
  CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE CAST(d.doc_id % 5 + 1 AS INT) END AS rating,
  CASE d.doc_id % 3 WHEN 0 THEN 'up' WHEN 1 THEN 'down' END AS thumbs,
  d.text AS prompt, concat('about ', d.lang) AS comments,
  {day0} + {hours:d.doc_id % 720} AS created_at
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

# Lag readings, attachments and ingest jobs carried on the same events.
LAG_READINGS = """
SELECT seq, event_ts, concat('group-', CAST(seq % 3 AS STRING)) AS group_id, concat('topic-', CAST(seq % 2 AS STRING)) AS topic,
       CAST(seq % 4 AS INT) AS partition_id, CAST(output_tokens * 20 AS BIGINT) AS lag, CAST(seq * 10 AS BIGINT) AS fetched_total
FROM obs WHERE event_type LIKE 'REQUEST%'
"""

# Spend out of order lines: customer = application, ship date = event time.
ORDER_SPEND = """
SELECT concat('cust-', CAST(o.o_custkey % 40 AS STRING)) AS application_id,
       concat('brand-', CAST(l.l_partkey % 5 AS STRING)) AS model_name,
       concat('li-', CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING), '-', CAST(l.l_partkey AS STRING),
              '-', CAST(l.l_suppkey AS STRING), '-', CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) AS STRING)) AS event_id,
       l.l_shipdate AS event_ts, CAST(l.l_extendedprice AS DECIMAL(14,2)) AS cost_usd
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

# Question and answer pairs: a user turn is the context of the assistant turn after it.
QA_PAIRS = """
SELECT u.conv_id, u.turn, u.text AS context, a.text AS response
FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'
"""

ASCII_DOCUMENTS = "SELECT doc_id, lang, source, {ascii:text} AS text FROM documents"


def _values(columns: str, rows: list[tuple]) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    casts = ", ".join(f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in columns.split("; "))
    names = ", ".join(c.split()[0] for c in columns.split("; "))
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"SELECT {casts} FROM (VALUES {body}) AS t({names})"


_CRIT = ["low", "medium", "high", "critical"]
PRICE_ROWS = [(m, "2023-01-01", i, o) for m, i, o, _ in catalogs.MODEL_PRICES] + [
    ("gemini-1.5-pro", "2024-01-15", "0.0025", "0.01"),
    ("claude-haiku-4-5", "2024-01-15", "0.0008", "0.004"),
]

DIMENSIONS = {
    "app_registry": _values(
        "application_id STRING; app_name STRING; lob STRING; usecase_id STRING; owner_team STRING; criticality STRING; status STRING",
        [(f"app-{i}", f"App {i}", f"lob-{i % 3}", f"uc-{i}", f"team-{i % 4}", _CRIT[i % 4], "active") for i in range(10)],
    ),
    "agent_registry": _values(
        "agent_id STRING; agent_version INT; agent_name STRING; agent_type STRING; application_id STRING; max_steps INT; status STRING",
        [(f"agent-{i}", v, f"Agent {i} v{v}", "planner" if i % 2 else "executor", f"app-{i * 3}", 8 + v, "active" if v < 3 else "draft")
         for i in range(5) for v in (1, 2, 3)],
    ),
    "tool_registry": _values(
        "tool_id STRING; tool_version INT; tool_name STRING; tool_type STRING; sla_latency_ms INT; status STRING",
        [(f"tool-{i}", v, f"Tool {i}", ["REST", "DB", "ServiceNow", "RAG", "Webhook"][i], 300 + 100 * i if i < 4 else None, "active")
         for i in range(5) for v in (1, 2)],
    ),
    "prices": _values(
        "model_name STRING; effective_from DATE; input_usd_per_1k DECIMAL(12,8); output_usd_per_1k DECIMAL(12,8)", PRICE_ROWS
    ),
    "slos": _values(
        "slo_id STRING; application_id STRING; sli_type STRING; target_pct DECIMAL(6,3); latency_target_ms INT; window_days INT; enabled BOOLEAN; filter_type STRING; filter_service STRING",
        [(f"slo-{i}", f"app-{i}", "latency" if i % 2 else "availability", 100.0 if i == 8 else (80.0 if i % 4 == 1 else 99.0),
          1000 if i % 2 else None, 7, i != 10, None, None) for i in range(12)]
        + [("slo-q", "app-1", "quality", 95.0, None, 30, True, None, None), ("slo-done", "app-1", "latency", 90.0, 900, 7, True, "REQUEST_COMPLETED", None),
           ("slo-part", "app-2", "availability", 50.0, None, 7, True, "REQUEST_FAILED", "gssp-gs")],
    ),
    "budgets": _values(
        "application_id STRING; model_name STRING; period STRING; max_spend_usd DECIMAL(12,2); alert_at_pct INT",
        [(f"app-{i}", "*", "monthly", 0.05 + 0.02 * i, 80) for i in range(12)]
        + [(f"app-{i}", "claude-sonnet-4-5", "daily", 0.01, 50) for i in range(12)]
        + [(f"app-{i}", "llama-3-70b", "weekly", 0.03, 60) for i in range(0, 12, 2)],
    ),
    "spend_limits": _values(
        "application_id STRING; model_name STRING; period STRING; max_spend_usd DECIMAL(12,2); alert_at_pct INT",
        [(f"cust-{i}", "*", "monthly", 700000 + 9000 * i, 80) for i in range(40)]
        + [(f"cust-{i}", f"brand-{i % 5}", "weekly", 60000, 70) for i in range(40)],
    ),
    "prompt_registry": _values(
        "template_id STRING; version INT; template_text STRING; prompt_hash STRING; status STRING; ab_bucket STRING; traffic_pct INT",
        [("tpl-0", 1, "Answer: <q>", "x", "archived", None, 100), ("tpl-0", 2, "Answer well: <q>", "x", "active", None, 100),
         ("tpl-1", 1, "Plan <q>", "x", "active", "A", 50), ("tpl-1", 2, "Plan well <q>", "x", "active", "B", 150),
         ("tpl-2", 1, "Sum <q>", "x", "active", None, 100), ("tpl-2", 2, "Sum up <q>", "x", "active", None, 100)],
    ),
    "access_policy": _values(
        "policy_id STRING; subject_id STRING; application_id STRING; lob STRING; permission STRING; active_flag BOOLEAN; agent_id STRING",
        [("p1", "ann", None, "lob-1", "read_metrics", True, None), ("p2", "ann", "app-2", None, "read_metrics", True, None),
         ("p3", "ann", "app-3", None, "read_metrics", False, None), ("p4", "bob", "app-4", None, "read_payloads", True, None),
         ("p5", "root", None, None, "admin", True, None), ("p6", "cy", None, None, "read_metrics", True, "agent-2"),
         ("p7", "cy", None, None, "read_payloads", True, "agent-3"), ("p8", "dee", "app-5", None, "read_logs", True, None),
         ("p9", "dee", "app-6", None, "read_metrics", True, None)],
    ),
    "kpi_thresholds": _values(
        "metric_id STRING; warning DOUBLE; breached DOUBLE; higher_is_worse BOOLEAN",
        [("error_rate_pct", 20, 27, True), ("request_count", 15, 5, False), ("llm_cost_usd", 0.02, 0.04, True)],
    ),
}

VIEWS = {
    "obs": (OBS, []),
    "spans": (SPANS, ["obs"]),
    "span_events": (SPAN_EVENTS, ["spans"]),
    "raw_events": (RAW_EVENTS, ["obs"]),
    "feedback": (FEEDBACK, []),
    "lag_readings": (LAG_READINGS, ["obs"]),
    "order_spend": (ORDER_SPEND, []),
    "qa_pairs": (QA_PAIRS, []),
    "ascii_documents": (ASCII_DOCUMENTS, []),
    **{name: (sql, []) for name, sql in DIMENSIONS.items()},
}


def render(sql: str, dialect: str) -> str:
    """Fill the dialect placeholders `{name}` and `{name:arg|arg}`; `{{` stands for a brace."""
    words = _DIALECT[dialect]

    def fill(match: re.Match) -> str:
        return words[match[1]].format(*(match[2] or "").split("|"))

    names = "|".join(words)
    return re.sub(r"(?<!\{)\{(" + names + r")(?::([^{}]*))?\}", fill, sql)


_BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


class Tables:
    """Lazy access to the given tables and to the derived views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, partitions: int | None = None):
        """`partitions` deals the tables out anew, for a caller who knows that their files cannot be split."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.partitions = partitions
        self._views: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return table.repartition(self.partitions) if self.partitions else table

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            sql, needs = VIEWS[name]
            sources = {n: self.view(n) for n in needs}
            for table in _BASE_TABLES:
                if re.search(rf"\b(FROM|JOIN) {table}\b", sql) and table not in sources:
                    sources[table] = self.base(table)
            text = render(sql, "spark")
            for source in sources:  # `FROM obs` -> `FROM {obs}`, bound to a DataFrame, no session view
                text = re.sub(rf"\b(FROM|JOIN) {source}\b", rf"\1 {{{source}}}", text)
            self._views[name] = self.spark.sql(text, **sources)
        return self._views[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.view(name)
        if name in _BASE_TABLES:
            return self.base(name)
        raise AttributeError(name)


def duckdb_view(name: str) -> str:
    return render(VIEWS[name][0], "duckdb").replace("{{", "{").replace("}}", "}")
