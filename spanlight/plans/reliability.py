"""Queries over budgets, objectives, alerts, lag and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import catalogs
from ..operators import alerts, anomaly, budget, slo
from .registry import Context, query


def _matched(limits: str, spend: str) -> str:
    return f"""m AS (SELECT s.application_id, b.model_name AS limit_model, b.period,
    CAST(CASE b.period WHEN 'daily' THEN CAST(s.event_ts AS DATE) WHEN 'weekly' THEN date_trunc('week', s.event_ts) ELSE date_trunc('month', s.event_ts) END AS DATE) AS period_start,
    s.event_id, s.event_ts, CAST(s.cost_usd AS DECIMAL(28,8)) AS cost_usd, b.max_spend_usd, b.alert_at_pct
  FROM {spend} s JOIN {limits} b ON b.application_id = s.application_id AND (b.model_name = s.model_name OR b.model_name = '*') WHERE s.cost_usd > 0),
r AS (SELECT *, sum(cost_usd) OVER (PARTITION BY application_id, limit_model, period, period_start ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING) AS running FROM m)"""


def _crossings(limits: str, spend: str) -> str:
    return f"""WITH {_matched(limits, spend)},
k AS (SELECT *, 'alert' AS kind, CAST(max_spend_usd * alert_at_pct AS DECIMAL(28,8)) * CAST(0.01 AS DECIMAL(3,2)) AS line FROM r
      UNION ALL SELECT *, 'cap', CAST(max_spend_usd AS DECIMAL(28,8)) FROM r)
SELECT application_id, limit_model, period, period_start, kind, event_id, event_ts, dbl(running) AS new_spend_usd, dbl(max_spend_usd) AS limit_usd
FROM k WHERE running >= line AND running - cost_usd < line"""


@query("budget_crossings", "W2 J5 R7", _crossings("budgets", "spend"))
def _(c: Context):
    return budget.crossings(c.spend, c.budgets)


@query("order_budget_crossings", "W2 J5", _crossings("spend_limits", "order_spend"))
def _(c: Context):
    return budget.crossings(c.order_spend, c.spend_limits)


@query("budget_totals", "A26 J13 K4", f"""WITH {_matched('budgets', 'spend')},
t AS (SELECT application_id, limit_model, period, period_start, max_spend_usd, alert_at_pct, sum(cost_usd) AS spend_usd FROM m GROUP BY ALL)
SELECT application_id, limit_model, period, period_start, dbl(max_spend_usd) AS max_spend_usd, n(alert_at_pct) AS alert_at_pct, dbl(spend_usd) AS spend_usd,
  spend_usd * 100 >= max_spend_usd * alert_at_pct AS alert_emitted, spend_usd >= max_spend_usd AS cap_emitted,
  r6(100.0 * CAST(spend_usd AS DOUBLE) / CAST(max_spend_usd AS DOUBLE)) AS utilisation_pct, dbl(max_spend_usd - spend_usd) AS headroom_usd,
  CASE WHEN spend_usd >= max_spend_usd THEN 'breached' WHEN spend_usd * 100 >= max_spend_usd * alert_at_pct THEN 'warning' ELSE 'ok' END AS state FROM t""")
def _(c: Context):
    return budget.adherence(budget.totals(c.spend, c.budgets))


@query("budget_utilisation", "K4", f"""WITH {_matched('budgets', 'spend')}
SELECT application_id, limit_model, period, event_id, dbl(running) AS running_usd, r6(100.0 * CAST(running AS DOUBLE) / CAST(max_spend_usd AS DOUBLE)) AS utilisation_pct FROM r""")
def _(c: Context):
    return budget.utilisation(c.spend, c.budgets).select(
        "application_id", "limit_model", "period", "event_id", "running_usd", "utilisation_pct")


@query("daily_spend_trend", "W5 W6", """
WITH d AS (SELECT application_id, CAST(event_ts AS DATE) AS day, sum(cost_usd) AS spend_usd FROM spend GROUP BY ALL),
w AS (SELECT *, CAST(sum(spend_usd) OVER t AS DOUBLE) / nullif(count(*) OVER t, 0) AS mean, CAST(lag(spend_usd) OVER (PARTITION BY application_id ORDER BY day) AS DOUBLE) AS previous
      FROM d WINDOW t AS (PARTITION BY application_id ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT application_id, day, dbl(spend_usd) AS spend_usd, r6(mean) AS trailing_mean_usd, r6(previous) AS previous_usd,
  coalesce(CAST(spend_usd AS DOUBLE) >= 2.0 * mean, FALSE) AS above_trend, coalesce(CAST(spend_usd AS DOUBLE) >= 2.0 * previous, FALSE) AS doubled FROM w""")
def _(c: Context):
    return budget.daily_spend_trend(c.spend, ["application_id"])


_BURN = """e AS (SELECT s.slo_id, o.application_id, o.event_id, o.event_ts, o.seq, s.target_pct, s.window_days, CAST(floor(epoch(o.event_ts) / 60) AS BIGINT) AS minute,
    CASE WHEN s.sli_type = 'availability' THEN o.status = 'success' ELSE coalesce(o.latency_ms <= s.latency_target_ms, FALSE) END AS good
  FROM obs o JOIN slos s ON s.application_id = o.application_id WHERE s.enabled AND s.sli_type IN ('availability', 'latency')
    AND o.event_type IN ('REQUEST_COMPLETED', 'REQUEST_FAILED')
    AND coalesce(s.filter_type, o.event_type) = o.event_type AND coalesce(s.filter_service, o.service_name) = o.service_name),
w AS (SELECT x.slo_id, x.event_id, count(*) FILTER (y.minute > x.minute - 60) AS t1, count(*) FILTER (y.minute > x.minute - 60 AND y.good) AS g1, count(*) AS t6, count(*) FILTER (y.good) AS g6
  FROM e x JOIN e y ON y.slo_id = x.slo_id AND y.minute > x.minute - 360 AND (y.minute < x.minute OR (y.minute = x.minute AND (y.event_ts, y.event_id) <= (x.event_ts, x.event_id)))
  GROUP BY x.slo_id, x.event_id),
b AS (SELECT e.*, (1.0 - w.g1::DOUBLE / w.t1) / nullif(1.0 - CAST(target_pct AS DOUBLE) / 100.0, 0) AS b1, (1.0 - w.g6::DOUBLE / w.t6) / nullif(1.0 - CAST(target_pct AS DOUBLE) / 100.0, 0) AS b6
  FROM e JOIN w ON w.slo_id = e.slo_id AND w.event_id = e.event_id)"""


@query("slo_burn_rates", "W1 J6", f"""WITH {_BURN}
SELECT slo_id, application_id, event_id, n(good) AS good, r6(b1) AS burn_rate_1h, r6(b6) AS burn_rate_6h FROM b""")
def _(c: Context):
    return slo.burn_rates(c.obs, c.slos).select("slo_id", "application_id", "event_id", "good", "burn_rate_1h", "burn_rate_6h")


_DAILY = """SELECT slo_id, application_id, target_pct, window_days, CAST(event_ts AS DATE) AS day, count(*) FILTER (good) AS good_events, count(*) AS total_events,
  max(b1) AS burn_rate_1h, max(b6) AS burn_rate_6h FROM b GROUP BY ALL"""


@query("daily_slo_compliance", "A24", f"""WITH {_BURN}, d AS ({_DAILY})
SELECT slo_id, application_id, dbl(target_pct) AS target_pct, n(window_days) AS window_days, day, n(good_events) AS good_events, n(total_events) AS total_events,
  r6(100.0 * good_events / total_events) AS sli_pct, r6(burn_rate_1h) AS burn_rate_1h, r6(burn_rate_6h) AS burn_rate_6h, coalesce(burn_rate_1h > 14.4, FALSE) AS breached FROM d""")
def _(c: Context):
    return slo.daily_compliance(slo.burn_rates(c.obs, c.slos))


@query("error_budget", "A25 Q25", f"""WITH {_BURN}, d AS ({_DAILY}),
s AS (SELECT x.slo_id, x.day, sum(y.good_events) AS wg, sum(y.total_events) AS wt FROM d x JOIN d y ON y.slo_id = x.slo_id AND y.day <= x.day AND y.day > x.day - x.window_days GROUP BY ALL),
u AS (SELECT d.*, 100.0 * (s.wt - s.wg) / nullif((1.0 - CAST(target_pct AS DOUBLE) / 100.0) * s.wt, 0) AS used FROM d JOIN s ON s.slo_id = d.slo_id AND s.day = d.day)
SELECT slo_id, day, r6(used) AS error_budget_consumed_pct, r6(CASE WHEN used IS NOT NULL THEN greatest(100.0 - used, 0.0) END) AS error_budget_remaining_pct,
  CASE WHEN used >= 100.0 THEN day WHEN used IS NOT NULL AND burn_rate_6h > 0 THEN day + CAST(ceil(greatest(100.0 - used, 0.0) / 100.0 * window_days / burn_rate_6h) AS INT) END AS exhausted_on FROM u""")
def _(c: Context):
    return slo.error_budget(slo.daily_compliance(slo.burn_rates(c.obs, c.slos))).select(
        "slo_id", "day", "error_budget_consumed_pct", "error_budget_remaining_pct", "exhausted_on")


@query("burn_alerts", "W14", f"""WITH {_BURN}
SELECT slo_id, event_id, CASE WHEN b1 > 14.4 AND b6 > 6 THEN 'page' ELSE 'ticket' END AS level FROM b WHERE (b1 > 14.4 AND b6 > 6) OR (b1 > 3 AND b6 > 1)""")
def _(c: Context):
    return slo.burn_alerts(slo.burn_rates(c.obs, c.slos)).select("slo_id", "event_id", "level")


@query("slo_history", "K11", f"""WITH {_BURN}, d AS ({_DAILY})
SELECT d.slo_id, CAST(d.day AS TIMESTAMP) AS event_ts, d.application_id, r.lob, r6(round(100.0 * good_events / total_events, 3)) AS sli_pct,
  r6(round(burn_rate_1h, 4)) AS burn_rate_1h, r6(round(burn_rate_6h, 4)) AS burn_rate_6h, coalesce(burn_rate_1h > 14.4, FALSE) AS breached
FROM d LEFT JOIN app_registry r ON r.application_id = d.application_id""")
def _(c: Context):
    return slo.history_snapshot(slo.daily_compliance(slo.burn_rates(c.obs, c.slos)), c.app_registry)


@query("sliding_slo_counts", "R6", """
WITH e AS (SELECT s.slo_id, CASE WHEN s.sli_type = 'availability' THEN o.status = 'success' ELSE coalesce(o.latency_ms <= s.latency_target_ms, FALSE) END AS good, date_trunc('minute', o.event_ts) AS m
  FROM obs o JOIN slos s ON s.application_id = o.application_id WHERE s.enabled AND s.sli_type IN ('availability', 'latency') AND o.event_type IN ('REQUEST_COMPLETED', 'REQUEST_FAILED')
  AND coalesce(s.filter_type, o.event_type) = o.event_type AND coalesce(s.filter_service, o.service_name) = o.service_name)
SELECT slo_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, n(count(*) FILTER (good)) AS good, n(count(*)) AS total
FROM (SELECT slo_id, good, m - to_minutes(unnest(range(0, 60))) AS window_start FROM e) GROUP BY slo_id, window_start""")
def _(c: Context):
    return slo.sliding_counts(slo.minute_counts(c.obs, c.slos), 60)


_RATES = """p AS (SELECT service_name, CAST(floor(epoch(event_ts) / 60) AS BIGINT) AS m, count(*) FILTER (http_status >= 500) AS failed, count(*) AS total FROM obs GROUP BY ALL),
q AS (SELECT service_name, m + k AS minute, sum(failed) AS failed, sum(total) AS total FROM p, range(0, 5) t(k) GROUP BY ALL)"""


@query("service_error_rate", "A33", f"""WITH {_RATES}
SELECT service_name, n(minute) AS minute, n(failed) AS failed, n(total) AS total FROM q""")
def _(c: Context):
    return alerts.rate_windows(c.obs, ["service_name"], {"failed": F.col("http_status") >= 500, "total": F.col("http_status").isNotNull()})


@query("held_error_rate_alerts", "W11 R8", f"""WITH {_RATES},
t AS (SELECT *, minute - row_number() OVER (PARTITION BY service_name ORDER BY minute) AS island FROM q WHERE failed / greatest(total::DOUBLE, 0.3) > 0.05),
s AS (SELECT service_name, min(minute) AS a, max(minute) AS z FROM t GROUP BY service_name, island)
SELECT service_name, TIMESTAMP '1970-01-01' + to_minutes(a) AS pending_from, TIMESTAMP '1970-01-01' + to_minutes(a + 10) AS firing_from, TIMESTAMP '1970-01-01' + to_minutes(z) AS last_true
FROM s WHERE z - a >= 10""")
def _(c: Context):
    return alerts.error_rate_alert(c.obs)


@query("dead_letter_rate", "A31", """
WITH p AS (SELECT CAST(floor(epoch(o.event_ts) / 60) AS BIGINT) AS m, count(*) FILTER (NOT is_json) AS dead, count(*) AS raw FROM raw_checked r JOIN obs o ON o.seq = r.seq GROUP BY ALL),
q AS (SELECT m + k AS minute, sum(dead) AS dead, sum(raw) AS raw FROM p, range(0, 5) t(k) GROUP BY ALL)
SELECT n(minute) AS minute, n(dead) AS dead, n(raw) AS raw, r6(dead / greatest(raw::DOUBLE, 300.0)) AS dead_share FROM q""")
def _(c: Context):
    dead = F.try_parse_json("value").isNull()
    messages = c.raw_events.select("seq", dead.alias("dead")).join(c.obs.select("seq", "event_ts"), "seq")
    return alerts.dead_letter_rate(messages)


_EXTRA_RULES = [("app_3_errors", "request_error_rate_pct", ">", 20.0, 60, "app-3", None, "critical", True),
                ("lob_1_loops", "agent_loops_at_max", ">=", 1.0, 60, None, "lob-1", "info", True),
                ("off", "request_error_rate_pct", ">", 0.0, 15, None, None, "info", False)]


def _rule_sql() -> str:
    rows = [(*r, None, None, "warning", True) if len(r) == 5 else r for r in [*catalogs.ALERT_RULES, *_EXTRA_RULES]]
    text = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows) + ") r(alert_id, metric_id, cmp, threshold, window_minutes, app, rlob, severity, enabled)"


def _window_sql(minutes: int) -> str:
    at = f"SELECT *, time_bucket(INTERVAL {minutes} MINUTE, event_ts) AS window_start FROM coded_obs"
    names = {
        "request_error_rate_pct": "100.0 * count(*) FILTER (event_type = 'REQUEST_FAILED') / nullif(count(*) FILTER (event_type IN ('REQUEST_COMPLETED', 'REQUEST_FAILED')), 0)",
        "tool_failure_rate_pct": "100.0 * count(*) FILTER (event_type = 'TOOL_CALL_FAILED') / nullif(count(*) FILTER (event_type LIKE 'TOOL%'), 0)",
        "rag_no_result_rate_pct": "100.0 * count(*) FILTER (event_type = 'RAG_NO_RESULT') / nullif(count(*) FILTER (event_type LIKE 'RAG%'), 0)",
        "negative_feedback_pct": "100.0 * count(*) FILTER (event_type = 'FEEDBACK_SUBMITTED' AND rating <= 2) / nullif(count(*) FILTER (event_type = 'FEEDBACK_SUBMITTED'), 0)",
        "agent_loops_at_max": "CAST(count(*) FILTER (event_type LIKE 'AGENT%' AND loop_count >= 3) AS DOUBLE)",
        "prompt_template_errors": "CAST(count(*) FILTER (event_type LIKE 'LLM%' AND error_code = 'GR005') AS DOUBLE)",
        "llm_p95_latency_ms": "quantile_cont(latency_ms, 0.95) FILTER (event_type LIKE 'LLM%')",
    }
    return " UNION ALL ".join(
        f"SELECT '{n}' AS metric_id, {minutes} AS window_minutes, window_start, application_id, max(lob) AS lob, application_id AS scope, {e} AS value FROM ({at}) GROUP BY application_id, window_start"
        for n, e in names.items())


_NO_LOB = "CAST(NULL AS VARCHAR) AS application_id, CAST(NULL AS VARCHAR) AS lob"


@query("alert_evaluation", "K1 K2", f"""
WITH coded_obs AS (SELECT * REPLACE (CASE WHEN event_type LIKE 'LLM%' AND seq % 33 = 0 THEN 'GR005' ELSE error_code END AS error_code) FROM obs),
daily AS (SELECT application_id, CAST(event_ts AS DATE) AS day, CAST(sum(cost_usd) AS DOUBLE) AS s FROM spend GROUP BY ALL),
costs AS (SELECT application_id, day, s, lag(s) OVER (PARTITION BY application_id ORDER BY day) AS p FROM daily),
blocked AS (SELECT application_id, event_date AS day, count(*) FILTER (event_type = 'GUARDRAIL_BLOCKED') AS n FROM obs GROUP BY ALL),
blocks AS (SELECT *, lag(n) OVER (PARTITION BY application_id ORDER BY day) AS p FROM blocked),
lags AS (SELECT group_id, topic, partition_id, time_bucket(INTERVAL 10 MINUTE, event_ts) AS window_start, arg_max(lag, (event_ts, seq)) AS lag FROM lag_readings GROUP BY ALL),
vals AS ({_window_sql(15)} UNION ALL {_window_sql(60)}
  UNION ALL SELECT 'cost_vs_previous_day', 1440, CAST(day AS TIMESTAMP), application_id, NULL, application_id, s / p FROM costs WHERE p > 0
  UNION ALL SELECT 'guardrail_blocks_vs_previous_day', 1440, CAST(day AS TIMESTAMP), application_id, NULL, application_id, CAST(n AS DOUBLE) / p FROM blocks WHERE p > 0
  UNION ALL SELECT 'kafka_consumer_lag', 10, window_start, {_NO_LOB}, group_id || '/' || topic, CAST(sum(lag) AS DOUBLE) FROM lags GROUP BY group_id, topic, window_start
  UNION ALL SELECT 'archive_failures', 60, time_bucket(INTERVAL 60 MINUTE, event_ts) AS w, application_id, NULL, application_id, CAST(count(*) AS DOUBLE) FROM obs WHERE seq % 97 = 0 GROUP BY w, application_id
  UNION ALL SELECT 'missing_rollup_hours', 120, time_bucket(INTERVAL 120 MINUTE, h) AS w, {_NO_LOB}, '*', CAST(count(*) AS DOUBLE)
    FROM (SELECT DISTINCT date_trunc('hour', event_ts) AS h FROM obs WHERE hour(event_ts) % 7 = 0) GROUP BY w
  UNION ALL SELECT 'sink_missing_rows', 60, time_bucket(INTERVAL 60 MINUTE, event_ts) AS w, {_NO_LOB}, '*', CAST(count(*) AS DOUBLE) FROM obs WHERE seq % 41 = 0 GROUP BY w)
SELECT r.alert_id, v.scope, v.window_start, n(v.window_minutes) AS window_minutes, r.severity, r6(v.value) AS value
FROM vals v JOIN {_rule_sql()} ON r.metric_id = v.metric_id AND r.window_minutes = v.window_minutes AND r.enabled
WHERE (r.app IS NULL OR r.app = v.application_id) AND (r.rlob IS NULL OR r.rlob = v.lob)
  AND CASE r.cmp WHEN '>' THEN v.value > r.threshold ELSE v.value >= r.threshold END""")
def _(c: Context):
    broken = (F.col("event_type").startswith("LLM_")) & (F.col("seq") % 33 == 0)
    events = c.obs.withColumn("error_code", F.when(broken, "GR005").otherwise(F.col("error_code")))
    blocks = alerts.day_over_day(c.obs, ["application_id"], F.col("event_type") == "GUARDRAIL_BLOCKED", 3.0)
    failed = c.obs.where("seq % 97 = 0").select("event_ts", "application_id", F.lit("stage7-s3").alias("stage"))
    rolled = c.obs.where(F.hour("event_ts") % 7 != 0).select(F.date_trunc("hour", "event_ts").cast("timestamp_ntz").alias("hour"))
    values = alerts.named_metrics(events, 15)
    for more in (
            alerts.named_metrics(events, 60),
            alerts.spike_metrics(budget.daily_spend_trend(c.spend, ["application_id"]), "cost_vs_previous_day", "spend_usd", "previous_usd"),
            alerts.spike_metrics(blocks, "guardrail_blocks_vs_previous_day", "n", "previous"),
            alerts.lag_metric(c.lag_readings, 10), alerts.stage_error_metric(failed, 60),
            alerts.missing_hours(c.obs, rolled, 120), alerts.sink_gaps(c.obs, c.obs.where("seq % 41 <> 0"), 60)):
        values = values.unionByName(more)
    rules = catalogs.alert_rule_table(c.spark, [*catalogs.ALERT_RULES, *_EXTRA_RULES])
    return alerts.evaluate_rules(values, rules).select("alert_id", "scope", "window_start", "window_minutes", "severity", "value")


@query("guardrail_block_spikes", "W6", """
WITH d AS (SELECT application_id, event_date AS day, count(*) FILTER (event_type = 'GUARDRAIL_BLOCKED') AS n FROM obs GROUP BY ALL),
w AS (SELECT *, lag(n) OVER (PARTITION BY application_id ORDER BY day) AS previous FROM d)
SELECT application_id, day, n(n) AS n, n(previous) AS previous, coalesce(previous > 0 AND n >= 3 * previous, FALSE) AS spike FROM w""")
def _(c: Context):
    return alerts.day_over_day(c.obs, ["application_id"], F.col("event_type") == "GUARDRAIL_BLOCKED", 3.0)


@query("consumer_lag", "A16 Q13", """
SELECT group_id, topic, n(partition_id) AS partition_id, n(arg_max(lag, (event_ts, seq))) AS lag, max(event_ts) AS read_at FROM lag_readings GROUP BY ALL""")
def _(c: Context):
    return alerts.latest_lag(c.lag_readings)


@query("lag_drain", "A34 Q13", """
WITH p AS (SELECT group_id, topic, partition_id, arg_max(lag, (event_ts, seq)) AS lag, arg_max(fetched_total, (event_ts, seq)) - arg_min(fetched_total, (event_ts, seq)) AS fetched,
  epoch_us(max(event_ts)) - epoch_us(min(event_ts)) AS micros FROM lag_readings GROUP BY ALL),
s AS (SELECT group_id, topic, sum(lag) AS lag, count(*) FILTER (lag > 0) AS partitions_behind, sum(fetched) / nullif(max(micros / 1e6), 0) AS rate FROM p GROUP BY ALL)
SELECT group_id, topic, n(lag) AS lag, n(partitions_behind) AS partitions_behind, r6(rate) AS rate_per_s, r6(lag / nullif(rate, 0)) AS drain_s FROM s""")
def _(c: Context):
    return alerts.lag_summary(c.lag_readings)


_BOUNDS = catalogs.LATENCY_BUCKETS_S
_HIST = "SELECT event_type, le, n FROM (" + " UNION ALL ".join(
    [f"SELECT event_type, CAST({b} AS DOUBLE) AS le, count(*) FILTER (latency_ms / 1000.0 <= {b}) AS n FROM obs GROUP BY event_type" for b in _BOUNDS]
    + ["SELECT event_type, NULL, count(*) FROM obs GROUP BY event_type"]) + ")"


@query("latency_histogram", "A32", f"SELECT event_type, le, n(n) AS n FROM ({_HIST}) h")
def _(c: Context):
    return alerts.histogram(c.obs, ["event_type"], F.col("latency_ms") / 1000.0)


@query("histogram_p95", "A32", f"""
WITH h AS ({_HIST}), w AS (SELECT *, coalesce(lag(n) OVER s, 0) AS below, coalesce(lag(le) OVER s, 0.0) AS low, max(n) OVER (PARTITION BY event_type) AS total
  FROM h WINDOW s AS (PARTITION BY event_type ORDER BY le ASC NULLS LAST))
SELECT event_type, r6(CASE WHEN le IS NULL THEN low ELSE low + (le - low) * (0.95e0 * total - below) / nullif(n - below, 0) END) AS quantile
FROM w WHERE n >= 0.95e0 * total AND below < 0.95e0 * total""")
def _(c: Context):
    hist = alerts.histogram(c.obs, ["event_type"], F.col("latency_ms") / 1000.0)
    return alerts.histogram_quantile(hist, ["event_type"], 0.95)


@query("processed_by_type", "A32", "SELECT event_type, n(count(*)) AS processed FROM obs GROUP BY ALL")
def _(c: Context):
    return c.obs.groupBy("event_type").agg(F.count(F.lit(1)).alias("processed"))


@query("latency_baselines", "W3", """
WITH v AS (SELECT application_id, event_date AS d, latency_ms AS v FROM obs WHERE event_type LIKE 'REQUEST%'),
x AS (SELECT v.application_id, v.d + CAST(k AS INT) AS day, list_sort(list(v.v)) AS vs FROM v, range(1, 8) t(k) GROUP BY ALL)
SELECT application_id, CAST(day AS DATE) AS day, r6(vs[CAST(floor(len(vs) * 0.5) AS INT) + 1]) AS p50, r6(vs[CAST(floor(len(vs) * 0.95) AS INT) + 1]) AS p95,
  r6(vs[CAST(floor(len(vs) * 0.99) AS INT) + 1]) AS p99 FROM x""")
def _(c: Context):
    return anomaly.baselines(c.obs.where("event_type LIKE 'REQUEST%'"), ["application_id"], "latency_ms")


_SCORES = """v AS (SELECT application_id, event_date AS d, latency_ms AS v, event_id, correlation_id FROM obs WHERE event_type LIKE 'REQUEST%'),
x AS (SELECT v.application_id, CAST(v.d + CAST(k AS INT) AS DATE) AS day, list_sort(list(v.v)) AS vs FROM v, range(1, 8) t(k) GROUP BY ALL),
b AS (SELECT application_id, day, vs[CAST(floor(len(vs) * 0.95) AS INT) + 1] AS p95, vs[CAST(floor(len(vs) * 0.99) AS INT) + 1] AS p99 FROM x),
s AS (SELECT v.*, coalesce(greatest(0.0, least(1.0, ((v.v / greatest(b.p95, 1.0) - 1.0) + (v.v / greatest(b.p99, 1.0) - 1.0)) / 2.0)), 0.0) AS raw_score, b.p95 IS NULL AS none
  FROM v LEFT JOIN b ON b.application_id = v.application_id AND b.day = v.d)"""


@query("anomaly_scores", "W4 Q12", f"""WITH {_SCORES}
SELECT event_id, r6(CASE WHEN none THEN 0.0 ELSE raw_score END) AS anomaly_score FROM s""")
def _(c: Context):
    return anomaly.scored(c.obs.where("event_type LIKE 'REQUEST%'"), ["application_id"], "latency_ms").select("event_id", "anomaly_score")


@query("correlated_anomalies", "J15", f"""WITH {_SCORES},
c AS (SELECT correlation_id, count(*) FILTER (event_type = 'TOOL_CALL_FAILED') AS tool_failures, max(latency_ms) FILTER (event_type LIKE 'LLM%') AS slowest, count(*) FILTER (status = 'failed') AS failures FROM obs GROUP BY ALL)
SELECT s.event_id, n(c.tool_failures) AS tool_failures, r6(c.slowest) AS slowest_llm_ms, n(c.failures) AS failures
FROM s JOIN c ON c.correlation_id = s.correlation_id WHERE NOT none AND raw_score > 0""")
def _(c: Context):
    scores = anomaly.scored(c.obs.where("event_type LIKE 'REQUEST%'"), ["application_id"], "latency_ms").where("anomaly_score > 0")
    return anomaly.correlated(scores.select("event_id", "correlation_id"), c.obs).drop("correlation_id")


@query("stuck_agents", "W17", """
SELECT o.agent_id, date_trunc('hour', event_ts) AS hour, n(count(*)) AS runs_at_limit FROM obs o
JOIN (SELECT agent_id, max_steps FROM agent_registry WHERE agent_version = 2) a ON a.agent_id = o.agent_id
WHERE event_type LIKE 'AGENT%' AND step_count >= max_steps GROUP BY ALL HAVING count(*) >= 2""")
def _(c: Context):
    from ..operators.lookups import latest_active

    return anomaly.stuck_agents(c.obs, latest_active(c.agent_registry, "agent_id", "agent_version"), 2)


