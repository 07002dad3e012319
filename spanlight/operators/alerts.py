"""Threshold rules, rates over short windows, hold times, histograms, lag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalogs import LATENCY_BUCKETS_S
from ..functions.times import epoch_second
from ..session import small_side
from .order_stats import ratio, with_percentiles


def compare(value: Column, comparator: Column, threshold: Column) -> Column:
    return (
        F.when(comparator == ">", value > threshold).when(comparator == ">=", value >= threshold)
        .when(comparator == "<", value < threshold).when(comparator == "<=", value <= threshold)
        .when(comparator == "==", value == threshold)
    )


def evaluate_rules(values: DataFrame, rules: DataFrame) -> DataFrame:
    """Metric values per window against the enabled alert rules of that window: rows that fire.

    `values` is (metric_id, window_minutes, window_start, application_id, lob, scope, value); a rule without
    an application or line of business in its scope holds for all.
    """
    active = rules.where("enabled").select(
        "alert_id", "metric_id", "window_minutes", "comparator", "threshold", "severity",
        F.col("scope_application_id").alias("_app"), F.col("scope_lob").alias("_lob"))
    joined = values.join(small_side(active), ["metric_id", "window_minutes"])
    in_scope = (F.col("_app").isNull() | F.coalesce(F.col("_app") == F.col("application_id"), F.lit(False))) & (
        F.col("_lob").isNull() | F.coalesce(F.col("_lob") == F.col("lob"), F.lit(False)))
    return joined.where(in_scope & compare(F.col("value"), F.col("comparator"), F.col("threshold"))).drop("_app", "_lob")


def rate_windows(events: DataFrame, keys: Sequence[str], counters: dict[str, Column], minutes: int = 5) -> DataFrame:
    """Counts over the last `minutes` minutes at every minute that has any event in that window.

    Counted per minute first; each minute then adds to the fixed number of windows covering it.
    """
    stamped = events.withColumn("minute", F.floor(epoch_second("event_ts") / 60).cast("long"))
    per_minute = stamped.groupBy(*keys, "minute").agg(*[F.count_if(c).alias(n) for n, c in counters.items()])
    spread = per_minute.withColumn("minute", F.explode(F.sequence(F.col("minute"), F.col("minute") + minutes - 1)))
    return spread.groupBy(*keys, "minute").agg(*[F.sum(n).alias(n) for n in counters])


def holding(states: DataFrame, keys: Sequence[str], condition: Column, minutes: int) -> DataFrame:
    """Stretches in which the condition held without a gap for at least `minutes` minutes.

    `states` has one row per key and minute, so a window per key spans minutes, not events.
    """
    true = states.where(condition)
    part = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    island = true.withColumn("_island", F.col("minute") - F.row_number().over(part.orderBy("minute")))
    spans = island.groupBy(*keys, "_island").agg(F.min("minute").alias("from_minute"), F.max("minute").alias("to_minute"))
    held = F.col("to_minute") - F.col("from_minute")
    return spans.where(held >= minutes).select(
        *keys, F.timestamp_seconds(F.col("from_minute") * 60).cast("timestamp_ntz").alias("pending_from"),
        F.timestamp_seconds((F.col("from_minute") + minutes) * 60).cast("timestamp_ntz").alias("firing_from"),
        F.timestamp_seconds(F.col("to_minute") * 60).cast("timestamp_ntz").alias("last_true"))


def error_rate_alert(events: DataFrame, share: float = 0.05, rate_minutes: int = 5, hold_minutes: int = 10) -> DataFrame:
    """Services whose 5xx share stayed above the limit for the hold time."""
    rates = rate_windows(events, ["service_name"], {
        "failed": F.col("http_status") >= 500, "total": F.col("http_status").isNotNull()}, rate_minutes)
    # The floor on the total keeps an idle service from dividing by zero.
    floor = 0.001 * rate_minutes * 60
    return holding(rates, ["service_name"], F.col("failed") / F.greatest(F.col("total").cast("double"), F.lit(floor)) > share, hold_minutes)


def dead_letter_rate(messages: DataFrame, rate_minutes: int = 5) -> DataFrame:
    """Quarantined share of raw volume per minute; `dead` marks quarantined messages."""
    rates = rate_windows(messages, [], {"dead": F.col("dead"), "raw": F.lit(True)}, rate_minutes)
    return rates.withColumn("dead_share", F.col("dead") / F.greatest(F.col("raw").cast("double"), F.lit(1.0 * rate_minutes * 60)))


def latest_lag(readings: DataFrame) -> DataFrame:
    """Last lag reading per consumer group, topic and partition."""
    return readings.groupBy("group_id", "topic", "partition_id").agg(
        F.max_by("lag", F.struct("event_ts", "seq")).alias("lag"), F.max("event_ts").alias("read_at"))


def lag_summary(readings: DataFrame) -> DataFrame:
    """Lag, partitions behind, consumption rate and seconds to drain per group and topic."""
    keys = ["group_id", "topic", "partition_id"]
    ordered = F.struct("event_ts", "seq")
    per_partition = readings.groupBy(*keys).agg(
        F.max_by("lag", ordered).alias("lag"),
        (F.max_by("fetched_total", ordered) - F.min_by("fetched_total", ordered)).alias("fetched"),
        (F.unix_micros(F.max("event_ts").cast("timestamp")) - F.unix_micros(F.min("event_ts").cast("timestamp"))).alias("micros"),
    )
    return per_partition.groupBy("group_id", "topic").agg(
        F.sum("lag").alias("lag"), F.count_if(F.col("lag") > 0).alias("partitions_behind"),
        (F.sum("fetched") / F.nullif(F.max("micros") / F.lit(1e6), F.lit(0.0))).alias("rate_per_s"),
    ).withColumn("drain_s", F.col("lag") / F.nullif(F.col("rate_per_s"), F.lit(0.0)))


def histogram(rows: DataFrame, keys: Sequence[str], seconds: Column, buckets: Sequence[float] = LATENCY_BUCKETS_S) -> DataFrame:
    """Cumulative bucket counts (keys, le, n), `le` null for the last, unbounded bucket."""
    counts = rows.groupBy(*keys).agg(
        *[F.count_if(seconds <= b).alias(f"b{i}") for i, b in enumerate(buckets)], F.count(seconds).alias("total"))
    entries = F.explode(F.array(*[
        F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(buckets)
    ], F.struct(F.lit(None).cast("double").alias("le"), F.col("total").alias("n"))))
    return counts.select(*keys, entries.alias("e")).select(*keys, "e.le", "e.n")


def histogram_quantile(hist: DataFrame, keys: Sequence[str], q: float) -> DataFrame:
    """Quantile by linear interpolation inside the bucket that holds it; the last finite bound beyond."""
    part = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    w = part.orderBy(F.col("le").asc_nulls_last())
    rows = hist.withColumns({
        "_below": F.coalesce(F.lag("n").over(w), F.lit(0)), "_low": F.coalesce(F.lag("le").over(w), F.lit(0.0)),
        "_total": F.max("n").over(part),
    })
    target = F.lit(q) * F.col("_total")
    inside = F.col("_low") + (F.col("le") - F.col("_low")) * (target - F.col("_below")) / F.nullif(F.col("n") - F.col("_below"), F.lit(0))
    hit = (F.col("n") >= target) & (F.col("_below") < target)
    return rows.where(hit).select(*keys, F.when(F.col("le").isNull(), F.col("_low")).otherwise(inside).alias("quantile"))


def block_rate(events: DataFrame) -> DataFrame:
    """Guardrail blocks against evaluations."""
    blocked, total = F.count_if(F.col("event_type") == "GUARDRAIL_BLOCKED"), F.count_if(F.col("event_type") == "GUARDRAIL_EVALUATED")
    return events.where(F.col("event_type").startswith("GUARDRAIL_")).agg(
        blocked.alias("blocked"), total.alias("total"), ratio(blocked, total).alias("block_rate"))


def day_over_day(events: DataFrame, keys: Sequence[str], counted: Column, factor: float) -> DataFrame:
    """Daily counts against the previous day with data, flagged from `factor` times on."""
    daily = events.groupBy(*keys, F.col("event_ts").cast("date").alias("day")).agg(F.count_if(counted).alias("n"))
    part = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    previous = F.lag("n").over(part.orderBy("day"))
    return daily.withColumn("previous", previous).withColumn(
        "spike", F.coalesce((F.col("previous") > 0) & (F.col("n") >= F.lit(factor) * F.col("previous")), F.lit(False)))


VALUE_COLUMNS = ["metric_id", "window_minutes", "window_start", "application_id", "lob", "scope", "value"]


def _windowed(rows: DataFrame, minutes: int) -> DataFrame:
    start = F.window(F.col("event_ts").cast("timestamp"), f"{minutes} minutes").getField("start")
    return rows.withColumn("window_start", start.cast("timestamp_ntz"))


def named_metrics(events: DataFrame, minutes: int) -> DataFrame:
    """The event-derived metrics behind the named alerts per application and window of so many minutes, one pass."""
    def share(num: Column, den: Column) -> Column:
        return ratio(F.count_if(num), F.count_if(den), 100.0)

    t = F.col("event_type")
    metrics = {
        "request_error_rate_pct": share(t == "REQUEST_FAILED", t.isin("REQUEST_COMPLETED", "REQUEST_FAILED")),
        "tool_failure_rate_pct": share(t == "TOOL_CALL_FAILED", t.isin("TOOL_CALL_COMPLETED", "TOOL_CALL_FAILED", "TOOL_CALL_TIMEOUT")),
        "rag_no_result_rate_pct": share(t == "RAG_NO_RESULT", t.startswith("RAG_")),
        "negative_feedback_pct": share((t == "FEEDBACK_SUBMITTED") & (F.col("rating") <= 2), t == "FEEDBACK_SUBMITTED"),
        "agent_loops_at_max": F.count_if(t.startswith("AGENT_") & (F.col("loop_count") >= 3)).cast("double"),
        "prompt_template_errors": F.count_if(t.startswith("LLM_") & (F.col("error_code") == "GR005")).cast("double"),
    }
    rows, keys = _windowed(events, minutes), ["application_id", "window_start"]
    wide = rows.groupBy(*keys).agg(F.max("lob").alias("lob"), *[c.alias(n) for n, c in metrics.items()])
    wide = with_percentiles(wide, rows.where(t.startswith("LLM_")), keys, "latency_ms", {"llm_p95_latency_ms": 0.95})
    names = [*metrics, "llm_p95_latency_ms"]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("metric_id"), F.col(n).alias("value")) for n in names]))
    return wide.select("application_id", "window_start", "lob", pairs.alias("m")).select(
        "m.metric_id", F.lit(minutes).alias("window_minutes"), "window_start", "application_id", "lob",
        F.col("application_id").alias("scope"), "m.value")


def _values(rows: DataFrame, metric_id: str, minutes: int, value: Column, scope: Column, application: Column | None = None) -> DataFrame:
    return rows.select(F.lit(metric_id).alias("metric_id"), F.lit(minutes).alias("window_minutes"), "window_start",
                       (F.lit(None).cast("string") if application is None else application).alias("application_id"),
                       F.lit(None).cast("string").alias("lob"), scope.alias("scope"), value.cast("double").alias("value"))


def spike_metrics(daily: DataFrame, metric_id: str, measure: str, previous: str) -> DataFrame:
    """A day's measure over the previous day's."""
    rows = daily.where(F.col(previous) > 0).withColumn("window_start", F.col("day").cast("timestamp_ntz"))
    return _values(rows, metric_id, 1440, F.col(measure).cast("double") / F.col(previous), F.col("application_id"), F.col("application_id"))


def lag_metric(readings: DataFrame, minutes: int) -> DataFrame:
    """Lag per consumer group and topic in a window: the sum over partitions of the last reading of each."""
    last = _windowed(readings, minutes).groupBy("group_id", "topic", "partition_id", "window_start").agg(
        F.max_by("lag", F.struct("event_ts", "seq")).alias("lag"))
    summed = last.groupBy("group_id", "topic", "window_start").agg(F.sum("lag").alias("lag"))
    return _values(summed, "kafka_consumer_lag", minutes, F.col("lag"), F.concat_ws("/", "group_id", "topic"))


def stage_error_metric(stage_errors: DataFrame, minutes: int, metric_id: str = "archive_failures", stage: str = "stage7-s3") -> DataFrame:
    """Events of an application whose enrichment failed in a stage, from (event_ts, application_id, stage)."""
    counted = _windowed(stage_errors.where(F.col("stage") == stage), minutes).groupBy("application_id", "window_start").agg(
        F.count(F.lit(1)).alias("n"))
    return _values(counted, metric_id, minutes, F.col("n"), F.col("application_id"), F.col("application_id"))


def missing_hours(events: DataFrame, rollup: DataFrame, minutes: int = 120) -> DataFrame:
    """Hours that have events but no rollup row, counted per window."""
    hours = events.select(F.date_trunc("hour", "event_ts").cast("timestamp_ntz").alias("event_ts")).distinct()
    gaps = hours.join(rollup.select(F.col("hour").alias("event_ts")).distinct(), "event_ts", "left_anti")
    counted = _windowed(gaps, minutes).groupBy("window_start").agg(F.count(F.lit(1)).alias("n"))
    return _values(counted, "missing_rollup_hours", minutes, F.col("n"), F.lit("*"))


def sink_gaps(source: DataFrame, target: DataFrame, minutes: int = 60) -> DataFrame:
    """Events of a window that the sink does not hold, from (event_id, event_ts) of both sides."""
    both = source.select("event_id", "event_ts", F.lit(0).alias("stored")).unionByName(
        target.select("event_id", "event_ts", F.lit(1).alias("stored")))
    lost = both.groupBy("event_id").agg(F.max("stored").alias("stored"), F.min("event_ts").alias("event_ts")).where("stored = 0")
    counted = _windowed(lost, minutes).groupBy("window_start").agg(F.count(F.lit(1)).alias("n"))
    return _values(counted, "sink_missing_rows", minutes, F.col("n"), F.lit("*"))
