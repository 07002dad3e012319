"""Baselines over trailing days, anomaly scores, comparisons of periods, stuck agents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_side
from .order_stats import ratio, trailing_percentiles

BASELINE_DAYS = 7
_PROBS = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def baselines(values: DataFrame, keys: Sequence[str], value: str, days: int = BASELINE_DAYS) -> DataFrame:
    """Per key and day: p50, p95, p99 of the `days` days before it, element int(n*p) of the sorted values."""
    return trailing_percentiles(values, keys, F.col("event_ts").cast("date"), value, _PROBS, days, method="index")


def score(value: Column, p95: Column, p99: Column) -> Column:
    """0..1: nothing up to p95, rising linearly to 1 at twice p99; 0 without a baseline."""
    over = (value / F.greatest(p95, F.lit(1.0)) - 1.0) + (value / F.greatest(p99, F.lit(1.0)) - 1.0)
    known = p95.isNotNull() & p99.isNotNull()  # greatest() would skip a missing baseline
    return F.when(known, F.greatest(F.lit(0.0), F.least(F.lit(1.0), over / 2.0))).otherwise(0.0)


def scored(values: DataFrame, keys: Sequence[str], value: str, days: int = BASELINE_DAYS) -> DataFrame:
    """Every value with its day's baseline and anomaly score."""
    base = baselines(values, keys, value, days)
    joined = values.withColumn("day", F.col("event_ts").cast("date")).join(base, [*keys, "day"], "left")
    return joined.withColumn("anomaly_score", score(F.col(value), F.col("p95"), F.col("p99")))


def top_anomalies(scores: DataFrame, n: int = 20) -> DataFrame:
    return scores.where("anomaly_score > 0").orderBy(F.col("anomaly_score").desc(), "event_id").limit(n)


def correlated(anomalies: DataFrame, events: DataFrame) -> DataFrame:
    """What else happened on the anomaly's correlation id: failed tools, slowest model call, errors.

    Aggregated per correlation id and joined, never all pairs of events.
    """
    wanted = anomalies.select("correlation_id").distinct()
    context = events.join(wanted, "correlation_id", "left_semi").groupBy("correlation_id").agg(
        F.count_if(F.col("event_type") == "TOOL_CALL_FAILED").alias("tool_failures"),
        F.max(F.when(F.col("event_type").startswith("LLM_"), F.col("latency_ms"))).alias("slowest_llm_ms"),
        F.count_if(F.col("status") == "failed").alias("failures"))
    return anomalies.join(context, "correlation_id", "left")


def compare_periods(daily: DataFrame, keys: Sequence[str], measure: str, split: str, days: int = 7) -> DataFrame:
    """A measure in the `days` days from `split` on against the `days` days before: delta and percent."""
    start = F.lit(split).cast("date")
    now = (F.col("day") >= start) & (F.col("day") < F.date_add(start, days))
    before = (F.col("day") < start) & (F.col("day") >= F.date_sub(start, days))
    return daily.where(now | before).groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(now, F.col(measure))), F.lit(0)).alias("current"),
        F.coalesce(F.sum(F.when(before, F.col(measure))), F.lit(0)).alias("previous"),
    ).withColumns({
        "delta": F.col("current") - F.col("previous"),
        "delta_pct": ratio(F.col("current") - F.col("previous"), F.col("previous"), 100.0)})


def trend(daily: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Direction of a daily measure against the previous day with data."""
    previous = F.lag(measure).over(Window.partitionBy(*keys).orderBy("day"))
    return daily.withColumn("previous", previous).withColumn(
        "trend", F.when(F.col(measure) > F.col("previous"), "up").when(F.col(measure) < F.col("previous"), "down")
        .when(F.col("previous").isNotNull(), "flat"))


def stuck_agents(events: DataFrame, agents: DataFrame, times: int = 3) -> DataFrame:
    """Agents whose runs reach their step limit at least `times` times in an hour."""
    dim = small_side(agents.select("agent_id", "max_steps"))
    runs = events.where(F.col("event_type").startswith("AGENT_")).join(dim, "agent_id")
    return runs.where(F.col("step_count") >= F.col("max_steps")).groupBy(
        "agent_id", F.date_trunc("hour", "event_ts").cast("timestamp_ntz").alias("hour")).agg(
        F.count(F.lit(1)).alias("runs_at_limit")).where(F.col("runs_at_limit") >= times)
