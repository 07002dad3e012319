"""Failure clusters, cause hypotheses, nightly report, weekly digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order_stats import percentiles, ratio, top_per_group

MIN_SCORE = 0.1


def clusters(events: DataFrame, dimension: str, n: int = 20) -> DataFrame:
    """Most frequent values of one dimension among failed events."""
    return events.where((F.col("status") == "failed") & F.col(dimension).isNotNull()).groupBy(dimension).agg(
        F.count(F.lit(1)).alias("errors")).orderBy(F.col("errors").desc(), dimension).limit(n)


def latest_traces(events: DataFrame, n: int = 5) -> DataFrame:
    """The n most recent failed correlation ids per error code, one row each."""
    last = events.where("status = 'failed' AND error_code IS NOT NULL").groupBy("error_code", "correlation_id").agg(
        F.max("event_ts").alias("last_seen"))
    return top_per_group(last, ["error_code"], [F.col("last_seen").desc(), F.col("correlation_id")], n)


def day_facts(events: DataFrame) -> DataFrame:
    """Events counted by application, day, type, prompt version, error and, for failures, trace.

    Everything but a percentile follows from this table. Its users pick their rows by conditional sums, not by
    filters, which Spark would push below the grouping: so the plans agree and share one scan and one shuffle.
    """
    call, failed = F.col("event_type").startswith("LLM_"), F.col("status") == "failed"
    named = failed & F.col("error_code").isNotNull()
    return events.groupBy(
        "application_id", F.col("event_ts").cast("date").alias("day"), "event_type", failed.alias("failed"),
        F.when(call, F.col("prompt_template_id")).alias("prompt_template_id"), F.when(call, F.col("prompt_version")).alias("prompt_version"),
        F.when(named, F.col("error_code")).alias("error_code"), F.when(named, F.col("correlation_id")).alias("correlation_id"),
    ).agg(F.count(F.lit(1)).alias("n"))


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join that treats null as a value: plain equality would add filters to one side only, and the two uses
    of `day_facts` would no longer be one."""
    side = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(side, condition, how).drop(*[f"_r_{k}" for k in keys])


def _when_sum(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("n")).otherwise(0))


def incidents(facts: DataFrame) -> DataFrame:
    """Per application, error code and day: failures, traces, failed share of the day's events. Takes `day_facts`."""
    per_code = facts.groupBy("application_id", "day", "error_code", "correlation_id").agg(F.sum("n").alias("n")).groupBy(
        "application_id", "day", "error_code").agg(F.sum("n").alias("errors"), F.count("correlation_id").alias("traces"),
                                                   _when_sum(F.col("error_code").isNotNull()).alias("named"))
    whole = Window.partitionBy("application_id", "day")  # a day's error codes
    return per_code.withColumn("day_events", F.sum("errors").over(whole)).where("named > 0").drop("named").withColumn(
        "impact_pct", ratio(F.col("errors"), F.col("day_events"), 100.0))


def hypotheses(events: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Scores per application and day: tool degradation, model drift, retrieval staleness; best first.

    tool degradation = slowest tool's p95 over 10 s, at most 1; model drift = share of calls on a
    prompt version other than the previous day's main one; staleness = share of empty retrievals.
    """
    facts = day_facts(events) if facts is None else facts
    keys = ["application_id", "day"]
    rows = events.withColumn("day", F.col("event_ts").cast("date"))
    tools = percentiles(rows.where(F.col("event_type").startswith("TOOL_")), [*keys, "tool_id"], "latency_ms", {"p95": 0.95})
    tool = tools.groupBy(*keys).agg(F.when(F.max("p95").isNotNull(), F.least(F.lit(1.0), F.max("p95") / F.lit(10000.0))).alias("tool_degradation"))
    calls = _when_sum(F.col("event_type").startswith("LLM_"))
    versions = facts.groupBy(*keys, "prompt_template_id", "prompt_version").agg(calls.alias("n")).where("n > 0")
    main = versions.groupBy(*keys, "prompt_template_id").agg(
        F.min_by("prompt_version", F.struct(-F.col("n"), F.col("prompt_version"))).alias("main_version"))
    w = Window.partitionBy("application_id", "prompt_template_id").orderBy("day")
    previous = main.withColumn("previous_version", F.lag("main_version").over(w))
    drift = _joined(versions, previous, [*keys, "prompt_template_id"], "inner").groupBy(*keys).agg(
        ratio(F.sum(F.when(F.col("prompt_version") != F.col("previous_version"), F.col("n")).otherwise(0)), F.sum("n")).alias("model_drift"))
    retrievals = _when_sum(F.col("event_type").startswith("RAG_"))
    wide = facts.groupBy(*keys).agg(
        _when_sum(F.col("failed")).alias("errors"),
        ratio(_when_sum(F.col("event_type") == "RAG_NO_RESULT"), retrievals).alias("rag_staleness")).where("errors > 0")
    for side in (tool, drift):
        wide = _joined(wide, side, keys, "left")
    names = ["tool_degradation", "model_drift", "rag_staleness"]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("hypothesis"), F.round(F.col(n), 3).alias("score")) for n in names]))
    long = wide.select(*keys, "errors", pairs.alias("h")).select(*keys, "errors", "h.hypothesis", "h.score").where(
        F.col("score") > MIN_SCORE)
    ranked = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "hypothesis")
    return long.withColumn("rank", F.row_number().over(ranked))


def weekly_digest(incident_rows: DataFrame, ranked: DataFrame, n: int = 5) -> DataFrame:
    """The n largest incidents per week with the likeliest cause of their application and day."""
    best = ranked.where("rank = 1").select("application_id", "day", F.col("hypothesis").alias("likely_cause"), F.col("score").alias("cause_score"))
    weekly = incident_rows.withColumn("week", F.date_trunc("week", "day").cast("date"))
    top = top_per_group(weekly, ["week"], [F.col("errors").desc(), F.col("application_id"), F.col("day"), F.col("error_code")], n)
    return _joined(top, best, ["application_id", "day"], "left")
