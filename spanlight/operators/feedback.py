"""Feedback records: summaries, lists, lifecycle, anonymisation, attribution."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_side
from .order_stats import exact_avg, ratio
from .validate import known_feedback_type

MAX_PAGE_SIZE = 200


def selected(feedback: DataFrame, usecase_id: str | None = None, correlation_id: str | None = None,
             feedback_type: str | None = None, correctness: bool | None = None, status: str | None = None,
             from_date: date | str | None = None, to_date: date | str | None = None) -> DataFrame:
    """The filters every feedback read accepts; date bounds are inclusive days."""
    out = feedback
    for name, wanted in (("usecase_id", usecase_id), ("correlation_id", correlation_id),
                         ("feedback_type", feedback_type), ("correctness", correctness), ("status", status)):
        if wanted is not None:
            out = out.where(F.col(name) == F.lit(wanted))
    if from_date is not None:
        out = out.where(F.col("created_at") >= F.lit(str(from_date)).cast("timestamp_ntz"))
    if to_date is not None:
        out = out.where(F.col("created_at") < F.date_add(F.lit(str(to_date)).cast("date"), 1).cast("timestamp_ntz"))
    return out


def _rates() -> dict[str, Column]:
    up, down = F.count_if(F.col("correctness")), F.count_if(~F.col("correctness"))
    return {
        "total": F.count(F.lit(1)), "correct_count": up, "incorrect_count": down,
        "correctness_rate": F.round(ratio(up, up + down), 4),
        # Rounded as a decimal: a mean that ends in 5 must not depend on its binary form.
        "avg_confidence": F.round(F.sum(F.col("confidence_score").cast("decimal(18,6)")) / F.nullif(F.count("confidence_score"), F.lit(0)), 4).cast("double"),
    }


def summary(feedback: DataFrame) -> DataFrame:
    """One row: totals, correctness rate, confidence, counts by status."""
    by_status = {f"{s}_count": F.count_if(F.col("status") == s) for s in ("open", "reviewed", "fixed")}
    return feedback.agg(*[c.alias(n) for n, c in {**_rates(), **by_status}.items()])


def by_type(feedback: DataFrame) -> DataFrame:
    """Per type with the correctness split, most frequent first."""
    rates = {n: c for n, c in _rates().items() if n != "correctness_rate"}
    return feedback.groupBy("feedback_type").agg(*[c.alias(n) for n, c in rates.items()]).orderBy(
        F.col("total").desc(), "feedback_type")


def daily_trend(feedback: DataFrame) -> DataFrame:
    rates = _rates()
    return feedback.groupBy(F.col("created_at").cast("date").alias("day")).agg(
        *[c.alias(n) for n, c in rates.items()]
    ).withColumn("no_correctness", F.col("total") - F.col("correct_count") - F.col("incorrect_count"))


def page(feedback: DataFrame, number: int = 1, size: int = 50) -> DataFrame:
    """One page, newest first, with the total and whether more follow.

    The total is a scalar subquery; offset and limit are pushed into the sort.
    """
    if not 1 <= size <= MAX_PAGE_SIZE or number < 1:
        raise ValueError(f"page numbers start at 1 and sizes lie in 1..{MAX_PAGE_SIZE}")
    total = feedback.agg(F.count(F.lit(1)).alias("total"))
    rows = feedback.orderBy(F.col("created_at").desc(), "feedback_id").offset((number - 1) * size).limit(size)
    listed = rows.withColumns({
        "has_comments": F.col("comments").isNotNull(),
    }).drop("prompt", "comments")
    return listed.withColumn("total", total.scalar()).withColumn("has_next", F.lit(number * size) < F.col("total"))


def page_after(feedback: DataFrame, created_at: Column | None = None, feedback_id: Column | None = None, size: int = 50) -> DataFrame:
    """The page behind a record, newest first; without one the first page. Costs a page however far back it lies."""
    if not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError(f"page sizes lie in 1..{MAX_PAGE_SIZE}")
    rows = feedback
    if created_at is not None:
        rows = rows.where((F.col("created_at") < created_at) | ((F.col("created_at") == created_at) & (F.col("feedback_id") > feedback_id)))
    return rows.orderBy(F.col("created_at").desc(), "feedback_id").limit(size).withColumn(
        "has_comments", F.col("comments").isNotNull()).drop("prompt", "comments")


def problems(feedback: DataFrame, number: int = 1, size: int = 50) -> DataFrame:
    return page(feedback.where(~F.col("correctness")), number, size)


def normalised_types(feedback: DataFrame) -> DataFrame:
    """Unknown types become 'other'; the flag counts them for migration."""
    kind, unknown = known_feedback_type(F.col("feedback_type"))
    return feedback.withColumns({"feedback_type": kind, "unknown_type": unknown})


def latest_per_user(feedback: DataFrame) -> DataFrame:
    """One record per user and chat event: the last one counts."""
    w = Window.partitionBy("soe_id", "correlation_id").orderBy(F.col("created_at").desc(), F.col("feedback_id").desc())
    return feedback.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def anonymise(feedback: DataFrame, subjects: DataFrame) -> DataFrame:
    """Rows of the listed feedback ids lose user, prompt, comments and response but stay countable."""
    marked = feedback.join(small_side(subjects.select("feedback_id").distinct().withColumn("_anon", F.lit(True))), "feedback_id", "left")
    hide = F.coalesce("_anon", F.lit(False))
    cleared = {"soe_id": F.lit("ANONYMISED"), "prompt": F.lit("<anonymised>"), "comments": F.lit(None).cast("string"),
               "response_text": F.lit('{"anonymised":true}')}
    return marked.withColumns({
        c: F.when(hide, v).otherwise(F.col(c)) for c, v in cleared.items() if c in feedback.columns}).drop("_anon")


def attribution(feedback: DataFrame, events: DataFrame) -> DataFrame:
    """Feedback by the agent, model, tool and knowledge base involved in the same correlation id.

    Both sides are reduced to one row per correlation id (and component) before the join, so a busy
    correlation id costs its components, not feedback times components.
    """
    given = feedback.groupBy("correlation_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("rating") <= 2).alias("neg"),
        F.sum("rating").alias("stars"), F.count("rating").alias("rated"))
    parts = F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.when(cond, F.col(col)).alias("component")) for kind, cond, col in (
            ("agent", F.col("event_type").startswith("AGENT_"), "agent_id"),
            ("model", F.col("event_type").startswith("LLM_"), "model_name"),
            ("tool", F.col("event_type").startswith("TOOL_"), "tool_id"),
            ("knowledge_base", F.col("event_type").startswith("RAG_"), "rag_id"))]))
    involved = events.select("correlation_id", parts.alias("p")).select("correlation_id", "p.kind", "p.component").where(
        "component IS NOT NULL").distinct()
    return given.join(involved, "correlation_id").groupBy("kind", "component").agg(
        F.sum("n").alias("feedback_count"), F.sum("neg").alias("negative_count"),
        ratio(F.sum("stars"), F.sum("rated")).alias("avg_rating"))


def case_state(history: DataFrame) -> DataFrame:
    """Current state per case from its status changes: opened, last status, resolved, cycle hours."""
    at = F.struct("changed_at", "change_id")
    closed = F.col("status").isin("fixed", "wont_fix")
    return history.groupBy("case_id").agg(
        F.min("changed_at").alias("opened_at"), F.max_by("status", at).alias("status"),
        F.count(F.lit(1)).alias("changes"), F.max(F.when(closed, F.col("changed_at"))).alias("_closed"),
    ).withColumn("resolved_at", F.when(closed, F.col("_closed"))).withColumn(
        "cycle_hours",
        (F.unix_micros(F.col("resolved_at").cast("timestamp")) - F.unix_micros(F.col("opened_at").cast("timestamp"))) / F.lit(3.6e9),
    ).drop("_closed")


def mean_time_to_resolve(cases: DataFrame) -> DataFrame:
    return cases.groupBy("status").agg(F.count(F.lit(1)).alias("cases"), exact_avg("cycle_hours", 6).alias("mttr_hours"))
