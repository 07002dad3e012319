"""Span assembly, span trees, waterfalls and trace summaries.

Trees are resolved for all traces at once by pointer doubling: every span joins to its current
ancestor's ancestor, so a chain of depth d takes log2(d) joins on (correlation_id, span_id). The
join key contains the span, so one huge trace is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order_stats import running_sums

FEW_SPANS = 50_000  # so many spans of chosen traces are walked level by level
FEW_LEVELS = 64  # and no deeper than this


def assemble(span_events: DataFrame) -> DataFrame:
    """Started and terminal events of a span as one row: start, end, status; open spans have no end."""
    started, ended = F.col("phase") == "STARTED", F.col("phase") == "TERMINAL"
    return span_events.groupBy("correlation_id", "span_id").agg(
        F.min_by("parent_span_id", F.struct("event_ts", "event_id")).alias("parent_span_id"),
        F.min(F.when(started, F.col("event_ts"))).alias("start_ts"),
        F.max(F.when(ended, F.col("event_ts"))).alias("end_ts"),
        F.max_by(F.when(ended, F.col("status")), F.when(ended, F.struct("event_ts", "event_id"))).alias("status"),
    ).withColumns({
        "status": F.coalesce("status", F.lit("open")),
        "duration_ms": (F.unix_micros(F.col("end_ts").cast("timestamp")) - F.unix_micros(F.col("start_ts").cast("timestamp"))) / F.lit(1000.0),
    })


def _doubled(start: DataFrame, merge: dict[str, Column]) -> DataFrame:
    """Pointer doubling: every span takes over its ancestor's ancestor until no further span meets a root.

    `start` has the keys, `up` (null at a root) and the columns that `merge` combines; in `merge` the ancestor's value of a
    column c is named a_c. Round r ends for the spans at depths from 2^(r-1) up to 2^r, so once a round ends for
    none, what still moves is on a cycle or below one.
    """
    keys = ["correlation_id", "span_id"]
    state = cut_lineage(start)
    finished, moving = state.where("up IS NULL"), state.where("up IS NOT NULL")
    left, before = moving.count(), None
    while left and left != before:
        above = finished.unionByName(moving).select(
            "correlation_id", F.col("span_id").alias("up"), F.col("up").alias("a_up"), *[F.col(c).alias(f"a_{c}") for c in merge])
        # Only spans still moving are joined and written again; finished ones stay where they are.
        moved = cut_lineage(moving.join(above, ["correlation_id", "up"]).select(
            *keys, F.col("a_up").alias("up"), *[v.alias(c) for c, v in merge.items()]))
        finished, moving = finished.unionByName(moved.where("up IS NULL")), moved.where("up IS NOT NULL")
        left, before = moving.count(), left
    return finished.unionByName(moving)


def tree(spans: DataFrame, with_path: bool = False) -> DataFrame:
    """depth, root_span_id, child_count, self time and, if asked for, the path of every span.

    A span whose parent is missing becomes a root. A span that never meets a root is on a cycle or below one, is
    flagged `on_cycle` and has no root, depth or path. Doubling ends with the deepest span that has a root, so what a
    cycle gathers on the way is no longer than twice the longest path.
    """
    keys = ["correlation_id", "span_id"]
    ids = spans.select(*keys).distinct().withColumnRenamed("span_id", "parent_span_id").withColumn("_known", F.lit(True))
    linked = spans.select(*keys, "parent_span_id").join(ids, ["correlation_id", "parent_span_id"], "left").select(
        *keys, F.when(F.col("_known"), F.col("parent_span_id")).alias("up"))
    start = linked.select(*keys, "up", F.col("up").isNotNull().cast("long").alias("hops"), F.coalesce("up", "span_id").alias("top"),
                          *([F.col("span_id").alias("path")] if with_path else []))
    merge = {"hops": F.col("hops") + F.col("a_hops"), "top": F.col("a_top")}
    if with_path:
        merge["path"] = F.concat("a_path", F.lit("/"), "path")
    rooted = F.col("up").isNull()
    done = _doubled(start, merge).select(
        *keys, F.when(rooted, F.col("hops")).alias("depth"), F.when(rooted, F.col("top")).alias("root_span_id"), (~rooted).alias("on_cycle"),
        *([F.when(rooted, F.col("path")).alias("path")] if with_path else []))
    return _with_children(spans, done)


def _with_children(spans: DataFrame, placed: DataFrame) -> DataFrame:
    """The spans with their places in the tree, number of children and self time."""
    keys = ["correlation_id", "span_id"]
    children = spans.where(F.col("parent_span_id").isNotNull()).groupBy(
        "correlation_id", F.col("parent_span_id").alias("span_id")).agg(
        F.count(F.lit(1)).alias("child_count"), F.sum(F.col("latency_ms").cast("decimal(18,3)")).alias("_child_ms"))
    out = spans.join(placed, keys).join(children, keys, "left")
    own = F.col("latency_ms").cast("decimal(18,3)") - F.coalesce("_child_ms", F.lit(0))
    return out.withColumns({
        "child_count": F.coalesce("child_count", F.lit(0)), "self_ms": own.cast("double"),
    }).drop("_child_ms")


def tree_of(spans: DataFrame, ids: DataFrame, with_path: bool = False) -> DataFrame:
    """`tree` of a few traces, those whose correlation_id is in `ids`: a recursive query from the roots down.

    Their spans are read once and kept; a level then is one small join, and a shallow trace needs no rounds of
    checkpoints. The recursion stops by itself at the deepest span; spans it does not meet are on a cycle or below one. Traces of
    more than FEW_SPANS spans together, or with a span below FEW_LEVELS, are left to `tree`, whose result is the same.
    """
    keys = ["correlation_id", "span_id"]
    few = cut_lineage(spans.join(ids.select("correlation_id").distinct(), "correlation_id", "left_semi"))
    if few.limit(FEW_SPANS + 1).count() > FEW_SPANS:
        return tree(few, with_path)
    known = few.select(*keys).distinct().withColumnRenamed("span_id", "parent_span_id").withColumn("_known", F.lit(True))
    linked = cut_lineage(few.select(*keys, "parent_span_id").join(known, ["correlation_id", "parent_span_id"], "left").select(
        *keys, F.when(F.col("_known"), F.col("parent_span_id")).alias("up")))
    reached = cut_lineage(few.sparkSession.sql(f"""
        WITH RECURSIVE walk(correlation_id, span_id, depth, root_span_id, path) MAX RECURSION LEVEL {FEW_LEVELS + 2} AS (
          SELECT correlation_id, span_id, 0L, span_id, span_id FROM {{linked}} WHERE up IS NULL
          UNION ALL
          SELECT l.correlation_id, l.span_id, w.depth + 1, w.root_span_id, concat(w.path, '/', l.span_id)
          FROM walk w JOIN {{linked}} l ON l.correlation_id = w.correlation_id AND l.up = w.span_id WHERE w.depth < {FEW_LEVELS})
        SELECT * FROM walk""", linked=linked))
    deep = reached.where(F.col("depth") == FEW_LEVELS).select("correlation_id", F.col("span_id").alias("up"))
    if not linked.join(deep, ["correlation_id", "up"], "left_semi").isEmpty():
        return tree(few, with_path)
    placed = linked.select(*keys).join(reached if with_path else reached.drop("path"), keys, "left").withColumn(
        "on_cycle", F.col("depth").isNull())
    return _with_children(few, placed)


def waterfall(spans: DataFrame) -> DataFrame:
    """Offset from the trace start, position in the trace, running tokens."""
    starts = spans.groupBy("correlation_id").agg(F.min("event_ts").alias("_t0"))
    rows = spans.join(starts, "correlation_id").withColumns({
        "offset_ms": (F.unix_micros(F.col("event_ts").cast("timestamp")) - F.unix_micros(F.col("_t0").cast("timestamp"))) / F.lit(1000.0),
        "tokens": F.coalesce("input_tokens", F.lit(0)) + F.coalesce("output_tokens", F.lit(0)), "one": F.lit(1),
    }).withColumn("slot", F.floor(F.col("offset_ms") / 60000.0))
    return running_sums(rows, ["correlation_id"], "slot", ["event_ts", "event_id"], {
        "position": "one", "running_tokens": "tokens"}).drop("_t0", "one", "slot")


def summaries(events: DataFrame, scores: DataFrame, feedback: DataFrame) -> DataFrame:
    """One row per trace: spans, failures, extent, with evaluation scores and feedback attached.

    Each side is aggregated to one row per correlation id before it is joined.
    """
    traces = events.groupBy("correlation_id").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("status") == "failed").alias("failures"),
        F.min("event_ts").alias("started"), F.max("event_ts").alias("ended"))
    evals = scores.groupBy("correlation_id").agg(
        F.count(F.lit(1)).alias("scores"), F.min("score").alias("worst_score"),
        F.count_if("hallucination_flag").alias("hallucinations"))
    cases = feedback.groupBy("correlation_id").agg(
        F.count(F.lit(1)).alias("feedback_cases"), F.min("rating").alias("worst_rating"))
    joined = traces.join(evals, "correlation_id", "left").join(cases, "correlation_id", "left")
    return joined.fillna(0, ["scores", "hallucinations", "feedback_cases"])


def trace_events(families: dict[str, DataFrame], correlation_id: str | None = None) -> DataFrame:
    """All families of one correlation id (or of all) as one table with a family column."""
    out = None
    for family, df in families.items():
        rows = df if correlation_id is None else df.where(F.col("correlation_id") == correlation_id)
        rows = rows.withColumn("family", F.lit(family))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def chain_completeness(events: DataFrame) -> DataFrame:
    """Correlation ids and the steps of the expected chain they have, in order or not.

    Received -> agent started -> model or tool completed -> agent completed -> delivered. Only the
    first time of each step is kept, so a long trace needs five values, not a list.
    """
    t = F.col("event_type")
    steps = {
        "received": t == "REQUEST_RECEIVED", "agent_started": t == "AGENT_STARTED",
        "work_done": t.isin("LLM_CALL_COMPLETED", "TOOL_CALL_COMPLETED"), "agent_done": t == "AGENT_COMPLETED",
        "delivered": t.isin("RESPONSE_DELIVERED"),
    }
    firsts = events.groupBy("correlation_id").agg(*[F.min(F.when(c, F.col("event_ts"))).alias(n) for n, c in steps.items()])
    present = F.array(*[F.col(n) for n in steps])
    known = F.array_compact(present)
    return firsts.withColumns({
        "missing_steps": F.size(present) - F.size(known),
        "in_order": F.array_sort(known) == known,
    }).withColumn("complete", (F.col("missing_steps") == 0) & F.col("in_order"))
