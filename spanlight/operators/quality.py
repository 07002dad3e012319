"""Answer quality, embedding health, retrieval recall, prompt drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, vectors
from ..functions.times import hours_between
from ..session import computed_once, small_side
from .order_stats import exact_avg, top_per_group


def answer_quality(pairs: DataFrame) -> DataFrame:
    """Faithfulness and context utilisation of (context, response) pairs by token overlap."""
    return pairs.withColumns({
        "faithfulness": text.token_overlap(F.col("context"), F.col("response")),
        "context_utilisation": text.context_utilisation(F.col("context"), F.col("response")),
    })


def token_entropy(rows: DataFrame, keys: Sequence[str], body: str) -> DataFrame:
    """Shannon entropy in bits of each row's tokens: log2(n) - sum(c * log2(c)) / n.

    Counted inside the row over its sorted tokens, run by run, so no token is shuffled.
    """
    words = rows.select(*keys, F.sort_array(text.tokens(F.col(body))).alias("_t")).where(F.size("_t") > 0)
    cut = "CASE WHEN a.run > 1 THEN a.w + a.run * log2(a.run) ELSE a.w END"
    runs = F.expr(f"""aggregate(_t, named_struct('prev', CAST(NULL AS STRING), 'run', 0, 'kinds', 0, 'w', CAST(0 AS DOUBLE)),
        (a, t) -> CASE WHEN t <=> a.prev THEN named_struct('prev', a.prev, 'run', a.run + 1, 'kinds', a.kinds, 'w', a.w)
                  ELSE named_struct('prev', t, 'run', 1, 'kinds', a.kinds + 1, 'w', {cut}) END,
        a -> named_struct('kinds', a.kinds, 'w', {cut}))""")
    counted = computed_once(words, _r=runs, tokens=F.size("_t"))
    bits = F.log2("tokens") - F.col("_r.w") / F.col("tokens")
    return counted.select(*keys, "tokens", F.col("_r.kinds").alias("distinct_tokens"), F.round(bits, 9).alias("entropy_bits"))


def entropy_flag(entropy: Column, low: float, high: float) -> Column:
    """Repetitive or incoherent answers are a hallucination risk."""
    return F.when(entropy < low, "repetitive").when(entropy > high, "incoherent").otherwise("normal")


def daily_quality(scores: DataFrame) -> DataFrame:
    """Mean scores and samples per day and knowledge base."""
    return scores.groupBy("rag_id", F.col("event_ts").cast("date").alias("day")).agg(
        exact_avg("faithfulness").alias("avg_faithfulness"), exact_avg("precision").alias("avg_precision"),
        F.count(F.lit(1)).alias("sample_count"))


def vector_health(chunks: DataFrame, as_of: Column, sla_hours: float = 24.0) -> DataFrame:
    """Per corpus: chunks, last indexing, mean norm, hours since, freshness breach."""
    stats = chunks.groupBy("corpus").agg(
        F.max("created_at").alias("last_indexed_at"), F.count(F.lit(1)).alias("chunk_count"),
        exact_avg(vectors.l2_norm(F.col("embedding")), 9).alias("avg_norm"))
    return stats.withColumn("hours_since_indexed", hours_between(as_of, F.col("last_indexed_at"))).withColumn(
        "freshness_breach", F.col("hours_since_indexed") > sla_hours)


def centroids(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Element-wise mean vector per key.

    Averaged per (key, position) with map-side combine; the vector is rebuilt from one value per
    position, so its size is the dimension, not the number of rows.
    """
    by_position = chunks.select(*keys, F.posexplode("embedding").alias("pos", "x")).groupBy(*keys, "pos").agg(
        exact_avg("x", 9).alias("m"))
    return by_position.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda e: e["m"]).alias("centroid"))


def embedding_drift(chunks: DataFrame, corpus: str = "corpus", week: str = "week") -> DataFrame:
    """Shift of a corpus' centroid against its previous week: cosine and Euclidean distance."""
    c = centroids(chunks, [corpus, week])
    w = Window.partitionBy(corpus).orderBy(week)
    pairs = c.withColumns({"_prev": F.lag("centroid").over(w), "previous_week": F.lag(week).over(w)}).where("_prev IS NOT NULL")
    return pairs.select(
        corpus, week, "previous_week",
        vectors.cosine_distance(F.col("centroid"), F.col("_prev")).alias("cosine_shift"),
        vectors.l2_distance(F.col("centroid"), F.col("_prev")).alias("l2_shift"))


def recall_at_k(retrieved: DataFrame, relevant: DataFrame, k: int, keys: Sequence[str] = ("corpus",)) -> DataFrame:
    """Mean share of a query's relevant documents found in its first k results.

    `retrieved(corpus, query_id, doc_id, score)`, `relevant(corpus, query_id, doc_id)`. The rank
    limit runs before the shuffle, the hit test is an equi-join.
    """
    top = top_per_group(retrieved, ["query_id"], [F.col("score").desc(), F.col("doc_id")], k)
    hits = top.join(relevant.select("query_id", "doc_id").distinct(), ["query_id", "doc_id"]).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("hits"))
    wanted = relevant.select(*keys, "query_id", "doc_id").distinct().groupBy(*keys, "query_id").agg(F.count(F.lit(1)).alias("wanted"))
    joined = wanted.join(hits, "query_id", "left").withColumn(
        "recall", F.coalesce("hits", F.lit(0)) / F.col("wanted"))
    return joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("queries"), exact_avg("recall", 9).alias("recall_at_k"))


def prompt_drift(calls: DataFrame, keys: Sequence[str] = ("application_id", "prompt_template_id")) -> DataFrame:
    """Weekly distinct prompt hashes per template, and whether the dominant hash changed."""
    weekly = calls.withColumn("week", F.date_trunc("week", "event_ts").cast("date")).groupBy(*keys, "week", "prompt_hash").agg(
        F.count(F.lit(1)).alias("n"))
    main = weekly.groupBy(*keys, "week").agg(
        F.count(F.lit(1)).alias("distinct_hashes"),
        F.min_by("prompt_hash", F.struct(-F.col("n"), F.col("prompt_hash"))).alias("main_hash"))
    w = Window.partitionBy(*keys).orderBy("week")
    return main.withColumn("previous_hash", F.lag("main_hash").over(w)).withColumn(
        "changed", F.col("previous_hash").isNotNull() & (F.col("previous_hash") != F.col("main_hash")))


def evaluated(scores: DataFrame, events: DataFrame) -> DataFrame:
    """Scores with the event they judge; orphans keep nulls and are flagged."""
    side = events.select(F.col("event_id").alias("evaluated_event_id"), "event_type", "event_ts", "application_id").withColumn("_hit", F.lit(True))
    return scores.join(side, "evaluated_event_id", "left").withColumn("orphan", F.col("_hit").isNull()).drop("_hit")


def freshness(indexed: DataFrame, registry: DataFrame, as_of: Column) -> DataFrame:
    """Hours since the last indexing against each corpus' own limit (24 h where none is set)."""
    dim = small_side(registry.select("rag_id", "freshness_sla_hours"))
    joined = indexed.join(dim, "rag_id", "left").withColumn("hours_since_indexed", hours_between(as_of, F.col("last_indexed_at")))
    return joined.withColumn("freshness_breach", F.col("hours_since_indexed") > F.coalesce("freshness_sla_hours", F.lit(24)))


