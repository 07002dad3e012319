"""From enriched events to stored tables: typed rows, routing, domain projections, dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contract
from ..session import small_side

# Named row filters that the stored tables were indexed for.
NAMED_FILTERS = {
    "errors": "error_code IS NOT NULL",
    "no_result": "no_result_flag",
    "negative_feedback": "sentiment = 'negative' OR thumbs = 'down'",
    "bad_quality": "hallucination_flag OR score < 0.5",
    "breached": "breached",
}


def named_filter(df: DataFrame, name: str) -> DataFrame:
    return df.where(NAMED_FILTERS[name])


def typed(events: DataFrame) -> DataFrame:
    """Envelope rows with parsed times and partition columns; unparseable times fall back to ingest time."""
    ts = F.coalesce(F.try_to_timestamp("timestamp"), F.try_to_timestamp("emitted_at"), F.current_timestamp()).cast("timestamp_ntz")
    return events.withColumn("event_ts", ts).withColumns({
        "event_date": F.col("event_ts").cast("date"),
        "event_month": F.date_format("event_ts", "yyyy-MM"),
    })


def index_family(event_type: Column, status: Column) -> Column:
    """Index family by type prefix; failed events go to errors."""
    by_prefix = F.coalesce(
        *[F.when(event_type.startswith(prefix), family) for prefix, family in contract.INDEX_ROUTES],
        F.lit(contract.DEFAULT_INDEX_FAMILY))
    return F.when(status == "failed", "errors").otherwise(by_prefix)


def routed(events: DataFrame, day: str = "event_date") -> DataFrame:
    """Family and daily index name `ai-obs-{lob}-{family}-{yyyy.MM.dd}`; no line of business means shared."""
    family = index_family(F.col("event_type"), F.col("status"))
    name = F.concat_ws("-", F.lit("ai-obs"), F.coalesce("lob", F.lit("shared")), F.col("index_family"), F.date_format(day, "yyyy.MM.dd"))
    return events.withColumn("index_family", family).withColumn("index_name", name)


def _promoted(family: str) -> list[Column]:
    """One typed column per promoted payload key; the first alias present wins."""
    columns = []
    for name, sql_type in contract.FAMILY_COLUMNS[family]:
        reads = [F.expr(f"try_variant_get(payload['{key}'], '$', '{sql_type}')") for key in contract.COLUMN_ALIASES.get(name, [name])]
        columns.append(F.coalesce(*reads).alias(name))
    return columns


_COMMON = ["event_id", "event_ts", "event_type", "correlation_id", "application_id", "lob"]


def domain_projection(events: DataFrame, family: str) -> DataFrame:
    """Payload keys of a family promoted into typed columns."""
    kept = [F.col(c) for c in _COMMON if c in events.columns]
    promoted = _promoted(family)
    outcome = [F.col(c) for c in ("latency_ms", "status") if c in events.columns]
    return events.select(*kept, *promoted, *outcome)


def domain_tables(events: DataFrame) -> dict[str, DataFrame]:
    """One projection per domain table, each filtered by its literal type prefix."""
    return {
        table: domain_projection(events.where(F.col("event_type").startswith(prefix)), family)
        for table, (prefix, family) in contract.DOMAIN_TABLES.items()
    }


def signal_tables(events: DataFrame) -> dict[str, DataFrame]:
    """Log and metric tables by telemetry type."""
    def key(name: str, sql_type: str = "string") -> Column:
        return F.expr(f"try_variant_get(payload['{name}'], '$', '{sql_type}')").alias(name)

    logs = events.where("telemetry_type = 'log'").select(
        "event_id", "event_ts", "correlation_id", "service_name", "environment", "component", "error_code", "http_status",
        key("severity"), key("logger_name"), key("message"))
    metrics = events.where("telemetry_type = 'metric'").select(
        "event_id", "event_ts", "correlation_id", "service_name", "environment",
        key("metric_name"), key("metric_value", "decimal(20,6)"), key("metric_unit"), key("metric_type"))
    return {"logs": logs, "metrics": metrics}


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key. The rank filter prunes copies in each map task, so a key with very many
    copies sends one row per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def not_yet_stored(batch: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a batch whose key is not in the stored rows.

    The stored side is first reduced to the batch's keys; for a batch of checked small size that is
    a broadcast filter, so the stored rows are never shuffled.
    """
    hits = stored.select(*keys).join(small_side(batch.select(*keys)), keys, "left_semi")
    return batch.join(hits, keys, "left_anti")


def with_replay_state(dead: DataFrame, replayed: DataFrame) -> DataFrame:
    """Dead letters with `reprocessed` and its time, from the table of replayed ids."""
    last = replayed.groupBy("dead_id").agg(F.max("replayed_at").alias("reprocessed_at"))
    return dead.join(last, "dead_id", "left").withColumn("reprocessed", F.col("reprocessed_at").isNotNull())


def incident_rows(tables: dict[str, DataFrame], correlation_ids: DataFrame) -> dict[str, DataFrame]:
    """Everything stored for a set of correlation ids."""
    wanted = correlation_ids.select("correlation_id").distinct()
    return {name: df.join(wanted, "correlation_id", "left_semi") for name, df in tables.items()}
