"""Joins with registries, catalogs, prices, limits and policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalogs import ErrorRule
from ..functions import money, text
from ..session import computed_once, small_side


def with_registry(events: DataFrame, apps: DataFrame) -> DataFrame:
    """Application context: lob filled only where empty, owner and criticality from the registry."""
    dim = small_side(apps.select(
        F.col("application_id").alias("_app"), F.col("lob").alias("_lob"), F.col("usecase_id").alias("_uc"),
        F.col("owner_team").alias("app_owner_team"), F.col("criticality").alias("app_criticality"),
    ))
    joined = events.join(dim, F.col("application_id") == F.col("_app"), "left")
    usecase = F.coalesce(F.col("usecase_id"), F.col("_uc")) if "usecase_id" in events.columns else F.col("_uc")
    return joined.withColumns({
        "lob": F.coalesce(F.nullif("lob", F.lit("")), F.col("_lob")),
        "usecase_id": usecase,
        "app_registered": F.when(F.col("application_id").isNotNull(), F.col("_app").isNotNull()),
    }).drop("_app", "_lob", "_uc")


def latest_active(registry: DataFrame, key: str, version: str) -> DataFrame:
    """Highest active version per key."""
    w = Window.partitionBy(key).orderBy(F.col(version).desc())
    return registry.where(F.col("status") == "active").withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def with_agent_and_tool(events: DataFrame, agents: DataFrame, tools: DataFrame) -> DataFrame:
    """Names and types from the agent and tool registries; sla_breached against the tool's target."""
    a = small_side(latest_active(agents, "agent_id", "agent_version").select(
        "agent_id", "agent_name", "agent_type", "agent_version", "max_steps"))
    t = small_side(latest_active(tools, "tool_id", "tool_version").select(
        "tool_id", "tool_name", F.col("sla_latency_ms").alias("tool_sla_ms")))
    joined = events.join(a, "agent_id", "left").join(t, "tool_id", "left")
    return joined.withColumn(
        "sla_breached",
        F.when(F.col("tool_name").isNotNull(),
               F.coalesce(F.coalesce("latency_ms", F.lit(0.0)) > F.col("tool_sla_ms"), F.lit(False))),
    )


def price_intervals(prices: DataFrame) -> DataFrame:
    """Effective-dated prices as half-open validity intervals."""
    w = Window.partitionBy("model_name").orderBy("effective_from")
    return prices.withColumn("effective_to", F.lead("effective_from").over(w))


def with_prices(events: DataFrame, prices: DataFrame, model: str = "model_name", on: str = "event_date") -> DataFrame:
    """As-of join: the latest price effective on the event's date."""
    dim = small_side(price_intervals(prices).select(
        F.col("model_name").alias("_m"), F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to"),
        "input_usd_per_1k", "output_usd_per_1k"))
    valid = (F.col(model) == F.col("_m")) & (F.col(on) >= F.col("_from")) & (
        F.col("_to").isNull() | (F.col(on) < F.col("_to")))
    return events.join(dim, valid, "left").drop("_m", "_from", "_to")


def with_cost(events: DataFrame, prices: DataFrame) -> DataFrame:
    """Authoritative token cost for model calls; an unknown model keeps the producer's figure."""
    priced = with_prices(events, prices)
    is_model_call = F.col("event_type").startswith("LLM_")
    counted = F.col("input_tokens").isNotNull() | F.col("output_tokens").isNotNull()
    own = money.token_cost(F.col("input_tokens"), F.col("output_tokens"), F.col("input_usd_per_1k"), F.col("output_usd_per_1k"))
    has_price = F.col("input_usd_per_1k").isNotNull() & counted & is_model_call
    given = (F.col("estimated_cost_usd") if "estimated_cost_usd" in events.columns
             else F.when(is_model_call, money.producer_estimate(F.col("model_name"), F.col("input_tokens"), F.col("output_tokens"))))
    return priced.withColumns({
        "estimated_cost_usd": F.when(has_price, own).otherwise(given).cast(money.COST),
        "cost_source": F.when(has_price, "control_plane").when(is_model_call, "producer"),
    }).drop("input_usd_per_1k", "output_usd_per_1k")


def first_rule(rules: list[ErrorRule], body: Column, field: str) -> Column:
    """Ordered rule table folded into one expression: the first matching rule's field."""
    return F.coalesce(*[
        F.when(body.rlike(f"(?i){r.pattern}"), F.lit(getattr(r, field))) for r in rules
    ]) if rules else F.lit(None)


def with_error_code(events: DataFrame, rules: list[ErrorRule]) -> DataFrame:
    """Normalise errors: first active rule by priority over `code: message`, raw code kept."""
    concerned = (F.col("status") == "failed") | F.nullif("error_code", F.lit("")).isNotNull()
    body = F.when(concerned, text.error_text(F.col("error_code"), F.col("error_message")))
    by_code = {r.error_code: r for r in rules}

    def attribute(field: str) -> Column:
        pairs = [F.lit(x) for r in by_code.values() for x in (r.error_code, getattr(r, field))]
        return F.try_element_at(F.create_map(*pairs), F.col("_rule")) if pairs else F.lit(None)

    matched = computed_once(events, _rule=first_rule(rules, body, "error_code"))
    return matched.withColumns({
        "raw_error_code": F.when(F.col("_rule").isNotNull() & ~F.col("_rule").eqNullSafe(F.col("error_code")), F.col("error_code")),
        "error_category": attribute("category"),
        "error_retryable": attribute("retryable"),
        "error_code": F.coalesce("_rule", "error_code"),
    }).drop("_rule")


def match_budgets(costed: DataFrame, limits: DataFrame) -> DataFrame:
    """One row per event and limit: the app's own model limits and its '*' limits."""
    dim = small_side(limits.select(
        F.col("application_id").alias("_app"), F.col("model_name").alias("limit_model"), "period", "max_spend_usd", "alert_at_pct"))
    offered = costed.withColumn("_m", F.explode(F.array_distinct(F.array(F.coalesce("model_name", F.lit("*")), F.lit("*")))))
    return offered.join(dim, (F.col("application_id") == F.col("_app")) & (F.col("_m") == F.col("limit_model"))).drop("_m", "_app")


def match_slos(events: DataFrame, definitions: DataFrame) -> DataFrame:
    """One row per event and enabled objective of its application."""
    dim = small_side(definitions.where("enabled").drop("enabled"))
    return events.join(dim, "application_id")


def grants(policies: DataFrame, subject: str) -> DataFrame:
    return policies.where((F.col("subject_id") == subject) & F.col("active_flag"))


def scoped(events: DataFrame, policies: DataFrame, subject: str,
           payload_columns: tuple[str, ...] = ("payload", "error_message"), log_columns: tuple[str, ...] = ("message", "log")) -> DataFrame:
    """Rows the subject may see: all for an admin, otherwise by line of business, application or agent.

    Payload columns are blanked unless the subject holds read_payloads on the row or is an admin; columns of
    log text unless it holds read_logs, read_payloads or is an admin.
    """
    own = grants(policies, subject)
    scopes = [k for k in ("lob", "application_id", "agent_id") if k in events.columns and k in policies.columns]

    def flag(df: DataFrame, permitted: DataFrame, name: str) -> DataFrame:
        nowhere = F.lit(True)
        for k in ("lob", "application_id", "agent_id"):
            nowhere = nowhere & (F.col(k).isNull() if k in policies.columns else F.lit(True))
        everything = permitted.where((F.col("permission") == "admin") & nowhere).agg(F.count(F.lit(1)) > 0)
        seen, out = everything.scalar(), df
        for k in scopes:
            side = permitted.where(F.col(k).isNotNull()).select(F.col(k).alias(f"_{k}")).distinct()
            out = out.join(small_side(side), F.col(k) == F.col(f"_{k}"), "left")
            seen = seen | F.col(f"_{k}").isNotNull()
        return out.withColumn(name, seen).drop(*[f"_{k}" for k in scopes])

    out = flag(events, own, "_see").where("_see").drop("_see")
    for columns, rights in ((payload_columns, ("read_payloads", "admin")), (log_columns, ("read_logs", "read_payloads", "admin"))):
        present = [c for c in columns if c in events.columns]
        if present:
            out = flag(out, own.where(F.col("permission").isin(*rights)), "_read")
            out = out.withColumns({c: F.when(F.col("_read"), F.col(c)) for c in present}).drop("_read")
    return out


def with_cheaper_model(costed: DataFrame, catalog: list[tuple[str, str, str]]) -> DataFrame:
    """Price the same tokens with the next cheaper model."""
    offer = money.cheaper_alternative(F.col("input_tokens"), F.col("output_tokens"), F.col("estimated_cost_usd"), catalog)
    return costed.withColumn("_o", offer).withColumns({
        "alternative_model": F.col("_o.model"), "alternative_cost_usd": F.col("_o.cost"),
    }).drop("_o")


def any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out
