"""Registration of named queries, and the checking SQL that belongs to each."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalogs, fixtures
from ..operators import enrich, lookups, validate
from ..session import shared_dir


class Context(fixtures.Tables):
    """The tables and views of one data folder, plus events at the usual stages of enrichment."""

    @property
    def slos(self) -> DataFrame:
        """Objectives with their event filter as a map; null filters are left out."""
        names = {"filter_type": "event_type", "filter_service": "service_name"}
        pairs = F.filter(F.array(*[F.struct(F.lit(n).alias("key"), F.col(c).alias("value")) for c, n in names.items()]), lambda e: e["value"].isNotNull())
        return self.view("slos").withColumn("event_filter", F.map_from_entries(pairs)).drop(*names)

    @property
    def costed(self) -> DataFrame:
        return lookups.with_cost(self.obs, self.prices)

    @property
    def spend(self) -> DataFrame:
        return self.costed.where("event_type LIKE 'LLM%'").withColumn("cost_usd", F.col("estimated_cost_usd"))

    @property
    def coded(self) -> DataFrame:
        return lookups.with_error_code(self.obs, catalogs.error_rules())

    @property
    def full(self) -> DataFrame:
        return lookups.with_error_code(self.costed, catalogs.error_rules())

    @property
    def validated(self) -> DataFrame:
        return validate.validate(self.raw_events.select("seq", "value"), now=F.lit("2024-02-01 00:00:00").cast("timestamp"))

    @property
    def enriched(self) -> DataFrame:
        return enrich.enrich(
            validate.good(self.validated), enrich.Dimensions(self.app_registry, self.prices, catalogs.error_rules()))


def run_folder(c: Context) -> str:
    """A folder of this run in the shared place; it goes when the session ends."""
    folder = f"{shared_dir(c.spark)}/spanlight-runs/{uuid.uuid4().hex}"
    path = c.spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(c.spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    build: Callable[[Context], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query under a name with the inventory rows it covers and its checking SQL."""
    def keep(build: Callable[[Context], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(name, covers, build, sql)
        return build

    return keep


def plain(df: DataFrame) -> DataFrame:
    """Result columns in the types both engines share: decimals as doubles, floats rounded."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            c = c.cast("double")
        elif kind in ("double", "float"):
            c = F.round(c.cast("double"), 6)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        out.append(c.alias(name))
    return df.select(*out)


def run(name: str, spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    return plain(QUERIES[name].build(Context(spark, sf_dir, partitions)))


# --------------------------------------------------------------------------
# Checking SQL
# --------------------------------------------------------------------------
def _rule_case(field: str) -> str:
    body = "concat(coalesce(error_code, ''), ': ', coalesce(error_message, ''))"
    arms = " ".join(
        f"WHEN regexp_matches({body}, '(?i){r.pattern}') THEN "
        + (f"'{getattr(r, field)}'" if isinstance(getattr(r, field), str) else str(getattr(r, field)).upper())
        for r in catalogs.error_rules())
    return f"CASE WHEN status = 'failed' OR nullif(error_code, '') IS NOT NULL THEN CASE {arms} END END"


_COST = """round((CAST(coalesce(o.input_tokens, 0) AS DECIMAL(12,0)) * {pin} + CAST(coalesce(o.output_tokens, 0) AS DECIMAL(12,0)) * {pout})
         * CAST(0.001 AS DECIMAL(3,3)), 8)"""

SQL_VIEWS = {
    "costed": ("""
SELECT o.*, CASE WHEN o.event_type LIKE 'LLM\\_%' ESCAPE '\\' THEN
    CASE WHEN p.model_name IS NOT NULL THEN """ + _COST.format(pin="p.input_usd_per_1k", pout="p.output_usd_per_1k") + """
         ELSE """ + _COST.format(pin="CAST(0.005 AS DECIMAL(12,8))", pout="CAST(0.015 AS DECIMAL(12,8))") + """ END END AS estimated_cost_usd,
  CASE WHEN o.event_type LIKE 'LLM\\_%' ESCAPE '\\' THEN CASE WHEN p.model_name IS NOT NULL THEN 'control_plane' ELSE 'producer' END END AS cost_source
FROM obs o ASOF LEFT JOIN prices p ON o.model_name = p.model_name AND o.event_date >= p.effective_from""", ["obs", "prices"]),
    "spend": ("SELECT *, estimated_cost_usd AS cost_usd FROM costed WHERE event_type LIKE 'LLM%'", ["costed"]),
    "full_events": (f"""
SELECT * REPLACE (coalesce({_rule_case('error_code')}, error_code) AS error_code),
  {_rule_case('error_code')} AS rule_code, error_code AS given_code,
  {_rule_case('category')} AS error_category, {_rule_case('retryable')} AS error_retryable
FROM costed""", ["costed"]),
    "raw_checked": ("""
SELECT seq, CASE WHEN json_valid(value) THEN value END AS value, json_valid(value) AS is_json,
  CASE WHEN json_valid(value) THEN json_type(value) END AS root FROM raw_events""", ["raw_events"]),
}
fixtures_views = {**fixtures.VIEWS, **SQL_VIEWS}


def _call(sql: str, name: str, make: Callable[[str], str]) -> str:
    """Expand `name(...)` with balanced parentheses."""
    out, i = [], 0
    pattern = re.compile(rf"\b{name}\(")
    while True:
        hit = pattern.search(sql, i)
        if not hit:
            return "".join(out) + sql[i:]
        depth, j = 1, hit.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            j += 1
        out.append(sql[i:hit.start()] + make(_call(sql[hit.end():j - 1], name, make)))
        i = j


def oracle(name: str) -> str | None:
    sql = QUERIES[name].sql
    if sql is None:
        return None
    sql = _call(sql, "davg", lambda x: f"(CAST(sum(CAST(({x}) AS DECIMAL(18,3))) AS DOUBLE) / nullif(count({x}), 0))")
    sql = _call(sql, "r6", lambda x: f"round(CAST(({x}) AS DOUBLE), 6)")
    sql = _call(sql, "dbl", lambda x: f"CAST({x} AS DOUBLE)")
    sql = _call(sql, "n", lambda x: f"CAST({x} AS BIGINT)")
    return _with_views(sql)


def _view_sql(name: str) -> str:
    if name in SQL_VIEWS:
        return SQL_VIEWS[name][0]
    return fixtures.duckdb_view(name)


def _with_views(sql: str) -> str:
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in fixtures_views[name][1]:
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in fixtures_views:
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            add(name)
    body = sql.strip()
    if not wanted:
        return body
    ctes = ",\n".join(f"{name} AS ({_view_sql(name)})" for name in wanted)
    head = re.match(r"WITH\s+(RECURSIVE\s+)?", body)
    if head:
        return f"WITH {head[1] or ''}{ctes},\n{body[head.end():]}"
    return f"WITH {ctes}\n{body}"
