"""Data rules, references between tables, retention, prompt history and integrity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalogs import LIFECYCLE_POLICIES, TIERING_BY_PREFIX, TIERING_DEFAULT
from ..contract import CHECK_RULES
from ..functions.text import short_hash
from ..session import cut_lineage, small_side


def check_report(tables: dict[str, DataFrame], rules: Sequence[tuple[str, str, str]] = CHECK_RULES) -> DataFrame:
    """(table, rule, rows, bad_rows): one pass per table for all its rules. NULL passes, as in a CHECK."""
    out = None
    for name, df in tables.items():
        own = [(rule, predicate) for table, rule, predicate in rules if table == name]
        if not own:
            continue
        counted = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(~F.expr(p)).alias(r) for r, p in own])
        pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("bad")) for r, _ in own]))
        rows = counted.select(F.lit(name).alias("table_name"), "n", pairs.alias("p")).select(
            "table_name", F.col("p.rule").alias("rule"), F.col("n").alias("row_count"), F.col("p.bad").alias("bad_rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


def duplicate_keys(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def active_prompt_conflicts(registry: DataFrame) -> DataFrame:
    """Templates with more than one active version in the same experiment bucket."""
    return duplicate_keys(
        registry.where("status = 'active'"), ["template_id", F.coalesce("ab_bucket", F.lit("")).alias("ab_bucket")])


def unresolved(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with the number of rows.

    The child is reduced to distinct keys first, so a hot key costs one row in the join.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("missing_key")).agg(
        F.count(F.lit(1)).alias("rows"))
    side = parent.select(F.col(parent_key).alias("missing_key")).distinct()
    return keys.join(small_side(side), "missing_key", "left_anti")


def catalog_differences(left: DataFrame, right: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Keys present on one side only or with different values on the two sides."""
    l = left.select(key, *[F.col(v).alias(f"left_{v}") for v in values], F.lit(True).alias("_l"))
    r = right.select(key, *[F.col(v).alias(f"right_{v}") for v in values], F.lit(True).alias("_r"))
    joined = l.join(r, key, "full_outer")
    differs = F.lit(False)
    for v in values:
        differs = differs | ~F.col(f"left_{v}").eqNullSafe(F.col(f"right_{v}"))
    state = F.when(F.col("_r").isNull(), "left only").when(F.col("_l").isNull(), "right only").when(differs, "different")
    return joined.withColumn("state", state).where("state IS NOT NULL").drop("_l", "_r")


def lifecycle_plan(partitions: DataFrame, today: Column, policy: str = "hot-warm-30d") -> DataFrame:
    """Action per stored day of a family: keep, warm or delete, by the policy's ages in days."""
    _, warm, delete = next(p for p in LIFECYCLE_POLICIES if p[0] == policy)
    age = F.datediff(today, F.col("event_date"))
    action = F.when(age >= delete, "delete").when(age >= warm, "warm").otherwise("hot")
    return partitions.withColumns({"age_days": age, "action": action})


def month_retention(partitions: DataFrame, today: Column, keep_months: int = 3) -> DataFrame:
    """Months before the retention window: archived first, then dropped."""
    cutoff = F.add_months(F.trunc(today, "MM"), -keep_months)
    return partitions.where(F.col("event_month") < cutoff).withColumn("action", F.lit("archive_then_drop"))


def storage_tier(prefix: Column, age_days: Column) -> Column:
    """Storage class of an archived object by its prefix and age."""
    def tier(rule: tuple) -> Column:
        warm, cold, expiry = rule
        chain = F.when(age_days >= cold, "cold").when(age_days >= warm, "infrequent").otherwise("standard")
        return chain if expiry is None else F.when(age_days >= expiry, "expired").otherwise(chain)

    out = tier(TIERING_DEFAULT)
    for name, rule in TIERING_BY_PREFIX.items():
        out = F.when(prefix == name, tier(rule)).otherwise(out)
    return out


def active_version_at(audit: DataFrame, as_of: Column) -> DataFrame:
    """The version in force per template: its last activation or rollback up to a time."""
    past = audit.where((F.col("occurred_at") <= as_of) & F.col("action").isin("activated", "rolled_back"))
    at = F.struct("occurred_at", "audit_id")
    return past.groupBy("template_id").agg(
        F.max_by("version", at).alias("version"), F.max_by("action", at).alias("action"), F.max("occurred_at").alias("since"))


def version_history(audit: DataFrame) -> DataFrame:
    """Validity interval of every activation or rollback."""
    changes = audit.where(F.col("action").isin("activated", "rolled_back"))
    w = Window.partitionBy("template_id").orderBy("occurred_at", "audit_id")
    return changes.select("template_id", "version", "action", F.col("occurred_at").alias("valid_from"),
                          F.lead("occurred_at").over(w).alias("valid_to"))


def hash_mismatches(registry: DataFrame) -> DataFrame:
    """Prompt versions whose stored hash is not that of their text."""
    return registry.withColumn("expected_hash", short_hash(F.col("template_text"))).where("prompt_hash <> expected_hash")


def reconcile(source: DataFrame, target: DataFrame, key: str = "event_id") -> DataFrame:
    """Keys written to only one of two stores."""
    both = source.select(key, F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        target.select(key, F.lit(0).alias("s"), F.lit(1).alias("t")))
    seen = both.groupBy(key).agg(F.max("s").alias("s"), F.max("t").alias("t"))
    return seen.where("s <> t").select(key, F.when(F.col("s") == 1, "target").otherwise("source").alias("missing_in"))


DIGEST_BUCKETS = 4096


def _digests(rows: DataFrame, at: str) -> DataFrame:
    """(bucket, digest): count, exclusive or and two sums of the row hashes; equal for equal multisets of rows."""
    low = F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("_h", 32)
    return rows.groupBy(at).agg(F.struct(F.count(F.lit(1)), F.bit_xor("_h"), F.sum(low), F.sum(high)).alias("digest"))


def _unequal(source: DataFrame, target: DataFrame, at: str) -> DataFrame:
    """The buckets in which the two sides differ."""
    both = _digests(source, at).withColumnRenamed("digest", "s").join(_digests(target, at).withColumnRenamed("digest", "t"), at, "full_outer")
    return both.where(~F.col("s").eqNullSafe(F.col("t"))).select(at)


def reconcile_rows(source: DataFrame, target: DataFrame, key: str, values: Sequence[str] = (), buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """Keys whose rows differ between two stores: (key, state, source_rows, target_rows), state `missing in target`,
    `missing in source`, `repeated` (the same rows, other numbers of them) or `changed`.

    Both sides are first compared by the digests of `buckets` hash ranges of the key, summed in the tasks, so a range
    travels as one row per task; then the unequal ranges by `buckets` finer ones. Rows are shuffled only
    from finer ranges that differ: for equal stores none.
    """
    def side(df: DataFrame) -> DataFrame:
        kept = df.select(key, *values)
        spread = F.xxhash64(F.col(key).cast("string"), F.lit(7))
        return kept.withColumns({"_h": F.xxhash64(*[F.col(c) for c in [key, *values]]), "_b": F.pmod(spread, F.lit(buckets)),
                                 "_f": F.pmod(F.shiftrightunsigned(spread, 20), F.lit(buckets))})

    s, t = side(source), side(target)
    coarse = cut_lineage(_unequal(s, t, "_b"))  # `buckets` rows at most
    s, t = (x.join(F.broadcast(coarse), "_b", "left_semi").withColumn("_bf", F.col("_b") * buckets + F.col("_f")) for x in (s, t))
    fine = cut_lineage(_unequal(s, t, "_bf"))
    s, t = (x.join(small_side(fine), "_bf", "left_semi") for x in (s, t))
    rows = s.select(key, "_h", F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(t.select(key, "_h", F.lit(0).alias("s"), F.lit(1).alias("t")))
    kinds = rows.groupBy(key, "_h").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    keys = kinds.groupBy(key).agg(
        F.sum("s").alias("source_rows"), F.sum("t").alias("target_rows"),
        F.max(F.col("s") != F.col("t")).alias("differ"), F.max((F.col("s") == 0) | (F.col("t") == 0)).alias("changed"))
    state = F.when(F.col("target_rows") == 0, "missing in target").when(F.col("source_rows") == 0, "missing in source").when(
        F.col("changed"), "changed").otherwise("repeated")
    return keys.where("differ").select(key, state.alias("state"), "source_rows", "target_rows")
