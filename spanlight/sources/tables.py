"""Parquet tables: partitioned layout, idempotent appends, recomputed rollups, retention."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import domain_tables, first_per_key, not_yet_stored
from ..session import small_side


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def storable(df: DataFrame) -> DataFrame:
    """Variant payloads as JSON text, the form they have in stored tables."""
    kinds = dict(df.dtypes)
    return df.withColumn("payload", F.to_json("payload")) if kinds.get("payload", "").startswith("map") else df


ROWS_PER_FILE = 2_000_000
# Row groups without a wanted correlation id are skipped inside the files that `lookup` has found.
BLOOM = {"parquet.bloom.filter.enabled#correlation_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
# Dates come from messages. So many distinct days of a batch are listed by value; beyond, days share files by hash.
MAX_LISTED_DAYS = 400


def files_per_value(df: DataFrame, partition: str, rows_per_file: int = ROWS_PER_FILE) -> dict:
    """Files each of the largest partition values needs: at most MAX_LISTED_DAYS + 1 values reach the driver."""
    largest = df.groupBy(partition).count().orderBy(F.col("count").desc(), partition).limit(MAX_LISTED_DAYS + 1)
    return {r[0]: -(-r[1] // rows_per_file) for r in largest.collect()}


def laid_out(df: DataFrame, partition: str, files: dict, spread: str = "event_id") -> DataFrame:
    """One task per partition value, several for a large one: as many as it needs files."""
    share = F.lit(1)
    for value, n in files.items():
        if n > 1:
            share = F.when(F.col(partition) == F.lit(value), F.lit(n)).otherwise(share)
    target = (partition, F.pmod(F.hash(spread), share))
    return df.repartition(max(1, sum(files.values())), *target) if files else df.repartition(*target)


def append_events(events: DataFrame, path: str, files: dict | None = None, keys: Sequence[str] = ("event_id", "event_ts")) -> None:
    """Insert, ignoring keys already stored; the first of several copies in the batch wins.

    A copy of an event that carries its time has the same time, so only stored files whose days and times
    overlap the batch are read, and of these only the key columns. Where `time_given` is false the time is
    that of arrival and moves with each delivery: such events are matched by identifier against the stored events
    without a time of their own. Rows are sorted inside each file, so filters on the application skip row groups.
    """
    spark = events.sparkSession
    files = files_per_value(events, "event_date") if files is None else files
    if not files:
        return
    dated = "time_given" not in events.columns
    timed = storable(events) if dated else storable(events).where("time_given")
    fresh = [first_per_key(timed, list(keys), ["emitted_at"])]
    if not dated:
        fresh.append(first_per_key(storable(events).where("NOT time_given"), ["event_id"], ["event_ts", "emitted_at"]))
    if exists(spark, path):
        stored = spark.read.parquet(path)
        first, last = events.agg(F.min("event_ts"), F.max("event_ts")).first()
        overlap = stored.where(F.col("event_date").between(first.date(), last.date()) & F.col("event_ts").between(first, last))
        if len(files) <= MAX_LISTED_DAYS:  # else the range of days prunes well enough
            overlap = overlap.where(F.col("event_date").isin(list(files)))
        fresh[0] = not_yet_stored(fresh[0], overlap, list(keys))
        if not dated:
            fresh[1] = not_yet_stored(fresh[1], stored.where("NOT time_given"), ["event_id"])
    batch = fresh[0] if dated else fresh[0].unionByName(fresh[1])
    (laid_out(batch, "event_date", files).sortWithinPartitions("event_date", "application_id", "event_ts")
     .write.mode("append").options(**BLOOM).partitionBy("event_month", "event_date").parquet(path))


def stored_batch(spark: SparkSession, path: str, batch_id: int, days: Sequence) -> DataFrame:
    """What one batch left in the event table, with its payload as a map again."""
    rows = spark.read.parquet(path).where(F.col("ingest_batch") == batch_id)
    if len(days) <= MAX_LISTED_DAYS:
        rows = rows.where(F.col("event_date").isin(list(days)))
    return with_payload(rows)


def with_payload(stored: DataFrame) -> DataFrame:
    return stored.withColumn("payload", F.try_parse_json("payload").try_cast("map<string,variant>"))


def backfill_domain_tables(spark: SparkSession, events_path: str, root: str) -> None:
    """All domain tables anew from the stored events."""
    write_domain_tables(with_payload(spark.read.parquet(events_path)), root, 0, {})


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """A micro-batch in its own directory: a retried batch replaces itself."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch={batch_id}")


def write_domain_tables(events: DataFrame, root: str, batch_id: int, files: dict) -> None:
    """One filtered projection per domain table from the same (cached) batch."""
    for name, df in domain_tables(events).items():
        dated = df.withColumn("event_date", F.col("event_ts").cast("date"))
        write_batch(laid_out(dated, "event_date", files), f"{root}/{name}", batch_id, ["event_date"])


def recompute_hours(hours: DataFrame, stored_events: DataFrame, rollup: Callable[[DataFrame], DataFrame], path: str,
                    version: int) -> None:
    """Rebuild these hours from all stored events of them, as a new version of their rollup rows.

    The days prune partitions, the hours are matched by a join with the short list of hours. A
    repeated rebuild replaces its own version; `latest_rows` reads the newest one of each row.
    """
    days = [r[0] for r in hours.select(F.col("hour").cast("date")).distinct().limit(MAX_LISTED_DAYS + 1).collect()]
    rows = stored_events if len(days) > MAX_LISTED_DAYS else stored_events.where(F.col("event_date").isin(days))
    rows = rows.withColumn("_h", F.date_trunc("hour", "event_ts").cast("timestamp_ntz"))
    touched = rows.join(small_side(hours.select(F.col("hour").alias("_h")).distinct()), "_h", "left_semi").drop("_h")
    write_batch(rollup(touched), path, version)


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current rows of a table written batch by batch: the last batch that wrote a key wins."""
    rows = spark.read.option("basePath", path).parquet(path)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), "batch").alias("_r"))
    return last.select(*keys, "_r.*").drop("batch")


def compact(spark: SparkSession, path: str, keys: Sequence[str], target: str) -> None:
    """Write only the current rows of a batch-by-batch table, as batch 0 of a new table."""
    write_batch(latest_rows(spark, path, keys), target, 0)


def expired_months(spark: SparkSession, path: str, today: date, keep_months: int = 3) -> list[str]:
    """Names of month partitions before the retention window, oldest first."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())
    months = today.year * 12 + today.month - 1 - keep_months
    cutoff = f"event_month={months // 12:04d}-{months % 12 + 1:02d}"
    return [n for n in names if n.startswith("event_month=") and n < cutoff]


def _content(df: DataFrame) -> str:
    """Count and digest of rows, whatever their order: equal for equal multisets of rows."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    low = lambda c: c.bitwiseAND(F.lit(0xFFFFFFFF))  # noqa: E731  sums of 32 bits cannot overflow
    n, x, a, b = df.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(h), F.lit(0)), F.coalesce(F.sum(low(h)), F.lit(0)),
                        F.coalesce(F.sum(low(F.shiftrightunsigned(h, 32))), F.lit(0))).first()
    return f"{n}-{x & (1 << 64) - 1:016x}-{a:x}-{b:x}"


def archive_and_drop(spark: SparkSession, path: str, archive: str, today: date, keep_months: int = 3,
                     step: Callable[[str], None] = lambda name: None) -> list[str]:
    """Move expired months to `{archive}/{month}/move={content}`; returns the names of those moved.

    A month leaves the table by one rename, is copied to a staging folder, compared with its copy by count and digest,
    published by a rename, and taken out of the way by a rename before it is deleted. A run that stops anywhere
    is taken up by the next one: nothing is lost, and as a copy is named by its content nothing is there twice.
    Late rows of a month that is gone are a move of their own. Renames must be atomic, as on HDFS or a local disk.
    `step` is told the name of each step before it is taken.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = hadoop(path).getFileSystem(conf)

    def move(old: str, new: str) -> None:
        fs.mkdirs(hadoop(new).getParent())
        if not fs.rename(hadoop(old), hadoop(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def inside(folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in fs.listStatus(hadoop(folder))) if fs.exists(hadoop(folder)) else []

    moving, dropping, done = f"{path}/_moving", f"{path}/_dropping", []
    left = [(name, run) for name in inside(moving) for run in inside(f"{moving}/{name}")]
    for name in expired_months(spark, path, today, keep_months):
        run = uuid.uuid4().hex
        step("take")
        move(f"{path}/{name}", f"{moving}/{name}/{run}")
        left.append((name, run))
    for name, run in left:
        source = f"{moving}/{name}/{run}"
        rows = spark.read.parquet(source)
        content = _content(rows)
        target, staged = f"{archive}/{name}/move={content}", f"{archive}/_staging/{name}/{run}"
        if not exists(spark, target):
            step("copy")
            rows.write.mode("overwrite").parquet(staged)
            step("compare")
            if _content(spark.read.schema(rows.schema).parquet(staged)) != content:
                raise OSError(f"the copy of {source} differs from it")
            step("publish")
            move(staged, target)
        step("set aside")
        move(source, f"{dropping}/{name}/{run}")
        done.append(name)
    step("delete")
    fs.delete(hadoop(dropping), True)
    return sorted(set(done))


def read_archived(spark: SparkSession, archive: str, pointers: DataFrame, pointer: str = "pointer") -> DataFrame:
    """The archived texts that pointers name: their rows with the `body`, null where nothing is stored."""
    bodies = spark.read.option("basePath", archive).parquet(archive).select(
        F.concat(F.lit(archive.rstrip("/") + "/"), "archive_key").alias(pointer), "body", "batch")
    last = bodies.groupBy(pointer).agg(F.max_by("body", "batch").alias("body"))
    return pointers.join(last, pointer, "left")


def export_incident(tables: dict[str, DataFrame], target: str) -> None:
    """One directory per incident with every table's rows."""
    for name, df in tables.items():
        storable(df).write.mode("overwrite").parquet(f"{target}/{name}")
