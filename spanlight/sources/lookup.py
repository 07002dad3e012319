"""Secondary index of an event table: which files hold a correlation id.

The table is laid out by day, so a look-up by correlation id would read all of it. The index has a row per (identifier
hash, file), in folders by hash, sorted by hash: a look-up reads a few row groups of it, then only the files named
there, whose row groups are skipped by Parquet bloom filters. Files are indexed once, after they were written,
late ones like any other; files that are not indexed yet are always read, so a look-up finds what a full scan finds.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import small_side
from .tables import exists

FOLDERS = 64
# With more files than this a look-up is no longer one; the whole table is read instead.
MAX_FILES = 20_000


def _hash(c: Column) -> Column:
    return F.xxhash64(c.cast("string"))


def _folder(h: Column) -> Column:
    return F.pmod(h, F.lit(FOLDERS)).cast("int")


def _files(spark: SparkSession, events_path: str, days: Sequence | None = None) -> set[str]:
    """Names of the table's data files (of these days); a listing, nothing is read."""
    rows = spark.read.parquet(events_path)
    if days is None:
        return set(rows.inputFiles())
    names = [f"/event_date={d}/" for d in days]
    return {f for f in rows.inputFiles() if any(n in f for n in names)}


def _indexed(spark: SparkSession, index_path: str) -> set[str]:
    if not exists(spark, f"{index_path}/files"):
        return set()
    return {r.file for r in spark.read.parquet(f"{index_path}/files").collect()}


def update(spark: SparkSession, events_path: str, index_path: str, key: str = "correlation_id", days: Sequence | None = None) -> int:
    """Index the files that are not indexed yet (of these days, such as those of a batch); returns how many.

    The entries are written before the list of files they cover: an update that stops in between is made again,
    and entries that are there twice do no harm.
    """
    new = sorted(_files(spark, events_path, days) - _indexed(spark, index_path))
    if not new:
        return 0
    run = uuid.uuid4().hex
    rows = spark.read.option("basePath", events_path).parquet(*new)
    entries = rows.where(F.col(key).isNotNull()).select(_hash(F.col(key)).alias("h"), F.input_file_name().alias("file")).distinct()
    placed = entries.withColumn("folder", _folder(F.col("h"))).repartition("folder").sortWithinPartitions("folder", "h")
    placed.write.mode("append").partitionBy("folder").parquet(f"{index_path}/entries")
    spark.createDataFrame([(f, run) for f in new], "file string, run string").coalesce(1).write.mode("append").parquet(f"{index_path}/files")
    return len(new)


def files_with(spark: SparkSession, events_path: str, index_path: str, ids: DataFrame) -> list[str] | None:
    """The files that may hold any of the identifiers (one column), or None for all."""
    there, indexed = _files(spark, events_path), _indexed(spark, index_path)
    fresh = there - indexed
    found: set[str] = set()
    if indexed:
        wanted = ids.select(_hash(F.col(ids.columns[0])).alias("h")).distinct().withColumn("folder", _folder(F.col("h")))
        entries = spark.read.parquet(f"{index_path}/entries")
        few = [r.h for r in wanted.select("h").limit(1001).collect()]
        if len(few) <= 1000:  # as literals they prune folders and row groups
            folders = sorted({h % FOLDERS for h in few})
            hits = entries.where(F.col("folder").isin(folders) & F.col("h").isin(few))
        else:
            hits = entries.join(small_side(wanted), ["folder", "h"], "left_semi")
        names = [r.file for r in hits.select("file").distinct().limit(MAX_FILES + 1).collect()]
        if len(names) > MAX_FILES:
            return None
        found = set(names)
    files = sorted((found & there) | fresh)  # a file of the index may be gone by retention
    return None if len(files) > MAX_FILES else files


def events_of(spark: SparkSession, events_path: str, index_path: str, ids: DataFrame | Sequence[str], key: str = "correlation_id") -> DataFrame:
    """All stored events of these correlation ids, read from the files that may hold them."""
    if not isinstance(ids, DataFrame):
        ids = spark.createDataFrame([(i,) for i in ids], f"{key} string")
    wanted = ids.select(F.col(ids.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct()
    files = files_with(spark, events_path, index_path, wanted)
    rows = spark.read.parquet(events_path)
    if files is not None:
        rows = spark.read.schema(rows.schema).option("basePath", events_path).parquet(*files) if files else rows.where("false")
    few = [r[0] for r in wanted.limit(1001).collect()]
    if len(few) <= 1000:  # pushed down to the bloom filters
        return rows.where(F.col(key).isin(few))
    return rows.join(small_side(wanted), key, "left_semi")
