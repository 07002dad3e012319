"""Exact dedup by content sort.

Normalised texts are sorted over the whole cluster: sampled splitters range-partition the rows, the
external sort of each task orders them by content, which places equal texts next to each other, and each
text is compared in full with its neighbour. A splitter is (first 64 characters, SHA-256, identifier), about
100 bytes, so the sample that the driver sees stays small however long the texts are, and a group that
fills more than one task is split by its identifiers. A task holds a range of these keys, so a group that goes
on in another task is that of its least or of its greatest key, wherever its content stands in the order of the
task. These two meet their neighbours at the seams by one row per task, which holds the digests of both.

Defined cases: a null text counts as empty; null identifiers sort last and are never preferred; of
fully repeated rows exactly one stays; texts of any length are compared whole, a very long one is moved and sorted as one
row; columns of any name are kept as they are; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from .common import WHITE, written

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


@F.arrow_udf(StructType().add("run", LongType()).add("first", BooleanType()))
def _runs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Number the runs of equal neighbours within one sorted task."""
    last, run = None, -1
    for texts in batches:
        n = len(texts)
        if not n:
            yield pa.StructArray.from_arrays([pa.array([], pa.int64()), pa.array([], pa.bool_())], ["run", "first"])
            continue
        head = pa.array([last is None or texts[0].as_py() != last])
        tail = pc.not_equal(texts[1:], texts[:-1]) if n > 1 else pa.array([], pa.bool_())
        first = pa.concat_arrays([head, tail])
        number = pc.add(pc.cumulative_sum(first.cast(pa.int64())), run)
        last, run = texts[n - 1].as_py(), number[n - 1].as_py()
        yield pa.StructArray.from_arrays([number, first], ["run", "first"])


def _sorted_runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(pid, run, first, prefix, sha, id, row) in content order within each task; `row` holds every column of the input."""
    norm = normalised(F.col("row")[text_col])
    keyed = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
             .select("row", F.col("row")[id_col].alias("id"), norm.alias("norm"))
             .select("row", "id", F.substring("norm", 1, PREFIX_CHARS).alias("prefix"),
                     F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha")))
    least_first = F.col("id").asc_nulls_last()
    # The text is normalised again behind the exchange, so that it travels once.
    placed = keyed.repartitionByRange(F.col("prefix"), F.col("sha"), least_first).withColumn("norm", norm)
    ordered = placed.sortWithinPartitions(F.col("norm"), least_first)
    return (ordered.withColumn("at", _runs(F.col("norm")))
            .select(F.spark_partition_id().alias("pid"), "at.run", "at.first", "prefix", "sha", "id", "row"))


def _seams(runs: DataFrame) -> DataFrame:
    """(pid, run, head_pid, head_run): of tasks whose group of the least key began in an earlier task that group's run, and the
    task and run in which it began; one row per task."""
    key = F.struct("prefix", "sha")
    ends = runs.groupBy("pid").agg(
        F.min_by(F.struct("sha", "run"), key).alias("head"), F.max_by(F.struct("sha", "run"), key).alias("tail"))
    by_task = Window.orderBy("pid")  # one row per shuffle partition, whatever the size of the data
    joined = F.coalesce(F.col("head.sha") == F.lag("tail.sha").over(by_task), F.lit(False))
    starts = F.when(~F.col("joined") | (F.col("tail.run") != F.col("head.run")), F.struct("pid", F.col("tail.run").alias("run")))
    return (ends.withColumn("joined", joined).withColumn("start", starts)
            .withColumn("open", F.last("start", ignorenulls=True).over(by_task.rowsBetween(Window.unboundedPreceding, -1)))
            .where("joined").select("pid", F.col("head.run").alias("run"), F.col("open.pid").alias("head_pid"), F.col("open.run").alias("head_run")))


def _continued(rows: DataFrame, seams: DataFrame) -> DataFrame:
    """`moved`: the row's run began in an earlier task, at (head_pid, head_run)."""
    # At most one row of 30 bytes per shuffle partition, whatever the size of the data.
    return rows.join(F.broadcast(seams), ["pid", "run"], "left").withColumn("moved", F.col("head_pid").isNotNull())


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(_sorted_runs(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")),
                                "doc_id", "text").drop("row"))
    seams = _seams(rows)
    # Rows are counted by run, runs by group, and the rows look up their run, so no key holds more than one task had.
    runs = _continued(rows.groupBy("pid", "run").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), seams)
    runs = runs.withColumns({"gp": F.when(F.col("moved"), F.col("head_pid")).otherwise(F.col("pid")),
                             "gr": F.when(F.col("moved"), F.col("head_run")).otherwise(F.col("run"))})
    groups = runs.groupBy("gp", "gr").agg(F.min("least").alias("keep_id"), F.sum("n").alias("group_size"))
    known = runs.select("pid", "run", "gp", "gr", "moved").join(groups, ["gp", "gr"]).drop("gp", "gr")
    return rows.join(known, ["pid", "run"]).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("first") & ~F.col("moved")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    firsts = written(_sorted_runs(docs, id_col, text_col).where("first"))
    return _continued(firsts, _seams(firsts)).where("NOT moved").select("row.*")
