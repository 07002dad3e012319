"""Helpers the corpus operators share: tables in the shared folder, ASCII folding, safe names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

WHITE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are large rows: let Spark hand at most so many of them to Python at a time. A lower setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def ascii_lower(c: Column) -> Column:
    """A-Z only; other letters keep their case in every engine alike."""
    return F.translate(c, _UPPER, _LOWER)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder; what is put there goes when the session ends."""
    path = f"{shared_dir(spark).rstrip('/')}/spanlight-llm/{uuid.uuid4().hex}"
    fs, hadoop = _file_system(spark, path)
    fs.mkdirs(hadoop.getParent())
    fs.deleteOnExit(hadoop)
    return path


def written(df: DataFrame) -> DataFrame:
    """Write once to a Parquet table in the shared folder and read it back.

    Lineage ends there: a lost executor costs its running tasks only, a value that depends on the
    order of rows is fixed, and the size of the table is known to later joins. The folder goes when
    the session ends, or earlier by `dropped`.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables of `written` that nothing will read again."""
    for t in tables:
        fs, hadoop = _file_system(t.sparkSession, t._written_path)
        fs.delete(hadoop, True)


def input_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of the input; starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % n
