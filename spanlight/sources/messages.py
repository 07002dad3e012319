"""Raw, processed and dead-letter message streams (Kafka, or files with the same columns)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPICS = {"raw": "ai-obs-events-raw", "processed": "ai-obs-events-processed", "dead": "ai-obs-dead-letter"}
MESSAGE_DDL = "key string, value string, headers array<struct<key:string,value:binary>>"


def read_kafka(spark: SparkSession, servers: str, topic: str = TOPICS["raw"], max_offsets: int = 2_000_000,
               streaming: bool = True, **options: str) -> DataFrame:
    """A topic from its earliest offset, with headers. Needs the Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    settings = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest",
        "includeHeaders": "true", "failOnDataLoss": "true", **options,
    }
    if streaming:
        settings["maxOffsetsPerTrigger"] = str(max_offsets)
    return reader.format("kafka").options(**settings).load()


def read_files(spark: SparkSession, path: str, streaming: bool = True, files_per_trigger: int = 1000) -> DataFrame:
    """Message files with the Kafka columns key, value, headers."""
    if streaming:
        return spark.readStream.schema(MESSAGE_DDL).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return spark.read.schema(MESSAGE_DDL).parquet(path)


def kafka_sink(servers: str, topic: str = TOPICS["processed"], **options: str) -> Callable[[DataFrame, int], None]:
    """A sink for the streaming jobs: each batch as messages, keyed, so that a key keeps its order."""
    def send(rows: DataFrame, batch_id: int) -> None:
        rows.write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic, **options}).save()

    return send


def from_lines(lines: DataFrame) -> DataFrame:
    """Text lines as messages."""
    empty = F.array().cast("array<struct<key:string,value:binary>>")
    return lines.select(F.lit(None).cast("string").alias("key"), "value", empty.alias("headers"))
