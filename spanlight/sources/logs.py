"""Container log lines: runtime prefix, JSON body, secrets removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import computed_once

# Line format and the keys that never leave the node.
LINE = r"^([^ ]+) (stdout|stderr) ([^ ]*) (.*)$"
SECRET_KEYS = ["authorization", "api_key", "password"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse(lines: DataFrame) -> DataFrame:
    """Lines of the format as time, stream, tag and a field map without secret keys.

    A body that is no JSON object stays readable under `log`; lines of another format are dropped,
    as the collector does. Other columns of the lines (a file name, an offset) are carried along.
    """
    made = ("value", "time", "stream", "logtag", "log", "fields", "event_ts")
    hit = lines.where(F.col("value").rlike(LINE)).select(
        *[c for c in lines.columns if c not in made],
        F.regexp_extract("value", LINE, 1).alias("time"), F.regexp_extract("value", LINE, 2).alias("stream"),
        F.regexp_extract("value", LINE, 3).alias("logtag"), F.regexp_extract("value", LINE, 4).alias("log"))
    parsed = computed_once(hit, _doc=F.try_parse_json("log"))
    fields = F.expr("try_variant_get(_doc, '$', 'map<string,variant>')")
    safe = F.map_filter(fields, lambda k, _: ~k.isin(SECRET_KEYS))
    return parsed.withColumn("fields", safe).withColumn(
        "log", F.when(F.col("fields").isNull(), F.col("log"))
    ).withColumn("event_ts", F.try_to_timestamp("time").cast("timestamp_ntz")).drop("_doc")


def field(name: str, sql_type: str = "string"):
    return F.expr(f"try_variant_get(fields['{name}'], '$', '{sql_type}')")
