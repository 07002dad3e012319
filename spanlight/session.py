"""Session set-up and the few cluster-aware helpers every operator shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is only broadcast when the optimizer's size estimate is below this many bytes.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def build_session(app_name: str = "spanlight", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; reads statistics only, starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark a dimension for broadcast when its estimated size is proven below the limit.

    Above the limit the DataFrame is returned as it is, so the join becomes a shuffled
    equi-join that adaptive execution may split by skew.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit_bytes else df


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's spark.checkpoint.dir.

    Only a local-mode session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="spanlight-checkpoints-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns behind a generator, so that later filters and projections refer to the
    value. Plain aliases would be inlined, and a parsed document or a rule match evaluated again,
    wherever they are used.
    """
    packed = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select("*", packed.alias("_once")).select(*kept, *[F.col(f"_once.{n}").alias(n) for n in columns])
