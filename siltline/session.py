"""Session settings and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The JVM does not compile methods over 8000 bytes of bytecode; wide cleansing projections are then
    # better off split into smaller methods than fused into one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Groups that a task keeps in an object hash map before it sorts (see operators/folding.py).
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
}


def open_session(name: str = "siltline", **extra: str) -> SparkSession:
    """A session with the settings the operators expect; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the session names, else one beside its warehouse, which is shared too.

    On a cluster a warehouse on a local disk is not shared, so the folder must be named there.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not context.master.startswith("local") and (warehouse.startswith("file:") or ":/" not in warehouse):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share; the warehouse is on a local disk")
        named = f"{warehouse}-checkpoints"
    context.setCheckpointDir(named)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage once and read it back from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_aside(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: columns compressed and pruned,
    where a checkpoint holds serialized rows."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/aside-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
