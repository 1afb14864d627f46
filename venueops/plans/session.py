"""Session settings the operators count on, and checkpoints that outlive executors."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where an aggregation reuses the join's partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # what a task reads, and so what its sorts and hash tables hold, is the same small piece however large the table
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # a side whose pieces all fit is hashed, so that the other, wider one is not sorted
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16MB",
    # stored steps are read a few times only, so that fewer bytes count for more than the time to pack them
    "spark.sql.parquet.compression.codec": "zstd",
    # and what they unpack to, not their size, decides on a broadcast
    "spark.sql.sources.fileCompressionFactor": "2",
}


def tuned(spark: SparkSession) -> SparkSession:
    """Applies the runtime settings; broadcast thresholds stay as the cluster has them."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back, its lineage cut.

    The table outlives lost executors, is read by column, and has a size the planner knows.
    """
    return written(df)[0]


def observed(df: DataFrame, **aggregates: Column) -> tuple[DataFrame, dict]:
    """As :func:`checkpointed`, with aggregates over its rows that the write itself computes."""
    watch = Observation()
    table = checkpointed(df.observe(watch, *[column.alias(name) for name, column in aggregates.items()]))
    return table, watch.get


def written(df: DataFrame, options: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """As :func:`checkpointed`, with the table's path for :func:`removed`; ``options`` are the writer's."""
    path = f"{checkpoint_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, *paths: str) -> None:
    """Deletes tables of :func:`written` that no later frame reads."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` or ``setCheckpointDir`` names it."""
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder
