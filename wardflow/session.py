"""One place that builds the SparkSession every job shares."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # An upper limit: smaller inputs are still split to at least one task per core. At 100 TB it
    # means 200,000 scan tasks instead of 800,000, and shuffle blocks four times as large.
    "spark.sql.files.maxPartitionBytes": "512m",
    # Shuffles start this wide, and adaptive execution merges what is small: a setting for the
    # largest stage, set by the deployment (40,000 for 100 TB are 2.5 GB each), not by the data.
    "spark.sql.shuffle.partitions": "2000",
    # Recording the calling line of every column expression doubles the time to build a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

def build_session(app_name: str, settings: dict[str, str] | None = None,
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Create or reuse the session; ``settings`` wins over the defaults above.

    Object-store endpoints and credentials belong in ``settings`` or in the cluster's own
    configuration; none are kept here. A checkpoint folder named by the cluster is kept;
    ``checkpoint_dir`` fills in only where none is set.
    """
    builder = SparkSession.builder.appName(app_name)
    if "SPARK_MASTER" in os.environ:
        builder = builder.master(os.environ["SPARK_MASTER"])
    for key, value in {**BASE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    if checkpoint_dir and not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local one only where the session is local."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wardflow-shared-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")
