"""Session defaults and the place where jobs may write intermediate tables."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs are planned for.  None of them depends on the size
# of the data: adaptive execution sizes, splits and coalesces the partitions.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the aggregation after the join then needs a
    # shuffle of its own; its partial step runs before that shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    On a cluster it must be named.  A local session, whose driver and executors are
    one process, gets one of its own where the setting is unset; it goes when Python ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    own = tempfile.TemporaryDirectory(prefix="mercato-", ignore_cleanup_errors=True)
    atexit.register(own.cleanup)
    spark.conf.set("spark.checkpoint.dir", own.name)
    return own.name


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows written below the shared folder and read back: computed once, whatever the plan does with them.

    For results that two evaluations may give differently, such as approximate quantiles, whose states merge in
    the order in which they arrive.
    """
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
