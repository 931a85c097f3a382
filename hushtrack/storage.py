"""Intermediate tables in the shared folder of the cluster.

A result that is needed more than once is written there and read back. That cuts the lineage, is
computed once, and outlives the executors that computed it.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def require_utc(spark: SparkSession) -> None:
    """Days, months and years of the tables are UTC, and Spark takes them in the session's zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


@lru_cache(maxsize=None)
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="spark-hushtrack-")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir`` or given to the context; a temporary one only in local mode.

    All executors share it. That is taken at its word, for a ``file:`` folder too: whether it is a mount
    that all machines have cannot be told by its scheme.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
