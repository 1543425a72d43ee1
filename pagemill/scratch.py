"""Intermediate tables in storage that the driver and all executors share.

Lineage is cut by writing Parquet under the folder that the cluster names in
``spark.checkpoint.dir``.  A lost executor then costs a re-read, not a recomputation.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
#: By application, the folder used where the setting is unset.
_own: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder; a temporary one only where the setting is unset and Spark runs in one process."""
    root = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {KEY} to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        root = _own[app] = _own.get(app) or "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the reread table (same columns, no lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
