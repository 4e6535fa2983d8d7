"""Stored intermediate tables on storage that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; only where it is unset (local tests) one is made."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back: cuts lineage and survives lost executors."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_slots(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
