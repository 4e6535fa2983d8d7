"""SparkSession defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that carry meaning (time zone, ANSI errors) or let Spark re-plan at run time.
# The partition count is only the starting point: AQE coalesces it, so a cluster job
# should raise it to roughly (shuffled bytes / 128 MB).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "cairn", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder of this application for written intermediate tables.

    It lies under the cluster's checkpoint folder (``spark.checkpoint.dir``) or, where the
    session names none, under the warehouse: both are storage that all executors reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"
