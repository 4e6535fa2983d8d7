"""Freshness of a table kept up by a stream, instead of a scan of the table per check.

Loads announce the times of their rows as files in a folder, one folder and one stream per table. The stream counts them
per window of time; a watermark closes windows, so the state holds open windows only. Closed windows are appended to a
folder, exactly once; open ones are read from the state store. Both lie on shared storage, so a run goes on where the last
one ended, whichever machines are lost.

A row is late when its window has been closed before it arrives: it is in no window. The watermark never passes the newest
row of the table, so a late row is never the newest one and the status equals the batch check's, whatever the order of
arrival. Rows without a time are in no window. Windows of days start at midnight UTC. A table without a row has status
``error``, as in the batch check.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.quality import freshness

ARRIVALS = "loaded_at timestamp_ntz"
WINDOWS = "window_start timestamp_ntz, n_rows bigint, loaded_at timestamp_ntz"
NOTHING_YET = "STDS_COMMITTED_BATCH_UNAVAILABLE"


def announce(df: DataFrame, loaded_at: str, folder: str) -> None:
    """Add the times of loaded rows to a table's folder."""
    df.select(F.col(loaded_at).cast("timestamp_ntz").alias("loaded_at")).write.mode("append").parquet(folder)


def read_arrivals(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The announced times as a stream, oldest files first; all new files are one batch unless a number is given."""
    read = spark.readStream.schema(ARRIVALS)
    return (read.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else read).parquet(folder)


def windows(arrivals: DataFrame, width: str, delay: str) -> DataFrame:
    """Rows and newest time per window; counts combine in every task before the shuffle."""
    # watermarks are kept on instants
    timed = arrivals.withColumn("loaded_at", F.col("loaded_at").cast("timestamp")).withWatermark("loaded_at", delay)
    return (timed.groupBy(F.window("loaded_at", width).alias("span")).agg(F.count("*").alias("n_rows"), F.max("loaded_at").alias("newest"))
            .select(F.col("span.start").cast("timestamp_ntz").alias("window_start"), "n_rows", F.col("newest").cast("timestamp_ntz").alias("loaded_at")))


def watch(arrivals: DataFrame, root: str, width: str = "1 day", delay: str = "1 day") -> None:
    """Take in all that has arrived since the last call, then stop. ``root`` is the table's own folder on shared storage."""
    (windows(arrivals, width, delay).writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
     .option("checkpointLocation", f"{root}/progress").option("path", f"{root}/closed").start().awaitTermination())


def _open(spark: SparkSession, root: str) -> DataFrame:
    try:
        state = spark.read.format("statestore").load(f"{root}/progress")
    except PySparkException as error:
        if error.getCondition() != NOTHING_YET:
            raise
        return spark.createDataFrame([], WINDOWS)
    span, = state.schema["key"].dataType.names
    n_rows, newest = state.schema["value"].dataType.names
    return state.select(
        F.col("key")[span]["start"].cast("timestamp_ntz").alias("window_start"), F.col("value")[n_rows].alias("n_rows"),
        F.col("value")[newest].cast("timestamp_ntz").alias("loaded_at"))


def arrived(spark: SparkSession, root: str) -> DataFrame:
    """All windows so far, closed and open: window_start, n_rows, loaded_at (the newest in the window)."""
    return spark.read.schema(WINDOWS).parquet(f"{root}/closed").unionByName(_open(spark, root))


def streamed_freshness(spark: SparkSession, tables: Mapping[str, tuple[str, float, float]], as_of: Column) -> DataFrame:
    """The batch check's rows, read off the windows; ``tables`` maps a table to its root, warn and error hours."""
    return freshness({name: (arrived(spark, root), "loaded_at", warn, error) for name, (root, warn, error) in tables.items()}, as_of)
