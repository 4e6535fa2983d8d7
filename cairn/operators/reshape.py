"""Unpivot, unions of conformed sources, date spines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def unpivot_groups(df: DataFrame, keep: Sequence[str], label: str,
                   groups: Mapping[object, Mapping[str, str]]) -> DataFrame:
    """One row per group of wide columns, in a single scan.

    ``groups`` maps the label value to ``{output name: source column}``.
    """
    entries = [
        F.struct(F.lit(value).alias(label), *[F.col(src).alias(out) for out, src in cols.items()])
        for value, cols in groups.items()
    ]
    return df.select(*keep, F.explode(F.array(*entries)).alias("__e")).select(*keep, "__e.*")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of a schema in its order, cast; missing ones as typed NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def union_conformed(frames: Sequence[DataFrame], schema: StructType | None = None) -> DataFrame:
    """All rows of all frames; duplicates stay. With a schema every frame is conformed first."""
    if schema is not None:
        frames = [conform(f, schema) for f in frames]
        return reduce(DataFrame.unionAll, frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_union(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys of all frames. Each side is reduced first, so the shuffle carries keys only."""
    return union_conformed([f.select(*keys) for f in frames]).distinct()


def date_spine(spark: SparkSession, start: str, end_exclusive: str, name: str = "date_day"
               ) -> DataFrame:
    """One row per day from ``start`` up to but not including ``end_exclusive``."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("lo"), F.lit(end_exclusive).cast("date").alias("hi"))
    return explode_days(bounds, F.col("lo"), F.date_sub("hi", 1), name).select(name)


def spine_of(df: DataFrame, col: str, name: str = "date_day") -> DataFrame:
    """One row per day between the first and last date of a column."""
    bounds = df.agg(F.min(col).cast("date").alias("lo"), F.max(col).cast("date").alias("hi"))
    return explode_days(bounds.where(F.col("lo").isNotNull()), F.col("lo"), F.col("hi"), name
                        ).select(name)


def explode_days(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """Each row once per day from ``first`` to ``last``; none where ``last < first``."""
    days = F.when(last >= first, F.sequence(first, last))
    return df.withColumn(name, F.explode(days))
