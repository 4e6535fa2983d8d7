"""What tables exist and what they look like."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def describe(df: DataFrame) -> DataFrame:
    """Column name, type and whether it may be NULL, in column order."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean")


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """Tables and views of a schema with their column counts."""
    rows = [
        (t.namespace[0] if t.namespace else "", t.name, t.tableType,
         len(spark.catalog.listColumns(t.name if t.isTemporary else f"{t.namespace[0]}.{t.name}")))
        for t in spark.catalog.listTables(schema)
    ]
    return spark.createDataFrame(
        sorted(rows), "table_schema string, table_name string, table_type string, column_count int")


def table_overview(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count of every table, counted on the full data in one job."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("column_count"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def sample(df: DataFrame, n: int, order_by: Sequence[Column] | None = None) -> DataFrame:
    """``n`` rows; with ``order_by`` always the same ones."""
    if n < 1:
        raise ValueError("sample needs n >= 1")
    return (df.orderBy(*order_by) if order_by else df).limit(n)
