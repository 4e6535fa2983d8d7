"""Readers."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def load_source(spark: SparkSession, root: str, system: str, table: str, fmt: str = "parquet",
                layout: str = "{root}/{system}/{table}") -> DataFrame:
    """One table of one source system, found by the layout of the folder."""
    path = layout.format(root=root.rstrip("/"), system=system, table=table)
    return spark.read.format(fmt).load(path)


def register_views(frames: dict[str, DataFrame]) -> None:
    """Bind frames to temp views, so they can be used from SQL by ``system_table`` names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name.replace(".", "_"))


def load_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Small typed CSV with a header; rows that do not fit the schema are skipped.

    A row is judged by all its fields, whatever columns are asked for later: every field is
    read as text, and rows with too few or too many fields or a value that is not of its
    declared type go.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    texts = StructType([StructField(f.name, StringType()) for f in fields] + [StructField("__bad", StringType())])
    read = (
        spark.read.schema(texts)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "__bad")
        .csv(path)
    )
    fits = [F.col(f"`{f.name}`").isNull() | F.col(f"`{f.name}`").try_cast(f.dataType).isNotNull() for f in fields]
    return read.where(reduce(Column.__and__, fits, F.col("__bad").isNull())).select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields])


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files of each distinct first line; the files are read by tasks, a line each comes back."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("at"))
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    return {r["header"]: sorted(map(unquote, r["files"])) for r in first.groupBy("header").agg(F.collect_list("file").alias("files")).collect()}


def load_catalog_dir(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Catalog CSV files with differing columns as one frame of strings.

    ``paths`` is a folder or a list of files and folders. Files with the same header line
    are one scan, however many they are, and the scans are united by column name; columns a
    file does not have are NULL. ``_file`` and ``_row`` keep the original order addressable.
    A header is one line.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    found = _headers(spark, listed) if listed else {}
    if not found:
        raise ValueError("load_catalog_dir needs at least one file")
    frames = []
    for header, files in sorted(found.items()):
        names = next(csv.reader([header.removeprefix("\ufeff")]))
        schema = StructType([StructField(n, StringType()) for n in names])
        read = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        # a file is read by one task from its start, so ids rise within it
        frames.append(read.csv(files).withColumns({
            "_file": F.col("_metadata.file_path"), "_row": F.monotonically_increasing_id()}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def entity_descriptions(catalog: DataFrame, entity: str, description: str, *order: str) -> DataFrame:
    """First non-blank description per entity in the given order."""
    usable = catalog.where(F.col(entity).isNotNull() & (F.trim(F.col(description)) != ""))
    return usable.groupBy(entity).agg(
        F.min_by(F.col(description), F.struct(*order)).alias(description))
