"""Sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from cairn.session import shared_dir


def materialize(df: DataFrame, name: str, kind: str = "view", root: str | None = None) -> DataFrame:
    """Keep a model lazy (``view``) or store it (``table``) and read it back.

    Stored models go under ``root`` (default: the cluster's shared folder) as Parquet,
    which also cuts the lineage: a lost executor re-reads files, not the whole plan. Every
    call has a path of its own, so a frame may be stored from itself and frames returned
    earlier stay readable.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table":
        raise ValueError("kind is 'view' or 'table'")
    path = f"{(root or shared_dir(df.sparkSession)).rstrip('/')}/{name}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def store_clustered(df: DataFrame, name: str, keys: Sequence[str], buckets: int, root: str | None = None) -> DataFrame:
    """Store a model hashed by ``keys`` into ``buckets`` and sorted in them, and read it back as a table.

    Joins and aggregates on the keys read it without an exchange, also with another model stored with the same number of
    buckets. The files lie in the shared folder; every call has a path and a table name of its own.
    """
    run = uuid.uuid4().hex
    path, table = f"{(root or shared_dir(df.sparkSession)).rstrip('/')}/{name}/{run}", f"{name}_{run}"
    # one file per bucket
    df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def store_partitions(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Store a model in one folder per value of ``by``; only the folders that ``df`` has rows for are replaced."""
    (df.repartition(*by).write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))
    return df.sparkSession.read.parquet(path)


def export(models: dict[str, DataFrame], root: str, fmt: str = "both",
           select: Sequence[str] | None = None) -> list[str]:
    """Write models as CSV, Parquet or both; returns the written paths.

    An unknown format or model name is an error. Each model is written by all tasks in
    parallel, one file per partition.
    """
    if fmt not in ("csv", "parquet", "both"):
        raise ValueError("fmt is 'csv', 'parquet' or 'both'")
    unknown = sorted(set(select or ()) - set(models))
    if unknown:
        raise KeyError(f"no such model: {', '.join(unknown)}")
    written = []
    for name, df in models.items():
        if select and name not in select:
            continue
        for kind in ("csv", "parquet") if fmt == "both" else (fmt,):
            path = f"{root.rstrip('/')}/{kind}/{name}"
            writer = df.write.mode("overwrite")
            if kind == "csv":
                writer.option("header", True).csv(path)
            else:
                writer.parquet(path)
            written.append(path)
    return written
