"""Audits over a lineage graph.

``nodes``: (unique_id, name, resource_type); ``edges``: (parent, child, distance). Only
direct edges count. Edges are filtered and reduced before they meet the nodes. ``closure``
derives all edges with their distances from the direct ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.joins import orphans
from cairn.sources.sinks import materialize


def closure(direct: DataFrame) -> DataFrame:
    """``parent, child, distance, path`` for every pair of nodes linked over direct edges ``parent, child``.

    The distance is the shortest one, the path the smallest of the shortest ones, both ends included. A node on a cycle
    is its own ancestor at the length of its shortest cycle. Edges with a NULL end are left out, repeated ones count once.

    Every round doubles the reach: pairs at exactly the reach of the last round are continued by all pairs known so far,
    so the number of rounds grows with the logarithm of the longest distance. Rounds are stored in the shared folder.
    """
    pair = ["parent", "child"]
    known = direct.where(F.col("parent").isNotNull() & F.col("child").isNotNull()).select(
        *pair, F.lit(1).alias("distance"), F.array(*pair).alias("path")).distinct()
    reach, known = 1, materialize(known, "lineage", "table")
    while not (far := known.where(F.col("distance") == reach)).isEmpty():
        begin = far.select("parent", F.col("child").alias("middle"), F.col("path").alias("begun"))
        rest = known.select(F.col("parent").alias("middle"), "child", "distance", F.slice("path", 2, F.size("path") - 1).alias("rest"))
        way = F.struct((F.col("distance") + reach).alias("distance"), F.concat("begun", "rest").alias("path"))
        longer = begin.join(rest, "middle").select(*pair, way.alias("way")).groupBy(*pair).agg(F.min("way").alias("way"))
        fresh = longer.join(known.select(*pair), pair, "left_anti").select(*pair, "way.*")
        known = materialize(known.unionByName(fresh), "lineage", "table")
        reach *= 2
    return known


def _direct(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("distance") == 1)


def _models(nodes: DataFrame, *prefixes: str) -> DataFrame:
    name = F.col("name")
    test = name.startswith(prefixes[0])
    for p in prefixes[1:]:
        test = test | name.startswith(p)
    return nodes.where((F.col("resource_type") == "model") & test).select(
        "unique_id", F.col("name").alias("resource_name"))


def _parent_model(layer: str) -> Column:
    return F.col("parent").contains("model.") & F.col("parent").contains(f".{layer}_")


def facts_without_integration(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Facts and dimensions that read no integration model."""
    return orphans(_models(nodes, "fct_", "dim_"), _direct(edges), {"unique_id": "child"}, _parent_model("int"))


def marts_on_staging(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Facts and dimensions that read staging directly, one row per such edge."""
    bad = _direct(edges).where(_parent_model("stg")).select(F.col("child").alias("unique_id"))
    return _models(nodes, "fct_", "dim_").join(bad, "unique_id")


def staging_off_source(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Staging models with a parent that is neither a source nor a base model."""
    good = F.col("parent").contains("source.") | _parent_model("base")
    bad = _direct(edges).where(~good).select(F.col("child").alias("unique_id")).distinct()
    return _models(nodes, "stg_").distinct().join(bad, "unique_id")
