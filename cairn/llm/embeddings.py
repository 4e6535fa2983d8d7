"""Embedding near-dedup: random-hyperplane signs in several tables, exact cosines, distributed components.

Equal vectors form a class, named by its smallest ``vec_id``; only class representatives are hashed. A table has ``bits``
hyperplanes, as many as keep buckets near ``BUCKET_ROWS`` rows on average (a billion vectors need under 300 tables), and the number of tables follows from the chance
``RECALL`` to meet in one of them at exactly the threshold. Rows of a bucket are compared exactly, in double precision, and
give a spanning forest; components of the forests are then compared once as a whole, which counts every link inside.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing and are kept;
vectors of different length do not link; a null ``vec_id`` links with nothing (its component is null, kept); rows that
repeat a ``vec_id`` share a node; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.graph import Forest, components, dealt_blocks, fixed_rows, whole_groups, with_groups
from cairn.llm.store import stored

THRESHOLD, RECALL = 0.9, 0.99999
#: rows of an average bucket; rows of a block of a bucket or, in parts of a group, at least and at most
BUCKET_ROWS, BLOCK_ROWS, GROUP_ROWS = 512, 2048, 32
SEED = 11


def valid_vector(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def table_plan(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for so many vectors."""
    bits = min(40, max(4, round(math.log2(max(rows, 1) / BUCKET_ROWS + 1))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def hyperplanes(size: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, bits * tables))


def hashed(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """``id, vector`` (doubles as bytes), ``buckets`` (one per table)."""
    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column(1)], int)
            for size in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == size))
                x = np.array(part.column(1).to_pylist(), np.float64)
                x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])  # by a power of two: squares of tiny or huge components stay doubles
                if size not in planes:
                    planes[size] = hyperplanes(size, bits, tables)
                bit = ((x @ planes[size]) > 0).reshape(len(x), tables, bits)
                code = bit @ (1 << np.arange(bits, dtype=np.int64))
                code += (np.arange(tables, dtype=np.int64) << bits)[None] + (size << 48)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(list(code), pa.list_(pa.int64()))],
                    ["id", "vector", "buckets"])

    return vectors.mapInArrow(signs, "id bigint, vector binary, buckets array<bigint>")


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    norms = np.sqrt((x * x).sum(1))[:, None] * np.sqrt((y * y).sum(1))[None]
    return x @ y.T >= threshold * norms


def near_dedup(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vec_id, embedding``."""
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding", (valid_vector(F.col("embedding")) & F.col("vec_id").isNotNull()).alias("_valid"))
    known = rows.where("_valid").select("vec_id", "embedding", F.xxhash64("embedding").alias("_h1"), F.xxhash64(F.lit(3), "embedding").alias("_h2"))
    classes = stored(known.groupBy("_h1", "_h2").agg(F.min("vec_id").alias("id"), F.count_distinct("vec_id").alias("weight"), F.count("*").alias("_rows")), "classes")
    distinct, total = classes.agg(F.count("*"), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    bits, tables = table_plan(distinct, threshold, recall)
    named = with_groups(known, classes, ["_h1", "_h2"], "_rows", total)
    heads = stored(hashed(named.where("vec_id = id").dropDuplicates(["id", "_h1", "_h2"]).select("id", "embedding"), bits, tables), "hashed")
    members = heads.select(F.explode("buckets").alias("bucket"), "id", F.lit(1).alias("weight"))
    payload = heads.select("id", "vector")

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches):
            ids, own, i, j = (table.column(c).to_numpy() for c in ("id", "own", "i", "j"))
            out: list[tuple[int, int]] = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                x = fixed_rows(table.column("vector").slice(a, b - a), "f8")
                found = np.triu(linked(x, x, threshold), 1)
                if i[a] != j[a]:
                    found &= own[a:b][:, None] != own[a:b][None]
                forest = Forest(b - a)
                for r in np.flatnonzero(found.any(1)).tolist():
                    forest.join(r, np.flatnonzero(found[r]))
                out += [(int(ids[a + p]), int(ids[a + q])) for p, q in forest.links]
            yield edge_batch(out)

    edges = dealt_blocks(members, payload, block_rows).mapInArrow(forests, "a bigint, b bigint")
    found = stored(components(edges), "components")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches):
            ids, own, weight, i, j = (table.column(c).to_numpy() for c in ("id", "own", "weight", "i", "j"))
            total = np.zeros(len(ids), np.int64)
            for a, b in zip(bounds[:-1], bounds[1:]):
                x = fixed_rows(table.column("vector").slice(a, b - a), "f8")
                near = linked(x, x, threshold) & (ids[a:b][:, None] != ids[a:b][None])
                if i[a] != j[a]:
                    near &= own[a:b][:, None] != own[a:b][None]
                total[a:b] = near @ weight[a:b]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["id", "links"])

    weighted = payload.join(classes.select("id", "weight"), "id")
    groups = found.select(F.col("component").alias("bucket"), "id", F.lit(1).alias("weight"))
    links = (dealt_blocks(groups, weighted, min(GROUP_ROWS, block_rows), block_rows)
             .mapInArrow(counts, "id bigint, links bigint").groupBy("id").agg(F.sum("links").alias("links")))
    per_class = classes.join(found, "id", "left").join(links, "id", "left").select(
        "_h1", "_h2", "_rows", F.coalesce("component", "id").alias("_component"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("_links"))
    judged = with_groups(known.select("vec_id", "_h1", "_h2"), per_class, ["_h1", "_h2"], "_rows", total).select("vec_id", "_links", "_component")
    rest = rows.where("not _valid").select("vec_id", F.lit(0).cast("long").alias("_links"), F.col("vec_id").alias("_component"))
    return judged.unionByName(rest).select(
        "vec_id", F.col("_links").alias("n_links"), F.col("_component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("_component"), F.lit(True)).alias("kept"))


def edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"])
