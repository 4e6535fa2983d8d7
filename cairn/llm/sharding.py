"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual`` points of the ring; a key belongs to the arc that ends in the next point clockwise. No shard
takes more rows than its capacity (all capacities together are the number of rows, and differ by one at most): what
an arc has beyond the room left in its shard goes on clockwise to the next shard with room, in the keys' ring order.
Only rows per arc decide this, so the walk over the arcs works on ``shards x virtual`` counts, whatever the number of
rows; each row then finds its shard from its rank in its arc, and its slot from the rank and the arc's base.

Law ``rows``: counts are at most one apart. With one shard more, ring points of the others stay, so a row moves only
when the new points or the smaller capacities ask for it.

Defined results: null text has no bytes; with a null ``doc_id`` the text is the key; rows that repeat a ``doc_id`` are
separate rows (ranked by text); an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS, VIRTUAL, RING = 40, 512, 1 << 32
ROW_BYTES = 16


def ring_points(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(point, shard) in ring order; a shard's points do not depend on the number of shards."""
    def point(shard: int, i: int) -> int:
        return int.from_bytes(hashlib.md5(f"{shard}/{i}".encode()).digest()[:4], "big")

    return sorted({point(s, i): s for s in reversed(range(shards)) for i in range(virtual)}.items())


def fill_ring(points: list[tuple[int, int]], counts: dict[int, int], shards: int) -> list[tuple[int, int, int, int]]:
    """``(arc, first rank, shard, slot of the first rank)`` for every run of ranks of an arc that share a shard."""
    total = sum(counts.values())
    room = {s: total // shards + (s < total % shards) for s in range(shards)}
    used: dict[int, int] = defaultdict(int)
    runs, over = [], []

    def give(arc: int, rank: int, shard: int, n: int) -> None:
        runs.append((arc, rank, shard, used[shard]))
        used[shard] += n
        room[shard] -= n

    for arc, (_, shard) in enumerate(points):
        n = min(counts.get(arc, 0), room[shard])
        if n:
            give(arc, 0, shard, n)
        if counts.get(arc, 0) > n:
            over.append((arc, n, counts[arc] - n))
    for arc, rank, left in over:
        step = arc
        while left:
            step = (step + 1) % len(points)
            shard = points[step][1]
            n = min(left, room[shard])
            if n:
                give(arc, rank, shard, n)
                rank, left = rank + n, left - n
    return runs


def arc_lookup(points: list[int]):
    """A function from ring places to arcs: the first point at or after a place, beyond the last one the first."""
    @F.pandas_udf("int")
    def arc(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(points, dtype=np.int64), place.to_numpy()) % len(points)).astype("int32")

    return arc


def assign_shards(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot`` for every row."""
    points = ring_points(shards, virtual)
    arc = arc_lookup([p for p, _ in points])
    text = F.coalesce("text", F.lit(""))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.xxhash64("doc_id"))
    rows = docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.pmod(key, F.lit(RING)).alias("_place"))
    keys = docs.select(F.pmod(key, F.lit(RING)).alias("_place"))
    counts = {r["_arc"]: r["count"] for r in keys.groupBy(arc("_place").alias("_arc")).count().collect()}
    runs = defaultdict(list)
    for at, *run in sorted(fill_ring(points, counts, shards)):
        runs[at].append(tuple(run))
    table = docs.sparkSession.createDataFrame(sorted(runs.items()), "_arc int, _runs array<struct<rank:bigint,shard:int,slot:bigint>>")
    order = Window.partitionBy("_arc").orderBy("_place", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("_arc", arc("_place")).withColumn("_rank", (F.row_number().over(order) - 1).cast("long"))
    run = F.element_at(F.filter("_runs", lambda r: r["rank"] <= F.col("_rank")), -1)
    return ranked.join(F.broadcast(table), "_arc").withColumn("_run", run).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_run.shard").alias("shard"),
        (F.col("_run.slot") + F.col("_rank") - F.col("_run.rank")).alias("slot"))
