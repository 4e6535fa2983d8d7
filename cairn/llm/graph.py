"""Shared parts of the pair operators: buckets compared in bounded blocks, and distributed connected components.

Members of buckets are sorted over range partitions of (bucket, hash of id), so a hot bucket is cut by position and no key fills a
task. Buckets too large for one block become several, and every pair of blocks is compared, so nothing is lost and no task
holds more than two blocks. Tasks give a spanning forest of the links they find instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.store import shuffle_slots, stored


#: a key with more than this share of the rows is hot; there are fewer such keys than its inverse
HOT_SHARE = 1 / 1000


def with_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` joined to ``groups``, one row per key, whose column ``size`` counts the key's rows out of ``total``.

    Hot keys would fill one task each, so their rows are dealt into parts of a ``HOT_SHARE`` of all rows, and their group is
    repeated per part. There are fewer than ``1 / HOT_SHARE`` such keys; their numbers of parts are broadcast.
    """
    parted = groups.withColumn("_parts", F.greatest(F.ceil(F.col(size) / F.lit(max(HOT_SHARE * total, 1e-9))), F.lit(1)).cast("long"))
    often = F.broadcast(parted.where("_parts > 1").select(*keys, "_parts"))
    dealt = rows.withColumn("_hash", F.xxhash64(*rows.columns)).join(often, keys, "left").withColumn(
        "_part", F.pmod("_hash", F.coalesce("_parts", F.lit(1)))).drop("_hash", "_parts")
    each = parted.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
    return dealt.join(each, [*keys, "_part"]).drop("_part")


#: a bucket is compared by at least the blocks in so many parts before its blocks grow beyond the least size
SPREAD = 32


def runs_in_place(members: DataFrame, least: int) -> DataFrame:
    """``bucket, id, weight, part, at, wide``: members in sorted range partitions, without buckets of one row.

    ``at`` is the weight before a row in its bucket's run in this partition. A bucket is ``wide`` if its run touches a border of
    the partition (it may go on there) or weighs more than ``least``.
    """
    def runs(table: pa.Table, bounds: np.ndarray, starts: bool, ends: bool, part: int) -> pa.RecordBatch:
        weight, rows = table.column("weight").to_numpy(), np.diff(bounds)
        before = np.cumsum(weight) - weight
        wide = np.add.reduceat(weight, bounds[:-1]) > least
        wide[0] |= starts
        wide[-1] |= ends
        keep = pa.array(np.repeat((rows > 1) | wide, rows))
        columns = [table.column("bucket"), table.column("id"), table.column("weight"), pa.array(np.full(table.num_rows, part)),
                   pa.array(before - np.repeat(before[bounds[:-1]], rows)), pa.array(np.repeat(wide, rows))]
        kept = pa.table(columns, ["bucket", "id", "weight", "part", "at", "wide"]).filter(keep).combine_chunks()
        return kept.to_batches()[0] if kept.num_rows else pa.RecordBatch.from_pylist([], kept.schema)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, starts, waiting = TaskContext.get().partitionId(), True, None
        for group in whole_groups(batches, ("bucket",)):
            if waiting is not None:
                yield runs(*waiting, starts, False, part)
                starts = False
            waiting = group
        if waiting is not None:
            yield runs(*waiting, starts, True, part)

    order = ["bucket", "_h", "id"]
    dealt = members.select("bucket", "id", F.col("weight").cast("long").alias("weight"), F.xxhash64("id").alias("_h"))
    return (dealt.repartitionByRange(shuffle_slots(members), *order).sortWithinPartitions(*order).drop("_h")
            .mapInArrow(placed, "bucket bigint, id bigint, weight bigint, part bigint, at bigint, wide boolean"))


def dealt_blocks(members: DataFrame, payload: DataFrame, least: int, most: int | None = None) -> DataFrame:
    """``bucket, i, j, own, id`` and the payload columns, dealt and sorted by ``bucket, i, j``.

    ``members`` has ``bucket``, ``id`` and ``weight``, ``payload`` has ``id`` and what is to be compared. Buckets up to the weight
    ``least`` are one block, larger ones up to ``SPREAD`` blocks, or more where a block would weigh over ``most`` (and one row).
    """
    placed = stored(runs_in_place(members, least), "placed")
    lone = placed.where("not wide").select("bucket", "id", F.lit(0).alias("own"), F.lit(1).alias("_blocks"))
    # only buckets at a border of a partition, at most two each, and those above a block
    in_bucket = Window.partitionBy("bucket")
    runs = placed.where("wide").groupBy("bucket", "part").agg(F.sum("weight").alias("_w"), F.count("*").alias("_n")).select(
        "bucket", "part", (F.sum("_w").over(in_bucket.orderBy("part")) - F.col("_w")).alias("_before"),
        F.sum("_w").over(in_bucket).alias("_total"), F.sum("_n").over(in_bucket).alias("_rows")).where("_rows > 1")
    blocks = F.greatest(F.least(F.ceil(F.col("_total") / least), F.lit(SPREAD)), F.ceil(F.col("_total") / (most or least)))
    own = F.floor((F.col("_before") + F.col("at")) * F.col("_blocks") / F.col("_total"))
    wide = placed.where("wide").join(runs.withColumn("_blocks", blocks), ["bucket", "part"]).select(
        "bucket", "id", own.cast("int").alias("own"), F.col("_blocks").cast("int").alias("_blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    pairs = lone.unionByName(wide).select("bucket", "id", "own", other.alias("_other")).select(
        "bucket", F.least("own", "_other").alias("i"), F.greatest("own", "_other").alias("j"), "own", "id")
    return (pairs.join(payload, "id").repartition(shuffle_slots(members), "bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j", "id"))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...] = ("bucket", "i", "j")) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, bounds of the groups) of a sorted stream, each group whole."""
    held: list[pa.Table] = []

    def last(table: pa.Table) -> tuple:
        return tuple(table.column(k)[table.num_rows - 1].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = pa.Table.from_batches([batch])
        if held and last(held[-1]) == last(fresh) == tuple(fresh.column(k)[0].as_py() for k in keys):
            held.append(fresh)
            continue
        table = pa.concat_tables([*held, fresh]).combine_chunks()
        changed = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            values = table.column(k).to_numpy()
            changed |= values[1:] != values[:-1]
        cuts = np.flatnonzero(changed) + 1
        if len(cuts):
            yield table.slice(0, cuts[-1]), np.append(0, cuts)
            table = table.slice(cuts[-1])
        held = [table]
    if held:
        table = pa.concat_tables(held).combine_chunks()
        yield table, np.array([0, table.num_rows])


def fixed_rows(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    """A binary column of equally long values as a matrix."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset: array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
    return data.reshape(len(array), -1).view(dtype)


class Forest:
    """Union-find over the rows of a group, keeping the links that joined two trees."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def join(self, a: int, others: np.ndarray) -> None:
        """Links ``a`` to one of ``others`` in every other tree that holds some of them."""
        trees, first = np.unique(self.label[others], return_index=True)
        apart = trees != self.label[a]
        if apart.any():
            self.links += [(a, int(others[k])) for k in first[apart]]
            self.label[np.isin(self.label, trees)] = self.label[a]


def components(edges: DataFrame) -> DataFrame:
    """``id, component``: the smallest id reachable, for every id of the edges ``a, b`` (alternating stars).

    Each round replaces the neighbours of every id by their minimum; rounds are written out, so their number does not
    lengthen the plan. Minima are aggregates that combine before the shuffle, and the centre of a large star is a hot key.
    """
    def settled(frame: DataFrame) -> tuple:
        return frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()[:]

    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = settled(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("_m"), F.count_if(F.col("v") > F.col("u")).alias("_n"))
        large = with_groups(both.where("v > u"), least, ["u"], "_n", before[0]).select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        large = stored(large, "edges")  # read twice below
        lowest = large.groupBy("u").agg(F.min("v").alias("_m"), F.count("*").alias("_n"))
        # the pairs do not grow in number, so before[0] bounds those of this half round too
        small = with_groups(large, lowest, ["u"], "_n", before[0]).select(
            F.when(F.col("v") == F.col("_m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("_m").alias("v")).distinct()
        pairs = stored(small, "edges")
        after = settled(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
