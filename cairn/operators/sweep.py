"""Sweep line over intervals: levels from +1/-1 events and distributed running sums.

An interval is two events, however long it is; nothing is expanded to days. Running sums are taken inside range partitions
of (key, time) and the totals of the partitions before are carried over, so a hot key is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.operators.filters import valid_intervals
from cairn.sources.sinks import materialize


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in names])


def running_sums(rows: DataFrame, keys: Sequence[str], at: str, sums: Mapping[str, str], upcoming: str = "next_at") -> DataFrame:
    """``rows`` with the totals of their key up to and including each row, and the key's next ``at``.

    ``sums`` maps output names to columns; (keys, at) has to be unique. NULL keys are a key of their own.
    """
    part = "__part"
    placed = materialize(
        rows.repartitionByRange(*keys, at).sortWithinPartitions(*keys, at).withColumn(part, F.spark_partition_id()), "sweep", "table")
    inside = Window.partitionBy(part, *keys).orderBy(at)
    until_now = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per key and partition it lies in: at most keys + partitions
    totals = placed.groupBy(part, *keys).agg(*[F.sum(c).alias(f"__t_{c}") for c in sums.values()], F.min(at).alias("__first"))
    over = Window.partitionBy(*keys).orderBy(part)
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(part, *keys, F.lead("__first").over(over).alias("__next"), *[
        F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__b_{c}") for c in sums.values()])
    local = placed.withColumns(
        {f"__s_{c}": F.sum(c).over(until_now) for c in sums.values()} | {"__lead": F.lead(at).over(inside)})
    both = local.join(carried, _same(local, carried, [part, *keys]))
    return both.select(
        *[local[c] for c in rows.columns], *[(F.col(f"__s_{c}") + F.col(f"__b_{c}")).alias(out) for out, c in sums.items()],
        F.coalesce("__lead", "__next").alias(upcoming))


def levels(intervals: DataFrame, keys: Sequence[str], start: str, end: str, measures: Mapping[str, Column]) -> DataFrame:
    """``keys, start, end`` and the sum of each measure over the intervals that cover ``[start, end)``.

    Every stretch between two changes is one row, gaps between intervals included (with zeros); stretches in which nothing changes are not
    cut. Intervals without both ends or with ``end <= start`` count nowhere.
    """
    names = list(measures)
    valid = valid_intervals(intervals, start, end)
    amounts = [value.alias(f"__d_{name}") for name, value in measures.items()]
    ends = F.array(F.struct(F.col(start).alias("__at"), F.lit(1).alias("__sign")), F.struct(F.col(end).alias("__at"), F.lit(-1).alias("__sign")))
    events = valid.select(*keys, F.explode(ends).alias("__e"), *amounts).select(*keys, "__e.*", *[f"__d_{n}" for n in names])
    changes = events.groupBy(*keys, "__at").agg(*[F.sum(F.col(f"__d_{n}") * F.col("__sign")).alias(f"__d_{n}") for n in names])
    moved = reduce(Column.__or__, [F.col(f"__d_{n}") != 0 for n in names])
    level = running_sums(changes.where(moved), keys, "__at", {n: f"__d_{n}" for n in names}, "__until")
    return level.where("__until is not null").select(*keys, F.col("__at").alias(start), F.col("__until").alias(end), *names)


def covered(intervals: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """The union of each key's intervals, cut where the number of intervals changes."""
    return levels(intervals, keys, start, end, {"__n": F.lit(1)}).where("__n > 0").drop("__n")
