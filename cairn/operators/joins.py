"""Joins and the set-ups that keep them cheap.

No join here carries a broadcast hint: Spark broadcasts a side only when its size is
under ``spark.sql.autoBroadcastJoinThreshold``, and AQE splits hot keys of sort-merge
joins. ``salts`` splits hot keys explicitly where AQE is off or a key is extreme.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.reshape import explode_days, union_conformed

_SALT, _SIDE = "__salt", "__side"


def left_lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str] | Sequence[str],
                add: Sequence[str] | None = None, cast: bool = False, salts: int = 1) -> DataFrame:
    """Left join to a dimension, adding its columns.

    ``on`` maps fact column to dimension column (or lists shared names). ``cast``
    compares both sides as text. ``add`` limits the dimension columns, so only they
    and the keys are shuffled. With ``salts > 1`` each fact key is spread over that
    many partitions and the dimension is repeated accordingly.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    add = [c for c in dim.columns if c not in pairs.values()] if add is None else list(add)

    def comparable(c: str) -> str:
        return f"cast(`{c}` as string)" if cast else f"`{c}`"

    right = dim.selectExpr(
        *[f"{comparable(r)} as __k{i}" for i, r in enumerate(pairs.values())],
        *[f"`{c}` as __a{i}" for i, c in enumerate(add)],
    )
    left = df
    conditions = [f"{comparable(c)} = __k{i}" for i, c in enumerate(pairs)]
    if salts > 1:
        left = df.withColumn(_SALT, F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
        right = right.withColumn("__dim_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
        conditions.append(f"{_SALT} = __dim_salt")
    joined = left.join(right, F.expr(" and ".join(conditions)), "left")
    return joined.selectExpr(*[f"`{c}`" for c in df.columns], *[f"__a{i} as `{c}`" for i, c in enumerate(add)])


def hot_keys(df: DataFrame, key: str, share: float, most: int = 100) -> list:
    """Values of a column with at least about ``share`` of the rows, at most ``most`` of them.

    The counts come from a mergeable sketch of ``100 * most`` counters, so no key is shuffled; every value above
    ``share`` is among them as long as ``share`` is above one counter's part.
    """
    if not 0 < share <= 1 or share * 100 * most < 2:
        raise ValueError("the sketch holds too few counters for that share")
    held = df.where(F.col(key).isNotNull())
    row = held.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {100 * most})").alias("top")).first()
    return [item["item"] for item in (row["top"] or []) if item["count"] >= share * row["n"]]


def hot_lookup(df: DataFrame, dim: DataFrame, on: tuple[str, str], add: Sequence[str], hot: Sequence, salts: int = 16) -> DataFrame:
    """Left join to a dimension with only the ``hot`` fact keys salted (see :func:`hot_keys`).

    A hot key is spread over ``salts`` partitions, and only the dimension rows of hot keys are repeated; the others are as in
    :func:`left_lookup`. The rows are the same as those of the plain join.
    """
    left_key, right_key = on
    if not hot:
        return left_lookup(df, dim, {left_key: right_key}, add)
    among = lambda c: F.coalesce(F.col(c).isin(list(hot)), F.lit(False))
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")
    facts = df.withColumn(_SALT, F.when(among(left_key), spread).otherwise(F.lit(0)))
    copies = F.when(among(right_key), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    rows = dim.select(right_key, *[c for c in add if c != right_key], F.explode(copies).alias("__dim_salt"))
    return left_lookup(facts, rows, {left_key: right_key, _SALT: "__dim_salt"}, add).drop(_SALT)


def lookup_on(df: DataFrame, dim: DataFrame, left_key: Column, right_key: str,
              add: Sequence[str]) -> DataFrame:
    """Left join on a computed left key, such as a padded business key."""
    keyed = df.withColumn("__computed", left_key)
    return left_lookup(keyed, dim, {"__computed": right_key}, add).drop("__computed")


def expand_nights(df: DataFrame, start: str, end: str, calendar: DataFrame, day: str = "full_date"
                  ) -> DataFrame:
    """Each interval once per day in ``[start, end)`` that lies within the calendar's range.

    Days are generated from the interval, so no range join is needed. The range comes
    from one scalar subquery and keeps a mistyped far-off date from blowing an interval
    up. Days missing inside the calendar are left to an inner join with it, which callers
    that aggregate do afterwards, on the small result.
    """
    span = calendar.select(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi"))).scalar()
    # greatest and least skip NULL, but an open interval has no nights
    first = F.when(F.col(start).isNotNull(), F.greatest(F.col(start), span["lo"]))
    last = F.when(F.col(end).isNotNull(), F.least(F.date_sub(F.col(end), 1), span["hi"]))
    return explode_days(df, first, last, day)


def nights_on_site(df: DataFrame, start: str, end: str, calendar: DataFrame, day: str = "full_date"
                   ) -> DataFrame:
    """Each interval once per calendar day in ``[start, end)``, joined by equality."""
    return expand_nights(df, start, end, calendar, day).join(calendar, day, "inner")


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on equal keys; the key columns are coalesced."""
    return left.join(right, list(keys), "full")


def attach_to_keys(keys: DataFrame, frames: Sequence[DataFrame], on: Sequence[str],
                   null_safe: bool = False) -> DataFrame:
    """Left join each frame to a key set. NULL keys match only with ``null_safe``."""
    out = keys
    for i, frame in enumerate(frames):
        renamed = frame.select(*[
            F.col(c).alias(f"__{i}{c}" if c in on else c) for c in frame.columns])
        test = [
            F.col(k).eqNullSafe(F.col(f"__{i}{k}")) if null_safe else F.col(k) == F.col(f"__{i}{k}")
            for k in on
        ]
        out = out.join(renamed, reduce(Column.__and__, test), "left").drop(*[f"__{i}{k}" for k in on])
    return out


def merge_aggregates(frames: Sequence[DataFrame], keys: Sequence[str], null_safe: bool = False,
                     separate_null_keys: bool = True) -> DataFrame:
    """Full outer merge of frames that hold one row per key, in a single shuffle.

    Every frame must be grouped by exactly ``keys``. The result has one row per key
    with the measures of all frames; it equals a chain of full outer joins followed by
    joining each frame back to the key set. As in that chain, a key with a NULL part
    matches nothing: it gives one row per frame (or one row with
    ``separate_null_keys=False``) whose measures are NULL. ``null_safe=True`` treats
    NULL as an ordinary key value instead.
    """
    measures = [c for f in frames for c in f.columns if c not in keys]
    stacked = union_conformed([f.withColumn(_SIDE, F.lit(i)) for i, f in enumerate(frames)])
    broken = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    if null_safe:
        return stacked.groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures])
    side = F.when(broken, F.col(_SIDE) if separate_null_keys else F.lit(0))
    merged = stacked.withColumn(_SIDE, side).groupBy(*keys, _SIDE).agg(
        *[F.max(m).alias(m) for m in measures])
    return merged.select(
        *keys, *[F.when(F.col(_SIDE).isNull(), F.col(m)).alias(m) for m in measures])


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str] | Sequence[str],
            where_parent: Column | None = None) -> DataFrame:
    """Child rows without a parent; rows with a NULL key count as orphans.

    Parent keys are reduced to a distinct set first, so a parent key with many rows
    costs one.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    if where_parent is not None:
        parent = parent.where(where_parent)
    keys = parent.select(*[F.col(r).alias(f"__p{i}") for i, r in enumerate(pairs.values())]).distinct()
    test = reduce(Column.__and__, [F.col(c) == F.col(f"__p{i}") for i, c in enumerate(pairs)])
    return child.join(keys, test, "left_anti")


def match_on_value(df: DataFrame, other: DataFrame, keys: Sequence[str], pick: str) -> DataFrame:
    """Attach ``max(pick)`` of the other frame's rows that agree in all ``keys``.

    The other side is aggregated first, so the join never multiplies rows. Its rows without
    a ``pick`` change nothing and are left out before they are shuffled.
    """
    picked = other.where(F.col(pick).isNotNull()).groupBy(*keys).agg(F.max(F.col(pick).cast("string")).alias(pick))
    return left_lookup(df, picked, keys, [pick])


def lookup_first(df: DataFrame, other: DataFrame, on: Mapping[str, str], order: Sequence[Column],
                 add: Sequence[str]) -> DataFrame:
    """Left join to the first row per key of the other side (fan-out guard)."""
    from cairn.operators.dedup import first_per_key

    return left_lookup(df, first_per_key(other, list(on.values()), order), on, add)


def compare_totals(left: DataFrame, right: DataFrame, pairs: Mapping[str, str], digits: int = 2
                   ) -> DataFrame:
    """The totals of two one-row frames as one row when any pair differs, else no row."""
    both = union_conformed([left, right]).agg(
        *[F.max(c).alias(c) for c in (*left.columns, *right.columns)])
    differ = [F.round(a, digits) != F.round(b, digits) for a, b in pairs.items()]
    return both.where(reduce(Column.__or__, differ))
