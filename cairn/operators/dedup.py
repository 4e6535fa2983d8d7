"""One row per key.

Picks use ``row_number() = 1``: Spark then keeps only the best row of each key per
task *before* the shuffle (window group limit), so a key that holds a third of all
rows sends one row per task, not all of them. Attribute merges are plain aggregates,
which combine before the shuffle for the same reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, key: Sequence[str | Column], order: Sequence[Column], n: int = 1
                  ) -> DataFrame:
    """First ``n`` rows of each key in the given order; NULL keys form one group."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) <= n).drop(_RANK)


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Newest row per key. Give ``order`` as ``desc_nulls_last`` columns and a tie-break."""
    return first_per_key(df, key, order)


def drop_exact_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key among exact duplicates; where rows differ, the smallest row."""
    rest = [F.asc_nulls_last(c) for c in df.columns if c not in key]
    return first_per_key(df, key, rest or [F.lit(1)])


def source_rank(source: str | Column, ranks: Sequence[str]) -> Column:
    """Position of a row's source in a preference list; unlisted sources come last."""
    source = F.col(source) if isinstance(source, str) else source
    out = F.when(F.lit(False), 0)
    for i, code in enumerate(ranks):
        out = out.when(source == code, i)
    return out.otherwise(len(ranks))


def prefer_source(df: DataFrame, key: Sequence[str | Column], source: str, ranks: Sequence[str],
                  tie: Sequence[str]) -> DataFrame:
    """One row per key: the preferred source first, then the smallest tie-break."""
    return first_per_key(df, key, [source_rank(source, ranks), *[F.asc_nulls_last(c) for c in tie]])


def golden_record(df: DataFrame, key: Column, merge: Sequence[str], source: str,
                  ranks: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """One merged row per key.

    The ``merge`` columns take the largest value of the whole group, even across
    different rows; all others come from the preferred source's row. It is one
    aggregate with one shuffle, not several windows.
    """
    other = [c for c in df.columns if c not in merge]
    parts = [p for c in tie for p in (F.col(c).isNull(), F.col(c))]  # NULL last
    rank = F.struct(source_rank(source, ranks), *parts)
    grouped = df.groupBy(key.alias("__key")).agg(
        F.min_by(F.struct(*other), rank).alias("__row"),
        *[F.max(c).alias(c) for c in merge],
    )
    return grouped.select("__row.*", *merge)


def pick_max(df: DataFrame, key: Sequence[str], picks: Mapping[str, Column]) -> DataFrame:
    """Largest value per key for each named expression: a deterministic pick."""
    return df.groupBy(*key).agg(*[F.max(expr).alias(name) for name, expr in picks.items()])
