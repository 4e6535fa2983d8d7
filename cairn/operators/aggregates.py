"""Grouped figures. Plain aggregates: Spark combines per task before it shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions import month_of


def by_month(df: DataFrame, key: Sequence[str], when: str, measures: Mapping[str, Column],
             month: str = "report_month") -> DataFrame:
    """Measures per key and month; the month is a timestamp at midnight."""
    return df.groupBy(*key, month_of(when).alias(month)).agg(
        *[expr.alias(name) for name, expr in measures.items()])


def totals(df: DataFrame, **measures: Column) -> DataFrame:
    """One row of totals, zero where there is nothing to add."""
    return df.agg(*[F.coalesce(expr, F.lit(0)).alias(name) for name, expr in measures.items()])


def count_if(test: Column) -> Column:
    """How many rows pass a test."""
    return F.sum(F.when(test, 1).otherwise(0))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order: each task keeps ``n``, no full sort."""
    return df.orderBy(*order).limit(n)


def grouping_totals(df: DataFrame, sets: Sequence[Sequence[str]], measures: Mapping[str, Column], level: str = "level") -> DataFrame:
    """Measures per several sets of keys at once, from one scan (the sets are one ``Expand`` before the partial aggregate).

    ``level`` is a number with one bit per key in order of appearance, the first key highest, set where the row is a total over that
    key; it tells totals from groups of NULL keys. An empty set gives the grand total; an empty table gives no rows.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    bits = [F.grouping(k) * (1 << (len(keys) - 1 - i)) for i, k in enumerate(keys)]
    total = reduce(Column.__add__, bits) if bits else F.lit(0)
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(
        total.cast("int").alias(level), *[expr.alias(name) for name, expr in measures.items()])
