"""Row filters. All are plain predicates, so they reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def live_rows(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    """Rows whose delete flag is false; a NULL flag drops the row."""
    return df.where(~F.col(flag))


def valid_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows with both bounds and ``end > start``."""
    return df.where(
        F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) > F.col(start))
    )


def any_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where at least one of the columns is set."""
    return df.where(reduce(or_, [F.col(c).isNotNull() for c in cols]))


def non_blank(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where every column is set and not ``''``."""
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() & (F.col(c) != "") for c in cols]))
