"""Argument checks shared by the expression functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str, caller: str) -> Column:
    """Column for a name or a Column; an empty argument is an error."""
    if c is None or (isinstance(c, str) and not c.strip()):
        raise ValueError(f"{caller} needs a column")
    return F.col(c) if isinstance(c, str) else c
