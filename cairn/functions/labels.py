"""Labels and constants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions._args import as_column


def is_set(c: Column | str) -> Column:
    return as_column(c, "is_set").isNotNull()


def constant(value: object, data_type: str) -> Column:
    return F.lit(value).cast(data_type)


def typed_null(data_type: str) -> Column:
    """NULL of a stated type, to conform the branches of a union."""
    return F.lit(None).cast(data_type)


def label_map(
    c: Column | str, labels: Mapping[str, Sequence[object]], default: str | None
) -> Column:
    """First label whose list holds the value; ``default`` otherwise and for NULL."""
    c = as_column(c, "label_map")
    out = None
    for label, values in labels.items():
        test = c.isin(*values)
        out = F.when(test, label) if out is None else out.when(test, label)
    if out is None:
        raise ValueError("label_map needs at least one label")
    return out.otherwise(F.lit(default))


def band(c: Column | str, upper: Sequence[Column | float], labels: Sequence[str], unknown="Unknown",
         last_closed: bool = True, first_closed: bool = False) -> Column:
    """Numeric bands from ascending upper edges; NULL gets ``unknown``.

    With edges ``(500, 5000)`` the bands are ``< 500``, ``500 … 5000`` and ``> 5000``:
    the first band is open above unless ``first_closed``, the second-to-last closed
    unless ``last_closed`` is off.
    """
    if len(labels) != len(upper) + 1:
        raise ValueError("band needs one label more than edges")
    c = as_column(c, "band")
    out = F.when(c.isNull(), F.lit(unknown))
    for i, edge in enumerate(upper):
        closed = first_closed if i == 0 else last_closed
        out = out.when((c <= edge) if closed else (c < edge), labels[i])
    return out.otherwise(labels[-1])
