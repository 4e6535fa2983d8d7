"""Cast-and-rename projections, declared or derived from a schema."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.keys import surrogate_key_sql


@dataclass(frozen=True)
class StagingSpec:
    """One staging model: typed columns of one source table plus a hash key.

    ``columns`` maps source column to type, ``renames`` source column to output name,
    ``derived`` output name to an expression over the source columns.
    """

    system: str
    table: str
    hash_key: str
    key: str
    columns: Mapping[str, str]
    renames: Mapping[str, str] = field(default_factory=dict)
    derived: Callable[[], Mapping[str, Column]] | None = None

    def output_name(self, column: str) -> str:
        return self.renames.get(column, column)


def _cast_sql(column: str, data_type: str, name: str) -> str:
    return f"cast(`{column}` as {data_type}) as `{name}`"


def cast_columns(df: DataFrame, types: Mapping[str, str], renames: Mapping[str, str] | None = None
                 ) -> DataFrame:
    """Every listed column cast to its type and renamed; other columns are dropped.

    Casts follow the session's ANSI setting: bad input raises when it is on.
    """
    renames = renames or {}
    return df.selectExpr(*[_cast_sql(c, t, renames.get(c, c)) for c, t in types.items()])


def stage(df: DataFrame, spec: StagingSpec) -> DataFrame:
    """Apply a staging spec: one projection, rows unchanged."""
    derived = dict(spec.derived()) if spec.derived else {}
    if derived:
        df = df.withColumns({f"__new_{name}": expr for name, expr in derived.items()})
    return df.selectExpr(
        f"{surrogate_key_sql(spec.key)} as `{spec.hash_key}`",
        *[_cast_sql(c, t, spec.output_name(c)) for c, t in spec.columns.items()],
        *[f"`__new_{name}` as `{name}`" for name in derived],
    )


def keep_and_add(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of the input and some new ones."""
    return df.withColumns(columns)


# What makes a column name an id or metadata name.
ID_NAME = re.compile(r"id[A-Z]|id$", re.IGNORECASE)
METADATA_PREFIX = "_"


def _category(f: T.StructField) -> str | None:
    if ID_NAME.search(f.name):
        return "ids"
    if f.name.startswith(METADATA_PREFIX):
        return "metadata"
    kinds: list[tuple[str, tuple[type, ...]]] = [
        ("strings", (T.StringType,)),
        ("numerics", (T.NumericType,)),
        ("booleans", (T.BooleanType,)),
        ("dates/timestamps", (T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType)),
        ("semi_structured", (T.ArrayType, T.StructType, T.MapType, T.VariantType)),
    ]
    return next((name for name, types in kinds if isinstance(f.dataType, types)), None)


CATEGORY_ORDER = ("ids", "strings", "numerics", "booleans", "dates/timestamps", "semi_structured",
                  "metadata")


def spec_from_schema(df: DataFrame) -> dict[str, str]:
    """Cast spec of a table: columns grouped by category, sorted by name within each.

    The result maps source column to type and can be passed to :func:`cast_columns`
    (with lower-cased names) as the starting point of a staging model.
    """
    grouped: dict[str, list[T.StructField]] = {name: [] for name in CATEGORY_ORDER}
    for f in df.schema.fields:
        category = _category(f)
        if category:
            grouped[category].append(f)
    return {
        f.name: f.dataType.simpleString()
        for category in CATEGORY_ORDER
        for f in sorted(grouped[category], key=lambda f: f.name.lower())
    }
