"""Column names that do not clash with those of the caller's table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted``, each with underscores put in front until no column of ``df`` has that name (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ddl(df: DataFrame) -> str:
    """The columns of ``df`` as a schema text."""
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
