"""Keys: reproducible digests, padded business keys, tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions._args import as_column

# The text that stands for NULL inside a key, and the part separator.
# Digests equal those of existing keys only with exactly these.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def _part(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NULL_TOKEN))


def surrogate_key_sql(*names: str) -> str:
    """The key of named columns as a SQL expression."""
    parts = [f"coalesce(cast(`{n}` as string), '{NULL_TOKEN}')" for n in names]
    return f"md5(concat_ws('{SEPARATOR}', {', '.join(parts)}))"


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 hex over the text of the key parts; never NULL.

    Key on text, integer or date columns: the text form of floating numbers
    differs between engines.
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    if all(isinstance(c, str) and c.strip() for c in cols):
        return F.expr(surrogate_key_sql(*cols))
    return F.md5(F.concat_ws(SEPARATOR, *[_part(as_column(c, "surrogate_key")) for c in cols]))


def salted_key(literal: str, *cols: Column | str) -> Column:
    """Key with a literal first part, so ids of different kinds never collide."""
    if not literal:
        raise ValueError("salted_key needs a literal")
    return surrogate_key(F.lit(literal), *cols)


def guarded_key(c: Column | str) -> Column:
    """Key of one column, NULL where the column is NULL."""
    c = as_column(c, "guarded_key")
    return F.when(c.isNotNull(), surrogate_key(c))


def hash_pii(c: Column | str) -> Column:
    """Unsalted MD5 of the text form; NULL stays NULL."""
    return F.md5(as_column(c, "hash_pii").cast("string"))


def padded_key(c: Column | str, fmt: str = "GP-%03d") -> Column:
    """Zero-padded business key; NULL stays NULL (``format_string`` alone prints "null")."""
    c = as_column(c, "padded_key")
    return F.when(c.isNotNull(), F.format_string(fmt, c))


def id_to_string(c: Column | str) -> Column:
    return as_column(c, "id_to_string").cast("string")


def source_tag(code: str) -> Column:
    """Constant source-system code."""
    if not code:
        raise ValueError("source_tag needs a system code")
    return F.lit(code).cast("string")
