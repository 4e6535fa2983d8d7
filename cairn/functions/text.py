"""Text cleaning and splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions._args import as_column

# Patterns of the stored text formats.
DROPPED_CHARACTERS = "[^a-zA-Z0-9 _-]"
ACCOUNT_PATTERNS = {
    "account_fund_code": r"^(\d+)-DIV",
    "account_division_code": r"-DIV-(\w+)-PRG",
    "account_program_code": r"-PRG-(\w+)-OBJ",
    "account_object_code": r"-OBJ-(\w+)$",
}
CONTACT_PATTERNS = {
    "contact_name": r"^([^|]*)",
    "contact_email": r"\|([^|]*)\|",
    "contact_phone": r"\|([^|]*)$",
}


def clean_string(c: Column | str, fold_case: bool = False) -> Column:
    """Drop punctuation and trim. Case is kept unless ``fold_case``."""
    cleaned = F.trim(
        F.regexp_replace(as_column(c, "clean_string").cast("string"), DROPPED_CHARACTERS, "")
    )
    return F.lower(cleaned) if fold_case else cleaned


def _split(c: Column, patterns: dict[str, str]) -> dict[str, Column]:
    return {name: F.regexp_extract(c, pattern, 1) for name, pattern in patterns.items()}


def split_account(c: Column | str) -> dict[str, Column]:
    """Fund, division, program and object of a compound account code.

    A part that does not match is ``''``; a NULL code gives NULL parts.
    """
    return _split(as_column(c, "split_account"), ACCOUNT_PATTERNS)


def split_contact(c: Column | str) -> dict[str, Column]:
    """Name, email and phone of a ``name|email|phone`` text."""
    return _split(as_column(c, "split_contact"), CONTACT_PATTERNS)


def tagged_count(c: Column | str, tag: str) -> Column:
    """Integer behind ``tag:`` in a ``Adults:3|Kids:2`` list; NULL when absent."""
    if not tag:
        raise ValueError("tagged_count needs a tag")
    found = F.regexp_extract(as_column(c, "tagged_count"), tag + r":(\d+)", 1)
    return F.nullif(found, F.lit("")).try_cast("int")


def json_text(c: Column | str, path: str) -> Column:
    """Text at a JSON path such as ``$.a``."""
    return F.get_json_object(as_column(c, "json_text"), path)


def json_whole(c: Column | str) -> Column:
    """The document if it is well formed and nothing follows it, else NULL.

    ``get_json_object`` stops reading after the first value, so ``{"a":1} x`` would
    still give 1. The document is read as the first element of an array whose second is
    the document's own hash: text behind the document of any kind breaks the array, or
    something else comes second. Names in single quotes are read, as Spark's functions do.
    """
    c = as_column(c, "json_whole")
    tail = F.xxhash64(c).cast("string")
    second = F.get_json_object(F.concat(F.lit("["), c, F.lit(","), tail, F.lit("]")), "$[1]")
    return F.when(second == tail, c)


def json_text_guarded(c: Column | str, path: str) -> Column:
    """Text at a JSON path, NULL for the whole of any malformed document."""
    return F.get_json_object(json_whole(as_column(c, "json_text_guarded")), path)


def json_fields_guarded(c: Column | str, *names: str) -> dict[str, Column]:
    """Texts of top-level fields, NULL for all of any malformed document.

    The document is judged once for all fields of a projection, and a field that is not
    asked for later costs nothing. Of a repeated field the first counts.
    """
    return {n: json_text_guarded(c, f"$['{n}']") for n in names}


def marker_count(c: Column | str, marker: str) -> Column:
    """How often a marker occurs in a text; NULL stays NULL."""
    if not marker:
        raise ValueError("marker_count needs a marker")
    c = as_column(c, "marker_count")
    removed = F.length(c) - F.length(F.replace(c, F.lit(marker), F.lit("")))
    return (removed / F.lit(len(marker))).cast("int")


def null_if(c: Column | str, sentinel: object) -> Column:
    return F.nullif(as_column(c, "null_if"), F.lit(sentinel))


def join_text(sep: str, *cols: Column | str) -> Column:
    """Join, skipping NULLs; all NULL gives ``''``."""
    return F.concat_ws(sep, *[as_column(c, "join_text") for c in cols])
