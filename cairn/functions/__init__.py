"""Reusable column expressions. Everything here stays inside Spark's code generation."""

from cairn.functions.dates import (
    date_parts,
    fiscal_month,
    fiscal_quarter,
    fiscal_year,
    month_date,
    month_of,
    nights,
    parse_compact_date,
    parse_date,
    parse_era_timestamp,
    staleness_days,
    tenure_tier,
)
from cairn.functions.keys import (
    guarded_key,
    hash_pii,
    id_to_string,
    padded_key,
    salted_key,
    source_tag,
    surrogate_key,
)
from cairn.functions.labels import band, constant, is_set, label_map, typed_null
from cairn.functions.numbers import (
    first_set,
    parse_money,
    pct,
    percent_to_rate,
    report_decimal,
    try_int,
    zero,
)
from cairn.functions.text import (
    clean_string,
    join_text,
    json_fields_guarded,
    json_text,
    json_text_guarded,
    json_whole,
    marker_count,
    null_if,
    split_account,
    split_contact,
    tagged_count,
)

__all__ = [
    "band",
    "clean_string",
    "constant",
    "date_parts",
    "first_set",
    "fiscal_month",
    "fiscal_quarter",
    "fiscal_year",
    "guarded_key",
    "hash_pii",
    "id_to_string",
    "is_set",
    "join_text",
    "json_fields_guarded",
    "json_text",
    "json_text_guarded",
    "json_whole",
    "label_map",
    "marker_count",
    "month_date",
    "month_of",
    "nights",
    "null_if",
    "padded_key",
    "parse_compact_date",
    "parse_date",
    "parse_era_timestamp",
    "parse_money",
    "pct",
    "percent_to_rate",
    "report_decimal",
    "salted_key",
    "source_tag",
    "split_account",
    "split_contact",
    "staleness_days",
    "surrogate_key",
    "tagged_count",
    "tenure_tier",
    "try_int",
    "typed_null",
    "zero",
]
