"""Numbers held as text, defaults, report rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions._args import as_column


def parse_money(c: Column | str, data_type: str = "decimal(14,2)") -> Column:
    """Amount from ``$509,891.46`` or ``509891.46``; text that is no number gives NULL."""
    return F.regexp_replace(as_column(c, "parse_money"), "[$,]", "").try_cast(data_type)


def percent_to_rate(c: Column | str) -> Column:
    """``'15%'`` to 0.15 (double); two decimals of the percentage are kept."""
    number = F.replace(as_column(c, "percent_to_rate"), F.lit("%"), F.lit(""))
    return number.cast("decimal(5,2)").cast("double") / F.lit(100.0)


def try_int(c: Column | str) -> Column:
    return as_column(c, "try_int").try_cast("int")


def zero(c: Column | str) -> Column:
    """NULL as zero."""
    return F.coalesce(as_column(c, "zero"), F.lit(0))


def first_set(*cols: Column | str) -> Column:
    return F.coalesce(*[as_column(c, "first_set") for c in cols])


def report_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """Rounded report figure of a stated decimal type; NULL stays NULL."""
    rounded = F.round(as_column(c, "report_decimal"), scale)
    return rounded.cast(f"decimal({precision},{scale})")


def pct(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    """``100 * part / whole`` as double; NULL when ``whole`` is 0 or NULL."""
    part = as_column(part, "pct").cast("double")
    whole = F.nullif(as_column(whole, "pct").cast("double"), F.lit(0.0))
    return F.round(F.lit(100.0) * part / whole, digits)
