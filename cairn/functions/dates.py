"""Dates held as text, calendar and fiscal parts, ages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions._args import as_column
from cairn.functions.labels import band

# The stored date formats in order of preference, the first month of
# the fiscal year, and the pivot of two-digit years (69 is 1969).
MIXED_DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy")
ERA_FORMATS = ("yyyy-M-d", "MMddyyyy")
ERA_SHORT_YEAR_FORMAT = "M/d/yy"
SHORT_YEAR_PIVOT = 2069
COMPACT_FORMAT = "yyyyMMdd"
FISCAL_START_MONTH = 7
TENURE_LABELS = ("New (< 1 year)", "Established (1-3 years)", "Loyal (> 3 years)")


def parse_date(c: Column | str, formats: Sequence[str] = MIXED_DATE_FORMATS) -> Column:
    """First format that fits; NULL when none does."""
    c = as_column(c, "parse_date")
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def parse_era_timestamp(c: Column | str) -> Column:
    """Timestamp from ISO, ``MMDDYYYY`` or ``MM/DD/YY`` text."""
    c = as_column(c, "parse_era_timestamp")

    def read(fmt: str) -> Column:
        return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")

    short = read(ERA_SHORT_YEAR_FORMAT)
    century = F.make_interval(F.when(F.year(short) >= SHORT_YEAR_PIVOT, -100).otherwise(0))
    return F.coalesce(*[read(f) for f in ERA_FORMATS], (short + century).cast("timestamp_ntz"))


def parse_compact_date(c: Column | str) -> Column:
    """Timestamp from ``YYYYMMDD`` text."""
    parsed = F.try_to_timestamp(as_column(c, "parse_compact_date"), F.lit(COMPACT_FORMAT))
    return parsed.cast("timestamp_ntz")


def staleness_days(c: Column | str, as_of: Column) -> Column:
    """Days from a date to ``as_of``."""
    return F.datediff(as_of, as_column(c, "staleness_days"))


def month_date(year: Column | str, month: Column | str) -> Column:
    """First day of a month given as two numbers."""
    return F.make_date(
        as_column(year, "month_date").cast("int"), as_column(month, "month_date").cast("int"),
        F.lit(1),
    )


def month_of(c: Column | str) -> Column:
    """Midnight of the first day of the month, as timestamp."""
    return F.date_trunc("month", as_column(c, "month_of")).cast("timestamp_ntz")


def nights(start: Column | str, end: Column | str) -> Column:
    """Days between two dates."""
    return F.datediff(as_column(end, "nights"), as_column(start, "nights")).cast("int")


def tenure_tier(c: Column | str, as_of: Column) -> Column:
    """Age label by calendar years crossed (31 December to 1 January is one)."""
    years = F.year(as_of) - F.year(as_column(c, "tenure_tier").cast("date"))
    return band(years, (1, 3), TENURE_LABELS)


def _late(c: Column) -> Column:
    return F.month(c) >= FISCAL_START_MONTH


def fiscal_year(c: Column | str) -> Column:
    c = as_column(c, "fiscal_year")
    return F.year(c) + F.when(_late(c), 1).otherwise(0)


def fiscal_month(c: Column | str) -> Column:
    c = as_column(c, "fiscal_month")
    return F.month(c) + F.when(_late(c), -6).otherwise(6)


def fiscal_quarter(c: Column | str) -> Column:
    c = as_column(c, "fiscal_quarter")
    return F.quarter(c) + F.when(_late(c), -2).otherwise(2)


def date_parts(c: Column | str) -> dict[str, Column]:
    """Calendar numbers (bigint) and full English names."""
    c = as_column(c, "date_parts")
    return {
        "calendar_year": F.year(c).cast("bigint"),
        "calendar_month": F.month(c).cast("bigint"),
        "day_of_month": F.dayofmonth(c).cast("bigint"),
        "calendar_quarter": F.quarter(c).cast("bigint"),
        "day_name": F.date_format(c, "EEEE"),
        "month_name": F.date_format(c, "MMMM"),
    }
