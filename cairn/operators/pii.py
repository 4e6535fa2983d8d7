"""Personal data: which columns hold it, and redaction."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators.profile import wide_stats

# Name fragments that mark a column as personal data.
PII_NAMES = (
    "email", "ssn", "phone", "dob", "birth", "first_name", "last_name", "surname", "address",
    "ip_address", "ip_addr", "passport", "license", "credit_card", "card_number", "routing",
    "social_security", "taxpayer", "national_id",
)
# Value patterns, most specific first. They use no look-around, so both engines read them alike.
PII_PATTERNS = {
    "EMAIL_ADDRESS": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "US_SSN": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "CREDIT_CARD": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
    "IP_ADDRESS": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "PHONE_NUMBER": r"\b[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}\b",
}
REDACTED = "[REDACTED]"
# What any match of a pattern contains: cheaper searches, which spare most rows the pattern. The search for a digit is
# shared by its kinds, and patterns without their word bounds are found several times faster than with them.
NEEDED = {
    "EMAIL_ADDRESS": lambda c: c.contains("@"),
    "US_SSN": lambda c: c.contains("-"),
}


def has_digit(c: Column) -> Column:
    return c.rlike("[0-9]")


def holds(c: Column | str, kind: str, digit: Column | None = None) -> Column:
    """Does a text contain personal data of a kind? ``digit`` tells whether it can hold a digit, where that is known."""
    c = F.col(c) if isinstance(c, str) else c
    if kind in NEEDED:
        needed = NEEDED[kind](c)
    else:
        needed = (has_digit(c) if digit is None else digit) & c.rlike(PII_PATTERNS[kind].replace(r"\b", ""))
    return needed & c.rlike(PII_PATTERNS[kind])


def luhn(digits: Column) -> Column:
    """Does a text of digits pass the checksum of card numbers? An aggregate over its digits from the right."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(places, F.lit(0), lambda n, d: n + d) % 10 == 0


# What a match of a pattern must satisfy beyond its form: checksum, ranges of the parts, numbers never issued.
CHECKS = {
    "CREDIT_CARD": lambda m: luhn(F.regexp_replace(m, "[ -]", "")),
    "IP_ADDRESS": lambda m: F.forall(F.split(m, "[.]"), lambda part: part.cast("int") <= 255),
    "US_SSN": lambda m: ~(F.substring(m, 1, 3).isin("000", "666") | m.startswith("9") | (F.substring(m, 5, 2) == "00") | m.endswith("-0000")),
}


def matches(c: Column | str, kind: str) -> Column:
    """All texts in ``c`` that have the form of a kind, in order."""
    return F.regexp_extract_all(c, F.lit(PII_PATTERNS[kind]), F.lit(0))


def holds_valid(c: Column | str, kind: str) -> Column:
    """As :func:`holds`, for items that also pass the check of their kind; only texts with the form are taken apart."""
    if kind not in CHECKS:
        return holds(c, kind)
    return F.when(holds(c, kind), F.exists(matches(c, kind), CHECKS[kind])).otherwise(F.when(holds(c, kind).isNotNull(), F.lit(False)))


def pii_by_name(columns: DataFrame, name: str = "column_name") -> DataFrame:
    """Rows whose column name contains a marked fragment, in any case."""
    lower = F.lower(name)
    return columns.where(reduce(Column.__or__, [lower.contains(p) for p in PII_NAMES]))


def pii_by_value(df: DataFrame, threshold: int = 1, validated: bool = False) -> DataFrame:
    """Text columns with at least ``threshold`` rows that contain personal data.

    Every row of every text column is looked at, in one aggregate. With ``validated`` an item has to pass the check of
    its kind too (``CHECKS``), so that order numbers are not cards and version numbers not addresses.
    """
    test = holds_valid if validated else holds
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    stats = {
        kind: ("bigint", lambda c, k=kind: F.count_if(test(c, k))) for kind in PII_PATTERNS}
    found = wide_stats(df, text, stats)
    return found.where(F.greatest(*PII_PATTERNS) >= threshold)


def _masked(c: str, kind: str, validated: bool) -> Column:
    """The text with its items of a kind replaced; of a validated kind only those that pass the check."""
    tag = F.lit(f"[REDACTED:{kind}]")
    if not validated or kind not in CHECKS:
        return F.regexp_replace(c, F.lit(PII_PATTERNS[kind]), tag)
    # the text between the items, each followed by its item
    between = F.split(c, PII_PATTERNS[kind], -1)
    shown = F.transform(matches(c, kind), lambda m: F.when(CHECKS[kind](m), tag).otherwise(m))
    return F.array_join(F.zip_with(between, shown, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def redact(df: DataFrame, columns: Iterable[str], validated: bool = False) -> DataFrame:
    """Frame with the named columns masked.

    Each recognised item becomes ``[REDACTED:KIND]``; a value without one becomes
    ``[REDACTED]``. NULL stays NULL and unknown columns are ignored. With ``validated`` items that
    fail the check of their kind are left as they are.
    """
    masked = [c for c in dict.fromkeys(columns) if c in df.columns]
    # masking adds no digit, so a text without one needs no further search
    out = df.withColumns({f"__m_{c}": F.col(c).cast("string") for c in masked}
                         | {f"__d_{c}": has_digit(F.col(c).cast("string")) for c in masked}) if masked else df
    for kind in PII_PATTERNS:
        # one step per kind, so each text is rewritten only when it holds the kind
        out = out.withColumns({
            f"__m_{c}": F.when(holds(f"__m_{c}", kind, F.col(f"__d_{c}")), _masked(f"__m_{c}", kind, validated))
            .otherwise(F.col(f"__m_{c}")) for c in masked}) if masked else out
    return out.select(*[
        F.when(F.col(f"__m_{c}") == F.col(c).cast("string"), REDACTED).otherwise(F.col(f"__m_{c}")).alias(c)
        if c in masked else F.col(c) for c in df.columns]) if masked else df
