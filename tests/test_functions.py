"""Column expressions: NULL cases, odd formats and argument checks."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cairn import functions as fn
from cairn.functions.keys import NULL_TOKEN


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).collect()[0]["v"]


def text(s):
    return F.lit(s).cast("string")


def test_surrogate_key_is_md5_of_joined_parts(spark):
    expected = hashlib.md5(f"a-{NULL_TOKEN}-3".encode()).hexdigest()
    assert value(spark, fn.surrogate_key(F.lit("a"), text(None), F.lit(3))) == expected


def test_salted_keys_differ_by_literal(spark):
    assert value(spark, fn.salted_key("x", F.lit(1))) != value(spark, fn.salted_key("y", F.lit(1)))


def test_null_stays_null_in_hash_padded_and_guarded_keys(spark):
    assert value(spark, fn.hash_pii(text(None))) is None
    assert value(spark, fn.padded_key(F.lit(None).cast("int"))) is None
    assert value(spark, fn.guarded_key(text(None))) is None
    assert value(spark, fn.padded_key(F.lit(7))) == "GP-007"
    assert value(spark, fn.padded_key(F.lit(1234))) == "GP-1234"


@pytest.mark.parametrize("call", [
    lambda: fn.clean_string(""), lambda: fn.source_tag(""), lambda: fn.id_to_string(None),
    lambda: fn.surrogate_key(), lambda: fn.salted_key("", "a"), lambda: fn.marker_count("a", ""),
    lambda: fn.tagged_count("a", ""), lambda: fn.label_map("a", {}, None)])
def test_empty_arguments_are_errors(spark, call):
    with pytest.raises(ValueError):
        call()


def test_clean_string_keeps_case_by_default(spark):
    assert value(spark, fn.clean_string(F.lit(" Blue-Hills, (Park)! "))) == "Blue-Hills Park"
    assert value(spark, fn.clean_string(F.lit("Blue."), fold_case=True)) == "blue"


def test_account_parts_are_empty_on_mismatch_and_null_on_null(spark):
    parts = fn.split_account(F.lit("100-DIV-D2-PRG-P3-OBJ-44"))
    assert [value(spark, p) for p in parts.values()] == ["100", "D2", "P3", "44"]
    assert [value(spark, p) for p in fn.split_account(F.lit("x")).values()] == [""] * 4
    assert [value(spark, p) for p in fn.split_account(text(None)).values()] == [None] * 4


def test_contact_parts(spark):
    parts = fn.split_contact(F.lit("Ann|a@x.org|555"))
    assert [value(spark, p) for p in parts.values()] == ["Ann", "a@x.org", "555"]


def test_tagged_counts(spark):
    guests = F.lit("Adults:3|Kids:12")
    assert value(spark, fn.tagged_count(guests, "Kids")) == 12
    assert value(spark, fn.tagged_count(guests, "Pets")) is None


@pytest.mark.parametrize("raw, expected", [
    ("$509,891.46", Decimal("509891.46")), ("509891.46", Decimal("509891.46")), ("TBD", None), (None, None)])
def test_parse_money(spark, raw, expected):
    assert value(spark, fn.parse_money(text(raw))) == expected


def test_percent_to_rate(spark):
    assert value(spark, fn.percent_to_rate(F.lit("15%"))) == 0.15


@pytest.mark.parametrize("raw, expected", [
    ("2022-12-25", dt.date(2022, 12, 25)), ("12/13/2022", dt.date(2022, 12, 13)),
    ("1/3/2022", dt.date(2022, 1, 3)), ("December 10, 2010", dt.date(2010, 12, 10)),
    ("Mar 08, 2012", dt.date(2012, 3, 8)), ("n/a", None), (None, None)])
def test_parse_date(spark, raw, expected):
    assert value(spark, fn.parse_date(text(raw))) == expected


@pytest.mark.parametrize("raw, expected", [
    ("2001-02-03", dt.datetime(2001, 2, 3)), ("02032001", dt.datetime(2001, 2, 3)),
    ("02/03/68", dt.datetime(2068, 2, 3)), ("02/03/69", dt.datetime(1969, 2, 3)),
    ("02/03/99", dt.datetime(1999, 2, 3)), ("soon", None)])
def test_era_timestamps_pivot_at_1969(spark, raw, expected):
    assert value(spark, fn.parse_era_timestamp(text(raw))) == expected


@pytest.mark.parametrize("doc, expected", [
    ('{"a":"x"}', "x"), ('{"a":1}', "1"), ('{"a":null}', None), ('{"a":1', None), ('{"a":1} tail', None),
    ('{"a":1},{"b":2}', None), ('{"a":1}}', None), ('{"a":1}] x', None), ("", None), (None, None),
    (' {"a":1} ', "1")])
def test_malformed_json_gives_null_as_a_whole(spark, doc, expected):
    assert value(spark, fn.json_text_guarded(text(doc), "$.a")) == expected


def test_marker_count_keeps_null(spark):
    assert value(spark, fn.marker_count(F.lit("INV-1|INV-2|"), "INV-")) == 2
    assert value(spark, fn.marker_count(text(None), "INV-")) is None


@pytest.mark.parametrize("since, tier", [
    ("2026-01-01", "New (< 1 year)"), ("2025-12-31", "Established (1-3 years)"),
    ("2023-06-01", "Established (1-3 years)"), ("2022-06-01", "Loyal (> 3 years)"), (None, "Unknown")])
def test_tenure_counts_calendar_years(spark, since, tier):
    as_of = F.lit("2026-01-01").cast("date")
    assert value(spark, fn.tenure_tier(text(since).cast("date"), as_of)) == tier


@pytest.mark.parametrize("acres, label", [(499.99, "S"), (500, "M"), (5000, "M"), (5000.01, "L"), (None, "Unknown")])
def test_band_edges(spark, acres, label):
    assert value(spark, fn.band(F.lit(acres).cast("double"), (500, 5000), ("S", "M", "L"))) == label


@pytest.mark.parametrize("day, expected", [
    ("2025-07-01", (2026, 1, 1)), ("2025-12-31", (2026, 6, 2)), ("2026-01-01", (2026, 7, 3)), ("2026-06-30", (2026, 12, 4))])
def test_fiscal_year_starts_in_july(spark, day, expected):
    d = F.lit(day).cast("date")
    assert (value(spark, fn.fiscal_year(d)), value(spark, fn.fiscal_month(d)), value(spark, fn.fiscal_quarter(d))) == expected


def test_full_names_of_days_and_months(spark):
    parts = fn.date_parts(F.lit("2024-09-02").cast("date"))
    assert value(spark, parts["day_name"]) == "Monday" and value(spark, parts["month_name"]) == "September"


def test_join_text_skips_null(spark):
    assert value(spark, fn.join_text(" ", text(None), F.lit("b"))) == "b"
    assert value(spark, fn.join_text(" ", text(None), text(None))) == ""


def test_pct_of_nothing_is_null(spark):
    assert value(spark, fn.pct(F.lit(1), F.lit(0))) is None
    assert value(spark, fn.pct(F.lit(1), F.lit(3))) == 33.3
