"""Profiles, hints, personal data, keys and cardinality."""

from __future__ import annotations

import datetime
from itertools import combinations

import pytest

from cairn.operators import discovery, pii, profile


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [(1, "a@x.org", "10", "on", None, "k"), (2, "b@x.org", "20.5", "off", None, "k"), (3, None, "30", "on", None, "k")],
        "id int, email_address string, amount string, status string, legacy_flag string, constant_col string")


def by_name(df):
    return {r["column_name"]: r for r in df.collect()}


def test_quick_profile(frame):
    p = by_name(profile.profile_ratios(profile.quick_profile(frame)))
    assert p["id"][1:] == (3, 0, 3, "1", "3", 2.0, "1|2|3", 0.0, 1.0)
    assert p["email_address"]["null_count"] == 1 and p["email_address"]["null_rate"] == 0.3333
    assert p["amount"]["avg_val"] == pytest.approx(60.5 / 3)
    assert p["status"]["top_values"] == "on|off" and p["status"]["avg_val"] is None
    assert p["legacy_flag"]["distinct_count"] == 0 and p["legacy_flag"]["top_values"] is None


def test_profile_of_empty_table(spark):
    p = by_name(profile.profile_ratios(profile.quick_profile(spark.createDataFrame([], "x int"))))
    assert p["x"]["total_count"] == 0 and p["x"]["null_rate"] == 0.0 and p["x"]["uniqueness_ratio"] == 0.0


def test_numeric_bounds_stay_typed(spark):
    df = spark.createDataFrame([(9,), (10,)], "x int")
    assert by_name(profile.quick_profile(df))["x"][4:6] == ("9", "10")


def test_unique_columns_and_value_counts(frame, rows):
    assert rows(profile.unique_columns(profile.quick_profile(frame)), "column_name") == [("amount",), ("id",)]
    counts = rows(profile.value_counts(frame.select("status", "email_address"), max_distinct=2))
    assert counts == [("email_address", "a@x.org", 1), ("email_address", "b@x.org", 1), ("email_address", None, 1),
                      ("status", "off", 1), ("status", "on", 2)]


def test_signals(frame, rows):
    found = rows(profile.staging_signals(frame, 0.9), "column_name", "signal_type")
    assert found == [("amount", "CAST_HINT"), ("constant_col", "UNUSED_COLUMN"), ("id", "RENAME_HINT"),
                     ("legacy_flag", "UNUSED_COLUMN"), ("status", "RENAME_HINT")]


@pytest.mark.parametrize("name, part", [
    ("orderId", "order_id"), ("str_name", "Hungarian"), ("Type", "ambiguous"), ("order_no", None)])
def test_rename_hints(spark, name, part):
    found = [r["message"] for r in profile.staging_signals(spark.createDataFrame([(1,), (2,)], f"{name} int")).collect()]
    assert (part in found[0]) if part else found == []


def test_check_suggestions(spark, rows):
    data = [(f"i{n}", None if n % 2 else 1, "ab"[n % 2], None if n < 5 else "2024-01-01") for n in range(40)]
    df = spark.createDataFrame(data, "order_id string, park_sk int, kind string, closed_on string")
    assert rows(profile.suggest_checks(df, {"order_id": ["not_null"]})) == [
        ("kind", "accepted_values", "a, b"), ("order_id", "unique", None), ("park_sk", "not_null", None)]


def test_freshness_suggestion(spark, rows):
    df = spark.createDataFrame([
        ("sales_orders", "created_at", 1), ("sales_orders", "row_updated_at", 2), ("park_types", "Modified_Date", 1),
        ("parks", "name", 1), ("visits", "last_modified", 3)], "table_name string, column_name string, position int")
    assert rows(profile.suggest_freshness(df)) == [
        ("park_types", "Modified_Date", "reference", 168, 336), ("sales_orders", "row_updated_at", "transactional", 12, 24),
        ("visits", "last_modified", "standard", 24, 48)]


def test_pii_by_name_and_value(spark, frame, rows):
    from cairn.sources import describe

    assert rows(pii.pii_by_name(describe(frame)), "column_name") == [("email_address",)]
    notes = spark.createDataFrame([("call 617-555-0101",), ("10.0.0.1 up",), (None,)], "note string")
    found = pii.pii_by_value(notes).collect()[0]
    assert found["PHONE_NUMBER"] == 1 and found["IP_ADDRESS"] == 1 and found["EMAIL_ADDRESS"] == 0
    assert pii.pii_by_value(notes, threshold=2).count() == 0


def test_redaction(spark, frame, rows):
    df = spark.createDataFrame([("me a@x.org", 1), ("plain", 2), (None, 3)], "note string, id int")
    assert rows(pii.redact(df, ["note", "missing"])) == [
        ("[REDACTED]", 2), ("me [REDACTED:EMAIL_ADDRESS]", 1), (None, 3)]
    assert pii.redact(df, []) is df


def brute_force_keys(data, names, elig, cand):
    total, found = len(data), []

    def ratio(cols):
        picked = [tuple(r[names.index(c)] for c in cols) for r in data]
        return len({p for p in picked if None not in p}) / total

    eligible = [c for c in names if ratio([c]) >= elig]
    found += [((c,), ratio([c])) for c in eligible]
    for size in (2, 3):
        if any(r >= cand for _, r in found):
            break
        found += [(c, ratio(c)) for c in combinations(eligible, size)]
    return {", ".join(c): (len(c), pytest.approx(r)) for c, r in found}


@pytest.mark.parametrize("data", [
    [(i, i // 2, i % 3, "x") for i in range(20)],
    [(i // 2, (i * 7 % 20) // 2, None if i == 3 else i % 11, i % 2) for i in range(20)],
    [(i // 2, i // 2, i // 2 + 100, 0) for i in range(20)],
    [tuple((i * k % 20) // 2 for k in (1, 3, 7, 9, 11, 13, 17, 19, 1, 3, 7, 9)) for i in range(20)]])
def test_candidate_keys_match_brute_force(spark, data):
    names = list("abcdefghijkl")[: len(data[0])]
    df = spark.createDataFrame(data, names)
    found = discovery.candidate_keys(df, 0.5, 0.99).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == brute_force_keys(data, names, 0.5, 0.99)
    assert [r[2] for r in found] == sorted((r[2] for r in found), reverse=True)


def counted_one_by_one(monkeypatch):
    seen, count = [], discovery._distinct_counts
    monkeypatch.setattr(discovery, "_distinct_counts", lambda df, combos: (seen.extend(combos), count(df, combos))[1])
    return seen


def test_pairs_share_one_grouping_per_column(spark, monkeypatch):
    names, data = list("abcd"), [(i // 2, (i + 1) // 2, i if i % 3 else i - i % 2, None if i % 7 == 0 else i // 2) for i in range(60)]
    seen = counted_one_by_one(monkeypatch)
    found = discovery.candidate_keys(spark.createDataFrame(data, names), 0.4, 1.1, names).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == brute_force_keys(data, names, 0.4, 1.1)
    assert max(map(len, seen)) == 1


@pytest.mark.parametrize("crowd", [1_000, 0])
def test_large_groups_are_counted_one_by_one(spark, monkeypatch, crowd):
    start = datetime.date(2020, 1, 1)
    data = [(f"s{i * 7 % 25}", i * 3 % 29 + 0.5, start + datetime.timedelta(i * 11 % 23), None if i % 9 == 0 else i * 5 % 31, None if i < 20 else f"t{i}")
            for i in range(40)]
    monkeypatch.setattr(discovery, "LEAST_CROWD", crowd)
    seen, names = counted_one_by_one(monkeypatch), list("abcde")
    found = discovery.candidate_keys(spark.createDataFrame(data, "a string, b double, c date, d int, e string"), 0.5, 1.1).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == brute_force_keys(data, names, 0.5, 1.1)
    assert len(found) == 25 and (sum(len(c) > 1 for c in seen) == 20) == (crowd == 0)


def test_no_keys_in_empty_table(spark):
    assert discovery.candidate_keys(spark.createDataFrame([], "a int")).count() == 0


def test_key_coverage(spark, rows):
    keys = spark.createDataFrame([("id", 1, 1.0), ("a, b", 2, 0.9), ("x", 1, 0.8)],
                                 "key_columns string, key_size int, uniqueness_ratio double")
    declared = spark.createDataFrame([("id", "unique"), ("id", "not_null"), ("a", "not_null")],
                                     "column_name string, check_name string")
    assert rows(discovery.key_coverage(keys, declared), "key_columns", "covered", "missing_checks") == [
        ("a, b", False, "not_null on b, unique_combination_of_columns"), ("id", True, ""), ("x", False, "unique, not_null")]


@pytest.mark.parametrize("counts, kind, fan", [
    ((10, 10, 10, 10), "1:1", False), ((20, 10, 40, 20), "1:M", True), ((5, 10, 20, 20), "M:1", False),
    ((10, 10, 100, 20), "M:M", True), ((0, 0, 0, 0), "1:1", False)])
def test_cardinality_labels(spark, counts, kind, fan):
    df = spark.createDataFrame([counts], "left_distinct bigint, right_distinct bigint, result_rows bigint, left_rows bigint")
    found = discovery.classify_cardinality(df).collect()[0]
    assert (found["cardinality"], found["fan_out"]) == (kind, fan)


def test_join_cardinality_counts(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (3,), (None,)], "r int")
    found = discovery.join_cardinality(left, right, {"k": "r"}).collect()[0]
    assert found[:4] == (2, 2, left.join(right, left.k == right.r).count(), 4)
