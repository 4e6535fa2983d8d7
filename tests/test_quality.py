"""Checks: violations, scopes, summaries, contracts, freshness."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.operators import quality as q


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a@x.org", "new", 5, 1), (2, None, "old", 7, 9), (2, "nobody", "odd", None, 3), (None, "b@y.org", None, 11, 11)],
        "id int, email string, status string, a int, b int")


@pytest.mark.parametrize("check, bad", [
    (q.not_null("id"), 1), (q.unique("id"), 1), (q.accepted_values("status", ["new", "old"]), 1),
    (q.between("a", 6, 10), 2), (q.between("a", high=10), 1), (q.match_regex("email", r"^[^@]+@[^@]+\.[^@]+$"), 1),
    (q.pair_greater("a", "b"), 2), (q.pair_greater("a", "b", or_equal=True), 1),
    (q.not_null_where("email", F.col("status") == "new"), 0), (q.unique_combination("id", "email"), 0),
    (q.row_count_between(1, 4), 0), (q.row_count_between(5), 1), (q.max_between("a", 0, 10), 1)])
def test_violation_counts(people, check, bad):
    assert check.violations(people).count() == bad
    assert check.count(people).collect()[0]["violations"] == bad


def test_relationships_skip_null_keys(spark, people):
    parents = spark.createDataFrame([(1,), (1,)], "pid int")
    assert q.relationships("id", parents, "pid").violations(people).count() == 2


def test_row_count_equals_guards_fan_out(people):
    assert q.row_count_equals(people).violations(people).count() == 0
    assert q.row_count_equals(people.limit(2)).violations(people).count() == 1


def test_scope_and_severity(people):
    check = q.not_null("email").when(F.col("id") == 2).warn()
    summary = q.summarize(people, "people", [check, q.unique("id")])
    found = {(r.check_name, r.severity, r.violations) for r in summary.collect()}
    assert found == {("not_null", "warn", 1), ("unique", "error", 1)}
    assert [r.check_name for r in q.failed(summary).collect()] == ["unique"]


def test_summary_scans_once_for_all_row_checks(people, capsys):
    checks = [q.not_null("id"), q.not_null("email"), q.between("a", 0, 9), q.accepted_values("status", ["new"])]
    q.summarize(people, "people", checks).explain()
    assert capsys.readouterr().out.count("Scan ") == 1


def test_contract(spark, people):
    schema = people.schema
    assert q.enforce_contract(people.select("b", "a", "status", "email", "id"), schema).schema.names == schema.names
    with pytest.raises(q.ContractError, match="missing a.*undeclared extra"):
        q.enforce_contract(people.drop("a").withColumn("extra", F.lit(1)), schema)
    with pytest.raises(q.ContractError, match="id is bigint, declared int"):
        q.enforce_contract(people.withColumn("id", F.col("id").cast("bigint")), schema)


def test_column_diff(people, rows):
    assert rows(q.column_diff(people, ["id", "email", "status", "a", "c"])) == [
        ("b", "present only"), ("c", "declared only")]


def test_freshness(spark, rows):
    now = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    fresh = spark.createDataFrame([(dt.datetime(2024, 1, 9, 18),)], "t timestamp_ntz")
    old = spark.createDataFrame([(dt.datetime(2024, 1, 8),), (None,)], "t timestamp_ntz")
    empty = spark.createDataFrame([], "t timestamp_ntz")
    found = q.freshness({"fresh": (fresh, "t", 12, 24), "late": (old, "t", 12, 72), "old": (old, "t", 12, 24),
                         "empty": (empty, "t", 12, 24)}, now)
    assert rows(found, "table_name", "status") == [("empty", "error"), ("fresh", "pass"), ("late", "warn"), ("old", "error")]


def test_balance(spark, rows):
    fact = spark.createDataFrame([(10.0,), (5.0,)], "v double")
    report = spark.createDataFrame([(15.0, 1.0)], "r double, p double")
    ok = {"res": (fact, "v")}
    assert rows(q.balance_check(ok, report, {"res": "r"})) == []
    assert q.balance_check(ok, report, {"res": "p"}).count() == 1


def test_reconcile_and_conformance(spark, rows):
    parks = spark.createDataFrame([("1", "X-REV-01"), ("2", "X-REV-01"), ("2", "X-GEO-01")], "n string, s string")
    assert rows(q.reconcile_ids(parks, "n", "s", "%REV%", "%GEO%")) == [("1",)]
    columns = spark.createDataFrame([("Name",), ("park_id",), ("parks_sk",), ("odd",)], "column_name string")
    catalog = spark.createDataFrame([("Park", "name"), ("Other", "odd")], "entity string, column_name string")
    assert rows(q.entity_conformance(columns, catalog, "Park")) == [("odd",)]


def test_accepted_values_count_alike_everywhere(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "v string")
    check = q.accepted_values("v", ["a"])
    assert check.count(df).first()["violations"] == 2 == q.summarize(df, "t", [check]).first()["violations"]
