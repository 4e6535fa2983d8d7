"""Joins, deduplication and reshaping on tiny frames."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cairn.functions import clean_string
from cairn.operators import aggregates, dedup, filters, joins, reshape

D = dt.date


def test_left_lookup_keeps_rows_and_null_keys(spark, rows):
    facts = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", 10), (None, 99)], "k string, v int")
    assert rows(joins.left_lookup(facts, dim, ["k"])) == [(1, "a", 10), (2, None, None), (3, "z", None)]


@pytest.mark.parametrize("salts", [1, 2, 7])
def test_salted_lookup_equals_plain_lookup(spark, rows, salts):
    rng = random.Random(5)
    data = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", None]), i % 2) for i in range(200)]
    facts = spark.createDataFrame(data, "id int, k string, g int")
    dim = spark.createDataFrame([("hot", 1), ("a", 2)], "dk string, v int")
    expected = sorted((i, k, g, {"hot": 1, "a": 2}.get(k)) for i, k, g in data)
    found = joins.left_lookup(facts, dim, {"k": "dk"}, ["v"], salts=salts).collect()
    assert sorted(tuple(r) for r in found) == expected


def test_hot_key_join_is_split_at_run_time(spark, capsys):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 60000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("pad"))
        dim = spark.range(0, 60000).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("v"))
        joined = joins.left_lookup(facts, dim, {"k": "dk"}, ["v"])
        assert joined.agg(F.count("*"), F.count("v")).collect()[0][:] == (60000, 60000)
        joined.collect()
        joined.explain()
        assert "skew=true" in capsys.readouterr().out
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_first_per_key_is_limited_before_the_shuffle(spark, capsys):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    dedup.latest_per_key(df, ["k"], [F.desc_nulls_last("id")]).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_merge_aggregates_equals_join_chain(spark, rows):
    a = spark.createDataFrame([("p", 1, 5), ("q", 1, 6), (None, 1, 7)], "k string, m int, x int")
    b = spark.createDataFrame([("p", 1, 50), (None, 1, 70), ("r", None, 80)], "k string, m int, y int")
    merged = joins.merge_aggregates([a, b], ["k", "m"])
    keys = joins.full_outer(a, b, ["k", "m"]).select("k", "m")
    chained = joins.attach_to_keys(keys, [a, b], ["k", "m"])
    assert rows(merged, "k", "m", "x", "y") == rows(chained, "k", "m", "x", "y")
    assert rows(merged, "k", "m", "x", "y").count((None, 1, None, None)) == 2


def test_merge_aggregates_null_safe_keeps_measures(spark, rows):
    a = spark.createDataFrame([("p", 5), (None, 7)], "k string, x int")
    b = spark.createDataFrame([(None, 70)], "k string, y int")
    assert rows(joins.merge_aggregates([a, b], ["k"], null_safe=True)) == [("p", 5, None), (None, 7, 70)]
    one = joins.merge_aggregates([a, b], ["k"], separate_null_keys=False)
    assert rows(one) == [("p", 5, None), (None, None, None)]


def test_nights_exclude_departure_and_follow_the_calendar(spark, rows):
    stays = spark.createDataFrame([
        (1, D(2024, 1, 1), D(2024, 1, 3)), (2, D(2024, 1, 2), D(2024, 1, 2)), (3, None, D(2024, 1, 9)),
        (4, D(2024, 1, 4), D(9999, 1, 1)), (5, D(1900, 1, 1), D(2024, 1, 2))], "id int, a date, b date")
    days = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 4, 5)], "full_date date")
    found = rows(joins.nights_on_site(stays, "a", "b", days), "id", "full_date")
    assert found == [(1, D(2024, 1, 1)), (1, D(2024, 1, 2)), (4, D(2024, 1, 4)), (4, D(2024, 1, 5)), (5, D(2024, 1, 1))]


def test_orphans_count_null_keys(spark, rows):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "id int, k string")
    parent = spark.createDataFrame([("a",), ("a",)], "p string")
    assert rows(joins.orphans(child, parent, {"k": "p"}), "id") == [(2,), (3,)]


def test_value_match_never_multiplies_rows(spark, rows):
    ledger = spark.createDataFrame([(1, "A", 5), (2, "A", 6)], "id int, acct string, amt int")
    paid = spark.createDataFrame([("A", 5, "v1"), ("A", 5, "v9"), ("A", 5, None)], "acct string, amt int, vendor string")
    assert rows(joins.match_on_value(ledger, paid, ["acct", "amt"], "vendor")) == [(1, "A", 5, "v9"), (2, "A", 6, None)]


def test_first_match_prefers_latest_and_puts_null_last(spark, rows):
    left = spark.createDataFrame([("f",)], "fund string")
    awards = spark.createDataFrame([("f", "a1", None), ("f", "a3", D(2020, 1, 1)), ("f", "a2", D(2020, 1, 1))],
                                   "code string, award string, ends date")
    order = [F.desc_nulls_last("ends"), F.asc_nulls_last("award")]
    assert rows(joins.lookup_first(left, awards, {"fund": "code"}, order, ["award"])) == [("f", "a2")]


def test_compare_totals(spark, rows):
    a = spark.createDataFrame([(10.004,)], "x double")
    b = spark.createDataFrame([(10.0,)], "y double")
    assert rows(joins.compare_totals(a, b, {"x": "y"})) == []
    assert rows(joins.compare_totals(a, b, {"x": "y"}, digits=3)) == [(10.004, 10.0)]


def test_golden_record_mixes_attributes_and_prefers_source(spark, rows):
    df = spark.createDataFrame([
        ("9", "Pine Park.", "AST", None, "x"), ("5", "Pine Park", "REV", 3.0, "a"), ("7", "Pine Park!", "GEO", 1.0, None),
        ("1", "pine park", "REV", 9.0, "q")], "sk string, name string, src string, acres double, cls string")
    merged = dedup.golden_record(df, clean_string("name"), ["acres", "cls"], "src", ["GEO"], ["sk"])
    assert rows(merged, "sk", "name", "acres", "cls") == [("1", "pine park", 9.0, "q"), ("7", "Pine Park!", 3.0, "x")]
    folded = dedup.golden_record(df, clean_string("name", fold_case=True), ["acres"], "src", ["GEO"], ["sk"])
    assert rows(folded, "sk", "acres") == [("7", 9.0)]


def test_prefer_source_equals_golden_pick(spark, rows):
    df = spark.createDataFrame([("2", "A", "REV"), ("1", "A", "REV"), ("3", "B", "GEO"), ("0", "B", "REV")],
                               "sk string, name string, src string")
    assert rows(dedup.prefer_source(df, ["name"], "src", ["GEO"], ["sk"])) == [("1", "A", "REV"), ("3", "B", "GEO")]


def test_exact_duplicates_keep_one(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "k string, v string")
    assert rows(dedup.drop_exact_duplicates(df, ["k"])) == [("a", None), ("b", "x")]


def test_live_rows_drop_null_flags(spark, rows):
    df = spark.createDataFrame([(1, False), (2, True), (3, None)], "id int, is_deleted boolean")
    assert rows(filters.live_rows(df), "id") == [(1,)]


def test_unpivot_and_spine(spark, rows):
    df = spark.createDataFrame([("w", 1, None, 3, 4)], "id string, b20 int, a20 int, b21 int, a21 int")
    long = reshape.unpivot_groups(df, ["id"], "y", {2020: {"b": "b20", "a": "a20"}, 2021: {"b": "b21", "a": "a21"}})
    assert rows(long) == [("w", 2020, 1, None), ("w", 2021, 3, 4)]
    spine = reshape.date_spine(spark, "2010-01-01", "2030-12-31")
    assert spine.count() == 7669
    assert spine.agg(F.max("date_day")).collect()[0][0] == D(2030, 12, 30)


def test_spine_of_empty_table_is_empty(spark):
    df = spark.createDataFrame([], "d date")
    assert reshape.spine_of(df, "d").count() == 0


def test_union_conformed_pads_and_casts(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2, 7)], "id int, size int")
    target = spark.createDataFrame([], "id bigint, name string, size int").schema
    found = reshape.union_conformed([a, b], target)
    assert found.schema == target and rows(found) == [(1, "x", None), (2, None, 7)]


def test_totals_of_nothing_are_zero(spark, rows):
    df = spark.createDataFrame([], "x int")
    assert rows(aggregates.totals(df, total=F.sum("x"))) == [(0,)]
