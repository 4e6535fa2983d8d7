"""Lineage closure, sweep line, unpacked lists, pruned key search, validated detectors and fields of JSON documents against plain versions."""

from __future__ import annotations

import csv
import datetime as dt
import difflib
import json
import random
import re
from collections import defaultdict
from itertools import combinations, groupby

import pytest
from pyspark.sql import functions as F

from cairn.functions import json_fields_guarded, json_text_guarded
from cairn import sources
from cairn.operators import aggregates, catalog, discovery, joins, lineage, lists, pii, sweep
from cairn.plans import metrics


def shortest_paths(edges):
    """Breadth first from every node, smallest path first."""
    after = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None:
            after[a].add(b)
    out = {}
    for start in list(after):
        seen, level = {}, {n: [start, n] for n in after[start]}
        while level:
            seen |= {n: (len(p) - 1, p) for n, p in level.items()}
            following = {}
            for n, p in level.items():
                for m in after.get(n, ()):
                    if m not in seen:
                        following[m] = min(following.get(m, [*p, m]), [*p, m])
            level = following
        out |= {(start, n): found for n, found in seen.items()}
    return out


def test_closure_of_a_graph_with_cycles_and_a_long_chain(spark):
    random.seed(1)
    edges = [(f"n{random.randrange(40):02}", f"n{random.randrange(40):02}") for _ in range(60)]
    edges += [(f"c{i:02}", f"c{i + 1:02}") for i in range(37)] + [("x", "y"), ("y", "x"), ("z", "z"), ("x", "y"), (None, "x"), ("x", None)]
    got = lineage.closure(spark.createDataFrame(edges, "parent string, child string")).collect()
    want = shortest_paths(edges)
    assert len(got) == len(want) and {(r.parent, r.child): (r.distance, r.path) for r in got} == want
    assert want["x", "x"] == (2, ["x", "y", "x"]) and want["z", "z"][0] == 1 and want["c00", "c37"][0] == 37
    assert lineage.closure(spark.createDataFrame([], "parent string, child string")).count() == 0


def test_running_sums_of_a_hot_key_carry_over_partitions(spark):
    random.seed(2)
    rows = [("hot", t, random.randint(-5, 5)) for t in range(3000)] + [(k, t, t) for k in ("a", None) for t in range(20)]
    frame = spark.createDataFrame(rows, "k string, at int, v int").repartition(3)
    got = sweep.running_sums(frame, ["k"], "at", {"total": "v"}, "then").collect()
    want, total = {}, defaultdict(int)
    for k, t, v in sorted(rows, key=lambda r: r[1]):
        total[k] += v
        want[k, t] = total[k]
    assert {(r.k, r.at): r.total for r in got} == want and len(got) == len(rows)
    assert all(r.then == (r.at + 1 if (r.k, r.at + 1) in want else None) for r in got)


DAY = dt.date(2020, 1, 1)
STAY = "park string, unit int, arrival date, departure date"


def stays():
    random.seed(3)
    out = [(random.choice(["A", "B", None]), random.randrange(9), DAY + dt.timedelta(a := random.randrange(200)), DAY + dt.timedelta(a + random.randrange(-2, 12)))
           for _ in range(400)]
    return [*out, ("A", 1, DAY, DAY + dt.timedelta(365 * 50)), ("A", 2, None, DAY), ("B", 2, DAY, None)]


def units():
    return [(p, u, DAY + dt.timedelta(5 * u), DAY + dt.timedelta(300)) for p in ("A", "B", None) for u in range(6)]


def expanded(rows):
    out = defaultdict(set)
    for park, unit, a, b in rows:
        for k in range(max((b - a).days, 0) if a and b else 0):
            out[park, a + dt.timedelta(k)].add(unit)
    return out


def test_occupancy_equals_the_expanded_form(spark):
    level = metrics.occupancy_levels(spark.createDataFrame(stays(), STAY), spark.createDataFrame(units(), STAY), ["park"], "unit", "arrival", "departure")
    taken, free = expanded(stays()), expanded(units())
    want = {key: (len(taken[key]), len(free[key])) for key in set(taken) | set(free)}
    daily = metrics.occupancy_daily(level, ["park"], "arrival", "departure").collect()
    assert {(r.park, r.occupancy_date): (r.occupied_units, r.available_units) for r in daily} == want and len(daily) == len(want)
    assert all(r.occupancy_rate == (round(r.occupied_units / r.available_units, 4) if r.available_units else None) for r in daily)
    months = defaultdict(lambda: [0, 0])
    for (park, day), (o, a) in want.items():
        months[park, day.replace(day=1)][0] += o
        months[park, day.replace(day=1)][1] += a
    monthly = metrics.occupancy_monthly(level, ["park"], "arrival", "departure").collect()
    assert {(r.park, r.month): [r.occupied_nights, r.available_nights] for r in monthly} == dict(months)


def test_a_long_stay_is_one_stretch(spark):
    long = spark.createDataFrame([("A", 1, DAY, DAY + dt.timedelta(365 * 50))], STAY)
    row, = sweep.levels(long, ["park"], "arrival", "departure", {"n": F.lit(1)}).collect()
    assert row[:] == ("A", DAY, DAY + dt.timedelta(365 * 50), 1)
    assert sweep.levels(long.limit(0), ["park"], "arrival", "departure", {"n": F.lit(1)}).count() == 0


def test_backlog_equals_the_latest_values_of_every_day(spark):
    random.seed(4)
    day = lambda: DAY + dt.timedelta(random.randrange(60))
    costs = [(f"B{k:03}", f"a{random.randrange(12)}", random.randrange(100) / 4, day()) for k in range(120)]
    scores = [(f"S{k:03}", f"a{random.randrange(12)}", random.choice([20, 60, 69, 70, 90]), day()) for k in range(120)]
    assets = [(f"a{k}", k % 3) for k in range(12)]
    got = metrics.maintenance_backlog(
        spark.createDataFrame(costs, "backlog_id string, asset_tag string, estimated_repair_cost double, calculation_date date"),
        spark.createDataFrame(scores, "assessment_id string, asset_tag string, fci_score int, inspection_date date"),
        spark.createDataFrame(assets, "asset_tag string, park_id int"), spark.createDataFrame([(0, 1), (1, 2)], "park_id int, region_id int")).collect()

    def latest(rows, asset, until):
        return max(((d, i, v) for i, a, v, d in rows if a == asset and d <= until), default=(None, None, None))[2]

    want, before = {}, {}
    for k in range(60):
        until = DAY + dt.timedelta(k)
        for park in range(3):
            held = [latest(costs, a, until) for a, p in assets if p == park and (latest(scores, a, until) or 70) < 70]
            now = (sum(v for v in held if v is not None), sum(v is not None for v in held))
            if now != before.get(park, (0, 0)):
                want[park, until] = now
            before[park] = now
    assert {(r.park_id, r.changed_on): (float(r.backlog_cost), r.backlog_assets) for r in got} == want
    assert {(r.park_id, r.region_id) for r in got} == {(0, 1), (1, 2), (2, None)}


def test_list_items_in_order_with_quotes_and_malformed_ones(spark):
    cases = {'a, b': [("a", False), ("b", False)], '"Hill, J.",, c ': [("Hill, J.", False), ("", False), ("c", False)], '"say ""hi""",x': [('say "hi"', False), ("x", False)],
             'a,"open, rest': [("a", False), ('"open', True), ("rest", False)], '"a"b,c': [("a", False), ("b", True), ("c", False)], ",": [("", False), ("", False)],
             'x"y': [("x", False), ('"y', True)], "": [], None: [], "é": [("é", False)], '"' + "long, " * 5000 + '"': [(("long, " * 5000), False)]}
    df = spark.createDataFrame(list(enumerate(cases)), "k int, xs string")
    got = defaultdict(list)
    for r in sorted(lists.unpack_list(df, "xs", ["k"]).collect()):
        assert r.position == len(got[r.k]) + 1
        got[r.k].append((r.value, r.malformed))
    assert [got[k] for k in range(len(cases))] == list(cases.values())
    with pytest.raises(ValueError):
        lists.item_pattern('"')


def test_list_items_equal_the_csv_reader(spark):
    random.seed(5)
    texts = [",".join(random.choice(["a", '"b, c"', '"d ""e"""', "", "f g"]) for _ in range(random.randint(1, 6))) for _ in range(200)]
    texts = [t for t in texts if t]
    got = defaultdict(list)
    for r in sorted(lists.unpack_list(spark.createDataFrame(list(enumerate(texts)), "k int, xs string"), "xs", ["k"]).collect()):
        assert not r.malformed
        got[r.k].append(r.value)
    assert [got[k] for k in range(len(texts))] == list(csv.reader(texts))


def test_records_and_reconciliation(spark):
    memos = {1: "I1|1.50|x|I2|2.00|y|", 2: "I1|1.50|x|I2|2.", 3: 'I1|1.00|"a | b"|', 4: None, 5: "I1|9|", 6: "I1|zero|x"}
    df = spark.createDataFrame([(k, t, 3.5) for k, t in memos.items()], "k int, memo string, amount double").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    lines = lists.unpack_records(df, "memo", ["k"], ["no", "part", "note"]).withColumn("part", F.col("part").try_cast("decimal(10,2)"))
    got = sorted((r.k, r.position, r.no, None if r.part is None else float(r.part), r.note, r.malformed) for r in lines.collect())
    assert got == [(1, 1, "I1", 1.5, "x", False), (1, 2, "I2", 2.0, "y", False), (2, 1, "I1", 1.5, "x", False), (2, 2, "I2", 2.0, None, True),
                   (3, 1, "I1", 1.0, "a | b", False), (5, 1, "I1", 9.0, "", False), (6, 1, "I1", None, "x", False)]
    sums = {r.k: (r.n_records, r.n_malformed, float(r.difference)) for r in lists.reconcile(df, lines, "k", "amount", "part").collect()}
    assert sums == {1: (2, 0, 0.0), 2: (2, 1, 2.0), 3: (1, 0, 2.5), 4: (0, 0, 3.5), 5: (1, 0, -5.5), 6: (1, 0, 3.5)}


def test_patterns_are_for_quoted_texts_only(spark):
    random.seed(7)
    parts = ["a", " b ", "", " ", "\n", "é", "|", "|", '"c"', ' "d | e" ', '"f ""g"""', '"open', "x\"", "\t"]
    texts = ["".join(random.choice(parts[:8] if n % 2 else parts) for _ in range(random.randint(0, 9))) for n in range(400)] + [None, "", "|", "\n", '"']
    df = spark.createDataFrame(list(enumerate(texts)), "k int, xs string")
    expected = []
    for k, text in enumerate(texts):
        for n, x in enumerate(re.findall(lists.item_pattern("|"), "|" + text) if text else []):
            body = (x[1:] if x.startswith("|") else x).strip(" ")
            quoted, plain = re.search(rf"^\|{lists.QUOTED}$", x), re.search(r'^\|[^"|]*$', x)
            expected.append((k, n + 1, body[1:-1].replace('""', '"') if quoted else body, not (quoted or plain)))
    assert sorted(tuple(r) for r in lists.unpack_list(df, "xs", ["k"], "|").collect()) == expected
    # a text without a quote never meets the patterns, and each text is read once
    records = lists.unpack_records(df, "xs", ["k"], ["a", "b", "c"], "|")
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and "Contains(xs#" in plan and "slice(" not in plan
    every = []
    for k, found in groupby(expected, key=lambda x: x[0]):
        found = [x[2:] for x in found]
        found = found[:-1] if len(found) % 3 == 1 and found[-1][0] == "" else found
        for at in range(0, len(found), 3):
            three = found[at:at + 3]
            every.append((k, at // 3 + 1, *([v for v, _ in three] + [None] * 2)[:3], len(three) < 3 or any(bad for _, bad in three)))
    assert [tuple(r) for r in records.sort("k", "position").collect()] == every


def twelve_columns(spark):
    df = spark.range(4000)
    bit = lambda i: F.floor(F.col("id") / 2**i) % 2
    pick = {f"a{i}": F.col("id") - (F.col("id") % 2) * bit(i) for i in range(1, 7)} | {f"b{i}": F.col("id") - (F.col("id") % 2) * (1 - bit(i)) for i in range(1, 7)}
    return df.select(*[c.alias(n) for n, c in pick.items()], F.lit(None).cast("int").alias("nothing"))


def test_pruned_keys_equal_the_exhaustive_ones(spark):
    df, counted = twelve_columns(spark), {}
    every = discovery.candidate_keys(df).collect()
    assert len(every) == 12 + len(list(combinations(range(12), 2)))
    got = discovery.accepted_keys(df, counted=counted).collect()
    assert sorted(got) == sorted(r for r in every if r.uniqueness_ratio >= 0.99) and {r.key_columns for r in got} == {f"a{i}, b{i}" for i in range(1, 7)}
    assert counted[1] == (13, 12) and counted[2] == (66, 6)
    single = spark.range(100).withColumn("x", F.col("id") % 7)
    assert [r[:] for r in discovery.accepted_keys(single).collect()] == [("id", 1, 1.0)]
    assert discovery.accepted_keys(single.limit(0)).count() == 0


def test_validated_detectors(spark):
    cards = {"4111 1111 1111 1111": True, "4111111111111112": False, "5500-0000-0000-0004": True, "1234567890123456": False}
    df = spark.createDataFrame([(f"pay {c} now", ok) for c, ok in cards.items()], "t string, ok boolean")
    assert all(r.got == r.ok for r in df.select("ok", pii.holds_valid("t", "CREDIT_CARD").alias("got")).collect())
    text = "order 1234567890123456 card 4111111111111111 ip 10.0.0.256 and 10.0.0.25 ssn 000-12-3456 666-12-3456 912-12-3456 123-00-4567 123-45-0000 123-45-6789"
    row = pii.redact(spark.createDataFrame([(text, "1234567890123456", None)], "t string, u string, v string"), ["t", "u", "v"], validated=True).first()
    assert row.t == text.replace("4111111111111111", "[REDACTED:CREDIT_CARD]").replace("10.0.0.25 ", "[REDACTED:IP_ADDRESS] ").replace("123-45-6789", "[REDACTED:US_SSN]")
    assert row.u == "[REDACTED]" and row.v is None
    frame = spark.createDataFrame([("1234567890123456",), ("4111111111111111",), (None,)], "t string")
    assert pii.pii_by_value(frame, validated=True).first().CREDIT_CARD == 1 and pii.pii_by_value(frame).first().CREDIT_CARD == 2


def test_json_fields_come_from_whole_documents_only(spark):
    texts = ['{"a":1,"b":"x"}', '{"a":null}', '{"a":"é","c":[1,2]}', '{"a":{"q":[1, 2]},"b":true}', '{"a":1} x', '{"a":1}]', '{"a":1},{"a":2}', '{"a":1', "", None, "null", "[]", "5",
             '[{"a":1}]', '{"a":1.50,"b":1e3}', '{"A":7}', '  {"a":" s "}  ', '{"b":"\\u00e9\\n"}', "{}", '{"a":1}}', "{'a':1}", '{"a":1,"a":2}',
             '{"a":1}]}', '{"a":1},"a":2', '{"a":1}, 5', '"{}"', '{"a":1} {"a":2}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    one = json_fields_guarded("t", "a", "b")
    got = df.select("t", one["a"].alias("a"), one["b"].alias("b"), json_text_guarded("t", "$.a").alias("x"), json_text_guarded("t", "$.b").alias("y")).collect()
    assert [(r.t, r.a, r.b) for r in got] == [(r.t, r.x, r.y) for r in got]
    whole = {t for t, a, b in ((r.t, r.a, r.b) for r in got) if a is not None or b is not None}
    for t in whole:
        json.loads(t.replace("'", '"'))  # values come from whole documents only
    assert next(r.a for r in got if r.t == '{"a":1,"a":2}') == "1"
    assert {'{"a":1}]}', '{"a":1},"a":2', '{"a":1}, 5'}.isdisjoint(whole) and len(whole) == 8


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_grouping_totals_are_one_scan(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", None, 3), (None, 1, 5)], "k string, j int, v int")
    out = aggregates.grouping_totals(df, [["k", "j"], ["k"], []], {"v": F.sum("v")})
    assert {r[:] for r in out.collect()} == {("a", 1, 0, 2), ("a", None, 0, 3), (None, 1, 0, 5), ("a", None, 1, 5), (None, None, 1, 5), (None, None, 3, 10)}
    assert executed(out).split("== Initial Plan ==")[0].count("Expand") == 1
    assert aggregates.grouping_totals(df.limit(0), [["k"], []], {"v": F.sum("v")}).count() == 0


def test_clustered_tables_join_without_an_exchange(spark):
    left = sources.store_clustered(spark.range(500).withColumn("x", F.col("id") % 7), "left_side", ["id"], 4)
    right = sources.store_clustered(spark.range(0, 500, 5).withColumnRenamed("id", "k"), "right_side", ["k"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = left.join(right, left["id"] == right["k"])
        assert joined.count() == 100 and "Exchange" not in executed(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_stored_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "parts")
    sources.store_partitions(spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "v int, p string"), path, ["p"])
    out = sources.store_partitions(spark.createDataFrame([(9, "b"), (8, "c")], "v int, p string"), path, ["p"])
    assert {r[:] for r in out.collect()} == {(1, "a"), (9, "b"), (8, "c")}


def test_hot_keys_are_spread_without_adaptive_planning(spark):
    facts = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).cast("long").alias("k")).unionAll(
        spark.createDataFrame([(-1, None)], "id long, k long"))
    dim = spark.range(300).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    hot = joins.hot_keys(facts, "k", 0.1)
    assert hot == [7] and joins.hot_keys(facts.limit(0), "k", 0.1) == []
    before = {c: spark.conf.get(c, None) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plain, salted = joins.left_lookup(facts, dim, {"k": "key"}, ["name"]), joins.hot_lookup(facts, dim, ("k", "key"), ["name"], hot)
        assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))
        largest = [df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] for df in (plain, salted)]
        assert largest[0] > 4500 and largest[1] < 3700
    finally:
        for c, v in before.items():
            spark.conf.set(c, v) if v is not None else spark.conf.unset(c)


def test_bound_of_the_ratio_loses_no_word_and_spares_most(spark):
    random.seed(7)
    keys = ["thereing", "erentions"]
    words = {"".join(random.choices("therinosaz", k=random.randint(4, 12))) for _ in range(4000)} | {"thering", "erention", "therein", *keys}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    kept = {r.word for r in df.where(catalog.in_reach(F.col("word"), keys, 0.8)).collect()}
    similar = {w for w in words if any(difflib.SequenceMatcher(None, w, k).ratio() >= 0.8 for k in keys)}
    quick = {w for w in words if any(difflib.SequenceMatcher(None, w, k).quick_ratio() >= 0.8 for k in keys)}
    assert similar <= kept == quick and len(kept) < 0.2 * len(words)


def test_description_scores_equal_those_of_all_tokens(spark):
    texts = ["Testing nations", "nation", "tests ting", "a s ing tion", "Bolts, bolting; Nationals", "", None, "threestion threes", "ings ing"]
    concepts = ["The nation", "test bolt three", "s ing", "tion", "!!"]
    df = spark.createDataFrame(list(enumerate(texts)), "entity int, description string")
    held = {r.entity: set(r.t or []) for r in df.select("entity", catalog.tokens("description").alias("t")).collect()}
    want = {}
    for c in concepts:
        asked = catalog.phrase_tokens(c)
        for e, found in held.items():
            if k := len(found & set(asked)):
                want[c, e] = round(k / len(asked) * catalog.DESCRIPTION_FACTOR, 3)
    assert {(r.concept, r.entity): r.description_score for r in catalog.description_match(concepts, df).collect()} == want


def test_cheap_searches_spare_no_match(spark):
    texts = ["1.2.3.4", "x1.2.3.4", "v1.2.3.4 10.0.0.1", "1234 5678-90123456", "a1234567890123456", "555-123-4567", "5551234567", "x555.123.4567y",
             "123-45-6789", "١٢٣.4.5.6", "a@b.co", "a@b", "no digits", "", None, "1", "12.34.56", "1234567890123456789"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind, pattern in pii.PII_PATTERNS.items():
        assert df.where(~pii.holds("t", kind).eqNullSafe(F.col("t").rlike(pattern))).count() == 0
