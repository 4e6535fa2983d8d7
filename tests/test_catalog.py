"""Catalog coverage, search, scores and lineage audits."""

from __future__ import annotations

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from cairn.operators import catalog as c
from cairn.operators import lineage


def brute_force_fuzzy(texts, keywords, cutoff, all_words):
    def hit(text, k):
        if " " in k or len(k) <= 3 or k in text:
            return k in text
        words = {w for w in re.findall("[a-z0-9]+", text) if len(w) > 3}
        return any(difflib.SequenceMatcher(None, w, k).ratio() >= cutoff for w in words)

    return sorted(i for i, t in texts if (all if all_words else any)(hit(t.lower(), k.lower()) for k in keywords))


@pytest.mark.parametrize("all_words", [False, True])
@pytest.mark.parametrize("keywords", [["reservation"], ["Reservations", "park"], ["is", "trail head"], ["ticket", "tikcets"]])
def test_fuzzy_search_matches_brute_force(spark, keywords, all_words):
    rng = random.Random(11)
    vocabulary = ["reservation", "reservatoin", "reserve", "park", "parks", "perk", "ticket", "tickets", "tikcet", "trail",
                  "head", "is", "reservat1on", "spark", "Reservations"]
    texts = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 6)))) for i in range(80)]
    df = spark.createDataFrame(texts, "entity int, text string")
    found = c.search_fuzzy(df, keywords, ["text"], 0.8, all_words)
    assert found.columns == df.columns
    assert sorted(r["entity"] for r in found.collect()) == brute_force_fuzzy(texts, keywords, 0.8, all_words)


def test_exact_search(spark, rows):
    df = spark.createDataFrame([("Park", "name", None), ("Park", "acres", "Total size"), ("Case", "title", "Size of NAME")],
                               "entity string, attribute string, description string")
    fields = ["entity", "attribute", "description"]
    assert rows(c.search_exact(df, ["name", "size"], fields), "attribute") == [("acres",), ("name",), ("title",)]
    assert rows(c.search_exact(df, ["name", "size"], fields, all_words=True), "attribute") == [("title",)]
    assert rows(c.search_exact(df, ["name"], fields, entity="PARK"), "attribute") == [("name",)]
    assert [tuple(r) for r in c.entity_ranking(c.search_exact(df, ["e"], fields)).collect()] == [("Park", 2), ("Case", 1)]
    with pytest.raises(ValueError):
        c.search_exact(df, [], fields)


def python_tokens(text):
    words = set(re.findall("[a-z]+", text.lower()))
    stems = {w[:-len(s)] for w in words for s, n in (("s", 3), ("ing", 5), ("tion", 6)) if w.endswith(s) and len(w) > n}
    return words | stems


@pytest.mark.parametrize("text", ["Parks and camping reservation", "gas bus is", "ring bring testing nation", "A-B 12c", ""])
def test_tokens(spark, text):
    found = spark.range(1).select(c.tokens(F.lit(text)).alias("t")).collect()[0]["t"]
    assert len(found) == len(set(found)) and set(found) == python_tokens(text)


def test_first_synonym_wins_even_with_lower_score(spark, rows):
    synonyms = spark.createDataFrame([
        ("camp site booking", "Visit", "first", 1), ("campsite", "Asset", "x", 2), ("booking", "Visit", "later", 3)],
        "synonym string, entity string, note string, position int")
    n = len(python_tokens("camp site booking"))
    score = round(len(python_tokens("booking")) / n * 0.9, 3)
    assert rows(c.synonym_match(["Booking", "nothing"], synonyms)) == [("Booking", "Visit", score, "first")]


def test_equal_phrase_scores_one(spark, rows):
    synonyms = spark.createDataFrame([(" Park ", "Asset", "n", 1)], "synonym string, entity string, note string, position int")
    assert rows(c.synonym_match(["park"], synonyms), "entity", "synonym_score") == [("Asset", 1.0)]


def brute_force_synonyms(concepts, synonyms):
    found = {}
    for concept in set(concepts):
        ct = python_tokens(concept)
        for syn, entity, note, _ in sorted(synonyms, key=lambda r: r[3]):
            phrase, st = syn.lower().strip(), python_tokens(syn.lower().strip())
            if concept.lower().strip() == phrase:
                score = 1.0
            elif ct & st:
                score = round(len(ct & st) / max(len(ct), len(st)) * 0.9, 3)
            else:
                continue
            found.setdefault((concept, entity), (score, note))
    return sorted((c, e, s, n) for (c, e), (s, n) in found.items())


def test_synonyms_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["park", "parks", "camping", "camp", "site", "42", "reservation", "Ticket", "visit"]
    phrases = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 3))) for _ in range(60)] + ["42", "42 "]
    synonyms = [(p, rng.choice("ABC"), f"n{i}", i) for i, p in enumerate(phrases)]
    concepts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 3))) for _ in range(40)] + ["42"]
    found = c.synonym_match(concepts, spark.createDataFrame(synonyms, "synonym string, entity string, note string, position int"))
    assert sorted(tuple(r) for r in found.collect()) == brute_force_synonyms(concepts, synonyms)


def test_description_and_combined_score(spark, rows):
    entities = spark.createDataFrame([("Asset", "A park"), ("Visit", "visit to a park"), ("Case", "none")],
                                     "entity string, description string")
    described = c.description_match(["park visit"], entities)
    assert rows(described, "entity", "description_score") == [("Asset", 0.4), ("Visit", 0.8)]
    synonyms = spark.createDataFrame([("park visit", "Asset", 1.0)], "concept string, entity string, synonym_score double")
    found = c.combined_score(synonyms, described, column_bonus=0.5)
    assert rows(found, "entity", "final_score") == [("Asset", 0.77), ("Visit", 0.24)]


def test_coverage_report(spark, rows):
    crosswalk = spark.createDataFrame([("int_a", "Park", "name"), ("int_a", "Park", "name"), ("int_a", "Park", ""),
                                       ("int_b", "Nope", "x"), ("int_c", "Case", "t")], "model string, entity string, mapped_column string")
    catalog = spark.createDataFrame([("Park", "name"), ("Park", "acres")] + [("Case", f"c{i}") for i in range(3)],
                                    "entity string, column_name string")
    assert rows(c.entity_coverage(crosswalk, catalog), "model", "mapped_columns", "total_columns", "coverage_pct", "coverage_status") == [
        ("int_a", 1, 2, 50.0, c.ABOVE), ("int_b", 1, None, None, c.NO_ENTRY), ("int_c", 1, 3, 33.3, c.BELOW)]


def test_candidates_ignore_technical_columns(spark):
    columns = spark.createDataFrame([("Name",), ("parks_sk",), ("_park_sk",), ("park_id",), ("acres",)], "column_name string")
    catalog = spark.createDataFrame([("Park", "name"), ("Park", "acres"), ("Case", "name"), ("Case", "park_id"), ("Case", "z"), ("No", "z")],
                                    "entity string, column_name string")
    found = [tuple(r) for r in c.entity_candidates(columns, catalog).collect()]
    assert found == [("Park", 2, 2, 100.0, False), ("Case", 3, 1, 33.3, True)]


def test_lineage_audits(spark, rows):
    nodes = spark.createDataFrame([(f"model.p.{n}", n, "model") for n in ("fct_a", "dim_b", "stg_c", "stg_d", "int_e")]
                                  + [("seed.p.fct_s", "fct_s", "seed")], "unique_id string, name string, resource_type string")
    edges = spark.createDataFrame([
        ("model.p.int_e", "model.p.fct_a", 1), ("model.p.stg_c", "model.p.fct_a", 1), ("model.p.int_e", "model.p.dim_b", 2),
        ("source.p.s.t", "model.p.stg_c", 1), ("model.p.base_x", "model.p.stg_c", 1),
        ("model.p.stg_c", "model.p.stg_d", 1), ("model.p.int_e", "model.p.stg_d", 1)], "parent string, child string, distance int")
    assert rows(lineage.facts_without_integration(nodes, edges), "resource_name") == [("dim_b",)]
    assert rows(lineage.marts_on_staging(nodes, edges), "resource_name") == [("fct_a",)]
    assert rows(lineage.staging_off_source(nodes, edges), "resource_name") == [("stg_d",)]
