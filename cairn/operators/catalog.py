"""Matching tables and business terms to an entity catalog.

A catalog has one row per (entity, column); text searches and scores work on tokens, so
terms meet descriptions word by word. The terms of a search or a score are a short list
given by the caller; the catalog is the table, read once.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions import pct
from cairn.operators.aggregates import count_if, top_n
from cairn.operators.filters import non_blank

# Thresholds, weights, and the word stems of the scores.
COVERAGE_THRESHOLD = 50
NO_ENTRY, ABOVE, BELOW = ("No catalog entry", "Above threshold",
                          "Below threshold — review for CDM exception")
SYNONYM_FACTOR, DESCRIPTION_FACTOR = 0.9, 0.8
SCORE_WEIGHTS = {"synonym_score": 0.6, "description_score": 0.3, "column_bonus": 0.1}
STEMS = {"s": 3, "ing": 5, "tion": 6}
FUZZY_CUTOFF, SHORT_WORD = 0.8, 3
WORD, LETTERS = "[a-z0-9]+", "[a-z]+"


# --- coverage

def catalog_columns(catalog: DataFrame, entity: str, column: str) -> DataFrame:
    """Usable (entity, column_name) rows of a catalog list."""
    return non_blank(catalog, column).select(F.col(entity).alias("entity"), F.col(column).alias("column_name"))


def entity_coverage(crosswalk: DataFrame, catalog: DataFrame) -> DataFrame:
    """How much of its entity each model maps.

    ``crosswalk``: (model, entity, mapped_column); ``catalog``: (entity, column_name).
    """
    mapped = non_blank(crosswalk, "mapped_column").groupBy("model", "entity").agg(
        F.count_distinct("mapped_column").alias("mapped_columns"))
    sizes = catalog.groupBy("entity").agg(F.count("*").alias("total_columns"))
    covered = mapped.join(sizes, "entity", "left").withColumn(
        "coverage_pct", pct("mapped_columns", "total_columns"))
    status = (F.when(F.col("total_columns").isNull(), NO_ENTRY)
              .when(F.col("coverage_pct") >= COVERAGE_THRESHOLD, ABOVE).otherwise(BELOW))
    return covered.select("model", "entity", "mapped_columns", "total_columns", "coverage_pct",
                          status.alias("coverage_status"))


def business_columns(columns: DataFrame) -> DataFrame:
    """Column names that are neither keys nor references, lower-cased and distinct."""
    c = F.lower("column_name")
    technical = c.endswith("_sk") | c.startswith("_") | c.endswith("_id")
    return columns.select(c.alias("column_name")).where(~technical).distinct()


def entity_candidates(columns: DataFrame, catalog: DataFrame, n: int = 10) -> DataFrame:
    """Entities whose columns a table shares, best first; under 50 % carries a warning."""
    wanted = business_columns(columns).withColumn("__hit", F.lit(1))
    grouped = catalog.join(wanted, "column_name", "left").groupBy("entity").agg(
        F.count("*").alias("total_columns"), count_if(F.col("__hit").isNotNull()).alias("matched_columns"))
    ranked = grouped.where(F.col("matched_columns") > 0).withColumn(
        "coverage_pct", pct("matched_columns", "total_columns"))
    best = top_n(ranked, [F.desc("matched_columns"), F.desc("coverage_pct"), F.asc("entity")], n)
    return best.withColumn("below_threshold", F.col("coverage_pct") < COVERAGE_THRESHOLD)


# --- keyword search

def search_text(fields: Sequence[str]) -> Column:
    """Lower-cased text of several fields, NULL as empty."""
    return F.lower(F.concat_ws(" | ", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]))


def _combine(tests: Sequence[Column], all_words: bool) -> Column:
    return reduce(Column.__and__ if all_words else Column.__or__, tests)


def search_exact(catalog: DataFrame, words: Sequence[str], fields: Sequence[str], all_words: bool = False,
                 entity: str | None = None, entity_column: str = "entity") -> DataFrame:
    """Catalog rows whose text contains any (or all) keywords."""
    if not words:
        raise ValueError("search needs at least one keyword")
    rows = catalog.where(_combine([search_text(fields).contains(w.lower()) for w in words], all_words))
    return rows if entity is None else rows.where(F.lower(entity_column) == entity.lower())


def entity_ranking(matches: DataFrame, entity_column: str = "entity") -> DataFrame:
    """Entities by number of matching rows."""
    return matches.groupBy(entity_column).agg(F.count("*").alias("matches")).orderBy(
        F.desc("matches"), F.asc(entity_column))


def similar_words(vocabulary: DataFrame, keywords: dict[str, str], cutoff: float) -> DataFrame:
    """Words that reach the similarity ratio with a keyword, with one flag per keyword.

    ``keywords`` maps keyword to flag name. One Arrow pass over the distinct words; only
    the similar ones come back.
    """
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matchers = {}
        for keyword, flag in keywords.items():
            matchers[flag] = difflib.SequenceMatcher()
            matchers[flag].set_seq2(keyword)

        def reaches(matcher: difflib.SequenceMatcher, word: str) -> bool:
            matcher.set_seq1(word)
            # the two cheaper ratios are upper bounds of the exact one
            return (matcher.real_quick_ratio() >= cutoff and matcher.quick_ratio() >= cutoff
                    and matcher.ratio() >= cutoff)

        for batch in batches:
            for flag, matcher in matchers.items():
                batch[flag] = [reaches(matcher, w) for w in batch["word"]]
            yield batch[batch[list(matchers)].any(axis=1)]

    flags = "".join(f", {flag} boolean" for flag in keywords.values())
    return vocabulary.select("word").where(in_reach(F.col("word"), keywords, cutoff)).mapInPandas(score, f"word string{flags}")


def in_reach(word: Column, keywords: Iterable[str], cutoff: float) -> Column:
    """Can a word reach the similarity ratio with a keyword? Two upper bounds, both in the JVM.

    The ratio is twice the matching characters per characters of both; the shorter word bounds the matches, and so do the
    characters that both words share, counted with repetitions.
    """
    size = F.length(word)

    def ratio(shared: Column, k: str) -> Column:
        return 2.0 * shared / (size + len(k)) >= cutoff

    def shared(k: str) -> Column:
        counts = [F.least(size - F.length(F.replace(word, F.lit(c), F.lit(""))), F.lit(k.count(c))) for c in sorted(set(k))]
        return reduce(Column.__add__, counts)

    return reduce(Column.__or__, [ratio(F.least(size, F.lit(len(k))), k) & ratio(shared(k), k) for k in keywords])


def search_fuzzy(catalog: DataFrame, words: Sequence[str], fields: Sequence[str], cutoff: float = FUZZY_CUTOFF,
                 all_words: bool = False, entity: str | None = None, entity_column: str = "entity") -> DataFrame:
    """Catalog rows whose text contains keywords or words much like them.

    Keywords with a blank or of at most three letters are matched as plain text. For the
    others only words that can reach the ratio by their characters leave a text; their distinct
    vocabulary is compared once per word, and the similar words find their texts by an equality join,
    and texts are told apart by their SHA-256, so copies of a text cost one entry. Nothing
    runs before the result is asked for.
    """
    if not words:
        raise ValueError("search needs at least one keyword")
    keywords = [w.lower() for w in words]
    rows = catalog if entity is None else catalog.where(F.lower(entity_column) == entity.lower())
    text = search_text(fields)
    row_words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    fuzzy = {k: f"__k{i}" for i, k in enumerate(keywords) if " " not in k and len(k) > SHORT_WORD}
    similar = {k: F.lit(False) for k in keywords}
    if fuzzy:
        # tested behind the explode, inside generated code
        possible = (F.length("word") > SHORT_WORD) & in_reach(F.col("word"), fuzzy, cutoff)
        vocabulary = rows.select(F.explode(row_words).alias("word")).where(possible).distinct()
        near = similar_words(vocabulary, fuzzy, cutoff)
        rows = _join_near_words(rows, text, row_words, possible, near, list(fuzzy.values()))
        similar.update({k: F.coalesce(F.col(flag), F.lit(False)) for k, flag in fuzzy.items()})
    tests = [text.contains(k) | similar[k] for k in keywords]
    return rows.where(_combine(tests, all_words)).select(*catalog.columns)


def _join_near_words(rows: DataFrame, text: Column, row_words: Column, possible: Column, near: DataFrame,
                     flags: Sequence[str]) -> DataFrame:
    """Rows with the flags of the similar words they contain."""
    # id and words are computed per row before the words are exploded
    listed = rows.select(F.sha2(text, 256).alias("__id"), row_words.alias("__words"))
    used = listed.select("__id", F.explode("__words").alias("word")).where(possible)
    hits = used.join(near, "word").groupBy("__id").agg(*[F.max(flag).alias(flag) for flag in flags])
    return rows.withColumn("__id", F.sha2(text, 256)).join(hits, "__id", "left")


# --- scores

def tokens(text: Column | str) -> Column:
    """Distinct lower-case words of a text, plus crude stems (``s``, ``ing``, ``tion``)."""
    text = F.col(text) if isinstance(text, str) else text
    words = F.regexp_extract_all(F.lower(text), F.lit(f"({LETTERS})"), F.lit(1))

    def forms(w: Column) -> Column:
        stems = [F.when(w.endswith(end) & (F.length(w) > longer), F.left(w, F.length(w) - len(end)))
                 for end, longer in STEMS.items()]
        return F.array(w, *stems)

    return F.array_distinct(F.array_compact(F.flatten(F.transform(words, forms))))


def phrase_tokens(phrase: str) -> list[str]:
    """The :func:`tokens` of a phrase given by the caller."""
    words = re.findall(LETTERS, phrase.lower())
    stems = [w[:-len(end)] for w in words for end, longer in STEMS.items() if w.endswith(end) and len(w) > longer]
    return sorted({*words, *stems})


def _asked(concepts: Sequence[str]) -> Column:
    """Each concept once, as a row next to every row: ``_.concept``, ``_.phrase``, ``_.tokens``."""
    if not concepts:
        raise ValueError("a score needs at least one concept")
    texts = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    return F.explode(F.array(*[
        F.struct(F.lit(c).alias("concept"), F.lit(c.lower().strip(" ")).alias("phrase"), texts(phrase_tokens(c)).alias("tokens"))
        for c in dict.fromkeys(concepts)])).alias("_")


def synonym_match(concepts: Sequence[str], synonyms: DataFrame) -> DataFrame:
    """Score business concepts against a curated synonym list.

    ``synonyms``: (synonym, entity, note, position). Equal phrases score 1, otherwise shared
    tokens count against the larger token set. Per concept and entity the *first* matching
    synonym in list order decides, even where a later one would score higher. The list is
    read once; firsts are an aggregate, so nothing grows but with the number of entities.
    """
    phrase = F.trim(F.lower("synonym"))
    listed = synonyms.select("entity", "position", "note", phrase.alias("phrase"), tokens(phrase).alias("tokens"), _asked(concepts))
    shared = F.size(F.array_intersect("_.tokens", "tokens"))
    overlap = shared / F.greatest(F.size("_.tokens"), F.size("tokens"))
    equal = F.col("_.phrase") == F.col("phrase")
    scored = listed.where(equal | (shared > 0)).select(
        "_.concept", "entity", "position", F.struct(
            F.when(equal, 1.0).otherwise(F.round(overlap * SYNONYM_FACTOR, 3)).alias("score"), "note").alias("found"))
    first = scored.groupBy("concept", "entity").agg(F.min_by("found", "position").alias("found"))
    return first.select("concept", "entity", F.col("found.score").alias("synonym_score"), "found.note")


def _spellings(token: str) -> list[str]:
    """The words whose :func:`tokens` hold a token: itself, and itself with an ending that is cut off."""
    return [token, *(token + end for end, longer in STEMS.items() if len(token) + len(end) > longer)]


def description_match(concepts: Sequence[str], entities: DataFrame) -> DataFrame:
    """Share of a concept's tokens that occur in an entity's description.

    ``entities``: (entity, description). Every description is scored in place: one scan and
    no shuffle, and at most one row per entity and concept asked for. Only the words that give a
    token asked for are taken from a text, so no array of all its words and stems is built.
    """
    if not concepts:
        raise ValueError("a score needs at least one concept")
    asked = {c: [_spellings(t) for t in phrase_tokens(c)] for c in dict.fromkeys(concepts)}
    wanted = sorted({w for tokens_ in asked.values() for spelt in tokens_ for w in spelt})
    whole_words = f"(?<![a-z])(?:{'|'.join(wanted)})(?![a-z])" if wanted else "(?!)"
    found = F.array_distinct(F.regexp_extract_all(F.lower("description"), F.lit(whole_words), F.lit(0)))
    held = entities.select("entity", found.alias("found")).where(F.size("found") > 0)

    def shared(spelt: list[list[str]]) -> Column:
        return reduce(Column.__add__, [F.arrays_overlap("found", F.array(*map(F.lit, s))).cast("int") for s in spelt], F.lit(0))

    scores = F.array(*[F.struct(F.lit(c).alias("concept"), F.lit(len(spelt)).alias("n"), shared(spelt).alias("k")) for c, spelt in asked.items()])
    rows = held.select("entity", F.explode(scores).alias("_")).where("_.k > 0")
    score = F.round(F.col("_.k") / F.greatest("_.n", F.lit(1)) * DESCRIPTION_FACTOR, 3)
    return rows.select("_.concept", "entity", score.alias("description_score"))


def combined_score(synonym: DataFrame, description: DataFrame, column_bonus: float = 0.0) -> DataFrame:
    """Weighted score per concept and entity; the bonus counts for synonym matches only."""
    both = synonym.select("concept", "entity", "synonym_score").join(
        description.select("concept", "entity", "description_score"), ["concept", "entity"], "full")
    parts = both.withColumns({
        "column_bonus": F.when(F.col("synonym_score").isNotNull(), F.lit(float(column_bonus))).otherwise(0.0),
        "synonym_score": F.coalesce("synonym_score", F.lit(0.0)),
        "description_score": F.coalesce("description_score", F.lit(0.0))})
    total = reduce(Column.__add__, [F.lit(w) * F.col(c) for c, w in SCORE_WEIGHTS.items()])
    return parts.withColumn("final_score", F.round(total, 3))
