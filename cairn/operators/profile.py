"""Whole-table profiling.

Columns are melted once to (column, value) and counted; distinct counts, top values and
value lists all come from that one small-grain frame. Totals, NULLs, typed bounds and
means come from one wide aggregate. No table is sampled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators.dedup import first_per_key

# Limits and name patterns of the profile's hints.
TOP_VALUES = 5
LOW_CARDINALITY = 10
CATEGORY_LIMIT = 15
PADDED = r"^\s+|\s+$"
AMBIGUOUS_NAMES = ("id", "code", "flag", "type", "status", "name", "value", "data")
DATE_WORDS = ("date", "time", "_at", "_on", "created", "updated", "modified", "_ts", "timestamp")
CAMEL_CASE = re.compile(r"[a-z][A-Z]")
HUNGARIAN = re.compile(r"(str|int|flt|bln|dbl|arr|obj)[A-Z_]")
KEY_ENDINGS = ("_id", "_sk", "_key")
DATE_ENDINGS = ("_date", "_at", "_on")


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _rows(per_column: dict[str, dict[str, Column]], types: dict[str, str]) -> Column:
    """Wide aggregates as an array of one struct per column."""
    return F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[e.cast(types[n]).alias(n) for n, e in stats.items()])
        for c, stats in per_column.items()
    ])


def wide_stats(df: DataFrame, columns: Sequence[str], stats: dict[str, tuple[str, object]]) -> DataFrame:
    """One row per column from one aggregate.

    ``stats`` maps the statistic's name to (type, function of the column name).
    """
    wide = df.agg(*[
        make(c).alias(f"{i}_{name}")
        for i, c in enumerate(columns) for name, (_, make) in stats.items()])
    per_column = {
        c: {name: F.col(f"{i}_{name}") for name in stats} for i, c in enumerate(columns)}
    rows = _rows(per_column, {name: t for name, (t, _) in stats.items()})
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def melt_counts(df: DataFrame, columns: Sequence[str] | None = None, keep_null: bool = True
                ) -> DataFrame:
    """(column_name, value, n): how often each value occurs, values as text.

    Counting starts before the shuffle, so a frequent value costs one row per task.
    """
    columns = list(columns or df.columns)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    melted = df.select(F.explode(pairs).alias("p")).select("p.*")
    if not keep_null:
        melted = melted.where(F.col("value").isNotNull())
    return melted.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def top_values(counts: DataFrame, n: int = TOP_VALUES, sep: str = "|") -> DataFrame:
    """The most frequent values per column as one string; equal counts in value order.

    NULL counts as a value but leaves no text.
    """
    order = [F.desc("n"), F.asc_nulls_last("value")]
    best = first_per_key(counts, ["column_name"], order, n)
    ranked = best.withColumn("__r", F.row_number().over(Window.partitionBy("column_name").orderBy(*order)))
    ordered = F.array_sort(F.collect_list(F.struct("__r", "value")))
    texts = F.array_compact(F.transform(ordered, lambda s: s["value"]))
    return ranked.groupBy("column_name").agg(
        F.when(F.size(texts) > 0, F.array_join(texts, sep)).alias("top_values"))


def quick_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: totals, NULLs, distinct values, bounds, mean and top values."""
    columns = list(columns or df.columns)
    typed = wide_stats(df, columns, {
        "min_val": ("string", F.min),
        "max_val": ("string", F.max),
        "avg_val": ("double", _mean_of(df)),
    })
    # both uses need every column of the counts, so Spark shuffles them once and reuses them
    counts = melt_counts(df, columns)
    totals = counts.groupBy("column_name").agg(
        F.sum("n").alias("total_count"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count("value").alias("distinct_count"))
    empty = {c: F.coalesce(c, F.lit(0)) for c in ("total_count", "null_count", "distinct_count")}
    return (typed.join(totals, "column_name", "left").join(top_values(counts), "column_name", "left")
            .withColumns(empty)
            .select("column_name", "total_count", "null_count", "distinct_count", "min_val", "max_val",
                    "avg_val", "top_values"))


def _mean_of(df: DataFrame):
    numeric_or_text = {
        f.name for f in df.schema.fields
        if isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType))}

    def mean(c: str) -> Column:
        if c in numeric_or_text:
            return F.avg(F.col(c).try_cast("double"))
        return F.max(F.lit(None).cast("double"))

    return mean


def profile_ratios(profile: DataFrame) -> DataFrame:
    """Profile with NULL rate and uniqueness to four decimals; 0 for an empty table."""
    def ratio(c: str) -> Column:
        share = F.col(c) / F.nullif("total_count", F.lit(0))
        return F.coalesce(F.round(share, 4), F.lit(0.0))

    return profile.withColumns({
        "null_rate": ratio("null_count"), "uniqueness_ratio": ratio("distinct_count")})


def uniqueness_ratios(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-NULL values per row for each column."""
    counts = melt_counts(df, columns)
    return counts.groupBy("column_name").agg(
        (F.count("value") / F.sum("n")).alias("uniqueness_ratio"))


def unique_columns(profile: DataFrame) -> DataFrame:
    """Columns whose every row holds another value."""
    return profile.where((F.col("total_count") > 0) & (F.col("distinct_count") == F.col("total_count")))


def value_counts(df: DataFrame, max_distinct: int = LOW_CARDINALITY) -> DataFrame:
    """Counts of every value, NULL included, for columns with few distinct values."""
    counts = melt_counts(df)
    # both uses read every column of the counts, so their shuffle is done once
    few = counts.groupBy("column_name").agg(F.count("value").alias("k"), F.sum("n").alias("total")).where(
        F.col("k").between(1, max_distinct) & (F.col("total") > 0)).select("column_name")
    return counts.join(few, "column_name", "left_semi")


def text_hygiene(df: DataFrame) -> DataFrame:
    """Empty and padded values per text column; columns without either are left out."""
    stats = {
        "empty_count": ("bigint", lambda c: F.count_if(F.col(c) == "")),
        "padded_count": ("bigint", lambda c: F.count_if(F.col(c).rlike(PADDED))),
    }
    return wide_stats(df, _text_columns(df), stats).where(
        (F.col("empty_count") > 0) | (F.col("padded_count") > 0))


def bounds(df: DataFrame) -> DataFrame:
    """First and last value of every date and time column."""
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, times)]
    return wide_stats(df, columns, {
        "min_value": ("timestamp_ntz", F.min), "max_value": ("timestamp_ntz", F.max)})


def null_top(df: DataFrame, n: int = 10) -> DataFrame:
    """The columns with most NULLs."""
    stats = wide_stats(df, df.columns, {
        "null_count": ("bigint", lambda c: F.count_if(F.col(c).isNull())),
        "null_pct": ("double", lambda c: F.round(
            F.lit(100.0) * F.count_if(F.col(c).isNull()) / F.nullif(F.count(F.lit(1)), F.lit(0)), 2)),
    })
    return stats.where(F.col("null_count") > 0).orderBy(F.desc("null_count"), "column_name").limit(n)


def _snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def _rename_message(name: str) -> str | None:
    if CAMEL_CASE.search(name):
        return f"rename to snake_case: {_snake_case(name)}"
    if HUNGARIAN.match(name):
        return f"remove Hungarian notation prefix from: {name}"
    if name.lower() in AMBIGUOUS_NAMES:
        return f"ambiguous column name '{name}' — prefix with entity context"
    return None


def staging_signals(df: DataFrame, null_limit: float = 0.5) -> DataFrame:
    """Hints for a staging model: what to cast, rename or drop.

    A text column counts as numeric when every filled value reads as a number; the
    NULL share from which a column counts as unused is ``null_limit``.
    """
    text = set(_text_columns(df))
    stats = wide_stats(df, df.columns, {
        "filled": ("bigint", F.count),
        "total": ("bigint", lambda c: F.count(F.lit(1))),
        "numeric": ("bigint", lambda c: F.count(F.col(c).cast("string").try_cast("double"))),
        "constant": ("boolean", lambda c: F.min(c).eqNullSafe(F.max(c))),
    })

    def pick(names: Sequence[str], column: Column = F.col("column_name")) -> Column:
        return column.isin(*names) if names else F.lit(False)

    dated = [c for c in text if any(w in c.lower() for w in DATE_WORDS)]
    renames = {c: m for c in df.columns if (m := _rename_message(c))}
    name = F.col("column_name")
    numeric = pick(sorted(text)) & (F.col("filled") > 0) & (F.col("numeric") == F.col("filled"))
    cast_hint = F.when(numeric, F.concat(
        F.lit("cast("), name, F.lit(" as numeric) — column stores numeric values as text"))).when(
        pick(sorted(dated)),
        F.concat(F.lit("cast("), name, F.lit(" as date) — column name suggests date/time data")))
    rename_hint = F.lit(None).cast("string")
    for c, message in renames.items():
        rename_hint = F.when(name == c, message).otherwise(rename_hint)
    unused = F.when(F.col("constant") & (F.col("filled") > 0),
                    "constant value — consider dropping in staging").when(
        F.lit(1.0) - F.col("filled") / F.col("total") >= null_limit,
        "high null rate — consider dropping or documenting sparse population")
    hints = F.array(*[
        F.struct(F.lit(kind).alias("signal_type"), message.alias("message"))
        for kind, message in (("CAST_HINT", cast_hint), ("RENAME_HINT", rename_hint), ("UNUSED_COLUMN", unused))])
    return stats.select("column_name", F.explode(hints).alias("h")).select(
        "column_name", "h.signal_type", "h.message").where(F.col("message").isNotNull())


def suggest_checks(df: DataFrame, existing: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Checks that the data supports and that do not exist yet, one row each.

    Key-like names: not_null, and unique if no filled value repeats. Date-like names
    with under 10 % NULL: not_null. Other text with 2–15 distinct values: accepted
    values, sorted.
    """
    existing = existing or {}
    has = {c: set(existing.get(c, ())) for c in df.columns}
    keys = [c for c in df.columns if c.endswith(KEY_ENDINGS)]
    dates = [c for c in df.columns if c.endswith(DATE_ENDINGS)]
    labels = [c for c in _text_columns(df) if c not in keys and "accepted_values" not in has[c]]
    parts = []

    def rule(columns: Sequence[str], check: str, condition: Column) -> None:
        if columns:
            parts.append((list(columns), check, condition))

    rule([c for c in keys if "not_null" not in has[c]], "not_null", F.lit(True))
    rule([c for c in keys if "unique" not in has[c]], "unique", F.col("distinct_count") == F.col("filled"))
    rule([c for c in dates if "not_null" not in has[c]], "not_null",
         (F.col("total") - F.col("filled")) / F.col("total") < 0.1)
    rule(labels, "accepted_values", F.col("distinct_count").between(2, CATEGORY_LIMIT))
    wanted = sorted({c for columns, *_ in parts for c in columns})
    if not wanted:
        return df.sparkSession.createDataFrame([], "column_name string, check_name string, accepted string")
    counts = melt_counts(df, wanted)
    stats = counts.groupBy("column_name").agg(
        F.count("value").alias("distinct_count"), F.sum("n").alias("total"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("filled"))
    # at most one value more than the limit per column reaches this list
    first = first_per_key(counts.where(F.col("value").isNotNull() & F.col("column_name").isin(*labels))
                          if labels else counts.where(F.lit(False)),
                          ["column_name"], [F.asc("value")], CATEGORY_LIMIT + 1)
    lists = first.groupBy("column_name").agg(
        F.array_join(F.sort_array(F.collect_list("value")), ", ").alias("accepted"))
    rows = [
        stats.where(F.col("column_name").isin(*columns) & condition).select(
            "column_name", F.lit(check).alias("check_name"))
        for columns, check, condition in parts]
    found = reduce(DataFrame.unionAll, rows)
    joined = found.join(lists, "column_name", "left")
    return joined.select("column_name", "check_name", F.when(
        F.col("check_name") == "accepted_values", F.col("accepted")).alias("accepted"))


# Keywords that classify a table, limits per class in hours, and the
# load-time column endings in order of preference.
TRANSACTIONAL_WORDS = ("transaction", "event", "log", "order", "payment", "sale", "booking")
REFERENCE_WORDS = ("type", "code", "categor", "mapping", "lookup", "status_code")
FRESHNESS_HOURS = {"transactional": (12, 24), "reference": (7 * 24, 14 * 24), "standard": (24, 48)}
LOADED_AT_ENDINGS = (
    "_loaded_at", "_updated_at", "_modified_at", "_created_at", "updated_date", "modified_date",
    "last_modified", "load_timestamp", "updated_at", "created_at", "modified_at")


def suggest_freshness(columns: DataFrame) -> DataFrame:
    """Freshness policy per table from its name and columns.

    ``columns`` has one row per table column (table_name, column_name, position). Tables
    without a load-time column are left out. Feeds :func:`cairn.operators.quality.freshness`.
    """
    lower = F.lower("column_name")
    rank = F.lit(None).cast("int")
    for i, ending in reversed(list(enumerate(LOADED_AT_ENDINGS))):
        rank = F.when(lower.endswith(ending), i).otherwise(rank)
    ranked = columns.withColumn("rank", rank).where(F.col("rank").isNotNull())
    best = ranked.groupBy("table_name").agg(
        F.min_by("column_name", F.struct("rank", "position")).alias("loaded_at_field"))
    table = F.lower("table_name")

    def mentions(words: Sequence[str]) -> Column:
        return reduce(Column.__or__, [table.contains(w) for w in words])

    kind = (F.when(mentions(TRANSACTIONAL_WORDS), "transactional")
            .when(mentions(REFERENCE_WORDS), "reference").otherwise("standard"))
    typed = best.withColumn("table_kind", kind)

    def limit(i: int) -> Column:
        out = F.lit(FRESHNESS_HOURS["standard"][i])
        for k, hours in FRESHNESS_HOURS.items():
            out = F.when(F.col("table_kind") == k, hours[i]).otherwise(out)
        return out

    return typed.select("table_name", "loaded_at_field", "table_kind",
                        limit(0).alias("warn_hours"), limit(1).alias("error_hours"))
