"""Data-quality checks.

A check is a small value object. ``violations(df)`` returns the offending rows or
keys; :func:`summarize` counts the violations of many checks at once: all checks that
look at single rows share one aggregate over one scan, and only the checks that need
grouping or another table run on their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cairn.operators.joins import compare_totals, orphans

ERROR, WARN = "error", "warn"
SUMMARY = ("check_name", "table_name", "column_name", "severity", "violations")


@dataclass(frozen=True)
class Check:
    """Base of all checks. ``where`` restricts the rows that are checked."""

    columns: tuple[str, ...]
    severity: str = ERROR
    where: Column | None = None

    name = "check"

    def tally(self, test: Column) -> Column:
        """The number of violations as an aggregate of the row test: rows, unless a check counts something else."""
        return F.count_if(test)

    def scope(self, df: DataFrame) -> DataFrame:
        return df if self.where is None else df.where(self.where)

    def bad_row(self) -> Column | None:
        """Predicate of an offending row, for checks that look at single rows."""
        return None

    def violations(self, df: DataFrame) -> DataFrame:
        bad = self.bad_row()
        if bad is None:
            raise NotImplementedError(self.name)
        return self.scope(df).where(bad)

    def count(self, df: DataFrame) -> DataFrame:
        """One row ``violations``."""
        return self.violations(df).agg(F.count("*").alias("violations"))

    def when(self, where: Column) -> Check:
        return replace(self, where=where)

    def warn(self) -> Check:
        return replace(self, severity=WARN)


@dataclass(frozen=True)
class NotNull(Check):
    name = "not_null"

    def bad_row(self) -> Column:
        return F.col(self.columns[0]).isNull()


@dataclass(frozen=True)
class AcceptedValues(Check):
    """Non-NULL values outside a list."""

    values: tuple[object, ...] = ()
    name = "accepted_values"

    def bad_row(self) -> Column:
        c = F.col(self.columns[0])
        return c.isNotNull() & ~c.isin(*self.values)

    def violations(self, df: DataFrame) -> DataFrame:
        return super().violations(df).groupBy(self.columns[0]).agg(F.count("*").alias("n_rows"))

    def tally(self, test: Column) -> Column:
        return F.count_distinct(F.when(test, F.col(self.columns[0])))


@dataclass(frozen=True)
class Between(Check):
    """Non-NULL values outside inclusive bounds; either bound may be open."""

    low: object = None
    high: object = None
    name = "between"

    def bad_row(self) -> Column:
        c = F.col(self.columns[0])
        tests = [c < F.lit(self.low)] if self.low is not None else []
        tests += [c > F.lit(self.high)] if self.high is not None else []
        return reduce(Column.__or__, tests)


@dataclass(frozen=True)
class MatchesRegex(Check):
    pattern: str = ""
    name = "match_regex"

    def bad_row(self) -> Column:
        c = F.col(self.columns[0])
        return c.isNotNull() & ~c.rlike(self.pattern)


@dataclass(frozen=True)
class PairGreater(Check):
    """Rows where the first column is not above the second (``or_equal`` allows a tie)."""

    or_equal: bool = False
    name = "pair_greater"

    def bad_row(self) -> Column:
        a, b = (F.col(c) for c in self.columns)
        return ~((a >= b) if self.or_equal else (a > b))


@dataclass(frozen=True)
class Unique(Check):
    """Non-NULL values, or combinations of columns, that occur more than once."""

    name = "unique"

    def violations(self, df: DataFrame) -> DataFrame:
        rows = self.scope(df)
        if len(self.columns) == 1:
            rows = rows.where(F.col(self.columns[0]).isNotNull())
        return rows.groupBy(*self.columns).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


@dataclass(frozen=True)
class UniqueCombination(Unique):
    name = "unique_combination"


@dataclass(frozen=True)
class Relationship(Check):
    """Non-NULL child keys that have no parent."""

    parent: DataFrame | None = None
    parent_column: str = ""
    name = "relationships"

    def violations(self, df: DataFrame) -> DataFrame:
        child = self.scope(df).where(F.col(self.columns[0]).isNotNull())
        return orphans(child, self.parent, {self.columns[0]: self.parent_column})


@dataclass(frozen=True)
class RowCountBetween(Check):
    low: int = 0
    high: int | None = None
    name = "row_count_between"

    def violations(self, df: DataFrame) -> DataFrame:
        counted = self.scope(df).agg(F.count("*").alias("row_count"))
        bad = F.col("row_count") < self.low
        return counted.where(bad if self.high is None else bad | (F.col("row_count") > self.high))


@dataclass(frozen=True)
class RowCountEquals(Check):
    """Row count equal to another table's, which guards joins against loss and fan-out."""

    other: DataFrame | None = None
    name = "row_count_equals"

    def violations(self, df: DataFrame) -> DataFrame:
        return compare_totals(
            self.scope(df).agg(F.count("*").alias("row_count")),
            self.other.agg(F.count("*").alias("other_row_count")), {"row_count": "other_row_count"}, 0)


@dataclass(frozen=True)
class MaxBetween(Check):
    """A column whose largest value lies outside inclusive bounds."""

    low: object = None
    high: object = None
    name = "max_between"

    def violations(self, df: DataFrame) -> DataFrame:
        top = self.scope(df).agg(F.max(self.columns[0]).alias("max_value"))
        return top.where(Between(("max_value",), low=self.low, high=self.high).bad_row())


def not_null(column: str) -> Check:
    return NotNull((column,))


def unique(column: str) -> Check:
    return Unique((column,))


def accepted_values(column: str, values: Sequence[object]) -> Check:
    return AcceptedValues((column,), values=tuple(values))


def relationships(column: str, parent: DataFrame, parent_column: str) -> Check:
    return Relationship((column,), parent=parent, parent_column=parent_column)


def unique_combination(*columns: str) -> Check:
    return UniqueCombination(columns)


def row_count_between(low: int, high: int | None = None) -> Check:
    return RowCountBetween((), low=low, high=high)


def row_count_equals(other: DataFrame) -> Check:
    return RowCountEquals((), other=other)


def between(column: str, low: object = None, high: object = None) -> Check:
    return Between((column,), low=low, high=high)


def max_between(column: str, low: object = None, high: object = None) -> Check:
    return MaxBetween((column,), low=low, high=high)


def match_regex(column: str, pattern: str) -> Check:
    return MatchesRegex((column,), pattern=pattern)


def pair_greater(a: str, b: str, or_equal: bool = False) -> Check:
    return PairGreater((a, b), or_equal=or_equal)


def not_null_where(column: str, where: Column) -> Check:
    return NotNull((column,), where=where)


def summarize(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check with its number of violations.

    Checks with a row predicate become conditional sums of one aggregate; it is turned
    into rows afterwards, so the table is scanned once for all of them.
    """
    def label(check: Check) -> list[Column]:
        return [F.lit(check.name).alias("check_name"), F.lit(table).alias("table_name"),
                F.lit(", ".join(check.columns)).alias("column_name"),
                F.lit(check.severity).alias("severity")]

    single = [c for c in checks if c.bad_row() is not None]
    parts = []
    if single:
        scoped = [c.bad_row() if c.where is None else c.where & c.bad_row() for c in single]
        sums = df.agg(*[c.tally(test).alias(f"__c{i}") for i, (c, test) in enumerate(zip(single, scoped))])
        rows = F.array(*[
            F.struct(*label(c), F.col(f"__c{i}").alias("violations")) for i, c in enumerate(single)])
        parts.append(sums.select(F.explode(rows).alias("r")).select("r.*"))
    parts += [
        c.count(df).select(*label(c), "violations") for c in checks if c.bad_row() is None]
    return reduce(DataFrame.unionAll, parts)


def failed(summary: DataFrame) -> DataFrame:
    """Checks that break a build: violations at error severity."""
    return summary.where((F.col("severity") == ERROR) & (F.col("violations") > 0))


# --- schemas

class ContractError(ValueError):
    """A frame does not have exactly the declared columns and types."""


def enforce_contract(df: DataFrame, declared: StructType | Mapping[str, str]) -> DataFrame:
    """The frame in declared column order, or an error listing every difference.

    ``declared`` is a schema, or maps column to type.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = ({f.name: f.dataType.simpleString() for f in declared.fields}
            if isinstance(declared, StructType) else dict(declared))
    problems = [f"missing {c}" for c in want if c not in have]
    problems += [f"undeclared {c}" for c in have if c not in want]
    problems += [f"{c} is {have[c]}, declared {t}" for c, t in want.items() if c in have and have[c] != t]
    if problems:
        raise ContractError("; ".join(problems))
    return df.select(*want)


def column_diff(df: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Columns that are only declared or only present."""
    rows = [(c, "declared only") for c in declared if c not in df.columns]
    rows += [(c, "present only") for c in df.columns if c not in declared]
    return df.sparkSession.createDataFrame(rows, "column_name string, side string")


# --- freshness

def freshness(tables: Mapping[str, tuple[DataFrame, str, float, float]], as_of: Column) -> DataFrame:
    """Age of the newest row per table against its limits.

    ``tables`` maps name to (frame, loaded-at column, warn hours, error hours). A table
    without a value has no status ``pass``: it is an error.
    """
    rows = []
    for name, (df, column, warn, error) in tables.items():
        newest = df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("loaded_at"))
        age = F.timestamp_diff("SECOND", F.col("loaded_at"), as_of) / F.lit(3600.0)
        rows.append(newest.select(
            F.lit(name).alias("table_name"), "loaded_at", age.alias("age_hours"),
            F.when(F.col("loaded_at").isNull() | (age > error), ERROR)
            .when(age > warn, WARN).otherwise("pass").alias("status")))
    return reduce(DataFrame.unionAll, rows)


# --- reconciliation

def orphan_check(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is missing in the parent; a NULL key counts."""
    return orphans(child, parent, {child_key: parent_key})


def reconcile_ids(df: DataFrame, id_column: str, source: str, left_like: str, right_like: str
                  ) -> DataFrame:
    """Ids of one source system that another source system does not know."""
    left = df.where(F.col(source).like(left_like)).select(id_column)
    right = df.where(F.col(source).like(right_like)).select(F.col(id_column).alias("__id"))
    return orphans(left, right, {id_column: "__id"})


def balance_check(facts: Mapping[str, tuple[DataFrame, str]], report: DataFrame,
                  report_columns: Mapping[str, str]) -> DataFrame:
    """Fact totals against report totals: a row when any pair differs by cents.

    ``facts`` maps a total's name to (frame, column), ``report_columns`` the same name
    to the report column.
    """
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,2)")

    fact_rows = [df.agg(total(c).alias(f"fact_{n}")) for n, (df, c) in facts.items()]
    left = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fact_rows)
    left = left.agg(*[F.max(f"fact_{n}").alias(f"fact_{n}") for n in facts])
    right = report.agg(*[total(c).alias(f"report_{n}") for n, c in report_columns.items()])
    return compare_totals(left, right, {f"fact_{n}": f"report_{n}" for n in facts})


# Endings of key columns, which need no catalog entry.
KEY_ENDINGS = ("_sk", "_id")


def entity_conformance(columns: DataFrame, catalog: DataFrame, entity: str,
                       entity_column: str = "entity", name_column: str = "column_name") -> DataFrame:
    """Non-key columns that the entity's catalog does not list.

    ``columns`` holds one row per output column (``column_name``).
    """
    allowed = catalog.where(F.col(entity_column) == entity).select(
        F.lower(name_column).alias("__allowed"))
    key = reduce(Column.__or__, [F.lower("column_name").endswith(e) for e in KEY_ENDINGS])
    checked = columns.where(~key).withColumn("__lower", F.lower("column_name"))
    return orphans(checked, allowed, {"__lower": "__allowed"}).drop("__lower")
