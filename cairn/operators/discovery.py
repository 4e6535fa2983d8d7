"""Key discovery and join cardinality on whole tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import batched, combinations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Shares from which a column may take part in a key, and from which a
# combination is accepted; growth that counts as fan-out.
ELIGIBLE, ACCEPTED = 0.5, 0.99
FAN_OUT = 1.05
# combinations counted in one job; all are tried, in as many jobs as that takes
BATCH = 16
# rows of one value go to one task as long as they are this part of the rows at most, or this many
CROWD, LEAST_CROWD = 1_000, 1_000
# sketches merged in one scan, their size (2^k registers), and how far the true count can lie above an estimate: five
# standard errors of 1.04 / sqrt(registers)
SKETCHES, REGISTERS_LOG2 = 100, 14
MARGIN = 5 * 1.04 / 2 ** (REGISTERS_LOG2 / 2)

Combo = tuple[str, ...]


def _exact(df: DataFrame, column: str) -> bool:
    """Whether equal values of the column are equal as text too, and fit a long."""
    return df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long", "boolean", "date")


def _part(df: DataFrame, column: str) -> Column:
    """What is compared of a column: whole numbers, dates and booleans as they are, others as text."""
    return F.col(column) if _exact(df, column) or isinstance(df.schema[column].dataType, DecimalType) else F.col(column).cast("string")


def _marks(df: DataFrame, column: str) -> list[Column]:
    """Longs that are equal only where the parts are: the value itself, or 128 bits of its text's hashes (NULL stays NULL)."""
    if df.schema[column].dataType.typeName() == "date":
        return [F.unix_date(column).cast("bigint")]
    if _exact(df, column):
        return [F.col(column).cast("bigint")]
    part = _part(df, column)
    return [F.when(part.isNotNull(), F.xxhash64(part)), F.when(part.isNotNull(), F.xxhash64(F.lit(1), part))]


def _collected(frames: Iterable[DataFrame]) -> list[Row]:
    """The rows of small frames, ``BATCH`` frames per job."""
    return [row for batch in batched(frames, BATCH) for row in reduce(DataFrame.unionAll, batch).collect()]


def _keyed(df: DataFrame, combo: Combo, *more: Column) -> DataFrame:
    """The parts of a combination as ``k0, k1, ...``, without rows where one is NULL."""
    names = [f"k{i}" for i in range(len(combo))]
    return df.select(*[_part(df, c).alias(k) for c, k in zip(combo, names)], *more).where(
        reduce(Column.__and__, [F.col(k).isNotNull() for k in names]))


def _distinct_counts(df: DataFrame, combos: Sequence[Combo]) -> dict[Combo, tuple[int, int]]:
    """Distinct non-NULL values of each combination, and the rows of its most frequent value.

    Every combination is a two-step aggregate over its own values, which spreads over all keys. Collected is one row per
    combination.
    """
    def tally(i: int, combo: Combo) -> DataFrame:
        keys = [f"k{j}" for j in range(len(combo))]
        return _keyed(df, combo).groupBy(*keys).agg(F.count("*").alias("n")).agg(
            F.lit(i).alias("combo"), F.count("*").alias("distinct"), F.coalesce(F.max("n"), F.lit(0)).alias("most"))

    return {combos[r["combo"]]: (r["distinct"], r["most"]) for r in _collected(tally(i, c) for i, c in enumerate(combos))}


def _joint_counts(df: DataFrame, combos: Sequence[Combo], total: int, most: Mapping[str, int]) -> dict[Combo, int]:
    """Distinct non-NULL values of combinations of two or more columns; ``most`` has the rows of each column's most frequent value.

    All combinations that differ in their last column only share one grouping by the others: each row crosses the network
    once for them. A group in which a last column has at most one value, or that has two rows, shows its distinct values by
    the smallest and the largest. Combinations with any other group, and those whose groups would be large, are counted
    one by one.
    """
    order = {combo: sorted(combo, key=lambda c: most[c]) for combo in combos}
    lasts: dict[Combo, list[Combo]] = {}
    for combo, columns in order.items():
        if most[columns[0]] <= max(LEAST_CROWD, total // CROWD):
            lasts.setdefault(tuple(columns[:-1]), []).append(combo)
    groups = [(lead, part) for lead, found in lasts.items() for part in batched(found, BATCH)]

    def tally(i: int, lead: Combo, part: Sequence[Combo]) -> DataFrame:
        keys = [f"k{j}" for j in range(len(lead))]
        marks = [[(f"m{j}_{h}", mark) for h, mark in enumerate(_marks(df, order[c][-1]))] for j, c in enumerate(part)]
        rows = _keyed(df, lead, *[mark.alias(m) for pairs in marks for m, mark in pairs]).repartition(*keys)
        each = rows.groupBy(*keys).agg(F.count("*").alias("n"), *[
            f(m).alias(f"{name}_{m}") for pairs in marks for m, _ in pairs for name, f in (("lo", F.min), ("hi", F.max))])
        seen = [F.when(F.col(f"lo_{pairs[0][0]}").isNull(), 0)
                .when(reduce(Column.__and__, [F.col(f"lo_{m}") == F.col(f"hi_{m}") for m, _ in pairs]), 1)
                .when(F.col("n") == 2, 2) for pairs in marks]
        return each.agg(F.lit(i).alias("group"), F.array(*[F.coalesce(F.sum(s), F.lit(0)) for s in seen]).alias("distinct"),
                        F.array(*[F.count_if(s.isNull()) for s in seen]).alias("open"))

    counts: dict[Combo, int] = {}
    for row in _collected(tally(i, *group) for i, group in enumerate(groups)):
        counts |= {c: n for c, n, left in zip(groups[row["group"]][1], row["distinct"], row["open"]) if not left}
    rest = [c for c in combos if c not in counts]
    return counts | {c: n for c, (n, _) in _distinct_counts(df, rest).items()}


def candidate_keys(df: DataFrame, elig: float = ELIGIBLE, cand: float = ACCEPTED,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Columns and combinations by uniqueness, best first.

    Single columns from ``elig`` up are reported. Only when none reaches ``cand`` are
    pairs of them tried, and only then triples, always all of them. Rows with a NULL in a
    key do not count. Only one count per combination reaches the driver.
    """
    found: list[tuple[list[str], float]] = []
    total = df.count()
    if total:
        singles = {c: n for (c,), n in _distinct_counts(df, [(c,) for c in (columns or df.columns)]).items()}
        eligible = [c for c, (n, _) in sorted(
            singles.items(), key=lambda e: df.columns.index(e[0])) if n / total >= elig]
        found += [([c], singles[c][0] / total) for c in eligible]
        for size in (2, 3):
            combos = list(combinations(eligible, size))
            if not combos or any(ratio >= cand for _, ratio in found):
                break
            counts = _joint_counts(df, combos, total, {c: singles[c][1] for c in eligible})
            found += [(list(c), counts[c] / total) for c in combos]
    found.sort(key=lambda e: -e[1])
    return df.sparkSession.createDataFrame(
        [(", ".join(c), len(c), r) for c, r in found],
        "key_columns string, key_size int, uniqueness_ratio double")


def _upper_bounds(df: DataFrame, combos: Sequence[Combo]) -> tuple[int, dict[Combo, float]]:
    """Row count and an upper bound of each combination's distinct count, from sketches that merge in one scan."""
    total, bounds = 0, {}
    for batch in batched(combos, SKETCHES):
        def key(combo: Combo) -> Column:
            known = F.forall(F.array(*[F.col(c).isNotNull() for c in combo]), lambda x: x)
            return F.when(known, F.xxhash64(*combo))

        row = df.agg(F.count("*"), *[
            F.hll_sketch_estimate(F.hll_sketch_agg(key(combo), F.lit(REGISTERS_LOG2))) for combo in batch]).first()
        total = row[0]
        bounds |= {combo: (n or 0) * (1 + MARGIN) for combo, n in zip(batch, row[1:])}
    return total, bounds


def accepted_keys(df: DataFrame, elig: float = ELIGIBLE, cand: float = ACCEPTED, columns: Sequence[str] | None = None,
                  counted: dict[int, tuple[int, int]] | None = None) -> DataFrame:
    """The rows of :func:`candidate_keys` from ``cand`` up, without counting what cannot reach it.

    Each size costs one scan for sketches of all combinations; only combinations whose upper bound reaches the share are
    counted exactly. ``counted`` is filled with (tried, counted exactly) per size.
    """
    def shares(combos: Sequence[Combo], least: float) -> dict[Combo, float]:
        total, bounds = _upper_bounds(df, combos)
        near = [c for c in combos if total and bounds[c] >= least * total]
        if counted is not None:
            counted[len(combos[0])] = (len(combos), len(near))
        return {c: n / total for c, (n, _) in _distinct_counts(df, near).items() if n / total >= least}

    singles = shares([(c,) for c in (columns or df.columns)], elig)
    found = {c: r for c, r in singles.items() if r >= cand}
    for size in (2, 3):
        combos = list(combinations([c for c, in singles], size))
        if not combos or found:
            break
        found = shares(combos, cand)
    return df.sparkSession.createDataFrame(
        [(", ".join(c), len(c), r) for c, r in sorted(found.items(), key=lambda e: (-e[1], e[0]))],
        "key_columns string, key_size int, uniqueness_ratio double")


def key_coverage(candidates: DataFrame, declared: DataFrame) -> DataFrame:
    """Which checks a candidate key still needs.

    ``declared`` has one row per existing check (column_name, check_name). A single
    column needs unique and not_null; a combination needs not_null on each column and
    always the combination check.
    """
    keys = candidates.select("key_columns", "key_size", F.posexplode(F.split("key_columns", ", ")).alias(
        "position", "column_name"))
    needed = keys.withColumn("check_name", F.explode(
        F.when(F.col("key_size") == 1, F.array(F.lit("unique"), F.lit("not_null")))
        .otherwise(F.array(F.lit("not_null")))))
    open_checks = needed.join(
        declared.select("column_name", "check_name").distinct(), ["column_name", "check_name"], "left_anti")
    label = F.when(F.col("key_size") == 1, F.col("check_name")).otherwise(
        F.concat(F.lit("not_null on "), F.col("column_name")))
    order = F.struct(F.col("position").alias("p"), (F.col("check_name") != "unique").alias("q"), label.alias("label"))
    listed = open_checks.groupBy("key_columns").agg(F.sort_array(F.collect_list(order)).alias("o"))
    missing = F.coalesce(F.transform("o", lambda s: s["label"]), F.array().cast("array<string>"))
    whole = F.when(F.col("key_size") > 1, F.array(F.lit("unique_combination_of_columns"))).otherwise(
        F.array().cast("array<string>"))
    joined = candidates.join(listed, "key_columns", "left").withColumn("m", F.concat(missing, whole))
    return joined.select("key_columns", "key_size", "uniqueness_ratio",
                         (F.size("m") == 0).alias("covered"), F.array_join("m", ", ").alias("missing_checks"))


def join_cardinality(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Kind of an inner join, from key histograms; the join itself is never built.

    A key with ``a`` left and ``b`` right rows gives ``a × b`` result rows, so one row
    per distinct key is enough and hot keys cost nothing.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    names = [f"k{i}" for i in range(len(pairs))]

    def histogram(df: DataFrame, columns: Sequence[str], n: str) -> DataFrame:
        return df.groupBy(*[F.col(c).alias(k) for c, k in zip(columns, names)]).agg(F.count("*").alias(n))

    a = histogram(left, list(pairs), "a").withColumn("b", F.lit(0).cast("bigint"))
    b = histogram(right, list(pairs.values()), "b").withColumn("a", F.lit(0).cast("bigint"))
    both = a.unionByName(b).groupBy(*names).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    known: Column = F.lit(True)
    for k in names:
        known = known & F.col(k).isNotNull()
    counts = both.agg(
        F.count_if(known & (F.col("a") > 0)).alias("left_distinct"),
        F.count_if(known & (F.col("b") > 0)).alias("right_distinct"),
        F.coalesce(F.sum(F.when(known, F.col("a") * F.col("b"))), F.lit(0)).alias("result_rows"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("left_rows"))
    return classify_cardinality(counts)


def classify_cardinality(counts: DataFrame) -> DataFrame:
    """Label counts of (left_distinct, right_distinct, result_rows, left_rows)."""
    growth = F.coalesce(F.col("result_rows") / F.nullif("left_rows", F.lit(0)), F.lit(0.0))
    grows = growth > FAN_OUT
    left, right = F.col("left_distinct"), F.col("right_distinct")
    kind = (F.when((left == right) & ~grows, "1:1").when((left > right) & grows, "1:M")
            .when((left < right) & ~grows, "M:1").otherwise("M:M"))
    return counts.select(
        "*", kind.alias("cardinality"), grows.alias("fan_out"), F.round(growth, 3).alias("expansion_ratio"))
