"""Measures that the business glossary defines and no model of the warehouse holds: occupancy rate and maintenance backlog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.operators.reshape import explode_days
from cairn.operators.sweep import covered, levels, running_sums

#: condition index from which an asset counts as good
GOOD_CONDITION = 70


def occupancy_levels(stays: DataFrame, units: DataFrame, keys: Sequence[str], unit: str, start: str, end: str) -> DataFrame:
    """``keys, start, end, occupied_units, available_units`` per stretch of time without a change.

    ``stays`` and ``units`` hold ``keys``, ``unit`` and an interval ``[start, end)`` each: when the unit is taken, and when it can be
    booked. A unit with overlapping stays is occupied once; stays outside a unit's bookable time still count as occupied.
    """
    occupied = covered(stays, [*keys, unit], start, end).withColumns({"__o": F.lit(1), "__a": F.lit(0)})
    available = covered(units, [*keys, unit], start, end).withColumns({"__o": F.lit(0), "__a": F.lit(1)})
    return levels(occupied.unionByName(available), keys, start, end, {"occupied_units": F.col("__o"), "available_units": F.col("__a")})


def occupancy_rate(occupied: Column, available: Column) -> Column:
    """Occupied ÷ available units, four decimals; NULL where nothing is available."""
    return F.round(occupied / F.nullif(available, F.lit(0)), 4)


def occupancy_daily(level: DataFrame, keys: Sequence[str], start: str, end: str, day: str = "occupancy_date") -> DataFrame:
    """Rate per key and day. Only the levels are expanded, a row per key and day of the result."""
    days = explode_days(level.where("available_units > 0 or occupied_units > 0"), F.col(start), F.date_sub(end, 1), day)
    return days.select(*keys, day, "occupied_units", "available_units",
                       occupancy_rate(F.col("occupied_units"), F.col("available_units")).alias("occupancy_rate"))


def occupancy_monthly(level: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Unit nights and rate per key and month, from the levels cut at the months' ends."""
    months = F.sequence(F.trunc(start, "month"), F.trunc(F.date_sub(end, 1), "month"), F.expr("interval 1 month"))
    cut = level.where("available_units > 0 or occupied_units > 0").withColumn("month", F.explode(months))
    nights = F.datediff(F.least(F.col(end), F.add_months("month", 1)), F.greatest(F.col(start), F.col("month"))).cast("bigint")
    total = cut.groupBy(*keys, "month").agg(
        F.sum(nights * F.col("occupied_units")).alias("occupied_nights"), F.sum(nights * F.col("available_units")).alias("available_nights"))
    return total.withColumn("occupancy_rate", occupancy_rate(F.col("occupied_nights"), F.col("available_nights")))


def maintenance_backlog(estimates: DataFrame, assessments: DataFrame, assets: DataFrame, parks: DataFrame,
                        good: int = GOOD_CONDITION) -> DataFrame:
    """``region_id, park_id, changed_on, backlog_cost, backlog_assets`` after every day on which a park's backlog changes.

    An asset counts with its latest estimated cost while its latest condition index is below ``good``; before its first
    estimate or assessment it counts nothing. Of several on one day the one with the largest id holds. The figure covers
    inventoried assets only, so a region without assessments has none.
    """
    def daily(df: DataFrame, day: str, value: str, order: str, name: str) -> DataFrame:
        # at most one row per asset and day, combined before the shuffle
        return df.where(F.col(day).isNotNull()).groupBy("asset_tag", F.col(day).alias("changed_on")).agg(F.max_by(value, order).alias(name))

    costs = daily(estimates, "calculation_date", "estimated_repair_cost", "backlog_id", "_cost")
    scores = daily(assessments, "inspection_date", "fci_score", "assessment_id", "_score")
    both = costs.unionByName(scores, allowMissingColumns=True).groupBy("asset_tag", "changed_on").agg(
        F.max("_cost").alias("_cost"), F.max("_score").alias("_score"))
    so_far = Window.partitionBy("asset_tag").orderBy("changed_on")
    last = lambda c: F.last(c, ignorenulls=True).over(so_far)
    cost = F.when(last("_score") < good, last("_cost"))
    held = both.select("asset_tag", "changed_on", F.coalesce(cost, F.lit(0)).cast("decimal(18,2)").alias("_now"), cost.isNotNull().cast("bigint").alias("_on"))
    change = lambda c: F.col(c) - F.coalesce(F.lag(c).over(so_far), F.lit(0))
    steps = held.select("asset_tag", "changed_on", change("_now").cast("decimal(18,2)").alias("_cost"), change("_on").alias("_assets"))
    placed = steps.join(assets.select("asset_tag", "park_id"), "asset_tag").groupBy("park_id", "changed_on").agg(
        F.sum("_cost").alias("_cost"), F.sum("_assets").alias("_assets")).where("_cost <> 0 or _assets <> 0")
    total = running_sums(placed, ["park_id"], "changed_on", {"backlog_cost": "_cost", "backlog_assets": "_assets"})
    return total.join(parks.select("park_id", "region_id"), "park_id", "left").select(
        "region_id", "park_id", "changed_on", F.col("backlog_cost").cast("decimal(18,2)").alias("backlog_cost"), "backlog_assets")
