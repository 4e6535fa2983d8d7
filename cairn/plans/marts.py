"""Mart models: facts, dimensions and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import (
    band,
    constant,
    date_parts,
    first_set,
    fiscal_month,
    fiscal_quarter,
    fiscal_year,
    guarded_key,
    join_text,
    label_map,
    month_date,
    nights,
    report_decimal,
    surrogate_key,
    tenure_tier,
    typed_null,
    zero,
)
from cairn.operators.aggregates import by_month
from cairn.operators.filters import valid_intervals
from cairn.operators.joins import (
    expand_nights,
    left_lookup,
    lookup_on,
    match_on_value,
    merge_aggregates,
)
from cairn.operators.reshape import date_spine, union_conformed
from cairn.plans.codes import SystemCodes

# Report labels, the value lists behind them, and the default calendar.
CALENDAR = ("2010-01-01", "2030-12-31")
VISIT_STATUSES = ("Checked In", "Completed")
STATE_REGIONS = {
    "Northeast": ("MA", "CT", "RI", "NH", "VT", "ME", "NY", "NJ"),
    "Midwest": ("PA", "OH", "MI", "IN", "IL", "WI"),
    "West": ("CA", "OR", "WA", "NV", "ID"),
    "South": ("TX", "FL", "GA", "NC", "SC", "VA"),
}
ASSET_GROUPS = {
    "Camping": ("campsite", "tent", "rv", "rv_site", "tent_site"),
    "Lodging": ("cabin", "yurt", "lodge"),
    "Day Use": ("shelter", "day-use", "picnic_area"),
}
ACREAGE_LABELS = ("Small (< 500 acres)", "Medium (500 - 5000 acres)", "Large (> 5000 acres)")
CAPACITY_LABELS = ("Small (1-4)", "Medium (5-8)", "Large (9+)")
WORK_ORDER, SHIFT = "Maintenance Work Order", "Law Enforcement Shift"


# --- core

def calendar(days: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar and fiscal attributes of a frame of days."""
    d = F.col(day)
    return days.select(
        d.alias("date_sk"), d.alias("full_date"),
        *[expr.alias(name) for name, expr in date_parts(d).items()],
        fiscal_year(d).alias("fiscal_year"), fiscal_month(d).alias("fiscal_month"),
        fiscal_quarter(d).alias("fiscal_quarter"))


def dim_date(spark: SparkSession, start: str = CALENDAR[0], end_exclusive: str = CALENDAR[1]
             ) -> DataFrame:
    return calendar(date_spine(spark, start, end_exclusive))


def dim_assets(physical_assets: DataFrame) -> DataFrame:
    return physical_assets.withColumnRenamed("physical_assets_sk", "asset_sk")


def dim_employees(employees: DataFrame) -> DataFrame:
    return employees.withColumnRenamed("employees_sk", "employee_sk")


def dim_vendors(vendors: DataFrame) -> DataFrame:
    return vendors.withColumnRenamed("vendors_sk", "vendor_sk")


# --- revenue

def dim_customers(contacts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Customers with region and tenure at ``as_of`` (default: today)."""
    as_of = F.current_date() if as_of is None else as_of
    return contacts.select(
        "contacts_sk", F.col("e_mail_address1").alias("email"),
        F.col("mobile_phone").alias("phone"), "address_state",
        F.col("account_created_at").alias("customer_since_date"),
        "has_annual_pass", "is_senior", "is_veteran", "is_merged_duplicate",
        join_text(" ", "first_name", "last_name").alias("customer_name"),
        label_map("address_state", STATE_REGIONS, "Other").alias("geographic_region"),
        tenure_tier("account_created_at", as_of).alias("customer_tenure_tier"))


def dim_parks(parks: DataFrame, regions: DataFrame, codes: SystemCodes = SystemCodes()) -> DataFrame:
    """Parks with region label, verification status and acreage tier."""
    region_key = F.concat(F.lit("R"), F.col("region_id").cast("string"))
    return lookup_on(parks, regions, region_key, "region_code", ["region_name"]).select(
        "parks_sk", F.col("name").alias("park_name"), F.col("region_name").alias("region"),
        F.col("classification").alias("park_type"), "infratrak_park_id",
        F.col("total_acres").cast("decimal(10,2)").alias("acreage"),
        "address1_city", "address1_stateorprovince", "address1_postalcode",
        "address1_latitude", "address1_longitude",
        F.when(F.col("source_system") == codes.geo, "Active - Verified")
        .otherwise("Active - Unverified").alias("operational_status"),
        band("total_acres", (500, 5000), ACREAGE_LABELS).alias("acreage_size_tier"))


def dim_reservation_inventory(customer_assets: DataFrame, inventory: DataFrame, parks: DataFrame
                              ) -> DataFrame:
    """Bookable inventory with amenities, group and capacity tier."""
    rows = left_lookup(customer_assets, parks.withColumnRenamed("name", "park_assignment"),
                       {"_parent_park_sk": "parks_sk"}, ["park_assignment"])
    rows = left_lookup(
        rows, inventory, {"customerasset_id": "asset_id"},
        ["asset_type", "max_occupancy", "is_ada_accessible", "pet_policy", "utility_hookup"], cast=True)
    return rows.select(
        "customer_assets_sk", F.col("_parent_park_sk").alias("parks_sk"),
        F.col("name").alias("asset_name"), "asset_type", "park_assignment",
        F.col("max_occupancy").alias("capacity"),
        F.when(F.col("is_ada_accessible"), "ADA Accessible").otherwise("Standard")
        .alias("accessibility_status"),
        join_text(", ", F.when(F.col("pet_policy") == "allowed", "Pets Allowed"),
                  F.when(F.col("utility_hookup") == "full", "Full Hookups")).alias("amenities"),
        label_map("asset_type", ASSET_GROUPS, "Other").alias("asset_type_group"),
        band("max_occupancy", (4, 8), CAPACITY_LABELS, first_closed=True).alias("capacity_tier"))


def fct_reservations(visits: DataFrame) -> DataFrame:
    """Reservation measures, projected from the linked visits (``visits_linked``).

    Reservation ids are unique (staging checks it), so this equals joining the visit
    entity back to the reservations, without shuffling either again.
    """
    return visits.select(
        F.col("visits_sk").alias("reservations_sk"), F.col("_contact_sk").alias("contacts_sk"),
        F.col("_asset_sk").alias("customer_assets_sk"), F.col("_park_sk").alias("parks_sk"),
        "reservation_status", F.col("total_amount").alias("reservation_amount"),
        F.col("arrival_date").alias("check_in_date"),
        F.col("departure_date").alias("check_out_date"), "reservation_created_at",
        nights("arrival_date", "departure_date").alias("nights_stayed"),
        "booking_source", "promo_code", "number_of_guests")


def fct_pos_transactions(transactions: DataFrame) -> DataFrame:
    """Point-of-sale measures, projected from the linked transactions."""
    return transactions.select(
        "transactions_sk", F.col("_contact_sk").alias("contacts_sk"),
        F.col("_park_sk").alias("parks_sk"), "transaction_amount",
        constant(1, "int").alias("quantity"), "revenue_category", "transaction_created_at",
        "is_kiosk_entry")


def fct_park_occupancy_daily_snapshot(reservations: DataFrame, dates: DataFrame, parks: DataFrame
                                      ) -> DataFrame:
    """Park × night: reservations, guests and revenue of every stay on site.

    The stays are expanded and aggregated on park and day only; the calendar and the
    park labels join the small aggregate. A stay's full revenue counts on each night.
    """
    stays = valid_intervals(reservations, "check_in_date", "check_out_date")
    on_site = expand_nights(stays, "check_in_date", "check_out_date", dates)
    daily = on_site.groupBy("parks_sk", "full_date").agg(
        F.count("reservations_sk").alias("active_reservation_count"),
        F.sum("number_of_guests").cast("bigint").alias("total_guests_on_site"),
        F.sum("reservation_amount").alias("revenue"))
    dated = daily.join(dates.select(
        "full_date", "calendar_year", "calendar_month", "calendar_quarter", "fiscal_year",
        "fiscal_month", "day_name", "day_of_month"), "full_date")
    named = left_lookup(dated, parks, ["parks_sk"], ["park_name", "region"])
    return named.select(
        surrogate_key("parks_sk", "full_date").alias("occupancy_snapshot_sk"),
        "parks_sk", "park_name", "region", F.col("full_date").alias("snapshot_date"),
        "calendar_year", "calendar_month", "calendar_quarter",
        F.col("fiscal_year").cast("bigint"), F.col("fiscal_month").cast("bigint"),
        "day_name", "day_of_month", "active_reservation_count", "total_guests_on_site",
        F.col("revenue").cast("decimal(14,2)").alias("total_reservation_revenue_in_stay"))


def rpt_park_revenue_summary(reservations: DataFrame, transactions: DataFrame, parks: DataFrame,
                             null_safe: bool = False) -> DataFrame:
    """Park × month revenue of both channels.

    With ``null_safe=False`` revenue without park or month is not shown (its row has
    zeros); ``null_safe=True`` keeps it.
    """
    booked = by_month(reservations, ["parks_sk"], "check_in_date", {
        "total_reservations": F.count("reservations_sk"),
        "total_reservation_revenue": F.sum("reservation_amount"),
        "avg_reservation_value": F.avg("reservation_amount"),
        "total_nights_stayed": F.sum("nights_stayed"),
        "avg_nights_per_reservation": F.avg("nights_stayed")})
    sold = by_month(transactions, ["parks_sk"], "transaction_created_at", {
        "total_pos_transactions": F.count("transactions_sk"),
        "total_pos_revenue": F.sum("transaction_amount"),
        "avg_pos_transaction_value": F.avg("transaction_amount"),
        "total_pos_items_sold": F.sum("quantity")})
    merged = merge_aggregates([booked, sold], ["parks_sk", "report_month"], null_safe,
                              separate_null_keys=False)
    named = left_lookup(merged, parks, ["parks_sk"], ["park_name", "region", "park_type"])

    def total(c: str, data_type: str) -> Column:
        return zero(c).cast(data_type).alias(c)

    both = zero("total_reservation_revenue") + zero("total_pos_revenue")
    return named.select(
        "parks_sk", F.col("report_month").cast("date"), "park_name", "region", "park_type",
        total("total_reservations", "int"), total("total_reservation_revenue", "decimal(14,2)"),
        report_decimal("avg_reservation_value", 14, 2).alias("avg_reservation_value"),
        total("total_nights_stayed", "int"),
        report_decimal("avg_nights_per_reservation", 10, 2).alias("avg_nights_per_reservation"),
        total("total_pos_transactions", "int"), total("total_pos_revenue", "decimal(14,2)"),
        report_decimal("avg_pos_transaction_value", 14, 2).alias("avg_pos_transaction_value"),
        total("total_pos_items_sold", "int"),
        both.cast("decimal(14,2)").alias("total_combined_revenue"))


# --- attendance

def fct_visitation(visits: DataFrame, visitor_counts: DataFrame,
                   statuses: Sequence[str] = VISIT_STATUSES, null_safe: bool = False) -> DataFrame:
    """Park × day: registered guests, check-ins and sensor estimates.

    ``visits`` are the linked visits. Rows without park or day show zeros unless
    ``null_safe``.
    """
    arrived = visits.where(F.col("reservation_status").isin(*statuses)
                           & F.col("arrival_date").isNotNull())
    registered = arrived.groupBy(
        F.col("_park_sk").alias("parks_sk"), F.col("arrival_date").alias("date_sk")).agg(
        F.sum("number_of_guests").alias("registered_visitors"),
        F.count("reservation_id").alias("checked_in_reservations"))
    sensed = visitor_counts.groupBy("parks_sk", F.col("target_date").alias("date_sk")).agg(
        F.sum("estimated_total_visitors").alias("sensor_estimated_visitors"))
    merged = merge_aggregates([registered, sensed], ["parks_sk", "date_sk"], null_safe)
    measures = ("registered_visitors", "checked_in_reservations", "sensor_estimated_visitors")
    return merged.select(
        surrogate_key("parks_sk", "date_sk").alias("visitation_sk"), "parks_sk", "date_sk",
        *[zero(m).alias(m) for m in measures],
        (zero("registered_visitors") + zero("sensor_estimated_visitors"))
        .alias("total_estimated_visitors"))


# --- finance

def expenditures_with_vendor(entries: DataFrame, payables: DataFrame) -> DataFrame:
    """Expenditures among the entries, each with the probable vendor.

    The vendor is the largest id among payables of the same account and amount.
    """
    spent = entries.where(F.col("entry_type") == "Expenditure")
    return match_on_value(spent, payables, ["account_id", "amount"], "vendor_id")


def fct_expenditures(financials: DataFrame, payables: DataFrame | None = None) -> DataFrame:
    """Ledger expenditure with the probable vendor.

    Without ``payables`` the financials are expenditures that carry their vendor already:
    matched before the labels are looked up, entries are shuffled narrow. Fiscal year and
    accounting month are read as a calendar month.
    """
    paired = financials if payables is None else expenditures_with_vendor(financials, payables)
    return paired.select(
        F.col("financials_sk").alias("expenditure_sk"),
        F.col("gl_entry_id").alias("source_record_id"),
        guarded_key("vendor_id").alias("vendors_sk"), typed_null("string").alias("parks_sk"),
        month_date("fiscal_year", "accounting_month").alias("expenditure_month_date"),
        "amount", "account_fund_code", "fund_description", "account_division_code",
        "division_description", "account_program_code", "program_description",
        "account_object_code", "object_description", "award_id", "award_amount",
        "award_fiscal_year_actual", "source_system")


# --- operations

def fct_incidents_and_maintenance(work_orders: DataFrame, shifts: DataFrame) -> DataFrame:
    """Work orders and officer shifts as one event table."""
    maintenance = work_orders.select(
        F.col("work_orders_sk").alias("event_sk"), F.col("wo_id").alias("source_record_id"),
        "parks_sk", typed_null("string").alias("assigned_region"),
        F.col("reported_date").alias("start_date"), F.col("completed_date").alias("end_date"),
        F.lit(WORK_ORDER).alias("event_category"), F.col("wo_type").alias("event_type"),
        F.col("status").alias("event_status"), "labor_hours",
        F.col("total_cost").alias("financial_cost"), "source_system")
    patrol = shifts.select(
        F.col("officer_shifts_sk").alias("event_sk"),
        F.col("activity_id").alias("source_record_id"),
        F.col("assigned_region").cast("string").alias("assigned_region"),
        F.col("shift_date").alias("start_date"), F.col("shift_date").alias("end_date"),
        F.lit(SHIFT).alias("event_category"), F.lit("Patrol").alias("event_type"),
        F.lit("Completed").alias("event_status"), "visitor_contacts", "resource_checks",
        F.col("patrol_miles").cast("decimal(10,2)").alias("patrol_miles"), "source_system")
    return union_conformed([maintenance, patrol]).select(
        surrogate_key("event_sk", "event_category").alias("incidents_and_maintenance_sk"),
        "event_sk", "source_record_id", "parks_sk", "assigned_region", "start_date", "end_date",
        "event_category", "event_type", "event_status", "labor_hours", "financial_cost",
        "visitor_contacts", "resource_checks", "patrol_miles", "source_system",
        first_set("start_date", "end_date").alias("event_date"))


# --- reporting

def rpt_agency_performance(expenditures: DataFrame, visitation: DataFrame, events: DataFrame,
                           null_safe: bool = False) -> DataFrame:
    """Park × month: spending, visitors and maintenance events.

    Expenditures carry no park, so with ``null_safe=False`` their rows show zeros;
    ``null_safe=True`` reports them under the NULL park.
    """
    keys = ["parks_sk", "report_month"]
    spent = by_month(expenditures, ["parks_sk"], "expenditure_month_date",
                     {"total_expenditures": F.sum("amount")})
    visited = by_month(visitation, ["parks_sk"], "date_sk",
                       {"total_visitors": F.sum("total_estimated_visitors")})
    serviced = by_month(events.where(F.col("event_category") == WORK_ORDER), ["parks_sk"],
                        "event_date", {"total_incidents": F.count("event_sk")})
    merged = merge_aggregates([spent, visited, serviced], keys, null_safe)
    return merged.select(
        surrogate_key(*keys).alias("performance_sk"), F.col("report_month").cast("date"), "parks_sk",
        zero("total_expenditures").cast("decimal(38,2)").alias("total_expenditures"),
        *[zero(m).alias(m) for m in ("total_visitors", "total_incidents")])
