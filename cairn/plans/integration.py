"""Integration models: conformed entities across source systems.

Each function takes staged frames and returns one entity. They stay lazy; a build
that feeds several marts should store them once with ``materialize(..., "table")``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions import (
    clean_string,
    is_set,
    padded_key,
    salted_key,
    source_tag,
    surrogate_key,
    typed_null,
)
from cairn.operators.dedup import golden_record
from cairn.operators.filters import live_rows
from cairn.operators.joins import attach_to_keys, left_lookup, lookup_first, lookup_on
from cairn.operators.projection import keep_and_add
from cairn.operators.reshape import union_conformed
from cairn.plans.codes import SystemCodes

# Columns no register fills yet; kept so the entity has its full shape.
ADDRESS_COLUMNS = {
    "address1_city": "string",
    "address1_stateorprovince": "string",
    "address1_postalcode": "string",
    "address1_latitude": "decimal(10,6)",
    "address1_longitude": "decimal(10,6)",
}


def _address() -> list[Column]:
    return [typed_null(t).alias(c) for c, t in ADDRESS_COLUMNS.items()]


def int_parks(geo: DataFrame, bookings: DataFrame, assets: DataFrame,
              codes: SystemCodes = SystemCodes(), fold_case: bool = False) -> DataFrame:
    """Three park registers merged on the cleaned name.

    The geographic register's row wins; acreage, class, region and the asset system's
    id take the largest value of the whole name group. Ids of two registers can be
    equal, so the system code decides last.
    """
    rows = union_conformed([
        geo.select(
            surrogate_key("geo_park_id").alias("parks_sk"),
            F.col("geo_park_id").alias("accountnumber"),
            F.col("park_name").alias("name"),
            F.col("gis_steward").alias("description"),
            "total_acres",
            source_tag(codes.geo).alias("source_system"),
        ),
        bookings.select(
            surrogate_key("park_id").alias("parks_sk"),
            F.col("park_id").alias("accountnumber"),
            F.col("park_name").alias("name"),
            "classification", "region_id",
            source_tag(codes.bookings).alias("source_system"),
        ),
        assets.select(
            surrogate_key("park_id").alias("parks_sk"),
            F.col("park_id").cast("string").alias("accountnumber"),
            F.col("park_name").alias("name"),
            "classification", "region_id",
            F.col("park_id").alias("infratrak_park_id"),
            source_tag(codes.assets).alias("source_system"),
        ),
    ])
    merged = golden_record(
        rows, clean_string("name", fold_case),
        merge=["total_acres", "classification", "region_id", "infratrak_park_id"],
        source="source_system", ranks=[codes.geo],
        tie=["parks_sk", "source_system"])
    return merged.select(
        "parks_sk", "accountnumber", "name", "description", *_address(), "source_system",
        "total_acres", "classification", "region_id", "infratrak_park_id")


def int_contacts(customers: DataFrame) -> DataFrame:
    return customers.select(
        surrogate_key("customer_id").alias("contacts_sk"),
        F.col("customer_id").alias("contact_id"),
        "first_name", "last_name",
        F.col("email").alias("e_mail_address1"),
        F.col("phone").alias("mobile_phone"),
        "address_state", "account_created_at", "has_annual_pass", "is_senior", "is_veteran",
        is_set("merged_into_customer_id").alias("is_merged_duplicate"),
    )


def contact_keys(customers: DataFrame) -> DataFrame:
    """Id and key of every contact, from any versions of the customers.

    ``int_contacts`` has one row per customer id, so facts that only need the key are
    linked to this: one narrow distinct instead of picking every customer's newest row.
    """
    ids = customers.select(F.col("customer_id").cast("string").alias("contact_id")).distinct()
    return ids.withColumn("contacts_sk", surrogate_key("contact_id"))


def int_customer_assets(inventory: DataFrame, parks: DataFrame) -> DataFrame:
    """Bookable assets linked to their park by the padded park number."""
    named = keep_and_add(inventory, name=F.col("asset_id"))
    linked = lookup_on(named, parks, padded_key("park_id"), "accountnumber", ["parks_sk"])
    return linked.select(
        surrogate_key("asset_id").alias("customer_assets_sk"),
        F.col("asset_id").alias("customerasset_id"),
        F.col("parks_sk").alias("_parent_park_sk"),
        "name",
    )


def transactions_linked(pos: DataFrame, contacts: DataFrame, parks: DataFrame) -> DataFrame:
    """Every point-of-sale column plus contact and park keys.

    Both the entity and the fact are projections of this frame, so the fact needs no
    second join of the transactions to themselves.
    """
    linked = left_lookup(pos, contacts, {"customer_id": "contact_id"}, ["contacts_sk"], cast=True)
    linked = lookup_on(linked, parks, padded_key("park_id"), "accountnumber", ["parks_sk"])
    return linked.withColumnsRenamed({"contacts_sk": "_contact_sk", "parks_sk": "_park_sk"}
                                     ).withColumn("transactions_sk", surrogate_key("transaction_id"))


def int_transactions(linked: DataFrame) -> DataFrame:
    return linked.select(
        "transactions_sk", "transaction_id",
        F.col("transaction_created_at").alias("book_date"),
        F.col("transaction_amount").alias("amount"),
        "_contact_sk", "_park_sk",
    )


def visits_linked(reservations: DataFrame, contacts: DataFrame, assets: DataFrame) -> DataFrame:
    """Every reservation column plus contact, asset and park keys (see transactions_linked)."""
    linked = left_lookup(
        reservations, contacts, {"customer_id": "contact_id"}, ["contacts_sk"], cast=True)
    linked = left_lookup(
        linked, assets, {"asset_id": "customerasset_id"},
        ["customer_assets_sk", "_parent_park_sk"], cast=True)
    return linked.withColumnsRenamed({
        "contacts_sk": "_contact_sk", "customer_assets_sk": "_asset_sk",
        "_parent_park_sk": "_park_sk",
    }).withColumn("visits_sk", surrogate_key("reservation_id"))


def int_visits(linked: DataFrame) -> DataFrame:
    return linked.select(
        "visits_sk", F.col("reservation_id").alias("visit_id"), "_contact_sk", "_asset_sk", "_park_sk")


def int_financial_transactions(ledger: DataFrame, accounts: DataFrame, awards: DataFrame,
                               award_budget: DataFrame, codes: SystemCodes = SystemCodes(),
                               keep: Sequence[str] = (), late: Mapping[str, Column] | None = None
                               ) -> DataFrame:
    """Ledger entries with account labels, the latest award of the fund and its budget.

    Labels, award and its budgets of all years meet once per account and fund code of the
    ledger, so that the wide entries are shuffled once, not for every lookup. ``keep`` lists
    further ledger columns to pass on; ``late`` are columns the ledger does not bring,
    computed from its others behind that shuffle.
    """
    budgets = F.struct("fiscal_year", "budgeted_amount", "actual_amount")
    yearly = award_budget.groupBy("award_id").agg(F.collect_list(budgets).alias("__budgets"))
    labelled = left_lookup(
        ledger.select("account_id", "account_fund_code").distinct(), accounts, ["account_id"],
        ["fund_description", "division_description", "program_description", "object_description"])
    awarded = lookup_first(
        labelled, left_lookup(awards, yearly, ["award_id"], ["__budgets"]),
        {"account_fund_code": "sgf_appropriation_code"},
        [F.desc_nulls_last("performance_end"), F.asc_nulls_last("award_id")],
        ["award_id", "award_number", "award_amount", "required_match_percentage",
         "performance_start", "performance_end", "__budgets"])
    linked = attach_to_keys(ledger, [awarded], ["account_id", "account_fund_code"], null_safe=True
                            ).withColumns(dict(late or {}))
    of_year = F.filter("__budgets", lambda b: b["fiscal_year"] == F.col("fiscal_year"))
    budgeted = linked.withColumn("__budget", F.explode_outer(of_year)).select(
        "*", "__budget.budgeted_amount", "__budget.actual_amount")
    return budgeted.select(
        surrogate_key("gl_entry_id").alias("financials_sk"),
        "gl_entry_id", "fiscal_year", "accounting_month", "entry_type", "amount", "account_id",
        "account_fund_code", "account_division_code", "account_program_code",
        "account_object_code", "fund_description", "division_description",
        "program_description", "object_description", "batch_reference", "batch_detail_text",
        "batch_entry_count", "award_id", "award_number", "award_amount",
        "required_match_percentage", "performance_start", "performance_end",
        F.col("budgeted_amount").alias("award_fiscal_year_budget"),
        F.col("actual_amount").alias("award_fiscal_year_actual"),
        source_tag(codes.finance).alias("source_system"), *keep,
    )


def int_physical_assets(assets: DataFrame, features: DataFrame, parks: DataFrame,
                        codes: SystemCodes = SystemCodes()) -> DataFrame:
    """Two asset registers, unreconciled, with each park resolved its own way."""
    managed = left_lookup(assets, parks, {"park_id": "infratrak_park_id"}, ["parks_sk"])
    mapped = left_lookup(features, parks, {"geo_park_id": "accountnumber"}, ["parks_sk"])
    return union_conformed([
        managed.select(
            surrogate_key("asset_tag").alias("physical_assets_sk"),
            F.col("asset_tag").alias("asset_id"), "parks_sk",
            F.col("asset_category").alias("feature_class"),
            F.col("asset_category").alias("sub_type"), "description",
            F.col("construction_year").alias("installation_year"), "replacement_value",
            "expected_lifespan_years", F.col("latitude").alias("point_latitude"),
            F.col("longitude").alias("point_longitude"), typed_null("string").alias("geometry_wkt"),
            typed_null("decimal(5,2)").alias("positional_accuracy_meters"),
            typed_null("date").alias("last_updated"), typed_null("string").alias("status"),
            "is_visible_in_survey", source_tag(codes.assets).alias("source_system"),
        ),
        mapped.select(
            surrogate_key("feature_id").alias("physical_assets_sk"),
            F.col("feature_id").alias("asset_id"), "parks_sk", "feature_class", "sub_type",
            "installation_year", "geometry_wkt", "positional_accuracy_meters", "last_updated",
            "status", source_tag(codes.geo).alias("source_system"),
        ),
    ])


def int_ecological_surveys(flora_fauna: DataFrame, water: DataFrame, invasive: DataFrame,
                           sites: DataFrame, parks: DataFrame) -> DataFrame:
    """Three kinds of field observation in one sparse table.

    The kinds are united before the site and park joins, so those run once.
    """
    def kind(name: str, df: DataFrame, key: str, on: str, *columns: str) -> DataFrame:
        return df.select(
            salted_key(name, key).alias("ecological_surveys_sk"),
            F.col(key).alias("observation_id"), "site_id",
            F.lit(name).alias("observation_type"), F.col(on).alias("observation_date"), *columns)

    point = ("latitude", "longitude")
    rows = union_conformed([
        kind("flora_fauna", flora_fauna, "survey_id", "survey_date", "species_code",
             "observer_name", *point, "count_estimate", "density_estimate_per_hectare"),
        kind("water_quality", water, "test_id", "sample_date", "dissolved_oxygen_mgl", "ph_level",
             "ecoli_cfu_100ml", "turbidity_ntu", "temperature_celsius", "nitrogen_mgl",
             "phosphorus_mgl", "protocol_era"),
        kind("invasive_species", invasive, "observation_id", "observation_date", "species_code",
             *point, "extent_square_meters", "treatment_applied", "treatment_date"),
    ])
    placed = left_lookup(rows, sites, ["site_id"], ["park_id"])
    placed = left_lookup(placed, parks, {"park_id": "infratrak_park_id"}, ["parks_sk"])
    return placed.select(
        "ecological_surveys_sk", "observation_id", "site_id", "parks_sk", "observation_type",
        "observation_date", "species_code", "observer_name", *point, "count_estimate",
        "density_estimate_per_hectare", "extent_square_meters", "treatment_applied",
        "treatment_date", "dissolved_oxygen_mgl", "ph_level", "ecoli_cfu_100ml",
        "turbidity_ntu", "temperature_celsius", "nitrogen_mgl", "phosphorus_mgl", "protocol_era")


def int_visitor_counts(metrics: DataFrame, sensors: DataFrame, parks: DataFrame) -> DataFrame:
    """Live sensor estimates with sensor and park."""
    counted = left_lookup(
        live_rows(metrics), live_rows(sensors).withColumn("__park", F.col("park_id").cast("int")),
        ["sensor_id"], ["__park", "sensor_type", "location_description"])
    counted = left_lookup(counted, parks, {"__park": "infratrak_park_id"}, ["parks_sk"])
    return counted.select(
        surrogate_key("metric_id").alias("visitor_counts_sk"),
        "metric_id", "sensor_id", "parks_sk", "target_date", "estimated_total_visitors",
        "vehicle_multiplier_used", "calculation_timestamp", "sensor_type",
        "location_description")


def int_employees(employees: DataFrame, positions: DataFrame, org_units: DataFrame,
                  codes: SystemCodes = SystemCodes()) -> DataFrame:
    """Live employees with their position (also a deleted one) and live org unit."""
    placed = left_lookup(
        live_rows(employees), positions.withColumn("__matched", F.col("position_id")),
        ["position_id"],
        ["__matched", "job_classification", "pay_grade", "funding_source", "is_active", "org_unit_id"])
    placed = left_lookup(
        placed, live_rows(org_units).withColumn("__unit", F.col("org_unit_id")), ["org_unit_id"],
        ["__unit", "org_unit_name", "region_id"])
    return placed.select(
        surrogate_key("employee_id").alias("employees_sk"),
        "employee_id", "first_name_hash", "last_name_hash", "email_hash", "phone_hash",
        "hire_date", "separation_date", F.col("__matched").alias("position_id"),
        "job_classification", "pay_grade", "funding_source",
        F.col("is_active").alias("position_is_active"), F.col("__unit").alias("org_unit_id"),
        "org_unit_name", "region_id", source_tag(codes.people).alias("source_system"))


def int_officer_shifts(activity: DataFrame, officers: DataFrame, codes: SystemCodes = SystemCodes()
                       ) -> DataFrame:
    """Shifts with officer attributes; joined to no other system."""
    shifts = left_lookup(
        activity, officers, ["badge_number"], ["rank", "certification_status", "assigned_region"])
    return shifts.select(
        surrogate_key("activity_id").alias("officer_shifts_sk"),
        "activity_id", "badge_number", "shift_date", "shift_start_time", "shift_end_time",
        "patrol_miles", "visitor_contacts", "resource_checks", "rank", "certification_status",
        "assigned_region", source_tag(codes.enforcement).alias("source_system"))


def int_work_orders(work_orders: DataFrame, parks: DataFrame, codes: SystemCodes = SystemCodes()
                    ) -> DataFrame:
    placed = left_lookup(work_orders, parks, {"park_id": "infratrak_park_id"}, ["parks_sk"])
    return placed.select(
        surrogate_key("wo_id").alias("work_orders_sk"),
        "wo_id", "asset_tag", "parks_sk", "primary_assignee", "wo_type", "status", "labor_hours",
        "material_cost", "total_cost", "reported_date", "completed_date",
        source_tag(codes.assets).alias("source_system"))


def int_vendors(vendors: DataFrame, codes: SystemCodes = SystemCodes()) -> DataFrame:
    return vendors.select(
        surrogate_key("vendor_id").alias("vendors_sk"),
        "vendor_id", "vendor_name", "vendor_type", "is_active", "tin_masked",
        source_tag(codes.finance).alias("source_system"))


