"""Bookings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions import json_fields_guarded, json_text, source_tag, staleness_days
from cairn.operators.dedup import latest_per_key
from cairn.operators.projection import StagingSpec

SYSTEM = "vistareserve"

def _booking(*names: str) -> dict[str, Column]:
    fields = json_fields_guarded("booking_metadata", *names)
    return fields | {"number_of_guests": fields["number_of_guests"].cast("int")}


# Source columns with their types, and the names the outputs carry.
MODELS = {
    "asset_crosswalks": StagingSpec(
        SYSTEM, "asset_crosswalk", "hk_asset_crosswalks", "vista_asset_id",
        {"geoparks_feature_id": "string", "vista_asset_id": "string",
         "infratrak_asset_tag": "string", "source_system": "string",
         "days_since_last_update": "int", "last_verified_date": "date"}),
    "customer_profiles": StagingSpec(
        SYSTEM, "customer_profiles", "hk_customer_profiles", "customer_id",
        {"customer_id": "string", "merged_into_customer_id": "string",
         "address_state": "string", "email": "string", "first_name": "string",
         "last_name": "string", "phone": "string", "has_annual_pass": "boolean",
         "is_senior": "boolean", "is_veteran": "boolean", "created_at": "timestamp_ntz"},
        {"created_at": "account_created_at"},
        lambda: {
            "equipment_preference": json_text("preferences_json", "$.equipment_type"),
            "accessibility_needs": json_text("preferences_json", "$.accessibility_needs")}),
    "inventory_assets": StagingSpec(
        SYSTEM, "inventory_assets", "hk_inventory_assets", "asset_id",
        {"asset_id": "string", "park_id": "int", "asset_type": "string",
         "pet_policy": "string", "utility_hookup": "string", "max_occupancy": "int",
         "ada_accessible": "boolean"}, {"ada_accessible": "is_ada_accessible"}),
    "parks": StagingSpec(
        SYSTEM, "parks", "hk_parks", "park_id",
        {"park_id": "string", "region_id": "int", "classification": "string",
         "park_name": "string", "has_unstaffed_kiosk": "boolean"}),
    "pos_transactions": StagingSpec(
        SYSTEM, "pos_transactions", "hk_pos_transactions", "transaction_id",
        {"customer_id": "string", "park_id": "int", "transaction_id": "string",
         "revenue_category": "string", "amount": "decimal(10,2)", "is_kiosk_entry": "boolean",
         "transaction_date": "timestamp_ntz"},
        {"amount": "transaction_amount", "transaction_date": "transaction_created_at"}),
    "reservations": StagingSpec(
        SYSTEM, "reservations", "hk_reservations", "reservation_id",
        {"asset_id": "string", "customer_id": "string", "reservation_id": "string",
         "status": "string", "total_amount": "decimal(10,2)", "arrival_date": "date",
         "booking_date": "timestamp_ntz", "departure_date": "date"},
        {"status": "reservation_status", "booking_date": "reservation_created_at"},
        lambda: _booking("booking_source", "promo_code", "number_of_guests")),
    "revenue_batch": StagingSpec(
        SYSTEM, "revenue_batch", "hk_revenue_batch", "batch_id",
        {"batch_id": "string", "park_id": "int", "revenue_category": "string",
         "gross_revenue": "decimal(12,2)", "transaction_count": "int", "batch_date": "date"}),
}
CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "phone", "address_state", "is_veteran",
    "is_senior", "has_annual_pass", "created_at", "merged_into_customer_id", "preferences_json",
)


def base_customer_profiles(source: DataFrame) -> DataFrame:
    """Newest version of each customer.

    Versions of the same moment are told apart by their own content, so the result
    does not depend on row order.
    """
    rest = [F.asc_nulls_last(c) for c in CUSTOMER_COLUMNS if c not in ("customer_id", "created_at")]
    newest = latest_per_key(source, ["customer_id"], [F.desc_nulls_last("created_at"), *rest])
    return newest.select(*CUSTOMER_COLUMNS)


def base_asset_crosswalks(source: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Crosswalk with its origin and its age in days at ``as_of`` (default: today)."""
    as_of = F.current_date() if as_of is None else as_of
    return source.select(
        "vista_asset_id", "geoparks_feature_id", "infratrak_asset_tag", "last_verified_date",
        source_tag(SYSTEM).alias("source_system"),
        staleness_days("last_verified_date", as_of).alias("days_since_last_update"),
    )
