"""Legacy reservations."""

from cairn.functions import parse_era_timestamp, percent_to_rate, tagged_count
from cairn.operators.projection import StagingSpec

SYSTEM = "legacyres"

# Source columns with their types, and the names the outputs carry.
GUEST_TAGS = {"guest_count_adults": "Adults", "guest_count_children": "Kids",
              "guest_count_pets": "Pets", "guest_count_vehicles": "Vehicles"}
MODELS = {
    "customers": StagingSpec(
        SYSTEM, "legacy_customers", "hk_customers", "legacy_cust_id",
        {"legacy_cust_id": "string", "first_name": "string", "last_name": "string",
         "email": "string", "phone_number": "string", "partial_card_mask": "string"},
        renames={"legacy_cust_id": "legacy_customer_id"}),
    "fee_schedule": StagingSpec(
        SYSTEM, "legacy_fee_schedule_wide", "hk_fee_schedule", "facility_type",
        {"facility_type": "string", "base_rate_peak": "decimal(6,2)",
         "base_rate_offpeak": "decimal(6,2)", "base_rate_shoulder": "decimal(6,2)",
         "export_date": "date"},
        renames={"export_date": "schedule_export_date"},
        derived=lambda: {"resident_discount_rate": percent_to_rate("resident_discount_pct"),
                         "senior_discount_rate": percent_to_rate("senior_discount_pct")}),
    "park_crosswalk": StagingSpec(
        SYSTEM, "legacy_park_crosswalk", "hk_park_crosswalk", "legacy_park_id",
        {"legacy_park_id": "string", "legacy_park_name": "string", "current_park_id": "int"}),
    "reservations": StagingSpec(
        SYSTEM, "legacy_reservations", "hk_reservations", "res_id",
        {"res_id": "string", "legacy_cust_id": "string", "legacy_park_id": "string",
         "total_paid": "decimal(10,2)", "data_format_source": "string"},
        renames={"res_id": "reservation_id", "legacy_cust_id": "legacy_customer_id"},
        derived=lambda: {
            "arrival_date": parse_era_timestamp("arrival_date"),
            "departure_date": parse_era_timestamp("departure_date"),
            **{name: tagged_count("guest_info", tag) for name, tag in GUEST_TAGS.items()}}),
    "revenue_summaries": StagingSpec(
        SYSTEM, "legacy_revenue_summaries", "hk_revenue_summaries", "summary_id",
        {"summary_id": "string", "legacy_park_id": "string", "report_month": "date",
         "revenue_category": "string", "total_revenue": "decimal(10,2)"}),
}
