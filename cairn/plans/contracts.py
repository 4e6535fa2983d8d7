"""Declared contracts of the mart models: exact columns, order and types."""

from __future__ import annotations

# The columns and types the marts publish.
_DECLARED = {
    "fct_visitation": """visitation_sk string; parks_sk string; date_sk date; registered_visitors bigint;
        checked_in_reservations bigint; sensor_estimated_visitors bigint; total_estimated_visitors bigint""",
    "dim_date": """date_sk date; full_date date; calendar_year bigint; calendar_month bigint; day_of_month bigint;
        calendar_quarter bigint; fiscal_year int; fiscal_month int; fiscal_quarter int; day_name string; month_name string""",
    "dim_assets": """asset_sk string; asset_id string; parks_sk string; feature_class string; sub_type string;
        description string; installation_year int; replacement_value decimal(12,2); expected_lifespan_years int;
        point_latitude decimal(9,6); point_longitude decimal(9,6); geometry_wkt string;
        positional_accuracy_meters decimal(5,2); last_updated date; status string; is_visible_in_survey boolean;
        source_system string""",
    "dim_employees": """employee_sk string; employee_id string; first_name_hash string; last_name_hash string;
        email_hash string; phone_hash string; hire_date date; separation_date date; position_id string;
        job_classification string; pay_grade string; funding_source string; position_is_active boolean;
        org_unit_id string; org_unit_name string; region_id int; source_system string""",
    "dim_vendors": """vendor_sk string; vendor_id string; vendor_name string; vendor_type string; is_active boolean;
        tin_masked string; source_system string""",
    "fct_incidents_and_maintenance": """incidents_and_maintenance_sk string; event_sk string; source_record_id string;
        parks_sk string; assigned_region string; start_date date; end_date date; event_category string;
        event_type string; event_status string; labor_hours decimal(6,2); financial_cost decimal(10,2);
        visitor_contacts int; resource_checks int; patrol_miles decimal(10,2); source_system string; event_date date""",
    "rpt_agency_performance": """performance_sk string; report_month date; parks_sk string;
        total_expenditures decimal(38,2); total_visitors bigint; total_incidents bigint""",
    "dim_parks": """parks_sk string; park_name string; region string; acreage decimal(10,2); park_type string;
        operational_status string; address1_city string; address1_stateorprovince string; address1_postalcode string;
        address1_latitude decimal(10,6); address1_longitude decimal(10,6); acreage_size_tier string;
        infratrak_park_id int""",
    "dim_customers": """contacts_sk string; customer_name string; email string; phone string; address_state string;
        customer_since_date timestamp_ntz; geographic_region string; customer_tenure_tier string;
        is_merged_duplicate boolean; has_annual_pass boolean; is_senior boolean; is_veteran boolean""",
    "dim_reservation_inventory": """customer_assets_sk string; parks_sk string; asset_name string; asset_type string;
        park_assignment string; capacity int; accessibility_status string; amenities string; asset_type_group string;
        capacity_tier string""",
    "fct_reservations": """reservations_sk string; contacts_sk string; customer_assets_sk string; parks_sk string;
        reservation_status string; reservation_amount decimal(10,2); check_in_date date; check_out_date date;
        reservation_created_at timestamp_ntz; nights_stayed int; booking_source string; promo_code string;
        number_of_guests int""",
    "fct_pos_transactions": """transactions_sk string; contacts_sk string; parks_sk string;
        transaction_amount decimal(10,2); quantity int; revenue_category string; transaction_created_at timestamp_ntz;
        is_kiosk_entry boolean""",
    "fct_park_occupancy_daily_snapshot": """occupancy_snapshot_sk string; parks_sk string; park_name string;
        region string; snapshot_date date; calendar_year bigint; calendar_month bigint; calendar_quarter bigint;
        fiscal_year bigint; fiscal_month bigint; day_name string; day_of_month bigint;
        active_reservation_count bigint; total_guests_on_site bigint; total_reservation_revenue_in_stay decimal(14,2)""",
    "rpt_park_revenue_summary": """parks_sk string; report_month date; park_name string; region string;
        park_type string; total_reservations int; total_reservation_revenue decimal(14,2);
        avg_reservation_value decimal(14,2); total_nights_stayed int; avg_nights_per_reservation decimal(10,2);
        total_pos_transactions int; total_pos_revenue decimal(14,2); avg_pos_transaction_value decimal(14,2);
        total_pos_items_sold int; total_combined_revenue decimal(14,2)""",
}
CONTRACTS: dict[str, dict[str, str]] = {
    model: dict(entry.split() for entry in text.split(";")) for model, text in _DECLARED.items()
}
