"""Ecology surveys."""

from cairn.functions import null_if, try_int
from cairn.operators.projection import StagingSpec

SYSTEM = "biosurvey"

# Source columns with their types, and the names the outputs carry.
MODELS = {
    "endangered_species_observations": StagingSpec(
        SYSTEM, "endangered_species_monitoring", "hk_endangered_monitoring", "monitoring_id",
        {"monitoring_id": "string", "site_id": "string", "species_code": "string",
         "monitoring_year": "int", "population_count": "int", "nesting_pairs": "int",
         "reproductive_success_rate": "decimal(5,2)", "compliance_reported": "boolean"}),
    "field_observations_raw": StagingSpec(
        SYSTEM, "field_observations_raw", "hk_observation", "raw_id",
        {"raw_id": "bigint", "observation_type": "string", "site_id": "string",
         "species_code": "string", "observation_date": "date", "observer_name": "string",
         "count_estimate": "int", "density_estimate_per_hectare": "decimal(8,2)",
         "ph_level": "decimal(4,2)", "turbidity_ntu": "decimal(6,2)",
         "temperature_celsius": "decimal(5,2)", "gps_latitude": "decimal(9,6)",
         "gps_longitude": "decimal(9,6)", "notes": "string"},
        derived=lambda: {"nesting_status": null_if("nesting_status", "None"),
                         "ecoli_count": try_int("ecoli_count")}),
    "flora_fauna_surveys": StagingSpec(
        SYSTEM, "flora_fauna_surveys", "hk_flora_fauna_survey", "survey_id",
        {"survey_id": "string", "site_id": "string", "species_code": "string",
         "survey_date": "date", "observer_name": "string", "count_estimate": "int",
         "density_estimate_per_hectare": "decimal(8,2)", "latitude": "decimal(9,6)",
         "longitude": "decimal(9,6)"}),
    "invasive_species_observations": StagingSpec(
        SYSTEM, "invasive_species_observations", "hk_invasive_observation", "observation_id",
        {"observation_id": "string", "site_id": "string", "species_code": "string",
         "observation_date": "date", "extent_square_meters": "decimal(10,2)",
         "treatment_applied": "string", "treatment_date": "date", "latitude": "decimal(9,6)",
         "longitude": "decimal(9,6)"}),
    "species_codes": StagingSpec(
        SYSTEM, "species_codes", "hk_species", "species_code",
        {"species_code": "string", "common_name": "string", "scientific_name": "string",
         "category": "string", "is_endangered": "boolean", "is_invasive": "boolean",
         "alternate_names": "string"}),
    "survey_sites": StagingSpec(
        SYSTEM, "survey_sites", "hk_survey_site", "site_id",
        {"site_id": "string", "park_id": "int", "site_name": "string",
         "site_description": "string"}),
    "water_quality_tests": StagingSpec(
        SYSTEM, "water_quality_tests", "hk_water_quality_test", "test_id",
        {"test_id": "string", "site_id": "string", "sample_date": "date",
         "dissolved_oxygen_mgl": "decimal(6,2)", "ph_level": "decimal(4,2)",
         "ecoli_cfu_100ml": "int", "turbidity_ntu": "decimal(6,2)",
         "temperature_celsius": "decimal(5,2)", "nitrogen_mgl": "decimal(6,2)",
         "phosphorus_mgl": "decimal(6,2)", "protocol_era": "string"}),
}
