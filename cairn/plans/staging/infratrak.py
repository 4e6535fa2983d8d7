"""Asset management."""

from cairn.operators.projection import StagingSpec

SYSTEM = "infratrak"

# Source columns with their types, and the names the outputs carry.
MODELS = {
    "assets": StagingSpec(
        SYSTEM, "assets", "hk_asset", "asset_tag",
        {"asset_tag": "string", "park_id": "int", "asset_category": "string",
         "description": "string", "construction_year": "int", "expected_lifespan_years": "int",
         "replacement_value": "decimal(12,2)", "latitude": "decimal(9,6)",
         "longitude": "decimal(9,6)", "is_visible_in_survey": "boolean"}),
    "condition_assessments": StagingSpec(
        SYSTEM, "condition_assessments", "hk_condition_assessment", "assessment_id",
        {"assessment_id": "string", "asset_tag": "string", "inspector_id": "string",
         "fci_score": "int", "notes": "string", "inspection_date": "date"}),
    "deferred_maintenance": StagingSpec(
        SYSTEM, "deferred_maintenance", "hk_deferred_maintenance", "backlog_id",
        {"backlog_id": "string", "asset_tag": "string",
         "estimated_repair_cost": "decimal(12,2)", "is_funded": "boolean",
         "calculation_date": "date"}),
    "employees": StagingSpec(
        SYSTEM, "employees", "hk_employee", "employee_id",
        {"employee_id": "string", "assigned_region": "int", "first_name": "string",
         "last_name": "string", "title": "string"}),
    "parks": StagingSpec(
        SYSTEM, "parks", "hk_park", "park_id",
        {"park_id": "int", "region_id": "int", "park_name": "string",
         "classification": "string"}),
    "work_orders": StagingSpec(
        SYSTEM, "work_orders", "hk_work_order", "wo_id",
        {"wo_id": "string", "asset_tag": "string", "park_id": "int",
         "primary_assignee": "string", "wo_type": "string", "status": "string",
         "labor_hours": "decimal(6,2)", "material_cost": "decimal(10,2)",
         "total_cost": "decimal(10,2)", "reported_date": "date", "completed_date": "date"}),
}
