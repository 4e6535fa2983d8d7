"""People."""

from cairn.functions import hash_pii
from cairn.operators.projection import StagingSpec

SYSTEM = "peoplefirst"

# Source columns with their types, and the names the outputs carry.
DELETED = {"_is_deleted": "is_deleted"}
MODELS = {
    "benefits": StagingSpec(
        SYSTEM, "benefits", "hk_benefit", "employee_id",
        {"employee_id": "string", "health_plan_type": "string", "retirement_tier": "string",
         "annual_leave_hours": "decimal(6,2)", "sick_leave_hours": "decimal(6,2)",
         "comp_time_hours": "decimal(6,2)", "_is_deleted": "boolean"}, DELETED),
    "employees": StagingSpec(
        SYSTEM, "employees", "hk_employee", "employee_id",
        {"employee_id": "string", "hire_date": "date", "separation_date": "date",
         "position_id": "string", "_is_deleted": "boolean"}, DELETED,
        lambda: {f"{c}_hash": hash_pii(c) for c in ("first_name", "last_name", "email", "phone")}),
    "leave_balances": StagingSpec(
        SYSTEM, "leave_balances", "hk_leave_balance", "leave_balance_id",
        {"leave_balance_id": "string", "employee_id": "string", "leave_type": "string",
         "balance_amount": "decimal(6,2)", "as_of_date": "date", "_is_deleted": "boolean"},
        DELETED),
    "org_units": StagingSpec(
        SYSTEM, "org_units", "hk_org_unit", "org_unit_id",
        {"org_unit_id": "string", "org_unit_name": "string", "region_id": "int",
         "_is_deleted": "boolean"}, DELETED),
    "payroll": StagingSpec(
        SYSTEM, "payroll", "hk_payroll", "payroll_id",
        {"payroll_id": "string", "employee_id": "string", "pay_period_start": "date",
         "pay_period_end": "date", "gross_pay": "decimal(10,2)", "deductions": "decimal(10,2)",
         "taxes_withheld": "decimal(10,2)", "net_pay": "decimal(10,2)",
         "_is_deleted": "boolean"}, DELETED),
    "positions": StagingSpec(
        SYSTEM, "positions", "hk_position", "position_id",
        {"position_id": "string", "job_classification": "string", "pay_grade": "string",
         "org_unit_id": "string", "funding_source": "string", "is_active": "boolean",
         "_is_deleted": "boolean"}, DELETED),
    "seasonal_workforce": StagingSpec(
        SYSTEM, "seasonal_workforce", "hk_seasonal_employee", "seasonal_emp_id",
        {"seasonal_emp_id": "string", "org_unit_id": "string", "season_year": "int",
         "actual_start_date": "date", "system_onboard_date": "date", "separation_date": "date",
         "hourly_rate": "decimal(6,2)", "_is_deleted": "boolean"}, DELETED,
        lambda: {f"{c}_hash": hash_pii(c) for c in ("first_name", "last_name")}),
}
