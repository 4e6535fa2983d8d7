"""Grants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions import parse_date, parse_money, split_contact, surrogate_key
from cairn.operators.dedup import drop_exact_duplicates
from cairn.operators.filters import any_present
from cairn.operators.projection import StagingSpec
from cairn.operators.reshape import unpivot_groups

SYSTEM = "granttrack"

# Source columns with their types, and the names the outputs carry.
MODELS = {
    "active_awards": StagingSpec(
        SYSTEM, "active_awards", "hk_award", "award_id",
        {"award_id": "string", "application_id": "string", "award_number": "string",
         "sgf_appropriation_code": "string", "required_match_percentage": "decimal(5,2)",
         "award_amount": "decimal(12,2)", "performance_start": "date",
         "performance_end": "date"}),
    "compliance_deadlines": StagingSpec(
        SYSTEM, "compliance_deadlines", "hk_compliance_deadline", "deadline_id",
        {"deadline_id": "string", "award_id": "string", "report_type": "string",
         "status": "string"},
        derived=lambda: {"due_date": parse_date("due_date"),
                         "submission_date": parse_date("submission_date")}),
    "grant_applications": StagingSpec(
        SYSTEM, "grant_applications", "hk_grant_application", "application_id",
        {"application_id": "string", "grant_program": "string", "status": "string",
         "submission_date": "date", "estimated_award_date": "date",
         "requested_amount": "decimal(12,2)", "primary_contact": "string"},
        renames={"primary_contact": "primary_contact_raw"},
        derived=lambda: split_contact("primary_contact")),
    "match_fund_transactions": StagingSpec(
        SYSTEM, "match_fund_tracking", "hk_match_fund", "match_id",
        {"match_id": "string", "award_id": "string", "match_type": "string",
         "description": "string", "contributors": "string", "amount_value": "decimal(10,2)",
         "transaction_date": "date"}),
    "reimbursement_requests": StagingSpec(
        SYSTEM, "reimbursement_requests", "hk_reimbursement_request", "request_id",
        {"request_id": "string", "award_id": "string", "sgf_encumbrance_ref": "string",
         "requested_amount": "decimal(10,2)", "approved_amount": "decimal(10,2)",
         "submission_date": "date", "receipt_date": "date"}),
}
BUDGET_YEARS = (2020, 2021, 2022, 2023, 2024, 2025)


def award_budget_by_fiscal_year(source: DataFrame) -> DataFrame:
    """Wide yearly budgets as one row per award and year, in one scan.

    Duplicated awards keep one row; a year with neither amount is left out; amounts
    are parsed after the filter, so TBD keeps its row with a NULL amount.
    """
    long = unpivot_groups(
        drop_exact_duplicates(source, ["award_id"]),
        keep=["award_id", "award_number", "notes"],
        label="fiscal_year",
        groups={y: {"raw_budgeted": f"fy{y}_budgeted", "raw_actual": f"fy{y}_actual"}
                for y in BUDGET_YEARS},
    )
    return any_present(long, ["raw_budgeted", "raw_actual"]).select(
        surrogate_key("award_id", "fiscal_year").alias("hk_award_budget"),
        F.col("award_id").cast("string"),
        F.col("award_number").cast("string"),
        F.col("fiscal_year").cast("int"),
        parse_money("raw_budgeted").alias("budgeted_amount"),
        parse_money("raw_actual").alias("actual_amount"),
        F.col("notes").cast("string"),
    )
