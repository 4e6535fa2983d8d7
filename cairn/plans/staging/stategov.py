"""State finance."""

from cairn.functions import marker_count, parse_compact_date, split_account
from cairn.operators.projection import StagingSpec

SYSTEM = "stategov"

# Source columns with their types, and the names the outputs carry.
INVOICE_MARKER = "INV-"
MODELS = {
    "accounts_payable": StagingSpec(
        SYSTEM, "accounts_payable", "hk_accounts_payable", "invoice_id",
        {"invoice_id": "string", "vendor_id": "string", "encumbrance_id": "string",
         "account_id": "string", "invoice_date": "date", "payment_date": "date",
         "amount": "decimal(12,2)", "status": "string"},
        derived=lambda: split_account("account_id")),
    "budget_activity_log": StagingSpec(
        SYSTEM, "budget_activity_log", "hk_budget_activity_log", "log_sequence_id",
        {"log_sequence_id": "string", "fiscal_year": "int", "accounting_period": "int",
         "account_id": "string", "activity_type": "string", "amount": "decimal(12,2)",
         "vendor_id": "string", "encumbrance_ref": "string", "revenue_source_code": "string",
         "appropriation_auth": "string", "allotment_period": "string", "batch_id": "string",
         "entry_operator": "string"},
        derived=lambda: {**split_account("account_id"),
                         "effective_date": parse_compact_date("effective_date")}),
    "chart_of_accounts": StagingSpec(
        SYSTEM, "chart_of_accounts", "hk_chart_of_accounts", "account_id",
        {"account_id": "string", "fund_code": "string", "fund_description": "string",
         "division_code": "string", "division_description": "string", "program_code": "string",
         "program_description": "string", "object_code": "string",
         "object_description": "string"}),
    "encumbrances": StagingSpec(
        SYSTEM, "encumbrances", "hk_encumbrances", "encumbrance_id",
        {"encumbrance_id": "string", "vendor_id": "string", "account_id": "string",
         "established_date": "date", "original_amount": "decimal(12,2)",
         "remaining_balance": "decimal(12,2)", "status": "string"},
        derived=lambda: split_account("account_id")),
    "general_ledger": StagingSpec(
        SYSTEM, "general_ledger", "hk_general_ledger", "gl_entry_id",
        {"gl_entry_id": "string", "account_id": "string", "fiscal_year": "int",
         "accounting_month": "int", "entry_type": "string", "amount": "decimal(12,2)",
         "batch_reference": "string", "batch_detail_text": "string"},
        derived=lambda: {**split_account("account_id"),
                         "batch_entry_count": marker_count("batch_detail_text", INVOICE_MARKER)}),
    "vendors": StagingSpec(
        SYSTEM, "vendors", "hk_vendors", "vendor_id",
        {"vendor_id": "string", "vendor_name": "string", "vendor_type": "string",
         "is_active": "boolean", "tin_masked": "string"}),
}
