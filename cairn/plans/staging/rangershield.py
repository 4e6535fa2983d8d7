"""Enforcement."""

from cairn.operators.projection import StagingSpec

SYSTEM = "rangershield"

# Source columns with their types, and the names the outputs carry.
MODELS = {
    "citations": StagingSpec(
        SYSTEM, "citations", "hk_citation", "citation_number",
        {"citation_number": "string", "incident_number": "string", "issuing_officer": "string",
         "violation_code": "string", "issue_timestamp": "timestamp_ntz",
         "fine_amount": "decimal(6,2)", "court_disposition": "string"},
        {"issuing_officer": "issuing_officer_badge"}),
    "dispatch_logs": StagingSpec(
        SYSTEM, "dispatch_logs", "hk_dispatch_log", "log_id",
        {"log_id": "string", "incident_number": "string", "badge_number": "string",
         "log_timestamp": "timestamp_ntz", "event_type": "string",
         "radio_traffic_transcript": "string"}),
    "incidents": StagingSpec(
        SYSTEM, "incidents", "hk_incident", "incident_number",
        {"incident_number": "string", "reporting_officer": "string", "incident_type": "string",
         "report_timestamp": "timestamp_ntz", "location_narrative": "string",
         "narrative_summary": "string", "review_status": "string"},
        {"reporting_officer": "reporting_officer_badge"}),
    "officer_activity": StagingSpec(
        SYSTEM, "officer_activity", "hk_officer_activity", "activity_id",
        {"activity_id": "string", "badge_number": "string", "shift_date": "date",
         "shift_start_time": "timestamp_ntz", "shift_end_time": "timestamp_ntz",
         "patrol_miles": "decimal(5,1)", "visitor_contacts": "int", "resource_checks": "int"}),
    "officers": StagingSpec(
        SYSTEM, "officers", "hk_officer", "badge_number",
        {"badge_number": "string", "first_name": "string", "last_name": "string",
         "rank": "string", "certification_status": "string", "assigned_region": "int"}),
    "use_of_force": StagingSpec(
        SYSTEM, "use_of_force", "hk_use_of_force", "uof_id",
        {"uof_id": "string", "incident_number": "string", "involved_officer": "string",
         "force_level": "string", "subject_injury": "boolean", "officer_injury": "boolean",
         "internal_review_status": "string"},
        {"involved_officer": "involved_officer_badge"}),
}
