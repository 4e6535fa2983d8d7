"""Source-shaped input tables, derived from the driver tables.

Each of the 56 source tables is a projection of one whole driver table (or a union
of two), written once in SQL that both Spark and DuckDB accept, so both engines see
the same dirty input. Everything follows from the row's own key: nothing is random
and nothing depends on today's date.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


MONTHS = "January,February,March,April,May,June,July,August,September,October,November,December"
STATES = "MA,CT,RI,NH,VT,ME,NY,NJ,PA,OH,MI,IN,IL,WI,CA,OR,WA,NV,ID,TX,FL,GA,NC,SC,ZZ"


def txt(k: str) -> str:
    return f"cast({k} as string)"


def pick(k: str, options: str) -> str:
    """Option number ``k`` of a comma list, round robin."""
    n = len(options.split(","))
    return f"split_part('{options}', ',', cast({k} % {n} + 1 as int))"


def num(k: str, whole: int) -> str:
    """Text of a number with two decimals below ``whole``."""
    return f"cast({k} % {whole} as string) || '.' || lpad(cast({k} * 7 % 100 as string), 2, '0')"


def gap(expr: str, k: str, every: int) -> str:
    """NULL for every n-th key."""
    return f"case when {k} % {every} = 0 then null else {expr} end"


def day(k: str, span: int, start: str = "2015-01-01") -> str:
    return f"date '{start}' + cast({k} % {span} as int)"


def shift(d: str, k: str) -> str:
    return f"cast({d} as date) + cast({k} as int)"


def two(x: str) -> str:
    return f"lpad(cast({x} as string), 2, '0')"


def mixed_date(d: str, k: str) -> str:
    """One of four renderings by ``k % 4``; every 17th is no date."""
    d = f"cast({d} as date)"
    y, m, dd = f"cast(year({d}) as string)", f"month({d})", f"day({d})"
    full = f"split_part('{MONTHS}', ',', cast({m} as int))"
    return (
        f"case when {k} % 17 = 0 then 'n/a' "
        f"when {k} % 4 = 0 then cast({d} as string) "
        f"when {k} % 4 = 1 then {two(m)} || '/' || {two(dd)} || '/' || {y} "
        f"when {k} % 4 = 2 then {full} || ' ' || cast({dd} as string) || ', ' || {y} "
        f"else substr({full}, 1, 3) || ' ' || {two(dd)} || ', ' || {y} end"
    )


def era_date(d: str, k: str) -> str:
    """One of three renderings by ``k % 3``."""
    d = f"cast({d} as date)"
    y, m, dd = f"cast(year({d}) as string)", two(f"month({d})"), two(f"day({d})")
    return (
        f"case when {k} % 3 = 0 then cast({d} as string) when {k} % 3 = 1 then {m} || {dd} || {y} "
        f"else {m} || '/' || {dd} || '/' || substr({y}, 3, 2) end"
    )


def mixed_money(amount: str, k: str) -> str:
    """``$12,345.67``, ``12345.67`` or ``TBD`` by ``k % 3``."""
    cents = f"cast(floor(abs({amount}) * 100 + 0.5) as bigint)"
    whole = f"cast(floor({cents} / 100) as bigint)"
    frac = f"lpad(cast({cents} % 100 as string), 2, '0')"
    thousands = f"cast(floor({whole} / 1000) as bigint)"
    return (
        f"case when {k} % 3 = 0 then '$' || cast({thousands} as string) || ',' || "
        f"lpad(cast({whole} % 1000 as string), 3, '0') || '.' || {frac} "
        f"when {k} % 3 = 1 then cast({whole} as string) || '.' || {frac} else 'TBD' end"
    )


def account(k: str) -> str:
    return (
        f"cast({k} % 300 + 100 as string) || '-DIV-D' || cast({k} % 10 as string) || "
        f"'-PRG-P' || cast({k} % 7 as string) || '-OBJ-' || cast({k} as string)"
    )


def flag(k: str, every: int) -> str:
    return f"{k} % {every} = 0"


def deleted(k: str) -> str:
    """Soft-delete flag: mostly false, sometimes true or NULL."""
    return f"case when {k} % 23 = 0 then null else {k} % 10 = 0 end"


# table -> list of (driver table, {column: SQL})
RAW: dict[str, list[tuple[str, dict[str, str]]]] = {}


def raw(name: str, base: str, **columns: str) -> None:
    RAW.setdefault(name, []).append((base, columns))


C, S, P, O = "c_custkey", "s_suppkey", "p_partkey", "o_orderkey"
E = "event_id"
L = "(l_orderkey * 8 + l_linenumber)"
ODATE, SHIP = "cast(o_orderdate as date)", "cast(l_shipdate as date)"
LINE_ID = (
    "cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || "
    "cast(l_suppkey as string) || '-' || cast(l_linenumber as string) || '-' || "
    "cast(cast(l_quantity as int) as string)"
)

# --- ecology surveys
raw("biosurvey.endangered_species_monitoring", "lineitem",
    monitoring_id=f"'M' || {LINE_ID}", site_id="'ST' || cast(l_suppkey as string)",
    species_code="'SP' || cast(l_partkey as string)", monitoring_year="cast(year(l_shipdate) as string)",
    population_count="cast(l_quantity as int)", nesting_pairs=gap("cast(l_linenumber as string)", L, 5),
    reproductive_success_rate="l_discount", compliance_reported="l_linestatus = 'O'")
raw("biosurvey.field_observations_raw", "events",
    raw_id=E, observation_type="event_type", site_id="'ST' || cast(user_id as string)",
    species_code=gap(f"'SP' || cast({E} % 97 as string)", E, 6), observation_date="cast(ts as date)",
    observer_name=f"'Observer ' || cast({E} % 13 as string)", count_estimate=f"cast({E} % 40 as string)",
    density_estimate_per_hectare=num(E, 900), nesting_status=pick(E, "None,active,failed"),
    ph_level=num(E, 14), ecoli_count=f"case when {E} % 4 = 0 then 'TNTC' else cast({E} % 500 as string) end",
    turbidity_ntu=num(E, 800), temperature_celsius=num(E, 40), gps_latitude=f"'42.' || lpad(cast({E} % 1000000 as string), 6, '0')",
    gps_longitude=f"'-71.' || lpad(cast({E} % 1000000 as string), 6, '0')", notes=gap("props", E, 3))
raw("biosurvey.flora_fauna_surveys", "orders",
    survey_id=f"'FF' || {txt(O)}", site_id=f"'ST' || cast({O} % 120 as string)",
    species_code=f"'SP' || cast({O} % 500 as string)", survey_date=ODATE,
    observer_name=f"'Observer ' || cast({O} % 13 as string)", count_estimate=f"cast({O} % 60 as string)",
    density_estimate_per_hectare=num(O, 900), latitude=f"'42.' || lpad(cast({O} % 1000000 as string), 6, '0')",
    longitude=f"'-71.' || lpad(cast({O} % 1000000 as string), 6, '0')")
raw("biosurvey.invasive_species_observations", "orders",
    observation_id=f"'IV' || {txt(O)}", site_id=gap(f"'ST' || cast({O} % 130 as string)", O, 9),
    species_code=f"'SP' || cast({O} % 500 as string)", observation_date=ODATE,
    extent_square_meters=num(O, 90000), treatment_applied=gap(pick(O, "herbicide,manual,burn"), O, 4),
    treatment_date=gap(shift("o_orderdate", f"{O} % 30"), O, 4),
    latitude=f"'42.' || lpad(cast({O} % 1000000 as string), 6, '0')",
    longitude=f"'-71.' || lpad(cast({O} % 1000000 as string), 6, '0')")
raw("biosurvey.species_codes", "part",
    species_code=f"'SP' || {txt(P)}", common_name="p_name", scientific_name="'Genus ' || p_name",
    category="p_type", is_endangered=flag(P, 11), is_invasive=flag(P, 7),
    alternate_names=gap("p_name || ';' || p_brand", P, 3))
raw("biosurvey.survey_sites", "supplier",
    site_id=f"'ST' || {txt(S)}", park_id=f"{S} % 80", site_name="'Site ' || s_name",
    site_description=gap("'Near ' || s_name", S, 5))
raw("biosurvey.water_quality_tests", "orders",
    test_id=f"'WQ' || {txt(O)}", site_id=f"'ST' || cast({O} % 110 as string)", sample_date=ODATE,
    dissolved_oxygen_mgl=num(O, 20), ph_level=num(O, 14), ecoli_cfu_100ml=f"cast({O} % 500 as string)",
    turbidity_ntu=num(O, 800), temperature_celsius=num(O, 35), nitrogen_mgl=gap(num(O, 50), O, 8),
    phosphorus_mgl=gap(num(O, 20), O, 8), protocol_era=pick(O, "pre-2005,2005-2018,2018+"))

# --- geographic register
raw("geoparks.infrastructure_features", "part",
    feature_id=f"'INF-' || {txt(P)}",
    geo_park_id=f"'GP-' || lpad(cast({P} % 120 as string), 3, '0')", feature_class="p_type", sub_type="p_brand",
    status=gap(pick(P, "active,closed"), P, 6), installation_year=f"cast(1950 + {P} % 70 as string)",
    geometry_wkt=f"'POINT(' || {txt(P)} || ' 42)'", positional_accuracy_meters=num(P, 90),
    last_updated=day(P, 3000))
raw("geoparks.parks_master", "supplier",
    geo_park_id=f"case when {S} < 1000 then 'GP-' || lpad({txt(S)}, 3, '0') else 'GP-' || {txt(S)} end",
    gis_steward="'Steward ' || cast(s_nationkey as string)", park_name="s_name",
    total_acres=gap("abs(s_acctbal)", S, 7))

# --- grants
raw("granttrack.active_awards", "customer",
    award_id=f"'AW' || {txt(C)}", application_id=f"'AP' || {txt(C)}", award_number=f"'N-' || {txt(C)}",
    sgf_appropriation_code=gap(f"cast({C} % 250 + 100 as string)", C, 19),
    required_match_percentage=num(C, 60), award_amount="abs(c_acctbal)",
    performance_start=day(C, 900), performance_end=gap(day(C, 1800, "2018-01-01"), C, 5))
BUDGETS = {
    f"fy{y}_{kind}": gap(mixed_money(f"(c_acctbal * {3 * i + j + 1})", f"({C} + {i + j})"), f"({C} + {y})", 6)
    for i, y in enumerate(range(2020, 2026)) for j, kind in enumerate(("budgeted", "actual"))
}
for _ in range(2):  # every row twice: exact duplicates
    raw("granttrack.award_budget_by_fiscal_year", "customer",
        award_id=f"'AW' || {txt(C)}", award_number=f"'N-' || {txt(C)}",
        notes=gap("'note ' || c_mktsegment", C, 4), **BUDGETS)
raw("granttrack.compliance_deadlines", "orders",
    deadline_id=f"'DL' || {txt(O)}", award_id=f"'AW' || {txt('o_custkey')}",
    report_type=pick(O, "annual,quarterly,final"), status=pick(O, "submitted,pending,overdue"),
    due_date=mixed_date(shift("o_orderdate", "40"), O), submission_date=gap(mixed_date("o_orderdate", f"({O} + 1)"), O, 5))
raw("granttrack.grant_applications", "customer",
    application_id=f"'AP' || {txt(C)}", grant_program="c_mktsegment",
    status=pick(C, "submitted,awarded,declined"), submission_date=day(C, 900),
    estimated_award_date=gap(day(C, 1200), C, 6), requested_amount="abs(c_acctbal)",
    primary_contact=f"case when {C} % 9 = 0 then null when {C} % 8 = 0 then c_name else c_name || '|c' || {txt(C)} || "
    f"'@example.com|555-01' || lpad(cast({C} % 100 as string), 2, '0') end")
raw("granttrack.match_fund_tracking", "orders",
    match_id=f"'MF' || {txt(O)}", award_id=f"'AW' || {txt('o_custkey')}", match_type=pick(O, "cash,in-kind"),
    description="o_orderpriority", contributors="'Friends, ' || o_orderpriority",
    amount_value="o_totalprice", transaction_date=ODATE)
raw("granttrack.reimbursement_requests", "orders",
    request_id=f"'RQ' || {txt(O)}", award_id=f"'AW' || {txt('o_custkey')}",
    sgf_encumbrance_ref=f"'EN' || {txt(O)}", requested_amount="o_totalprice",
    approved_amount=gap("o_totalprice", O, 4), submission_date=ODATE,
    receipt_date=gap(shift("o_orderdate", f"{O} % 60"), O, 4))

# --- asset management
raw("infratrak.assets", "part",
    asset_tag=f"'AST-' || {txt(P)}", park_id=f"{P} % 90", asset_category="p_type",
    description="p_name", construction_year=f"cast(1940 + {P} % 80 as string)",
    expected_lifespan_years="p_size", replacement_value="p_retailprice",
    latitude=f"'42.' || lpad(cast({P} % 1000000 as string), 6, '0')",
    longitude=f"'-71.' || lpad(cast({P} % 1000000 as string), 6, '0')",
    is_visible_in_survey=gap(flag(P, 2), P, 9))
raw("infratrak.condition_assessments", "lineitem",
    assessment_id=f"'CA' || {LINE_ID}", asset_tag="'AST-' || cast(l_partkey as string)",
    inspector_id="'E' || cast(l_suppkey as string)", fci_score="cast(l_quantity as int)",
    notes=gap("l_returnflag || l_linestatus", L, 4), inspection_date=SHIP)
raw("infratrak.deferred_maintenance", "lineitem",
    backlog_id=f"'BL' || {LINE_ID}", asset_tag="'AST-' || cast(l_partkey as string)",
    estimated_repair_cost="l_extendedprice", is_funded="l_linestatus = 'F'", calculation_date=SHIP)
raw("infratrak.employees", "supplier",
    employee_id=f"'E' || {txt(S)}", assigned_region="s_nationkey % 4 + 1",
    first_name=f"'F' || cast({S} % 40 as string)", last_name="s_name", title=pick(S, "ranger,engineer,clerk"))
raw("infratrak.parks", "supplier",
    park_id=S, region_id=gap("s_nationkey % 4 + 1", S, 6),
    park_name=f"case when {S} % 4 = 0 then s_name || ' Annex' else replace(s_name, '#', '') end",
    classification=gap(pick(S, "forest,beach,historic"), S, 4))
raw("infratrak.work_orders", "orders",
    wo_id=f"'WO' || {txt(O)}", asset_tag=f"'AST-' || cast({O} % 2000 as string)",
    park_id=gap(f"{O} % 110", O, 13), primary_assignee=f"'E' || cast({O} % 90 as string)",
    wo_type=pick(O, "repair,inspection,upgrade"), status=pick(O, "open,closed"),
    labor_hours=num(O, 200), material_cost=num(O, 9000), total_cost="o_totalprice",
    reported_date=gap(ODATE, O, 37), completed_date=gap(shift("o_orderdate", f"{O} % 40"), O, 3))

# --- legacy reservations
raw("legacyres.legacy_customers", "customer",
    legacy_cust_id=f"'LC' || {txt(C)}", first_name=f"'F' || cast({C} % 50 as string)", last_name="c_name",
    email=f"'c' || {txt(C)} || '@example.com'", phone_number=f"'555-0' || cast({C} % 900 + 100 as string)",
    partial_card_mask=gap(f"'****' || cast({C} % 9000 + 1000 as string)", C, 6))
raw("legacyres.legacy_fee_schedule_wide", "part",
    facility_type=f"p_type || '-' || {txt(P)}", base_rate_peak=num(P, 900), base_rate_offpeak=num(P, 600),
    base_rate_shoulder=num(P, 700), export_date=day(P, 2000),
    resident_discount_pct=f"cast({P} % 60 as string) || '%'",
    senior_discount_pct=gap(f"cast({P} % 40 as string) || '.5%'", P, 8))
raw("legacyres.legacy_park_crosswalk", "supplier",
    legacy_park_id=f"'LP' || {txt(S)}", legacy_park_name="s_name", current_park_id=gap(S, S, 5))
raw("legacyres.legacy_reservations", "orders",
    res_id=f"'LR' || {txt(O)}", legacy_cust_id=f"'LC' || {txt('o_custkey')}",
    legacy_park_id=f"'LP' || cast({O} % 120 as string)", total_paid="o_totalprice",
    data_format_source=pick(O, "SQLDump,FlatFile_2005_2010,Export"),
    arrival_date=era_date("o_orderdate", O), departure_date=era_date(shift("o_orderdate", f"{O} % 9"), O),
    guest_info=f"case when {O} % 6 = 0 then null when {O} % 5 = 0 then 'Adults:' || cast({O} % 7 as string) "
    f"else 'Adults:' || cast({O} % 5 as string) || '|Kids:' || cast({O} % 3 as string) || "
    f"'|Pets:' || cast({O} % 2 as string) || '|Vehicles:1' end")
raw("legacyres.legacy_revenue_summaries", "orders",
    summary_id=f"'LS' || {txt(O)}", legacy_park_id=f"'LP' || cast({O} % 120 as string)", report_month=ODATE,
    revenue_category="o_orderpriority", total_revenue="o_totalprice")

# --- people
raw("peoplefirst.benefits", "customer",
    employee_id=f"'E' || {txt(C)}", health_plan_type="c_mktsegment", retirement_tier=pick(C, "T1,T2,T3"),
    annual_leave_hours=num(C, 300), sick_leave_hours=num(C, 200), comp_time_hours=num(C, 100),
    _is_deleted=deleted(C))
raw("peoplefirst.employees", "customer",
    employee_id=f"'E' || {txt(C)}", first_name=f"'F' || cast({C} % 50 as string)", last_name="c_name",
    email=gap(f"'e' || {txt(C)} || '@example.com'", C, 12), phone=f"'555-0' || cast({C} % 900 + 100 as string)",
    hire_date=day(C, 3000), separation_date=f"case when {C} % 4 = 0 then {day(C, 3000, '2023-06-01')} end",
    position_id=gap(f"'PS' || cast({C} % 1900 as string)", C, 14), _is_deleted=deleted(C))
raw("peoplefirst.leave_balances", "customer",
    leave_balance_id=f"'LB' || {txt(C)}", employee_id=f"'E' || {txt(C)}", leave_type=pick(C, "annual,sick,comp"),
    balance_amount=num(C, 400), as_of_date=day(C, 300), _is_deleted=deleted(C))
raw("peoplefirst.org_units", "supplier",
    org_unit_id=f"'OU' || {txt(S)}", org_unit_name="s_name", region_id="s_nationkey % 4 + 1", _is_deleted=deleted(S))
raw("peoplefirst.payroll", "orders",
    payroll_id=f"'PY' || {txt(O)}", employee_id=f"'E' || {txt('o_custkey')}", pay_period_start=ODATE,
    pay_period_end=shift("o_orderdate", "14"), gross_pay="o_totalprice", deductions=num(O, 900),
    taxes_withheld=num(O, 1900), net_pay="o_totalprice", _is_deleted=deleted(O))
raw("peoplefirst.positions", "part",
    position_id=f"'PS' || {txt(P)}", job_classification="p_type", pay_grade=f"'G' || cast({P} % 12 as string)",
    org_unit_id=f"'OU' || cast({P} % 120 as string)", funding_source=pick(P, "general,federal,trust"),
    is_active=flag(P, 3), _is_deleted=deleted(P))
raw("peoplefirst.seasonal_workforce", "customer",
    seasonal_emp_id=f"'SE' || {txt(C)}", first_name=f"'F' || cast({C} % 50 as string)", last_name="c_name",
    org_unit_id=f"'OU' || cast({C} % 100 as string)", season_year=f"cast(2015 + {C} % 9 as string)",
    actual_start_date=day(C, 3000), system_onboard_date=day(C, 3000, "2015-01-20"),
    separation_date=gap(day(C, 3000, "2015-06-01"), C, 3), hourly_rate=num(C, 60), _is_deleted=deleted(C))

# --- enforcement
raw("rangershield.citations", "orders",
    citation_number=f"'CT' || {txt(O)}", incident_number=gap(f"'IN' || {txt(O)}", O, 4),
    issuing_officer=f"'B' || cast({O} % 110 as string)", violation_code="o_orderpriority",
    issue_timestamp="o_orderdate", fine_amount=num(O, 900), court_disposition=gap(pick(O, "paid,dismissed"), O, 5))
raw("rangershield.dispatch_logs", "conversations",
    log_id="cast(conv_id as string) || '-' || cast(turn as string)", incident_number="'IN' || cast(conv_id as string)",
    badge_number="'B' || cast(turn as string)",
    log_timestamp="cast(date '2020-01-01' + cast(conv_id % 900 as int) as string) || ' 08:30:00'",
    event_type="role", radio_traffic_transcript="text")
raw("rangershield.incidents", "orders",
    incident_number=f"'IN' || {txt(O)}", reporting_officer=f"'B' || cast({O} % 110 as string)",
    incident_type="o_orderpriority", report_timestamp="o_orderdate", location_narrative=gap("'Gate ' || o_orderstatus", O, 6),
    narrative_summary="'Summary of ' || o_orderpriority", review_status="o_orderstatus")
raw("rangershield.officer_activity", "events",
    activity_id=f"'OA' || {txt(E)}", badge_number="'B' || cast(user_id as string)", shift_date="cast(ts as date)",
    shift_start_time="ts", shift_end_time=gap("ts", E, 8), patrol_miles=f"cast({E} % 300 as string) || '.5'",
    visitor_contacts=f"cast({E} % 30 as string)", resource_checks=gap(f"cast({E} % 9 as string)", E, 7))
raw("rangershield.officers", "supplier",
    badge_number=f"'B' || {txt(S)}", first_name=f"'F' || cast({S} % 40 as string)", last_name="s_name",
    rank=pick(S, "ranger,sergeant,captain"), certification_status=gap(pick(S, "valid,expired"), S, 6),
    assigned_region="s_nationkey % 4 + 1")
raw("rangershield.use_of_force", "orders",
    uof_id=f"'UF' || {txt(O)}", incident_number=f"'IN' || {txt(O)}",
    involved_officer=f"'B' || cast({O} % 110 as string)", force_level=pick(O, "verbal,physical,none"),
    subject_injury=flag(O, 5), officer_injury=gap(flag(O, 7), O, 6), internal_review_status="o_orderstatus")

# --- state finance
raw("stategov.accounts_payable", "lineitem",
    invoice_id=f"'IV' || {LINE_ID}", vendor_id=gap("'V' || cast(l_suppkey as string)", L, 15),
    encumbrance_id="'EN' || cast(l_orderkey as string)", account_id=account("l_partkey"),
    invoice_date=SHIP, payment_date=gap(shift("l_shipdate", "l_linenumber * 5"), L, 6),
    amount="case when l_linenumber % 2 = 0 then l_extendedprice else l_tax end",
    status="l_linestatus")
raw("stategov.budget_activity_log", "orders",
    log_sequence_id=f"'BA' || {txt(O)}", fiscal_year="cast(year(o_orderdate) as int)",
    accounting_period="cast(month(o_orderdate) as int)",
    account_id=f"case when {O} % 21 = 0 then 'unassigned' else {account(O)} end",
    activity_type=pick(O, "allot,spend,transfer"), amount="o_totalprice", vendor_id=gap(f"'V' || cast({O} % 100 as string)", O, 3),
    encumbrance_ref=gap(f"'EN' || {txt(O)}", O, 2), revenue_source_code=gap(pick(O, "R1,R2"), O, 5),
    appropriation_auth=gap("'AA'", O, 4), allotment_period=gap("'Q' || cast(quarter(o_orderdate) as string)", O, 7),
    batch_id=f"'BT' || cast({O} % 300 as string)", entry_operator=f"'OP' || cast({O} % 9 as string)",
    effective_date=f"case when {O} % 26 = 0 then 'unknown' else replace(cast({ODATE} as string), '-', '') end")
raw("stategov.chart_of_accounts", "part",
    account_id=account(P), fund_code=f"cast({P} % 300 + 100 as string)", fund_description="'Fund ' || p_brand",
    division_code=f"'D' || cast({P} % 10 as string)", division_description="'Division ' || p_type",
    program_code=f"'P' || cast({P} % 7 as string)", program_description="'Program ' || p_name",
    object_code=txt(P), object_description=gap("'Object ' || p_name", P, 6))
raw("stategov.encumbrances", "orders",
    encumbrance_id=f"'EN' || {txt(O)}", vendor_id=f"'V' || cast({O} % 100 as string)", account_id=account(O),
    established_date=ODATE, original_amount="o_totalprice", remaining_balance=num(O, 9000), status="o_orderstatus")
raw("stategov.general_ledger", "lineitem",
    gl_entry_id=f"'GL' || {LINE_ID}", account_id=account("l_partkey"), fiscal_year="cast(year(l_shipdate) as int)",
    accounting_month="cast(month(l_shipdate) as int)",
    entry_type="case when l_returnflag = 'R' then 'Revenue' else 'Expenditure' end", amount="l_extendedprice",
    batch_reference="'BR' || cast(l_orderkey as string)",
    batch_detail_text=gap("repeat('INV-' || cast(l_partkey as string) || '|9.99|memo|', cast(l_linenumber as int))", L, 6))
raw("stategov.vendors", "supplier",
    vendor_id=f"'V' || {txt(S)}", vendor_name="s_name", vendor_type=pick(S, "supplier,contractor"),
    is_active=flag(S, 2), tin_masked=f"'**-***' || cast({S} % 9000 + 1000 as string)")

# --- sensors
raw("trafficcount.derived_visitor_metrics", "events",
    metric_id=f"'VM' || {txt(E)}", sensor_id="'S' || cast(user_id as string)", target_date="cast(ts as date)",
    estimated_total_visitors=gap("cast(floor(value * 10) as int)", E, 41), vehicle_multiplier_used="'2.70'",
    calculation_timestamp="ts", _is_deleted=deleted(E))
raw("trafficcount.pedestrian_cyclist_counts", "events",
    count_id=f"'PC' || {txt(E)}", sensor_id="'S' || cast(user_id as string)", timestamp_hour="ts",
    raw_pedestrian_count=f"cast({E} % 90 as string)", raw_cyclist_count=gap(f"cast({E} % 30 as string)", E, 9),
    is_anomaly=flag(E, 50), _is_deleted=deleted(E))
raw("trafficcount.sensor_locations", "supplier",
    sensor_id=f"'S' || {txt(S)}", park_id=f"cast({S} % 85 as string)", installation_date=day(S, 2500),
    sensor_type=pick(S, "vehicle,pedestrian"), location_description=gap("'At ' || s_name", S, 5),
    status=pick(S, "active,offline"), _is_deleted=deleted(S))
raw("trafficcount.vehicle_counts", "events",
    count_id=f"'VC' || {txt(E)}", sensor_id="'S' || cast(user_id as string)", timestamp_hour="ts",
    raw_vehicle_count="cast(floor(value) as int)", is_anomaly=flag(E, 60), _is_deleted=deleted(E))

# --- bookings
raw("vistareserve.asset_crosswalk", "part",
    geoparks_feature_id=f"'INF-' || {txt(P)}", vista_asset_id=f"'A' || {txt(P)}",
    infratrak_asset_tag=gap(f"'AST-' || {txt(P)}", P, 6), last_verified_date=gap(day(P, 2000), P, 9))
for copy in (0, 1):  # the second copy is a later version of the same customer
    raw("vistareserve.customer_profiles", "customer",
        customer_id=txt(C), merged_into_customer_id=f"case when {C} % 9 = 0 then cast({C} + 1 as string) end",
        address_state=gap(f"split_part('{STATES}', ',', cast(c_nationkey + 1 as int))", C, 16),
        email=f"case when {C} % 13 = 0 then null when {C} % 11 = 0 then 'c{copy} at example' "
        f"else 'c{copy}' || {txt(C)} || '@example.com' end",
        first_name=gap(f"'F' || cast({C} % 50 as string)", C, 18), last_name="c_name",
        phone=f"'555-0' || cast({C} % 900 + 100 as string)", has_annual_pass=flag(C, 3), is_senior=flag(C, 5),
        is_veteran=flag(C, 7),
        created_at=gap(f"date '2018-01-01' + cast({C} % 2500 + {copy} * ({C} % 3 + 1) as int)", C, 27),
        preferences_json=f"case when {C} % 8 = 0 then null else '{{\"equipment_type\":\"' || {pick(C, 'tent,rv,trailer')} || "
        f"'\",\"accessibility_needs\":' || case when {C} % 4 = 0 then 'null' else '\"ramp\"' end || '}}' end")
raw("vistareserve.inventory_assets", "part",
    asset_id=f"'A' || {txt(P)}", park_id=gap(f"cast({P} % 105 as int)", P, 17),
    asset_type=pick(P, "campsite,tent,rv,rv_site,tent_site,cabin,yurt,lodge,shelter,day-use,picnic_area,boat"),
    pet_policy=gap(pick(P, "allowed,prohibited"), P, 3), utility_hookup=gap(pick(P, "full,partial"), P, 5),
    max_occupancy=gap("cast(p_size % 12 as int)", P, 11), ada_accessible=gap(flag(P, 2), P, 10))
raw("vistareserve.parks", "supplier",
    park_id=S, region_id="s_nationkey % 5 + 1", classification=gap(pick(S, "forest,beach,historic,urban"), S, 5),
    park_name=f"case when {S} % 5 = 0 then s_name || ' Annex' when {S} % 2 = 0 then s_name || '.' else ' ' || s_name || '!' end",
    has_unstaffed_kiosk=flag(S, 3))
raw("vistareserve.pos_transactions", "lineitem",
    customer_id=gap("cast(l_orderkey % 1700 as string)", L, 14), park_id=gap("cast(l_suppkey as int)", L, 33),
    transaction_id=f"'T' || {LINE_ID}", revenue_category=pick("l_linenumber", "retail,rental,entry"),
    amount="l_extendedprice", is_kiosk_entry="l_linestatus = 'O'", transaction_date="l_shipdate")
raw("vistareserve.reservations", "orders",
    asset_id=gap(f"'A' || cast({O} % 2100 as string)", O, 31), customer_id=gap(txt("o_custkey"), O, 29),
    reservation_id=f"'R' || {txt(O)}",
    status="case o_orderstatus when 'F' then 'Completed' when 'O' then 'Checked In' else 'confirmed' end",
    total_amount="o_totalprice", arrival_date=gap(ODATE, O, 43), booking_date="o_orderdate",
    departure_date=gap(shift("o_orderdate", f"{O} % 6"), O, 47),
    booking_metadata=f"substr('{{\"booking_source\":\"' || {pick(O, 'web,phone,kiosk')} || '\",\"promo_code\":' || "
    f"case when {O} % 3 = 0 then 'null' else '\"P' || cast({O} % 10 as string) || '\"' end || ',\"number_of_guests\":' || "
    f"cast({O} % 8 as string) || '}}', 1, case when {O} % 20 = 0 then 25 else 500 end)")
raw("vistareserve.revenue_batch", "orders",
    batch_id=f"'RB' || {txt(O)}", park_id="cast(o_custkey % 100 as int)", revenue_category="o_orderpriority",
    gross_revenue="o_totalprice", transaction_count=f"cast({O} % 90 as int)", batch_date=ODATE)


def raw_sql(name: str) -> str:
    """The source table as DuckDB SQL."""
    parts = [
        "select " + ", ".join(f'{expr} as "{col}"' for col, expr in columns.items()) + f" from {base}"
        for base, columns in RAW[name]
    ]
    return " union all ".join(parts)


# Schema of a table's file, asked once per application and path.
_KNOWN: dict[tuple[str, str], StructType] = {}


class Tables:
    """Driver tables and derived source tables of one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        if table not in self._read:
            path = f"{self.sf_dir}/{table}.parquet"
            key = (self.spark.sparkContext.applicationId, path)
            if key not in _KNOWN:
                _KNOWN[key] = self.spark.read.parquet(path).schema
            self._read[table] = self.spark.read.schema(_KNOWN[key]).parquet(path)
        return self._read[table]

    def raw(self, name: str) -> DataFrame:
        parts = [
            getattr(self, base).selectExpr(*[f"{expr} as `{col}`" for col, expr in columns.items()])
            for base, columns in RAW[name]
        ]
        return reduce(DataFrame.unionAll, parts)

    def load(self, system: str, table: str) -> DataFrame:
        """The loader signature the staging models take."""
        return self.raw(f"{system}.{table}")
