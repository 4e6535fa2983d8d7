"""Model quirks and the wiring of the warehouse on hand-made sources."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from cairn.plans import integration as i
from cairn.plans import marts as m
from cairn.plans.codes import SystemCodes
from cairn.plans.contracts import CONTRACTS
from cairn.plans.staging import MODEL_NAMES, build_staging
from cairn.plans.staging.granttrack import award_budget_by_fiscal_year
from cairn.plans.staging.vistareserve import base_customer_profiles
from cairn.plans.warehouse import INTEGRATION_MODELS, MART_MODELS, Warehouse
from cairn_queries.fixtures import RAW, Tables
from cairn_queries.models import warehouse

D = dt.date


@pytest.fixture(scope="module")
def small(spark):
    return Tables(spark, "/root/testdata/sf0.001")


def test_inventory_is_complete():
    assert len(RAW) == 56 and len(MODEL_NAMES) == 58
    assert len(INTEGRATION_MODELS) == 13 and len(MART_MODELS) == 15


def test_budget_years_without_amounts_are_left_out(spark, rows):
    wide = {f"fy{y}_{k}": None for y in range(2020, 2026) for k in ("budgeted", "actual")}
    wide |= {"award_id": "A", "award_number": "N", "notes": None, "fy2020_budgeted": "$1,000.50", "fy2021_actual": "TBD"}
    df = spark.createDataFrame([wide, wide], ", ".join(f"{c} string" for c in wide))
    found = rows(award_budget_by_fiscal_year(df), "fiscal_year", "budgeted_amount", "actual_amount")
    assert [(y, b and float(b), a) for y, b, a in found] == [(2020, 1000.5, None), (2021, None, None)]


def test_newest_customer_version_wins(spark, rows):
    columns = ("customer_id string, first_name string, last_name string, email string, phone string, address_state string, is_veteran boolean, "
               "is_senior boolean, has_annual_pass boolean, created_at date, merged_into_customer_id string, preferences_json string")
    def row(email, day):
        return ("1", "A", "B", email, None, None, None, None, None, day, None, None)
    df = spark.createDataFrame([row("none", None), row("old", D(2020, 1, 1)), row("z", D(2021, 1, 1)), row("b", D(2021, 1, 1))], columns)
    assert rows(base_customer_profiles(df), "customer_id", "email") == [("1", "b")]


def park_frames(spark):
    geo = spark.sql("select 'GP-001' geo_park_id, 'Oak' park_name, 's' gis_steward, cast(10 as decimal(10,2)) total_acres")
    bookings = spark.sql("select '1' park_id, 'Oak.' park_name, 'forest' classification, 2 region_id")
    assets = spark.sql("select 1 park_id, ' Oak!' park_name, 'beach' classification, 4 region_id")
    return geo, bookings, assets


def test_parks_merge_by_clean_name_and_mix_attributes(spark):
    found = i.int_parks(*park_frames(spark)).collect()
    assert len(found) == 1
    p = found[0]
    assert (p.accountnumber, p.name, p.classification, p.region_id, p.infratrak_park_id) == ("GP-001", "Oak", "forest", 4, 1)


def test_codes_carry_a_prefix(spark):
    p = i.int_parks(*park_frames(spark), codes=SystemCodes("ABC")).collect()[0]
    assert p.source_system == "ABC-GEO-01"


def test_dim_date_default_range(spark):
    dates = m.dim_date(spark)
    last = dates.orderBy(F.desc("date_sk")).first()
    assert dates.count() == 7669 and last.date_sk == D(2030, 12, 30) and last.fiscal_year == 2031


def test_agency_report_hides_spending_without_park_unless_asked(spark, rows):
    spent = spark.createDataFrame([(None, D(2024, 1, 1), 5)], "parks_sk string, expenditure_month_date date, amount int")
    seen = spark.createDataFrame([("p", D(2024, 1, 9), 3)], "parks_sk string, date_sk date, total_estimated_visitors int")
    events = spark.createDataFrame([("p", D(2024, 1, 2), m.WORK_ORDER, "e"), ("p", D(2024, 1, 2), m.SHIFT, "f")],
                                   "parks_sk string, event_date date, event_category string, event_sk string")
    columns = ("parks_sk", "total_expenditures", "total_visitors", "total_incidents")
    assert rows(m.rpt_agency_performance(spent, seen, events), *columns) == [("p", 0, 3, 1), (None, 0, 0, 0)]
    assert rows(m.rpt_agency_performance(spent, seen, events, null_safe=True), *columns) == [("p", 0, 3, 1), (None, 5, 0, 0)]


def test_visit_statuses_are_case_sensitive_and_a_parameter(small):
    w = warehouse(small)
    lower = m.fct_visitation(w.visits_linked, w.int_visitor_counts, statuses=("completed",))
    assert lower.agg(F.sum("registered_visitors")).collect()[0][0] == 0
    assert w.fct_visitation.agg(F.sum("registered_visitors")).collect()[0][0] > 0


def test_facts_keep_every_source_row(small):
    w = warehouse(small)
    assert w.int_visits.count() == w.fct_reservations.count() == small.orders.count()
    assert w.int_transactions.count() == w.fct_pos_transactions.count() == small.lineitem.count()
    assert w.int_financial_transactions.count() == small.lineitem.count()
    assert w.int_work_orders.count() == small.orders.count()


def test_contact_keys_equal_those_of_the_entity(small, rows):
    w = warehouse(small)
    assert rows(w.contact_keys, "contacts_sk", "contact_id") == rows(w.int_contacts, "contacts_sk", "contact_id")


def test_occupancy_counts_full_revenue_each_night(spark):
    stays = spark.sql("""select 'p' parks_sk, 'r' reservations_sk, 2 number_of_guests, cast(100 as decimal(10,2)) reservation_amount,
        date '2024-06-30' check_in_date, date '2024-07-02' check_out_date""")
    parks = spark.sql("select 'p' parks_sk, 'Oak' park_name, 'West' region")
    found = m.fct_park_occupancy_daily_snapshot(stays, m.dim_date(spark), parks).orderBy("snapshot_date").collect()
    assert [(r.snapshot_date, r.fiscal_year, r.total_guests_on_site, float(r.total_reservation_revenue_in_stay)) for r in found] == [
        (D(2024, 6, 30), 2024, 2, 100.0), (D(2024, 7, 1), 2025, 2, 100.0)]


def test_stored_models_equal_lazy_ones(spark, small, tmp_path, rows):
    regions = spark.createDataFrame([("R1", "West")], "region_code string, region_name string")
    lazy = Warehouse(spark, small.load, regions)
    stored = Warehouse(spark, small.load, regions, store=("int_parks", "visits_linked"), root=str(tmp_path))
    assert rows(stored.fct_reservations) == rows(lazy.fct_reservations)
    assert (tmp_path / "int_parks").exists() and (tmp_path / "visits_linked").exists()


def test_marts_meet_their_contracts(small):
    w = warehouse(small)
    assert set(MART_MODELS) - set(CONTRACTS) == {"fct_expenditures"}
    for name, declared in CONTRACTS.items():
        assert {f.name: f.dataType.simpleString() for f in getattr(w, name).schema.fields} == declared


def test_crosswalk_age_uses_as_of(spark, small):
    df = build_staging("base_vistareserve__asset_crosswalks", small.load, F.lit("2015-01-03").cast("date"))
    first = df.where(F.col("last_verified_date") == D(2015, 1, 2)).first()
    assert first is None or first.days_since_last_update == 1


# --- the ledger and its lookups

LEDGER = "gl_entry_id string, account_id string, account_fund_code string, fiscal_year int, entry_type string, amount int, accounting_month int"


def ledger_frames(spark):
    entries = [(f"g{i}", a, f, y, "Revenue" if i % 5 == 0 else "Expenditure", 10 + i % 3, 1 + i % 12) for i, (a, f, y) in enumerate(
        (a, f, y) for a in ("a1", "a2", "a3", None) for f in ("100", "200", "300", None) for y in (2020, 2021, None))]
    ledger = spark.createDataFrame(entries, LEDGER).withColumns(
        {c: F.lit(c) for c in ("account_division_code", "account_program_code", "account_object_code", "batch_reference", "batch_detail_text")}
        | {"batch_entry_count": F.lit(1)})
    accounts = spark.createDataFrame([("a1", "one"), ("a1", "uno"), ("a2", "two"), (None, "none")], "account_id string, fund_description string").withColumns(
        {f"{c}_description": F.concat(F.lit(c), "fund_description") for c in ("division", "program", "object")})
    awards = spark.createDataFrame([("w1", "100", "2024-01-01"), ("w2", "100", None), ("w4", "200", None), ("w3", "200", None), ("w5", None, "2024-01-01")],
                                   "award_id string, sgf_appropriation_code string, ends string").select(
        "award_id", "sgf_appropriation_code", F.col("award_id").alias("award_number"), F.lit(5).alias("award_amount"),
        F.lit(7).alias("required_match_percentage"), F.lit(None).cast("date").alias("performance_start"), F.to_date("ends").alias("performance_end"))
    budget = spark.createDataFrame([("w1", 2020, 1, 2), ("w1", 2020, 3, 4), ("w1", 2021, 5, None), ("w1", None, 6, 6), ("w3", 2022, 7, 7), ("w4", 2020, 8, 8), (None, 2020, 9, 9)],
                                   "award_id string, fiscal_year int, budgeted_amount int, actual_amount int")
    return ledger, accounts, awards, budget


def shuffles_with(spark, column, build):
    """How many exchanges carry a column where nothing is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = build()._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return len(re.findall(r"\) Exchange\nInput \[\d+\]: \[[^\]]*\b" + column + "#", plan))


def test_ledger_lookups_match_plain_joins(spark, rows):
    ledger, accounts, awards, budget = ledger_frames(spark)
    plain = spark.sql("""
        with w as (select * from (select *, row_number() over (partition by sgf_appropriation_code order by performance_end desc nulls last, award_id) as n from {awards}) where n = 1)
        select g.gl_entry_id, c.object_description, w.award_id, w.performance_end, b.budgeted_amount, b.actual_amount from {ledger} g
        left join {accounts} c on c.account_id = g.account_id left join w on w.sgf_appropriation_code = g.account_fund_code
        left join {budget} b on b.award_id = w.award_id and b.fiscal_year = g.fiscal_year""", ledger=ledger, accounts=accounts, awards=awards, budget=budget)
    got = i.int_financial_transactions(ledger, accounts, awards, budget)
    assert rows(got, "gl_entry_id", "object_description", "award_id", "performance_end", "award_fiscal_year_budget", "award_fiscal_year_actual") == rows(plain)
    twice = ledger.unionAll(ledger)
    assert i.int_financial_transactions(twice, accounts, awards, budget).count() == 2 * plain.count()


def test_ledger_entries_are_shuffled_once(spark):
    assert shuffles_with(spark, "gl_entry_id", lambda: i.int_financial_transactions(*ledger_frames(spark))) == 1


def test_expenditures_are_shuffled_for_labels_and_vendor_only(spark):
    paid = spark.createDataFrame([("a1", 10, "v1")], "account_id string, amount int, vendor_id string")
    assert shuffles_with(spark, "gl_entry_id", lambda: m.fct_expenditures(i.int_financial_transactions(*ledger_frames(spark)), paid)) == 2


def finance_load(spark):
    """Sources of the ledger's models, with rows that repeat and keys that are null."""
    codes = ("100-DIV-D1-PRG-P1-OBJ-1", "200-DIV-D2-PRG-P2-OBJ-2", "odd", None)
    entries = [(f"g{n % 20}", codes[n % 4], 2020 + n % 2, 1 + n % 12, "Revenue" if n % 5 == 0 else "Expenditure", None if n % 7 == 0 else n % 3) for n in range(40)]
    budget = {f"fy{y}_{kind}": f"{y}.50" for y in range(2020, 2026) for kind in ("budgeted", "actual")}
    tables = {
        "general_ledger": spark.createDataFrame(entries, "gl_entry_id string, account_id string, fiscal_year int, accounting_month int, entry_type string, amount int"
                                                ).withColumns({"batch_reference": F.lit("b"), "batch_detail_text": F.lit(None).cast("string")}),
        "chart_of_accounts": spark.createDataFrame([(codes[0], "one"), (codes[0], "uno"), ("odd", "two"), (None, "none")], "account_id string, fund_description string").withColumns(
            {c: F.col("fund_description") for c in ("fund_code", "division_code", "division_description", "program_code", "program_description", "object_code", "object_description")}),
        "accounts_payable": spark.createDataFrame(
            [(codes[0], 1, "v1"), (codes[0], 1, "v2"), (codes[0], 1, None), (codes[0], 2, None), ("odd", 2, "v3"), (None, 1, "v4"), ("odd", None, "v5"), (codes[1], 9, "v6")],
            "account_id string, amount int, vendor_id string").withColumns({c: F.lit(None).cast("string") for c in ("invoice_id", "encumbrance_id", "invoice_date", "payment_date", "status")}),
        "active_awards": spark.createDataFrame([("w1", "100", None), ("w2", "100", "2024-01-01"), ("w3", None, None)], "award_id string, sgf_appropriation_code string, performance_end string").withColumns(
            {c: F.lit(None).cast("string") for c in ("application_id", "award_number", "required_match_percentage", "performance_start")} | {"award_amount": F.lit(5)}),
        "award_budget_by_fiscal_year": spark.createDataFrame([{"award_id": "w2", "award_number": "n", "notes": "x"} | budget] * 2),
    }
    return lambda system, table: tables[table]


def test_vendors_matched_before_or_after_the_labels_are_the_same(spark, rows):
    w = Warehouse(spark, finance_load(spark), spark.range(0))
    financials = i.int_financial_transactions(*[w.staged(f"stg_{name}") for name in (
        "stategov__general_ledger", "stategov__chart_of_accounts", "granttrack__active_awards", "granttrack__award_budget_by_fiscal_year")])
    assert rows(w.int_financial_transactions) == rows(financials) and w.int_financial_transactions.schema == financials.schema
    after = m.fct_expenditures(financials, w.staged("stg_stategov__accounts_payable"))
    got = rows(w.fct_expenditures)
    assert got == rows(after) and w.fct_expenditures.schema == after.schema
    assert len({r[2] for r in got}) == 3  # of v2 and v3, and none


def test_entries_are_shuffled_without_labels_and_parts_of_the_account(spark):
    w = Warehouse(spark, finance_load(spark), spark.range(0))
    assert shuffles_with(spark, "gl_entry_id", lambda: w.fct_expenditures) == 2
    assert shuffles_with(spark, r"gl_entry_id#[^\]]*\bobject_description", lambda: w.fct_expenditures) == 0
    for model in ("fct_expenditures", "int_financial_transactions"):
        assert shuffles_with(spark, r"gl_entry_id#[^\]]*\baccount_division_code", lambda: getattr(w, model)) == 0


def test_stored_financials_are_read_for_the_expenditures(spark, tmp_path, rows):
    load = finance_load(spark)
    stored = Warehouse(spark, load, spark.range(0), store=("int_financial_transactions",), root=str(tmp_path))
    assert rows(stored.fct_expenditures) == rows(Warehouse(spark, load, spark.range(0)).fct_expenditures)
    assert (tmp_path / "int_financial_transactions").exists()
