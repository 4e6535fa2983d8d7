"""All models over one set of sources.

Plain wiring: every model is a property that calls its function with the frames it
needs. Nothing runs until a model is written or counted. ``store`` lists models to
write once and read back, so that marts sharing them do not recompute them. ``dates``
is a frame of ``date_day`` for the calendar, ``as_of`` the day that ages are measured at.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from cairn.functions import split_account
from cairn.operators.quality import enforce_contract
from cairn.plans import integration as i
from cairn.plans import marts as m
from cairn.plans.codes import SystemCodes
from cairn.plans.contracts import CONTRACTS
from cairn.plans.staging import Loader, build_staging
from cairn.sources.sinks import materialize


class Warehouse:
    def __init__(self, spark: SparkSession, load: Loader, regions: DataFrame,
                 codes: SystemCodes = SystemCodes(), as_of: Column | None = None,
                 dates: DataFrame | None = None, store: Iterable[str] = (),
                 root: str | None = None) -> None:
        self.spark, self.load, self.regions, self.codes = spark, load, regions, codes
        self.as_of, self.dates, self.root = as_of, dates, root
        self._store = frozenset(store)

    def staged(self, model: str) -> DataFrame:
        return build_staging(model, self.load, self.as_of)

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        return materialize(df, name, "table", self.root) if name in self._store else df

    def _mart(self, name: str, df: DataFrame) -> DataFrame:
        """A mart under its contract; a model without one is passed on as it is."""
        return self._keep(name, enforce_contract(df, CONTRACTS[name]) if name in CONTRACTS else df)

    # integration

    @cached_property
    def int_parks(self) -> DataFrame:
        return self._keep("int_parks", i.int_parks(
            self.staged("stg_geoparks__parks_master"), self.staged("stg_vistareserve__parks"),
            self.staged("stg_infratrak__parks"), self.codes))

    @cached_property
    def int_contacts(self) -> DataFrame:
        return self._keep("int_contacts", i.int_contacts(
            self.staged("stg_vistareserve__customer_profiles")))

    @cached_property
    def contact_keys(self) -> DataFrame:
        return i.contact_keys(self.load("vistareserve", "customer_profiles"))

    @cached_property
    def int_customer_assets(self) -> DataFrame:
        return self._keep("int_customer_assets", i.int_customer_assets(
            self.staged("stg_vistareserve__inventory_assets"), self.int_parks))

    @cached_property
    def transactions_linked(self) -> DataFrame:
        return self._keep("transactions_linked", i.transactions_linked(
            self.staged("stg_vistareserve__pos_transactions"), self.contact_keys, self.int_parks))

    @cached_property
    def int_transactions(self) -> DataFrame:
        return i.int_transactions(self.transactions_linked)

    @cached_property
    def visits_linked(self) -> DataFrame:
        return self._keep("visits_linked", i.visits_linked(
            self.staged("stg_vistareserve__reservations"), self.contact_keys,
            self.int_customer_assets))

    @cached_property
    def int_visits(self) -> DataFrame:
        return i.int_visits(self.visits_linked)

    @property
    def _entries(self) -> DataFrame:
        """The staged ledger without the parts of its account, which are split anew behind the shuffles."""
        return self.staged("stg_stategov__general_ledger").drop(*split_account("account_id"))

    def _financials(self, entries: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        parts = split_account("account_id")
        fund = "account_fund_code"
        return i.int_financial_transactions(
            entries.withColumn(fund, parts.pop(fund)), self.staged("stg_stategov__chart_of_accounts"),
            self.staged("stg_granttrack__active_awards"),
            self.staged("stg_granttrack__award_budget_by_fiscal_year"), self.codes, keep, parts)

    @cached_property
    def int_financial_transactions(self) -> DataFrame:
        return self._keep("int_financial_transactions", self._financials(self._entries))

    @cached_property
    def int_physical_assets(self) -> DataFrame:
        return self._keep("int_physical_assets", i.int_physical_assets(
            self.staged("stg_infratrak__assets"),
            self.staged("stg_geoparks__infrastructure_features"), self.int_parks, self.codes))

    @cached_property
    def int_ecological_surveys(self) -> DataFrame:
        return self._keep("int_ecological_surveys", i.int_ecological_surveys(
            self.staged("stg_biosurvey__flora_fauna_surveys"),
            self.staged("stg_biosurvey__water_quality_tests"),
            self.staged("stg_biosurvey__invasive_species_observations"),
            self.staged("stg_biosurvey__survey_sites"), self.int_parks))

    @cached_property
    def int_visitor_counts(self) -> DataFrame:
        return self._keep("int_visitor_counts", i.int_visitor_counts(
            self.staged("stg_trafficcount__derived_visitor_metrics"),
            self.staged("stg_trafficcount__sensor_locations"), self.int_parks))

    @cached_property
    def int_employees(self) -> DataFrame:
        return self._keep("int_employees", i.int_employees(
            self.staged("stg_peoplefirst__employees"), self.staged("stg_peoplefirst__positions"),
            self.staged("stg_peoplefirst__org_units"), self.codes))

    @cached_property
    def int_officer_shifts(self) -> DataFrame:
        return self._keep("int_officer_shifts", i.int_officer_shifts(
            self.staged("stg_rangershield__officer_activity"),
            self.staged("stg_rangershield__officers"), self.codes))

    @cached_property
    def int_work_orders(self) -> DataFrame:
        return self._keep("int_work_orders", i.int_work_orders(
            self.staged("stg_infratrak__work_orders"), self.int_parks, self.codes))

    @cached_property
    def int_vendors(self) -> DataFrame:
        return i.int_vendors(self.staged("stg_stategov__vendors"), self.codes)

    # marts

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._mart("dim_date", m.dim_date(self.spark) if self.dates is None else m.calendar(self.dates))

    @cached_property
    def dim_assets(self) -> DataFrame:
        return self._mart("dim_assets", m.dim_assets(self.int_physical_assets))

    @cached_property
    def dim_employees(self) -> DataFrame:
        return self._mart("dim_employees", m.dim_employees(self.int_employees))

    @cached_property
    def dim_vendors(self) -> DataFrame:
        return self._mart("dim_vendors", m.dim_vendors(self.int_vendors))

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._mart("dim_customers", m.dim_customers(self.int_contacts, self.as_of))

    @cached_property
    def dim_parks(self) -> DataFrame:
        return self._mart("dim_parks", m.dim_parks(self.int_parks, self.regions, self.codes))

    @cached_property
    def dim_reservation_inventory(self) -> DataFrame:
        return self._mart("dim_reservation_inventory", m.dim_reservation_inventory(
            self.int_customer_assets, self.staged("stg_vistareserve__inventory_assets"),
            self.int_parks))

    @cached_property
    def fct_reservations(self) -> DataFrame:
        return self._mart("fct_reservations", m.fct_reservations(self.visits_linked))

    @cached_property
    def fct_pos_transactions(self) -> DataFrame:
        return self._mart("fct_pos_transactions", m.fct_pos_transactions(self.transactions_linked))

    @cached_property
    def fct_park_occupancy_daily_snapshot(self) -> DataFrame:
        return self._mart("fct_park_occupancy_daily_snapshot", m.fct_park_occupancy_daily_snapshot(
            self.fct_reservations, self.dim_date, self.dim_parks))

    @cached_property
    def rpt_park_revenue_summary(self) -> DataFrame:
        return self._mart("rpt_park_revenue_summary", m.rpt_park_revenue_summary(
            self.fct_reservations, self.fct_pos_transactions, self.dim_parks))

    @cached_property
    def fct_visitation(self) -> DataFrame:
        return self._mart("fct_visitation", m.fct_visitation(
            self.visits_linked, self.int_visitor_counts))

    @cached_property
    def fct_expenditures(self) -> DataFrame:
        payables = self.staged("stg_stategov__accounts_payable")
        if "int_financial_transactions" in self._store:  # labelled already, as written
            return self._mart("fct_expenditures", m.fct_expenditures(self.int_financial_transactions, payables))
        spent = m.expenditures_with_vendor(self._entries, payables)
        return self._mart("fct_expenditures", m.fct_expenditures(self._financials(spent, ["vendor_id"])))

    @cached_property
    def fct_incidents_and_maintenance(self) -> DataFrame:
        return self._mart("fct_incidents_and_maintenance", m.fct_incidents_and_maintenance(
            self.int_work_orders, self.int_officer_shifts))

    @cached_property
    def rpt_agency_performance(self) -> DataFrame:
        return self._mart("rpt_agency_performance", m.rpt_agency_performance(
            self.fct_expenditures, self.fct_visitation, self.fct_incidents_and_maintenance))


INTEGRATION_MODELS = (
    "int_parks", "int_contacts", "int_customer_assets", "int_transactions", "int_visits",
    "int_financial_transactions", "int_physical_assets", "int_ecological_surveys",
    "int_visitor_counts", "int_employees", "int_officer_shifts", "int_work_orders", "int_vendors")
MART_MODELS = (
    "fct_visitation", "dim_date", "dim_assets", "dim_employees", "dim_vendors", "fct_expenditures",
    "fct_incidents_and_maintenance", "rpt_agency_performance", "dim_customers", "dim_parks",
    "dim_reservation_inventory", "fct_reservations", "fct_pos_transactions",
    "fct_park_occupancy_daily_snapshot", "rpt_park_revenue_summary")
