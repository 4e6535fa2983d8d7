"""Staging models, one module per source system.

``SPECS`` maps model name to its spec. Two base models and one reshaping model are
not plain projections and live as functions in their system's module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from cairn.operators.projection import StagingSpec, stage
from cairn.plans.staging import (
    biosurvey,
    geoparks,
    granttrack,
    infratrak,
    legacyres,
    peoplefirst,
    rangershield,
    stategov,
    trafficcount,
    vistareserve,
)

SYSTEMS = (biosurvey, geoparks, granttrack, infratrak, legacyres, peoplefirst, rangershield,
           stategov, trafficcount, vistareserve)
SPECS: dict[str, StagingSpec] = {
    f"stg_{spec.system}__{name}": spec for module in SYSTEMS for name, spec in module.MODELS.items()
}
Loader = Callable[[str, str], DataFrame]


def build_staging(model: str, load: Loader, as_of: Column | None = None) -> DataFrame:
    """One staging model over a loader ``(system, table) -> DataFrame``.

    ``as_of`` is the date that ages are measured at; only the asset crosswalk needs it.
    """
    if model == "base_vistareserve__customer_profiles":
        return vistareserve.base_customer_profiles(load("vistareserve", "customer_profiles"))
    if model == "base_vistareserve__asset_crosswalks":
        return vistareserve.base_asset_crosswalks(load("vistareserve", "asset_crosswalk"), as_of)
    if model == "stg_granttrack__award_budget_by_fiscal_year":
        return granttrack.award_budget_by_fiscal_year(
            load("granttrack", "award_budget_by_fiscal_year"))
    spec = SPECS[model]
    base = {"stg_vistareserve__customer_profiles": "base_vistareserve__customer_profiles",
            "stg_vistareserve__asset_crosswalks": "base_vistareserve__asset_crosswalks"}.get(model)
    source = build_staging(base, load, as_of) if base else load(spec.system, spec.table)
    return stage(source, spec)


MODEL_NAMES = (*SPECS, "stg_granttrack__award_budget_by_fiscal_year",
               "base_vistareserve__customer_profiles", "base_vistareserve__asset_crosswalks")
