"""The study end to end: one encounter table, one hospital table, and the analysis cohort from both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators.cohort import ed_arrival_cohort
from cohortry.plans import area, clinical, hospital
from cohortry.plans.encounter import encounter_recode
from cohortry.sources.tables import table_scan


def study_year(combined: DataFrame, year: int, columns: Sequence[str], under_age: int = 18) -> DataFrame:
    """One year of the combined table: partition, row and column pruning reach the scan."""
    where = (F.col("start_year") == year) & (F.col("age") < under_age)
    return table_scan(combined, where, columns, {"id": "sql_id"})


def encounter_table(
    encounters: DataFrame,
    slots: Sequence[str],
    ccs: DataFrame,
    severity: DataFrame | None = None,
    conditions: DataFrame | None = None,
    injuries: DataFrame | None = None,
    income: DataFrame | None = None,
    education: DataFrame | None = None,
    county_map: DataFrame | None = None,
    urban: DataFrame | None = None,
    on_duplicate: str = "error",
) -> DataFrame:
    """Own-emergency-room cohort, recodes, code classifications and area data. Lookups not given are left out.
    ``on_duplicate="all"``: a repeated code or area gives a row per match."""
    df = encounter_recode(ed_arrival_cohort(encounters))
    df = clinical.injury_flags(clinical.ccs_multilevel(df, slots, ccs, on_duplicate=on_duplicate), slots)
    if severity is not None:
        df = clinical.illness_severity(df, slots, severity, on_duplicate=on_duplicate)
    if conditions is not None:
        df = clinical.ccc_summary(df, slots, conditions)
    if injuries is not None:
        df = clinical.injury_severity(df, slots, injuries, on_duplicate=on_duplicate)
    if income is not None and education is not None:
        df = area.area_income_education(df, income, education, on_duplicate)
    if county_map is not None and urban is not None:
        df = area.urban_rural(df, county_map, urban)
    return df


def hospital_table(
    utilisation: DataFrame,
    finance: DataFrame,
    critical_access: DataFrame,
    urban: DataFrame,
    encounters: DataFrame,
    survey: DataFrame,
    links: DataFrame,
) -> DataFrame:
    """Licences, finances, designations, rurality, encounter rates and survey answers per hospital."""
    base = hospital.financial_flags(hospital.hospital_factors(utilisation), finance)
    flagged = hospital.designation_flags(base, critical_access)
    placed = area.urban_rural_by_name(flagged, urban, "hf_county", "fac")
    # One row per hospital by construction: no key check, which would scan the encounters once more.
    rated = placed.join(hospital.encounter_profile(encounters), "oshpd_id", "left")
    answers = hospital.readiness_survey(survey, links).filter(F.col("oshpd_id").isNotNull())
    return hospital.link_survey(rated, answers)
