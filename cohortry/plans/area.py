"""Area-level data: income and education by postal area, urban/rural class by county."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.levels import factor
from cohortry.functions.recode import conditional_assign, values_to_null
from cohortry.functions.text import replace_in_order, replace_text, safe_cast
from cohortry.operators.joins import full_join, lookup_join
from cohortry.sources.files import drop_leading_rows

# Six urban/rural classes in order, and the five-class form.
URBAN_RURAL = [
    "Large central metro",
    "Large fringe metro",
    "Medium metro",
    "Small metro",
    "Micropolitan",
    "Noncore",
]
URBAN_RURAL_5 = ["Large central metro", "Large fringe metro", "Medium metro", "Small metro", "Non metro"]
# Capped income texts, applied in this order; a remaining dash means no value.
INCOME_RULES = [("2,500-", "2500"), ("250,000\\+", "250000"), ("-", None)]


def area_income(raw: DataFrame) -> DataFrame:
    """Area key stays text, so leading zeros survive."""
    data = drop_leading_rows(raw, "GEO_id2")
    income = safe_cast(replace_in_order("HC02_EST_VC02", INCOME_RULES), "double")
    return data.select(F.trim("GEO_id2").alias("census_zcta"), income.alias("census_med_income"))


def area_education(raw: DataFrame) -> DataFrame:
    data = drop_leading_rows(raw, "GEO_id2")
    return data.select(
        F.trim("GEO_id2").alias("census_zcta"),
        safe_cast(values_to_null("HC01_EST_VC16", "-"), "double").alias("census_hs_higher"),
        safe_cast(values_to_null("HC01_EST_VC17", "-"), "double").alias("census_bach_higher"),
    )


def area_table(income_raw: DataFrame, education_raw: DataFrame) -> DataFrame:
    both = full_join(area_income(income_raw), area_education(education_raw), "census_zcta")
    return both.filter(F.col("census_zcta").isNotNull()).withColumn("pat_zip", F.col("census_zcta"))


def area_income_education(df: DataFrame, income_raw: DataFrame, education_raw: DataFrame, on_duplicate: str = "error") -> DataFrame:
    return lookup_join(df, area_table(income_raw, education_raw), "pat_zip", on_duplicate)


def urban_classes(raw: DataFrame, state: str) -> DataFrame:
    """County name → class number, six-level name and five-level name, one state only."""
    here = raw.filter(F.col("State_Abr") == state).select(
        replace_text("County_name", " County", "").alias("county"), F.col("X2013_code").cast("int").alias("code")
    )
    five = conditional_assign("code", F.col("code") == 6, 5)
    return here.select(
        "county",
        F.col("code").alias("urban_rural_int"),
        factor("code", "urban_rural", range(1, 7), URBAN_RURAL),
        factor(five, "urban_rural2", range(1, 6), URBAN_RURAL_5),
    )


def urban_rural(df: DataFrame, county_map: DataFrame, classes: DataFrame, key: str = "pat_county", tag: str = "pat") -> DataFrame:
    """County number → name → class. ``county_map``: pat_county, County."""
    names = county_map.select(F.col("pat_county").alias(key), F.trim("County").alias(f"{tag}_county_name"))
    named = lookup_join(df, names, key)
    return urban_rural_by_name(named, classes, f"{tag}_county_name", tag)


def urban_rural_by_name(df: DataFrame, classes: DataFrame, key: str, tag: str) -> DataFrame:
    renamed = classes.select(
        F.col("county").alias(key),
        F.col("urban_rural").alias(f"nchs_{tag}_urban_rural"),
        F.col("urban_rural2").alias(f"nchs_{tag}_urban_rural2"),
        F.col("urban_rural_int").alias(f"nchs_{tag}_urban_rural_int"),
    )
    return lookup_join(df, renamed, key)
