"""The hospital table: licences, finances, designations, encounter rates, survey, distances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cohortry.functions.levels import factor, flag_factor
from cohortry.functions.numeric import zscores
from cohortry.functions.recode import band, case_when, flag_product, in_set, recode_map, true_count, values_to_null
from cohortry.functions.text import hospital_key, safe_cast
from cohortry.operators.cohort import membership_flag
from cohortry.operators.joins import lookup_join
from cohortry.operators.projection import map_columns, prefix_lower_names, reorder_columns, select_by_pattern
from cohortry.operators.rates import hospital_profile
from cohortry.session import checkpointed
from cohortry.sources.files import drop_leading_rows

# Columns taken from the utilisation file, and its codes.
UTILISATION_COLUMNS = [
    "OSHPD_ID",
    "FAC_NAME",
    "COUNTY",
    "FACILITY_LEVEL",
    "TYPE_CNTRL",
    "TYPE_SVC_PRINCIPAL",
    "ED_LIC_LEVL_END",
    "TEACH_HOSP",
    "PED_BED_LIC",
    "NICU_BED_LIC",
    "PSY_BED_LIC",
    "EMSA_TRAUMA_CTR_DESIG",
    "EMSA_TRAUMA_PEDS_CTR_DESIG",
    "EMS_AMB_DIVERS",
    "HEALTH_SVC_AREA",
    "LONGITUDE",
    "LATITUDE",
]
ED_LEVELS = ["Basic", "Standby", "Comprehensive"]
# Ids of the children's hospitals.
CHILDRENS_HOSPITALS = [
    "106010776",
    "106010856",
    "106190170",
    "106190429",
    "106190555",
    "106191227",
    "106191228",
    "106196168",
    "106204019",
    "106300032",
    "106314024",
    "106341006",
    "106341052",
    "106361246",
    "106370673",
    "106380777",
    "106380964",
    "106381154",
    "106430883",
    "106434040",
    "106434153",
    "106190796",
]
CONTROL_TYPES = {
    "City and/or County": "Non-profit",
    "District": "Non-profit",
    "Investor - individual": "Investor",
    "Investor - Corporation": "Investor",
    "Investor - Limited Liability Company": "Investor",
    "Investor - Partnership": "Investor",
    "Non-Profit Corporation (incl. Church-related)": "Non-profit",
    "University of California": "Non-profit",
    "State": "Non-profit",
}
TRAUMA_LEVELS = {
    "LEVEL I": "Level I & II",
    "LEVEL II": "Level I & II",
    "LEVEL III": "Level III & IV",
    "LEVEL IV": "Level III & IV",
    "0": "None",
}
PEDS_TRAUMA = {"LEVEL I PEDS": "TRUE", "LEVEL II PEDS": "TRUE", "0": "FALSE"}
STATE_PREFIX = 3


def hospital_factors(utilisation: DataFrame) -> DataFrame:
    """Facility attributes: description rows dropped, casts, bed and trauma flags, ``hf_`` names."""
    data = drop_leading_rows(utilisation.select(*UTILISATION_COLUMNS), "OSHPD_ID")
    beds = {c: safe_cast(c, "int") for c in ("PED_BED_LIC", "NICU_BED_LIC", "PSY_BED_LIC")}
    trauma, peds = F.col("EMSA_TRAUMA_CTR_DESIG"), F.col("EMSA_TRAUMA_PEDS_CTR_DESIG")
    out = data.withColumns(
        {
            **beds,
            "has_ped_bed_lic": beds["PED_BED_LIC"] > 0,
            "has_nicu_bed_lic": beds["NICU_BED_LIC"] > 0,
            "has_psy_bed_lic": beds["PSY_BED_LIC"] > 0,
            "trauma_ctr": trauma != "0",
            "peds_trauma_ctr": peds != "0",
            "EMSA_TRAUMA_CTR_DESIG2": values_to_null(trauma, "0"),
            "EMSA_TRAUMA_PEDS_CTR_DESIG2": values_to_null(peds, "0"),
            "ED_LIC_LEVL_END2": factor("ED_LIC_LEVL_END", "ED_LIC_LEVL_END2", ED_LEVELS),
            "TEACH_HOSP": recode_map(F.upper("TEACH_HOSP"), {"YES": True, "NO": False}, default=None),
            "OSHPD_ID": hospital_key("OSHPD_ID", STATE_PREFIX),
        }
    )
    named = prefix_lower_names(out, "hf_").withColumnRenamed("hf_oshpd_id", "oshpd_id")
    return reorder_columns(named, ["oshpd_id"])


def financial_flags(hospitals: DataFrame, finance: DataFrame) -> DataFrame:
    """Small/rural and teaching from a one-letter code; hospitals without a report are neither."""
    code = F.col("TEACH_RURL")
    kinds = finance.filter(F.col("FAC_NO").isNotNull()).select(
        hospital_key("FAC_NO", STATE_PREFIX).alias("oshpd_id"),
        case_when((code == "R", "Small/Rural"), (code == "T", "Teaching")).alias("teach_rurl"),
    )
    joined = lookup_join(hospitals, kinds, "oshpd_id")
    return joined.withColumns(
        {
            "fin_small_rural": F.coalesce(F.col("teach_rurl") == "Small/Rural", F.lit(False)),
            "fin_teaching": F.coalesce(F.col("teach_rurl") == "Teaching", F.lit(False)),
        }
    )


def designation_flags(
    hospitals: DataFrame, critical_access: DataFrame, childrens: Sequence[str] = tuple(CHILDRENS_HOSPITALS)
) -> DataFrame:
    """Critical-access and children's hospitals; both lists carry the state prefix, the table does not."""
    stripped = critical_access.select(hospital_key("oshpd_id", STATE_PREFIX).alias("oshpd_id"))
    flagged = membership_flag(hospitals, stripped, "oshpd_id", "cah")
    keys = [c[STATE_PREFIX:] for c in childrens]
    return flagged.withColumn("ccs_childrens_hosp", in_set("oshpd_id", keys))


def nearest_resource(col: str, resourced: str, distance: str) -> dict[str, Column]:
    """Band of a precomputed distance, and the same with the resourced hospitals as a level."""
    near = F.when(~F.col(resourced), band(distance, [50], ["0-50km", "51km +"]))
    return {
        f"{col}_cats": factor(near, f"{col}_cats", ["0-50km", "51km +"]),
        f"{col}_incl_resourced": F.coalesce(near, F.lit("Resourced")),
    }


def link_nearest(hospitals: DataFrame, nearest: DataFrame, name: str, resourced: str, distance: str) -> DataFrame:
    """Attach a nearest-resource file by hospital with its bands; its copies of hospital columns and its
    coordinates are left out."""
    banded = nearest.withColumn("oshpd_id", hospital_key("oshpd_id")).withColumns(
        nearest_resource(name, resourced, distance)
    )
    keep = [c for c in banded.columns if not c.startswith("hf_") and not c.endswith(("latitude", "longitude"))]
    return lookup_join(hospitals, banded.select(*keep), "oshpd_id")


def readiness_survey(survey: DataFrame, links: DataFrame) -> DataFrame:
    """Survey answers per hospital: ids linked, yes/no recoded, the combination label, score bands, ``pr_`` names."""
    linked = lookup_join(survey, links.select("portalID", "oshpd_id"), "portalID")
    policies = [c for c in survey.columns if c.startswith("Policies") and c != "Policies_Maltreat_YN"]
    base = linked.select(
        "oshpd_id",
        "Score",
        "TotalEDPatients",
        "PedEDPatientCat",
        "PedEDPatients",
        "EDConfig",
        "PhysTraining_Ped_YN",
        "PhysTraining_PedEM_YN",
        *policies,
        "agreements",
        "guidelines",
    )
    # A blank answer is "Unknown"; only a truly missing one stays NULL.
    answer = {"Y": "Yes", "N": "No"}
    first = base.withColumns(
        {
            "oshpd_id": hospital_key("oshpd_id", STATE_PREFIX),
            "guidelines": recode_map("guidelines", answer, default="Unknown"),
            "agreements": recode_map("agreements", answer, default="Unknown"),
            "Score10": F.col("Score") / 10,
            "Score_quintiles": band("Score", [20, 40, 60, 80], ["0-20", "20-40", "40-60", "60-80", "80-100"]),
            "PedEDPatientCat": factor("PedEDPatientCat", "PedEDPatientCat", ["high", "mediumHigh", "medium", "low"]),
            "EDConfig": recode_map("EDConfig", {"GenEd": "GenED"}),
        }
    )
    both = case_when(
        (F.col("guidelines") == "No", "No Guidelines"),
        (F.col("agreements") == "Yes", "Guidelines and Agreements"),
        (F.col("agreements") == "No", "Guidelines, No Agreements"),
        otherwise=F.col("agreements"),
    )
    flags = {"Yes": True, "No": False}
    out = first.withColumns(
        {
            "guidelines2": recode_map("guidelines", flags, default=None),
            "agreements2": recode_map("agreements", flags, default=None),
            "guidelines_agreements": both,
            "guidelines_agreements_factor": factor(
                both,
                "guidelines_agreements_factor",
                ["Guidelines and Agreements", "Guidelines, No Agreements", "No Guidelines"],
            ),
        }
    )
    return prefix_lower_names(out, "pr_", keep=["oshpd_id"], lower=False)


def link_survey(hospitals: DataFrame, survey: DataFrame) -> DataFrame:
    joined = lookup_join(hospitals, survey, "oshpd_id")
    return joined.withColumn("pr_responded", F.col("pr_Score").isNotNull())


def service_designation(survey: DataFrame) -> DataFrame:
    """Ward / intensive-care / paediatric-emergency flags (blank → no) → one of eight labels and counting flags."""

    def yes(col: str) -> Column:
        return F.coalesce(F.col(col) == "Y", F.lit(False))

    flagged = survey.withColumns(
        {
            "pr_inpatient": yes("InptPedSvc"),
            "pr_has_picu": yes("InptPedCap_PICU_YN"),
            "pr_has_nicu": yes("InptPedCap_NICU_YN"),
            "pr_has_ped_ward": yes("InptPedCap_PedWard_YN"),
            "pr_has_ped_ed": in_set("EDConfig", ["PedEd", "SepPedEd"]),
        }
    )
    flags = [F.col("pr_has_ped_ed"), F.col("pr_has_ped_ward"), F.col("pr_has_picu")]
    n = true_count(flags)
    ages = ["AgeMed", "AgeMed_Other_Comments", "AgeTrauma", "AgeTrauma_Other_Comments"]
    return flagged.withColumns(
        {
            **{f"pr_{c}": values_to_null(c, "") for c in ages if c in survey.columns},
            "pr_ped_desig": flag_product(list(zip(flags, ["Ped ED", "Ped Ward", "PICU"]))),
            "pr_inpatient2": F.col("pr_has_ped_ward") | F.col("pr_has_picu"),
            "pr_ped_1plus": n >= 1,
            "pr_ped_2": n == 2,
            "pr_ped_3": n == 3,
            "pr_ped_2plus": n >= 2,
        }
    )


def link_designations(hospitals: DataFrame, survey: DataFrame, links: DataFrame) -> DataFrame:
    """Attach the service designations of the survey by hospital; blank answers count as missing."""
    cleaned = map_columns(survey, lambda c: values_to_null(c, ""), StringType)
    keys = links.select("portalID", hospital_key("oshpd_id", STATE_PREFIX).alias("oshpd_id"))
    named = lookup_join(service_designation(cleaned), keys, "portalID").filter(F.col("oshpd_id").isNotNull())
    return lookup_join(hospitals, select_by_pattern(named, ["oshpd_id"], starts="pr_"), "oshpd_id")


def encounter_profile(encounters: DataFrame, hospital: str = "oshpd_id") -> DataFrame:
    """All encounter-derived hospital rates, for all rows and for the non-injured without Medicare."""
    rates = {
        "medicaid_rf": F.col("insurance3") == "Medicaid",
        "medicaid_or_uninsured_rf": F.col("insurance3").isin("Medicaid", "Uninsured/self-pay"),
        "nonwhite_rf": F.col("race_group2") != "White",
        "sev4or5": F.col("sev_all_max_int").isin(4, 5),
    }
    eligible = F.col("outcome").isNotNull() & ~F.col("ccs_injury_any") & (F.col("insurance2") != "Medicare")
    return hospital_profile(encounters, hospital, rates, {"": None, "ei_": eligible})


def hospital_recode(hospitals: DataFrame) -> DataFrame:
    """Analysis forms of the hospital table: percentages, standardised rates, score cuts, collapsed categories.

    The table is checkpointed first: it is small, and the standardisation reads it a second time.
    """
    hospitals = checkpointed(hospitals)
    rates = ["medicaid", "medicaid_or_uninsured", "nonwhite"]
    z = zscores(hospitals, ["hf_ALL_total", "hf_medicaid_rf", "hf_nonwhite_rf", "hf_sev4or5"])
    renamed = hospitals.withColumnsRenamed(
        {
            "hf_emsa_trauma_ctr_desig": "hf_emsa_trauma_lvl",
            "hf_emsa_trauma_ctr_desig2": "hf_emsa_trauma_lvl2",
            "hf_emsa_trauma_peds_ctr_desig": "hf_emsa_peds_lvl",
            "hf_emsa_trauma_peds_ctr_desig2": "hf_emsa_peds_lvl2",
        }
    )
    return renamed.withColumns(
        {
            **{f"hf_{r}_pct": F.col(f"hf_{r}_rf") * 100 for r in rates},
            "hf_sev4or5_pct": F.col("hf_sev4or5") * 100,
            "hf_ALL_total_norm": z["hf_ALL_total"],
            "hf_medicaid_norm": z["hf_medicaid_rf"],
            "hf_nonwhite_norm": z["hf_nonwhite_rf"],
            "hf_sev4or5_norm": z["hf_sev4or5"],
            "pr_score_cut_70": F.col("pr_Score") > 70,
            "pr_score_cut_70_factor": flag_factor(F.col("pr_Score") > 70, "pr_score_cut_70_factor"),
            "fin_small_rural_factor": flag_factor("fin_small_rural", "fin_small_rural_factor", true_first=True),
            "pr_ames_quartiles": band("pr_Score", [59.4, 74.9, 88.2], ["q1", "q2", "q3", "q4"]),
            "pr_score_quartiles": band("pr_Score", [57.66, 69.66, 86.02], ["q1", "q2", "q3", "q4"]),
            "pr_guidelines_agreements2": recode_map(
                "pr_guidelines_agreements",
                {
                    "Guidelines and Agreements": "TRUE",
                    "Guidelines, No Agreements": "FALSE",
                    "No Guidelines": "FALSE",
                },
                default=None,
            ),
            "hf_type_cntrl2": recode_map("hf_type_cntrl", CONTROL_TYPES, default=None),
            "hf_emsa_trauma_lvl3": recode_map("hf_emsa_trauma_lvl", TRAUMA_LEVELS, default=None),
            "hf_emsa_peds_lvl3": recode_map("hf_emsa_peds_lvl", PEDS_TRAUMA, default=None),
        }
    )
