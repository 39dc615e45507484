"""Code slots, classifications and the domain compositions on stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import CCC, COD, ENC, SLOTS, VIS, codes, condition_codes, encounters, query, rounded, table, visits
from cohortry.operators import slots
from cohortry.plans import area, clinical, hospital
from cohortry.plans.encounter import outcome_classify

IDS = ", ".join(SLOTS)


def slot_joins(source: str, on: str, pick: dict[str, str]) -> tuple[str, str]:
    """(select list, left joins) that look a code up for every slot."""
    cols = ", ".join(f"j{i}.{c} AS {name}_{s}" for i, s in enumerate(SLOTS) for name, c in pick.items())
    parts = " ".join(f"LEFT JOIN {source} j{i} ON vis.{s} = j{i}.{on}" for i, s in enumerate(SLOTS))
    return cols, parts


@query(
    "wide_to_long",
    f"WITH {VIS} " + " UNION ALL ".join(f"SELECT id, '{s}' AS slot, {s} AS code FROM vis" for s in SLOTS),
)
def wide_to_long(spark, d):
    return slots.wide_to_long(visits(spark, d), "id", SLOTS)


@query("long_to_wide", f"WITH {VIS} SELECT id, {IDS} FROM vis")
def long_to_wide(spark, d):
    return slots.long_to_wide(slots.wide_to_long(visits(spark, d), "id", SLOTS), "id", "slot", "code", SLOTS)


@query(
    "unique_id_check",
    "SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_ids, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders",
)
def unique_id_check(spark, d):
    return slots.id_check(slots.assert_unique_id(table(spark, d, "orders"), "o_orderkey"), "o_orderkey")


LABEL_COLS, LABEL_JOINS = slot_joins("cod", "dx_code", {"major": "major", "sub": "sub"})


@query("code_slots_lookup", f"WITH {VIS}, {COD} SELECT id, {LABEL_COLS} FROM vis {LABEL_JOINS}")
def code_slots_lookup(spark, d):
    out = slots.lookup_slots(visits(spark, d), SLOTS, codes(spark, d), "dx_code", ["major", "sub"], form="join", on_duplicate="all")
    return out.select("id", *[f"{v}_{s}" for s in SLOTS for v in ("major", "sub")])


@query("code_slots_lookup_long", f"WITH {VIS}, {COD} SELECT id, {LABEL_COLS} FROM vis {LABEL_JOINS}")
def code_slots_lookup_long(spark, d):
    out = slots.lookup_slots(visits(spark, d), SLOTS, codes(spark, d), "dx_code", ["major", "sub"], "id", "long", "all")
    return out.select("id", *[f"{v}_{s}" for s in SLOTS for v in ("major", "sub")])


@query(
    "long_lookup_wide",
    f"WITH {VIS}, {COD} SELECT id, {', '.join(f'j{i}.major AS {s}' for i, s in enumerate(SLOTS))} FROM vis {LABEL_JOINS}",
)
def long_lookup_wide(spark, d):
    return slots.lookup_long_wide(visits(spark, d), "id", SLOTS, codes(spark, d), "dx_code", "major", "all")


CLEAN = """clean AS (SELECT trim(replace(quoted, '''', '')) AS dx_code, CAST(replace(group_text, '''', '') AS INT) AS ccs_group,
  replace(label_text, 'Mental illness', 'Mental Illness') AS ccs_label FROM cod)"""
CCS_COLS, CCS_JOINS = slot_joins("clean", "dx_code", {"ccs_group": "ccs_group", "ccs_label": "ccs_label"})


def ccs_frame(spark, d):
    lookup = clinical.ccs_lookup(codes(spark, d), "quoted", "group_text", "label_text")
    return clinical.ccs_multilevel(visits(spark, d), SLOTS, lookup, on_duplicate="all")


@query("ccs_multilevel", f"WITH {VIS}, {COD}, {CLEAN} SELECT id, {CCS_COLS} FROM vis {CCS_JOINS}")
def ccs_multilevel(spark, d):
    return ccs_frame(spark, d).select("id", *[f"{v}_{s}" for s in SLOTS for v in ("ccs_group", "ccs_label")])


GROUP_LABELS = "CASE ccs_group " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(clinical.CCS_GROUPS, 1)) + " END"
CLEAN10 = f"""clean0 AS (SELECT trim(replace(quoted, '''', '')) AS dx_code, CAST(replace(group_text, '''', '') AS INT) AS ccs_group FROM cod),
clean AS (SELECT *, {GROUP_LABELS} AS ccs_label FROM clean0)"""


@query(
    "ccs_multilevel_icd10",
    f"""WITH {VIS}, {COD}, {CLEAN10} SELECT id, {', '.join(f'j{i}.ccs_label AS {s}' for i, s in enumerate(SLOTS))}
FROM vis {CCS_JOINS}""",
)
def ccs_multilevel_icd10(spark, d):
    lookup = clinical.ccs_lookup(codes(spark, d), "quoted", "group_text")
    return slots.lookup_long_wide(visits(spark, d), "id", SLOTS, lookup, "dx_code", "ccs_label", "all")


INJURED = " + ".join(f"coalesce(CAST(ccs_label_{s} = 'Injury and poisoning' AS INT), 0)" for s in SLOTS)


@query(
    "injury_flags",
    f"""WITH {VIS}, {COD}, {CLEAN}, l AS (SELECT id, {CCS_COLS} FROM vis {CCS_JOINS})
SELECT id, {INJURED} AS ccs_injury_count, {INJURED} >= 1 AS ccs_injury_any, ccs_label_dx_prin = 'Injury and poisoning' AS ccs_injury,
  ccs_label_dx_prin = 'Mental Illness' AS ccs_mental_health FROM l""",
)
def injury_flags(spark, d):
    flagged = clinical.injury_flags(ccs_frame(spark, d), SLOTS)
    return flagged.select("id", "ccs_injury_count", "ccs_injury_any", "ccs_injury", "ccs_mental_health")


@query(
    "ccs_single_label",
    f"""WITH {VIS}, {COD} SELECT id, sub AS ccs285_label FROM vis LEFT JOIN cod ON vis.dx_prin = cod.dx_code""",
)
def ccs_single_label(spark, d):
    padded = codes(spark, d).selectExpr("dx_code || '  ' AS category", "sub || chr(13) AS label")
    labels = clinical.ccs_single_labels(padded, "category", "label")
    return clinical.ccs_single_label(visits(spark, d), labels, "dx_prin", "all").select("id", "ccs285_label")


@query(
    "ccs_single_2018",
    f"""WITH {VIS}, {COD} SELECT id, CASE WHEN major <> 'PROMO' THEN major END AS ccs285_label
FROM vis LEFT JOIN cod ON vis.odx1 = cod.dx_code""",
)
def ccs_single_2018(spark, d):
    """The later label list has categories without a label: they stay NULL."""
    raw = codes(spark, d).selectExpr("dx_code AS category", "nullif(major, 'PROMO') AS label")
    labels = clinical.ccs_single_labels(raw, "category", "label")
    return clinical.ccs_single_label(visits(spark, d), labels, "odx1", "all").select("id", "ccs285_label")


FIRST = """first AS (SELECT code_system, code, arg_min(category, priority) AS category FROM ccc GROUP BY ALL)"""


def ccc_sql(system: str) -> str:
    cols = ", ".join(f"j{i}.category AS ccc_label_{s}" for i, s in enumerate(SLOTS))
    parts = " ".join(
        f"LEFT JOIN first j{i} ON vis.{s} = j{i}.code AND j{i}.code_system = '{system}'" for i, s in enumerate(SLOTS)
    )
    return f"WITH {VIS}, {CCC}, {FIRST} SELECT id, {cols} FROM vis {parts}"


def ccc(system: str):
    def run(spark, d):
        table_ = clinical.code_table(condition_codes(spark, d))
        out = clinical.ccc_classify(visits(spark, d), SLOTS, table_, system)
        return out.select("id", *[f"ccc_label_{s}" for s in SLOTS])

    return run


for _name, _system in {
    "ccc_icd9_dx": "icd9_dx",
    "ccc_icd9_proc": "icd9_proc",
    "ccc_icd10_dx": "icd10_dx",
    "ccc_icd10_proc": "icd10_proc",
}.items():
    query(_name, ccc_sql(_system))(ccc(_system))


@query(
    "ccc_prefix_match",
    f"""WITH {VIS}, {CCC}, stems AS (SELECT substr(code, 1, 4) AS stem, min(priority) AS priority FROM ccc WHERE code_system = 'icd9_dx'
  GROUP BY 1), names AS (SELECT DISTINCT priority, category FROM ccc)
SELECT id, n.category AS ccc_label_dx_prin FROM vis LEFT JOIN stems ON substr(dx_prin, 1, 4) = stem LEFT JOIN names n USING (priority)""",
)
def ccc_prefix_match(spark, d):
    """Listed codes read as stems."""
    listed = clinical.code_table(condition_codes(spark, d))
    stems = listed.withColumn("code", F.substring("code", 1, 4)).distinct()
    out = clinical.ccc_classify(visits(spark, d), ["dx_prin"], stems, "icd9_dx", match="prefix")
    return out.select("id", "ccc_label_dx_prin")


@query(
    "ccc_multi_label",
    f"""WITH {VIS}, {CCC}, lists AS (SELECT code, string_agg(category, '|' ORDER BY priority) AS c
  FROM (SELECT DISTINCT code, priority, category FROM ccc WHERE code_system = 'icd9_dx') GROUP BY code)
SELECT id, c AS ccc_labels FROM vis LEFT JOIN lists ON dx_prin = code""",
)
def ccc_multi_label(spark, d):
    listed = clinical.code_table(condition_codes(spark, d))
    out = clinical.ccc_classify(visits(spark, d), ["dx_prin"], listed, "icd9_dx", mode="multi")
    return out.select("id", F.array_join("ccc_label_dx_prin", "|").alias("ccc_labels"))


HAS = " + ".join(f"CAST(ccc_label_{s} IS NOT NULL AS INT)" for s in SLOTS)


@query(
    "ccc_summary",
    f"""WITH l AS ({ccc_sql("icd9_dx")}) SELECT id, ccc_label_dx_prin AS ccc_label, ccc_label_dx_prin IS NOT NULL AS has_ccc,
  {HAS} AS ccc_count, {HAS} >= 1 AS has_ccc_any FROM l""",
)
def ccc_summary(spark, d):
    out = clinical.ccc_summary(visits(spark, d), SLOTS, clinical.code_table(condition_codes(spark, d)))
    return out.select("id", "ccc_label", "has_ccc", "ccc_count", "has_ccc_any")


SEV = "sev AS (SELECT dx_code, severity_text, TRY_CAST(severity_text AS INT) AS score, major, sub FROM cod)"
SEV_COLS, SEV_JOINS = slot_joins("sev", "dx_code", {"sev": "score"})


@query(
    "illness_severity",
    f"""WITH {VIS}, {COD}, {SEV} SELECT id, {SEV_COLS}, j0.severity_text AS sev_score, j0.major AS sev_major_group, j0.sub AS sev_subgroup,
  greatest({', '.join(f'j{i}.score' for i in range(len(SLOTS)))}) AS sev_all_max_int FROM vis {SEV_JOINS}""",
)
def illness_severity(spark, d):
    raw = codes(spark, d).selectExpr(
        "dx_code AS ICD9_Code", "severity_text AS Severity_Score", "major AS Major_Group_Desc", "sub AS Subgroup_Desc"
    )
    out = clinical.illness_severity(visits(spark, d), SLOTS, clinical.severity_lookup(raw), on_duplicate="all")
    scores = [F.col(f"sev_score_int_{s}").alias(f"sev_{s}") for s in SLOTS]
    return out.select("id", *scores, "sev_score", "sev_major_group", "sev_subgroup", "sev_all_max_int")


LONG_AIS = " UNION ALL ".join(f"SELECT id, {s} AS dx_code FROM vis" for s in SLOTS)


@query(
    "injury_severity",
    f"""WITH {VIS}, {COD}, long AS ({LONG_AIS}),
hit AS (SELECT id, ais, region FROM long JOIN cod USING (dx_code) WHERE ais > 0),
reg AS (SELECT id, region, max(ais) AS ais FROM hit WHERE ais < 9 GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ais DESC) AS k FROM reg),
score AS (SELECT id, CASE WHEN max(ais) = 6 THEN 75 ELSE CAST(sum(ais * ais) AS INT) END AS iss FROM top WHERE k <= 3 GROUP BY id),
mx AS (SELECT id, coalesce(max(ais) FILTER (WHERE ais < 9), 9) AS m FROM hit GROUP BY id)
SELECT vis.id, m AS max_injury_sev, iss AS injury_sev, p.ais AS injury_sev_dx_prin,
  CASE WHEN iss >= 10 THEN 'Moderate to severe' WHEN iss >= 1 THEN 'Minor' END AS injury_sev_cat,
  CASE WHEN m = 9 THEN 'Unknown' WHEN m IS NULL THEN 'Missing/Not Assigned' ELSE CAST(m AS VARCHAR) END AS max_injury_sev2,
  CASE m WHEN 1 THEN 'Minor' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Serious' WHEN 4 THEN 'Severe' WHEN 5 THEN 'Critical'
    WHEN 6 THEN 'Unsurvivable' WHEN 9 THEN 'Unknown' END AS max_injury_sev_factor, nullif(m, 9) AS max_injury_sev_int
FROM vis LEFT JOIN mx USING (id) LEFT JOIN score USING (id) LEFT JOIN cod p ON vis.dx_prin = p.dx_code""",
)
def injury_severity(spark, d):
    out = clinical.injury_severity(visits(spark, d), SLOTS, codes(spark, d).select("dx_code", "ais", "region"), on_duplicate="all")
    return out.select(
        "id", "max_injury_sev", "injury_sev", "injury_sev_dx_prin", "injury_sev_cat", "max_injury_sev2",
        "max_injury_sev_factor", "max_injury_sev_int",
    )


# Area, county and facility tables: customers live in an area (their key), nations are counties.

INCOME = {
    "GEO_id2": "CASE WHEN c_custkey = 0 THEN 'Id2' ELSE lpad(CAST(c_custkey AS STRING), 5, '0') END",
    "HC02_EST_VC02": "CASE c_custkey % 5 WHEN 0 THEN '2,500-' WHEN 1 THEN '250,000+' WHEN 2 THEN '-' "
    "ELSE CAST(CAST(floor(c_acctbal) AS INT) AS STRING) END",
}
EDUCATION = {
    "GEO_id2": "lpad(CAST(s_suppkey + 50 AS STRING), 5, '0')",
    "HC01_EST_VC16": "CASE WHEN s_nationkey % 4 = 0 THEN '-' ELSE CAST(s_nationkey AS STRING) END",
    "HC01_EST_VC17": "CASE WHEN s_nationkey % 5 = 0 THEN '-' ELSE CAST(s_nationkey * 2 AS STRING) END",
}


@query(
    "area_income_education",
    """WITH i AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS z, CASE c_custkey % 5 WHEN 0 THEN 2500.0 WHEN 1 THEN 250000.0
    WHEN 2 THEN NULL ELSE floor(c_acctbal) END AS inc, CAST(CAST(floor(c_acctbal) AS INT) AS VARCHAR) AS txt, c_custkey
  FROM customer WHERE c_custkey > 0),
i2 AS (SELECT z, CASE WHEN c_custkey % 5 > 2 AND txt LIKE '-%' THEN NULL ELSE CAST(inc AS DOUBLE) END AS inc FROM i),
e AS (SELECT lpad(CAST(s_suppkey + 50 AS VARCHAR), 5, '0') AS z, CASE WHEN s_nationkey % 4 > 0 THEN CAST(s_nationkey AS DOUBLE) END AS hs,
  CASE WHEN s_nationkey % 5 > 0 THEN CAST(s_nationkey * 2 AS DOUBLE) END AS bach FROM supplier),
a AS (SELECT coalesce(i2.z, e.z) AS census_zcta, inc, hs, bach FROM i2 FULL JOIN e ON i2.z = e.z)
SELECT o_orderkey, lpad(CAST(o_custkey % 1600 AS VARCHAR), 5, '0') AS pat_zip, census_zcta, inc AS census_med_income,
  hs AS census_hs_higher, bach AS census_bach_higher
FROM orders LEFT JOIN a ON lpad(CAST(o_custkey % 1600 AS VARCHAR), 5, '0') = census_zcta""",
)
def area_income_education(spark, d):
    income = table(spark, d, "customer").selectExpr(*[f"{e} AS {c}" for c, e in INCOME.items()])
    education = table(spark, d, "supplier").selectExpr(*[f"{e} AS {c}" for c, e in EDUCATION.items()])
    orders = table(spark, d, "orders").selectExpr("o_orderkey", "lpad(CAST(o_custkey % 1600 AS STRING), 5, '0') AS pat_zip")
    return area.area_income_education(orders, income, education, "all")


@query(
    "urban_rural",
    """WITH u AS (SELECT n_name AS county, 1 + n_nationkey % 6 AS code FROM nation WHERE n_regionkey <> 4)
SELECT c_custkey, c_nationkey AS pat_county, n_name AS pat_county_name,
  CASE code WHEN 1 THEN 'Large central metro' WHEN 2 THEN 'Large fringe metro' WHEN 3 THEN 'Medium metro' WHEN 4 THEN 'Small metro'
    WHEN 5 THEN 'Micropolitan' WHEN 6 THEN 'Noncore' END AS nchs_pat_urban_rural,
  CASE code WHEN 1 THEN 'Large central metro' WHEN 2 THEN 'Large fringe metro' WHEN 3 THEN 'Medium metro' WHEN 4 THEN 'Small metro'
    WHEN 5 THEN 'Non metro' WHEN 6 THEN 'Non metro' END AS nchs_pat_urban_rural2, code AS nchs_pat_urban_rural_int
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN u ON n_name = county""",
)
def urban_rural(spark, d):
    nation = table(spark, d, "nation")
    raw = nation.selectExpr(
        "CASE WHEN n_regionkey = 4 THEN 'NV' ELSE 'CA' END AS State_Abr", "n_name || ' County' AS County_name", "1 + n_nationkey % 6 AS X2013_code"
    )
    county_map = nation.selectExpr("n_nationkey AS pat_county", "'  ' || n_name || ' ' AS County")
    customers = table(spark, d, "customer").selectExpr("c_custkey", "c_nationkey AS pat_county")
    return area.urban_rural(customers, county_map, area.urban_classes(raw, "CA"))


UTILISATION = {
    "OSHPD_ID": "CASE WHEN s_suppkey = 5 THEN 'Facility id' ELSE '106' || lpad(CAST(s_suppkey AS STRING), 6, '0') END",
    "FAC_NAME": "s_name",
    "COUNTY": "CAST(s_nationkey AS STRING)",
    "FACILITY_LEVEL": "CASE WHEN s_nationkey % 2 = 0 THEN 'Parent Facility' ELSE 'Consolidated Facility' END",
    "TYPE_CNTRL": "CASE WHEN s_nationkey % 3 = 0 THEN 'District' WHEN s_nationkey % 3 = 1 THEN 'Investor - individual' ELSE '0' END",
    "TYPE_SVC_PRINCIPAL": "'General Medical / Surgical'",
    "ED_LIC_LEVL_END": "CASE s_nationkey % 4 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Standby' WHEN 2 THEN 'Comprehensive' ELSE '0' END",
    "TEACH_HOSP": "CASE s_suppkey % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'No' ELSE '' END",
    "PED_BED_LIC": "CASE WHEN s_suppkey % 9 = 0 THEN 'n/a' ELSE CAST(s_suppkey % 5 AS STRING) END",
    "NICU_BED_LIC": "CAST(s_suppkey % 3 AS STRING)",
    "PSY_BED_LIC": "CAST(s_suppkey % 2 AS STRING)",
    "EMSA_TRAUMA_CTR_DESIG": "CASE s_suppkey % 3 WHEN 0 THEN '0' WHEN 1 THEN 'LEVEL I' ELSE 'LEVEL III' END",
    "EMSA_TRAUMA_PEDS_CTR_DESIG": "CASE WHEN s_suppkey % 5 = 0 THEN 'LEVEL II PEDS' ELSE '0' END",
    "EMS_AMB_DIVERS": "'No'",
    "HEALTH_SVC_AREA": "CAST(s_nationkey AS STRING)",
    "LONGITUDE": "CAST(s_suppkey AS STRING)",
    "LATITUDE": "CAST(s_nationkey AS STRING)",
}


def utilisation(spark, d):
    return table(spark, d, "supplier").selectExpr(*[f"{e} AS {c}" for c, e in UTILISATION.items()])


HOSPITAL_SQL = """h AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS oshpd_id, s_suppkey, s_nationkey, s_name FROM supplier WHERE s_suppkey <> 5)"""
HOSPITAL_COLS = """oshpd_id, s_name AS hf_fac_name,
  CASE WHEN s_suppkey % 9 > 0 THEN CAST(s_suppkey % 5 AS INT) END AS hf_ped_bed_lic,
  CASE WHEN s_suppkey % 9 > 0 THEN s_suppkey % 5 > 0 END AS hf_has_ped_bed_lic, s_suppkey % 3 > 0 AS hf_has_nicu_bed_lic,
  s_suppkey % 2 > 0 AS hf_has_psy_bed_lic, s_suppkey % 3 > 0 AS hf_trauma_ctr, s_suppkey % 5 = 0 AS hf_peds_trauma_ctr,
  CASE s_suppkey % 3 WHEN 1 THEN 'LEVEL I' WHEN 2 THEN 'LEVEL III' END AS hf_emsa_trauma_ctr_desig2,
  CASE s_nationkey % 4 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Standby' WHEN 2 THEN 'Comprehensive' END AS hf_ed_lic_levl_end2,
  CASE s_suppkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN FALSE END AS hf_teach_hosp"""


@query("hospital_factors", f"WITH {HOSPITAL_SQL} SELECT {HOSPITAL_COLS} FROM h")
def hospital_factors(spark, d):
    return hospital.hospital_factors(utilisation(spark, d)).select(
        "oshpd_id", "hf_fac_name", "hf_ped_bed_lic", "hf_has_ped_bed_lic", "hf_has_nicu_bed_lic", "hf_has_psy_bed_lic",
        "hf_trauma_ctr", "hf_peds_trauma_ctr", "hf_emsa_trauma_ctr_desig2", "hf_ed_lic_levl_end2", "hf_teach_hosp",
    )


@query(
    "financial_flags",
    f"""WITH {HOSPITAL_SQL} SELECT oshpd_id, CASE WHEN s_suppkey % 2 = 0 THEN CASE s_suppkey % 3 WHEN 0 THEN 'Small/Rural' WHEN 1 THEN 'Teaching' END
  END AS teach_rurl, s_suppkey % 2 = 0 AND s_suppkey % 3 = 0 AS fin_small_rural, s_suppkey % 2 = 0 AND s_suppkey % 3 = 1 AS fin_teaching FROM h""",
)
def financial_flags(spark, d):
    finance = table(spark, d, "supplier").selectExpr(
        "CASE WHEN s_suppkey % 2 = 0 THEN '106' || lpad(CAST(s_suppkey AS STRING), 6, '0') END AS FAC_NO",
        "CASE s_suppkey % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'T' ELSE '' END AS TEACH_RURL",
    )
    base = hospital.hospital_factors(utilisation(spark, d)).select("oshpd_id")
    return hospital.financial_flags(base, finance)


@query(
    "designation_flags",
    f"WITH {HOSPITAL_SQL} SELECT oshpd_id, s_nationkey = 7 AS cah, s_suppkey IN (11, 17) AS ccs_childrens_hosp FROM h",
)
def designation_flags(spark, d):
    listed = table(spark, d, "supplier").filter("s_nationkey = 7").selectExpr("'106' || lpad(CAST(s_suppkey AS STRING), 6, '0') AS oshpd_id")
    base = hospital.hospital_factors(utilisation(spark, d)).select("oshpd_id")
    return hospital.designation_flags(base, listed, ["106000011", "106000017"])


SURVEY = {
    "portalID": "s_suppkey + 1000",
    "Score": "CAST(floor(abs(s_acctbal)) AS INT) % 101",
    "TotalEDPatients": "CAST(s_suppkey * 10 AS INT)",
    "PedEDPatientCat": "CASE s_suppkey % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'mediumHigh' WHEN 2 THEN 'medium' WHEN 3 THEN 'low' ELSE 'x' END",
    "PedEDPatients": "CAST(s_suppkey AS INT)",
    "EDConfig": "CASE s_suppkey % 4 WHEN 0 THEN 'GenEd' WHEN 1 THEN 'GenED' WHEN 2 THEN 'PedEd' ELSE 'SepPedEd' END",
    "PhysTraining_Ped_YN": "'Y'",
    "PhysTraining_PedEM_YN": "'N'",
    "Policies_Triage_YN": "'Y'",
    "Policies_Maltreat_YN": "'N'",
    "agreements": "CASE s_suppkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE '' END",
    "guidelines": "CASE s_nationkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'Z' END",
    "InptPedSvc": "CASE WHEN s_suppkey % 2 = 0 THEN 'Y' ELSE '' END",
    "InptPedCap_PICU_YN": "CASE WHEN s_suppkey % 3 = 0 THEN 'Y' WHEN s_suppkey % 3 = 1 THEN 'N' END",
    "InptPedCap_NICU_YN": "CASE WHEN s_suppkey % 5 = 0 THEN 'Y' ELSE 'N' END",
    "InptPedCap_PedWard_YN": "CASE WHEN s_nationkey % 2 = 0 THEN 'Y' ELSE 'N' END",
}


def survey(spark, d):
    return table(spark, d, "supplier").selectExpr(*[f"{e} AS {c}" for c, e in SURVEY.items()])


@query(
    "readiness_survey",
    f"""WITH {HOSPITAL_SQL}, s AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS id, CAST(floor(abs(s_acctbal)) AS INT) % 101 AS score,
  CASE s_suppkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS agr,
  CASE s_nationkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS gui, s_suppkey AS k FROM supplier WHERE s_suppkey % 4 > 0)
SELECT oshpd_id, score AS pr_Score, score / 10 AS pr_Score10, gui AS pr_guidelines, agr AS pr_agreements,
  CASE gui WHEN 'Yes' THEN TRUE WHEN 'No' THEN FALSE END AS pr_guidelines2,
  CASE WHEN gui = 'No' THEN 'No Guidelines' WHEN agr = 'Yes' THEN 'Guidelines and Agreements'
    WHEN agr = 'No' THEN 'Guidelines, No Agreements' ELSE agr END AS pr_guidelines_agreements,
  CASE WHEN score < 20 THEN '0-20' WHEN score < 40 THEN '20-40' WHEN score < 60 THEN '40-60' WHEN score < 80 THEN '60-80'
    WHEN score >= 80 THEN '80-100' END AS pr_Score_quintiles,
  CASE k % 4 WHEN 0 THEN 'GenED' WHEN 1 THEN 'GenED' WHEN 2 THEN 'PedEd' WHEN 3 THEN 'SepPedEd' END AS pr_EDConfig,
  score IS NOT NULL AS pr_responded FROM h LEFT JOIN s ON oshpd_id = id""",
)
def readiness_survey(spark, d):
    links = table(spark, d, "supplier").selectExpr(
        "s_suppkey + 1000 AS portalID",
        "CASE WHEN s_suppkey % 4 > 0 THEN '106' || lpad(CAST(s_suppkey AS STRING), 6, '0') END AS oshpd_id",
        "s_suppkey AS ResponseID",
    )
    answers = hospital.readiness_survey(survey(spark, d), links).filter(F.col("oshpd_id").isNotNull())
    base = hospital.hospital_factors(utilisation(spark, d)).select("oshpd_id")
    return hospital.link_survey(base, answers).select(
        "oshpd_id", "pr_Score", "pr_Score10", "pr_guidelines", "pr_agreements", "pr_guidelines2", "pr_guidelines_agreements",
        "pr_Score_quintiles", "pr_EDConfig", "pr_responded",
    )


@query(
    "service_designation",
    """WITH f AS (SELECT s_suppkey + 1000 AS portalID, s_suppkey % 4 >= 2 AS e, s_nationkey % 2 = 0 AS w, s_suppkey % 3 = 0 AS p FROM supplier)
SELECT portalID, CASE WHEN e AND w AND p THEN 'Ped ED + Ped Ward + PICU' WHEN e AND w THEN 'Ped ED + Ped Ward' WHEN e AND p THEN 'Ped ED + PICU'
  WHEN w AND p THEN 'Ped Ward + PICU' WHEN p THEN 'PICU only' WHEN w THEN 'Ped Ward only' WHEN e THEN 'Ped ED only' ELSE 'None' END AS pr_ped_desig,
  w OR p AS pr_inpatient2, e OR w OR p AS pr_ped_1plus, CAST(e AS INT) + CAST(w AS INT) + CAST(p AS INT) = 2 AS pr_ped_2, e AND w AND p AS pr_ped_3,
  CAST(e AS INT) + CAST(w AS INT) + CAST(p AS INT) >= 2 AS pr_ped_2plus FROM f""",
)
def service_designation(spark, d):
    return hospital.service_designation(survey(spark, d)).select(
        "portalID", "pr_ped_desig", "pr_inpatient2", "pr_ped_1plus", "pr_ped_2", "pr_ped_3", "pr_ped_2plus"
    )


@query(
    "hospital_standardised",
    f"""WITH {ENC}, r AS (SELECT oshpd_id, count(*) AS n, count(*) FILTER (WHERE outcome = 'transferred') / CAST(count(*) AS DOUBLE) AS rf
  FROM enc GROUP BY oshpd_id)
SELECT oshpd_id, round((n - avg(n) OVER ()) / stddev_samp(n) OVER (), 6) AS total_norm,
  round((rf - avg(rf) OVER ()) / stddev_samp(rf) OVER (), 6) AS rf_norm FROM r""",
)
def hospital_standardised(spark, d):
    from cohortry.functions.numeric import zscore
    from cohortry.operators.rates import transfer_rates

    r = transfer_rates(outcome_classify(encounters(spark, d)), "oshpd_id")
    return rounded(
        r.select("oshpd_id", zscore(r, "hf_ALL_total").alias("total_norm"), zscore(r, "hf_ALL_transferred_rf").alias("rf_norm"))
    )
