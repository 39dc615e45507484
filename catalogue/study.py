"""The compositions of a whole study on stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.coding import EDUCATION, INCOME, SURVEY, UTILISATION
from catalogue.rates import BLOCKS, ELIGIBLE, PAYER
from catalogue.registry import ENC, ENCOUNTER, OUTCOME, encounters, query, rounded, select_sql, table
from cohortry.plans import area, clinical, study
from cohortry.plans.analysis import analysis_cohort
from cohortry.plans.encounter import encounter_recode
from cohortry.plans.hospital import hospital_recode

DX = {
    "sql_id": "l_orderkey",
    "dx_prin": "lpad(CAST(l_partkey % 2300 AS STRING), 5, '0')",
    "odx1": "CASE WHEN l_linenumber % 2 = 0 THEN lpad(CAST((l_partkey * 3 + l_suppkey) % 2300 AS STRING), 5, '0') END",
    "odx2": "CASE WHEN l_linenumber % 3 = 0 THEN lpad(CAST((l_partkey * 5 + l_suppkey) % 2300 AS STRING), 5, '0') END",
    "pat_zip": "lpad(CAST(l_suppkey AS STRING), 5, '0')",
    "pat_county": "CAST(l_suppkey % 25 AS INT)",
}
SLOTS3 = ["dx_prin", "odx1", "odx2"]


def full_encounters(spark, d):
    exprs = {**ENCOUNTER, **DX}
    return table(spark, d, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in exprs.items()])


def lookups(spark, d):
    part = table(spark, d, "part").selectExpr(
        "lpad(CAST(p_partkey AS STRING), 5, '0') AS code",
        "CAST(1 + p_size % 18 AS STRING) AS grp",
        "CAST(p_size % 7 AS STRING) AS sev",
        "p_type AS major",
        "p_brand AS sub",
    )
    ccs = clinical.ccs_lookup(part, "code", "grp")
    severity = clinical.severity_lookup(
        part.selectExpr("code AS ICD9_Code", "sev AS Severity_Score", "major AS Major_Group_Desc", "sub AS Subgroup_Desc")
    )
    return ccs, severity


def urban(spark, d, name: str):
    return area.urban_classes(
        table(spark, d, "nation").selectExpr("'CA' AS State_Abr", f"{name} AS County_name", "1 + n_nationkey % 6 AS X2013_code"), "CA"
    )


J = " ".join(f"LEFT JOIN k k{i} ON e.{s} = k{i}.code" for i, s in enumerate(SLOTS3))
INJ = " + ".join(f"coalesce(CAST(k{i}.grp = 16 AS INT), 0)" for i in range(3))


@query(
    "encounter_table",
    f"""WITH e0 AS ({select_sql('lineitem', {**ENCOUNTER, **DX})}),
e AS (SELECT *, {OUTCOME} AS outcome, {PAYER} AS insurance2 FROM e0 WHERE database = 'edd' OR ip_source_route = 1),
k AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS code, 1 + p_size % 18 AS grp,
  CASE WHEN p_size % 7 BETWEEN 1 AND 5 THEN p_size % 7 END AS sev FROM part),
inc AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS z, CASE c_custkey % 5 WHEN 0 THEN 2500.0 WHEN 1 THEN 250000.0 WHEN 2 THEN NULL
  ELSE CASE WHEN floor(c_acctbal) >= 0 THEN floor(c_acctbal) END END AS inc FROM customer WHERE c_custkey > 0)
SELECT sql_id, line, part, charge, outcome, insurance2, {INJ} AS ccs_injury_count, {INJ} >= 1 AS ccs_injury_any,
  greatest(k0.sev, k1.sev, k2.sev) AS sev_all_max_int, CAST(inc AS DOUBLE) AS census_med_income, n_name AS pat_county_name,
  1 + n_nationkey % 6 AS nchs_pat_urban_rural_int
FROM e {J} LEFT JOIN inc ON pat_zip = z LEFT JOIN nation ON pat_county = n_nationkey""",
)
def encounter_table(spark, d):
    ccs, severity = lookups(spark, d)
    income = table(spark, d, "customer").selectExpr(*[f"{e} AS {c}" for c, e in INCOME.items()])
    education = table(spark, d, "supplier").selectExpr(*[f"{e} AS {c}" for c, e in EDUCATION.items()])
    counties = table(spark, d, "nation").selectExpr("n_nationkey AS pat_county", "n_name AS County")
    out = study.encounter_table(
        full_encounters(spark, d), SLOTS3, ccs, severity, income=income, education=education,
        county_map=counties, urban=urban(spark, d, "n_name"), on_duplicate="all",
    )
    return out.select(
        "sql_id", "line", "part", "charge", "outcome", "insurance2", "ccs_injury_count", "ccs_injury_any", "sev_all_max_int",
        "census_med_income", "pat_county_name", "nchs_pat_urban_rural_int",
    )


def rated_encounters(spark, d):
    """Recoded encounters; injury and severity follow from the part of a line."""
    part = table(spark, d, "part").selectExpr(
        "p_partkey AS part", "p_type = 'PROMO' AS ccs_injury_any", "nullif(p_size % 6, 0) AS sev_all_max_int"
    )
    return encounter_recode(encounters(spark, d)).join(part, "part", "left")


RATED = f"""f AS (SELECT oshpd_id, outcome, race_group, p_type = 'PROMO' AS ccs_injury_any, nullif(p_size % 6, 0) AS sev_all_max_int,
  {PAYER} AS insurance2 FROM enc LEFT JOIN part ON part = p_partkey)"""
RF = "count(*) FILTER (WHERE {c}) / CAST(count(*) AS DOUBLE)"


def hospitals(spark, d):
    s = table(spark, d, "supplier")
    finance = s.selectExpr(
        "CASE WHEN s_suppkey % 2 = 0 THEN '106' || lpad(CAST(s_suppkey AS STRING), 6, '0') END AS FAC_NO",
        "CASE s_suppkey % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'T' ELSE '' END AS TEACH_RURL",
    )
    cah = s.filter("s_nationkey = 7").selectExpr("'106' || lpad(CAST(s_suppkey AS STRING), 6, '0') AS oshpd_id")
    links = s.selectExpr(
        "s_suppkey + 1000 AS portalID",
        "CASE WHEN s_suppkey % 4 > 0 THEN '106' || lpad(CAST(s_suppkey AS STRING), 6, '0') END AS oshpd_id",
    )
    return study.hospital_table(
        s.selectExpr(*[f"{e} AS {c}" for c, e in UTILISATION.items()]), finance, cah,
        urban(spark, d, "CAST(n_nationkey AS STRING)"), rated_encounters(spark, d),
        s.selectExpr(*[f"{e} AS {c}" for c, e in SURVEY.items()]), links,
    )


@query(
    "hospital_table",
    f"""WITH {ENC}, {RATED}, a AS (SELECT oshpd_id AS id, {BLOCKS}, {RF.format(c="insurance2 = 'Medicaid'")} AS med,
  {RF.format(c="race_group BETWEEN '0' AND '6' AND race_group <> '1'")} AS nonwhite, {RF.format(c="sev_all_max_int IN (4, 5)")} AS sev,
  nullif(count(*) FILTER (WHERE {ELIGIBLE}), 0) AS ei FROM f GROUP BY oshpd_id)
SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS oshpd_id, s_name AS hf_fac_name, s_suppkey % 2 = 0 AND s_suppkey % 3 = 0 AS fin_small_rural,
  s_nationkey = 7 AS cah, 1 + s_nationkey % 6 AS nchs_fac_urban_rural_int, round(med, 6) AS hf_medicaid_rf, round(nonwhite, 6) AS hf_nonwhite_rf,
  round(sev, 6) AS hf_sev4or5, hf_ALL_total, round(hf_ALL_transferred_rf, 6) AS hf_ALL_transferred_rf, hf_ADMIT_total, hf_DC_transferred_total,
  ei AS hf_ei_ALL_total, s_suppkey % 4 > 0 AS pr_responded
FROM supplier LEFT JOIN a ON id = lpad(CAST(s_suppkey AS VARCHAR), 6, '0') WHERE s_suppkey <> 5""",
)
def hospital_table(spark, d):
    out = hospitals(spark, d).select(
        "oshpd_id", "hf_fac_name", "fin_small_rural", "cah", "nchs_fac_urban_rural_int", "hf_medicaid_rf", "hf_nonwhite_rf",
        "hf_sev4or5", "hf_ALL_total", "hf_ALL_transferred_rf", "hf_ADMIT_total", "hf_DC_transferred_total", "hf_ei_ALL_total", "pr_responded",
    )
    return rounded(out)


@query(
    "hospital_recode",
    f"""WITH {ENC}, a AS (SELECT oshpd_id AS id, count(*) AS n FROM enc GROUP BY oshpd_id),
h AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS oshpd_id, n, s_suppkey, s_nationkey,
  CASE WHEN s_suppkey % 4 > 0 THEN CAST(floor(abs(s_acctbal)) AS INT) % 101 END AS score FROM supplier
  LEFT JOIN a ON id = lpad(CAST(s_suppkey AS VARCHAR), 6, '0') WHERE s_suppkey <> 5)
SELECT oshpd_id, round((n - avg(n) OVER ()) / stddev_samp(n) OVER (), 6) AS hf_ALL_total_norm, score > 70 AS pr_score_cut_70,
  CASE WHEN score < 59.4 THEN 'q1' WHEN score < 74.9 THEN 'q2' WHEN score < 88.2 THEN 'q3' WHEN score >= 88.2 THEN 'q4' END AS pr_ames_quartiles,
  CASE WHEN score < 57.66 THEN 'q1' WHEN score < 69.66 THEN 'q2' WHEN score < 86.02 THEN 'q3' WHEN score >= 86.02 THEN 'q4' END AS pr_score_quartiles,
  CASE s_nationkey % 3 WHEN 0 THEN 'Non-profit' WHEN 1 THEN 'Investor' END AS hf_type_cntrl2,
  CASE s_suppkey % 3 WHEN 0 THEN 'None' WHEN 1 THEN 'Level I & II' ELSE 'Level III & IV' END AS hf_emsa_trauma_lvl3,
  CASE WHEN s_suppkey % 5 = 0 THEN 'TRUE' ELSE 'FALSE' END AS hf_emsa_peds_lvl3,
  CASE WHEN s_suppkey % 4 > 0 AND s_nationkey % 3 = 1 THEN 'FALSE' WHEN s_suppkey % 4 > 0 AND s_suppkey % 3 = 0 THEN 'TRUE'
    WHEN s_suppkey % 4 > 0 AND s_suppkey % 3 = 1 THEN 'FALSE' END AS pr_guidelines_agreements2 FROM h""",
)
def hospital_recode_query(spark, d):
    out = hospital_recode(hospitals(spark, d)).select(
        "oshpd_id", "hf_ALL_total_norm", "pr_score_cut_70", "pr_ames_quartiles", "pr_score_quartiles", "hf_type_cntrl2",
        "hf_emsa_trauma_lvl3", "hf_emsa_peds_lvl3", "pr_guidelines_agreements2",
    )
    return rounded(out)


@query(
    "analysis_cohort",
    f"""WITH {ENC}, {RATED}, p AS (SELECT oshpd_id AS id, count(*) FILTER (WHERE outcome = 'admitted') AS a,
  count(*) FILTER (WHERE outcome = 'transferred') AS t FROM f GROUP BY oshpd_id),
c AS (SELECT f.* FROM f JOIN p ON id = oshpd_id WHERE NOT ccs_injury_any AND outcome IS NOT NULL AND insurance2 <> 'Medicare'
  AND oshpd_id <> '000005' AND CAST(oshpd_id AS INT) % 4 > 0 AND a > 0 AND t > 0)
SELECT oshpd_id, CAST(oshpd_id AS INT) % 2 = 0 AND CAST(oshpd_id AS INT) % 3 = 0 AS fin_small_rural, outcome, count(*) AS n FROM c GROUP BY ALL""",
)
def analysis_cohort_query(spark, d):
    cohort, _ = analysis_cohort(rated_encounters(spark, d), hospitals(spark, d))
    return cohort.groupBy("oshpd_id", "fin_small_rural", "outcome").agg(F.count(F.lit(1)).alias("n"))
