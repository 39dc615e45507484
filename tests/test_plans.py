import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortry.functions.levels import levels_of
from cohortry.operators import slots
from cohortry.plans import analysis, area, clinical, encounter, hospital, study
from tests.conftest import rows


def encounter_row(**over):
    base = dict(
        oshpd_id="776", database="edd", ed_disp=1, ip_source_route=None, ip_source_site=None, ip_source_license=None,
        age=0, age_days=27, sex="F", race_group="1", lang_spoken="ENG", payer="MC", rln="x", start_date=dt.date(2011, 1, 1),
        start_month=1, birthdate=dt.date(2010, 12, 5),
    )
    return {**base, **over}


SCHEMA = (
    "oshpd_id string, database string, ed_disp int, ip_source_route int, ip_source_site int, ip_source_license int, age int, "
    "age_days int, sex string, race_group string, lang_spoken string, payer string, rln string, start_date date, start_month int, birthdate date"
)


def recoded(spark, *overs):
    data = [tuple(encounter_row(**o).values()) for o in overs]
    return encounter.encounter_recode(spark.createDataFrame(data, SCHEMA)).collect()


@pytest.mark.parametrize(
    "disp, route, want",
    [
        (2, 1, "transferred"),
        (5, None, "transferred"),
        (1, 1, "admitted"),
        (None, 1, "admitted"),
        (1, 2, "dc home"),
        (3, None, None),
        (None, None, None),
    ],
)
def test_outcome(spark, disp, route, want):
    r = recoded(spark, dict(ed_disp=disp, ip_source_route=route))[0]
    assert r["outcome"] == want
    assert r["transferred"] == (None if want is None else want == "transferred")


def test_age_bands_and_neonate(spark):
    got = recoded(
        spark,
        dict(age=0, age_days=27),
        dict(age=0, age_days=28),
        dict(age=1, age_days=3, birthdate=dt.date(2009, 12, 31)),
        dict(age=2, age_days=0, birthdate=dt.date(2009, 1, 1)),
        dict(age=6, birthdate=dt.date(2004, 6, 1)),
        dict(age=12, birthdate=dt.date(1998, 6, 1)),
        dict(age=17, birthdate=dt.date(1993, 6, 1)),
        dict(age=19, birthdate=dt.date(1991, 6, 1)),
    )
    assert [r["age_cats"] for r in got] == ["0-27d", "28d-12m", "13-23m", "2-5y", "6-11y", "12-17y", "12-17y", "18-21y"]
    assert [r["age_cats2"] for r in got] == ["0-27d", "28d-12m", "1y-11y", "1y-11y", "1y-11y", "12y-17y", "12y-17y", None]
    assert [r["age_cats3"] for r in got][-3:] == ["1y-17y", "1y-17y", None]
    assert [r["age_cats4"] for r in got] == ["0-27d", "28d-12m", "13m-24m", "2y-5y", "6y-11y", "12y-17y", "12y-17y", None]
    assert got[2]["age_cats4_1"] == "Toddler"
    assert [r["neonate"] for r in got] == [True] + [False] * 7
    assert [r["age_days"] for r in got][:3] == [27, 28, None]


def test_recode_misc(spark):
    r = recoded(spark, dict(rln="---------", lang_spoken="*", race_group="4", sex="U", payer=None))[0]
    assert (r["rln"], r["has_rln"], r["lang_spoken2"], r["lang_spoken3"]) == (None, False, "Unknown/I/B", "Other/Unknown")
    assert (r["race_group2"], r["race_group2_5"], r["race_group3"], r["sex2"]) == ("A/PI", "Asian/Pacific Islander", "Other/Unknown", None)
    assert (r["insurance2"], r["insurance3"], r["oshpd_id"], r["ip_course"]) == (None, None, "000776", "NANANA")
    assert r["start_weekend"] and r["enc_season"] == "Winter"


def test_level_order_is_kept(spark):
    df = encounter.encounter_recode(spark.createDataFrame([tuple(encounter_row().values())], SCHEMA))
    assert levels_of(df, "race_group3") == ["White", "Hispanic/Latino", "Black", "Other/Unknown"]
    assert levels_of(df, "age_cats4")[0] == "0-27d"
    out = analysis.analysis_extract(df, ["oshpd_id", "insurance3"], id_col="oshpd_id")
    assert rows(out) == [(776, "Medicaid", 1)]


@pytest.mark.parametrize(
    "db, code, want",
    [("pdd", c, g) for g, cs in encounter.PAYERS["pdd"].items() for c in cs]
    + [("edd", c, g) for g, cs in encounter.PAYERS["edd"].items() for c in cs]
    + [("pdd", "MC", None), ("edd", "3", None), ("edd", None, None), ("pdd", "0", None)],
)
def test_payer_lists(db, code, want):
    # The lists themselves are checked here; the expression over all codes is checked in one query below.
    groups = [g for g, cs in encounter.PAYERS[db].items() if code in cs]
    assert groups == ([want] if want else [])


def test_payer_expression(spark):
    data = [(db, c, g) for db, groups in encounter.PAYERS.items() for g, cs in groups.items() for c in cs]
    data += [("pdd", "MC", None), ("edd", "3", None), ("edd", None, None)]
    df = spark.createDataFrame(data, "database string, payer string, want string")
    assert df.filter(~encounter.payer_group().eqNullSafe(F.col("want"))).count() == 0


def test_ccs_lookup_cleaning(spark):
    raw = spark.createDataFrame([("'042  '", "'5'", "Mental illness"), ("'E800'", "'16'", "Injury and poisoning")], "c string, g string, l string")
    assert rows(clinical.ccs_lookup(raw, "c", "g", "l"), "dx_code") == [("042", 5, "Mental Illness"), ("E800", 16, "Injury and poisoning")]
    assert rows(clinical.ccs_lookup(raw, "c", "g").select("ccs_label"), "dx_code")[0] == ("Mental Illness",)


def test_ccs_single_labels_padded_keys(spark):
    raw = spark.createDataFrame([(".Z  ", "Overall\r"), ("1", "Tuberculosis\r")], "k string, l string")
    df = spark.createDataFrame([("1",), (".Z",), ("9",)], "ccs_dx_prin string")
    got = rows(clinical.ccs_single_label(df, clinical.ccs_single_labels(raw, "k", "l")), "ccs_dx_prin")
    assert got == [(".Z", "Overall"), ("1", "Tuberculosis"), ("9", None)]


def test_code_table_priorities(spark):
    raw = spark.createDataFrame(
        [("icd9_dx", "'5190'", "Technology dependence"), ("icd9_dx", "5190", "Respiratory"), ("icd9_dx", "1", "not a group")],
        "code_system string, code string, category string",
    )
    table = clinical.code_table(raw)
    assert rows(table.select("code", "priority"), "priority") == [("5190", 3), ("5190", 11)]
    df = spark.createDataFrame([(1, "5190", None)], "id int, dx_prin string, odx1 string")
    r = clinical.ccc_summary(df, ["dx_prin", "odx1"], table).first()
    assert (r["ccc_label"], r["has_ccc"], r["ccc_count"], r["has_ccc_any"]) == ("Respiratory", True, 1, True)
    with pytest.raises(ValueError):
        clinical.ccc_classify(df, ["dx_prin"], table, "icd11")


def test_severity_texts_and_maximum(spark):
    raw = spark.createDataFrame(
        [("1", "5", "m", "s"), ("2", "2", "m", "s"), ("3", "Not Categorized", "m", "s")],
        "ICD9_Code string, Severity_Score string, Major_Group_Desc string, Subgroup_Desc string",
    )
    df = spark.createDataFrame([(1, "2", "1"), (2, "3", "x"), (3, "3", "2")], "id int, dx_prin string, odx1 string")
    got = clinical.illness_severity(df, ["dx_prin", "odx1"], clinical.severity_lookup(raw))
    assert rows(got.select("id", "sev_score", "sev_all_max_int", "sev_all_max_factor"), "id") == [
        (1, "2", 5, "5"),
        (2, "Not Categorized", None, None),
        (3, "Not Categorized", 2, "2"),
    ]


def test_injury_score(spark):
    lookup = spark.createDataFrame(
        [("a3", 3, "head"), ("a4", 4, "head"), ("b2", 2, "chest"), ("c5", 5, "face"), ("d1", 1, "limb"), ("x6", 6, "head"), ("u", 9, "face")],
        "dx_code string, ais int, region string",
    )
    df = spark.createDataFrame(
        [(1, "a3", "a4", "b2", "c5", "d1"), (2, "x6", None, None, None, None), (3, "u", None, None, None, None), (4, "zz", None, None, None, None), (5, "u", "d1", None, None, None)],
        "id int, dx_prin string, odx1 string, odx2 string, odx3 string, odx4 string",
    )
    slots = ["dx_prin", "odx1", "odx2", "odx3", "odx4"]
    got = rows(clinical.injury_severity(df, slots, lookup).select("id", "max_injury_sev", "injury_sev", "injury_sev_cat", "max_injury_sev2", "injury_sev_dx_prin_factor"), "id")
    assert got == [
        (1, 5, 25 + 16 + 4, "Moderate to severe", "5", "Serious"),
        (2, 6, 75, "Moderate to severe", "6", "Unsurvivable"),
        (3, 9, None, None, "Unknown", "Unknown"),
        (4, None, None, None, "Missing/Not Assigned", None),
        (5, 1, 1, "Minor", "1", "Unknown"),
    ]


def test_injury_score_regions(spark):
    """A NULL region counts as one region, and there may be any number of regions."""
    many = [(f"r{i}", 1 + i % 4, f"region {i}") for i in range(20)]
    lookup = spark.createDataFrame([("n3", 3, None), ("n4", 4, None), *many], "dx_code string, ais int, region string")
    df = spark.createDataFrame([(1, "n3", "n4", "r1"), (2, "n3", None, "n4"), (3, "r3", "r7", "r11")], "id int, dx_prin string, odx1 string, odx2 string")
    got = rows(clinical.injury_severity(df, ["dx_prin", "odx1", "odx2"], lookup).select("id", "max_injury_sev", "injury_sev"), "id")
    assert got == [(1, 4, 16 + 4), (2, 4, 16), (3, 4, 48)]


def test_area_keys_keep_leading_zero(spark):
    income = spark.createDataFrame([("Id2", "Median"), ("00601", "2,500-"), ("90001", "250,000+"), ("90002", "-")], "GEO_id2 string, HC02_EST_VC02 string")
    edu = spark.createDataFrame([("Id2", "x", "y"), ("00601", "80.5", "-")], "GEO_id2 string, HC01_EST_VC16 string, HC01_EST_VC17 string")
    df = spark.createDataFrame([(1, "00601"), (2, "601"), (3, "90001"), (4, None)], "id int, pat_zip string")
    got = rows(area.area_income_education(df, income, edu).select("id", "census_med_income", "census_hs_higher", "census_bach_higher"), "id")
    assert got == [(1, 2500.0, 80.5, None), (2, None, None, None), (3, 250000.0, None, None), (4, None, None, None)]


def test_financial_and_designation(spark):
    base = spark.createDataFrame([("010776",), ("000001",), ("000002",)], "oshpd_id string")
    finance = spark.createDataFrame([("106000001", "R"), ("106000002", "T"), (None, "R")], "FAC_NO string, TEACH_RURL string")
    got = hospital.financial_flags(base, finance)
    assert rows(got.select("fin_small_rural", "fin_teaching"), "oshpd_id") == [(True, False), (False, True), (False, False)]
    cah = spark.createDataFrame([("106000002",)], "oshpd_id string")
    flags = rows(hospital.designation_flags(base, cah).select("oshpd_id", "cah", "ccs_childrens_hosp"), "oshpd_id")
    assert flags == [("000001", False, False), ("000002", True, False), ("010776", False, True)]


def test_analysis_cohort(spark):
    enc = spark.createDataFrame(
        [("1", "transferred", False, "Private"), ("1", "admitted", False, "Private"), ("1", None, False, "Private"),
         ("1", "dc home", True, "Private"), ("1", "dc home", False, "Medicare"), ("2", "admitted", False, "Private"),
         ("3", "transferred", False, "Private"), ("3", "admitted", False, "Private")],
        "oshpd_id string, outcome string, ccs_injury_any boolean, insurance2 string",
    )
    hosp = spark.createDataFrame([("1", True), ("2", True), ("3", False), ("9", True)], "oshpd_id string, pr_responded boolean")
    cohort, lost = analysis.analysis_cohort(enc, hosp)
    assert [r["n"] for r in lost.orderBy("step").collect()] == [8, 7, 6, 5, 3, 2]
    assert rows(cohort.select("outcome"), "outcome") == [("admitted",), ("transferred",)]


def test_row_operators_take_a_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([(2, None), (1, 1), (1, None)], "ed_disp int, ip_source_route int").write.parquet(path)
    stream = spark.readStream.schema("ed_disp int, ip_source_route int").parquet(path)
    done = encounter.outcome_classify(stream).writeStream.format("memory").queryName("outcomes").start()
    done.processAllAvailable()
    done.stop()
    assert rows(spark.table("outcomes").select("outcome"), "outcome") == [("admitted",), ("dc home",), ("transferred",)]


def test_study_year_prunes_and_renames(spark, tmp_path):
    path = str(tmp_path / "combined")
    data = [(1, 2011, 5, "a"), (2, 2011, 18, "b"), (3, 2012, 5, "c"), (4, 2011, None, "d")]
    spark.createDataFrame(data, "id long, start_year int, age int, dx string").write.partitionBy("start_year").parquet(path)
    out = study.study_year(spark.read.parquet(path), 2011, ["id", "age", "dx"])
    assert rows(out) == [(1, 5, "a")] and out.columns == ["sql_id", "age", "dx"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(start_year" in plan and "LessThan(age,18)" in plan


def test_slot_names():
    assert clinical.slot_names(2) == ["dx_prin", "odx1", "odx2"]


def test_all_none_flags_equal_the_pivot(spark):
    from cohortry.operators.counts import outcome_pivot

    data = [("a", "admitted", False), ("a", "transferred", True), ("b", "admitted", False), ("b", "transferred", False), ("c", "dc home", False), ("d", None, False)]
    df = spark.createDataFrame(data, "oshpd_id string, outcome string, ccs_injury_any boolean")
    got = rows(analysis.all_none_flags(df), "oshpd_id")
    assert got == [("a", False, True), ("b", False, False), ("c", True, True), ("d", True, True)]
    pivot = rows(outcome_pivot(df, "oshpd_id").select("oshpd_id", "all_none"), "oshpd_id")
    assert [(h, f) for h, f, _ in got] == pivot


def test_nearest_and_designation_links(spark):
    base = spark.createDataFrame([("000001",), ("000002",), ("000003",)], "oshpd_id string")
    nearest = spark.createDataFrame(
        [(1, False, 49.9, 1.0, 2.0), (2, False, 50.0, 1.0, 2.0), (3, True, 10.0, 1.0, 2.0)],
        "oshpd_id int, hf_has_ped_bed_lic boolean, near_ped_bed_dist_km double, latitude double, x_longitude double",
    )
    out = hospital.link_nearest(base, nearest, "near_ped", "hf_has_ped_bed_lic", "near_ped_bed_dist_km")
    assert out.columns == ["oshpd_id", "near_ped_bed_dist_km", "near_ped_cats", "near_ped_incl_resourced"]
    assert rows(out.select("near_ped_cats", "near_ped_incl_resourced"), "oshpd_id") == [("0-50km", "0-50km"), ("51km +", "51km +"), (None, "Resourced")]
    survey = spark.createDataFrame(
        [(10, "Y", "Y", "", "Y", "PedEd", "18"), (11, "", "", "", "", "GenED", "")],
        "portalID int, InptPedSvc string, InptPedCap_PICU_YN string, InptPedCap_NICU_YN string, InptPedCap_PedWard_YN string, EDConfig string, AgeMed string",
    )
    links = spark.createDataFrame([(10, "106000001"), (11, "106000002")], "portalID int, oshpd_id string")
    got = hospital.link_designations(base, survey, links).select("oshpd_id", "pr_ped_desig", "pr_inpatient", "pr_ped_2plus", "pr_AgeMed")
    assert rows(got, "oshpd_id") == [
        ("000001", "Ped ED + Ped Ward + PICU", True, True, "18"),
        ("000002", "None", False, False, None),
        ("000003", None, None, None, None),
    ]


def test_flag_factors(spark):
    df = encounter.encounter_recode(spark.createDataFrame([tuple(encounter_row(ed_disp=2).values())], SCHEMA))
    assert levels_of(df, "transferred_char") == ["FALSE", "TRUE"] and df.first()["transferred_char"] == "TRUE"
    assert levels_of(df, "outcome") == ["dc home", "admitted", "transferred"]


def test_codes_with_several_injuries(spark, monkeypatch):
    """All injuries of a code enter the score; a row per injury of the principal code."""
    lookup = spark.createDataFrame(
        [("a", 3, "head"), ("a", 4, "chest"), ("b", 2, None), ("b", 5, "limb"), ("u", 9, "face"), ("z", 0, "head")], "dx_code string, ais int, region string"
    )
    df = spark.createDataFrame([(1, "a", "b"), (2, "u", None), (3, None, "a"), (4, "z", "u"), (5, None, None)], "id int, dx_prin string, odx1 string")
    want = [
        (1, 5, 50, 3, 5), (1, 5, 50, 4, 5), (2, 9, None, 9, None), (3, 4, 25, None, 4), (4, 9, None, 0, 9), (5, None, None, None, None)
    ]
    for limit in (200_000, 1):
        monkeypatch.setattr(clinical, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(slots, "BROADCAST_ROWS", limit)
        got = clinical.injury_severity(df, ["dx_prin", "odx1"], lookup, on_duplicate="all")
        assert sorted(rows(got.select("id", "max_injury_sev", "injury_sev", "injury_sev_dx_prin", "ais_odx1")), key=repr) == want
    once = lookup.filter("ais NOT IN (3, 2)")
    single, several = (clinical.injury_severity(df, ["dx_prin", "odx1"], x, on_duplicate="all") for x in (once, lookup))
    assert sorted(single.columns) == sorted(several.columns)


def test_severity_of_repeated_codes(spark):
    """Score and names of a row come from the same row of the list."""
    raw = spark.createDataFrame(
        [("1", "5", "G1", "S1"), ("1", "2", "G2", "S2")], "ICD9_Code string, Severity_Score string, Major_Group_Desc string, Subgroup_Desc string"
    )
    df = spark.createDataFrame([(1, "1", "x")], "id int, dx_prin string, odx1 string")
    got = clinical.illness_severity(df, ["dx_prin", "odx1"], clinical.severity_lookup(raw), on_duplicate="all")
    assert rows(got.select("sev_score", "sev_major_group", "sev_all_max_int"), "sev_score") == [("2", "G2", 2), ("5", "G1", 5)]


def test_repeated_areas_give_a_row_per_match(spark):
    income = spark.createDataFrame([("10000", "5"), ("10000", "7")], "GEO_id2 string, HC02_EST_VC02 string")
    edu = spark.createDataFrame([("10000", "80", "30")], "GEO_id2 string, HC01_EST_VC16 string, HC01_EST_VC17 string")
    df = spark.createDataFrame([(1, "10000"), (2, "2")], "id int, pat_zip string")
    with pytest.raises(ValueError, match="repeats"):
        area.area_income_education(df, income, edu)
    got = area.area_income_education(df, income, edu, "all").select("id", "census_med_income", "census_hs_higher")
    assert sorted(rows(got), key=repr) == [(1, 5.0, 80.0), (1, 7.0, 80.0), (2, None, None)]
