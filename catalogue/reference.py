"""Code and label lists that come from files in vintages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalogue.registry import CCC, COD, SLOTS, VIS, codes, condition_codes, query, visits
from cohortry.plans import clinical
from cohortry.session import scratch_path
from cohortry.sources import files
from cohortry.sources.reference import Vintage

STEM_SQL = "substr(code, 1, 3 + CAST(substr(code, 5, 1) AS INT) % 3)"
STEMS = f"stems AS (SELECT DISTINCT {STEM_SQL} AS stem, priority, category FROM ccc WHERE code_system = 'icd9_dx')"


def listed_stems(spark, d):
    """Condition groups as published files: stems of three to five characters, the four systems in two files."""
    rows = condition_codes(spark, d).selectExpr("code_system", f"{STEM_SQL} AS code", "category").distinct()
    vintages = []
    for name, systems in (("diagnoses", ("icd9_dx", "icd10_dx")), ("procedures", ("icd9_proc", "icd10_proc"))):
        path = scratch_path(spark, f"groups-{name}")
        padded = rows.filter(F.col("code_system").isin(*systems)).withColumn("code", F.concat(F.lit("\'"), "code", F.lit(" \'")))
        files.write_csv(padded.withColumnRenamed("category", "condition.group"), path)
        vintages.append(Vintage(name, path, rename={"condition_group": "category"}))
    return clinical.read_code_table(spark, vintages)


FIRST_STEM = ", ".join(
    f"(SELECT arg_min(category, priority) FROM stems WHERE starts_with({s}, stem)) AS ccc_label_{s}" for s in SLOTS
)
ALL_STEMS = ", ".join(
    f"(SELECT string_agg(category, '|' ORDER BY priority) FROM (SELECT DISTINCT category, priority FROM stems WHERE starts_with({s}, stem))) AS ccc_label_{s}"
    for s in SLOTS
)


@query("ccc_stems_from_files", f"WITH {VIS}, {CCC}, {STEMS} SELECT id, {FIRST_STEM} FROM vis")
def ccc_stems_from_files(spark, d):
    out = clinical.ccc_classify(visits(spark, d), SLOTS, listed_stems(spark, d), "icd9_dx", match="prefix")
    return out.select("id", *[f"ccc_label_{s}" for s in SLOTS])


@query("ccc_stems_multi", f"WITH {VIS}, {CCC}, {STEMS} SELECT id, {ALL_STEMS} FROM vis")
def ccc_stems_multi(spark, d):
    out = clinical.ccc_classify(visits(spark, d), SLOTS, listed_stems(spark, d), "icd9_dx", match="prefix", mode="multi")
    return out.select("id", *[F.array_join(f"ccc_label_{s}", "|").alias(f"ccc_label_{s}") for s in SLOTS])


@query(
    "ccs_label_vintages",
    f"""WITH {VIS}, {COD} SELECT id, CASE WHEN start_date >= DATE '1998-07-01' THEN CASE WHEN sub <> 'Brand#3' THEN sub END
  WHEN start_date >= DATE '1996-01-01' THEN major END AS ccs285_label FROM vis LEFT JOIN cod ON vis.dx_prin = cod.dx_code""",
)
def ccs_label_vintages(spark, d):
    """The earlier list is padded and quoted, the later one has categories without a label; days before both have none."""
    early, late = scratch_path(spark, "labels-early"), scratch_path(spark, "labels-late")
    source = codes(spark, d)
    files.write_csv(source.selectExpr("dx_code || '  ' AS `CCS CATEGORIES`", "major || '  ' AS `CCS LABELS`"), early)
    files.write_csv(source.selectExpr("quoted AS `X.CATEGORY.`", "nullif(sub, 'Brand#3') AS ccs_grouper"), late)
    vintages = [
        Vintage("early", early, date(1996, 1, 1), {"CCS_CATEGORIES": "category", "CCS_LABELS": "label"}),
        Vintage("late", late, date(1998, 7, 1), {"X_CATEGORY_": "category", "ccs_grouper": "label"}),
    ]
    labels = clinical.read_single_labels(spark, vintages, "all")
    out = clinical.ccs_single_label_at(visits(spark, d), labels, vintages, "start_date", "dx_prin", "all")
    return out.select("id", "ccs285_label")
