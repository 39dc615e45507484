"""Diagnosis-code work on the principal and other code slots. Code tables are arguments: published lists are
read from the user's files, see ``code_table``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions.levels import factor, flag_factor
from cohortry.functions.recode import band, case_when, in_set, recode_map, values_to_null
from cohortry.functions.rowwise import row_any, row_count_true, row_max
from cohortry.functions.text import replace_text, safe_cast, strip_chars
from cohortry.operators.joins import key_counts, lookup_join
from cohortry.operators.slots import classify, held_part, lookup_slots
from cohortry.session import BROADCAST_ROWS
from cohortry.sources.reference import Vintage, label_at, read_reference

# The 18 multi-level groups in order of their number.
CCS_GROUPS = [
    "Infectious and parasitic diseases",
    "Neoplasms",
    "Endocrine; nutritional; and metabolic diseases and immunity disorders",
    "Diseases of the blood and blood-forming organs",
    "Mental Illness",
    "Diseases of the nervous system and sense organs",
    "Diseases of the circulatory system",
    "Diseases of the respiratory system",
    "Diseases of the digestive system",
    "Diseases of the genitourinary system",
    "Complications of pregnancy; childbirth; and the puerperium",
    "Diseases of the skin and subcutaneous tissue",
    "Diseases of the musculoskeletal system and connective tissue",
    "Congenital anomalies",
    "Certain conditions originating in the perinatal period",
    "Injury and poisoning",
    "Symptoms; signs; and ill-defined conditions and factors influencing health status",
    "Residual codes; unclassified; all E codes [259. and 260.]",
]
INJURY, MENTAL = CCS_GROUPS[15], CCS_GROUPS[4]

# Complex chronic condition groups; an earlier one wins over a later one.
CCC_GROUPS = [
    "Neurologic and Neuromuscular",
    "Cardiovascular",
    "Respiratory",
    "Renal and urologic",
    "Gastrointestinal",
    "Hematologic or immunologic",
    "Metabolic",
    "Other congenital or Genetic defect",
    "Malignancy",
    "Premature and neonatal",
    "Technology dependence",
    "Transplantation",
]
CODE_SYSTEMS = ["icd9_dx", "icd9_proc", "icd10_dx", "icd10_proc"]
SEVERITY_LEVELS = ["1", "2", "3", "4", "5"]
# Severity codes of an injury and their labels.
AIS_LABELS = {1: "Minor", 2: "Moderate", 3: "Serious", 4: "Severe", 5: "Critical", 6: "Unsurvivable", 9: "Unknown"}


def slot_names(others: int) -> list[str]:
    return ["dx_prin", *[f"odx{i}" for i in range(1, others + 1)]]


def ccs_lookup(raw: DataFrame, code: str, group: str, label: str | None = None) -> DataFrame:
    """Clean a multi-level file: quotes and blanks off the codes, group number, one spelling of the labels.
    Without a label column the label follows from the group number."""
    number = safe_cast(strip_chars(group), "int")
    if label is None:
        text = factor(number, "ccs_label", range(1, len(CCS_GROUPS) + 1), CCS_GROUPS)
    else:
        text = replace_text(strip_chars(label, "'"), "Mental illness", "Mental Illness", first_only=True)
    return raw.select(strip_chars(code).alias("dx_code"), number.alias("ccs_group"), text.alias("ccs_label"))


def ccs_multilevel(
    df: DataFrame, slots: Sequence[str], lookup: DataFrame, id_col: str | None = None, form: str = "auto", on_duplicate: str = "error"
) -> DataFrame:
    """``ccs_group_<slot>`` and ``ccs_label_<slot>`` for every slot."""
    return lookup_slots(df, slots, lookup, "dx_code", ["ccs_group", "ccs_label"], id_col, form, on_duplicate)


def injury_flags(df: DataFrame, slots: Sequence[str]) -> DataFrame:
    """Injury slots counted, any and principal; mental health in the principal slot."""
    labels = [f"ccs_label_{s}" for s in slots]
    counted = df.withColumn("ccs_injury_count", row_count_true(labels, lambda c: c == INJURY))
    return counted.withColumns(
        {
            "ccs_injury_any": F.col("ccs_injury_count") >= 1,
            "ccs_injury": F.col(labels[0]) == INJURY,
            "ccs_mental_health": F.col(labels[0]) == MENTAL,
        }
    )


def ccs_single_labels(raw: DataFrame, key: str, label: str) -> DataFrame:
    """The single-level label file: padded keys and labels trimmed, line-end rests removed."""
    return raw.select(F.trim(F.regexp_replace(key, "[\\r']", "")).alias("ccs"), F.trim(F.regexp_replace(label, "\\r", "")).alias("ccs285_label"))


def ccs_single_label(df: DataFrame, labels: DataFrame, col: str = "ccs_dx_prin", on_duplicate: str = "error") -> DataFrame:
    """Label of the single-level category already in the data; unlisted → NULL."""
    keyed = df.withColumn("ccs", F.trim(F.col(col).cast("string")))
    return lookup_join(keyed, labels, "ccs", on_duplicate).drop("ccs")


def code_table(raw: DataFrame, groups: Sequence[str] = tuple(CCC_GROUPS)) -> DataFrame:
    """(code_system, code, category) rows of a published list plus the priority its group has."""
    order = [F.when(F.col("category") == g, F.lit(i)) for i, g in enumerate(groups, start=1)]
    return raw.select(
        "code_system", strip_chars("code").alias("code"), "category", F.coalesce(*order).alias("priority")
    ).filter(F.col("priority").isNotNull())


def read_code_table(spark: SparkSession, vintages: Sequence[Vintage], groups: Sequence[str] = tuple(CCC_GROUPS)) -> DataFrame:
    """Published condition-group lists (code_system, code, category), each file a vintage, with their groups' priority.
    A code may be in several groups of its system, but only once in each; a category that is no group is an error."""
    listed = read_reference(spark, vintages, ["code_system", "code", "category"], [])
    out = code_table(listed, groups)
    unknown = listed.join(out, ["code_system", "code", "category"], "left_anti").select("vintage", "category").first()
    if unknown:
        raise ValueError(f"{unknown['vintage']}: no group is called {unknown['category']!r}")
    return out


def read_single_labels(spark: SparkSession, vintages: Sequence[Vintage], on_duplicate: str = "error") -> DataFrame:
    """Single-level label lists (category, label), each file a vintage; a category without a label keeps NULL."""
    return read_reference(spark, vintages, ["category"], ["label"], on_duplicate)


def ccs_single_label_at(
    df: DataFrame, labels: DataFrame, vintages: Sequence[Vintage], day: str, col: str = "ccs_dx_prin", on_duplicate: str = "error"
) -> DataFrame:
    """``ccs285_label`` from the list that held on the row's day."""
    return label_at(df, labels, vintages, day, {"category": col}, {"label": "ccs285_label"}, on_duplicate)


def ccc_classify(
    df: DataFrame, slots: Sequence[str], codes: DataFrame, system: str = "icd9_dx", match: str = "exact", mode: str = "first"
) -> DataFrame:
    """``ccc_label_<slot>``: the condition group of each code of one code system."""
    if system not in CODE_SYSTEMS:
        raise ValueError(f"unknown code system {system}")
    own = codes.filter(F.col("code_system") == system).select("code", F.col("category").alias("ccc_label"), "priority")
    return classify(df, slots, own, "ccc_label", match, mode)


def ccc_summary(df: DataFrame, slots: Sequence[str], codes: DataFrame, system: str = "icd9_dx", **how: str) -> DataFrame:
    """Principal label, whether it has one, number of slots with one, any."""
    labelled = ccc_classify(df, slots, codes, system, **how)
    labels = [f"ccc_label_{s}" for s in slots]
    counted = labelled.withColumns(
        {
            "ccc_label": F.col(labels[0]),
            "has_ccc": F.col(labels[0]).isNotNull(),
            "ccc_count": row_count_true(labels, lambda c: c.isNotNull()),
        }
    )
    return counted.withColumns(
        {"has_ccc_any": F.col("ccc_count") >= 1, "has_ccc_any_factor": flag_factor(F.col("ccc_count") >= 1, "has_ccc_any_factor")}
    )


def severity_lookup(raw: DataFrame) -> DataFrame:
    """ICD9_Code, Severity_Score (1–5 or a text) and group names → cleaned lookup; texts become NULL."""
    score = F.col("Severity_Score").cast("string")
    return raw.select(
        F.col("ICD9_Code").cast("string").alias("dx_code"),
        score.alias("sev_score"),
        F.when(in_set(score, SEVERITY_LEVELS), score).cast("int").alias("sev_score_int"),
        F.col("Major_Group_Desc").alias("sev_major_group"),
        F.col("Subgroup_Desc").alias("sev_subgroup"),
    )


def illness_severity(
    df: DataFrame, slots: Sequence[str], lookup: DataFrame, id_col: str | None = None, on_duplicate: str = "error"
) -> DataFrame:
    """Severity of every slot, group names of the principal one, and the maximum over the slots."""
    names = ["sev_score", "sev_major_group", "sev_subgroup"]
    named = lookup_slots(df, slots, lookup, "dx_code", ["sev_score_int"], id_col, on_duplicate=on_duplicate, first_values=names)
    top = row_max([f"sev_score_int_{s}" for s in slots])
    return named.withColumn("sev_all_max_int", top).withColumn(
        "sev_all_max_factor", factor(F.col("sev_all_max_int").cast("string"), "sev_all_max_factor", SEVERITY_LEVELS)
    )


def injury_score(df: DataFrame, slots: Sequence[str]) -> DataFrame:
    """``max_injury_sev`` and ``injury_sev``: the sum of the squares of the three worst body regions, 75 if any
    severity is 6.

    Unknown severities (9) do not enter the score; the maximum is 9 only when nothing else is known. Computed
    inside the row from the ``ais_<slot>`` and ``region_<slot>`` columns: the worst injury, then the worst outside its
    region, then the worst outside both. Any number of regions; a NULL region is a region of its own.
    """
    known = {f"_k_{s}": F.when(F.col(f"ais_{s}").between(1, 8), F.col(f"ais_{s}")) for s in slots}

    def worst(*taken: str) -> Column:
        found = []
        for s in slots:
            fits = F.col(f"_k_{s}").isNotNull()
            for t in taken:
                fits &= ~F.col(f"region_{s}").eqNullSafe(F.col(t)["region"])
            found.append(F.when(fits, F.struct(F.col(f"_k_{s}").alias("ais"), F.col(f"region_{s}").alias("region"))))
        return F.greatest(*found, found[0])

    parts = df.withColumns(known).withColumn("_top1", worst()).withColumn("_top2", worst("_top1"))
    # Without a second region there is no third one.
    parts = parts.withColumn("_top3", F.when(F.col("_top2").isNotNull(), worst("_top1", "_top2")))
    tops = [F.coalesce(F.col(t)["ais"], F.lit(0)) for t in ("_top1", "_top2", "_top3")]
    best = F.col("_top1")["ais"]
    squares = sum((t * t for t in tops[1:]), tops[0] * tops[0])
    unknown = F.when(row_any([f"ais_{s}" for s in slots], lambda c: c == 9), F.lit(9))
    scored = parts.withColumns(
        {
            "max_injury_sev": F.coalesce(best, unknown),
            "injury_sev": F.when(best == 6, F.lit(75)).when(best.isNotNull(), squares),
        }
    )
    return scored.drop("_top1", "_top2", "_top3", *known)


def injury_lists_score(df: DataFrame, slots: Sequence[str]) -> DataFrame:
    """``injury_score`` over the lists ``injuries_<slot>``, for codes that stand for several injuries: all of them enter the
    score. The lists give way to ``ais_<slot>`` and ``region_<slot>``: a row per injury of the first slot's code, the worst known
    one of the others'."""
    none = F.array().cast("array<struct<ais:int,region:string>>")

    def held(s: str) -> Column:
        typed = F.transform(f"injuries_{s}", lambda i: F.struct(i["ais"].cast("int").alias("ais"), i["region"].cast("string").alias("region")))
        return F.coalesce(typed, none)

    def outside(*taken: str) -> Column:
        return F.array_max(F.filter("_known", lambda i: ~reduce(lambda a, b: a | b, [i["region"].eqNullSafe(F.col(t)["region"]) for t in taken])))

    parts = df.withColumn("_held", F.concat(*[held(s) for s in slots]))
    parts = parts.withColumn("_known", F.filter("_held", lambda i: i["ais"].between(1, 8)))
    parts = parts.withColumn("_top1", F.array_max("_known"))
    parts = parts.withColumn("_top2", F.when(F.col("_top1").isNotNull(), outside("_top1")))
    parts = parts.withColumn("_top3", F.when(F.col("_top2").isNotNull(), outside("_top1", "_top2")))
    best = F.col("_top1")["ais"]
    squares = best * best
    for t in ("_top2", "_top3"):
        squares += F.coalesce(F.col(t)["ais"] * F.col(t)["ais"], F.lit(0))
    unknown = F.when(F.exists("_held", lambda i: i["ais"] == 9), F.lit(9))
    scored = parts.withColumns(
        {
            "max_injury_sev": F.coalesce(best, unknown),
            "injury_sev": F.when(best == 6, F.lit(75)).when(best.isNotNull(), squares),
            f"_i_{slots[0]}": F.explode_outer(f"injuries_{slots[0]}"),
        }
    )
    for s in slots[1:]:
        known = F.filter(f"injuries_{s}", lambda i: i["ais"].between(1, 8))
        scored = scored.withColumn(f"_i_{s}", F.coalesce(F.array_max(known), F.array_max(f"injuries_{s}")))
    named = {f"{v}_{s}": F.col(f"_i_{s}")[v] for s in slots for v in ("ais", "region")}
    used = [f"{p}_{s}" for s in slots for p in ("injuries", "_i")]
    return scored.withColumns(named).drop("_held", "_known", "_top1", "_top2", "_top3", *used)


def injury_severity(
    df: DataFrame, slots: Sequence[str], lookup: DataFrame, id_col: str | None = None, on_duplicate: str = "error"
) -> DataFrame:
    """Max severity, score, principal-slot severity and their bands. ``lookup``: dx_code, ais (9 = unknown), region.

    A repeated code is an error. With ``on_duplicate="all"`` it stands for several injuries: all of them enter the maximum and
    the score, and there is a row per injury of the principal code."""
    seen = key_counts(lookup, ["dx_code"]) if on_duplicate == "all" else None
    if seen and seen["most"] > 1:
        lookup, rows = held_part(df, slots, lookup, "dx_code", seen["rows"])
        lists = lookup.groupBy("dx_code").agg(F.collect_list(F.struct("ais", "region")).alias("injuries"))
        # The lists' rows decide on a broadcast, not the number of lists.
        form = "join" if rows <= BROADCAST_ROWS else "long"
        scored = injury_lists_score(lookup_slots(df, slots, lists, "dx_code", ["injuries"], id_col or slots[0], form), slots)
    else:
        scored = injury_score(lookup_slots(df, slots, lookup, "dx_code", ["ais", "region"], id_col), slots)
    scored = scored.withColumn("injury_sev_dx_prin", F.col(f"ais_{slots[0]}"))

    def printed(col: str) -> Column:
        return case_when(
            (F.col(col) == 9, "Unknown"), (F.col(col).isNull(), "Missing/Not Assigned"), otherwise=F.col(col).cast("string")
        )

    return scored.withColumns(
        {
            "injury_sev_cat": band("injury_sev", [1, 10], [None, "Minor", "Moderate to severe"]),
            "max_injury_sev2": printed("max_injury_sev"),
            "max_injury_sev_factor": recode_map(F.col("max_injury_sev"), AIS_LABELS, default=None),
            "max_injury_sev_int": values_to_null("max_injury_sev", 9),
            "injury_sev_dx_prin2": printed("injury_sev_dx_prin"),
            "injury_sev_dx_prin_factor": recode_map(F.col("injury_sev_dx_prin"), AIS_LABELS, default=None),
            "injury_sev_dx_prin_int": values_to_null("injury_sev_dx_prin", 9),
        }
    )
