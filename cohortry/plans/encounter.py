"""Per-encounter recodes: outcome, age bands, demographics, payer, calendar. All row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.dates import SEASONS, age_years_exact, is_weekend, season
from cohortry.functions.levels import factor
from cohortry.functions.recode import case_when, conditional_assign, in_set, recode_map, values_to_null
from cohortry.functions.text import concat_text, hospital_key
from cohortry.session import compiled

# Codes of the encounter extracts and the groups they stand for.
MISSING_RLN = "---------"
TRANSFER_DISPOSITIONS = [2, 5]
HOME_DISPOSITION = 1
OWN_ED_ROUTE = 1
LANGUAGES = {
    "ENG": "English",
    "SPA": "Spanish",
    "CHI": "Chinese",
    "VIE": "Vietnamese",
    "ARA": "Arabic",
    "999": "Unknown/I/B",
    "*": "Unknown/I/B",
    "-": "Unknown/I/B",
}
LANGUAGE_LEVELS = ["English", "Spanish", "Arabic", "Chinese", "Vietnamese", "Other", "Unknown/I/B"]
RACES = {
    "1": "White",
    "2": "Black",
    "3": "Hispanic",
    "4": "A/PI",
    "5": "AI/AN",
    "6": "Other",
    "0": "Unknown",
}
RACE_LEVELS = ["Hispanic", "White", "Black", "A/PI", "Other", "Unknown", "AI/AN"]
PAYER_LEVELS = ["Medicaid", "Private", "Uninsured/self-pay", "Medicare", "Other", "Unknown"]
PAYERS = {
    "pdd": {
        "Private": ["3"],
        "Medicaid": ["2"],
        "Uninsured/self-pay": ["8"],
        "Other": ["4", "5", "6", "7", "9"],
        "Medicare": ["1"],
    },
    "edd": {
        "Private": ["12", "13", "14", "16", "BL", "CI", "HM"],
        "Medicaid": ["MC"],
        "Uninsured/self-pay": ["09"],
        "Other": ["11", "AM", "CH", "DS", "OF", "TV", "VA", "WC", "00"],
        "Medicare": ["MA", "MB"],
        "Unknown": ["99"],
    },
}
AGE_LEVELS = {
    "age_cats": ["0-27d", "28d-12m", "13-23m", "2-5y", "6-11y", "12-17y", "18-21y"],
    "age_cats2": ["0-27d", "28d-12m", "1y-11y", "12y-17y"],
    "age_cats3": ["0-27d", "28d-12m", "1y-17y"],
    "age_cats4": ["0-27d", "28d-12m", "13m-24m", "2y-5y", "6y-11y", "12y-17y"],
    "age_cats4_1": ["Neonate", "Infant", "Toddler", "Early Childhood", "Middle Childhood", "Early Adolescence"],
}


def outcome() -> Column:
    """transferred > admitted > dc home; anything else is unknown."""
    return case_when(
        (F.col("ed_disp").isin(TRANSFER_DISPOSITIONS), "transferred"),
        (F.col("ip_source_route") == OWN_ED_ROUTE, "admitted"),
        (F.col("ed_disp") == HOME_DISPOSITION, "dc home"),
    )


def outcome_classify(df: DataFrame) -> DataFrame:
    """Outcome and the transferred flag, which is NULL where the outcome is."""
    return df.withColumn("outcome", outcome()).withColumn("transferred", F.col("outcome") == "transferred")


def payer_group(database: Column | str = "database", payer: Column | str = "payer") -> Column:
    """Insurance group from the two payer code systems."""
    db = F.col(database) if isinstance(database, str) else database
    code = F.col(payer) if isinstance(payer, str) else payer
    return case_when(
        *[
            ((db == source) & code.isin(codes), group)
            for source, groups in PAYERS.items()
            for group, codes in groups.items()
        ]
    )


def age_bands(scheme: str) -> Column:
    """Age category of one scheme: days decide below one year, then years (exact years for ``age_cats4``)."""
    days, labels = F.col("age_days"), AGE_LEVELS[scheme]
    infant_age = F.col("age_exact") if scheme.startswith("age_cats4") else F.col("age")
    years = F.col("age_exact") if scheme == "age_cats4" else F.col("age")
    edges = {
        "age_cats": [1, 2, 6, 12, 18, 21],
        "age_cats2": [1, 12, 18],
        "age_cats3": [1, 18],
        "age_cats4": [1, 2, 6, 12, 18],
        "age_cats4_1": [1, 2, 6, 12, 18],
    }[scheme]
    branches = [(days < 28, labels[0]), ((days >= 28) & (infant_age < 1), labels[1])]
    branches += [((years >= lo) & (years < hi), label) for lo, hi, label in zip(edges, edges[1:], labels[2:])]
    return case_when(*branches)


def collapse_race(col: str, keep_asian: bool) -> Column:
    named = {"White": "White", "Black": "Black", "Hispanic": "Hispanic/Latino"}
    if keep_asian:
        named["A/PI"] = "Asian/Pacific Islander"
    return recode_map(col, named, default="Other/Unknown")


def encounter_recode(df: DataFrame) -> DataFrame:
    """The whole recode block in three projections."""
    cleaned = compiled(df).withColumns(
        {
            "oshpd_id": hospital_key("oshpd_id"),
            "rln": values_to_null("rln", MISSING_RLN),
            "age_days": conditional_assign("age_days", F.col("age") >= 1, None),
            "age_exact": age_years_exact("birthdate", "start_date"),
            "ip_course": concat_text("ip_source_site", "ip_source_license", "ip_source_route", null_as="NA"),
            "ed_disp2": case_when(
                (F.col("ip_source_route") == OWN_ED_ROUTE, "admitted"), otherwise=F.col("ed_disp").cast("string")
            ),
            "outcome": outcome(),
            "lang_spoken2": factor(recode_map("lang_spoken", LANGUAGES, default="Other"), "lang_spoken2", LANGUAGE_LEVELS),
            "lang_spoken3": recode_map("lang_spoken", {"ENG": "English", "SPA": "Spanish"}, default="Other/Unknown"),
            "race_group2": recode_map("race_group", RACES, default=None),
            "sex2": recode_map("sex", {"F": "Female", "M": "Male"}, default=None),
            "insurance2": payer_group(),
            "start_weekend": is_weekend("start_date"),
            "enc_season": season("start_month"),
        }
    )
    layered = cleaned.withColumns(
        {
            "has_rln": F.col("rln").isNotNull(),
            "neonate": F.coalesce(F.col("age_days") < 28, F.lit(False)),
            "transferred": F.col("outcome") == "transferred",
            "admitted": F.col("outcome") == "admitted",
            "race_group2_5": collapse_race("race_group2", keep_asian=True),
            "race_group3": collapse_race("race_group2", keep_asian=False),
            "insurance2_5": recode_map(
                "insurance2",
                {
                    "Private": "Private",
                    "Medicaid": "Public",
                    "Medicare": "Public",
                    "Uninsured/self-pay": "Uninsured/self-pay",
                },
                default="Other",
            ),
            "insurance3": recode_map("insurance2", {"Medicare": "Other", "Unknown": None}),
            "has_medicare": F.col("insurance2") == "Medicare",
            "transferred_char": F.upper((F.col("outcome") == "transferred").cast("string")),
            "start_month_factor": F.when(F.col("start_month").between(1, 12), F.col("start_month").cast("string")),
            **{scheme: age_bands(scheme) for scheme in AGE_LEVELS},
        }
    )
    return with_levels(layered)


def with_levels(df: DataFrame) -> DataFrame:
    """Attach the level order of the recoded categories."""
    levels = {
        **AGE_LEVELS,
        "race_group2": RACE_LEVELS,
        "race_group2_5": ["White", "Hispanic/Latino", "Black", "Asian/Pacific Islander", "Other/Unknown"],
        "race_group3": ["White", "Hispanic/Latino", "Black", "Other/Unknown"],
        "lang_spoken2": LANGUAGE_LEVELS,
        "lang_spoken3": ["English", "Spanish", "Other/Unknown"],
        "outcome": ["dc home", "admitted", "transferred"],
        "transferred_char": ["FALSE", "TRUE"],
        "start_month_factor": [str(m) for m in range(1, 13)],
        "sex2": ["Male", "Female"],
        "enc_season": SEASONS,
        "insurance2": PAYER_LEVELS,
        "insurance2_5": ["Private", "Public", "Uninsured/self-pay", "Other"],
        "insurance3": ["Medicaid", "Private", "Uninsured/self-pay", "Other"],
    }
    return df.select(
        *[F.col(c).alias(c, metadata={"levels": levels[c]}) if c in levels else F.col(c) for c in df.columns]
    )


def is_transfer_disposition(col: str = "ed_disp") -> Column:
    return in_set(col, TRANSFER_DISPOSITIONS)
