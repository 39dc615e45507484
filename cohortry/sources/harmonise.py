"""From two yearly sources with differing columns to the one encounter table of 125 columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions.dates import parse_date
from cohortry.sources.loads import highest_id, replace_partitions
from cohortry.sources.numbering import number_wide_rows


def numbered(stem: str, upto: int) -> list[str]:
    return [f"{stem}{i}" for i in range(1, upto + 1)]


DX = ["dx_prin", *numbered("odx", 24)]
CCS = [f"ccs_{c}" for c in DX]
INPATIENT_PROC = ["ip_pr_prin", *numbered("ip_opr", 5)]
INPATIENT_PROC_DAY = ["ip_day_pr_prin", *numbered("ip_day_opr", 5)]
EMERGENCY_PROC = ["ed_pr_prin", *numbered("ed_opr", 4)]
EXTERNAL = ["ec_prin", *numbered("ec", 4)]
EXTERNAL_POA = ["ec_poa_prin", *numbered("ec_poa", 4)]


def _typed(kind: str, names: Sequence[str] | str) -> list[tuple[str, str]]:
    return [(n, kind) for n in (names.split() if isinstance(names, str) else names)]


# Names, types and order of the harmonised encounter columns.
HARMONISED: list[tuple[str, str]] = [
    *_typed("bigint", "id db_row_n"),
    *_typed("string", "database rln sex"),
    *_typed("date", "birthdate"),
    *_typed("int", "age end_age age_days"),
    *_typed("string", "race_group lang_spoken pat_zip"),
    *_typed("int", "pat_county"),
    *_typed("string", "payer insurance oshpd_id fac_zip"),
    *_typed("int", "fac_county ip_fac_type"),
    *_typed("date", "start_date end_date"),
    *_typed("string", "start_day_of_week"),
    *_typed("int", "start_year end_year start_quarter end_quarter start_month los los_adj ip_charge"),
    *_typed("int", "ip_source ip_source_site ip_source_license ip_source_route ip_admission_type"),
    *_typed("string", "ip_source_ns ip_source_ns_site ip_source_ns_license ip_source_ns_route ip_admission_ns_type"),
    *_typed("int", "ed_disp ip_disp"),
    *_typed("string", [*DX, "dx_poa_prin", *CCS, *EXTERNAL, *EMERGENCY_PROC, *EXTERNAL_POA, *INPATIENT_PROC]),
    *_typed("int", INPATIENT_PROC_DAY),
    *_typed("string", "ip_mdc ip_msdrg"),
    *_typed("double", "grouper_v"),
    *_typed("int", "ip_sev_code"),
    *_typed("string", "ip_cat_code"),
]


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


# Harmonised column ← column of the inpatient source. A column not listed is NULL there.
INPATIENT_COLUMNS: dict[str, str] = {
    **_same("rln", "sex", "oshpd_id", "los", "los_adj"),
    "birthdate": "bthdate",
    "age": "agyradm",
    "end_age": "agyrdsch",
    "age_days": "agdyadm",
    "race_group": "race_grp",
    "lang_spoken": "pls_abbr",
    "pat_zip": "patzip",
    "pat_county": "patcnty",
    "payer": "pay_cat",
    "insurance": "pay_cat",
    "fac_zip": "hplzip",
    "fac_county": "hplcnty",
    "ip_fac_type": "typcare",
    "start_date": "admtdate",
    "end_date": "dschdate",
    "start_day_of_week": "admtday",
    "start_year": "admtyr",
    "end_year": "dsch_yr",
    "start_quarter": "qtr_adm",
    "end_quarter": "qtr_dsch",
    "start_month": "admtmth",
    "ip_charge": "charge",
    "ip_source": "source",
    "ip_source_site": "srcsite",
    "ip_source_license": "srclicns",
    "ip_source_route": "srcroute",
    "ip_admission_type": "admtype",
    "ip_source_ns": "source_ns",
    "ip_source_ns_site": "srcpo_ns",
    "ip_source_ns_license": "srclicns_ns",
    "ip_source_ns_route": "srcroute_ns",
    "ip_admission_ns_type": "admtype_ns",
    "ip_disp": "disp",
    **dict(zip(DX, ["diag_p", *numbered("odiag", 24)])),
    "dx_poa_prin": "poa_p",
    **dict(zip(CCS, ["ccs_diagp", *numbered("ccs_odiag", 24)])),
    **dict(zip(EXTERNAL, ["ecode_p", *numbered("ecode", 4)])),
    **dict(zip(EXTERNAL_POA, ["epoa_p", *numbered("epoa", 4)])),
    **dict(zip(INPATIENT_PROC, ["proc_p", *numbered("oproc", 5)])),
    **dict(zip(INPATIENT_PROC_DAY, ["proc_pdy", *numbered("procdy", 5)])),
    "ip_mdc": "mdc",
    "ip_msdrg": "msdrg",
    "grouper_v": "grouper",
    "ip_sev_code": "sev_code",
    "ip_cat_code": "cat_code",
}

# Harmonised column ← column of the emergency source. A column not listed is NULL there.
EMERGENCY_COLUMNS: dict[str, str] = {
    **_same("rln", "sex", "payer", *DX, *CCS, *EXTERNAL),
    "birthdate": "brthdate",
    "age": "agyrserv",
    "end_age": "agyrserv",
    "age_days": "agdyserv",
    "race_group": "race_grp",
    "lang_spoken": "pls_abr",
    "pat_zip": "patzip",
    "pat_county": "patco",
    "insurance": "payer",
    "oshpd_id": "fac_id",
    "fac_zip": "faczip",
    "fac_county": "fac_co",
    "start_date": "serv_dt",
    "end_date": "serv_dt",
    "start_day_of_week": "serv_d",
    "start_year": "serv_y",
    "end_year": "serv_y",
    "start_quarter": "serv_q",
    "end_quarter": "serv_q",
    "start_month": "serv_m",
    "ed_disp": "dispn",
    **dict(zip(EMERGENCY_PROC, ["pr_prin", *numbered("opr", 4)])),
}

# Columns that only some inpatient vintages have.
ADMISSION_SOURCE_OLD = {c: "int" for c in ("source", "srcsite", "srclicns", "srcroute", "admtype")}
ADMISSION_SOURCE_NEW = {c: "string" for c in ("source_ns", "srcpo_ns", "srclicns_ns", "srcroute_ns", "admtype_ns")}


def align_vintages(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns a vintage lacks as typed NULLs; present ones stay."""
    lacking = {c: t for c, t in columns.items() if c not in df.columns}
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in lacking.items()])


def harmonise(
    df: DataFrame,
    columns: Mapping[str, str],
    schema: Sequence[tuple[str, str]],
    constants: Mapping[str, object],
) -> DataFrame:
    """Project one source to the common schema: renamed, constant, or typed NULL; text dates are parsed."""

    def target(name: str, kind: str) -> Column:
        if name in constants:
            return F.lit(constants[name]).cast(kind).alias(name)
        source = columns.get(name)
        if source is None:
            return F.lit(None).cast(kind).alias(name)
        if kind == "date" and df.schema[source].dataType.simpleString() == "string":
            return parse_date(source).alias(name)
        return F.col(source).cast(kind).alias(name)

    return df.select(*[target(n, k) for n, k in schema])


def harmonise_inpatient(df: DataFrame) -> DataFrame:
    full = align_vintages(df, {**ADMISSION_SOURCE_OLD, **ADMISSION_SOURCE_NEW})
    return harmonise(full, INPATIENT_COLUMNS, HARMONISED, {"database": "pdd"})


def harmonise_emergency(df: DataFrame) -> DataFrame:
    return harmonise(df, EMERGENCY_COLUMNS, HARMONISED, {"database": "edd", "los": 0})


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def combine(
    inpatient: Sequence[DataFrame], emergency: Sequence[DataFrame], order: Sequence[str] = ("start_date",), after: int = 0
) -> DataFrame:
    """All years of both sources in one plan, numbered per (source, year) by date, with a running id behind ``after``.

    The frames are the yearly files as read (column and row selections included)."""
    parts = [*map(harmonise_inpatient, inpatient), *map(harmonise_emergency, emergency)]
    rows = union_all(parts).drop("id", "db_row_n")
    done = number_wide_rows(rows, order, ["database", "start_year"], after=after)
    return done.select(*[F.col(n).cast(k).alias(n) for n, k in HARMONISED])


def append_combined(df: DataFrame, path: str) -> None:
    """Put combined rows into the encounter table, which is partitioned so that a study year prunes to its own files.
    The (source, year) batches of the frame replace those of the table, so a load that runs again adds no row."""
    replace_partitions(df, path, ["database", "start_year"])


def load_encounters(
    spark: SparkSession,
    path: str,
    inpatient: Sequence[DataFrame] = (),
    emergency: Sequence[DataFrame] = (),
    order: Sequence[str] = ("start_date",),
) -> DataFrame:
    """Combine yearly files into the encounter table at ``path``, with ids that go on from its highest; the table as it is then."""
    append_combined(combine(inpatient, emergency, order, highest_id(spark, path)), path)
    return read_encounters(spark, path)


def read_encounters(spark: SparkSession, path: str) -> DataFrame:
    """The encounter table with its columns in order; types are given, not inferred from folder names."""
    return spark.read.schema(", ".join(f"`{n}` {k}" for n, k in HARMONISED)).parquet(path).select(*[n for n, _ in HARMONISED])


def code_system(start_date: Column | str, switch: str = "2015-10-01") -> Column:
    """Which diagnosis code system a date falls under: part of the lookup key instead of a split and a union."""
    d = F.col(start_date) if isinstance(start_date, str) else start_date
    return F.when(d < F.lit(switch).cast("date"), "icd9_dx").when(d.isNotNull(), "icd10_dx")
