"""Loads that run more than once: running ids over loads, and the harmonised encounter table over all its columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from cohortry.session import scratch_path
from cohortry.sources import harmonise, loads


@query(
    "surrogate_id_loads",
    """WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS step FROM orders),
k AS (SELECT count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS n1, count(*) FILTER (WHERE o_orderstatus = 'P') AS n2 FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS db_row_n FROM o)
SELECT o_orderkey, o_orderstatus, o_totalprice, db_row_n, db_row_n + CASE step WHEN 1 THEN 0 WHEN 2 THEN n1 ELSE n1 + n2 END AS id FROM r, k""",
)
def surrogate_id_loads(spark, d):
    """Two loads and one that runs again: ids go on from load to load, and the batch loaded twice is there once, with new ids."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "numbered-loads")
    for statuses in (("F", "O"), ("P",), ("O",)):
        part = orders.filter(F.col("o_orderstatus").isin(*statuses))
        loads.load_batches(part, path, ["o_totalprice", "o_orderkey"], ["o_orderstatus"], from_files=True)
    back = "id bigint, o_orderkey bigint, o_totalprice double, db_row_n bigint, o_orderstatus string"
    return spark.read.schema(back).parquet(path)


# The harmonised columns in order, each with its column in the inpatient and the emergency files (- where there is none).
ENCOUNTER_FILES = """
rln rln rln
sex sex sex
birthdate bthdate brthdate
age agyradm agyrserv
end_age agyrdsch agyrserv
age_days agdyadm agdyserv
race_group race_grp race_grp
lang_spoken pls_abbr pls_abr
pat_zip patzip patzip
pat_county patcnty patco
payer pay_cat payer
insurance pay_cat payer
oshpd_id oshpd_id fac_id
fac_zip hplzip faczip
fac_county hplcnty fac_co
ip_fac_type typcare -
start_date admtdate serv_dt
end_date dschdate serv_dt
start_day_of_week admtday serv_d
start_year admtyr serv_y
end_year dsch_yr serv_y
start_quarter qtr_adm serv_q
end_quarter qtr_dsch serv_q
start_month admtmth serv_m
los los 0
los_adj los_adj -
ip_charge charge -
ip_source source -
ip_source_site srcsite -
ip_source_license srclicns -
ip_source_route srcroute -
ip_admission_type admtype -
ip_source_ns source_ns -
ip_source_ns_site srcpo_ns -
ip_source_ns_license srclicns_ns -
ip_source_ns_route srcroute_ns -
ip_admission_ns_type admtype_ns -
ed_disp - dispn
ip_disp disp -
dx_prin diag_p dx_prin
odx1..24 odiag odx
dx_poa_prin poa_p -
ccs_dx_prin ccs_diagp ccs_dx_prin
ccs_odx1..24 ccs_odiag ccs_odx
ec_prin ecode_p ec_prin
ec1..4 ecode ec
ed_pr_prin - pr_prin
ed_opr1..4 - opr
ec_poa_prin epoa_p -
ec_poa1..4 epoa -
ip_pr_prin proc_p -
ip_opr1..5 oproc -
ip_day_pr_prin proc_pdy -
ip_day_opr1..5 procdy -
ip_mdc mdc -
ip_msdrg msdrg -
grouper_v grouper -
ip_sev_code sev_code -
ip_cat_code cat_code -
"""
# Whole-number columns of the files; text everywhere else but for the dates and the grouper version.
WHOLE = """agyradm agyrdsch agdyadm patcnty hplcnty typcare admtyr dsch_yr qtr_adm qtr_dsch admtmth los los_adj charge source srcsite
srclicns srcroute admtype disp proc_pdy procdy1 procdy2 procdy3 procdy4 procdy5 sev_code agyrserv agdyserv patco fac_co serv_y serv_q serv_m dispn""".split()
DATES = {"bthdate": 400, "admtdate": 0, "dschdate": -3, "brthdate": 900, "serv_dt": 0}
OLD_ONLY, NEW_ONLY = "source srcsite srclicns srcroute admtype".split(), "source_ns srcpo_ns srclicns_ns srcroute_ns admtype_ns".split()
SWITCH = 1995


def file_columns() -> list[tuple[str, str, str]]:
    """(harmonised, inpatient, emergency) with the numbered columns written out."""
    out = []
    for line in ENCOUNTER_FILES.split("\n")[1:-1]:
        name, inpatient, emergency = line.split()
        if ".." not in name:
            out.append((name, inpatient, emergency))
            continue
        stem, last = name.split("1..")
        numbers = range(1, int(last) + 1)
        out += [tuple(x if x == "-" else f"{x}{i}" for x in (stem, inpatient, emergency)) for i in numbers]
    return out


COLUMNS = file_columns()
PLACE = {c: i for i, c in enumerate(dict.fromkeys(c for _, *both in COLUMNS for c in both if c not in "-0"))}


def value_sql(column: str) -> str:
    """A raw column's value from an order's row, in SQL that both engines read alike. Dates are dates here."""
    if column in ("admtyr", "serv_y"):
        return "CAST(year(o_orderdate) AS INT)"
    if column == "rln":
        return "CAST(o_orderkey AS STRING)"
    if column in DATES:
        return f"CAST(o_orderdate AS DATE) - {DATES[column]}"
    mixed = f"(o_orderkey * {2 * PLACE[column] + 1} + o_custkey * {PLACE[column]} + {PLACE[column]}) % 997"
    if column == "grouper":
        return f"CAST({mixed} AS DOUBLE) / 2"
    return f"CAST({mixed} AS {'INT' if column in WHOLE else 'STRING'})"


def raw_files(spark, d):
    """Inpatient files of both vintages and the emergency file: one order each, dates as text."""
    orders = table(spark, d, "orders")

    def of(side: int, without: list[str], where: str):
        names = dict.fromkeys(c[side] for c in COLUMNS if c[side] not in ("-", "0", *without))
        exprs = [
            f"date_format({value_sql(c)}, '{'MM/dd/yyyy' if side == 1 else 'M/d/yyyy'}') AS {c}" if c in DATES else f"{value_sql(c)} AS {c}"
            for c in names
        ]
        return orders.filter(where).selectExpr(*exprs)

    old = of(1, NEW_ONLY, f"o_orderstatus <> 'O' AND year(o_orderdate) < {SWITCH}")
    new = of(1, OLD_ONLY, f"o_orderstatus <> 'O' AND year(o_orderdate) >= {SWITCH}")
    return [old, new], of(2, [], "o_orderstatus = 'O'")


def harmonised_sql() -> str:
    sides = []
    for side, database, where in ((1, "pdd", "o_orderstatus <> 'O'"), (2, "edd", "o_orderstatus = 'O'")):
        parts = [f"'{database}' AS database"]
        for c in COLUMNS:
            source = c[side]
            value = {"-": "NULL", "0": "0"}.get(source) or value_sql(source)
            if source in DATES:
                value = f"strftime({value}, '%Y-%m-%d')"
            if source in OLD_ONLY + NEW_ONLY:
                value = f"CASE WHEN (year(o_orderdate) < {SWITCH}) = {source in OLD_ONLY} THEN {value} END"
            parts.append(f"{value} AS {c[0]}")
        sides.append(f"SELECT {', '.join(parts)} FROM orders WHERE {where}")
    return f"""WITH h AS ({sides[0]} UNION ALL BY NAME {sides[1]}), again AS (SELECT *, database = 'edd' AND start_year = 1997 AS twice FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY database, start_year ORDER BY start_date, rln) AS db_row_n,
  row_number() OVER (ORDER BY database, start_year, start_date, rln) AS place FROM again)
SELECT CASE WHEN twice THEN (SELECT count(*) FROM h) + db_row_n ELSE place END AS id, * EXCLUDE (place, twice) FROM r"""


@query("harmonise_load", harmonised_sql())
def harmonise_load(spark, d):
    """All 125 columns of both sources and vintages; one batch is loaded again and is there once."""
    path = scratch_path(spark, "encounter-table")
    inpatient, emergency = raw_files(spark, d)
    order = ["start_date", "rln"]
    harmonise.load_encounters(spark, path, inpatient, [emergency], order)
    out = harmonise.load_encounters(spark, path, [], [emergency.filter("serv_y = 1997")], order)
    return out.withColumns({c: F.col(c).cast("string") for c in ("birthdate", "start_date", "end_date")})
