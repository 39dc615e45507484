"""Collects (name, Spark query, SQL) and the stand-in frames both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.plans.clinical import CCC_GROUPS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, for the comparison of two engines."""
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema]
    )


# Stand-in roles. The expressions are plain SQL that both engines read alike.

ENCOUNTER = {
    "oshpd_id": "lpad(CAST(l_suppkey AS STRING), 6, '0')",
    "database": "CASE WHEN l_linestatus = 'F' THEN 'pdd' ELSE 'edd' END",
    "ed_disp": "CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 5 END "
    "WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 1 WHEN l_returnflag = 'N' THEN 7 END",
    "ip_source_route": "CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_linestatus = 'F' AND l_linenumber % 3 = 0 THEN 2 END",
    "ip_source_site": "CASE WHEN l_linenumber % 4 > 0 THEN l_linenumber END",
    "ip_source_license": "l_linenumber % 3",
    "age": "CAST(floor(l_quantity * 18 / 51) AS INT)",
    "age_days": "CAST(floor(l_extendedprice) AS INT) % 60",
    "sex": "CASE WHEN l_linenumber % 5 = 0 THEN 'U' WHEN l_linenumber % 2 = 0 THEN 'F' ELSE 'M' END",
    "race_group": "CAST(l_partkey % 9 AS STRING)",
    "lang_spoken": "CASE l_partkey % 11 WHEN 0 THEN 'ENG' WHEN 1 THEN 'SPA' WHEN 2 THEN 'CHI' WHEN 3 THEN 'VIE' "
    "WHEN 4 THEN 'ARA' WHEN 5 THEN '999' WHEN 6 THEN '*' WHEN 7 THEN '-' WHEN 8 THEN 'RUS' WHEN 9 THEN 'ENG' END",
    "payer": "CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_partkey % 11 < 10 THEN CAST(l_partkey % 11 AS STRING) END "
    "ELSE CASE l_orderkey % 13 WHEN 0 THEN '12' WHEN 1 THEN '13' WHEN 2 THEN 'BL' WHEN 3 THEN 'MC' WHEN 4 THEN '09' "
    "WHEN 5 THEN '11' WHEN 6 THEN 'AM' WHEN 7 THEN 'MA' WHEN 8 THEN 'MB' WHEN 9 THEN '99' WHEN 10 THEN 'ZZ' "
    "WHEN 11 THEN 'MC' END END",
    "rln": "CASE WHEN l_partkey % 7 = 0 THEN '---------' ELSE CAST(l_orderkey AS STRING) END",
    "start_date": "CAST(l_shipdate AS DATE)",
    "start_month": "CAST(month(l_shipdate) AS INT)",
    "birthdate": "CAST(l_shipdate AS DATE) - CAST(CAST(floor(l_quantity * 18 / 51) AS INT) * 365 + l_partkey % 365 AS INT)",
    "charge": "l_extendedprice",
    "discount": "l_discount",
    "quantity": "l_quantity",
    "line": "l_linenumber",
    "part": "l_partkey",
    "orderkey": "l_orderkey",
    "small_rural": "l_suppkey % 3 = 0",
}

OUTCOME = (
    "CASE WHEN ed_disp IN (2, 5) THEN 'transferred' WHEN ip_source_route = 1 THEN 'admitted' "
    "WHEN ed_disp = 1 THEN 'dc home' END"
)

SLOTS = ["dx_prin", *[f"odx{i}" for i in range(1, 7)]]


def slot_sql(k: int) -> str:
    code = f"lpad(CAST((o_orderkey * {2 * k + 1} + o_custkey * {k + 1}) % 2300 AS STRING), 5, '0')"
    return code if k == 0 else f"CASE WHEN (o_orderkey + {k}) % 4 > 0 THEN {code} END"


VISIT = {
    "id": "o_orderkey",
    "start_date": "CAST(o_orderdate AS DATE)",
    "status": "o_orderstatus",
    **{s: slot_sql(k) for k, s in enumerate(SLOTS)},
}

CODES = {
    "dx_code": "lpad(CAST(p_partkey AS STRING), 5, '0')",
    "quoted": "chr(39) || lpad(CAST(p_partkey AS STRING), 5, '0') || ' ' || chr(39)",
    "group_text": "chr(39) || CAST(p_size % 20 AS STRING) || chr(39)",
    "label_text": "CASE p_type WHEN 'PROMO' THEN 'Injury and poisoning' WHEN 'SMALL' THEN 'Mental illness' ELSE p_type END",
    "severity_text": "CASE WHEN p_size % 7 = 0 THEN 'Not Categorized' WHEN p_size % 7 = 6 THEN 'No code entered' "
    "ELSE CAST(p_size % 7 AS STRING) END",
    "major": "p_type",
    "sub": "p_brand",
    "ais": "CASE WHEN p_size % 8 = 7 THEN 9 ELSE p_size % 8 END",
    "region": "p_type",
}

# Code → condition-group rows: a code can be in up to three groups of one code system.
CONDITION_GROUPS = dict(enumerate(CCC_GROUPS, start=1))


def select_sql(source: str, exprs: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in exprs.items()) + f" FROM {source}"


ENC = f"enc0 AS ({select_sql('lineitem', ENCOUNTER)}), enc AS (SELECT *, {OUTCOME} AS outcome FROM enc0)"
VIS = f"vis AS ({select_sql('orders', VISIT)})"
COD = f"cod AS ({select_sql('part', CODES)})"
SYSTEM_SQL = "CASE p_partkey % 4 WHEN 0 THEN 'icd9_dx' WHEN 1 THEN 'icd9_proc' WHEN 2 THEN 'icd10_dx' ELSE 'icd10_proc' END"
NUMBER_SQL = {
    "a": ("p_size % 2 = 0", "1 + p_size % 10"),
    "b": ("p_size % 3 = 0", "11"),
    "c": ("p_size % 5 = 0", "12"),
}
NAME_SQL = "CASE g " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in CONDITION_GROUPS.items()) + " END"
CCC = (
    "ccc0 AS ("
    + " UNION ALL ".join(
        f"SELECT {SYSTEM_SQL} AS code_system, {CODES['dx_code']} AS code, CAST({g} AS INT) AS g FROM part WHERE {w}"
        for w, g in NUMBER_SQL.values()
    )
    + f"), ccc AS (SELECT code_system, code, g AS priority, {NAME_SQL} AS category FROM ccc0)"
)


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in ENCOUNTER.items()])


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in VISIT.items()])


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*[f"{e} AS {c}" for c, e in CODES.items()])


def condition_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code_system, code, category) rows; the priorities come from the operator's own group order."""
    part = table(spark, sf_dir, "part")
    frames = [
        part.filter(w).selectExpr(f"{SYSTEM_SQL} AS code_system", f"{CODES['dx_code']} AS code", f"CAST({g} AS INT) AS g")
        for w, g in NUMBER_SQL.values()
    ]
    both = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return both.selectExpr("code_system", "code", f"{NAME_SQL} AS category")
