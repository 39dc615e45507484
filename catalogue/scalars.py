"""Recodes, text, dates and row-wise reductions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from catalogue.registry import ENC, SLOTS, VIS, encounters, query, rounded, table, visits
from cohortry.functions import dates, levels, numeric, recode, rowwise, text
from cohortry.models.design import Factor, Number, design_matrix
from cohortry.operators import joins, projection
from cohortry.plans import encounter, hospital
from cohortry.plans.analysis import analysis_extract

LINE_KEY = ["orderkey", "line", "part", "charge"]


@query(
    "outcome_classify",
    f"WITH {ENC} SELECT orderkey, line, part, charge, outcome, outcome = 'transferred' AS transferred FROM enc",
)
def outcome_classify(spark, d):
    return encounter.outcome_classify(encounters(spark, d)).select(*LINE_KEY, "outcome", "transferred")


@query(
    "case_when",
    f"""WITH {ENC} SELECT orderkey, line, part, charge,
  CASE WHEN ip_source_route = 1 THEN 'admitted' ELSE CAST(ed_disp AS VARCHAR) END AS ed_disp2 FROM enc""",
)
def case_when(spark, d):
    disp = recode.case_when((F.col("ip_source_route") == 1, "admitted"), otherwise=F.col("ed_disp").cast("string"))
    return encounters(spark, d).select(*LINE_KEY, disp.alias("ed_disp2"))


@query(
    "conditional_assign",
    f"WITH {ENC} SELECT orderkey, line, part, charge, CASE WHEN age >= 1 THEN NULL ELSE age_days END AS age_days FROM enc",
)
def conditional_assign(spark, d):
    days = recode.conditional_assign("age_days", F.col("age") >= 1, None)
    return encounters(spark, d).select(*LINE_KEY, days.alias("age_days"))


@query(
    "recode_map",
    f"""WITH {ENC} SELECT orderkey, line, part, charge,
  CASE WHEN lang_spoken = 'ENG' THEN 'English' WHEN lang_spoken = 'SPA' THEN 'Spanish'
       WHEN lang_spoken IS NOT NULL THEN 'Other/Unknown' END AS lang_default,
  CASE lang_spoken WHEN 'ENG' THEN 'English' WHEN 'SPA' THEN 'Spanish' ELSE lang_spoken END AS lang_kept,
  CASE WHEN lang_spoken IS NULL THEN 'none' WHEN lang_spoken = 'ENG' THEN 'English' END AS lang_missing
FROM enc""",
)
def recode_map(spark, d):
    pairs = {"ENG": "English", "SPA": "Spanish"}
    return encounters(spark, d).select(
        *LINE_KEY,
        recode.recode_map("lang_spoken", pairs, default="Other/Unknown").alias("lang_default"),
        recode.recode_map("lang_spoken", pairs).alias("lang_kept"),
        recode.recode_map("lang_spoken", {"ENG": "English"}, default=None, missing="none").alias("lang_missing"),
    )


PRIORITY = {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"}
PRIORITY_SQL = """SELECT o_orderkey, coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
  WHEN '5-LOW' THEN 'low' END, o_orderpriority) AS o_orderpriority FROM orders"""


@query("recode_update", PRIORITY_SQL)
def recode_update(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return joins.recode_update(orders, "o_orderpriority", recode.pairs_to_lookup(spark, PRIORITY))


@query(
    "pairs_to_lookup",
    """SELECT v."from", v."to", count(o_orderkey) AS n FROM (VALUES ('1-URGENT', 'urgent'), ('2-HIGH', 'high'), ('5-LOW', 'low'))
  v("from", "to") LEFT JOIN orders ON o_orderpriority = v."from" GROUP BY ALL""",
)
def pairs_to_lookup(spark, d):
    pairs = recode.pairs_to_lookup(spark, PRIORITY)
    seen = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("from")).agg(F.count(F.lit(1)).alias("n"))
    return joins.lookup_join(pairs, seen, "from")


@query(
    "update_join",
    """SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN s_nationkey ELSE c_nationkey END AS c_nationkey,
  CASE WHEN s_suppkey IS NOT NULL THEN s_acctbal ELSE c_acctbal END AS c_acctbal
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
)
def update_join(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    other = table(spark, d, "supplier").withColumnRenamed("s_suppkey", "c_custkey")
    return joins.update_join(customers, other, "c_custkey", {"c_nationkey": "s_nationkey", "c_acctbal": "s_acctbal"})


@query(
    "band_numeric",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
  CASE WHEN l_quantity < 10 THEN 'q1' WHEN l_quantity < 25 THEN 'q2' WHEN l_quantity < 40 THEN 'q3' ELSE 'q4' END AS quartile,
  CASE WHEN l_quantity < 5 THEN NULL WHEN l_quantity < 20 THEN 'Minor' ELSE 'Moderate to severe' END AS severity
FROM lineitem""",
)
def band_numeric(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        recode.band("l_quantity", [10, 25, 40], ["q1", "q2", "q3", "q4"]).alias("quartile"),
        recode.band("l_quantity", [5, 20], [None, "Minor", "Moderate to severe"]).alias("severity"),
    )


@query(
    "numeric_threshold",
    "SELECT s_suppkey, s_acctbal > 5000 AS over_5000, nullif(s_nationkey, 3) > 0 AS has_nation FROM supplier",
)
def numeric_threshold(spark, d):
    return table(spark, d, "supplier").select(
        "s_suppkey",
        recode.above("s_acctbal", 5000).alias("over_5000"),
        recode.above(recode.values_to_null("s_nationkey", 3), 0).alias("has_nation"),
    )


@query(
    "nearest_resource_band",
    """WITH h AS (SELECT s_suppkey, s_nationkey % 3 = 0 AS resourced,
  CASE WHEN s_suppkey % 10 > 0 THEN abs(s_acctbal) / 100 END AS km FROM supplier),
b AS (SELECT *, CASE WHEN NOT resourced AND km < 50 THEN '0-50km' WHEN NOT resourced AND km >= 50 THEN '51km +' END AS near_cats FROM h)
SELECT s_suppkey, near_cats, coalesce(near_cats, 'Resourced') AS near_incl_resourced FROM b""",
)
def nearest_resource_band(spark, d):
    h = table(spark, d, "supplier").selectExpr(
        "s_suppkey", "s_nationkey % 3 = 0 AS resourced", "CASE WHEN s_suppkey % 10 > 0 THEN abs(s_acctbal) / 100 END AS km"
    )
    return h.withColumns(hospital.nearest_resource("near", "resourced", "km")).drop("resourced", "km")


MARKETS = ["MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE"]


@query(
    "factor_levels",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE', 'FURNITURE') THEN c_mktsegment END AS segment,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'AUTOMOBILE' THEN 3 WHEN 'FURNITURE' THEN 4 END AS code,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'goods' WHEN 'BUILDING' THEN 'goods' WHEN 'HOUSEHOLD' THEN 'home' END AS label
FROM customer""",
)
def factor_levels(spark, d):
    named = table(spark, d, "customer").select(
        "c_custkey",
        levels.factor("c_mktsegment", "segment", MARKETS),
        levels.factor("c_mktsegment", "label", ["MACHINERY", "BUILDING", "HOUSEHOLD"], ["goods", "goods", "home"]),
    )
    return named.withColumn("code", levels.level_code("segment", levels.levels_of(named, "segment")))


@query(
    "values_to_null",
    f"""WITH {ENC} SELECT orderkey, line, part, charge, nullif(rln, '---------') AS rln,
  CASE WHEN race_group NOT IN ('0', '8') THEN race_group END AS race_group FROM enc""",
)
def values_to_null(spark, d):
    return encounters(spark, d).select(
        *LINE_KEY,
        recode.values_to_null("rln", "---------").alias("rln"),
        recode.values_to_null("race_group", "0", "8").alias("race_group"),
    )


@query(
    "fill_nulls",
    f"WITH {ENC} SELECT orderkey, line, part, charge, coalesce(payer, 'none') AS payer, coalesce(ip_source_route, 0) AS route FROM enc",
)
def fill_nulls(spark, d):
    return encounters(spark, d).select(
        *LINE_KEY, recode.fill_null("payer", "none").alias("payer"), recode.fill_null("ip_source_route", 0).alias("route")
    )


PAYER_PAIRS = ", ".join(
    f"('{db}', '{code}', '{group}')"
    for db, groups in encounter.PAYERS.items()
    for group, codes in groups.items()
    for code in codes
)


@query(
    "payer_group",
    f"""WITH {ENC} SELECT database, payer, grp AS insurance2, count(*) AS n
FROM enc LEFT JOIN (VALUES {PAYER_PAIRS}) v(db, code, grp) ON database = db AND payer = code GROUP BY ALL""",
)
def payer_group(spark, d):
    grouped = encounters(spark, d).select("database", "payer", encounter.payer_group().alias("insurance2"))
    return grouped.groupBy("database", "payer", "insurance2").agg(F.count(F.lit(1)).alias("n"))


@query(
    "calendar_features",
    """SELECT o_orderkey, CAST(month(o_orderdate) AS INT) AS mon,
  CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
       WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  dayofweek(o_orderdate) IN (0, 6) AS weekend FROM orders""",
)
def calendar_features(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.month("o_orderdate").alias("mon"),
        dates.season(F.month("o_orderdate")).alias("season"),
        dates.is_weekend("o_orderdate").alias("weekend"),
    )


@query(
    "parse_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders""",
)
def parse_date(spark, d):
    as_text = table(spark, d, "orders").select(
        "o_orderkey",
        F.expr(
            "CASE WHEN o_orderkey % 10 = 0 THEN '13/45/2011' WHEN o_orderkey % 2 = 0 THEN date_format(o_orderdate, 'M/d/yyyy') "
            "ELSE date_format(o_orderdate, 'MM/dd/yyyy') END AS given"
        ),
    )
    return as_text.select("o_orderkey", F.date_format(dates.parse_date("given"), "yyyy-MM-dd").alias("parsed"))


@query(
    "age_years_exact",
    f"""WITH {ENC}, a AS (SELECT orderkey, line, part, charge, birthdate AS b, start_date AS s,
  year(start_date) - year(birthdate) AS y0 FROM enc),
y AS (SELECT *, CAST(y0 - CASE WHEN CAST(b + to_years(CAST(y0 AS INT)) AS DATE) > s THEN 1 ELSE 0 END AS INT) AS y FROM a)
SELECT orderkey, line, part, charge, y + datediff('day', CAST(b + to_years(y) AS DATE), s)
  / CAST(datediff('day', CAST(b + to_years(y) AS DATE), CAST(b + to_years(y + 1) AS DATE)) AS DOUBLE) AS age_exact FROM y""",
)
def age_years_exact(spark, d):
    return encounters(spark, d).select(*LINE_KEY, dates.age_years_exact("birthdate", "start_date").alias("age_exact"))


@query("strip_chars", "SELECT p_partkey, trim(replace('''' || p_name || ' ''', '''', '')) AS clean FROM part")
def strip_chars(spark, d):
    quoted = table(spark, d, "part").selectExpr("p_partkey", "chr(39) || p_name || ' ' || chr(39) AS given")
    return quoted.select("p_partkey", text.strip_chars("given").alias("clean"))


@query(
    "replace_text",
    """SELECT p_partkey, replace(p_brand, 'Brand#', '') AS num, regexp_replace(p_name, 'r', 'R') AS first_r,
  CASE WHEN contains(p_name, 'red') THEN NULL ELSE regexp_replace(p_name, 'blue', 'BLUE', 'g') END AS ordered FROM part""",
)
def replace_text(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        text.replace_text("p_brand", "Brand#", "").alias("num"),
        text.replace_text("p_name", "r", "R", first_only=True).alias("first_r"),
        text.replace_in_order("p_name", [("blue", "BLUE"), ("red", None)]).alias("ordered"),
    )


@query(
    "substring_from",
    "SELECT s_suppkey, TRY_CAST(substr('106' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0'), 4) AS INT) AS stripped FROM supplier",
)
def substring_from(spark, d):
    ids = table(spark, d, "supplier").selectExpr("s_suppkey", "'106' || lpad(CAST(s_suppkey AS STRING), 6, '0') AS given")
    return ids.select("s_suppkey", text.safe_cast(text.substring_from("given", 4), "int").alias("stripped"))


@query(
    "pad_left",
    """SELECT p_partkey, CASE WHEN length(CAST(p_partkey AS VARCHAR)) >= 3 THEN CAST(p_partkey AS VARCHAR)
  ELSE lpad(CAST(p_partkey AS VARCHAR), 3, '0') END AS padded FROM part""",
)
def pad_left(spark, d):
    return table(spark, d, "part").select("p_partkey", text.pad_left("p_partkey", 3).alias("padded"))


@query(
    "concat_text",
    f"""WITH {ENC} SELECT orderkey, line, part, charge,
  coalesce(CAST(ip_source_site AS VARCHAR), 'NA') || coalesce(CAST(ip_source_license AS VARCHAR), 'NA')
    || coalesce(CAST(ip_source_route AS VARCHAR), 'NA') AS ip_course,
  CAST(ip_source_site AS VARCHAR) || '-' || CAST(ip_source_route AS VARCHAR) AS strict FROM enc""",
)
def concat_text(spark, d):
    return encounters(spark, d).select(
        *LINE_KEY,
        text.concat_text("ip_source_site", "ip_source_license", "ip_source_route", null_as="NA").alias("ip_course"),
        text.concat_text("ip_source_site", F.lit("-"), "ip_source_route").alias("strict"),
    )


@query(
    "safe_cast",
    """SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INT) AS num, TRY_CAST(o_orderpriority AS INT) AS whole,
  TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS price FROM orders""",
)
def safe_cast(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        text.safe_cast(F.split("o_orderpriority", "-")[0], "int").alias("num"),
        text.safe_cast("o_orderpriority", "int").alias("whole"),
        text.safe_cast(
            F.when(F.col("o_orderkey") % 3 == 0, F.lit("x")).otherwise(F.col("o_totalprice").cast("string")), "double"
        ).alias("price"),
    )


@query("lowercase", "SELECT s_suppkey, lower(s_name) AS s_name FROM supplier")
def lowercase(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", text.lowercase("s_name").alias("s_name"))


@query(
    "zscore",
    """SELECT s_suppkey, round((s_acctbal - avg(s_acctbal) OVER ()) / stddev_samp(s_acctbal) OVER (), 6) AS z FROM supplier""",
)
def zscore(spark, d):
    s = table(spark, d, "supplier")
    return rounded(s.select("s_suppkey", numeric.zscore(s, "s_acctbal").alias("z")))


@query(
    "round_format",
    """SELECT s_suppkey, round(s_acctbal / 7, 4) AS rounded, format('{:.2e}', s_acctbal / 7) AS sci,
  '(' || CAST(round(s_acctbal / 7, 3) AS VARCHAR) || '-' || CAST(round(s_acctbal / 3, 3) AS VARCHAR) || ')' AS interval_text FROM supplier""",
)
def round_format(spark, d):
    s = table(spark, d, "supplier")
    x = F.col("s_acctbal") / 7
    return s.select(
        "s_suppkey",
        F.round(x, 4).alias("rounded"),
        numeric.scientific(x).alias("sci"),
        numeric.interval_text(x, F.col("s_acctbal") / 3).alias("interval_text"),
    )


HITS = " + ".join(f"CASE WHEN {s} >= '01500' THEN 1 ELSE 0 END" for s in SLOTS)


@query("row_count_true", f"WITH {VIS} SELECT id, {HITS} AS hits FROM vis")
def row_count_true(spark, d):
    return visits(spark, d).select("id", rowwise.row_count_true(SLOTS, lambda c: c >= "01500").alias("hits"))


@query("row_any_flag", f"WITH {VIS} SELECT id, {HITS} >= 1 AS any_hit, dx_prin >= '01500' AS prin_hit FROM vis")
def row_any_flag(spark, d):
    return visits(spark, d).select(
        "id", rowwise.row_any(SLOTS, lambda c: c >= "01500").alias("any_hit"), (F.col("dx_prin") >= "01500").alias("prin_hit")
    )


@query("row_max", f"WITH {VIS} SELECT id, greatest({', '.join(SLOTS[1:])}) AS largest FROM vis")
def row_max(spark, d):
    return visits(spark, d).select("id", rowwise.row_max(SLOTS[1:]).alias("largest"))


@query(
    "flag_product",
    """WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag = 'R' AS a, l_linestatus = 'F' AS b,
  nullif(l_discount, 0.05) > 0.05 AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
  CASE WHEN a AND b AND c THEN 'A + B + C' WHEN a AND b THEN 'A + B' WHEN a AND c THEN 'A + C' WHEN b AND c THEN 'B + C'
       WHEN a THEN 'A only' WHEN b THEN 'B only' WHEN c THEN 'C only' ELSE 'None' END AS label,
  CAST(a AS INT) + CAST(b AS INT) + CAST(coalesce(c, FALSE) AS INT) >= 2 AS two_plus FROM f""",
)
def flag_product(spark, d):
    li = table(spark, d, "lineitem")
    flags = [
        F.col("l_returnflag") == "R",
        F.col("l_linestatus") == "F",
        recode.values_to_null("l_discount", 0.05) > 0.05,
    ]
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        recode.flag_product(list(zip(flags, "ABC"))).alias("label"),
        (recode.true_count(flags) >= 2).alias("two_plus"),
    )


@query(
    "in_set",
    f"WITH {ENC} SELECT orderkey, line, part, charge, coalesce(ed_disp IN (2, 5), FALSE) AS moved FROM enc",
)
def in_set(spark, d):
    return encounters(spark, d).select(*LINE_KEY, encounter.is_transfer_disposition().alias("moved"))


@query("select_columns", "SELECT s_suppkey, s_name FROM supplier")
def select_columns(spark, d):
    return projection.select_columns(table(spark, d, "supplier"), ["s_suppkey", "s_name"])


@query("select_by_pattern", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def select_by_pattern(spark, d):
    sized = projection.select_by_pattern(table(spark, d, "part"), ["p_partkey"], regex="size|price", drop=True)
    return projection.select_by_pattern(sized, starts="p_")


@query("rename_columns", "SELECT s_suppkey AS id, s_name AS name, s_nationkey, s_acctbal FROM supplier")
def rename_columns(spark, d):
    return projection.rename_columns(table(spark, d, "supplier"), {"s_suppkey": "id", "s_name": "name"})


@query("prefix_lower_names", "SELECT s_suppkey, s_name AS hf_s_name, s_nationkey AS hf_s_nationkey, s_acctbal AS hf_s_acctbal FROM supplier")
def prefix_lower_names(spark, d):
    upper = table(spark, d, "supplier").withColumnsRenamed({"s_name": "S_NAME", "s_acctbal": "S_AcctBal"})
    return projection.prefix_lower_names(upper, "hf_", keep=["s_suppkey"])


@query("suffix_lookup_names", 'SELECT p_partkey AS "p_partkey_3", p_type AS "p_type_3" FROM part')
def suffix_lookup_names(spark, d):
    return projection.suffix_names(table(spark, d, "part").select("p_partkey", "p_type"), "_3")


@query(
    "derive_columns",
    "SELECT s_suppkey, s_acctbal / 10 AS tenth, s_acctbal / 10 > 300 AS high, NOT (s_acctbal / 10 > 300) AS low FROM supplier",
)
def derive_columns(spark, d):
    out = projection.derive_columns(
        table(spark, d, "supplier").select("s_suppkey", "s_acctbal"),
        {"tenth": F.col("s_acctbal") / 10},
        {"high": F.col("tenth") > 300},
        {"low": ~F.col("high")},
    )
    return out.drop("s_acctbal")


@query(
    "map_all_columns",
    """SELECT s_suppkey + 1 AS s_suppkey, upper(s_name) AS s_name, s_nationkey + 1 AS s_nationkey, s_acctbal + 1 AS s_acctbal,
  coalesce(nullif(s_nationkey > 4, TRUE), FALSE) AS flag FROM supplier""",
)
def map_all_columns(spark, d):
    s = table(spark, d, "supplier").withColumn("flag", F.nullif(F.col("s_nationkey") > 4, F.lit(True)))
    s = projection.map_columns(s, lambda c: c + 1, NumericType)
    s = projection.map_columns(s, lambda c: F.coalesce(c, F.lit(False)), BooleanType)
    return s.withColumn("s_name", F.upper("s_name"))


@query("cast_columns", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CAST(s_nationkey AS VARCHAR) AS s_nationkey, s_name, s_acctbal FROM supplier")
def cast_columns(spark, d):
    return projection.cast_columns(table(spark, d, "supplier"), {"s_suppkey": "string", "s_nationkey": "string"})


@query(
    "set_columns",
    """SELECT o_orderkey, 'pdd' AS database, o_orderpriority AS payer, o_orderpriority AS insurance, 0 AS los,
  strftime(o_orderdate, '%Y-%m-%d') AS start_date FROM orders""",
)
def set_columns(spark, d):
    given = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("payer"), F.date_format("o_orderdate", "MM/dd/yyyy").alias("start_date")
    )
    done = projection.set_columns(
        given, {"database": "pdd", "insurance": F.col("payer"), "los": 0, "start_date": dates.parse_date("start_date")}
    )
    return done.withColumn("start_date", F.col("start_date").cast("string"))


@query("reorder_columns", "SELECT s_acctbal, s_suppkey, s_name, s_nationkey FROM supplier")
def reorder_columns(spark, d):
    return projection.reorder_columns(table(spark, d, "supplier"), ["s_acctbal"])


@query("column_presence_check", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def column_presence_check(spark, d):
    return projection.require_columns(table(spark, d, "supplier"), ["s_suppkey", "s_acctbal"])


@query("dim_check", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def dim_check(spark, d):
    return projection.dims(table(spark, d, "lineitem"))


ANALYSIS = ["oshpd_id", "outcome", "age", "small_rural"]


@query(
    "analysis_extract",
    f"""WITH {ENC} SELECT CAST(oshpd_id AS INT) AS oshpd_id, outcome,
  CASE outcome WHEN 'admitted' THEN 1 WHEN 'dc home' THEN 2 WHEN 'transferred' THEN 3 END AS outcome_code, age, small_rural FROM enc""",
)
def analysis_extract_query(spark, d):
    df = encounter.outcome_classify(encounters(spark, d))
    return analysis_extract(df, ANALYSIS, {"outcome": ["admitted", "dc home", "transferred"]}, id_col="oshpd_id")


@query(
    "relevel_reference",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 4
  WHEN '4-NOT SPECIFIED' THEN 5 END AS code FROM orders""",
)
def relevel_reference(spark, d):
    order = levels.relevel(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], "last")
    return table(spark, d, "orders").select("o_orderkey", levels.level_code("o_orderpriority", order).alias("code"))


@query(
    "design_matrix",
    """SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS DOUBLE) AS "o_orderpriority=1-URGENT",
  CAST(o_orderpriority = '3-MEDIUM' AS DOUBLE) AS "o_orderpriority=3-MEDIUM",
  CAST(o_orderstatus = 'O' AS DOUBLE) AS "o_orderstatus=O", o_totalprice
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus IN ('F', 'O')""",
)
def design_matrix_query(spark, d):
    terms = [
        Factor("o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM"), base=2),
        Factor("o_orderstatus", ("F", "O")),
        Number("o_totalprice"),
    ]
    return design_matrix(table(spark, d, "orders"), terms, keep=["o_orderkey"])


ENCOUNTER_OUT = [
    *LINE_KEY, "oshpd_id", "rln", "has_rln", "age_days", "neonate", "ip_course", "ed_disp2", "outcome", "transferred", "admitted",
    "lang_spoken2", "lang_spoken3", "race_group2", "race_group2_5", "race_group3", "sex2", "insurance2", "insurance2_5",
    "insurance3", "has_medicare", "start_weekend", "enc_season", "age_cats", "age_cats2", "age_cats3",
]


@query(
    "encounter_recode",
    f"""WITH {ENC}, a AS (SELECT * EXCLUDE (age_days), CASE WHEN age < 1 THEN age_days END AS age_days, grp AS insurance2,
  CASE race_group WHEN '1' THEN 'White' WHEN '2' THEN 'Black' WHEN '3' THEN 'Hispanic' WHEN '4' THEN 'A/PI'
    WHEN '5' THEN 'AI/AN' WHEN '6' THEN 'Other' WHEN '0' THEN 'Unknown' END AS race_group2
  FROM enc LEFT JOIN (VALUES {PAYER_PAIRS}) v(db, code, grp) ON database = db AND payer = code)
SELECT orderkey, line, part, charge, oshpd_id, nullif(rln, '---------') AS rln, rln <> '---------' AS has_rln, age_days,
  coalesce(age_days < 28, FALSE) AS neonate,
  coalesce(CAST(ip_source_site AS VARCHAR), 'NA') || coalesce(CAST(ip_source_license AS VARCHAR), 'NA')
    || coalesce(CAST(ip_source_route AS VARCHAR), 'NA') AS ip_course,
  CASE WHEN ip_source_route = 1 THEN 'admitted' ELSE CAST(ed_disp AS VARCHAR) END AS ed_disp2,
  outcome, outcome = 'transferred' AS transferred, outcome = 'admitted' AS admitted,
  CASE WHEN lang_spoken = 'ENG' THEN 'English' WHEN lang_spoken = 'SPA' THEN 'Spanish' WHEN lang_spoken = 'CHI' THEN 'Chinese'
    WHEN lang_spoken = 'VIE' THEN 'Vietnamese' WHEN lang_spoken = 'ARA' THEN 'Arabic'
    WHEN lang_spoken IN ('999', '*', '-') THEN 'Unknown/I/B' WHEN lang_spoken IS NOT NULL THEN 'Other' END AS lang_spoken2,
  CASE WHEN lang_spoken = 'ENG' THEN 'English' WHEN lang_spoken = 'SPA' THEN 'Spanish'
    WHEN lang_spoken IS NOT NULL THEN 'Other/Unknown' END AS lang_spoken3,
  race_group2,
  CASE WHEN race_group2 IN ('White', 'Black') THEN race_group2 WHEN race_group2 = 'Hispanic' THEN 'Hispanic/Latino'
    WHEN race_group2 = 'A/PI' THEN 'Asian/Pacific Islander' WHEN race_group2 IS NOT NULL THEN 'Other/Unknown' END AS race_group2_5,
  CASE WHEN race_group2 IN ('White', 'Black') THEN race_group2 WHEN race_group2 = 'Hispanic' THEN 'Hispanic/Latino'
    WHEN race_group2 IS NOT NULL THEN 'Other/Unknown' END AS race_group3,
  CASE sex WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' END AS sex2, insurance2,
  CASE WHEN insurance2 IN ('Medicaid', 'Medicare') THEN 'Public' WHEN insurance2 IN ('Private', 'Uninsured/self-pay') THEN insurance2
    WHEN insurance2 IS NOT NULL THEN 'Other' END AS insurance2_5,
  CASE WHEN insurance2 = 'Medicare' THEN 'Other' WHEN insurance2 <> 'Unknown' THEN insurance2 END AS insurance3,
  insurance2 = 'Medicare' AS has_medicare, dayofweek(start_date) IN (0, 6) AS start_weekend,
  CASE WHEN start_month IN (12, 1, 2) THEN 'Winter' WHEN start_month < 6 THEN 'Spring' WHEN start_month < 9 THEN 'Summer'
    ELSE 'Fall' END AS enc_season,
  CASE WHEN age_days < 28 THEN '0-27d' WHEN age_days >= 28 THEN '28d-12m' WHEN age < 2 THEN '13-23m' WHEN age < 6 THEN '2-5y'
    WHEN age < 12 THEN '6-11y' WHEN age < 18 THEN '12-17y' WHEN age < 21 THEN '18-21y' END AS age_cats,
  CASE WHEN age_days < 28 THEN '0-27d' WHEN age_days >= 28 THEN '28d-12m' WHEN age < 12 THEN '1y-11y'
    WHEN age < 18 THEN '12y-17y' END AS age_cats2,
  CASE WHEN age_days < 28 THEN '0-27d' WHEN age_days >= 28 THEN '28d-12m' WHEN age < 18 THEN '1y-17y' END AS age_cats3
FROM a""",
)
def encounter_recode(spark, d):
    return encounter.encounter_recode(encounters(spark, d)).select(*ENCOUNTER_OUT)


