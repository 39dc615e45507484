"""Filters, cohorts, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import ENC, encounters, query, table
from cohortry.operators import cohort, joins
from cohortry.plans.encounter import outcome_classify
from cohortry.sources.harmonise import code_system, union_all

KEY = ["orderkey", "line", "part", "charge"]


@query("filter_rows", f"WITH {ENC} SELECT orderkey, line, part, charge FROM enc WHERE outcome <> 'dc home'")
def filter_rows(spark, d):
    return cohort.keep_rows(outcome_classify(encounters(spark, d)), F.col("outcome") != "dc home").select(*KEY)


@query("filter_expr", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity < 22")
def filter_expr(spark, d):
    return cohort.keep_rows(table(spark, d, "lineitem"), "l_quantity < 22").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "null_predicates",
    f"""WITH {ENC} SELECT orderkey, line, part, charge, outcome IS NOT NULL AS known FROM enc
WHERE ip_source_route IS NULL OR payer IS NOT NULL""",
)
def null_predicates(spark, d):
    df = outcome_classify(encounters(spark, d))
    kept = cohort.keep_rows(df, F.col("ip_source_route").isNull() | F.col("payer").isNotNull())
    return kept.select(*KEY, F.col("outcome").isNotNull().alias("known"))


@query(
    "ed_arrival_cohort",
    f"""WITH {ENC} SELECT database, ip_source_route, count(*) AS n FROM enc
WHERE database = 'edd' OR (database = 'pdd' AND ip_source_route = 1) GROUP BY ALL""",
)
def ed_arrival_cohort(spark, d):
    return (
        cohort.ed_arrival_cohort(encounters(spark, d))
        .groupBy("database", "ip_source_route")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "cohort_attrition",
    f"""WITH {ENC}, c AS (SELECT count(*) AS n0, count(*) FILTER (WHERE line <> 4) AS n1,
  count(*) FILTER (WHERE line <> 4 AND outcome IS NOT NULL) AS n2,
  count(*) FILTER (WHERE line <> 4 AND outcome IS NOT NULL AND payer <> '1') AS n3,
  count(*) FILTER (WHERE line <> 4 AND outcome IS NOT NULL AND payer <> '1' AND small_rural) AS n4 FROM enc)
SELECT 0 AS step, 'all' AS label, n0 AS n, 0 AS dropped FROM c UNION ALL SELECT 1, 'not injured', n1, n0 - n1 FROM c
UNION ALL SELECT 2, 'known outcome', n2, n1 - n2 FROM c UNION ALL SELECT 3, 'not Medicare', n3, n2 - n3 FROM c
UNION ALL SELECT 4, 'small rural', n4, n3 - n4 FROM c""",
)
def cohort_attrition(spark, d):
    steps = [
        ("not injured", F.col("line") != 4),
        ("known outcome", F.col("outcome").isNotNull()),
        ("not Medicare", F.col("payer") != "1"),
        ("small rural", F.col("small_rural")),
    ]
    return cohort.attrition(outcome_classify(encounters(spark, d)), steps)


@query(
    "complete_cases",
    f"WITH {ENC} SELECT orderkey, line, part, charge FROM enc WHERE outcome IS NOT NULL AND payer IS NOT NULL AND ip_source_route IS NOT NULL",
)
def complete_cases(spark, d):
    df = outcome_classify(encounters(spark, d))
    return cohort.complete_cases(df, ["outcome", "payer", "ip_source_route"]).select(*KEY)


@query("distinct_values", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_values(spark, d):
    return cohort.distinct_values(table(spark, d, "lineitem"), "l_suppkey", "l_returnflag")


@query("sort_rows", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sort_rows(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")


@query("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def limit_rows(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return cohort.limit_rows(orders, 10, [F.desc("o_totalprice"), F.col("o_orderkey")])


@query("semi_join_filter", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def semi_join_filter(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return cohort.semi_join_filter(orders, lines, "o_orderkey")


@query(
    "membership_flag",
    "SELECT c_custkey, coalesce(c_custkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0), FALSE) AS listed FROM customer",
)
def membership_flag(spark, d):
    listed = table(spark, d, "supplier").filter("s_acctbal > 0").withColumnRenamed("s_suppkey", "c_custkey")
    return cohort.membership_flag(table(spark, d, "customer").select("c_custkey"), listed, "c_custkey", "listed")


@query(
    "left_join",
    """SELECT c_custkey, nullif(c_nationkey, 3) AS n_nationkey, n_name, n_regionkey
FROM customer LEFT JOIN nation ON nullif(c_nationkey, 3) = n_nationkey""",
)
def left_join(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey", "nullif(c_nationkey, 3) AS n_nationkey")
    return joins.lookup_join(c, table(spark, d, "nation"), "n_nationkey")


@query(
    "null_safe_join",
    """SELECT c_custkey, nullif(c_nationkey, 3) AS n_nationkey, n_name FROM customer
LEFT JOIN (SELECT nullif(n_nationkey, 3) AS k, n_name FROM nation) ON nullif(c_nationkey, 3) IS NOT DISTINCT FROM k""",
)
def null_safe_join(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey", "nullif(c_nationkey, 3) AS n_nationkey")
    n = table(spark, d, "nation").selectExpr("nullif(n_nationkey, 3) AS n_nationkey", "n_name")
    return joins.lookup_join(c, n, "n_nationkey", null_safe=True)


@query(
    "full_join",
    """SELECT coalesce(s_suppkey, c_custkey + 50) AS id, s_acctbal, c_acctbal FROM supplier
FULL JOIN customer ON s_suppkey = c_custkey + 50""",
)
def full_join(spark, d):
    s = table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_acctbal")
    c = table(spark, d, "customer").selectExpr("c_custkey + 50 AS id", "c_acctbal")
    return joins.full_join(s, c, "id")


@query(
    "union_all",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'pdd' AS database, o_totalprice AS charge FROM orders
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'edd', l_extendedprice FROM lineitem""",
)
def union_all_query(spark, d):
    a = table(spark, d, "orders").selectExpr("CAST(o_orderkey AS STRING) AS id", "'pdd' AS database", "o_totalprice AS charge")
    b = table(spark, d, "lineitem").selectExpr("l_extendedprice AS charge", "CAST(l_orderkey AS STRING) AS id", "'edd' AS database")
    return union_all([a, b])


@query(
    "split_by_date_union",
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderdate < DATE '1998-10-01' THEN 'icd9_dx' ELSE 'icd10_dx' END AS code_system,
  o_custkey % 2300 AS code FROM orders),
l AS (SELECT 'icd9_dx' AS code_system, p_partkey AS code, p_type AS label FROM part
  UNION ALL SELECT 'icd10_dx', p_partkey, p_brand FROM part)
SELECT o_orderkey, code_system, label FROM o LEFT JOIN l USING (code_system, code)""",
)
def split_by_date_union(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", code_system("o_orderdate", "1998-10-01").alias("code_system"), (F.col("o_custkey") % 2300).alias("code")
    )
    part = table(spark, d, "part")
    both = union_all(
        [
            part.selectExpr("'icd9_dx' AS code_system", "p_partkey AS code", "p_type AS label"),
            part.selectExpr("'icd10_dx' AS code_system", "p_partkey AS code", "p_brand AS label"),
        ]
    )
    return joins.lookup_join(o, both, ["code_system", "code"]).select("o_orderkey", "code_system", "label")
