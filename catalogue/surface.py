"""The four kinds of user function: column, row, table and aggregate functions, all plain Python over Columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import SLOTS, VIS, query, rounded, table, visits
from cohortry.functions.recode import band
from cohortry.operators.counts import mode_value, univar_table


@query(
    "column_function",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS balance FROM customer""",
)
def column_function(spark, d):
    """A function from Column to Column, used inside a projection."""

    def balance(column):
        return band(column, [0, 5000], ["debt", "low", "high"])

    return table(spark, d, "customer").select("c_custkey", balance("c_acctbal").alias("balance"))


@query(
    "row_lambda",
    f"WITH {VIS} SELECT id, {' + '.join(f'CAST({s} IS NOT NULL AS INT)' for s in SLOTS)} AS n_codes FROM vis",
)
def row_lambda(spark, d):
    """A lambda over the values of one row."""
    codes = F.filter(F.array(*SLOTS), lambda code: code.isNotNull())
    return visits(spark, d).select("id", F.size(codes).alias("n_codes"))


@query(
    "table_function",
    """SELECT o_orderstatus, count(*) AS freq, round(count(*) / CAST((SELECT count(*) FROM orders) AS DOUBLE), 6) AS rel_freq
FROM orders GROUP BY o_orderstatus""",
)
def table_function(spark, d):
    """A function from DataFrame to DataFrame, chained with ``transform``."""
    return table(spark, d, "orders").transform(univar_table, "o_orderstatus").transform(rounded)


@query(
    "aggregate_function",
    """WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) AS k FROM c)
SELECT l_suppkey, l_returnflag AS mode, n FROM r WHERE k = 1""",
)
def aggregate_function(spark, d):
    """An aggregate built from built-in ones: most frequent value per group."""
    return mode_value(table(spark, d, "lineitem"), "l_returnflag", "l_suppkey")
