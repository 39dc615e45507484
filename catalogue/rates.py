"""Rates, frequencies and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import ENC, encounters, query, rounded, table
from cohortry.functions.numeric import percent
from cohortry.operators import counts, rates
from cohortry.operators.cohort import stratify
from cohortry.operators.joins import join_aggregates, side_by_side
from cohortry.plans.encounter import outcome_classify, payer_group


def outcomes(spark, d):
    return outcome_classify(encounters(spark, d))


BLOCKS = """
  count(*) AS hf_ALL_total,
  count(*) FILTER (WHERE outcome = 'transferred') AS hf_ALL_transferred_total,
  count(*) FILTER (WHERE outcome = 'transferred') / CAST(count(*) AS DOUBLE) AS hf_ALL_transferred_rf,
  nullif(count(*) FILTER (WHERE outcome <> 'dc home'), 0) AS hf_ADMIT_total,
  CASE WHEN count(*) FILTER (WHERE outcome <> 'dc home') > 0
       THEN count(*) FILTER (WHERE outcome = 'transferred') END AS hf_ADMIT_transferred_total,
  count(*) FILTER (WHERE outcome = 'transferred')
    / CAST(nullif(count(*) FILTER (WHERE outcome <> 'dc home'), 0) AS DOUBLE) AS hf_ADMIT_transferred_rf,
  nullif(count(*) FILTER (WHERE outcome <> 'admitted'), 0) AS hf_DC_total,
  CASE WHEN count(*) FILTER (WHERE outcome <> 'admitted') > 0
       THEN count(*) FILTER (WHERE outcome = 'transferred') END AS hf_DC_transferred_total,
  count(*) FILTER (WHERE outcome = 'transferred')
    / CAST(nullif(count(*) FILTER (WHERE outcome <> 'admitted'), 0) AS DOUBLE) AS hf_DC_transferred_rf
"""


@query(
    "transfer_rates",
    f"""
WITH {ENC}, r AS (SELECT oshpd_id, {BLOCKS} FROM enc GROUP BY oshpd_id)
SELECT r.oshpd_id, s_name AS hospital, n_name AS county, r_name AS state,
  hf_ALL_total, hf_ALL_transferred_total, round(hf_ALL_transferred_rf, 6) AS hf_ALL_transferred_rf,
  hf_ADMIT_total, hf_ADMIT_transferred_total, round(hf_ADMIT_transferred_rf, 6) AS hf_ADMIT_transferred_rf,
  hf_DC_total, hf_DC_transferred_total, round(hf_DC_transferred_rf, 6) AS hf_DC_transferred_rf
FROM r
LEFT JOIN supplier ON r.oshpd_id = lpad(CAST(s_suppkey AS STRING), 6, '0')
LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
""",
)
def transfer_rates(spark, d):
    per_hospital = rates.transfer_rates(outcomes(spark, d), "oshpd_id")
    hospitals = (
        table(spark, d, "supplier")
        .join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("oshpd_id"),
            F.col("s_name").alias("hospital"),
            F.col("n_name").alias("county"),
            F.col("r_name").alias("state"),
        )
    )
    joined = per_hospital.join(hospitals, "oshpd_id", "left")
    return rounded(joined).orderBy(F.desc("hf_ALL_transferred_rf"), "oshpd_id")


# Payer codes of both sources, written apart from the operator.
PAYER = """CASE
  WHEN database = 'pdd' AND payer = '3' THEN 'Private' WHEN database = 'pdd' AND payer = '2' THEN 'Medicaid'
  WHEN database = 'pdd' AND payer = '8' THEN 'Uninsured/self-pay'
  WHEN database = 'pdd' AND payer IN ('4', '5', '6', '7', '9') THEN 'Other'
  WHEN database = 'pdd' AND payer = '1' THEN 'Medicare'
  WHEN database = 'edd' AND payer IN ('12', '13', '14', '16', 'BL', 'CI', 'HM') THEN 'Private'
  WHEN database = 'edd' AND payer = 'MC' THEN 'Medicaid' WHEN database = 'edd' AND payer = '09' THEN 'Uninsured/self-pay'
  WHEN database = 'edd' AND payer IN ('11', 'AM', 'CH', 'DS', 'OF', 'TV', 'VA', 'WC', '00') THEN 'Other'
  WHEN database = 'edd' AND payer IN ('MA', 'MB') THEN 'Medicare' WHEN database = 'edd' AND payer = '99' THEN 'Unknown' END"""


def profile_frame(spark, d):
    """Encounters with payer group, race, severity and injury (from the part a line holds)."""
    part = table(spark, d, "part").selectExpr(
        "p_partkey AS part", "p_type = 'PROMO' AS ccs_injury_any", "nullif(p_size % 6, 0) AS sev_all_max_int"
    )
    enc = outcomes(spark, d).select("oshpd_id", "outcome", "database", "payer", "race_group", "part")
    return enc.join(part, "part", "left").select(
        "oshpd_id",
        "outcome",
        "ccs_injury_any",
        "sev_all_max_int",
        payer_group().alias("insurance2"),
        "race_group",
    )


PROFILE = {
    "medicaid_rf": "insurance2 = 'Medicaid'",
    "medicaid_or_uninsured_rf": "insurance2 IN ('Medicaid', 'Uninsured/self-pay')",
    "nonwhite_rf": "race_group <> '1'",
    "sev4or5": "sev_all_max_int IN (4, 5)",
}
ELIGIBLE = "outcome IS NOT NULL AND NOT ccs_injury_any AND insurance2 <> 'Medicare'"


def _profile_sql(tag: str, rows: str) -> str:
    out = [
        f"round(count(*) FILTER (WHERE {rows} AND {c}) / CAST(nullif(count(*) FILTER (WHERE {rows}), 0) AS DOUBLE), 6) AS hf_{tag}{n}"
        for n, c in PROFILE.items()
    ]
    for name, cond in {"ALL": "TRUE", "ADMIT": "outcome <> 'dc home'", "DC": "outcome <> 'admitted'"}.items():
        total = f"count(*) FILTER (WHERE {rows} AND {cond})"
        moved = f"count(*) FILTER (WHERE {rows} AND {cond} AND outcome = 'transferred')"
        out += [
            f"nullif({total}, 0) AS hf_{tag}{name}_total",
            f"CASE WHEN {total} > 0 THEN {moved} END AS hf_{tag}{name}_transferred_total",
            f"round({moved} / CAST(nullif({total}, 0) AS DOUBLE), 6) AS hf_{tag}{name}_transferred_rf",
        ]
    return ", ".join(out)


@query(
    "hospital_profile",
    f"""
WITH {ENC}, f AS (
  SELECT oshpd_id, outcome, race_group, p_type = 'PROMO' AS ccs_injury_any, nullif(p_size % 6, 0) AS sev_all_max_int,
    {PAYER} AS insurance2
  FROM enc LEFT JOIN part ON part = p_partkey)
SELECT oshpd_id, {_profile_sql("", "TRUE")}, {_profile_sql("ei_", f"({ELIGIBLE})")}
FROM f GROUP BY oshpd_id
""",
)
def hospital_profile(spark, d):
    conditions = {n: F.expr(c) for n, c in PROFILE.items()}
    out = rates.hospital_profile(
        profile_frame(spark, d), "oshpd_id", conditions, {"": None, "ei_": F.expr(ELIGIBLE)}
    )
    return rounded(out)


@query(
    "group_rate",
    f"""
WITH {ENC} SELECT oshpd_id, count(*) AS total,
  round(count(*) FILTER (WHERE sex = 'F') / CAST(count(*) AS DOUBLE), 6) AS female_rf,
  round(count(*) FILTER (WHERE ed_disp IN (2, 5)) / CAST(count(*) AS DOUBLE), 6) AS moved_rf
FROM enc GROUP BY oshpd_id
""",
)
def group_rate(spark, d):
    conds = {"female_rf": F.col("sex") == "F", "moved_rf": F.col("ed_disp").isin(2, 5)}
    return rounded(rates.group_rate(encounters(spark, d), "oshpd_id", conds))


@query("group_count", "SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS INT) AS yr, count(*) AS n FROM orders GROUP BY ALL")
def group_count(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("yr"))
    return counts.group_count(orders, "status", "yr")


@query(
    "count_nonnull",
    "SELECT nullif(o_orderpriority, '5-LOW') AS priority, count(nullif(o_orderpriority, '5-LOW')) AS n FROM orders GROUP BY ALL",
)
def count_nonnull(spark, d):
    p = table(spark, d, "orders").select(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"))
    return counts.count_nonnull(p, "priority", "priority")


@query(
    "univar_table",
    "SELECT p_brand, count(*) AS freq, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS rel_freq FROM part GROUP BY p_brand",
)
def univar_table(spark, d):
    return rounded(counts.univar_table(table(spark, d, "part"), "p_brand"))


@query(
    "share_of_total",
    "SELECT p_type, p_brand, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM part GROUP BY ALL",
)
def share_of_total(spark, d):
    return rounded(counts.share_of_total(counts.group_count(table(spark, d, "part"), "p_type", "p_brand"), "n"))


@query(
    "share_within_group",
    """SELECT p_type, p_brand, count(*) AS n,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY p_type) AS DOUBLE), 6) AS share FROM part GROUP BY p_type, p_brand""",
)
def share_within_group(spark, d):
    return rounded(counts.with_share(counts.group_count(table(spark, d, "part"), "p_type", "p_brand"), ["p_type"]))


@query(
    "group_share",
    f"""WITH {ENC} SELECT database, outcome, count(*) AS n,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY database) AS DOUBLE), 6) AS share FROM enc GROUP BY database, outcome""",
)
def group_share(spark, d):
    return rounded(counts.group_share(outcomes(spark, d), "database", "outcome"))


@query(
    "count_trues",
    f"""WITH {ENC} SELECT oshpd_id, count(*) AS total, count(*) FILTER (WHERE outcome = 'transferred') AS count,
  round(count(*) FILTER (WHERE outcome = 'transferred') / CAST(count(*) AS DOUBLE), 6) AS prop FROM enc GROUP BY oshpd_id""",
)
def count_trues(spark, d):
    return rounded(counts.count_trues(outcomes(spark, d), "transferred", "oshpd_id"))


@query("crosstab_null", f"WITH {ENC} SELECT database, outcome, count(*) AS n FROM enc GROUP BY ALL")
def crosstab_null(spark, d):
    return counts.crosstab(outcomes(spark, d), "database", "outcome")


@query(
    "crosstab_null_wide",
    f"""WITH {ENC} SELECT database, count(*) FILTER (WHERE outcome = 'admitted') AS admitted,
  count(*) FILTER (WHERE outcome = 'transferred') AS transferred, count(*) FILTER (WHERE outcome IS NULL) AS missing
FROM enc GROUP BY database""",
)
def crosstab_null_wide(spark, d):
    return counts.crosstab_wide(outcomes(spark, d), "database", "outcome", ["admitted", "transferred"])


@query(
    "freq_table",
    f"WITH {ENC} SELECT database, outcome, count(*) AS n FROM enc WHERE outcome IS NOT NULL GROUP BY ALL",
)
def freq_table(spark, d):
    return counts.freq_table(outcomes(spark, d), "database", "outcome")


@query(
    "tabulate_row_pct",
    f"""WITH {ENC} SELECT small_rural, outcome, count(*) AS n,
  round(100 * count(*) / CAST(sum(count(*)) OVER (PARTITION BY small_rural) AS DOUBLE), 6) AS row_pct
FROM enc WHERE outcome <> 'dc home' GROUP BY small_rural, outcome""",
)
def tabulate_row_pct(spark, d):
    return rounded(counts.tabulate_row_pct(outcomes(spark, d), "small_rural", "outcome", F.col("outcome") != "dc home"))


PIVOT = """count(*) FILTER (WHERE outcome = 'admitted') AS admitted, count(*) FILTER (WHERE outcome = 'dc home') AS dc_home,
  count(*) FILTER (WHERE outcome = 'transferred') AS transferred, count(*) FILTER (WHERE outcome IS NULL) AS other"""


@query(
    "outcome_pivot",
    f"""WITH {ENC}, w AS (SELECT oshpd_id, {PIVOT} FROM enc GROUP BY oshpd_id),
t AS (SELECT *, admitted + dc_home + transferred AS total FROM w)
SELECT *, round(100 * admitted / CAST(nullif(total, 0) AS DOUBLE), 6) AS admit_per,
  round(100 * dc_home / CAST(nullif(total, 0) AS DOUBLE), 6) AS dc_home_per,
  round(100 * transferred / CAST(nullif(total, 0) AS DOUBLE), 6) AS transferred_per,
  round(transferred / CAST(nullif(admitted + transferred, 0) AS DOUBLE), 6) AS transfer_adm_per,
  admitted + transferred = 0 OR transferred = 0 OR admitted = 0 AS all_none
FROM t""",
)
def outcome_pivot(spark, d):
    return rounded(counts.outcome_pivot(outcomes(spark, d), "oshpd_id"))


@query(
    "outcome_pivot_global",
    f"""WITH {ENC}, w AS (SELECT oshpd_id, {PIVOT} FROM enc GROUP BY oshpd_id),
t AS (SELECT *, CAST(sum(admitted + dc_home + transferred) OVER () AS BIGINT) AS total,
  sum(admitted + transferred) OVER () AS adm FROM w)
SELECT oshpd_id, admitted, dc_home, transferred, other, total, round(100 * admitted / CAST(total AS DOUBLE), 6) AS admit_per,
  round(100 * dc_home / CAST(total AS DOUBLE), 6) AS dc_home_per,
  round(100 * transferred / CAST(total AS DOUBLE), 6) AS transferred_per,
  round(transferred / CAST(adm AS DOUBLE), 6) AS transfer_adm_per, transferred = 0 OR transferred = adm AS all_none
FROM t""",
)
def outcome_pivot_global(spark, d):
    return rounded(counts.outcome_pivot(outcomes(spark, d), "oshpd_id", denominator="global"))


@query(
    "rare_category_flag",
    """WITH f AS (SELECT p_brand, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS rf FROM part GROUP BY p_brand)
SELECT p_partkey, p_brand, rf < 0.04 AS rare FROM part JOIN f USING (p_brand)""",
)
def rare_category_flag(spark, d):
    return counts.rare_category_flag(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", 0.04)


@query(
    "mode_value",
    """WITH c AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_brand) AS k FROM c)
SELECT p_type, p_brand AS mode, n FROM r WHERE k = 1""",
)
def mode_value(spark, d):
    return counts.mode_value(table(spark, d, "part"), "p_brand", "p_type")


@query(
    "argmax",
    """WITH r AS (SELECT s_nationkey, s_suppkey, s_acctbal,
  row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS k FROM supplier)
SELECT s_nationkey, s_suppkey, s_acctbal FROM r WHERE k = 1""",
)
def argmax(spark, d):
    return counts.argmax(table(spark, d, "supplier"), "s_acctbal", "s_suppkey", "s_nationkey")


@query(
    "side_by_side",
    """WITH a AS (SELECT o_orderpriority AS value1, count(*) AS n1 FROM orders GROUP BY 1),
b AS (SELECT nullif(o_orderstatus, 'P') AS value2, count(nullif(o_orderstatus, 'P')) AS n2 FROM orders GROUP BY 1),
ra AS (SELECT *, row_number() OVER (ORDER BY n1, value1 NULLS FIRST) AS position FROM a),
rb AS (SELECT *, row_number() OVER (ORDER BY n2, value2 NULLS FIRST) AS position FROM b)
SELECT position, value1, n1, value2, n2 FROM ra FULL JOIN rb USING (position)""",
)
def side_by_side_query(spark, d):
    orders = table(spark, d, "orders").select("o_orderpriority", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status2"))
    return side_by_side(orders, "o_orderpriority", "status2")


@query(
    "join_aggregates",
    """WITH m AS (SELECT l_suppkey, count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
  round(avg(l_quantity), 6) AS mean_quantity FROM lineitem GROUP BY 1)
SELECT s_suppkey, s_name, n_lines, n_returned, mean_quantity FROM supplier LEFT JOIN m ON s_suppkey = l_suppkey""",
)
def join_aggregates_query(spark, d):
    base = table(spark, d, "supplier").select("s_suppkey", "s_name")
    facts = table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    out = join_aggregates(
        base,
        facts,
        "s_suppkey",
        n_lines=F.count(F.lit(1)),
        n_returned=F.count_if(F.col("l_returnflag") == "R"),
        mean_quantity=F.avg("l_quantity"),
    )
    return rounded(out)


@query(
    "stratify_subset",
    f"""WITH {ENC}, s AS (
  SELECT 'small rural' AS stratum, * FROM enc WHERE small_rural UNION ALL
  SELECT 'other' AS stratum, * FROM enc WHERE NOT small_rural UNION ALL
  SELECT 'under 14' AS stratum, * FROM enc WHERE age < 14)
SELECT stratum, count(*) AS n, round(avg(CASE WHEN outcome = 'transferred' THEN 1.0 WHEN outcome IS NOT NULL THEN 0.0 END), 6) AS rate
FROM s GROUP BY stratum""",
)
def stratify_subset(spark, d):
    strata = [("small rural", F.col("small_rural")), ("other", ~F.col("small_rural")), ("under 14", F.col("age") < 14)]
    long = stratify(outcomes(spark, d).select("small_rural", "age", "transferred"), strata)
    out = long.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("transferred").cast("double")).alias("rate"))
    return rounded(out)


@query(
    "outcome_contrast",
    f"""WITH {ENC}, k AS (
  SELECT 'all' AS contrast, outcome FROM enc WHERE outcome IS NOT NULL UNION ALL
  SELECT 'admitted', outcome FROM enc WHERE outcome <> 'dc home' UNION ALL
  SELECT 'discharged', outcome FROM enc WHERE outcome <> 'admitted')
SELECT contrast, count(*) AS n, count(*) FILTER (WHERE outcome = 'transferred') AS transferred FROM k GROUP BY contrast""",
)
def outcome_contrast(spark, d):
    from cohortry.models.grid import CONTRASTS, contrast

    long = stratify(outcomes(spark, d).select("outcome"), [(k, contrast(k)) for k in CONTRASTS], "contrast")
    return long.groupBy("contrast").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("outcome") == "transferred").alias("transferred")
    )


@query(
    "ratio_percent",
    """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) / CAST(nullif(o_orderkey, 0) AS DOUBLE) * 100 AS pct,
  o_totalprice / 10 AS tenth FROM orders""",
)
def ratio_percent(spark, d):
    orders = table(spark, d, "orders")
    return orders.select(
        "o_orderkey", percent("o_custkey", "o_orderkey").alias("pct"), (F.col("o_totalprice") / 10).alias("tenth")
    )
