"""Descriptive tables, tests and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.marginal import marginal_sql, terms_sql
from catalogue.registry import ENC, encounters, query, rounded, table
from cohortry.models.design import Factor, Number, sparse_levels
from cohortry.models.grid import contrast, cross
from cohortry.models.logit import logit, or_table, ratio_table
from cohortry.models.mixed import Cell, fit_grid, icc, mixed_logit
from cohortry.operators import comparisons, order_stats, summary
from cohortry.plans.encounter import outcome_classify

NUMBERS = ["charge", "quantity", "age"]


def simpson_sql(begin: str, end: str, density: str, steps: int = 4000) -> str:
    """Simpson's rule over u from ``begin`` to ``end``."""
    at = density.replace("u", f"({begin} + i * (({end}) - ({begin})) / {steps})")
    weight = f"CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"(({end}) - ({begin})) / {3 * steps} * list_sum(list_transform(range(0, {steps + 1}), lambda i: {weight} * ({at})))"


def chi2_sql(x: str, df: str) -> str:
    """Upper tail of the chi-square density, summed on the log scale."""
    a, begin = f"(({df}) / 2.0)", f"ln(({x}) / 2)"
    end = f"ln(greatest(({x}) / 2, {a}) + 40 * sqrt({a} + 1) + 60)"
    return f"CASE WHEN ({x}) <= 0 THEN 1.0 ELSE {simpson_sql(begin, end, f'EXP({a} * u - EXP(u) - LGAMMA({a}))')} END"


def f_sql(x: str, df1: str, df2: str) -> str:
    """Upper tail of the F density, summed on the log-odds scale; for many degrees of freedom below."""
    a, b = f"(({df1}) / 2.0)", f"(({df2}) / 2.0)"
    odds = f"(({df1}) * ({x}) / ({df2}))"
    end = f"ln((greatest({b} * {odds}, {a}) + 40 * sqrt({a} + 1) + 60) / {b})"
    density = f"EXP({a} * u - ({a} + {b}) * LN(1 + EXP(u)) - LGAMMA({a}) - LGAMMA({b}) + LGAMMA({a} + {b}))"
    return f"CASE WHEN ({x}) <= 0 THEN 1.0 ELSE {simpson_sql(f'ln({odds})', end, density)} END"


def frame(spark, d):
    return outcome_classify(encounters(spark, d))


def long_sql(names: list[str], cast: str) -> str:
    return " UNION ALL ".join(f"SELECT outcome AS grp, '{n}' AS variable, CAST({n} AS {cast}) AS value FROM enc" for n in names)


@query(
    "missing_table",
    f"""WITH {ENC}, m AS (SELECT database, count(*) AS n, count(*) - count(outcome) AS outcome, count(*) - count(payer) AS payer,
  count(*) - count(ip_source_route) AS ip_source_route FROM enc GROUP BY database)
SELECT database, n, variable, n_missing, round(100 * n_missing / CAST(n AS DOUBLE), 6) AS pct_missing
FROM m UNPIVOT (n_missing FOR variable IN (outcome, payer, ip_source_route))""",
)
def missing_table(spark, d):
    return rounded(summary.missing_table(frame(spark, d), ["outcome", "payer", "ip_source_route"], "database"))


@query(
    "column_summary",
    f"""WITH {ENC}, l AS (SELECT 'charge' AS variable, CAST(charge AS DOUBLE) AS v FROM enc UNION ALL SELECT 'quantity', quantity FROM enc
  UNION ALL SELECT 'age', age FROM enc UNION ALL SELECT 'ed_disp', ed_disp FROM enc),
nums AS (SELECT variable, count(*) AS n, count(*) - count(v) AS n_missing, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS sd,
  min(v) AS p0, round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75,
  max(v) AS p100 FROM l GROUP BY variable),
days AS (SELECT count(*) AS n, count(*) - count(start_date) AS n_missing, [min(start_date), max(start_date)] AS ends,
  quantile_cont(epoch_us(start_date::TIMESTAMP), [0.25, 0.5, 0.75]) AS mids FROM enc)
SELECT *, CAST(NULL AS BIGINT) AS n_levels, NULL AS t_p0, NULL AS t_p25, NULL AS t_p50, NULL AS t_p75, NULL AS t_p100 FROM nums
UNION ALL SELECT 'start_date', n, n_missing, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, strftime(ends[1], '%Y-%m-%d %H:%M:%S'),
  strftime(make_timestamp(CAST(round(mids[1]) AS BIGINT)), '%Y-%m-%d %H:%M:%S'), strftime(make_timestamp(CAST(round(mids[2]) AS BIGINT)), '%Y-%m-%d %H:%M:%S'),
  strftime(make_timestamp(CAST(round(mids[3]) AS BIGINT)), '%Y-%m-%d %H:%M:%S'), strftime(ends[2], '%Y-%m-%d %H:%M:%S') FROM days
UNION ALL SELECT 'outcome', count(*), count(*) - count(outcome), NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(DISTINCT outcome), NULL, NULL, NULL, NULL, NULL FROM enc
UNION ALL SELECT 'payer', count(*), count(*) - count(payer), NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(DISTINCT payer), NULL, NULL, NULL, NULL, NULL FROM enc
UNION ALL SELECT 'transferred', count(*), count(*) - count(outcome), round(avg(CASE WHEN outcome = 'transferred' THEN 1.0
  WHEN outcome IS NOT NULL THEN 0.0 END), 4), round(stddev_samp(CASE WHEN outcome = 'transferred' THEN 1.0
  WHEN outcome IS NOT NULL THEN 0.0 END), 4), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM enc""",
)
def column_summary(spark, d):
    chosen = frame(spark, d).select("charge", "quantity", "age", "ed_disp", "outcome", "payer", "transferred", "start_date")
    out = rounded(summary.column_summary(chosen), 4)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in out.columns if c.startswith("t_p")})


@query(
    "exact_quantiles",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 4) AS p10, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
  round(quantile_cont(l_extendedprice, 0.99), 4) AS p99, count(*) AS total, 'l_extendedprice' AS variable FROM lineitem GROUP BY l_returnflag""",
)
def exact_quantiles(spark, d):
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    return rounded(order_stats.exact_quantiles(table(spark, d, "lineitem"), ["l_extendedprice"], probs, ["l_returnflag"]), 4)


CATEGORIES = ["database", "sex", "payer"]
CAT_BLOCK = f"""c AS (SELECT variable, value AS level, grp, count(*) AS n FROM ({long_sql(CATEGORIES, 'VARCHAR')})
  WHERE grp IS NOT NULL AND value IS NOT NULL GROUP BY ALL)"""
NUM_BLOCK = f"""x AS (SELECT variable, grp, count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS sd,
  round(quantile_cont(value, 0.25), 4) AS q1, round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q3
  FROM ({long_sql(NUMBERS, 'DOUBLE')}) WHERE grp IS NOT NULL GROUP BY ALL)"""


@query(
    "bivariate_table",
    f"""WITH {ENC}, {CAT_BLOCK}, {NUM_BLOCK}
SELECT variable, level, grp, n, round(100 * n / CAST(sum(n) OVER (PARTITION BY variable, grp) AS DOUBLE), 4) AS pct,
  CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS sd, CAST(NULL AS DOUBLE) AS q1, CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS q3 FROM c
UNION ALL SELECT variable, NULL, grp, n, NULL, mean, sd, q1, median, q3 FROM x""",
)
def bivariate_table(spark, d):
    return rounded(summary.bivariate_table(frame(spark, d), "outcome", CATEGORIES, NUMBERS), 4)


@query(
    "bivariate_table_overall",
    f"""WITH {ENC}, {CAT_BLOCK}, o AS (SELECT * FROM c UNION ALL SELECT variable, level, '[ALL]', CAST(sum(n) AS BIGINT) FROM c GROUP BY ALL)
SELECT variable, level, grp, n, round(100 * n / CAST(sum(n) OVER (PARTITION BY variable, grp) AS DOUBLE), 4) AS pct FROM o""",
)
def bivariate_table_overall(spark, d):
    return rounded(summary.category_block(frame(spark, d), "outcome", CATEGORIES, show_all=True), 4)


@query(
    "describe_by",
    f"""WITH {ENC}, c AS (SELECT 'payer' AS variable, payer AS level, outcome AS grp, count(*) AS n FROM enc WHERE outcome IS NOT NULL GROUP BY ALL)
SELECT *, round(100 * n / CAST(sum(n) OVER (PARTITION BY grp) AS DOUBLE), 6) AS pct FROM c""",
)
def describe_by(spark, d):
    return rounded(summary.describe_by(frame(spark, d), "outcome", "payer", include_missing=True))


@query(
    "chi_square",
    f"""WITH {ENC}, {CAT_BLOCK}, e AS (SELECT variable, level, grp, CAST(n AS DOUBLE) AS o, CAST(sum(n) OVER (PARTITION BY variable, level) AS DOUBLE) AS r,
  CAST(sum(n) OVER (PARTITION BY variable, grp) AS DOUBLE) AS k, CAST(sum(n) OVER (PARTITION BY variable) AS DOUBLE) AS t FROM c),
x AS (SELECT variable, CAST(max(t) AS BIGINT) AS n, max(t) * sum(o * o / (r * k)) - max(t) AS s,
  (count(DISTINCT level) - 1) * (count(DISTINCT grp) - 1) AS df FROM e GROUP BY variable)
SELECT variable, n, round(s, 4) AS statistic, df, round({chi2_sql('s', 'df')}, 6) AS p_value FROM x""",
)
def chi_square(spark, d):
    out = comparisons.chi_square(frame(spark, d), "outcome", CATEGORIES)
    return rounded(out).withColumn("statistic", F.round("statistic", 4))


def moved_by_rural(spark, d):
    return comparisons.two_by_two(frame(spark, d), F.col("transferred"), F.col("small_rural"))


CELLS = f"""WITH {ENC}, t AS (SELECT count(*) FILTER (WHERE small_rural AND outcome = 'transferred') AS a,
  count(*) FILTER (WHERE small_rural AND outcome <> 'transferred') AS b, count(*) FILTER (WHERE NOT small_rural AND outcome = 'transferred') AS c,
  count(*) FILTER (WHERE NOT small_rural AND outcome <> 'transferred') AS d FROM enc)"""


@query(
    "odds_ratio_2x2",
    f"""{CELLS}, e AS (SELECT *, ln(a) + ln(d) - ln(b) - ln(c) AS log_or, sqrt(1.0 / a + 1.0 / b + 1.0 / c + 1.0 / d) AS se FROM t)
SELECT a, b, c, d, round(log_or, 6) AS log_or, round(se, 6) AS std_error, round(exp(log_or), 6) AS odds_ratio,
  round(exp(log_or - 1.959963984540054 * se), 6) AS conf_low, round(exp(log_or + 1.959963984540054 * se), 6) AS conf_high FROM e""",
)
def odds_ratio_2x2(spark, d):
    return rounded(comparisons.odds_ratio(moved_by_rural(spark, d)))


@query(
    "fisher_exact_2x2",
    f"""{CELLS}, m AS (SELECT *, a + b AS r, a + c AS k, a + b + c + d AS n FROM t),
x AS (SELECT *, unnest(range(CAST(greatest(0, r + k - n) AS BIGINT), CAST(least(r, k) + 1 AS BIGINT))) AS i FROM m),
p AS (SELECT a, b, c, d, i, lgamma(k + 1) - lgamma(i + 1) - lgamma(k - i + 1) + lgamma(n - k + 1) - lgamma(r - i + 1)
  - lgamma(n - k - r + i + 1) - lgamma(n + 1) + lgamma(r + 1) + lgamma(n - r + 1) AS lp FROM x),
o AS (SELECT lp AS seen FROM p WHERE i = a)
SELECT a, b, c, d, round(sum(exp(lp)) FILTER (WHERE lp <= seen + 1e-7), 6) AS p_value FROM p, o GROUP BY a, b, c, d""",
)
def fisher_exact_2x2(spark, d):
    return rounded(comparisons.fisher_exact(moved_by_rural(spark, d)))


MEAN_RANKS = f"""l AS ({long_sql(NUMBERS, 'DOUBLE')}), v AS (SELECT * FROM l WHERE grp IS NOT NULL AND value IS NOT NULL),
g AS (SELECT variable, grp, count(*) AS n, avg(value) AS m, var_samp(value) AS s2 FROM v GROUP BY ALL),
a AS (SELECT variable, CAST(sum(n) AS BIGINT) AS n, count(*) AS k, sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n) AS ssb, sum((n - 1) * s2) AS ssw
  FROM g GROUP BY variable),
r AS (SELECT variable, grp, value, rank() OVER w + (count(*) OVER (PARTITION BY variable, value) - 1) / 2.0 AS rk,
  count(*) OVER (PARTITION BY variable, value) AS t FROM v WINDOW w AS (PARTITION BY variable ORDER BY value)),
rs AS (SELECT variable, grp, count(*) AS n, sum(CAST(rk AS DOUBLE)) AS s FROM r GROUP BY ALL),
ties AS (SELECT variable, sum(CAST(t AS DOUBLE) * t - 1) AS ties FROM r GROUP BY variable),
h AS (SELECT variable, CAST(sum(n) AS DOUBLE) AS n, sum(s * s / n) AS q FROM rs GROUP BY variable),
fh AS (SELECT variable, a.n, (ssb / (k - 1)) / (ssw / (a.n - k)) AS f, k - 1 AS df1, a.n - k AS df2,
  (12 / (h.n * (h.n + 1)) * q - 3 * (h.n + 1)) / (1 - ties / (h.n * h.n * h.n - h.n)) AS h FROM a JOIN h USING (variable) JOIN ties USING (variable))"""


@query(
    "group_difference_tests",
    f"""WITH {ENC}, {MEAN_RANKS}
SELECT variable, n, round(f, 4) AS f, df1, df2, round(h, 4) AS h, round({f_sql('f', 'df1', 'df2')}, 6) AS p_f, round({chi2_sql('h', 'df1')}, 6) AS p_h FROM fh""",
)
def group_difference_tests(spark, d):
    df = frame(spark, d)
    f = comparisons.anova(df, "outcome", NUMBERS).select(
        "variable", "n", F.round("statistic", 4).alias("f"), "df1", "df2", F.round("p_value", 6).alias("p_f")
    )
    h = comparisons.kruskal_wallis(df, "outcome", NUMBERS)
    return f.join(h.select("variable", F.round("statistic", 4).alias("h"), F.round("p_value", 6).alias("p_h")), "variable")


def shape_sql(values: str) -> str:
    """Skewness, kurtosis and the Jarque-Bera statistic of (variable, value) rows."""
    return f"""m AS (SELECT variable, count(*) AS n, avg(value) AS mu FROM {values} GROUP BY variable),
cm AS (SELECT variable, max(n) AS n, avg(power(value - mu, 2)) AS m2, avg(power(value - mu, 3)) AS m3, avg(power(value - mu, 4)) AS m4
  FROM {values} JOIN m USING (variable) GROUP BY variable),
jb AS (SELECT variable, n, m3 / power(m2, 1.5) AS skewness, m4 / (m2 * m2) - 3 AS kurtosis,
  n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4) AS statistic FROM cm)"""


@query(
    "normality_check",
    f"""WITH {ENC}, means AS (SELECT 'mean of 50 prices' AS variable, avg(l_extendedprice) AS value FROM lineitem GROUP BY l_orderkey // 15),
v AS (SELECT variable, value FROM ({long_sql(NUMBERS, 'DOUBLE')}) UNION ALL FROM means), {shape_sql('v')}
SELECT variable, n, round(skewness, 4) AS skewness, round(kurtosis, 4) AS kurtosis, round(statistic, 2) AS statistic,
  round(exp(-statistic / 2), 6) AS p_value, exp(-statistic / 2) > 0.05 AS is_normal FROM jb""",
)
def normality_check(spark, d):
    """Rows' numbers and one that comes close to normal: the mean of many prices."""
    means = table(spark, d, "lineitem").groupBy(F.expr("l_orderkey DIV 15")).agg(F.avg("l_extendedprice").alias("mean of 50 prices"))
    out = comparisons.normality(frame(spark, d), NUMBERS).unionByName(comparisons.normality(means, ["mean of 50 prices"]))
    out = out.withColumn("p_value", F.round("p_value", 6)).withColumn("statistic", F.round("statistic", 2))
    return out.withColumns({c: F.round(c, 4) for c in ("skewness", "kurtosis")})


@query(
    "table_tests",
    f"""WITH {ENC}, {CAT_BLOCK}, e AS (SELECT variable, level, grp, CAST(n AS DOUBLE) AS o, CAST(sum(n) OVER (PARTITION BY variable, level) AS DOUBLE) AS r,
  CAST(sum(n) OVER (PARTITION BY variable, grp) AS DOUBLE) AS k, CAST(sum(n) OVER (PARTITION BY variable) AS DOUBLE) AS t FROM c),
x AS (SELECT variable, max(t) * sum(o * o / (r * k)) - max(t) AS s, (count(DISTINCT level) - 1) * (count(DISTINCT grp) - 1) AS df FROM e GROUP BY variable),
{MEAN_RANKS}, w AS (SELECT variable, value FROM l WHERE value IS NOT NULL), {shape_sql('w')}
SELECT variable, 'chi-square' AS test, round(s, 4) AS statistic, df, round({chi2_sql('s', 'df')}, 6) AS p_value FROM x
UNION ALL SELECT variable, CASE WHEN exp(-statistic / 2) > 0.05 THEN 'anova' ELSE 'kruskal-wallis' END,
  round(CASE WHEN exp(-statistic / 2) > 0.05 THEN f ELSE h END, 4), df1,
  round(CASE WHEN exp(-statistic / 2) > 0.05 THEN {f_sql('f', 'df1', 'df2')} ELSE {chi2_sql('h', 'df1')} END, 6) FROM fh JOIN jb USING (variable)""",
)
def table_tests(spark, d):
    """Test and p-value per variable, the test chosen by the normality check."""
    out = summary.table_results(frame(spark, d), "outcome", CATEGORIES, NUMBERS)["tests"]
    return out.withColumn("statistic", F.round("statistic", 4)).withColumn("p_value", F.round("p_value", 6))


@query(
    "logit",
    f"""{CELLS} SELECT '(intercept)' AS term, round(ln(c / CAST(d AS DOUBLE)), 4) AS estimate, round(sqrt(1.0 / c + 1.0 / d), 4) AS std_error FROM t
UNION ALL SELECT 'small_rural=True', round(ln(a) + ln(d) - ln(b) - ln(c), 4), round(sqrt(1.0 / a + 1.0 / b + 1.0 / c + 1.0 / d), 4) FROM t""",
)
def logit_query(spark, d):
    fitted = logit(frame(spark, d), F.col("transferred"), [Factor("small_rural", (False, True))])
    return rounded(fitted.select("term", "estimate", "std_error"), 4)


@query(
    "logit_separated",
    f"""WITH {ENC}, k AS (SELECT CASE WHEN ed_disp = 1 THEN 'sent home' WHEN line % 2 = 1 THEN 'odd' ELSE 'even' END AS kind, outcome = 'transferred' AS y,
  database FROM enc WHERE outcome IS NOT NULL),
t AS (SELECT CAST(count(*) FILTER (WHERE kind = 'odd' AND y) AS DOUBLE) AS a, CAST(count(*) FILTER (WHERE kind = 'odd' AND NOT y) AS DOUBLE) AS b,
  CAST(count(*) FILTER (WHERE kind = 'even' AND y) AS DOUBLE) AS c, CAST(count(*) FILTER (WHERE kind = 'even' AND NOT y) AS DOUBLE) AS d FROM k)
SELECT 'kind=odd' AS term, round(ln(a) + ln(d) - ln(b) - ln(c), 4) AS estimate, round(sqrt(1 / a + 1 / b + 1 / c + 1 / d), 4) AS std_error, 'ok' AS status FROM t
UNION ALL SELECT '(intercept)', round(ln(c / d), 4), round(sqrt(1 / c + 1 / d), 4), 'ok' FROM t
UNION ALL SELECT 'kind=sent home', NULL, NULL, 'separated' FROM k WHERE kind = 'sent home' HAVING count(*) FILTER (WHERE y) = 0 AND count(*) > 0
UNION ALL SELECT 'kind=none', NULL, NULL, 'no rows'""",
)
def logit_separated(spark, d):
    """A level that never has the outcome, and one without rows, beside levels that are estimated."""
    kind = F.when(F.col("ed_disp") == 1, "sent home").when(F.col("line") % 2 == 1, "odd").otherwise("even")
    fitted = logit(frame(spark, d).withColumn("kind", kind), F.col("transferred"), [Factor("kind", ("even", "odd", "sent home", "none"))])
    return rounded(fitted.select("term", "estimate", "std_error", "status"), 4)


@query(
    "or_table",
    f"""{CELLS}, e AS (SELECT 'small_rural=True' AS term, ln(a) + ln(d) - ln(b) - ln(c) AS b, sqrt(1.0 / a + 1.0 / b + 1.0 / c + 1.0 / d) AS se FROM t
  UNION ALL SELECT '(intercept)', ln(c / CAST(d AS DOUBLE)), sqrt(1.0 / c + 1.0 / d) FROM t)
SELECT term, round(exp(b), 4) AS estimate, '(' || CAST(round(exp(b - 1.959963984540054 * se), 3) AS VARCHAR) || '-'
  || CAST(round(exp(b + 1.959963984540054 * se), 3) AS VARCHAR) || ')' AS conf_int, round(exp(b) * se, 4) AS std_error FROM e""",
)
def or_table_query(spark, d):
    fitted = logit(frame(spark, d), F.col("transferred"), [Factor("small_rural", (False, True))])
    return or_table(fitted).drop("p_value")


TERMS = [
    Factor("small_rural", (False, True)),
    Factor("sex", ("M", "F", "U")),
    Factor("database", ("edd", "pdd"), base="last"),
]


@query(
    "sparse_levels",
    f"""WITH {ENC}, l AS (SELECT 'race_group' AS variable, race_group AS level, outcome = 'transferred' AS y FROM enc
  UNION ALL SELECT 'lang_spoken', lang_spoken, outcome = 'transferred' FROM enc)
SELECT variable, level, count(*) FILTER (WHERE y) AS n_yes, count(*) FILTER (WHERE NOT y) AS n_no FROM l
WHERE (variable = 'race_group' AND level IN ('1', '2', '3')) OR (variable = 'lang_spoken' AND level IN ('ENG', 'RUS'))
GROUP BY ALL HAVING least(count(*) FILTER (WHERE y), count(*) FILTER (WHERE NOT y)) < 2200""",
)
def sparse_levels_query(spark, d):
    factors = [Factor("race_group", ("1", "2", "3")), Factor("lang_spoken", ("ENG", "RUS"))]
    return sparse_levels(frame(spark, d), F.col("transferred"), factors, below=2200)


RESULT = ("estimate", "std_error", "log_lik", "icc", "z", "conf_low", "conf_high", "p_value", "odds_ratio")


def mixed_oracle(tables: str, names: dict[str, int], p: int, where: str = "TRUE", digits: int = 4, printed: tuple = (), **steps) -> str:
    """The rows of the models of ``tables``, which end with the CTE ``pat``; ``printed`` columns as text of three digits."""
    head, rest = marginal_sql(p, **steps).split("k AS (", 1)
    rounds = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN printf('%.2e', {c}) END AS {c}" if c in printed else f"round({c}, {digits}) AS {c}" for c in RESULT
    )
    return f"{head}{tables}, k AS ({rest}, {terms_sql(names, p, chi2_sql)} SELECT * REPLACE ({rounds}) FROM out WHERE {where}"


def pattern_sql(cell: str, group: str, outcome: str, columns: list[str], source: str, where: str) -> str:
    """Rows with and without the outcome per cell, group and pattern of the design columns."""
    x = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(columns))
    keys = ", ".join(f"x{i}" for i in range(len(columns)))
    return f"""SELECT {cell} AS cell, {group} AS grp, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE {outcome}) AS DOUBLE) AS y, {x}
  FROM {source} WHERE {where} GROUP BY ALL"""


MOVED = "outcome = 'transferred'"
MIXED_NAMES = {"(intercept)": 0, "small_rural=True": 1, "sex=F": 2, "sex=U": 3, "database=edd": 4, "discount": 5}
MIXED_COLUMNS = ["1", "small_rural", "sex = 'F'", "sex = 'U'", "database = 'edd'", "discount"]


@query(
    "mixed_logit",
    mixed_oracle(f"{ENC}, pat AS ({pattern_sql(repr('model'), 'oshpd_id', MOVED, MIXED_COLUMNS, 'enc', 'outcome IS NOT NULL')})", MIXED_NAMES, 6).replace(
        "SELECT * REPLACE", "SELECT * EXCLUDE (cell) REPLACE"
    ),
)
def mixed_logit_query(spark, d):
    df = frame(spark, d).filter(contrast("all"))
    return rounded(mixed_logit(df, F.col("transferred"), [*TERMS, Number("discount")], "oshpd_id"), 4)


GROUP_MOVED = "(l_orderkey * 7 + l_linenumber) % 10 < 2 + l_suppkey % 5 + (l_returnflag = 'R')::INT"
SPREAD_COLUMNS = ["1", "l_returnflag = 'R'", "l_discount"]


@query(
    "mixed_logit_spread",
    mixed_oracle(
        f"pat AS ({pattern_sql(repr('model'), 'l_suppkey', GROUP_MOVED, SPREAD_COLUMNS, 'lineitem', 'TRUE')})",
        {"(intercept)": 0, "returned=True": 1, "l_discount": 2},
        3,
        width=0.08,
        climbing=80,
    ).replace("SELECT * REPLACE", "SELECT * EXCLUDE (cell) REPLACE"),
)
def mixed_logit_spread(spark, d):
    """An outcome that does differ between groups, so that the spread, its error and its interval are compared."""
    lines = table(spark, d, "lineitem").withColumn("returned", F.col("l_returnflag") == "R")
    moved = F.expr("(l_orderkey * 7 + l_linenumber) % 10 < 2 + l_suppkey % 5 + CAST(returned AS INT)")
    return rounded(mixed_logit(lines, moved, [Factor("returned", (False, True)), Number("l_discount")], "l_suppkey"), 4)


ICC_CELLS = " UNION ALL ".join(
    pattern_sql(f"'{name}'", "oshpd_id", MOVED, ["1"], "enc", f"outcome IS NOT NULL AND {where}")
    for name, where in (("small rural", "small_rural"), ("other", "NOT small_rural"))
)


@query(
    "icc",
    mixed_oracle(f"{ENC}, pat AS ({ICC_CELLS})", {"(intercept)": 0}, 1, "term = 'sd(intercept)'")
    .replace("SELECT * REPLACE", "SELECT cell, sd, icc, n, n_groups, status FROM (SELECT * EXCLUDE (estimate), round(estimate, 4) AS sd FROM (SELECT * REPLACE")
    + "))",
)
def icc_query(spark, d):
    cells = [Cell("small rural", (F.col("small_rural"),)), Cell("other", (~F.col("small_rural"),))]
    return rounded(icc(frame(spark, d).filter(contrast("all")), F.col("transferred"), "oshpd_id", cells), 4)


STRATA_SQL = {"small rural": "small_rural", "other": "NOT small_rural"}
COHORT_SQL = {
    "all": "TRUE",
    "neonate": "coalesce(age < 1 AND age_days < 28, FALSE)",
    "under 14": "age < 14",
    "low charge": "charge < 40000",
}
CONTRAST_SQL = {"all": "outcome IS NOT NULL", "admitted": "outcome <> 'dc home'", "discharged": "outcome <> 'admitted'"}
EXPOSURE = Factor("discount_high", (False, True))


def grid_frame(spark, d):
    return frame(spark, d).withColumn("discount_high", F.col("discount") > 0.05)


def grid_cells(models=None):
    strata = {n: F.expr(c) for n, c in STRATA_SQL.items()}
    cohorts = {n: None if c == "TRUE" else F.expr(c) for n, c in COHORT_SQL.items()}
    return cross(strata, cohorts, models=models)


CELL_ROWS = " UNION ALL ".join(
    f"SELECT '{s}|{c}|{k}|crude' AS cell, discount > 0.05 AS x, outcome = 'transferred' AS y FROM enc WHERE {sw} AND {cw} AND {kw}"
    for s, sw in STRATA_SQL.items()
    for c, cw in COHORT_SQL.items()
    for k, kw in CONTRAST_SQL.items()
)


@query(
    "contrast_grid",
    f"""WITH {ENC}, r AS ({CELL_ROWS}), t AS (SELECT cell, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE x AND y) AS DOUBLE) AS a,
  CAST(count(*) FILTER (WHERE x AND NOT y) AS DOUBLE) AS b, CAST(count(*) FILTER (WHERE NOT x AND y) AS DOUBLE) AS c,
  CAST(count(*) FILTER (WHERE NOT x AND NOT y) AS DOUBLE) AS d FROM r GROUP BY cell)
SELECT cell, '(intercept)' AS term, n, round(ln(c / d), 4) AS estimate, round(sqrt(1 / c + 1 / d), 4) AS std_error FROM t
UNION ALL SELECT cell, 'discount_high=True', n, round(ln(a) + ln(d) - ln(b) - ln(c), 4), round(sqrt(1 / a + 1 / b + 1 / c + 1 / d), 4) FROM t""",
)
def contrast_grid(spark, d):
    """The crude models of the grid without the hospital effect, which have a closed form."""
    cells = grid_cells({"crude": None})
    fitted = fit_grid(grid_frame(spark, d), F.col("transferred"), [EXPOSURE], cells)
    return rounded(fitted.select("cell", "term", "n", "estimate", "std_error"), 4)


EXPOSED = ["1", "discount > 0.05"]
GRID_CELLS = " UNION ALL ".join(
    pattern_sql(f"'{s}|{c}|{k}|{model}'", "oshpd_id", MOVED, [*EXPOSED, *sex], "enc", f"{sw} AND {cw} AND {kw}")
    for s, sw in STRATA_SQL.items()
    for c, cw in COHORT_SQL.items()
    for k, kw in CONTRAST_SQL.items()
    for model, sex in (("crude", ["0", "0"]), ("adjusted", ["sex = 'F'", "sex = 'U'"]))
)


@query(
    "sensitivity_grid",
    mixed_oracle(
        f"{ENC}, pat AS ({GRID_CELLS})",
        {"(intercept)": 0, "discount_high=True": 1, "sex=F": 2, "sex=U": 3},
        4,
        "NOT (ends_with(cell, 'crude') AND starts_with(term, 'sex'))",
        digits=3,
        printed=("conf_low", "conf_high"),
    ),
)
def sensitivity_grid(spark, d):
    """Two strata × four sub-cohorts × three contrasts × crude and adjusted, fitted together."""
    cells = grid_cells({"crude": (EXPOSURE,), "adjusted": None})
    terms = [EXPOSURE, Factor("sex", ("M", "F", "U"))]
    out = fit_grid(grid_frame(spark, d), F.col("transferred"), terms, cells, "oshpd_id", tol=1e-11)
    # Ends of small cells' intervals go over many orders of magnitude: three digits, wherever they are.
    return rounded(out.withColumns({c: F.when(F.col(c).isNotNull(), F.format_string("%.2e", c)) for c in ("conf_low", "conf_high")}), 3)


@query(
    "ratio_table",
    f"""WITH {ENC}, c AS (SELECT sex AS level, CAST(count(*) FILTER (WHERE outcome = 'transferred') AS DOUBLE) AS a,
  CAST(count(*) FILTER (WHERE outcome <> 'transferred') AS DOUBLE) AS b FROM enc GROUP BY sex), m AS (SELECT a AS ma, b AS mb FROM c WHERE level = 'M'),
e AS (SELECT level, CASE WHEN level = 'M' THEN 0.0 ELSE ln(a) - ln(b) - ln(ma) + ln(mb) END AS est,
  CASE WHEN level <> 'M' THEN sqrt(1 / a + 1 / b + 1 / ma + 1 / mb) END AS se FROM c, m)
SELECT 'sex' AS variable, level, round(est, 6) AS estimate, round(se, 6) AS std_error, round(exp(est), 6) AS odds_ratio,
  round(est - 1.959963984540054 * se, 6) AS conf_low, round(est + 1.959963984540054 * se, 6) AS conf_high FROM e""",
)
def ratio_table_query(spark, d):
    out = ratio_table(frame(spark, d), F.col("transferred"), [Factor("sex", ("M", "F", "U"))])
    return rounded(out.drop("z", "p_value"))


@query(
    "bivariate_table_ungrouped",
    f"""WITH {ENC}, c AS (SELECT variable, value AS level, count(*) AS n FROM ({long_sql(CATEGORIES, 'VARCHAR')}) WHERE value IS NOT NULL GROUP BY ALL),
x AS (SELECT variable, count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS sd, round(quantile_cont(value, 0.25), 4) AS q1,
  round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q3 FROM ({long_sql(NUMBERS, 'DOUBLE')}) GROUP BY ALL)
SELECT variable, level, '[ALL]' AS grp, n, round(100 * n / CAST(sum(n) OVER (PARTITION BY variable) AS DOUBLE), 4) AS pct,
  CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS sd, CAST(NULL AS DOUBLE) AS q1, CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS q3 FROM c
UNION ALL SELECT variable, NULL, '[ALL]', n, NULL, mean, sd, q1, median, q3 FROM x""",
)
def bivariate_table_ungrouped(spark, d):
    return rounded(summary.bivariate_table(frame(spark, d), None, CATEGORIES, NUMBERS), 4)


@query(
    "printed_table",
    f"""WITH {ENC}, {CAT_BLOCK}, w AS (SELECT variable, level, grp,
  format('{{}} ({{:.1f}}%)', n, 100 * n / CAST(sum(n) OVER (PARTITION BY variable, grp) AS DOUBLE)) AS cell FROM c)
SELECT variable, level, max(cell) FILTER (WHERE grp = 'admitted') AS admitted, max(cell) FILTER (WHERE grp = 'transferred') AS transferred
FROM w GROUP BY variable, level""",
)
def printed_table(spark, d):
    out = summary.table_results(frame(spark, d), "outcome", CATEGORIES, missing=False)
    return summary.printed_table(out["table"], out["tests"], ["admitted", "transferred"]).drop("test", "p_value")
