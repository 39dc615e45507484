"""Tests of a variable against a grouping factor. Spark reduces the rows to counts and moments; the statistic
is arithmetic on those few rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions import tails
from cohortry.operators.order_stats import rank_sums
from cohortry.session import stored


def long_rows(wide: DataFrame, keep: Sequence[str], variables: Sequence[str], name: str) -> DataFrame:
    """(keep…, variable, name): one row per row and variable. Generated rows, not an unpivot: a plan with an expansion in it is not
    recognised as the same when a later aggregation reads its result twice, and the facts would be scanned again."""
    lines = [F.struct(F.lit(v).alias("variable"), F.col(v).alias(name)) for v in variables]
    return wide.select(*keep, F.inline(F.array(*lines)))


def _long_categories(df: DataFrame, group: str, variables: Sequence[str]) -> DataFrame:
    text = df.select(F.col(group).cast("string").alias("grp"), *[F.col(v).cast("string").alias(v) for v in variables])
    return long_rows(text, ["grp"], variables, "level")


def chi_square(df: DataFrame, group: str, variables: Sequence[str]) -> DataFrame:
    """Pearson's test of each variable against the group: N·Σ O²/(R·C) − N over the filled cells."""
    cells = (
        _long_categories(df, group, variables)
        .dropna(subset=["grp", "level"])
        .groupBy("variable", "level", "grp")
        .agg(F.count(F.lit(1)).alias("o"))
    )
    # Read five times below; the rows only once.
    cells = stored(cells, "cells")
    rows = cells.groupBy("variable", "level").agg(F.sum("o").alias("r"))
    cols = cells.groupBy("variable", "grp").agg(F.sum("o").alias("c"))
    o, r, c = (F.col(x).cast("double") for x in ("o", "r", "c"))
    parts = cells.join(rows, ["variable", "level"]).join(cols, ["variable", "grp"])
    shape = rows.groupBy("variable").agg(F.count(F.lit(1)).alias("n_levels"), F.sum("r").alias("n"))
    groups = cols.groupBy("variable").agg(F.count(F.lit(1)).alias("n_groups"))
    stat = parts.groupBy("variable").agg(F.sum(o * o / (r * c)).alias("s")).join(shape, "variable").join(groups, "variable")
    out = stat.select(
        "variable",
        "n",
        (F.col("n") * F.col("s") - F.col("n")).alias("statistic"),
        ((F.col("n_levels") - 1) * (F.col("n_groups") - 1)).alias("df"),
    )
    p = F.when(F.col("df") > 0, tails.p_value(tails.chi2_upper, "statistic", "df"))
    return out.withColumn("p_value", p)


def two_by_two(df: DataFrame, outcome: Column, exposure: Column) -> DataFrame:
    """a, b, c, d: exposed with/without the outcome, then unexposed; unknown in either drops the row."""
    return df.agg(
        F.count_if(exposure & outcome).alias("a"),
        F.count_if(exposure & ~outcome).alias("b"),
        F.count_if(~exposure & outcome).alias("c"),
        F.count_if(~exposure & ~outcome).alias("d"),
    )


def fisher_exact(table: DataFrame) -> DataFrame:
    return table.withColumn("p_value", tails.p_value(tails.fisher_two_sided, "a", "b", "c", "d"))


def odds_ratio(table: DataFrame, z: float = 1.959963984540054) -> DataFrame:
    """Crude odds ratio with the log-normal interval; NULL when a needed cell is empty."""
    a, b, c, d = (F.nullif(F.col(x).cast("double"), F.lit(0.0)) for x in "abcd")
    log_or = F.ln(a) + F.ln(d) - F.ln(b) - F.ln(c)
    se = F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    return table.withColumns({"log_or": log_or, "std_error": se}).withColumns(
        {
            "odds_ratio": F.exp("log_or"),
            "conf_low": F.exp(F.col("log_or") - z * F.col("std_error")),
            "conf_high": F.exp(F.col("log_or") + z * F.col("std_error")),
        }
    )


def _long_numbers(df: DataFrame, group: str | None, variables: Sequence[str]) -> DataFrame:
    keep = [F.col(group).cast("string").alias("grp")] if group else []
    wide = df.select(*keep, *[F.nullif(F.col(v).cast("double"), F.lit(float("nan"))).alias(v) for v in variables])
    return long_rows(wide, ["grp"] if group else [], variables, "value")


def group_moments(df: DataFrame, group: str, variables: Sequence[str]) -> DataFrame:
    return (
        _long_numbers(df, group, variables)
        .groupBy("variable", "grp")
        .agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    )


def anova(df: DataFrame, group: str, variables: Sequence[str]) -> DataFrame:
    """One-way analysis of variance; with two groups it is the pooled t-test (F = t²)."""
    cells = group_moments(df, group, variables).filter(F.col("grp").isNotNull() & (F.col("n") > 0))
    n, m = F.col("n").cast("double"), F.col("mean")
    # Deviations from the grand mean: sums of squares would cancel on values far from zero.
    each = Window.partitionBy("variable")
    cells = cells.withColumn("grand", F.sum(n * m).over(each) / F.sum(n).over(each))
    sums = cells.groupBy("variable").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum(n * (m - F.col("grand")) * (m - F.col("grand"))).alias("between"),
        F.sum((n - 1) * F.coalesce("sd", F.lit(0.0)) * F.coalesce("sd", F.lit(0.0))).alias("within"),
    )
    out = sums.select(
        "variable",
        "n",
        F.try_divide(F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k"))).alias(
            "statistic"
        ),
        (F.col("k") - 1).alias("df1"),
        (F.col("n") - F.col("k")).alias("df2"),
    )
    return out.withColumn("p_value", tails.p_value(tails.f_upper, "statistic", "df1", "df2"))


def kruskal_wallis(df: DataFrame, group: str, variables: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Rank test with the tie correction."""
    sums = rank_sums(df, variables, group, ranges)
    sums = sums.withColumn("total", F.sum("n").over(Window.partitionBy("variable")))
    # Distance of each group's mean rank from the middle one: squares of the rank sums would cancel on many rows.
    off = F.col("rank_sum") / F.col("n") - (F.col("total") + 1) / 2
    per_var = sums.groupBy("variable").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * off * off).alias("q"), F.sum("ties").alias("ties")
    )
    total = F.col("n").cast("double")
    h = 12 / (total * (total + 1)) * F.col("q")
    correction = 1 - F.try_divide(F.col("ties").cast("double"), total * total * total - total)
    out = per_var.select(
        "variable", "n", F.try_divide(h, correction).alias("statistic"), (F.col("k") - 1).alias("df")
    )
    return out.withColumn("p_value", tails.p_value(tails.chi2_upper, "statistic", "df"))


def normality(df: DataFrame, variables: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Jarque–Bera from skewness and excess kurtosis in one pass; normal when p is above alpha."""
    moments = (
        _long_numbers(df, None, variables)
        .groupBy("variable")
        .agg(F.count("value").alias("n"), F.skewness("value").alias("skewness"), F.kurtosis("value").alias("kurtosis"))
    )
    s, k = F.col("skewness"), F.col("kurtosis")
    stat = F.col("n") / 6 * (s * s + k * k / 4)
    return moments.withColumn("statistic", stat).withColumns(
        {"p_value": F.exp(-F.col("statistic") / 2), "is_normal": F.exp(-F.col("statistic") / 2) > alpha}
    )


def group_tests(
    df: DataFrame, group: str, categorical: Sequence[str] = (), continuous: Sequence[str] = (), normal: Sequence[str] = ()
) -> DataFrame:
    """One line per variable: chi-square for categories, ANOVA for normal and ranks for other numbers."""
    cols = ["variable", "test", "statistic", "df", "p_value"]
    parts = []
    if categorical:
        parts.append(chi_square(df, group, categorical).withColumn("test", F.lit("chi-square")).select(*cols))
    as_normal = [v for v in continuous if v in normal]
    if as_normal:
        parts.append(
            anova(df, group, as_normal).withColumnRenamed("df1", "df").withColumn("test", F.lit("anova")).select(*cols)
        )
    others = [v for v in continuous if v not in normal]
    if others:
        parts.append(kruskal_wallis(df, group, others).withColumn("test", F.lit("kruskal-wallis")).select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

