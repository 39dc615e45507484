"""Descriptive tables: column profile, missing values, and the group comparison ("Table 1")."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from cohortry.operators.comparisons import group_tests, long_rows, normality
from cohortry.operators.counts import with_share
from cohortry.operators.order_stats import cut_points, exact_quantiles, range_count

ALL = "[ALL]"
PROFILE = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def missing_table(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Missing count and percentage per variable (and group): one wide aggregation, turned long afterwards."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(columns)]
    wide = (df.groupBy(by) if by else df.groupBy()).agg(F.count(F.lit(1)).alias("_n"), *aggs)
    lines = [
        F.struct(F.lit(c).alias("variable"), F.col("_n").alias("n"), F.col(f"_m{i}").alias("n_missing"))
        for i, c in enumerate(columns)
    ]
    long = wide.select(*([by] if by else []), F.inline(F.array(*lines)))
    return long.withColumn("pct_missing", F.try_divide(F.col("n_missing").cast("double"), F.col("n")) * 100)


def column_summary(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """Profile of every column by type: missing, mean, sd, quantiles; number of levels for text; share for booleans.

    With date or timestamp columns there are also t_p0 to t_p100, their quantiles as timestamps."""
    kinds = {
        name: [f.name for f in df.schema if isinstance(f.dataType, types)]
        for name, types in (
            ("numeric", NumericType),
            ("logical", BooleanType),
            ("text", StringType),
            ("temporal", (DateType, TimestampType, TimestampNTZType)),
        )
    }
    numeric, logical, text, temporal = kinds.values()
    # Times are ranked as microseconds, which doubles hold exactly for some centuries around now.
    seen = df.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in temporal})
    ranked, all_columns = [*numeric, *temporal], [*numeric, *logical, *text, *temporal]
    aggs = {f"_m{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(all_columns)}
    for i, c in enumerate([*numeric, *logical]):
        aggs[f"_a{i}"], aggs[f"_s{i}"] = F.avg(F.col(c).cast("double")), F.stddev_samp(F.col(c).cast("double"))
    sketches = cut_points(ranked, ranges or range_count(df))
    # One pass: counts, moments, and the cut points for the exact quantiles.
    first = seen.agg(F.count(F.lit(1)).alias("_n"), *[a.alias(n) for n, a in aggs.items()], *[c.alias(f"_c{i}") for i, c in enumerate(sketches.values())]).first()
    means = {c: (first[f"_a{i}"], first[f"_s{i}"]) for i, c in enumerate([*numeric, *logical])}
    lines = [(c, first["_n"], first[f"_m{i}"], *(means.get(c) or (None, None))) for i, c in enumerate(all_columns)]
    moments = ", mean double, sd double" if means else ""
    lines = lines if means else [line[:3] for line in lines]
    out = df.sparkSession.createDataFrame(lines, f"variable string, n bigint, n_missing bigint{moments}")
    if ranked:
        cuts = {c: first[f"_c{i}"] for i, c in enumerate(ranked)}
        found = exact_quantiles(seen, ranked, PROFILE, cuts=cuts)
        is_time = F.col("variable").isin(temporal)
        numbers = [F.when(~is_time, F.col(p)).alias(p) for p in PROFILE] if numeric else []
        times = [F.when(is_time, F.timestamp_micros(F.round(p).cast("bigint"))).alias(f"t_{p}") for p in PROFILE] if temporal else []
        out = out.join(found.select("variable", *numbers, *times), "variable", "left")
    if text:
        values = df.select(*text).unpivot([], text, "variable", "value").dropna().distinct()
        out = out.join(values.groupBy("variable").agg(F.count(F.lit(1)).alias("n_levels")), "variable", "left")
    return out


def category_block(
    df: DataFrame, group: str, variables: Sequence[str], include_missing: bool = False, show_all: bool = False
) -> DataFrame:
    """(variable, level, grp, n, pct): counts and column percentages, all variables in one aggregation."""
    text = df.select(F.col(group).cast("string").alias("_grp"), *[F.col(v).cast("string").alias(v) for v in variables])
    long = long_rows(text.filter(F.col("_grp").isNotNull()), ["_grp"], variables, "level").withColumnRenamed("_grp", "grp")
    if not include_missing:
        long = long.filter(F.col("level").isNotNull())
    counts = long.groupBy("variable", "level", "grp").agg(F.count(F.lit(1)).alias("n"))
    if show_all:
        overall = counts.groupBy("variable", "level").agg(F.sum("n").alias("n"))
        counts = counts.unionByName(overall.withColumn("grp", F.lit(ALL)).select(*counts.columns))
    out = with_share(counts, ["variable", "grp"], name="pct")
    return out.withColumn("pct", F.col("pct") * 100)


def number_block(
    df: DataFrame, group: str, variables: Sequence[str], show_all: bool = False, ranges: int | None = None
) -> DataFrame:
    """(variable, grp, n, mean, sd, q1, median, q3) of numeric variables."""
    wide = df.select(F.col(group).cast("string").alias("_grp"), *[F.col(v).cast("double").alias(v) for v in variables])
    wide = wide.filter(F.col("_grp").isNotNull())
    if show_all:
        wide = wide.withColumn("_grp", F.explode(F.array(F.col("_grp"), F.lit(ALL))))
    found = exact_quantiles(wide, variables, QUARTILES, ["_grp"], ranges, moments=True)
    return found.select("variable", F.col("_grp").alias("grp"), F.col("total").alias("n"), "mean", "sd", *QUARTILES)


def bivariate_table(
    df: DataFrame,
    group: str | None,
    categorical: Sequence[str] = (),
    continuous: Sequence[str] = (),
    include_missing: bool = False,
    show_all: bool = False,
) -> DataFrame:
    """All variables by the grouping factor, long: categories as n and column %, numbers as moments and quartiles.
    Without a group every row is in ``[ALL]``."""
    if group is None:
        df, group, show_all = df.withColumn("_all", F.lit(ALL)), "_all", False
    parts = []
    if categorical:
        block = category_block(df, group, categorical, include_missing, show_all)
        nothing = [F.lit(None).cast("double").alias(c) for c in ("mean", "sd", "q1", "median", "q3")]
        parts.append(block.select("variable", "level", "grp", "n", "pct", *nothing))
    if continuous:
        block = number_block(df, group, continuous, show_all)
        level, pct = F.lit(None).cast("string").alias("level"), F.lit(None).cast("double").alias("pct")
        parts.append(block.select("variable", level, "grp", "n", pct, "mean", "sd", "q1", "median", "q3"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def printed_table(
    table: DataFrame, tests: DataFrame, groups: Sequence[str], normal: Sequence[str] = (), hide: Sequence[str] = ()
) -> DataFrame:
    """One text column per group and the p-value: ``n (%)``, ``mean (sd)`` or ``median [q1;q3]``.

    ``hide`` drops these levels (such as ``false``) of the variables that have exactly one other level.
    """
    percent = F.format_string("%d (%.1f%%)", "n", "pct")
    moments = F.format_string("%.2f (%.2f)", "mean", "sd")
    quarts = F.format_string("%.2f [%.2f;%.2f]", "median", "q1", "q3")
    is_normal = F.col("variable").isin(*normal) if normal else F.lit(False)
    cell = F.when(F.col("pct").isNotNull(), percent).when(is_normal, moments).otherwise(quarts)
    wide = table.groupBy("variable", "level").agg(*[F.max(F.when(F.col("grp") == g, cell)).alias(g) for g in groups])
    if hide:
        per_variable = wide.groupBy("variable").agg(F.count("level").alias("_levels"))
        dropped = (F.col("_levels") == 2) & F.coalesce(F.col("level").isin(*hide), F.lit(False))
        wide = wide.join(per_variable, "variable").filter(~dropped).drop("_levels")
    return wide.join(tests.select("variable", "test", "p_value"), "variable", "left").orderBy("variable", "level")


def describe_by(df: DataFrame, group: str, variable: str, include_missing: bool = False) -> DataFrame:
    return category_block(df, group, [variable], include_missing)


def table_results(
    df: DataFrame,
    group: str,
    categorical: Sequence[str] = (),
    continuous: Sequence[str] = (),
    missing: bool = True,
    normal: Sequence[str] | None = None,
    **options: bool,
) -> dict[str, DataFrame]:
    """The table, its tests and the missing-value table. ``normal=None`` decides per number by ``normality``
    (one result row per variable is read back)."""
    if normal is None:
        normal = []
        if continuous:
            normal = [r.variable for r in normality(df, continuous).filter("is_normal").select("variable").collect()]
    out = {
        "table": bivariate_table(df, group, categorical, continuous, **options),
        "tests": group_tests(df, group, categorical, continuous, normal),
    }
    if missing:
        out["missing"] = missing_table(df, [*categorical, *continuous], group)
    return out
