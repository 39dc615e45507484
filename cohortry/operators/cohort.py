"""Cohort definition: filters, flags, strata and attrition."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.session import broadcast_if_small


def keep_rows(df: DataFrame, where: Column | str) -> DataFrame:
    """Rows where the predicate is true; unknown drops. A text predicate is SQL."""
    return df.filter(where)


def limit_rows(df: DataFrame, n: int, order_by: Sequence[Column | str] = ()) -> DataFrame:
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def ed_arrival_cohort(df: DataFrame) -> DataFrame:
    """Every emergency row, and an inpatient row only if it came through the hospital's own emergency room."""
    own_ed = (F.col("database") == "pdd") & (F.col("ip_source_route") == 1)
    return df.filter((F.col("database") == "edd") | own_ed)


def complete_cases(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(names))


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct()


def semi_join_filter(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the other frame."""
    return df.join(other.select(key).distinct(), key, "left_semi")


def membership_flag(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """Boolean, never NULL: does the key occur in the other frame?"""
    keys = other.select(F.col(key).alias("_member")).filter(F.col("_member").isNotNull()).distinct()
    joined = df.join(broadcast_if_small(keys), F.col(key) == F.col("_member"), "left")
    return joined.withColumn(name, F.col("_member").isNotNull()).drop("_member")


def attrition(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left after each exclusion, all steps in one pass: (step, label, n, dropped)."""
    passed = [reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for _, p in steps[: i + 1]]) for i in range(len(steps))]
    counts = df.agg(
        F.count(F.lit(1)).alias("n0"), *[F.count_if(p).alias(f"n{i}") for i, p in enumerate(passed, start=1)]
    )
    labels = ["all", *[label for label, _ in steps]]
    rows = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(label).alias("label"),
            F.col(f"n{i}").alias("n"),
            (F.col(f"n{max(i - 1, 0)}") - F.col(f"n{i}")).alias("dropped"),
        )
        for i, label in enumerate(labels)
    ]
    return counts.select(F.inline(F.array(*rows)))


def apply_steps(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [p for _, p in steps]))


def stratify(df: DataFrame, strata: Sequence[tuple[str, Column]], name: str = "stratum") -> DataFrame:
    """One row per stratum a row belongs to (strata may overlap), so that operators group by it in one pass."""
    labels = F.array_compact(F.array(*[F.when(where, F.lit(label)) for label, where in strata]))
    return df.select("*", F.explode(labels).alias(name))
