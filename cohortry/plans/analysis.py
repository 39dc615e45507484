"""From encounters and hospitals to the analysis cohort and the model extract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.levels import level_code, levels_of
from cohortry.operators.cohort import apply_steps, attrition
from cohortry.operators.joins import lookup_join
from cohortry.operators.projection import require_columns
from cohortry.session import checkpointed


def study_steps() -> list[tuple[str, Column]]:
    """Exclusions in order."""
    return [
        ("not injured", ~F.col("ccs_injury_any")),
        ("known outcome", F.col("outcome").isNotNull()),
        ("not Medicare", F.col("insurance2") != "Medicare"),
        ("survey answered", F.col("pr_responded")),
        ("not all-or-none hospital", ~F.col("hf_all_none")),
    ]


def all_none_flags(encounters: DataFrame, key: str = "oshpd_id") -> DataFrame:
    """Hospitals that transfer all or none of their severe cases, over all rows and over the non-injured ones."""

    def flag(rows: Column) -> Column:
        admitted = F.count_if(rows & (F.col("outcome") == "admitted"))
        transferred = F.count_if(rows & (F.col("outcome") == "transferred"))
        return (admitted == 0) | (transferred == 0)

    return encounters.groupBy(key).agg(
        flag(F.lit(True)).alias("hf_all_none"), flag(~F.col("ccs_injury_any")).alias("hf_all_none_ei")
    )


def analysis_cohort(encounters: DataFrame, hospitals: DataFrame, key: str = "oshpd_id") -> tuple[DataFrame, DataFrame]:
    """(cohort, attrition): hospitals seen in the encounters, all-or-none flag, join, exclusions.

    The hospital side is small but derived from the encounters, so it is checkpointed once before the join.
    """
    present = checkpointed(hospitals.join(all_none_flags(encounters, key), key))
    joined = lookup_join(encounters, present, key)
    return apply_steps(joined, study_steps()), attrition(joined, study_steps())


def analysis_extract(
    df: DataFrame, columns: Sequence[str], factors: Mapping[str, Sequence[str]] | None = None, id_col: str | None = None
) -> DataFrame:
    """The model columns: categories as 1-based level codes (``<name>_code``), the id as a number, no dots in names.

    Level orders come from ``factors`` or from the column metadata.
    """
    require_columns(df, columns)
    out: list[Column] = []
    for c in columns:
        name = c.replace(".", "_")
        if factors and c in factors:
            out += [F.col(c).alias(name), level_code(c, factors[c]).alias(f"{name}_code")]
        elif "levels" in df.schema[c].metadata:
            out += [F.col(c).alias(name), level_code(c, levels_of(df, c)).alias(f"{name}_code")]
        elif c == id_col:
            out.append(F.col(c).cast("int").alias(name))
        else:
            out.append(F.col(f"`{c}`").alias(name))
    return df.select(*out)
