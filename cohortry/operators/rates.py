"""Per-hospital rates: every measure is a conditional count in one aggregation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.numeric import ratio

# Control groups of the transfer rate: which rows count. An unknown outcome counts in ALL only.
CONTROLS = ("ALL", "ADMIT", "DC")


def _control(control: str, outcome: Column) -> Column:
    return {"ALL": F.lit(True), "ADMIT": outcome != "dc home", "DC": outcome != "admitted"}[control]


def _within(subset: Column | None, cond: Column) -> Column:
    return cond if subset is None else subset & cond


def group_rate(df: DataFrame, by: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows meeting each condition ÷ all rows of the group."""
    counts = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(f"_{n}") for n, c in conditions.items()]
    )
    return counts.select(by, "total", *[ratio(f"_{n}", "total").alias(n) for n in conditions])


def _transfer_counts(subset: Column | None, prefix: str, outcome: Column) -> list[Column]:
    out = []
    for control in CONTROLS:
        rows = _within(subset, _control(control, outcome))
        moved = _within(subset, _control(control, outcome) & (outcome == "transferred"))
        out += [
            F.count_if(rows).alias(f"{prefix}{control}_total"),
            F.count_if(moved).alias(f"{prefix}{control}_transferred_total"),
        ]
    return out


def _transfer_columns(prefix: str) -> list[Column]:
    """A hospital without a row in a control group has NULL there, not 0."""
    out = []
    for control in CONTROLS:
        total, moved = f"{prefix}{control}_total", f"{prefix}{control}_transferred_total"
        out += [
            F.nullif(F.col(total), F.lit(0)).alias(total),
            F.when(F.col(total) > 0, F.col(moved)).alias(moved),
            ratio(moved, total).alias(f"{prefix}{control}_transferred_rf"),
        ]
    return out


def transfer_rates(df: DataFrame, by: str, outcome: str = "outcome", prefix: str = "hf_") -> DataFrame:
    """Total, transferred and rate per hospital against all, admitted-only and discharged-only controls."""
    counts = df.groupBy(by).agg(*_transfer_counts(None, prefix, F.col(outcome)))
    return counts.select(by, *_transfer_columns(prefix))


def hospital_profile(
    df: DataFrame,
    by: str,
    conditions: Mapping[str, Column],
    subsets: Mapping[str, Column | None],
    outcome: str = "outcome",
    prefix: str = "hf_",
) -> DataFrame:
    """Group rates and the three transfer blocks, for several row subsets, in one ``groupBy``.

    ``subsets`` maps a name prefix (``""``, ``"ei_"``) to the rows it takes (None = all).
    """
    aggs: list[Column] = []
    for tag, subset in subsets.items():
        p = prefix + tag
        aggs.append((F.count(F.lit(1)) if subset is None else F.count_if(subset)).alias(f"_{p}n"))
        aggs += [F.count_if(_within(subset, c)).alias(f"_{p}{n}") for n, c in conditions.items()]
        aggs += _transfer_counts(subset, p, F.col(outcome))
    counts = df.groupBy(by).agg(*aggs)
    out: list[Column] = [F.col(by)]
    for tag in subsets:
        p = prefix + tag
        out += [ratio(f"_{p}{n}", f"_{p}n").alias(p + n) for n in conditions]
        out += _transfer_columns(p)
    return counts.select(*out)
