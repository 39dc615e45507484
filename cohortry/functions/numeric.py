"""Ratios, scaling and printed numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(part: Column | str, total: Column | str) -> Column:
    """part / total; NULL when the total is 0."""
    return F.try_divide(_col(part).cast("double"), _col(total).cast("double"))


def percent(part: Column | str, total: Column | str) -> Column:
    return ratio(part, total) * 100


def zscores(df: DataFrame, names: Sequence[str]) -> dict[str, Column]:
    """(x − mean) / sample sd over the whole frame, for several columns from one scalar subquery."""
    parts = [p for n in names for p in (F.avg(n).alias(f"mean_{n}"), F.stddev_samp(n).alias(f"sd_{n}"))]
    stats = df.agg(F.struct(*parts)).scalar()
    return {n: F.try_divide(F.col(n) - stats[f"mean_{n}"], stats[f"sd_{n}"]) for n in names}


def zscore(df: DataFrame, name: str) -> Column:
    return zscores(df, [name])[name]


def scientific(col: Column | str, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}e", _col(col).cast("double"))


def interval_text(low: Column | str, high: Column | str, digits: int = 3) -> Column:
    """``(low-high)``, both rounded."""
    lo, hi = (F.round(_col(c).cast("double"), digits).cast("string") for c in (low, high))
    return F.concat(F.lit("("), lo, F.lit("-"), hi, F.lit(")"))
