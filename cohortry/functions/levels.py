"""Ordered categories: a string column whose level order travels in the column metadata."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def factor(col: Column | str, name: str, levels: Sequence[Any], labels: Sequence[str] | None = None) -> Column:
    """Keep listed values (relabelled if ``labels`` is given), turn all others into NULL, remember the order."""
    c = F.col(col) if isinstance(col, str) else col
    labels = [str(v) for v in levels] if labels is None else list(labels)
    out = F.lit(None).cast("string")
    for level, label in reversed(list(zip(levels, labels))):
        out = F.when(c == F.lit(level), F.lit(label)).otherwise(out)
    return out.alias(name, metadata={"levels": list(dict.fromkeys(labels))})


def flag_factor(flag: Column | str, name: str, true_first: bool = False) -> Column:
    """A boolean as a category of the texts FALSE and TRUE."""
    c = F.col(flag) if isinstance(flag, str) else flag
    return factor(F.upper(c.cast("string")), name, ["TRUE", "FALSE"] if true_first else ["FALSE", "TRUE"])


def levels_of(df: DataFrame, name: str) -> list[str]:
    levels = df.schema[name].metadata.get("levels")
    if levels is None:
        raise ValueError(f"column {name} carries no levels")
    return levels


def level_code(name: str, levels: Sequence[str]) -> Column:
    """1-based position of the value among the levels; NULL outside them."""
    out = F.lit(None).cast("int")
    for i, level in reversed(list(enumerate(levels, start=1))):
        out = F.when(F.col(name) == F.lit(level), F.lit(i)).otherwise(out)
    return out


def relevel(levels: Sequence[str], base: str | int) -> list[str]:
    """Move the reference level (a label, a 1-based position, or ``"last"``) to the front."""
    levels = list(levels)
    if isinstance(base, int):
        base = levels[base - 1]
    elif base == "last" and "last" not in levels:
        base = levels[-1]
    if base not in levels:
        raise ValueError(f"{base!r} is not one of {levels}")
    return [base, *[v for v in levels if v != base]]
