"""Choosing, naming and mapping columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


def matching(
    df: DataFrame, starts: str | None = None, ends: str | None = None, regex: str | None = None
) -> list[str]:
    """Column names with the given prefix, suffix and/or pattern."""
    return [
        c
        for c in df.columns
        if (starts is None or c.startswith(starts))
        and (ends is None or c.endswith(ends))
        and (regex is None or re.search(regex, c))
    ]


def select_by_pattern(
    df: DataFrame, keep: Sequence[str] = (), starts: str | None = None, ends: str | None = None,
    regex: str | None = None, drop: bool = False,
) -> DataFrame:
    """Keep (or drop) the columns matching the pattern; columns in ``keep`` stay in front either way."""
    hit = set(matching(df, starts, ends, regex))
    return df.select(*keep, *[c for c in df.columns if c not in keep and (c in hit) != drop])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """old → new."""
    return df.withColumnsRenamed(dict(names))


def prefix_lower_names(df: DataFrame, prefix: str, keep: Sequence[str] = (), lower: bool = True) -> DataFrame:
    return df.toDF(*[c if c in keep else prefix + (c.lower() if lower else c) for c in df.columns])


def suffix_names(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.toDF(*[c if c in keep else c + suffix for c in df.columns])


def derive_columns(df: DataFrame, *layers: Mapping[str, Column]) -> DataFrame:
    """Add columns in layers; a layer may use the columns of the layers before it."""
    for layer in layers:
        df = df.withColumns(dict(layer))
    return df


def map_columns(df: DataFrame, fn: Callable[[Column], Column], kind: type[DataType] | None = None) -> DataFrame:
    """Apply a function to all columns, or to those of one type (``NumericType``, ``BooleanType``, …)."""
    return df.select(
        *[fn(F.col(f.name)).alias(f.name) if kind is None or isinstance(f.dataType, kind) else F.col(f.name) for f in df.schema]
    )


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def set_columns(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Constants, copies and expressions over the whole frame."""
    return df.withColumns({c: v if isinstance(v, Column) else F.lit(v) for c, v in values.items()})


def reorder_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    return df.select(*first, *[c for c in df.columns if c not in first])


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"columns not in the frame: {absent}")
    return df


def dims(df: DataFrame) -> DataFrame:
    """One row: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))

