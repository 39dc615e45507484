"""Lookup joins. The lookup key is checked to be unique first, so a join never multiplies the facts unless it is asked to:
``on_duplicate="all"`` gives a row per match, as a left join in SQL does."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from cohortry.session import BROADCAST_ROWS, broadcast_if_small
from cohortry.sources.numbering import number_rows


ON_DUPLICATE = ("error", "first", "all")


def key_counts(lookup: DataFrame, keys: Sequence[str]) -> Row:
    """(most, keys, rows) of a lookup: rows of the most frequent key, number of keys, number of rows."""
    per_key = lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
    ).first()


def count_keys(lookup: DataFrame, keys: Sequence[str]) -> int:
    """Number of keys of a lookup; a repeated one is an error."""
    seen = key_counts(lookup, keys)
    if seen["most"] > 1:
        per_key = lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        raise ValueError(f"lookup key {list(keys)} repeats, e.g. {per_key.filter('n > 1').first()}")
    return seen["keys"]


def first_per_key(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest, so the choice does not depend on row order."""
    rest = [c for c in lookup.columns if c not in keys]
    one = lookup.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_v"))
    return one.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in rest])


def unique_key(lookup: DataFrame, keys: Sequence[str], on_duplicate: str = "error") -> DataFrame:
    """A lookup with one row per key (all rows of a key with ``all``), hinted for broadcast when the row count allows it."""
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate is one of {ON_DUPLICATE}, not {on_duplicate!r}")
    if on_duplicate == "all":
        return broadcast_if_small(lookup)
    if on_duplicate == "first":
        return broadcast_if_small(first_per_key(lookup, keys))
    return F.broadcast(lookup) if count_keys(lookup, keys) <= BROADCAST_ROWS else lookup


def lookup_join(
    df: DataFrame, lookup: DataFrame, keys: str | Sequence[str], on_duplicate: str = "error", null_safe: bool = False
) -> DataFrame:
    """Left join on equal names. ``null_safe`` lets a NULL key find a NULL key.

    A repeated lookup key is an error; ``on_duplicate="first"`` takes its smallest row, ``"all"`` gives a row for each."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    small = unique_key(lookup, keys, on_duplicate)
    if not null_safe:
        return df.join(small, keys, "left")
    renamed = small.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(renamed, same, "left").drop(*[f"_k_{k}" for k in keys])


def full_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return left.join(right, keys, "full_outer")


def recode_update(df: DataFrame, column: str, code_map: DataFrame) -> DataFrame:
    """Replace values by a (from, to) frame; values without a match stay."""
    pairs = code_map.select(F.col("from").alias(column), F.col("to").alias("_to"))
    joined = lookup_join(df, pairs, column)
    return joined.withColumn(column, F.coalesce(F.col("_to"), F.col(column))).select(*df.columns)


def update_join(df: DataFrame, other: DataFrame, key: str, assign: dict[str, str]) -> DataFrame:
    """Set columns from a matching row of the other frame: {column: other's column}; no match, no change."""
    source = other.select(key, *[F.col(v).alias(f"_new_{c}") for c, v in assign.items()], F.lit(True).alias("_hit"))
    joined = lookup_join(df, source, key)
    return joined.withColumns(
        {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in assign}
    ).select(*df.columns)


def side_by_side(df: DataFrame, col1: str, col2: str) -> DataFrame:
    """Two frequency tables next to each other, both from the rarest value up (a check on a recode)."""

    def ranked(name: str, tag: str) -> DataFrame:
        counts = df.groupBy(F.col(name).alias(f"value{tag}")).agg(F.count(name).alias(f"n{tag}"))
        order = [F.col(f"n{tag}"), F.col(f"value{tag}").asc_nulls_first()]
        return number_rows(counts, order, row_number="position")

    return ranked(col1, "1").join(ranked(col2, "2"), "position", "full_outer")


def join_aggregates(base: DataFrame, facts: DataFrame, key: str, **measures) -> DataFrame:
    """All measures of a key in one aggregation, joined once."""
    return base.join(facts.groupBy(key).agg(*[m.alias(n) for n, m in measures.items()]), key, "left")
