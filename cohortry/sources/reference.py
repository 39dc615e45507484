"""Published reference tables (code lists, label lists) in vintages: one file each, valid from a date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators.joins import lookup_join
from cohortry.sources.files import read_lookup_csv
from cohortry.sources.harmonise import union_all


@dataclass(frozen=True)
class Vintage:
    """A published file: its name, where it is, from which date on it holds (None: from the beginning), how its columns are
    called in the table (file name → table name), and how many keys it was published with (None: not checked)."""

    name: str
    path: str
    valid_from: date | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    n_keys: int | None = None


def clean_text(col: Column | str) -> Column:
    """Cell of a published file: quotes, padding and line-end rests off; an empty cell is NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.trim(F.regexp_replace(c, "[\\r\\n'\"]", "")), F.lit(""))


def read_reference(
    spark: SparkSession, vintages: Sequence[Vintage], keys: Sequence[str], values: Sequence[str], on_duplicate: str = "error"
) -> DataFrame:
    """(vintage, keys…, values…) of all files, cleaned. An empty key, a repeated key (unless ``on_duplicate="all"`` keeps all its
    rows) or a wrong number of keys is an error that names the vintage. All files are checked in one aggregation."""
    if on_duplicate not in ("error", "all"):
        raise ValueError(f"on_duplicate is 'error' or 'all', not {on_duplicate!r}")
    if len({v.name for v in vintages}) < len(vintages):
        raise ValueError("vintage names repeat")
    parts = []
    for v in vintages:
        raw = read_lookup_csv(spark, v.path, rename=v.rename)
        lacking = {*keys, *values} - set(raw.columns)
        if lacking:
            raise ValueError(f"{v.name}: no column {sorted(lacking)} among {raw.columns}")
        parts.append(raw.select(F.lit(v.name).alias("vintage"), *[clean_text(c).alias(c) for c in (*keys, *values)]))
    out = union_all(parts)
    check_keys(out, keys, {v.name: v.n_keys for v in vintages}, on_duplicate == "all")
    return out


def check_keys(table: DataFrame, keys: Sequence[str], expected: Mapping[str, int | None], may_repeat: bool = False) -> None:
    filled = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = table.groupBy("vintage", *keys).agg(F.count(F.lit(1)).alias("n"))
    seen = per_key.groupBy("vintage").agg(
        F.count_if(~filled).alias("empty"), F.count_if(F.col("n") > 1).alias("repeated"), F.count(F.lit(1)).alias("keys")
    )
    found = {r["vintage"]: r for r in seen.collect()}
    for name, n_keys in expected.items():
        r = found.get(name) or {"empty": 0, "repeated": 0, "keys": 0}
        if r["empty"] or (r["repeated"] and not may_repeat):
            raise ValueError(f"{name}: {r['empty']} empty and {r['repeated']} repeated keys {list(keys)}")
        if n_keys not in (None, r["keys"]):
            raise ValueError(f"{name}: {r['keys']} keys, published with {n_keys}")


def vintage_at(day: Column | str, vintages: Sequence[Vintage]) -> Column:
    """Name of the vintage that holds on a day: the latest that began by then. NULL before the first one; an unknown day
    finds only a vintage that holds from the beginning."""
    d = F.col(day) if isinstance(day, str) else day
    out = F.lit(None).cast("string")
    for v in sorted(vintages, key=lambda v: v.valid_from or date.min):
        holds = F.lit(True) if v.valid_from is None else d >= F.lit(v.valid_from)
        out = F.when(holds, F.lit(v.name)).otherwise(out)
    return out


def label_at(
    df: DataFrame,
    table: DataFrame,
    vintages: Sequence[Vintage],
    day: Column | str,
    on: Mapping[str, str],
    values: Mapping[str, str],
    on_duplicate: str = "error",
) -> DataFrame:
    """Look every row up in the vintage of its day: ``on`` maps the table's keys to columns of the rows, ``values`` the table's
    values to the new columns. One join by (vintage, keys); rows without a match get NULL."""
    keyed = df.withColumns({"_vintage": vintage_at(day, vintages), **{f"_k_{k}": F.col(c).cast("string") for k, c in on.items()}})
    keyed = keyed.withColumns({f"_k_{k}": F.trim(F.col(f"_k_{k}")) for k in on})
    side = table.select(
        F.col("vintage").alias("_vintage"), *[F.col(k).alias(f"_k_{k}") for k in on], *[F.col(v).alias(n) for v, n in values.items()]
    )
    return lookup_join(keyed, side, ["_vintage", *[f"_k_{k}" for k in on]], on_duplicate).drop("_vintage", *[f"_k_{k}" for k in on])
