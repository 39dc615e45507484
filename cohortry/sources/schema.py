"""Table schemas from a column specification."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Column types of the specification and their Spark names.
SPEC_TYPES = {
    "int": "int",
    "integer": "int",
    "smallint": "int",
    "bigint": "bigint",
    "float": "double",
    "numeric": "double",
    "text": "string",
    "varchar": "string",
    "char": "string",
    "date": "date",
}


def spec_entry(entry: str) -> str:
    """One ``name TYPE`` entry of the specification as Spark DDL."""
    name, kind = entry.split(None, 1)
    base = re.sub(r"\(.*\)", "", kind).strip().lower()
    return f"`{name}` {SPEC_TYPES[base]}"


def schema_from_spec(spec: DataFrame, types_col: str, exclude: Sequence[str] = ()) -> StructType:
    """The schema of one vintage. The specification has one row per column, in order of ``position``."""
    rows = spec.filter(F.col(types_col).isNotNull()).orderBy("position").select(types_col).collect()
    entries = [r[0] for r in rows if r[0].split(None, 1)[0] not in exclude]
    return StructType.fromDDL(", ".join(map(spec_entry, entries)))


def column_order(spec: DataFrame, names_col: str, exclude: Sequence[str] = ()) -> list[str]:
    rows = spec.filter(F.col(names_col).isNotNull()).orderBy("position").select(names_col).collect()
    return [r[0] for r in rows if r[0] not in exclude]
