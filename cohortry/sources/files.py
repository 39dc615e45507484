"""Reading and writing files: typed CSV loads, lookup CSVs, Parquet and result exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortry.functions.text import safe_cast


def read_typed_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """Headed CSV with declared types; a row that does not fit them stops the job."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(paths)


def read_lookup_csv(
    spark: SparkSession, path: str, types: Mapping[str, str] | None = None, rename: Mapping[str, str] | None = None
) -> DataFrame:
    """Small headed CSV: all text first, byte-order mark and odd name characters cleaned, then the named casts."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    clean = raw.toDF(*[c.lstrip("﻿").strip().strip("'\"").replace(".", "_").replace(" ", "_") for c in raw.columns])
    clean = clean.withColumnsRenamed(dict(rename or {}))
    types = types or {}
    return clean.select(*[safe_cast(c, types[c]).alias(c) if c in types else F.col(c) for c in clean.columns])


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """``single_file`` is for result tables of a few rows."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_columnar(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_columnar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def drop_leading_rows(df: DataFrame, id_col: str, to: str = "long") -> DataFrame:
    """Drop description rows under the header: files have no stable row order, so test the id instead."""
    return df.filter(safe_cast(id_col, to).isNotNull())


def label_columns(df: DataFrame, id_col: str, to: str = "long") -> DataFrame:
    """Take the (one) description row as column labels, kept in the metadata, and drop it from the data."""
    first = df.filter(safe_cast(id_col, to).isNull()).limit(1).collect()
    labels = first[0].asDict() if first else {}
    data = drop_leading_rows(df, id_col, to)
    return data.select(*[F.col(c).alias(c, metadata={"label": labels.get(c)}) for c in df.columns])
