"""Catalog work: create, append, snapshot, rename, drop, list; and audited loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def run_sql(spark: SparkSession, text: str, frames: Mapping[str, DataFrame] | None = None, **args: Any) -> DataFrame:
    """SQL text with named parameters (``:name``) over frames given by name (``{name}``)."""
    return spark.sql(text, args=args or None, **(frames or {}))


def create_table(
    spark: SparkSession, name: str, schema: StructType, path: str | None = None, partition_by: Sequence[str] = ()
) -> None:
    writer = spark.createDataFrame([], schema).write.format("parquet").mode("errorifexists").partitionBy(*partition_by)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_subset(df: DataFrame, table: str, columns: Sequence[str], where: Column | str) -> None:
    """Append the named columns of the rows passing the predicate; by name, never by position."""
    target = df.sparkSession.table(table).columns
    part = df.filter(where).select(*columns)
    part.select(*[F.col(c) for c in target]).write.mode("append").insertInto(table)


def write_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> None:
    writer = df.write.format("parquet").mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def snapshot_table(
    spark: SparkSession, source: str, name: str, where: Column | str | None = None, path: str | None = None
) -> None:
    """Copy a table, or the rows of it that pass a predicate, to a new one."""
    df = spark.table(source)
    write_table(df if where is None else df.filter(where), name, path, mode="errorifexists")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    quoted = [".".join("`" + part.replace("`", "``") + "`" for part in name.split(".")) for name in (old, new)]
    spark.sql(f"ALTER TABLE {quoted[0]} RENAME TO {quoted[1]}")


def list_tables(spark: SparkSession, pattern: str | None = None) -> DataFrame:
    names = [(t.name,) for t in spark.catalog.listTables(pattern=pattern) if not t.isTemporary]
    return spark.createDataFrame(names, "table_name string")


def table_scan(
    df: DataFrame, where: Column | str, columns: Sequence[str], rename: Mapping[str, str] | None = None
) -> DataFrame:
    """Filter, project, rename: lazily, so that both reach the scan."""
    return df.filter(where).select(*columns).withColumnsRenamed(dict(rename or {}))


def audited_append(df: DataFrame, table: str, columns: Sequence[str], where: Column | str) -> dict[str, int]:
    """Append and count what was staged and appended in the same pass; the target is counted by its footers."""
    spark = df.sparkSession
    before = spark.table(table).count()
    staged, appended = Observation("staged"), Observation("appended")
    target = spark.table(table).columns
    part = df.observe(staged, F.count(F.lit(1)).alias("n")).filter(where).select(*columns)
    part = part.select(*target).observe(appended, F.count(F.lit(1)).alias("n"))
    part.write.mode("append").insertInto(table)
    return {
        "stage_rows": staged.get["n"],
        "appended_rows": appended.get["n"],
        "target_before": before,
        "target_after": spark.table(table).count(),
    }
