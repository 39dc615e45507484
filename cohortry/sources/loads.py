"""Loads into a partitioned table that can be run again: a load replaces its own batches, ids go on from the table's highest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.sources.numbering import number_rows


def highest_id(spark: SparkSession, path: str, id_col: str = "id") -> int:
    """The highest id of the table at ``path``, 0 when there is none yet. Only the id column is read."""
    try:
        ids = spark.read.schema(f"`{id_col}` bigint").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return ids.agg(F.max(id_col)).first()[0] or 0


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write the frame; the partitions it has rows for are replaced as a whole, all others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def load_batches(
    df: DataFrame,
    path: str,
    order: Sequence[Column | str],
    batch: Sequence[str],
    id_col: str = "id",
    row_number: str = "db_row_n",
    from_files: bool = False,
) -> None:
    """Number the rows per batch and put them into the table at ``path``, which is partitioned by batch.

    Ids start behind the highest one of the table, the batches to be replaced included, so no id is given twice, and a load
    that runs again leaves every row once. A batch without rows in the frame stays as it is. One load at a time.
    """
    after = highest_id(df.sparkSession, path, id_col)
    rows = df.drop(id_col, row_number)
    replace_partitions(number_rows(rows, order, batch, row_number, id_col, from_files, after), path, batch)
