"""Row numbers over a total order without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from cohortry.session import broadcast_if_small, compiled, stored

# monotonically_increasing_id keeps the position inside the partition in its lower 33 bits.
POSITION_BITS = 33


def number_rows(
    df: DataFrame,
    order: Sequence[Column | str],
    batch: Sequence[str] = (),
    row_number: str = "db_row_n",
    running_id: str | None = None,
    from_files: bool = False,
    after: int = 0,
) -> DataFrame:
    """Row number per batch in the given order, and optionally one running id over all batches that starts behind ``after``.

    The rows are range-partitioned over batch and order (the scan position breaks ties, so equal keys still
    spread over partitions), sorted inside the partitions and written once, column by column, with their partition and
    position. Where each batch starts in each partition is counted from these two columns (and the batch) alone, and the
    rows are read once more to add it. Only one count per partition meets in one place.

    The scan position must be the same when a lost task runs again. It is for rows read from files (``from_files``);
    rows that come out of a shuffle are written before.
    """
    df = df if from_files else stored(df, "unnumbered")
    keys = [*[F.col(c) for c in batch], *[F.col(c) if isinstance(c, str) else c for c in order]]
    tied = df.withColumn("_scan", F.monotonically_increasing_id())
    partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = tied.repartitionByRange(partitions, *keys, "_scan").sortWithinPartitions(*keys, "_scan")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    placed = stored(ranged.withColumns({"_part": F.spark_partition_id(), "_pos": position}).drop("_scan"), "placed")

    runs = placed.groupBy(*batch, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = runs.groupBy("_part").agg(F.sum("_n").alias("_rows"))
    offsets = per_part.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    if batch:
        # One row per batch and partition it lies in.
        starts = runs.join(F.broadcast(offsets), "_part").withColumn("_start", F.col("_offset") + F.col("_first"))
        starts = starts.withColumn("_batch", F.min("_start").over(Window.partitionBy(*batch)))
        starts = stored(starts.select("_part", "_offset", "_batch", *[F.col(c).alias(f"_b_{c}") for c in batch]), "starts")
        same = [placed["_part"] == starts["_part"], *[F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in batch]]
        found = placed.join(broadcast_if_small(starts), same)
    else:
        found = placed.join(F.broadcast(offsets.withColumn("_batch", F.lit(0))), "_part")
    at = F.col("_offset") + F.col("_pos") + 1
    ids = [(at + F.lit(after)).alias(running_id)] if running_id else []
    return found.select(*ids, *df.columns, (at - F.col("_batch")).alias(row_number))


def number_wide_rows(
    df: DataFrame,
    order: Sequence[str],
    batch: Sequence[str],
    row_number: str = "db_row_n",
    running_id: str = "id",
    after: int = 0,
) -> DataFrame:
    """The numbers of ``number_rows`` for rows of many columns that come from files, ordered by names.

    The order columns alone are range-partitioned over batch, order and scan position and counted: that gives the key and the
    number at which each range of a batch starts. The whole rows are then computed once, go to their range by a binary search in these
    starts, and are sorted and numbered there; nothing is written in between. The result is in the order of batch and order
    columns, so a write by batch does not sort again. The starts are one row per partition and batch, as batches are few.
    """
    partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    tied = compiled(df).withColumn("_scan", F.monotonically_increasing_id())
    names = [*batch, *order, "_scan"]
    kind = StructType([StructField(f"_k{i}", tied.schema[c].dataType) for i, c in enumerate(names)])
    key = F.struct(*[F.col(c).alias(f.name) for c, f in zip(names, kind)]).cast(kind)
    ranged = tied.select(key.alias("_key")).repartitionByRange(partitions, "_key").withColumn("_part", F.spark_partition_id())
    of_batch = [F.col("_key")[f.name] for f in kind[: len(batch)]]
    runs = ranged.groupBy(*of_batch, "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("low")).select("n", "low")

    starts, batches, lows, rows = [], {}, [], 0
    for n, low in runs.orderBy("low").collect():
        starts.append((rows, batches.setdefault(low[: len(batch)], rows)))
        lows.append(F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(low, kind)]))
        rows += n
    # One literal of the key's type: a cast inside the search would be made again in each of its steps.
    listed = F.array(*lows).cast(ArrayType(kind))
    jumps = F.array(*[F.lit(1 << i) for i in reversed(range(len(lows).bit_length()))])
    found = F.aggregate(jumps, F.lit(0), lambda at, jump: F.when(F.get(listed, at + jump) <= key, at + jump).otherwise(at))
    ranges = tied.withColumn("_range", found if lows else F.lit(0)).repartitionById(max(len(lows), 1), "_range")

    placed = ranges.sortWithinPartitions(*names)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    before, own = (F.get(F.array(*[F.lit(s[i]).cast("bigint") for s in starts or [(0, 0)]]), F.col("_range")) for i in (0, 1))
    at = placed.withColumn("_at", before + position + 1)
    return at.select((F.col("_at") + F.lit(after)).alias(running_id), *df.columns, (F.col("_at") - own).alias(row_number))


def sparse_id(df: DataFrame, name: str = "id", start: int = 0) -> DataFrame:
    """Unique but gappy id: no shuffle at all."""
    return df.select((F.monotonically_increasing_id() + F.lit(start)).alias(name), *df.columns)
