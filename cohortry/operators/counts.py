"""Frequencies, shares and cross tables: partial aggregation first, shares over the few counted rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.numeric import ratio
from cohortry.session import broadcast_if_small, checkpointed


def group_count(df: DataFrame, *by: str, name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def count_nonnull(df: DataFrame, col: str, *by: str, name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(col).alias(name))


def univar_table(df: DataFrame, *cols: str) -> DataFrame:
    """Frequency and share of each value (or combination), most frequent first."""
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("freq"))
    # The total comes from the counted rows: same exchange, no second scan.
    total = counts.agg(F.sum("freq")).scalar()
    return counts.withColumn("rel_freq", ratio("freq", total)).orderBy(F.desc("freq"), *cols)


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    return df.withColumn(name, ratio(value, df.agg(F.sum(value)).scalar()))


def with_share(counts: DataFrame, by: Sequence[str], n: str = "n", name: str = "share") -> DataFrame:
    """Share of each row within its group, by a join with the group totals (NULL is a group of its own)."""
    totals = counts.groupBy(*by).agg(F.sum(n).alias("_total")).withColumnsRenamed({c: f"_g_{c}" for c in by})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by])
    out = counts.join(totals, same).withColumn(name, ratio(n, "_total"))
    return out.select(*[c for c in counts.columns if c != name], name)


def group_share(df: DataFrame, by: str, col: str) -> DataFrame:
    """Count of each value within each group, and its share of the group."""
    return with_share(group_count(df, by, col), [by])


def count_trues(df: DataFrame, flag: str, *by: str) -> DataFrame:
    """Rows, true rows and their ratio per group; rows with an unknown flag count in the denominator."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(flag)).alias("count"))
    return out.withColumn("prop", ratio("count", "total"))


def crosstab(df: DataFrame, a: str, b: str, with_null: bool = True) -> DataFrame:
    """Two-way counts, long; NULL is a level of its own unless left out."""
    return group_count(df if with_null else df.dropna(subset=[a, b]), a, b)


def crosstab_wide(df: DataFrame, a: str, b: str, levels: Sequence, null_name: str = "missing") -> DataFrame:
    """Two-way counts, one column per level of ``b`` and one for NULL, in a single aggregation."""
    cells = [F.count_if(F.col(b) == F.lit(v)).alias(str(v)) for v in levels]
    return df.groupBy(a).agg(*cells, F.count_if(F.col(b).isNull()).alias(null_name))


def freq_table(df: DataFrame, *cols: str) -> DataFrame:
    return group_count(df.dropna(subset=list(cols)), *cols)


def tabulate_row_pct(df: DataFrame, row: str, col: str, where: Column | str | None = None) -> DataFrame:
    """Two-way counts with the percentage within the row, missing values left out."""
    part = df if where is None else df.filter(where)
    out = with_share(freq_table(part, row, col), [row], name="row_pct")
    return out.withColumn("row_pct", F.col("row_pct") * 100)


def mode_value(df: DataFrame, col: str, *by: str) -> DataFrame:
    """Most frequent value per group; ties go to the smallest value, whatever the row order."""
    counts = group_count(df.dropna(subset=[col]), *by, col)
    best = F.min_by(col, F.struct(-F.col("n"), F.col(col)))
    return counts.groupBy(*by).agg(best.alias("mode"), F.max("n").alias("n"))


def argmax(df: DataFrame, value: str, of: str, *by: str) -> DataFrame:
    """The ``of`` with the largest value per group; ties go to the smallest ``of``."""
    best = F.min_by(of, F.struct(-F.col(value), F.col(of)))
    return df.groupBy(*by).agg(best.alias(of), F.max(value).alias(value))


def rare_category_flag(df: DataFrame, col: str, cut: float, name: str = "rare", common: bool = False) -> DataFrame:
    """Flag rows whose category has a relative frequency below (or above) the cut. A NULL category is one of them."""
    table = univar_table(df, col)
    hit = table.filter(F.col("rel_freq") > cut if common else F.col("rel_freq") < cut)
    flagged = hit.select(F.col(col).alias("_cat"), F.lit(True).alias("_hit"))
    joined = df.join(broadcast_if_small(checkpointed(flagged)), F.col(col).eqNullSafe(F.col("_cat")), "left")
    return joined.withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_cat", "_hit")


def outcome_pivot(
    df: DataFrame,
    by: str,
    outcome: str = "outcome",
    denominator: str = "row",
) -> DataFrame:
    """Outcome counts per hospital, wide and zero-filled, with percentages and the all-or-none flag.

    ``denominator="row"`` takes each hospital's own total; ``"global"`` the total of all hospitals.
    """
    o = F.col(outcome)
    wide = df.groupBy(by).agg(
        F.count_if(o == "admitted").alias("admitted"),
        F.count_if(o == "dc home").alias("dc_home"),
        F.count_if(o == "transferred").alias("transferred"),
        F.count_if(o.isNull()).alias("other"),
    )
    if denominator == "row":
        total = F.col("admitted") + F.col("dc_home") + F.col("transferred")
        adm_total = F.col("admitted") + F.col("transferred")
    else:
        adm_total = wide.agg(F.sum(F.col("admitted") + F.col("transferred"))).scalar()
        total = wide.agg(F.sum(F.col("admitted") + F.col("dc_home") + F.col("transferred"))).scalar()
    shares = wide.withColumns(
        {
            "total": total,
            "admit_per": ratio("admitted", total) * 100,
            "dc_home_per": ratio("dc_home", total) * 100,
            "transferred_per": ratio("transferred", total) * 100,
            "transfer_adm_per": ratio("transferred", adm_total),
        }
    )
    t = F.col("transfer_adm_per")
    return shares.withColumn("all_none", t.isNull() | (t == 0) | (t == 1))
