"""Exact quantiles and average ranks over any number of distinct values.

Values are counted first, then split into ranges by approximate cut points (one sketch pass; the cuts are
literals afterwards, so every later pass agrees on them). A running count needs one range at a time, plus an
offset per range: no task ever holds a whole variable. A range that holds a wanted position and too many values is split again by
cut points of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.session import broadcast_if_small, checkpointed, stored

MIN_RANGES = 64
#: A range with more values is split again before its values are ranked.
RANGE_VALUES = 1_000_000


def range_count(df: DataFrame) -> int:
    """As many ranges as the session has shuffle partitions, some at least."""
    return max(MIN_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def number(column: str) -> Column:
    """A numeric column as double; NaN is no value."""
    return F.nullif(F.col(column).cast("double"), F.lit(float("nan")))


def cut_points(values: Sequence[str], ranges: int, wide: Callable[[str], Column] = number) -> dict[str, Column]:
    """Sketches of the columns, as aggregations that one pass can make beside others: about equal shares of the values."""
    probs = [i / ranges for i in range(1, ranges)] or [0.5]
    return {v: F.percentile_approx(wide(v), probs, 4 * ranges) for v in values}


def _same(left: Sequence[str], prefix: str) -> Column:
    out = F.lit(True)
    for c in left:
        out = out & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return out


def placed_values(
    df: DataFrame,
    values: Sequence[str],
    by: Sequence[str] = (),
    ranges: int | None = None,
    cuts: dict[str, list[float]] | None = None,
    missing: bool = False,
) -> DataFrame:
    """(by…, variable, range, value) of the numeric columns, one row per value. NULL and NaN are left out, or with ``missing``
    in no range. ``cuts`` are the columns' cut points if an earlier pass has made them."""
    numbers = df.select(*by, *[number(v).alias(v) for v in values])
    if cuts is None:
        sketches = cut_points(values, ranges or range_count(df))
        cuts = dict(zip(values, numbers.agg(*[c.alias(f"c{i}") for i, c in enumerate(sketches.values())]).first()))
    splits = [[-float("inf"), *sorted(set(cuts[v] or [0.0])), float("inf")] for v in values]
    placed = Bucketizer(
        splitsArray=splits, inputCols=list(values), outputCols=[f"_r_{v}" for v in values], handleInvalid="keep"
    ).transform(numbers)
    lines = [
        F.struct(
            F.lit(v).alias("variable"),
            F.when(F.col(v).isNotNull(), F.col(f"_r_{v}").cast("int")).alias("range"),
            F.col(v).alias("value"),
        )
        for v in values
    ]
    long = placed.select(*by, F.inline(F.array(*lines)))
    return long if missing else long.filter(F.col("value").isNotNull())


def exact_quantiles(
    df: DataFrame,
    values: Sequence[str],
    probs: dict[str, float],
    by: Sequence[str] = (),
    ranges: int | None = None,
    cuts: dict[str, list[float]] | None = None,
    moments: bool = False,
) -> DataFrame:
    """(by…, variable, total, one column per probability), with linear interpolation between order statistics
    (position (n−1)·p); with ``moments`` also mean and sd, and a line for groups without any value.

    Counts per range tell which ranges hold the wanted positions; only their values are shuffled and ranked. Moments are merged from
    the ranges' own, so they cost no pass.
    """
    long = placed_values(df, values, by, ranges, cuts, missing=True)
    keys = [*by, "variable"]
    joint = [*keys, "range"]
    at = {name: (F.col("total") - 1) * F.lit(p) for name, p in probs.items()}
    wanted = [index(position) for position in at.values() for index in (F.floor, F.ceil)]
    holds = reduce(
        lambda a, b: a | b, [(F.col("before") <= i) & (i < F.col("before") + F.col("_n")) for i in wanted]
    )

    whole = Window.partitionBy(*keys)
    up_to = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = long.groupBy(*joint).agg(*_sizes(), F.avg("value").alias("_mean"), F.var_pop("value").alias("_var"))
    parts = stored(parts, "ranges")
    filled = parts.filter(F.col("range").isNotNull())
    located = filled.withColumns(
        {"before": F.coalesce(F.sum("_n").over(up_to), F.lit(0)), "total": F.sum("_n").over(whole)}
    )
    needed = stored(located.filter(holds).select(*joint, "_n", "_low", "_high", "before", "total"), "needed")
    own = needed.select(*[F.col(c).alias(f"_k_{c}") for c in joint], "_n", "_low", "_high", "before", "total")
    held = long.join(broadcast_if_small(own), _same(joint, "_k_")).select(*joint, "value", "_n", "_low", "_high", "before", "total")
    while needed.filter(_many()).limit(1).count():
        held, needed = _split(held, joint, holds)
    inside = Window.partitionBy(*joint).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        held.groupBy(*joint, "before", "total", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    )

    def value_at(index: Column) -> Column:
        here = (F.col("before") <= index) & (index < F.col("before") + F.col("n"))
        return F.max(F.when(here, F.col("value")))

    aggs, out = [], []
    for name, position in at.items():
        aggs += [value_at(F.floor(position)).alias(f"_lo_{name}"), value_at(F.ceil(position)).alias(f"_hi_{name}")]
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (position - F.floor(position)) * (hi - lo)).alias(name))
    result = ranked.groupBy(*keys).agg(F.max("total").alias("total"), *aggs).select(*keys, "total", *out)
    if not moments:
        return result
    every = parts.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    merged = merge_moments(filled, keys).select(*[F.col(k).alias(f"_m_{k}") for k in keys], "mean", "sd")
    both = result.join(merged, _same(keys, "_m_")).drop(*[f"_m_{k}" for k in keys])
    lines = every.join(both, _same(keys, "_k_"), "left").withColumn("total", F.coalesce("total", F.lit(0)))
    return lines.select(*[F.col(f"_k_{k}").alias(k) for k in keys], "total", "mean", "sd", *probs)


def merge_moments(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys…, mean, sd) from the parts' counts, means and population variances, by deviations from the common mean."""
    n = F.col("_n")
    common = Window.partitionBy(*keys)
    mean = F.sum(n * F.col("_mean")).over(common) / F.sum(n).over(common)
    spread = n * (F.col("_var") + (F.col("_mean") - F.col("mean")) * (F.col("_mean") - F.col("mean")))
    sums = parts.withColumn("mean", mean).groupBy(*keys).agg(F.first("mean").alias("mean"), F.sum(spread).alias("m2"), F.sum(n).alias("n"))
    return sums.select(*keys, "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("sd"))


def _sizes() -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), F.min("value").alias("_low"), F.max("value").alias("_high")]


def _many() -> Column:
    return (F.col("_n") > RANGE_VALUES) & (F.col("_low") < F.col("_high"))


def _split(held: DataFrame, joint: Sequence[str], holds: Column) -> tuple[DataFrame, DataFrame]:
    """The values of the wanted ranges, where ranges with too many values give way to those of their own ranges that hold a wanted
    position. A cut point is a range of its own, so a value that fills a range stands alone in it and is not split again."""
    held = stored(held, "held")
    probs = [i / MIN_RANGES for i in range(1, MIN_RANGES)]
    cuts = held.filter(_many()).groupBy(*joint).agg(F.array_distinct(F.percentile_approx("value", probs, 10 * MIN_RANGES)).alias("_cuts"))
    cuts = stored(cuts.select(*[F.col(c).alias(f"_k_{c}") for c in joint], "_cuts"), "cuts")
    below = F.size(F.filter("_cuts", lambda c: c < F.col("value"))) * 2 + F.array_contains("_cuts", F.col("value")).cast("int")
    placed = held.join(broadcast_if_small(cuts), _same(joint, "_k_"), "left").withColumn("_sub", F.coalesce(below, F.lit(0)))
    placed = placed.select(*joint, "_sub", "value", "before", "total")
    up_to = Window.partitionBy(*joint).orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*joint, "_sub", "before", "total").agg(*_sizes())
    counts = counts.withColumn("before", F.col("before") + F.coalesce(F.sum("_n").over(up_to), F.lit(0))).filter(holds)
    # What is left of the ranges is numbered anew; the order among them is in ``before``.
    number_ = Window.partitionBy(*[c for c in joint if c != "range"]).orderBy("range", "_sub")
    needed = stored(counts.withColumn("_range", F.row_number().over(number_)), "needed")
    kept = needed.select(
        *[F.col(c).alias(f"_k_{c}") for c in (*joint, "_sub")], "_n", "_low", "_high", F.col("before").alias("_before"), "_range"
    )
    left = placed.drop("before").join(broadcast_if_small(kept), _same([*joint, "_sub"], "_k_"))
    keys = [c for c in joint if c != "range"]
    left = left.select(*keys, F.col("_range").alias("range"), "value", "_n", "_low", "_high", F.col("_before").alias("before"), "total")
    return left, needed


def rank_sums(df: DataFrame, values: Sequence[str], by: str, ranges: int | None = None) -> DataFrame:
    """Per variable and group: n, sum of average ranks, and the group's part of the tie term Σ(t³−t)."""
    long = placed_values(df.filter(F.col(by).isNotNull()), values, [by], ranges)
    counts = long.groupBy(by, "variable", "range", "value").agg(F.count(F.lit(1)).alias("n"))
    per_range = long.groupBy("variable", "range").agg(F.count(F.lit(1)).alias("_n"))
    up_to = Window.partitionBy("variable").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select("variable", "range", F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_before"))
    # Equal values of all groups are peers of the range frame, so one sort gives the rank and the tie size.
    inside = Window.partitionBy("variable", "range").orderBy("value")
    ranked = counts.withColumns(
        {
            "_upto": F.sum("n").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
            "_t": F.sum("n").over(inside.rangeBetween(Window.currentRow, Window.currentRow)).cast("double"),
        }
    ).join(broadcast_if_small(checkpointed(offsets)), ["variable", "range"])
    n, t = F.col("n"), F.col("_t")
    rank = F.col("_before") + F.col("_upto") - t + (t + 1) / 2
    return ranked.groupBy("variable", by).agg(
        F.sum("n").alias("n"), F.sum(n * rank).alias("rank_sum"), F.sum(n * (t * t - 1)).alias("ties")
    )
