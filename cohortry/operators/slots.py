"""Repeated code columns (principal plus other codes): reshape, look up, classify."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators.joins import count_keys, key_counts
from cohortry.session import BROADCAST_ROWS, broadcast_if_small, stored

def wide_to_long(df: DataFrame, id_col: str, cols: Sequence[str], slot: str = "slot", code: str = "code") -> DataFrame:
    """One row per id and slot; empty slots stay as NULL codes."""
    return df.unpivot(id_col, list(cols), slot, code)


def long_to_wide(df: DataFrame, id_col: str, slot: str, value: str, slots: Sequence[str]) -> DataFrame:
    """Back to one row per id. The slots are given, so no extra pass looks for them."""
    return df.groupBy(id_col).pivot(slot, list(slots)).agg(F.first(value))


def assert_unique_id(df: DataFrame, id_col: str) -> DataFrame:
    """Stop unless the id is unique and filled. Checks by counting per id, never by collecting ids."""
    bad = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(id_col).isNull())
    if bad.limit(1).count():
        raise ValueError(f"{id_col} is not a unique id")
    return df


def id_check(df: DataFrame, id_col: str) -> DataFrame:
    """One row: rows, ids and whether the id is unique."""
    per_id = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    out = per_id.agg(
        F.sum("n").alias("n_rows"), F.count(id_col).alias("n_ids"), (F.max("n") == 1).alias("is_unique")
    )
    return out


def lookup_slots(
    df: DataFrame,
    slots: Sequence[str],
    lookup: DataFrame,
    code: str,
    values: Sequence[str],
    id_col: str | None = None,
    form: str = "auto",
    on_duplicate: str = "error",
    first_values: Sequence[str] = (),
) -> DataFrame:
    """Attach the looked-up values of every slot as ``<value>_<slot>`` columns, and ``first_values`` of the first slot's code
    under their own names.

    ``join`` broadcasts the lookup once and joins it per slot: no shuffle of the facts. ``long`` turns the
    slots into rows, joins once and turns them back: for lookups too large to broadcast. It goes by row numbers of its
    own, so repeated and NULL ids give the rows of the join form; asked for by name it wants ``id_col`` all the same.
    ``auto`` chooses by counting the lookup and works without ``id_col``. Of a lookup too large to broadcast, both look for the
    codes that the slots hold, and broadcast these if they are few enough.

    A repeated code is an error, unless ``on_duplicate="all"`` asks for a row per match (per combination of matches over the
    slots), as left joins in SQL give them, in either form.
    """
    if form == "long" and id_col is None:
        raise ValueError("the long form needs id_col")
    if on_duplicate not in ("error", "all"):
        raise ValueError(f"on_duplicate is 'error' or 'all', not {on_duplicate!r}")
    lookup = lookup.select(code, *values, *first_values)
    if on_duplicate == "error":
        rows, repeated = count_keys(lookup, [code]), False
    else:
        seen = key_counts(lookup, [code])
        rows, repeated = seen["rows"], seen["most"] > 1
    if form != "long":
        lookup, rows = held_part(df, slots, lookup, code, rows)
    small = rows <= BROADCAST_ROWS
    if form == "auto":
        form = "join" if small else "long"

    def of(slot: str) -> dict[str, str]:
        """Value → its column for the slot."""
        return {**{v: f"{v}_{slot}" for v in values}, **({v: v for v in first_values} if slot == slots[0] else {})}

    if form == "join":
        side = F.broadcast(lookup) if small else lookup
        for s in slots:
            named = side.select(F.col(code).alias(f"_{s}"), *[F.col(v).alias(n) for v, n in of(s).items()])
            df = df.join(named, F.col(s) == F.col(f"_{s}"), "left").drop(f"_{s}")
        return df
    # Written once with their numbers; the lookup reads the numbers and slots only.
    df = stored(df.withColumn("_row", F.monotonically_increasing_id()), "numbered-slots")
    long = wide_to_long(df.select("_row", *slots), "_row", slots, "_slot", "_code")
    if repeated:
        # One row per code with all its rows as a list, so that a row's slots still meet in one row; the lists are spread at the end.
        lookup = lookup.groupBy(code).agg(F.collect_list(F.struct(*values, *first_values)).alias("_all"))
        found = long.join(lookup.withColumnRenamed(code, "_code"), "_code", "inner")
        lists = [F.first(F.when(F.col("_slot") == s, F.col("_all")), ignorenulls=True).alias(f"_all_{s}") for s in slots]
        out = df.join(found.groupBy("_row").agg(*lists), "_row", "left")
        for s in slots:
            out = out.withColumn(f"_all_{s}", F.explode_outer(f"_all_{s}"))
        named = [F.col(f"_all_{s}")[v].alias(n) for s in slots for v, n in of(s).items()]
        return out.select(*[c for c in df.columns if c != "_row"], *named)
    found = long.join(lookup.withColumnRenamed(code, "_code"), "_code", "inner")
    wide = found.groupBy("_row").agg(
        *[F.first(F.when(F.col("_slot") == s, F.col(v)), ignorenulls=True).alias(n) for s in slots for v, n in of(s).items()]
    )
    return df.join(wide, "_row", "left").drop("_row")


def held_part(df: DataFrame, slots: Sequence[str], lookup: DataFrame, code: str, rows: int) -> tuple[DataFrame, int]:
    """A lookup and its number of rows; of one too large to broadcast, the rows of the codes that the slots hold."""
    if rows <= BROADCAST_ROWS:
        return lookup, rows
    held = df.select(F.explode(F.array_distinct(F.array_compact(F.array(*slots)))).alias(code)).distinct()
    part = stored(lookup.join(held, code, "left_semi"), "held-codes")
    return part, part.count()


def lookup_long_wide(
    df: DataFrame, id_col: str, slots: Sequence[str], lookup: DataFrame, code: str, value: str, on_duplicate: str = "error"
) -> DataFrame:
    """Replace the codes of every slot by their label: id plus one label column per slot."""
    named = lookup_slots(df.select(id_col, *slots), slots, lookup, code, [value], id_col, on_duplicate=on_duplicate)
    return named.select(id_col, *[F.col(f"{value}_{s}").alias(s) for s in slots])


def first_category(codes: DataFrame, code: str, category: str, priority: str, system: str | None = None) -> DataFrame:
    """One category per code: the one with the lowest priority number (the first listed group wins)."""
    keys = [system, code] if system else [code]
    return codes.groupBy(*keys).agg(F.min_by(category, F.col(priority)).alias(category))


def all_categories(codes: DataFrame, code: str, category: str, priority: str) -> DataFrame:
    """Every category of a code, in priority order."""
    ordered = F.sort_array(F.collect_set(F.struct(F.col(priority).alias("p"), F.col(category).alias("c"))))
    return codes.groupBy(code).agg(F.transform(ordered, lambda x: x["c"]).alias("categories"))


def classify(
    df: DataFrame,
    slots: Sequence[str],
    codes: DataFrame,
    category: str = "category",
    match: str = "exact",
    mode: str = "first",
) -> DataFrame:
    """Put each slot's code into a category: ``<category>_<slot>`` columns.

    ``codes`` has code, category and priority. ``match="prefix"`` reads the listed codes as stems: a code also
    matches when a listed stem begins it. ``mode="multi"`` gives an array of all categories instead of the first.
    """
    codes = codes.select("code", category, "priority")
    if match == "prefix":
        n_stems, shortest = codes.agg(F.count(F.lit(1)), F.min(F.length("code"))).first()
        if n_stems <= BROADCAST_ROWS:
            return classify_stems(df, slots, stem_index(codes, category, shortest or 1), shortest or 1, category, mode)
        # Derived from the facts, so it is written once before the lookups check and join it.
        codes = stored(expand_stems(df, slots, codes, category), "expanded-stems")
    if mode == "multi":
        lists = all_categories(codes, "code", category, "priority").withColumnRenamed("categories", category)
        return lookup_slots(df, slots, lists, "code", [category], form="join")
    return lookup_slots(df, slots, first_category(codes, "code", category, "priority"), "code", [category])


def stem_index(codes: DataFrame, category: str, shortest: int) -> DataFrame:
    """Listed stems by their first ``shortest`` characters: (head, stems), a head's stems in priority order.

    ``shortest`` is the length of the shortest stem, so every stem that begins a code shares the code's head."""
    entry = F.struct("priority", F.col("code").alias("stem"), F.col(category).alias("category"))
    return codes.groupBy(F.substring("code", 1, shortest).alias("head")).agg(F.sort_array(F.collect_set(entry)).alias("stems"))


def classify_stems(df: DataFrame, slots: Sequence[str], index: DataFrame, shortest: int, category: str, mode: str) -> DataFrame:
    """Categories by a broadcast stem index: one join per slot on the head, all of them with the same broadcast side; the facts
    are neither read again nor moved."""
    side = F.broadcast(index)
    for s in slots:
        own = side.select(F.col("head").alias(f"_h_{s}"), F.col("stems").alias(f"_s_{s}"))
        df = df.join(own, F.substring(s, 1, shortest) == F.col(f"_h_{s}"), "left")
        hits = F.filter(f"_s_{s}", lambda e: F.col(s).startswith(e["stem"]))
        names = F.array_distinct(F.transform(hits, lambda e: e["category"]))
        found = F.when(F.size(names) > 0, names) if mode == "multi" else F.get(names, F.lit(0))
        df = df.withColumn(f"{category}_{s}", found).drop(f"_h_{s}", f"_s_{s}")
    return df


def expand_stems(df: DataFrame, slots: Sequence[str], codes: DataFrame, category: str) -> DataFrame:
    """The distinct codes of the data that begin with a listed stem, by equality on every stem length."""
    stems = codes.withColumnRenamed("code", "stem")
    lengths = [r[0] for r in stems.select(F.length("stem").alias("n")).distinct().collect()]
    seen = df.select(F.explode(F.array_distinct(F.array_compact(F.array(*slots)))).alias("code")).distinct()
    heads = F.array_distinct(F.array(*[F.substring("code", 1, n) for n in lengths]))
    return (
        seen.select("code", F.explode(heads).alias("stem"))
        .join(broadcast_if_small(stems), "stem")
        .groupBy("code", category)
        .agg(F.min("priority").alias("priority"))
    )
