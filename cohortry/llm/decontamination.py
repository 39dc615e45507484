"""Benchmark decontamination on templates.

Words lose the marks around them and their case; numbers, units behind a number and names (capitalised words inside a
sentence) become typed slots. A document holds a benchmark item when at least 80 % of the item's five-word template
windows occur in it and the slots agree: along one alignment of item and document, equal item values stand
for equal document values. So a question with other numbers or names is found, too.

A bitmap of the benchmark's window hashes (2^23 bits whatever the benchmark's size) goes to every task; documents whose
windows cannot reach the share stop there. The others' windows are hash-joined with the benchmark's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import Remembered, odd_constants, utf8, windows

WINDOW, SHARE = 5, 0.8
BITS = 23

NUMBER = re.compile(r"[+-]?[$€£]?[0-9][0-9.,:/]*%?$")
# Units that make a slot behind a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t oz lb ml l s sec min h hr hrs ms hz khz mhz ghz b kb mb gb tb k c f v w kw kwh "
    "meter meters metre metres kilometers kilometres miles feet inches grams kilograms liters litres seconds minutes hours days weeks "
    "months years dollars euros cents pounds percent degrees".split()
)
NAME_BIT, END_BIT, NUMBER_BIT, UNIT_BIT, FLAGS = 1, 2, 4, 8, 15
NAME, NUM, UNIT = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"<name>", b"<num>", b"<unit>"))


def _word(raw: bytes) -> int:
    """Hash of the bare lower-cased word with flags in its lowest bits; 0 if no letter or digit is left."""
    text = raw.decode("utf-8", "replace")
    end = END_BIT if text[-1] in ".!?:" else 0
    a, b = 0, len(text)
    while a < b and not text[a].isalnum():
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    bare = text[a:b]
    if not bare:
        return end
    flags = end
    if NUMBER.match(bare):
        flags |= NUMBER_BIT
    elif bare.lower() in UNITS:
        flags |= UNIT_BIT
    elif bare[0].isupper() and bare[1:].islower():
        flags |= NAME_BIT
    return (xxhash.xxh3_64_intdigest(bare.lower().encode()) & ~FLAGS | flags) or 16


class Template:
    """Canonical word hashes of a text, and the values of its slots (0 where a word stands for itself)."""

    def __init__(self, body: bytes, known: Remembered) -> None:
        words = body.split()
        packed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        flags = packed & np.uint64(FLAGS)
        ends = (flags & np.uint64(END_BIT)) > 0
        starts = np.ones(len(words), bool)
        starts[1:] = ends[:-1]
        bare = packed > np.uint64(FLAGS)
        packed, flags, starts = packed[bare], flags[bare], starts[bare]
        value = packed & ~np.uint64(FLAGS)
        number = (flags & np.uint64(NUMBER_BIT)) > 0
        unit = (flags & np.uint64(UNIT_BIT)) > 0
        unit[1:] &= number[:-1]
        unit[:1] = False
        name = ((flags & np.uint64(NAME_BIT)) > 0) & ~starts
        slot = number | unit | name
        self.words = np.where(number, NUM, np.where(unit, UNIT, np.where(name, NAME, value)))
        self.slots = np.where(slot, value, 0).astype(np.uint64).view(np.int64)

    def windows(self, width: int) -> np.ndarray:
        return windows(self.words, width, 211) if len(self.words) >= width else self.words[:0]


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = Remembered(_word, 200_000)
    for batch in batches:
        out = [[] for _ in range(5)]
        for key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
            t = Template(body.as_py(), known)
            width = min(WINDOW, len(t.words))
            if not width:
                continue
            hashed = t.windows(width).view(np.int64).tolist()
            slots = t.slots.tolist()
            for j, h in enumerate(hashed):
                for column, value in zip(out, (key, j, len(hashed), h, slots[j : j + width])):
                    column.append(value)
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["item", "j", "total", "hash", "item_slots"])


def _place(hashed: np.ndarray) -> np.ndarray:
    return (hashed >> np.uint64(64 - BITS)).astype(np.int64)


def _document_windows(bits: np.ndarray, widths: list[int], least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(_word, 400_000)
        table = np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            out = [[] for _ in range(4)]
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = Template(body.as_py(), known)
                hits = [(w, h, np.flatnonzero(table[_place(h)])) for w in widths for h in (t.windows(w),)]
                if sum(len(np.unique(h[at])) for _, h, at in hits) < least:
                    continue
                for width, hashed, at in hits:
                    for i in at.tolist():
                        row = (key, i, int(hashed[i].view(np.int64)), t.slots[i : i + width].tolist())
                        for column, value in zip(out, row):
                            column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(out, types)], ["doc", "i", "hash", "doc_slots"])

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, share: float = SHARE, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc, item_ids, containment): for every contaminated text, keyed by xxhash64 of it, its items in order and the
    largest share of an item's windows in it."""
    items = benchmark.select(F.xxhash64(utf8(item_text_col)).alias("item"), utf8(item_text_col).alias("body"), F.col(item_col).cast("bigint").alias("item_id"))
    texts = items.groupBy("item").agg(F.first("body").alias("body"))
    schema = "item bigint, j int, total int, hash bigint, item_slots array<bigint>"
    wins = texts.mapInArrow(_item_windows, schema)
    place = F.shiftrightunsigned("hash", 64 - BITS)
    word = F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITS}) & 63 as int))")).alias("word")
    bits = np.zeros(1 << (BITS - 6), np.int64)
    for r in wins.groupBy(F.shiftrightunsigned(place, 6).alias("at")).agg(word).collect():  # at most 2^17 rows
        bits[r["at"]] = r["word"]
    sizes = wins.groupBy(F.size("item_slots").alias("w")).agg(F.min("total").alias("t")).collect()
    least = min((max(1, int(np.ceil(share * r["t"] - 1e-9))) for r in sizes), default=1)
    body = docs.select(F.xxhash64(utf8(text_col)).alias("doc"), utf8(text_col).alias("body"))
    found = body.mapInArrow(
        _document_windows(bits, sorted(r["w"] for r in sizes), least), "doc bigint, i int, hash bigint, doc_slots array<bigint>"
    )
    hits = found.join(wins, "hash").withColumn("line", F.col("i") - F.col("j"))
    # A value of the item that stands for two values along one alignment makes that alignment inconsistent.
    pairs = F.filter(F.arrays_zip("item_slots", "doc_slots"), lambda p: p["item_slots"] != 0)
    slots = hits.filter(F.exists("item_slots", lambda v: v != 0)).select("doc", "item", "line", F.explode(pairs).alias("p"))
    by_value = slots.groupBy("doc", "item", "line", F.col("p.item_slots").alias("v"))
    ranges = by_value.agg(F.min("p.doc_slots").alias("lo"), F.max("p.doc_slots").alias("hi"))
    bad = ranges.filter("lo <> hi").select("doc", "item", "line").distinct()
    kept = hits.join(bad, ["doc", "item", "line"], "left_anti")
    per_window = kept.groupBy("doc", "item", "j").agg(F.first("total").alias("total"))
    shares = per_window.groupBy("doc", "item").agg((F.count("*") / F.first("total")).alias("share")).filter(F.col("share") >= share - 1e-9)
    named = shares.join(items.select("item", "item_id"), "item")
    return named.groupBy("doc").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("share").alias("containment"))


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with contaminated, item_ids (items held, ascending; empty if none) and containment (0 if none).

    A NULL or empty text, and a text without a letter or digit, is clean; such an item is in no document. Items of
    fewer than five words are looked for whole. Rows come back one to one, also repeated ones and those with a NULL id;
    a NULL item_id is not listed but contaminates. Columns of ``docs`` with the names of the new ones are replaced. An empty
    frame stays empty; an empty benchmark leaves every document clean.
    """
    base = docs.drop("contaminated", "item_ids", "containment").withColumn("__doc", F.xxhash64(utf8(text_col)))
    found = contamination(docs, benchmark, text_col=text_col, **options).withColumnRenamed("doc", "__doc")
    out = base.join(found, "__doc", "left").drop("__doc")
    return out.withColumns(
        {
            "contaminated": F.col("containment").isNotNull(),
            "item_ids": F.coalesce("item_ids", F.array().cast("array<bigint>")),
            "containment": F.coalesce("containment", F.lit(0.0)),
        }
    )
