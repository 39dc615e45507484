"""Near-duplicate documents by a multi-index Hamming join of b-bit minwise signatures.

A document's lower-cased words give a set of word shingles. 32 minwise hashes of the set, 16 bits each, are its
signature: eight chunks of four symbols, one chunk to a 64-bit number. If two signatures differ in at most 15
symbols, some chunk differs in at most one (pigeonhole: 8 * 2 = 16). Enumerating the allowed error (each of the
four symbols blanked in turn) turns that into equality of one of 32 keys, so every pair within the signature
distance meets in some key's bucket. Two sets at a similarity of 0.85 differ in all eight chunks twice or more
with a probability of 2e-8 (1e-6 at 0.8).

Equal sets are one class from the start. Pairs are confirmed on full sets of 64-bit shingle hashes. No bucket is
expanded into its pairs: in each round the members that are not yet connected to their bucket's leader are
compared with it, at first the member that meets the most others. Rounds go on while at least one comparison in fifty
links. Only buckets that still hold several components then give their cross-component pairs.

Before texts are fetched, and inside the join of that last pass, pairs must pass their sets' odd sketches: every
shingle flips one of 2048 bits, so two sketches differ in at most as many bits as the sets have elements apart. More
bits than the wanted similarity allows rule a pair out for certain; nothing is lost by this.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortry.llm.common import hashes, odd_constants, windows, written

CHUNKS, PER_CHUNK, SKETCH = 8, 4, 32
LANE = 0xFFFF

#: The minwise hashes' multipliers.
MULTIPLIERS = odd_constants(CHUNKS * PER_CHUNK, 11)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; words are runs without ASCII white space, A-Z lower-cased."""
    words = text.lower().split()
    return np.unique(windows(hashes(words, len(words)), size, 101))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Eight 64-bit numbers, the chunks, of four 16-bit symbols each."""
    low = np.full(CHUNKS * PER_CHUNK, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 1024):
        np.minimum(low, np.multiply.outer(MULTIPLIERS, shingles[start : start + 1024]).min(axis=1), out=low)
    symbols = ((low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).reshape(-1, PER_CHUNK)
    return (symbols << (np.arange(PER_CHUNK, dtype=np.uint64) * np.uint64(16))).sum(axis=1, dtype=np.uint64).view(np.int64)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """2048 bits in 64-bit numbers; a bit says whether an odd number of shingles falls on it."""
    bits = np.bincount((shingles >> np.uint64(53)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _signed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, signs, odd = [], [], [], []
            for text in batch.column(2).cast(pa.binary()):
                s = shingle_set(text.as_py() or b"", size)
                counts.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                signs.append(signature(s).tolist() if len(s) else None)
                odd.append(odd_sketch(s).tolist() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()), pa.array(keys, pa.binary())]
                + [pa.array(x, pa.list_(pa.int64())) for x in (signs, odd)],
                [*batch.schema.names, "n", "set_key", "sig", "odd"],
            )

    return run


def _confirmed(size: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (None, None)
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for x, one, two in zip(a, batch.column("a_text"), batch.column("b_text")):
                if held[0] != x:
                    held = (x, shingle_set(one.as_py(), size))
                other = shingle_set(two.as_py(), size)
                common = len(np.intersect1d(held[1], other, assume_unique=True))
                keep.append(den * common >= num * (len(held[1]) + len(other) - common))
            picked = [i for i, k in enumerate(keep) if k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in picked], pa.int64()), pa.array([b[i] for i in picked], pa.int64())], ["a", "b"]
            )

    return run


def _bucket_rows(reps: DataFrame) -> DataFrame:
    """A row per class and key: the chunk with one symbol blanked, hashed with the chunk's and the symbol's number."""
    keys = [
        F.xxhash64(F.lit(c), F.lit(m), F.col("sig")[c].bitwiseAND(F.lit(_signed64(~(LANE << (16 * m))))))
        for c in range(CHUNKS)
        for m in range(PER_CHUNK)
    ]
    return reps.select("id", F.explode(F.array(*keys)).alias("key"))


def _signed64(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _sketched(reps: DataFrame, name: str) -> DataFrame:
    """Size and odd sketch of every class, in columns that start with ``name``."""
    odd = [F.col("odd")[i].alias(f"{name}_odd{i}") for i in range(SKETCH)]
    return reps.select(F.col("id").alias(name), F.col("n").alias(f"{name}_n"), *odd)


def _may_link(num: int, den: int) -> F.Column:
    """False only for pairs whose sizes or sketches rule the similarity out: linked sets of together n elements have at
    most n * (den - num) / (den + num) elements that are in one of them only."""
    sizes = F.lit(den) * F.least("a_n", "b_n") >= F.lit(num) * F.greatest("a_n", "b_n")
    apart = [F.bit_count(F.col(f"a_odd{i}").bitwiseXOR(F.col(f"b_odd{i}"))) for i in range(SKETCH)]
    return sizes & (F.lit(num + den) * sum(apart[1:], apart[0]) <= F.lit(den - num) * (F.col("a_n") + F.col("b_n")))


def connected(links: DataFrame) -> DataFrame:
    """(id, label) of every id in ``links`` (a, b), label the smallest id reachable.

    Rounds of contraction: every node moves to the neighbour (or itself) with the smallest hash, links follow, until
    none joins two nodes. Hashes change with the round, so chains shrink by a constant share as well.
    """
    edges = written(links.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = written(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("at", F.col("id")), "labels")
    turn = 0
    while edges.limit(1).count():
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        rank = lambda c, t=turn: F.struct(F.xxhash64(F.lit(t), c).alias("h"), F.col(c).alias("to"))
        moves = both.groupBy("u").agg(F.min(rank("v")).alias("best"))
        moves = written(moves.select("u", F.least(rank("u"), "best")["to"].alias("to")), "moves")
        labels = written(
            labels.join(moves, F.col("at") == F.col("u"), "left").select("id", F.coalesce("to", "at").alias("at")), "labels"
        )
        first = moves.select(F.col("u").alias("a"), F.col("to").alias("ta"))
        second = moves.select(F.col("u").alias("b"), F.col("to").alias("tb"))
        moved = edges.join(first, "a").join(second, "b").filter("ta <> tb")
        edges = written(moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
        turn += 1
    smallest = labels.groupBy("at").agg(F.min("id").alias("label"))
    return labels.join(smallest, "at").select("id", "label")


def row_components(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, num: int, den: int, others: Sequence[str] = ()
) -> DataFrame:
    """A row per row of ``docs``: id, text, the ``others`` as keep_0, keep_1, ..., n, component_id, first.

    Classes, links and components are keyed by row numbers of their own, never by ids, so repeated and NULL ids neither mix
    texts nor keep a row out. component_id is the smallest id of the component's rows (NULL if none has an id); first is true
    for one row of every component, one with that id where there is any, and for every row without shingles.
    """
    base = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).alias("text"),
        *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(others)],
    )
    fields = StructType(base.schema.fields + StructType.fromDDL("n bigint, set_key binary, sig array<bigint>, odd array<bigint>").fields)
    # Written with the texts: the row numbers are fixed from here on.
    signed = written(base.mapInArrow(_signed(shingle), fields), "signed")
    classes = signed.filter("set_key IS NOT NULL").groupBy("set_key")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("doc"), "row")).alias("best")
    first = [F.first(c).alias(c) for c in ("n", "sig", "odd")]
    reps = written(classes.agg(F.min("row").alias("id"), best, *first), "classes")
    # Buckets of one class say nothing; the others are written once and shrink as components form.
    rows = _bucket_rows(reps)
    several = rows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    rows = written(rows.join(several, "key"), "buckets")
    # What many documents were copied from shares keys with all of them, so it meets the most members.
    central = rows.groupBy("id").agg(F.sum("c").alias("met"))
    rows = written(rows.drop("c").join(central, "id"), "ranked")
    schema = "a bigint, b bigint"
    texts = signed.select("row", F.col("text").cast("binary").alias("body"))
    links = labels = None

    def confirm(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) linked on full sets; a is the bucket's leader, so its set is made once for a run of rows."""
        with_b = pairs.join(texts.toDF("b", "b_text"), "b")
        with_both = with_b.join(texts.toDF("a", "a_text"), "a")
        return with_both.select("a", "b", "a_text", "b_text").mapInArrow(_confirmed(shingle, num, den), schema)

    turn, stars = 0, True
    while True:
        at = rows if labels is None else rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        if labels is None:
            at = at.withColumn("label", F.col("id"))
        # Only keys whose members lie in several components are left, so buckets of one component cost nothing more.
        order = -F.col("met") if turn == 0 else F.xxhash64(F.lit(turn), F.col("id"))
        leader = F.min(F.struct(order.alias("order"), "id", "label")).alias("lead")
        leads = at.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), leader).filter("lo < hi")
        leads = written(leads.select("key", F.col("lead.id").alias("lead"), F.col("lead.label").alias("lead_label")), "leads")
        at = written(at.join(leads, "key"), "active")
        if stars:
            pairs = at.filter("label <> lead_label").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
            pairs = written(pairs, "pairs")
            near = pairs.join(_sketched(reps, "a"), "a").join(_sketched(reps, "b"), "b").filter(_may_link(num, den))
        else:
            one = written(at.select("key", F.col("id").alias("a"), "label").join(_sketched(reps, "a"), "a"), "sketched")
            two = one.select("key", *(F.col(c).alias(f"b{c[1:]}" if c[0] == "a" else "b_label") for c in one.columns if c != "key"))
            cross = (F.col("a") < F.col("b")) & (F.col("label") != F.col("b_label")) & _may_link(num, den)
            near = one.alias("x").join(two.alias("y"), (F.col("x.key") == F.col("y.key")) & cross)
        found = written(confirm(near.select("a", "b").distinct()), "links")
        linked = found.count()
        if linked:
            links = found if links is None else links.union(found)
            labels = written(connected(links), "components")
        if not stars:
            break
        stars = linked > 0 and 50 * linked >= pairs.count()
        rows, turn = at.select("id", "key", "met"), turn + 1
    final = reps.select("set_key", "id", "best")
    if labels is None:
        final = final.select("set_key", "best")
    else:
        final = final.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        chosen = final.groupBy("label").agg(F.min("best").alias("best"))
        final = final.drop("best").join(chosen, "label").select("set_key", "best")
    final = final.select("set_key", F.col("best.doc").alias("component_id"), F.col("best.row").alias("first_row"))
    out = signed.drop("sig", "odd").join(final, "set_key", "left")
    return out.withColumn("first", F.coalesce(F.col("row") == F.col("first_row"), F.lit(True))).drop("row", "first_row", "set_key")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """A row per document: id, n_shingles, component_id (smallest id of its component), kept (its own component).

    Two documents are linked when den * |intersection| >= num * |union| of their shingle sets. A NULL or blank text
    has no shingles and no links; fewer words than a shingle make one. Rows are linked by their texts alone: a row that
    repeats an id is in the component of its own text, and a row with a NULL id links others, though ``kept``, which goes by
    id, is true for it and its component is given as NULL. ``one_of_each`` keeps one row of every component whatever the ids.
    Other columns of ``docs`` are ignored. An empty frame gives an empty result.
    """
    out = row_components(docs, id_col, text_col, shingle, num, den)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """``docs`` with one row of every component, one with the smallest id; rows with NULL and repeated ids are treated as
    rows of their own. Texts without shingles all stay."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    kept = row_components(docs, id_col, text_col, shingle, num, den, others).filter("first")
    names = {id_col: F.col("id").cast(docs.schema[id_col].dataType), text_col: F.col("text")}
    names |= {c: F.col(f"keep_{i}") for i, c in enumerate(others)}
    return kept.select(*[names[c].alias(c) for c in docs.columns])
