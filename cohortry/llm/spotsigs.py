"""Document fingerprints by SpotSigs: chains of content words behind common words.

Every occurrence of a common word (an anchor) gives a spot signature: the anchor with the next two words that are no
anchors. A text without any takes its three-word windows. A document's set of signatures is compared by Jaccard
similarity on whole sets; sets whose lengths alone rule a similarity out are never compared. The printed fingerprint is the set's
size, a digest of the whole set and its 64 smallest 32-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.common import hashes, mixed, utf8, windows

# Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in a is that for it was with by on as at be this are or from an not have "
    "der die das und den von zu mit ist im ein eine nicht auf für "
    "le les des et est un une dans pour que qui sur pas par "
    "de la el en y los se del las lo al su para con por"
).split()
CHAIN, SKETCH = 2, 64
_ANCHORS = np.sort(np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in ANCHORS], np.uint64))


def spots(text: bytes) -> np.ndarray:
    """Sorted distinct signature hashes of a text."""
    words = [w.strip(b".,;:!?|()\"'") for w in text.lower().split()]
    h = hashes(words, len(words))
    anchor = _ANCHORS[np.searchsorted(_ANCHORS, h) % len(_ANCHORS)] == h
    content = np.flatnonzero(~anchor)
    at = np.flatnonzero(anchor)
    first = np.searchsorted(content, at)
    at, first = at[first + CHAIN <= len(content)], first[first + CHAIN <= len(content)]
    if not len(at):
        return np.unique(windows(h, 3, 307))
    chain = h[at]
    for j in range(CHAIN):
        chain = mixed(chain * np.uint64(3) + h[content[first + j]])
    return np.unique(chain)


def printed(signatures: np.ndarray) -> str:
    low = np.unique(signatures >> np.uint64(32))[:SKETCH]
    return f"{len(signatures)}:{xxhash.xxh3_64_hexdigest(signatures.tobytes())}:{low.astype('>u4').tobytes().hex()}"


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty sets are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    held = None  # bucket, id, text, signatures of the row that waits for its successor

    def row(text, own, other, following) -> tuple:
        cut = len(text) // 2
        edited = text[: len(text) - cut] + other[:cut]
        mine = spots(edited.encode())
        digest = hashlib.sha256(edited.encode()).hexdigest()
        return len(text), digest, printed(own), printed(mine), likeness(own, mine), likeness(own, following)

    for batch in batches:
        out: list[list] = [[] for _ in names]
        for bucket, copy, doc_id, text in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3)):
            if copy and (held is None or held[0] != bucket):
                continue  # another copy of the first document: the bucket is done
            text = text.as_py()
            own = spots(text.encode())
            if held is not None and held[0] == bucket:
                for column, value in zip(out, (held[1], *row(held[2], held[3], text, own))):
                    column.append(value)
            held = None if copy else (bucket, doc_id, text, own)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)


def range_starts(base: DataFrame, parts: int) -> list[tuple[int | None, int]]:
    """Where ranges of about equal size begin, as ascending (id, hash); an id that fills several ranges is cut by hash.

    At most as many numbers as partitions are held."""
    shares = [i / parts for i in range(1, parts)] or [0.5]
    cuts, n, nulls = base.agg(F.percentile_approx("id", shares, 100 * parts), F.count(F.lit(1)), F.count_if(F.col("id").isNull())).first()
    full = Counter(cuts or [])
    # The empty id has no percentile.
    full[None] = parts * nulls // n if n else 0
    starts = []
    for value, ranges in sorted(full.items(), key=lambda kv: (kv[0] is not None, kv[0] or 0)):
        starts += [(value, (k << 64) // max(1, ranges) - (1 << 63)) for k in range(value is None, ranges)]
    return starts


def _bucket(starts: list[tuple[int | None, int]]):
    """A function (id, hash) -> number of range starts at or below it; only these two numbers go to Python."""
    nulls = np.array([h for i, h in starts if i is None], np.int64)
    ids = np.array([i for i, _ in starts if i is not None], np.int64)
    hashes_ = np.array([h for i, h in starts if i is not None], np.int64)

    @F.arrow_udf("int")
    def run(id_: pa.Array, hash_: pa.Array) -> pa.Array:
        h = hash_.to_numpy(zero_copy_only=False)
        known = pc.is_valid(id_).to_numpy(zero_copy_only=False)
        i = pc.fill_null(id_, 0).to_numpy(zero_copy_only=False)
        low, high = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
        out = len(nulls) + high
        for at in np.unique(low[known & (high - low > 1)]):
            rows = known & (low == at) & (high - low > 1)
            end = int(high[rows][0])
            out[rows] = len(nulls) + at + np.searchsorted(hashes_[at:end], h[rows], "right")
        return pa.array(np.where(known, out, np.searchsorted(nulls, h, "right")).astype(np.int32))

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n / 2) code points replaced by the first as many of the next document's, in
    ascending id order (NULL ids first, equal ids by a hash of the text; after the last the first). Documents are dealt to
    ranges of (id, hash); the first document of a range is sent to the range before as well, so one shuffle brings every
    document to its successor. A NULL or empty text is the empty text with the empty set. Repeated rows are documents of their own.
    Other columns are ignored; an empty frame gives no rows.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    base = base.withColumn("hash", F.xxhash64("body"))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = base.withColumn("bucket", _bucket(range_starts(base, parts))("id", "hash"))
    # One row per range: its first document, and the range before it (before the first the last), which needs a copy.
    firsts = placed.groupBy("bucket").agg(F.min(F.struct(F.col("id").isNotNull(), "id", "hash")).alias("least"))
    order = Window.orderBy("bucket")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    to = F.coalesce(F.lag("bucket").over(order), F.last("bucket").over(whole))
    firsts = firsts.select(F.col("bucket").alias("_bucket"), F.col("least.id").alias("_id"), F.col("least.hash").alias("_hash"), to.alias("to"))
    same = (F.col("bucket") == F.col("_bucket")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    own, copy = (F.struct(F.col(c).alias("bucket"), F.lit(k).alias("copy")) for c, k in (("bucket", False), ("to", True)))
    sent = F.when(F.col("to").isNotNull(), F.array(own, copy)).otherwise(F.array(own))
    rows = placed.join(F.broadcast(firsts), same, "left").select(F.explode(sent).alias("s"), "id", "hash", "body")
    rows = rows.select("s.bucket", "s.copy", "id", "hash", "body")
    ordered = rows.repartitionByRange(parts, "bucket").sortWithinPartitions("bucket", "copy", "id", "hash", "body").drop("hash")
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(_edited, schema)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [spots(b.as_py()).view(np.int64).tolist() for b in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "sigs"])


def similar_pairs(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, similarity) of the different signature sets with a Jaccard similarity of ``threshold`` or more, each set named
    by the smallest id that has it.

    Sets are partitioned by length into bands [t^-k, t^-(k+1)), so partners are in the same band or the next; only a
    set's first signatures, without which it cannot reach the threshold, are joined. Empty sets have no partners; rows with
    a NULL id are left out.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), utf8(text_col).alias("body")).filter("id IS NOT NULL")
    sets = rows.mapInArrow(_sets, "id bigint, sigs array<bigint>").filter(F.size("sigs") > 0)
    sets = sets.groupBy("sigs").agg(F.min("id").alias("id")).withColumn("n", F.size("sigs"))
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(threshold)).cast("int")
    prefix = F.slice("sigs", F.lit(1), (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int"))
    spread = sets.select("id", "n", band.alias("band"), F.explode(prefix).alias("sig"))
    here = spread.select(F.col("id").alias("a"), F.col("n").alias("na"), "band", "sig")
    both = spread.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.explode(F.array("band", F.col("band") - 1)).alias("band"), "sig")
    near = here.join(both, ["band", "sig"]).filter("a <> b AND na <= nb").filter(F.col("na") >= F.col("nb") * threshold - 1e-9)
    pairs = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left, right = sets.select(F.col("id").alias("a"), F.col("sigs").alias("x")), sets.select(F.col("id").alias("b"), F.col("sigs").alias("y"))
    joined = pairs.join(left, "a").join(right, "b")
    similarity = F.size(F.array_intersect("x", "y")) / F.size(F.array_union("x", "y"))
    return joined.select("a", "b", similarity.alias("similarity")).filter(F.col("similarity") >= threshold - 1e-9)
