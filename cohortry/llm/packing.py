"""Hierarchical multi-length packing of token ids into training sequences.

Each task packs the documents of its own partition; nothing is shuffled. A document's whole longest windows become
sequences of their own. What is left of it goes to the smallest tier (512, 1024, 2048 or 4096 ids) that holds it.
Tiers are packed from the longest down: a window starts with the longest piece of its tier, its gap takes the
longest pieces of this and shorter tiers that fit, and a last gap is closed by cutting the piece that leaves the
least behind. A chunk's unfilled window is carried on; at the partition's end the rest becomes windows of powers of
two. So every sequence is full and nothing is padded. Sequences of one length form step groups of equal id counts.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.token_ids import word_level, word_level_once

TIERS = (512, 1024, 2048, 4096)
CHUNK_IDS = 1 << 20
STEP_IDS = 1 << 16
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "sequence_length int, step_group bigint"
)
FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group")


class Packer:
    """Packs pieces (document number, start, length); ``emit`` gets a full window's length and its pieces."""

    def __init__(self, emit, tiers: tuple[int, ...] = TIERS) -> None:
        self.emit, self.tiers = emit, tiers
        self.pool: list[tuple[int, int, int]] = []  # (length, document, start) in ascending order

    def add(self, doc: int, n: int) -> None:
        longest = self.tiers[-1]
        for start in range(0, n - longest + 1, longest):
            self.emit(longest, [(doc, start, longest)])
        if rest := n % longest:
            insort(self.pool, (rest, doc, n - rest))

    def pack(self) -> None:
        """Full windows of every tier, longest tier first; pieces that fill none stay in the pool."""
        for tier, below in zip(self.tiers[::-1], (*self.tiers[-2::-1], 0)):
            kept: list[list[tuple[int, int, int]]] = []
            while (at := bisect_right(self.pool, (tier, float("inf"))) - 1) >= 0 and self.pool[at][0] > below:
                window, gap = [], tier
                while gap and self.pool:
                    at = bisect_right(self.pool, (gap, float("inf"))) - 1
                    if at >= 0:
                        n, doc, start = self.pool.pop(at)
                    else:  # all are longer than the gap: cut the shortest of them
                        n, doc, start = self.pool.pop(0)
                        insort(self.pool, (n - gap, doc, start + gap))
                        n = gap
                    window.append((doc, start, n))
                    gap -= n
                if gap:
                    kept.append(window)
                    break
                self.emit(tier, window)
            for doc, start, n in (piece for window in kept for piece in window):
                insort(self.pool, (n, doc, start))

    def finish(self) -> None:
        """The rest of the pool as windows of powers of two."""
        self.pack()
        rest = sorted(((doc, start, n) for n, doc, start in self.pool), reverse=True)
        self.pool = []
        left = sum(n for _, _, n in rest)
        while left:
            size = min(1 << (left.bit_length() - 1), self.tiers[-1])
            window, gap = [], size
            while gap:
                doc, start, n = rest.pop()
                if n > gap:
                    rest.append((doc, start + gap, n - gap))
                    n = gap
                window.append((doc, start, n))
                gap -= n
            self.emit(size, window)
            left -= size


def _packed(path: str, end_id: int, tiers: tuple[int, ...], special: bool, lasting: bool = True):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = (word_level if lasting else word_level_once)(path, special)
        base = TaskContext.get().partitionId() << 33
        held: dict[int, tuple[int | None, bytes]] = {}
        out: list[list] = [[] for _ in FIELDS]
        made, of_length = 0, {}

        def emit(size: int, window: list[tuple[int, int, int]]) -> None:
            nonlocal made
            offset, turn = 0, of_length.get(size, 0)
            of_length[size] = turn + 1
            group = base | size.bit_length() << 28 | turn * size // STEP_IDS
            for doc, start, n in window:
                doc_id, ids = held[doc]
                crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + n)])
                row = (doc_id, start, n, crc, len(ids) // 4, base + made, offset, size, group)
                for column, value in zip(out, row):
                    column.append(value)
                offset += n
            made += 1

        def taken() -> pa.RecordBatch:
            types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], list(FIELDS))
            for column in out:
                column.clear()
            return batch

        packer, number, waiting = Packer(emit, tiers), 0, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                held[number] = (doc_id, ids)
                packer.add(number, len(ids) // 4)
                number, waiting = number + 1, waiting + len(ids) // 4
                if waiting >= CHUNK_IDS:
                    packer.pack()
                    needed = {doc for _, doc, _ in packer.pool}
                    held = {k: v for k, v in held.items() if k in needed}
                    waiting = 0
                    yield taken()
        packer.finish()
        yield taken()

    return run


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    tiers: tuple[int, ...] = TIERS,
    special: bool = False,
    lasting: bool = True,
) -> DataFrame:
    """A row per piece: the document's id, start and length in its ids, crc32 of the ids, the document's id count, and
    where the piece lies: sequence_id, offset, sequence_length (a power of two, always full), step_group.

    A NULL or empty text is the end id alone. Rows that repeat an id, and rows with a NULL id, are documents of their
    own. Other columns are ignored; an empty frame gives no rows. ``tiers`` are ascending powers of two.
    ``special`` gives the strings of special tokens in a text their own ids. ``lasting``: a worker keeps the pieces it has encoded
    for its next tasks; where other operators use the workers afterwards, that memory is theirs and each task keeps its own.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).alias("body")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), body).mapInArrow(_packed(vocabulary, end_id, tiers, special, lasting), SCHEMA)
