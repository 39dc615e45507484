"""Token ids in files of directly addressable codes.

A block of ids is split into levels of eight bits. Level 0 holds every id's lowest eight bits; a continuation bitmap
marks the ids that go on, and the next level holds the next eight bits of those only. A rank directory (set bits
before every 512th position) turns a position of one level into its position of the next by one lookup and one
popcount, so any id is read without decoding its block.

Blocks are rows of a Parquet table, in ascending document order: part (range of document ids), block, first
position in the part, number of ids, the documents and their starts in the block, and the levels' bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.token_ids import byte_level
from cohortry.session import scratch_path

MAGIC = b"DAC8"
RANK_STEP = 512
BLOCK_IDS = 1 << 20
FILE_SCHEMA = "part int, block int, first bigint, n_ids bigint, doc_ids array<bigint>, starts array<bigint>, codes binary"


def encode_block(ids: np.ndarray) -> bytes:
    """Magic, number of levels; per level the position count, the chunks, the bitmap and the rank directory."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        on = rest > 0xFF
        bits = np.packbits(on, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(on)[RANK_STEP - 1 :: RANK_STEP]]).astype("<u4")
        levels.append(struct.pack("<I", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[on] >> 8
        if not len(rest):
            return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)


class Block:
    """Random access to the ids of an encoded block."""

    def __init__(self, codes: bytes) -> None:
        if codes[:4] != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        self.levels, at = [], 8
        for _ in range(struct.unpack_from("<I", codes, 4)[0]):
            (n,) = struct.unpack_from("<I", codes, at)
            chunks = np.frombuffer(codes, np.uint8, n, at + 4)
            at += 4 + n
            bits = np.frombuffer(codes, np.uint8, (n + 7) // 8, at)
            at += len(bits)
            ranks = np.frombuffer(codes, "<u4", n // RANK_STEP + 1, at)
            at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _continued(self, bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before position ``i``."""
        step, byte = i // RANK_STEP, i // 8
        run = int.from_bytes(bits[step * RANK_STEP // 8 : byte + 1].tobytes(), "little")
        return int(ranks[step]) + (run & ((1 << (i - step * RANK_STEP)) - 1)).bit_count()

    def __getitem__(self, i: int) -> int:
        value = 0
        for shift, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * shift)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._continued(bits, ranks, i)
        return value

    def run(self, start: int, stop: int) -> np.ndarray:
        """Ids at [start, stop): the positions of a run stay a run on every level, so two rank lookups place it."""
        out = np.zeros(stop - start, np.uint32)
        where = np.arange(stop - start)
        for shift, (chunks, bits, ranks) in enumerate(self.levels):
            if start >= stop:
                break
            out[where] |= chunks[start:stop].astype(np.uint32) << np.uint32(8 * shift)
            on = np.unpackbits(bits[start // 8 : (stop + 7) // 8], bitorder="little")[start % 8 :][: stop - start].astype(bool)
            start = self._continued(bits, ranks, start)
            where = where[on]
            stop = start + len(where)
        return out


def _blocks(path: str, end_id: int, block_ids: int, special: bool):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level(path, special)
        part, block, first = TaskContext.get().partitionId(), 0, 0
        docs, starts, held, n = [], [], [], 0

        def taken() -> pa.RecordBatch:
            codes = encode_block(np.frombuffer(b"".join(held), "<u4"))
            arrays = [
                pa.array([part], pa.int32()),
                pa.array([block], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([n], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())),
                pa.array([starts], pa.list_(pa.int64())),
                pa.array([codes], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["part", "block", "first", "n_ids", "doc_ids", "starts", "codes"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs.append(doc_id)
                starts.append(n)
                held.append(encode(text.as_py()) + end)
                n += len(held[-1]) // 4
                if n >= block_ids:
                    yield taken()
                    block, first = block + 1, first + n
                    docs, starts, held, n = [], [], [], 0
        if docs:
            yield taken()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
    special: bool = False,
) -> None:
    """Encodes the documents in ascending id order (NULL ids first, equal ids by text) and writes their blocks to ``path``.

    A NULL or empty text is the end id alone. A block ends with the document that fills it. An empty frame writes no block.
    ``special`` gives the strings of special tokens in a text their own ids.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).alias("body")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), body)
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "body")
    ordered.mapInArrow(_blocks(vocabulary, end_id, block_ids, special), FILE_SCHEMA).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, n, docs, starts, codes in zip(
            batch.column("first").to_pylist(),
            batch.column("n_ids").to_pylist(),
            batch.column("doc_ids").to_pylist(),
            batch.column("starts").to_pylist(),
            batch.column("codes"),
        ):
            block, sums = Block(codes.as_py()), []
            for a, b in zip(starts, [*starts[1:], n]):
                sums.append(zlib.crc32(block.run(a, b).astype("<u4").tobytes()))
            starts = np.array(starts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array(starts + first, pa.int64()),
                    pa.array(np.diff(starts, append=n), pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """A row per document: doc_id, start (ids of all documents before it), n_tokens with the end id, crc32 of the ids.

    The only numbers that meet are one id count per part.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    ends = files.groupBy("part").agg(F.max(F.col("first") + F.col("n_ids")).alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ends.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    # One row per part of the files, so its size is bounded by the number of partitions written.
    placed = files.join(F.broadcast(offsets), "part").withColumn("first", F.col("first") + F.col("before"))
    return placed.select("first", "n_ids", "doc_ids", "starts", "codes").mapInArrow(
        _documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_files(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Writes the documents' files to the shared folder and reads them back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, vocabulary, **options)
    return read_token_files(docs.sparkSession, path)
