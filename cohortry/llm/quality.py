"""Text quality by nearest-neighbour voting among labelled latent-semantic vectors.

A document is a vector of hashed terms: the shapes of its words (letters and digits folded, marks kept), pairs of
neighbouring shapes, repeats of the word before, and the words themselves. Terms are weighted by their inverse document
frequency over all documents. A truncated singular value decomposition of a bounded sample of labelled documents
gives the latent space. The sample's vectors are broadcast (``most`` * ``RANK`` floats, so the bound is known);
every document's cosine with all of them is computed exactly, in blocks, and the nearest vote by similarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import Remembered, fold, utf8
from cohortry.llm.labelled import labelled_sample

SHAPES, PAIRS, WORDS = 256, 256, 256
REPEAT = SHAPES + PAIRS + WORDS
LONG = REPEAT + 1
DIMS = REPEAT + 2
SAMPLE, RANK, NEIGHBOURS = 4096, 48, 15
BLOCK = 512

_FOLD = bytes(97 if chr(b).isalpha() or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))


def _word(word: bytes) -> int:
    """Shape and word term of a word, packed into one number."""
    shape = word.translate(_FOLD)
    short = bytes(c for i, c in enumerate(shape) if i == 0 or c != shape[i - 1] or c not in b"a0")
    return (zlib.crc32(short[:64]) % SHAPES) << 8 | zlib.crc32(word.lower()) % WORDS


def counts(body: bytes, known: Remembered) -> np.ndarray:
    """Square roots of the terms' shares of the document's words."""
    words = body.split()
    out = np.zeros(DIMS, np.float32)
    n = len(words)
    if not n:
        return out
    packed = np.fromiter(map(known.__getitem__, words), np.int64, n)
    shapes = packed >> 8
    out[:SHAPES] = np.bincount(shapes, minlength=SHAPES)
    pairs = (shapes[1:] * 31 + shapes[:-1] * 17) % PAIRS
    out[SHAPES : SHAPES + PAIRS] = np.bincount(pairs, minlength=PAIRS)
    out[SHAPES + PAIRS : REPEAT] = np.bincount(packed & 0xFF, minlength=WORDS) * 0.1
    out[REPEAT] = 4 * np.count_nonzero(packed[1:] == packed[:-1])
    out[LONG] = max(0, len(body) / n - 8)
    return np.sqrt(out / n)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, seen, n = Remembered(_word, 300_000), np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for body in batch.column(0):
            seen += counts(body.as_py(), known) > 0
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array([*range(DIMS), DIMS]), pa.array([*seen.tolist(), n])], ["term", "n"])


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = Remembered(_word, 300_000)
    for batch in batches:
        rows = [counts(b.as_py(), known).tobytes() for b in batch.column("body")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(rows, pa.binary())], ["id", "y", "x"])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Space:
    """Term weights, the latent axes, the labelled vectors and their labels."""

    def __init__(self, weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        self.weights = weights.astype(np.float32)
        rows = _unit(x * self.weights)
        _, axes = np.linalg.eigh(rows.T.astype(float) @ rows)
        self.axes = np.ascontiguousarray(axes[:, ::-1][:, :RANK], np.float32)
        self.vectors = np.ascontiguousarray(_unit(rows @ self.axes).T)
        self.y = y.astype(np.float32)
        self.rate = float(y.mean()) if len(y) else 0.5

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Labels of the nearest vectors weighted by similarity; without any word the sample's rate."""
        if not len(self.y):
            return np.full(len(x), self.rate)
        some = x.any(axis=1)
        cosines = _unit(_unit(x * self.weights) @ self.axes) @ self.vectors
        k = min(NEIGHBOURS, len(self.y))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6).astype(float) ** 8
        return np.where(some, (weight * self.y[near]).sum(1) / weight.sum(1), self.rate)


def fit(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str) -> Space:
    freq = docs.select(utf8(text_col).alias("body")).mapInArrow(_frequencies, "term bigint, n bigint")
    seen = np.zeros(DIMS + 1)
    for r in freq.groupBy("term").agg(F.sum("n").alias("n")).collect():
        seen[r["term"]] = r["n"]
    weights = np.log((seen[DIMS] + 1) / (seen[:DIMS] + 1)) + 1
    sample = labelled_sample(docs, labels, "quality", 5, 0, most, id_col, text_col)
    rows = sample.mapInArrow(_sample_rows, "id bigint, y int, x binary").orderBy("id").collect()
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]) if rows else np.zeros((0, DIMS), np.float32)
    return Space(weights, x, np.array([r["y"] for r in rows], float))


def _scored(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(_word, 300_000)
        for batch in batches:
            bodies, scores = batch.column(batch.num_columns - 1), []
            for at in range(0, len(bodies), BLOCK):
                x = np.stack([counts(b.as_py(), known) for b in bodies[at : at + BLOCK]])
                scores += space.scores(x).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], [*batch.schema.names[:-1], "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1, higher: good likelier), from its text alone.

    ``most`` bounds the labelled documents used for fitting and broadcast; term statistics cover all documents. A NULL or
    empty text scores the sample's rate of good documents (0.5 without labels). Rows come back one to one, also
    repeated ones and those with a NULL id; a column named score is replaced. An empty frame stays empty.
    """
    space = fit(docs, labels, most, id_col, text_col)
    base = docs.drop("score")
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema) + ", score double"
    return base.withColumn("__body", utf8(text_col)).mapInArrow(_scored(space), out)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) per document."""
    scored = score_quality(docs.select("doc_id", "text"), labels, **options)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
