"""Language by prediction by partial matching.

For every language a context tree of up to four bytes holds how often each byte follows each context inside a word
(the space before a word opens it, the space behind closes it). A byte costs its share in the longest context that
has seen it, after an escape from every longer one (method C: a context of n bytes, d of them distinct, escapes with
d / (n + d)); below the empty context all 256 bytes cost alike. Statistics are counted over all training documents and
then frozen. A text's language is the one with the shortest code.

A byte string joins a tree when it makes up at least 1/2^15 of its language's bytes, so an order has at most 2^15 nodes
whatever the corpus, and the broadcast model is bounded by 5 * 2^15 nodes a language.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import Remembered, fold, utf8, written

ORDER = 4
SHARE = 1 / (1 << 15)
LONGEST = 64
# Bytes handled at once, and distinct windows a task remembers.
BLOCK, MOST = 1 << 20, 500_000
UNKNOWN = "und"


def _spaced(body: bytes) -> bytes:
    """The lower-cased words with one space before, between and behind them. A run is cut every 64 bytes."""
    words = body.lower().split()
    if any(len(w) > LONGEST for w in words):
        words = [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    return b" " + b" ".join(words) + b" " if words else b""


def _windows(bodies: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For blocks of the texts' coded bytes, the text each byte belongs to and its window: the byte with the (at most
    four) bytes before it inside its word, packed into a number that ends with the byte and opens with the length."""
    texts, lengths = zip(*((t, len(t)) for t in map(_spaced, bodies))) if bodies else ((), ())
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(lengths, dtype=np.int64)
    opening = np.zeros(len(raw), bool)
    opening[[e - n for e, n in zip(ends.tolist(), lengths) if n]] = True
    for at in range(0, len(raw), BLOCK):
        # No word is longer than LONGEST, so the space before every byte of the block is in view.
        back = max(0, at - LONGEST - 1)
        view = raw[back : at + BLOCK]
        place = np.arange(len(view))
        space = np.maximum.accumulate(np.where(view == 32, place, 0))
        coded = np.flatnonzero(~opening[back : at + BLOCK])
        coded = coded[coded >= at - back]
        depth = np.minimum(ORDER, coded - space[coded - 1])
        packed = view[coded].astype(np.int64)
        for k in range(1, ORDER + 1):
            packed |= np.where(depth >= k, view[np.maximum(coded - k, 0)], 0).astype(np.int64) << (8 * k)
        yield np.searchsorted(ends, coded + back, side="right"), packed | (depth << (8 * ORDER + 8))


def _gram(window: int) -> bytes:
    return window.to_bytes(ORDER + 2, "big")[-(window >> (8 * ORDER + 8)) - 1 :]


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language of every context with its next byte."""

    def taken(lang: str, seen: Counter) -> pa.RecordBatch:
        grams: Counter = Counter()
        for window, n in seen.items():
            gram = _gram(window)
            for k in range(len(gram)):
                grams[gram[k:]] += n
        langs = pa.array([lang] * len(grams), pa.string())
        return pa.RecordBatch.from_arrays([langs, pa.array(grams.keys(), pa.binary()), pa.array(grams.values(), pa.int64())], ["lang", "gram", "n"])

    held: dict[str, Counter] = {}
    for batch in batches:
        bodies: dict[str, list[bytes]] = {}
        for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist()):
            bodies.setdefault(lang, []).append(body)
        for lang, own in bodies.items():
            seen = held.setdefault(lang, Counter())
            for _, found in _windows(own):
                distinct, n = np.unique(found, return_counts=True)
                seen.update(dict(zip(distinct.tolist(), n.tolist())))
            if len(seen) > MOST:
                yield taken(lang, held.pop(lang))
    for lang, seen in held.items():
        yield taken(lang, seen)


class Tree:
    """Bits of a byte after a context, and of an escape from it."""

    def __init__(self, counts: dict[bytes, int]) -> None:
        total, distinct = Counter(), Counter()
        for gram, n in counts.items():
            total[gram[:-1]] += n
            distinct[gram[:-1]] += 1
        self.seen = {g: math.log2((total[g[:-1]] + distinct[g[:-1]]) / n) for g, n in counts.items()}
        self.escape = {c: math.log2((total[c] + distinct[c]) / distinct[c]) for c in total}

    def bits(self, word: bytes) -> float:
        s = b" " + word + b" "
        return sum(self.cost(s[max(0, i - ORDER) : i + 1]) for i in range(1, len(s)))

    def cost(self, gram: bytes) -> float:
        """Bits of the last byte after the bytes before it."""
        out = 0.0
        for k in range(len(gram)):
            if (cost := self.seen.get(gram[k:])) is not None:
                return out + cost
            out += self.escape.get(gram[k:-1], 0.0)
        return out + 8.0


def learn(docs: DataFrame, parts: int = 5, held_out: int = 0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, Tree]:
    """A tree per language, from all documents with a language outside the held-out fold."""
    train = docs.filter(F.col(lang_col).isNotNull() & (fold(id_col, parts) != held_out))
    train = train.select(F.col(lang_col).cast("string").alias("lang"), utf8(text_col).alias("body"))
    grams = train.mapInArrow(_grams, "lang string, gram binary, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    grams = written(grams, "grams")
    # Order 0 counts every byte once.
    bytes_of = grams.filter(F.length("gram") == 1).groupBy("lang").agg(F.sum("n").alias("bytes"))
    kept = grams.join(bytes_of, "lang").filter(F.col("n") >= F.col("bytes") * SHARE)
    counts: dict[str, dict[bytes, int]] = {}
    for r in kept.select("lang", "gram", "n").toLocalIterator():
        counts.setdefault(r["lang"], {})[bytes(r["gram"])] = r["n"]
    return {lang: Tree(c) for lang, c in sorted(counts.items())}


def _predicted(trees: dict[str, Tree]):
    langs, n = list(trees), len(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(lambda g: np.array([t.cost(g) for t in trees.values()]).tobytes(), MOST)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            bits = np.zeros((n, len(texts)))
            for owner, found in _windows([t.encode() for t in texts] if n else []):
                distinct, where = np.unique(found, return_inverse=True)
                costs = np.frombuffer(b"".join(known[_gram(w)] for w in distinct.tolist())).reshape(-1, n)
                for total, cost in zip(bits, costs.T):
                    total += np.bincount(owner, cost[where], minlength=len(texts))
            names, scores = [], []
            for text, own in zip(texts, bits.T):
                if not n or not any(map(str.isalpha, text)):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(own.argmin())
                names.append(langs[best])
                scores.append(float(1 / np.exp2(np.maximum(own[best] - own, -1000)).sum()))
            columns = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "lang_pred", "score"])

    return run


def predict_language(docs: DataFrame, trees: dict[str, Tree], text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, the share of that language among all when each is as likely as its code is short.

    A NULL text, one without a letter, and any text without a learned language is ``und`` with score 0. Equal code lengths
    go to the first language by name. Rows come back one to one, also repeated ones and those with a NULL id; columns
    named lang_pred or score are replaced. An empty frame stays empty.
    """
    base = docs.drop("lang_pred", "score")
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema) + ", lang_pred string, score double"
    return base.withColumn("__text", F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(_predicted(trees), out)


def language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score per document."""
    found = predict_language(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
