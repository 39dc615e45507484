"""Toxicity by weak supervision.

Words and their inner 4- to 7-grams are hashed to terms. On a bounded sample of labelled documents the terms most typical of either label
become lexicons: small ones of whole words that vote when any word occurs, and large ones of n-grams that vote when their
summed rates are higher than on nearly all clean documents. Each lexicon is a voter, and so are a few patterns. A generative label
model estimates by expectation-maximisation, from the votes alone, how often each voter fires on either class, and from
what agreement is left given the class how correlated voters are, so that echoes count less. Labels choose the lexicons and give the
classes their share and name; no document's own label enters its posterior. The posteriors train a linear classifier on
the lexicon terms' rates, which scores every document. What is broadcast is the classifier: a few thousand numbers, whatever the
corpus.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import fold, utf8, written
from cohortry.llm.labelled import labelled_sample, logistic, sigmoid

#: Hashed n-grams lie below TERMS, hashed whole words from there on.
TERM_BITS = 18
TERMS = 1 << TERM_BITS
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
GRAMS = (4, 5, 6, 7)
SAMPLE = 12_000
TOXIC_TERMS, CLEAN_TERMS, PER_LEXICON = 900, 200, 50
WORD_LEXICONS, PER_WORD_LEXICON = 24, 4
#: Documents that must hold a term; toxic ones to one clean one that must hold a word of a lexicon.
SUPPORT, OFTEN = 5, 4
#: A lexicon of n-grams votes on documents whose summed rates pass this share of the clean sample.
SILENT = 0.999
#: How much a voter's silence says against its vote; most voters know only a part of what is toxic.
SILENCE = 0.2
AROUND = b".,;:!?|#$%&*()\"'"
UPPER = bytes(65 if 65 <= b <= 90 else 46 for b in range(256))

#: Patterns that vote toxic when they fire (abuse aimed at the reader, masked words, shouting), each with a quick test that every match passes.
PATTERNS = (
    (rb"(?i)\byou(?:'re| are)? (?:an? |such |all )*\w+(?:s|t|d)\b[!]", lambda body: b"!" in body and b"you" in body.lower()),
    (rb"(?i)\b[a-z]{1,3}[*@#$]{2,}[a-z]{0,3}\b", lambda body: any(a + b in body for a in MASKS for b in MASKS)),
    (rb"(?:\b[A-Z]{4,}\b[ ,!]+){3,}", lambda body: body.translate(UPPER).count(b"AAAA") > 2),
    (rb"!{3,}", lambda body: b"!!!" in body),
)
MASKS = (b"*", b"@", b"#", b"$")


def _terms(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, term) of all words: hashes of the n-grams between ``^`` and ``$``, and of the words themselves."""
    cores = [w.strip(AROUND) for w in words]
    letters = np.frombuffer(b"^" + b"$^".join(cores) + b"$", np.uint8)
    # Where a word's sign for its end stands, by the sizes: the sign itself may be in a word.
    sizes = np.fromiter(map(len, cores), np.int64, len(cores)) + 2
    owner = np.repeat(np.arange(len(cores)), sizes)
    packed, whose, found = letters.astype(np.uint64), [], []
    for k in range(2, min(GRAMS[-1], len(letters)) + 1):
        # The n-gram that starts at each place, one byte longer than before, while it stays in its word.
        packed = packed[:-1] | (letters[k - 1 :].astype(np.uint64) << np.uint64(8 * k - 8))
        if k in GRAMS:
            inside = owner[: len(packed)] == owner[k - 1 :]
            whose.append(owner[: len(packed)][inside])
            found.append((packed[inside] * MULTIPLIER) >> np.uint64(64 - TERM_BITS))
    some = np.flatnonzero(sizes > 2)
    whose.append(some)
    found.append(np.fromiter((TERMS + zlib.crc32(cores[i]) % TERMS for i in some), np.uint64, len(some)))
    return np.concatenate(whose), np.concatenate(found).astype(np.int64)


class _Known(dict):
    """word -> its terms' places among the chosen ones; the unknown words of a document are looked up together."""

    def __init__(self, place: np.ndarray, most: int) -> None:
        super().__init__()
        self.place, self.most = place, most

    def of(self, words: list[bytes]) -> list[tuple[int, ...]]:
        found = list(map(self.get, words))
        if None not in found:
            return found
        unknown = list({w for w, f in zip(words, found) if f is None})
        if len(self) > self.most:
            self.clear()
            unknown = list(set(words))
        self.update(dict.fromkeys(unknown, ()))
        owner, terms = _terms(unknown)
        at = self.place[terms]
        hits = np.flatnonzero(at >= 0)
        for i, t in sorted(set(zip(owner[hits].tolist(), at[hits].tolist()))):
            self[unknown[i]] += (t,)
        return list(map(self.__getitem__, words))


def _counted(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of a document and how many of its words have them."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    times = Counter(words)
    owner, terms = _terms(list(times))
    both = np.unique(np.stack([terms, owner]), axis=1) if len(terms) else np.empty((2, 0), np.int64)
    distinct, which = np.unique(both[0], return_inverse=True)
    return distinct, np.bincount(which, np.array(list(times.values()))[both[1]], len(distinct))


def _term_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per term and label: documents with it and the sum of its rates."""
    docs, rates = np.zeros((2, 2 * TERMS)), np.zeros((2, 2 * TERMS))
    for batch in batches:
        for y, body in zip(batch.column("y").to_pylist(), batch.column("body")):
            words = body.as_py().lower().split()
            at, n = _counted(words)
            docs[y, at] += 1
            rates[y, at] += n / max(1, len(words))
    for y in (0, 1):
        at = np.flatnonzero(docs[y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), y), pa.int32()), pa.array(at), pa.array(docs[y, at]), pa.array(rates[y, at])], ["y", "term", "docs", "rate"]
        )


class Vectors:
    """The terms of a document among the chosen ones with their rates, pattern flags behind them, and a one for the intercept."""

    def __init__(self, chosen: np.ndarray) -> None:
        place = np.full(2 * TERMS, -1, np.int64)
        place[chosen] = np.arange(len(chosen))
        self.n = len(chosen)
        self.width = self.n + len(PATTERNS) + 1
        self.patterns = [(self.n + j, re.compile(p).search, test) for j, (p, test) in enumerate(PATTERNS)]

        self.words = _Known(place, 400_000)

    def __call__(self, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = body.lower().split()
        hits = [i for found in self.words.of(words) if found for i in found]
        fired = [j for j, search, test in self.patterns if test(body) and search(body)]
        at, n = np.unique(np.array(hits, np.int64), return_counts=True)
        rates = np.minimum(1, 8 * np.sqrt(n / max(1, len(words))))
        return np.concatenate([at, [*fired, self.width - 1]]).astype(np.int32), np.concatenate([rates, np.ones(len(fired) + 1)]).astype(np.float32)


def _sample_rows(chosen: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = Vectors(chosen)
        for batch in batches:
            rows = [vector(b.as_py()) for b in batch.column("body")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("y"), *(pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (0, 1))],
                ["id", "y", "at", "rate"],
            )

    return run


def label_model(votes: np.ndarray, prior: float, rounds: int = 40) -> np.ndarray:
    """Posterior of class 1 per row from votes (1 fires, 0 does not) and the share of class 1.

    It starts from the rows on which any voter fires. Correlated voters share their say: a voter's log-odds are divided by
    the sum of its squared correlations with all voters (itself included), given the class.
    """
    votes = np.asarray(votes, float)
    share = np.ones(votes.shape[1])
    p = np.where(votes.any(axis=1), 0.8, 0.05)
    for i in range(rounds):
        on1, on0 = ((votes * q[:, None]).sum(0) + 0.5 for q in (p, 1 - p))
        on1, on0 = on1 / (p.sum() + 1), on0 / ((1 - p).sum() + 1)
        if i % 10 == 5:
            left = votes - np.outer(p, on1) - np.outer(1 - p, on0)
            scale = np.sqrt((left**2).sum(0)) + 1e-9
            corr = (left.T @ left) / np.outer(scale, scale)
            share = 1 / np.maximum(1, (corr**2).sum(0))
        fires, silent = np.log(on1 / on0) * share, np.log((1 - on1) / (1 - on0)) * share * SILENCE
        p = sigmoid(math.log(prior / (1 - prior)) + votes @ fires + (1 - votes) @ silent)
    return p


def fit(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Chosen terms and weights; with one label only, no terms and the sample's rate."""
    sample = labelled_sample(docs, labels, "toxic", 3, 1, most, id_col, text_col)
    stats = sample.mapInArrow(_term_stats, "y int, term bigint, docs double, rate double")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        rate = np.log((ones + 0.5) / (zeros + 0.5)) if ones + zeros else -2.0
        return np.empty(0, np.int64), np.array([0.0] * len(PATTERNS) + [rate], np.float32)
    pivot = lambda c, y: F.sum(F.when(F.col("y") == y, F.col(c)).otherwise(0.0))
    by_term = stats.groupBy("term").agg(*[pivot(c, y).alias(f"{c}{y}") for c in ("docs", "rate") for y in (0, 1)])
    odds = F.log((F.col("rate1") / ones + 1e-5) / (F.col("rate0") / zeros + 1e-5))
    ranked = by_term.filter(F.col("docs0") + F.col("docs1") >= SUPPORT).select("term", "docs0", "docs1", odds.alias("odds"))
    ranked = written(ranked, "terms")
    toxic = ranked.orderBy((-F.col("odds") * F.sqrt("docs1")), "term").limit(TOXIC_TERMS).collect()
    clean = ranked.orderBy((F.col("odds") * F.sqrt("docs0")), "term").limit(CLEAN_TERMS).collect()
    held = F.log((F.col("docs1") / ones + 1e-3) / (F.col("docs0") / zeros + 1e-3)) * F.sqrt("docs1")
    often = (F.col("term") >= TERMS) & (F.col("docs1") >= SUPPORT) & (F.col("docs1") >= OFTEN * F.col("docs0"))
    words = ranked.filter(often).orderBy(-held, "term").limit(WORD_LEXICONS * PER_WORD_LEXICON).collect()
    chosen = np.array(list(dict.fromkeys([r["term"] for r in (*toxic, *clean, *words)])), np.int64)
    place = {t: i for i, t in enumerate(chosen.tolist())}
    rows = sample.mapInArrow(_sample_rows(chosen), "id bigint, y int, at binary, rate binary").orderBy("id").collect()
    x = np.zeros((len(rows), len(chosen) + len(PATTERNS) + 1), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["rate"], np.float32)
    y = np.array([r["y"] for r in rows], float)
    votes = []
    for start in range(0, len(words), PER_WORD_LEXICON):
        own = [place[r["term"]] for r in words[start : start + PER_WORD_LEXICON]]
        votes.append((x[:, own] > 0).any(axis=1))
    for side in (toxic, clean):
        own = [place[r["term"]] for r in side]
        lexicons = max(1, len(own) // PER_LEXICON)
        for i in range(lexicons):
            sums = x[:, own[i::lexicons]].sum(axis=1)
            votes.append(sums > max(np.quantile(sums[y == 0], SILENT), 0.0))
    votes += list(x[:, len(chosen) : -1].T > 0)
    return chosen, logistic(x, label_model(np.stack(votes, axis=1), ones / (ones + zeros))).astype(np.float32)


def _scored(chosen: np.ndarray, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = Vectors(chosen)
        for batch in batches:
            scores = []
            for body in batch.column(batch.num_columns - 1):
                at, rates = vector(body.as_py())
                scores.append(float(sigmoid(float(rates @ weights[at]))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())], [*batch.schema.names[:-1], "score"]
            )

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1, higher: toxic likelier), from its text alone.

    ``most`` bounds the labelled documents used for fitting. A NULL or empty text has the score of no evidence. Without
    labels of both kinds every score is the labels' rate (0.12 without any). Rows come back one to one, also repeated
    ones and those with a NULL id; a column named score is replaced. An empty frame stays empty.
    """
    chosen, weights = fit(docs, labels, most, id_col, text_col)
    base = docs.drop("score")
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema) + ", score double"
    return base.withColumn("__body", utf8(text_col)).mapInArrow(_scored(chosen, weights), out)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) per document."""
    scored = score_toxicity(docs.select("doc_id", "text"), labels, **options)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
