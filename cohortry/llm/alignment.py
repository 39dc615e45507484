"""Alignment of two tokenizers' ids through the byte offsets where both end a token.

Tasks work on blocks of documents in Arrow: the id lists are flattened with their parent indices, token byte lengths become
segmented cumulative sums, and a hash join of both sides' (document, end) keys finds the common ends, which cut the tokens
into groups. Each side's ids are counted per group, a hash join on the group gives the links, and ``Table.group_by`` sums them
per document. The aligned documents are written once. A second pass counts documents per id pair in every batch, Spark
merges these partial counts, and each document's links are looked up in them.

A null or empty text, and a text that one side does not give back byte for byte (one with U+2581, which that side
writes for a space), has no tokens: zeros and an empty digest. Repeated and NULL ids are separate documents; other columns of
the frame are not read. An empty frame gives an empty result. A document of any length is one block of its own.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cohortry.llm.common import written
from cohortry.session import broadcast_if_small

BLOCK_BYTES = 1 << 20
#: Up to this many id pairs, at 16 bytes each, the merged counts are broadcast; more are joined by a shuffle.
BROADCAST_PAIRS = 2_000_000
#: A pair of ids is one number: the A id above the B id.
A_SHIFT = 32
ALIGNED = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "links array<struct<pair:bigint,times:bigint>>"
)
LINK = pa.struct([("pair", pa.int64()), ("times", pa.int64())])
#: Before a space between a character that is none and a visible one, both vocabularies always end a token.
BETWEEN_WORDS = re.compile(r"(?<=[^ ])(?= \S)")
TOUCHING = re.compile(r"\s\s")
#: Such words stay apart when they follow each other, and so many are encoded at a time.
SPACED_WORD, TOGETHER = re.compile(r" \S+"), 500
#: Pieces of text whose ids a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 200_000, 256


def byte_level_ids(path: str):
    """A function pieces -> little-endian 32-bit ids of each by a byte-level vocabulary; strings of special tokens are plain text.

    Words that start with their space are encoded as one text, and its ids are cut where the words' bytes end."""
    # A task has one core.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    lengths = pc.fill_null(pc.binary_length(byte_level_tokens(path)), 0).to_numpy()

    def apart(pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in model.encode_batch_fast(pieces, add_special_tokens=False)]

    def together(words: list[str]) -> list[bytes]:
        ids = np.array(model.encode_batch_fast(["".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(lengths[ids])
        stops = np.cumsum([len(w.encode()) for w in words])
        at = np.searchsorted(ends, stops)
        if at[-1] >= len(ends) or (ends[at] != stops).any():
            return apart(words)
        run, cuts = ids.tobytes(), [0, *(4 * at + 4).tolist()]
        return [run[i:j] for i, j in zip(cuts, cuts[1:])]

    def encode(pieces: list[str]) -> list[bytes]:
        words = [p for p in pieces if SPACED_WORD.fullmatch(p)]
        found = {}
        for i in range(0, len(words), TOGETHER):
            some = words[i : i + TOGETHER]
            found.update(zip(some, together(some)))
        others = [p for p in pieces if p not in found]
        found.update(zip(others, apart(others)))
        return [found[p] for p in pieces]

    return encode


def piece_level_ids(path: str):
    """The same by a vocabulary of pieces, which puts a space before every text by itself.

    No entry has a space mark behind another character, nor a line break in it, so no merge crosses these places."""
    model = SentencePieceProcessor(model_file=path)
    entries = list(map(model.id_to_piece, range(model.get_piece_size())))
    if any(("▁" in p[1:] and p.strip("▁")) or "\n" in p for p in entries):
        raise ValueError(f"{path} has entries across words or lines")
    alone = [model.piece_to_id("▁")]
    line = model.encode("\n")

    def ids(pieces: list[str]) -> list[bytes]:
        # A piece without a space before it stands behind a line break.
        found = model.encode([p[1:] if p[:1] == " " else "\n" + p for p in pieces], num_threads=1)
        return [array("I", (f or alone) if p[:1] == " " else f[len(line) :]).tobytes() for p, f in zip(pieces, found)]

    return ids


class PairedIds:
    """The little-endian 32-bit ids of a spaced text by two vocabularies, made piece by piece; a repeated piece is looked up."""

    def __init__(self, a_ids, b_ids) -> None:
        self.both = a_ids, b_ids
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.line = self.made(["\n"])["\n"]

    def made(self, pieces: list[str]) -> dict[str, tuple[bytes, bytes]]:
        return dict(zip(pieces, zip(*(encode(pieces) for encode in self.both))))

    def pieces(self, spaced: str) -> list[str]:
        if TOUCHING.search(spaced):
            return BETWEEN_WORDS.split(spaced)
        lines = []
        for line in spaced.split("\n"):
            words = line.split(" ")
            lines += [words[0], *[" " + w for w in words[1:]], "\n"]
        return [p for p in lines[:-1] if p]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Both sides' ids of every text; pieces that are not known yet are encoded together."""
        cut = [self.pieces(t) for t in texts]
        held = set().union(*cut)
        unseen = held.difference(self.known)
        if len(self.known) + len(unseen) > REMEMBERED:
            self.older, self.known = self.known, {}
            unseen = held
        old = {p: self.older[p] for p in unseen if p in self.older}
        self.known.update(old)
        self.known.update(self.made([p for p in unseen if p not in old]))
        self.known["\n"] = self.line
        found = []
        for pieces in cut:
            ids = [self.known[p] for p in pieces]
            found.append((b"".join([a for a, _ in ids]), b"".join([b for _, b in ids])))
        for p in unseen:
            if len(p) > LONGEST:
                del self.known[p]
        return found


@cache
def byte_level_tokens(path: str) -> pa.Array:
    """The bytes of every id of a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    special = {t["id"]: t["content"].encode() for t in stored["added_tokens"]}
    ids = {i: bytes(byte_of[c] for c in token) for token, i in stored["model"]["vocab"].items() if i not in special} | special
    return pa.array([ids.get(i) for i in range(max(ids) + 1)], pa.binary())


@cache
def piece_level_tokens(path: str) -> pa.Array:
    """The bytes of every id of a vocabulary of pieces."""
    model = SentencePieceProcessor(model_file=path)

    def content(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return pa.array(map(content, range(model.get_piece_size())), pa.binary())


class _Side:
    """One tokenizer: the bytes of its tokens, and its ids as text with the sign that follows in a digest."""

    def __init__(self, tokens: pa.Array, last: str) -> None:
        self.tokens = tokens
        self.lengths = pc.fill_null(pc.binary_length(tokens), 0).cast(pa.int64())
        self.printed = pa.array([f"{i}{sign}" for i in range(len(tokens)) for sign in (",", last)], pa.binary())

    def lists(self, encoded: list[bytes]) -> pa.ListArray:
        offsets = np.cumsum([0, *(len(e) // 4 for e in encoded)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), "<i4")))

    def gives(self, encoded: bytes, text: bytes) -> bool:
        tokens = self.tokens.take(pa.array(np.frombuffer(encoded, "<i4")))
        return tokens.null_count == 0 and _data(tokens) == text


def _data(values: pa.Array) -> bytes:
    """The bytes of all values of an array that was just made, in one run."""
    return b"" if values.buffers()[2] is None else values.buffers()[2].to_pybytes()[: _offsets(values)[-1]]


def _offsets(values: pa.Array) -> np.ndarray:
    return np.frombuffer(values.buffers()[1], np.int32)[: len(values) + 1]


def _counted(keys: list[str], table: pa.Table, name: str) -> pa.Table:
    return table.group_by(keys, use_threads=False).aggregate([([], "count_all")]).rename_columns([*keys, name])


class _Flat:
    """All tokens of a block on one side: id, document, and the key of its end: document and bytes from its start."""

    def __init__(self, side: _Side, encoded: list[bytes], span: int, starts: pa.Array) -> None:
        lists = side.lists(encoded)
        self.side, self.ids, self.doc = side, pc.list_flatten(lists), pc.list_parent_indices(lists)
        ends = pc.subtract(pc.cumulative_sum(side.lengths.take(self.ids)), starts.take(self.doc))
        self.key = pc.add(pc.multiply(self.doc, span), ends)

    def keys(self, at: str) -> pa.Table:
        return pa.table({"key": self.key, at: pa.array(np.arange(len(self.ids)))})

    def cut(self, at: pa.ChunkedArray) -> None:
        """Marks the last token of each group; a token's group is the number of marks before it."""
        last = np.zeros(len(self.ids), bool)
        last[at.to_numpy()] = True
        self.last = last
        self.group = np.cumsum(last) - last

    def counts(self, name: str) -> pa.Table:
        return _counted(["group", name], pa.table({"group": self.group, name: self.ids}), f"n_{name}")

    def printed(self) -> np.ndarray:
        """Each token's place in its side's printed ids."""
        return self.ids.to_numpy() * 2 + self.last


def _digests(a: _Flat, b: _Flat, n_docs: int) -> list[str]:
    """sha256 of every document's groups ``a1,a2|b1`` joined by semicolons; without tokens the empty text."""
    total = len(a.ids) + len(b.ids)
    words = np.empty(total, np.int32)
    docs = np.bincount(a.doc.to_numpy(), minlength=n_docs) + np.bincount(b.doc.to_numpy(), minlength=n_docs)
    b_before = np.concatenate([[0], np.cumsum(np.bincount(b.group))])
    a_through = np.cumsum(np.bincount(a.group))
    words[np.arange(len(a.ids)) + b_before[a.group]] = a.printed()
    words[np.arange(len(b.ids)) + a_through[b.group]] = b.printed() + len(a.side.printed)
    text = pa.concat_arrays([a.side.printed, b.side.printed]).take(pa.array(words))
    offsets = _offsets(text)
    run, stops = memoryview(_data(text)), np.concatenate([[0], np.cumsum(docs)])
    return [
        hashlib.sha256(run[offsets[i] : offsets[j] - 1]).hexdigest() if j > i else ""
        for i, j in zip(stops[:-1].tolist(), stops[1:].tolist())
    ]


def align_block(ids: PairedIds, a_side: _Side, b_side: _Side, texts: list[str | None]) -> dict[str, pa.Array | list]:
    """Columns n_a, n_b, n_groups, n_links, groups_sha256 and links of a block of texts."""
    a_ids, b_ids, sizes = [], [], []
    spaced = [" " + t if t else "" for t in texts]
    for text, (a, b) in zip(spaced, ids.encode(spaced)):
        body = text.encode()
        whole = bool(text) and a_side.gives(a, body) and b_side.gives(b, body)
        a_ids.append(a if whole else b"")
        b_ids.append(b if whole else b"")
        sizes.append(len(body) if whole else 0)
    n, span = len(texts), max(sizes, default=0) + 1
    starts = pa.array(np.cumsum([0, *sizes[:-1]]))
    a, b = _Flat(a_side, a_ids, span, starts), _Flat(b_side, b_ids, span, starts)
    common = a.keys("a_at").join(b.keys("b_at"), "key", join_type="inner", use_threads=False)
    a.cut(common["a_at"])
    b.cut(common["b_at"])
    group_doc = a.doc.filter(pa.array(a.last))
    links = a.counts("a").join(b.counts("b"), "group", join_type="inner", use_threads=False)
    pair = pc.add(pc.shift_left(links["a"].cast(pa.int64()), A_SHIFT), links["b"].cast(pa.int64()))
    each = pa.table({"doc": group_doc.take(links["group"]), "pair": pair, "times": pc.multiply(links["n_a"], links["n_b"])})
    summed = each.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
    summed = summed.sort_by([("doc", "ascending"), ("pair", "ascending")]).combine_chunks()
    doc, times = summed["doc"].to_numpy(), summed["times_sum"].to_numpy()
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))])
    fields = [pa.array(summed["pair"].to_numpy()), pa.array(times)]
    per_doc = [np.bincount(x.to_numpy(), minlength=n) for x in (a.doc, b.doc, group_doc)]
    sums = np.concatenate([[0], np.cumsum(times)])
    return {
        "n_a": pa.array(per_doc[0]),
        "n_b": pa.array(per_doc[1]),
        "n_groups": pa.array(per_doc[2]),
        "n_links": pa.array(sums[offsets[1:]] - sums[offsets[:-1]]),
        "groups_sha256": pa.array(_digests(a, b, n)),
        "links": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(LINK))),
    }


@cache
def vocabularies(a_path: str, b_path: str) -> tuple[PairedIds, _Side, _Side]:
    ids = PairedIds(byte_level_ids(a_path), piece_level_ids(b_path))
    return ids, _Side(byte_level_tokens(a_path), "|"), _Side(piece_level_tokens(b_path), ";")


def _aligned(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(a_path, b_path)
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(sizes // BLOCK_BYTES)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
                part = batch.slice(start, stop - start)
                if part.num_rows:
                    columns = align_block(*both, part.column("text").to_pylist())
                    yield pa.RecordBatch.from_pydict({"row": part.column("row"), "doc_id": part.column("doc_id"), **columns})

    return run


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document, written once: counts of tokens, groups and links, the groups' digest, and the links by id pair."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")
    )
    return written(rows.mapInArrow(_aligned(a_path, b_path), ALIGNED), "aligned")


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per id pair in a batch; a document has a pair once."""
    for batch in batches:
        pairs = pc.list_flatten(batch.column("pairs"))
        yield from _counted(["pair"], pa.table({"pair": pairs}), "docs").to_batches()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """For every id pair that is linked: how many documents hold it, and whether that is its A id's highest count."""
    partial = aligned.select(F.col("links.pair").alias("pairs")).mapInArrow(_partial_counts, "pair bigint, docs bigint")
    counts = written(partial.groupBy("pair").agg(F.sum("docs").alias("docs")), "pair-counts")
    a_id = F.shiftright("pair", A_SHIFT)
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("highest"))
    # One row per id of a vocabulary.
    both = counts.join(F.broadcast(highest), a_id == F.col("a"))
    return both.select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, broadcast_pairs: int = BROADCAST_PAIRS, **columns: str) -> DataFrame:
    """Per document the counts of ``align_documents`` and, over its links, the sum of their pairs' document counts and how
    many of them are their A id's most frequent pair (ties included)."""
    aligned = align_documents(docs, a_path, b_path, **columns)
    counts = broadcast_if_small(pair_counts(aligned), broadcast_pairs)
    each = aligned.select("row", F.inline("links")).join(counts, "pair")
    sums = each.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
    )
    both = aligned.drop("links").join(sums, F.col("row") == F.col("_row"), "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_best", "count_sum")}
    return both.withColumns(zero).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
