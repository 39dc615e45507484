"""Fill-in-middle over texts stored as independent zstandard frames.

A stored text is a list of frames, each a zstandard frame of its own with whole units (white space and the word behind it), and the units
and code points before every frame. To cut a text, the two frames that hold the cuts are found by the cumulative units and
only they are searched; an output is a run of frames, decompressed one at a time, with the marks between. ``restored`` reads
such a run back without knowing the cuts: it looks for the marks alone.

Stored texts are a table of the shared folder, one row a document. A NULL text is empty; a NULL id is hashed as the empty text; repeated
ids are cut alike, each text on its own; columns of the frame other than id and text are not read. An empty frame gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import accumulate, islice
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import written

UNIT = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ENDS = tuple(b"%c" % c for c in b" \t\n\r\v\f")
#: White space that follows a word starts a unit.
WORD_END = re.compile(rb"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")
FRAME_BYTES = 1 << 16
PREFIX, SUFFIX, MIDDLE = MARKS = (b"<P>", b"<S>", b"<M>")
#: The segments of an output in order, each behind its mark.
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
FIM_PERCENT, SPM_PERCENT, SEED = 50, 80, 42
STORED = "doc_id bigint, n bigint, n_chars bigint, marked boolean, frames array<binary>, units_before array<bigint>, chars_before array<bigint>"


@cache
def _compress() -> Callable[[bytes], bytes]:
    return zstandard.ZstdCompressor(level=1).compress


@cache
def _decompress() -> Callable[[bytes], bytes]:
    return zstandard.ZstdDecompressor().decompress


def n_units(body: bytes) -> int:
    return len(body.split()) + body.endswith(ENDS)


def cut_frames(body: bytes, size: int = FRAME_BYTES) -> Iterator[bytes]:
    """Whole units, at least ``size`` bytes a frame but for the last one."""
    start = 0
    while start < len(body):
        end = len(body)
        if end - start > size:
            word = WORD_END.search(body, start + size - 1)
            end = word.end() if word else end
        yield body[start:end]
        start = end


class Stored(NamedTuple):
    """A stored text: frames and the units and code points before each."""

    n: int
    n_chars: int
    marked: bool
    frames: list[bytes]
    units_before: list[int]
    chars_before: list[int]

    def place(self, unit: int) -> tuple[int, int, int]:
        """Frame, byte in the frame, and code points of the text before a unit."""
        if unit >= self.n:
            return len(self.frames), 0, self.n_chars
        at = bisect.bisect_right(self.units_before, unit) - 1
        skip = unit - self.units_before[at]
        if not skip:
            return at, 0, self.chars_before[at]
        body = _decompress()(self.frames[at])
        byte = next(islice(UNIT.finditer(body), skip, None)).start()
        return at, byte, self.chars_before[at] + len(body[:byte].decode())

    def run(self, start: tuple[int, int, int], stop: tuple[int, int, int]) -> Iterator[bytes]:
        """The bytes between two places, frame by frame."""
        for i in range(start[0], min(stop[0] + 1, len(self.frames))):
            body = _decompress()(self.frames[i])
            yield body[start[1] if i == start[0] else 0 : stop[1] if i == stop[0] else len(body)]


def store(body: bytes, frame_bytes: int = FRAME_BYTES) -> Stored:
    bodies = list(cut_frames(body, frame_bytes))
    units, chars = [n_units(b) for b in bodies], [len(b.decode()) for b in bodies]
    return Stored(
        sum(units),
        sum(chars),
        any(m in body for m in MARKS),
        list(map(_compress(), bodies)),
        list(accumulate(units, initial=0))[:-1],
        list(accumulate(chars, initial=0))[:-1],
    )


class Transformed(NamedTuple):
    """Form, code points of prefix and middle (None if plain), and the output as a run of byte pieces that can be read again."""

    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: Callable[[], Iterator[bytes]]


def transform(text: Stored, doc_id: int | None, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> Transformed:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    first, end = (0, 0, 0), (len(text.frames), 0, text.n_chars)
    if not text.frames or text.marked or h3 % 100 >= fim:
        return Transformed("plain", None, None, lambda: text.run(first, end))
    low, high = map(text.place, sorted((h1 % (text.n + 1), h2 % (text.n + 1))))
    form = "spm" if h4 % 100 < spm else "psm"
    segment = {PREFIX: (first, low), MIDDLE: (low, high), SUFFIX: (high, end)}

    def output() -> Iterator[bytes]:
        for mark in ORDER[form]:
            yield mark
            yield from text.run(*segment[mark])

    return Transformed(form, low[2], high[2] - low[2], output)


def segments(pieces: Iterable[bytes], form: str) -> Iterator[tuple[bytes, bytes]]:
    """(mark, bytes) of an output that is read piece by piece; a mark may lie across pieces."""
    order = ORDER[form]
    held, now = b"", -1
    for piece in pieces:
        held += piece
        while now + 1 < len(order) and (at := held.find(order[now + 1])) >= 0:
            if now >= 0:
                yield order[now], held[:at]
            held, now = held[at + len(order[now + 1]) :], now + 1
        # The start of the next mark may already be there.
        keep = len(order[now + 1]) - 1 if now + 1 < len(order) else 0
        if now >= 0 and len(held) > keep:
            yield order[now], held[: len(held) - keep]
            held = held[len(held) - keep :]
    if now >= 0 and held:
        yield order[now], held


def restored(output: Callable[[], Iterable[bytes]], form: str) -> Iterator[bytes]:
    """The text of an output, from its marks: the pieces before the suffix on a first reading, the suffix on a second."""
    if form == "plain":
        yield from output()
        return
    yield from (b for mark, b in segments(output(), form) if mark != SUFFIX)
    yield from (b for mark, b in segments(output(), form) if mark == SUFFIX)


def store_texts(docs: DataFrame, frame_bytes: int = FRAME_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' texts in frames, written to the shared folder and read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(*(store(body.as_py(), frame_bytes) for body in batch.column("body")))
            named = dict(zip(Stored._fields, map(list, columns)))
            if named:
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **named}, schema=_stored_schema())

    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body")
    return written(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), body).mapInArrow(run, STORED), "text-frames")


@cache
def _stored_schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.binary()), longs, longs]
    return pa.schema(list(zip(["doc_id", *Stored._fields], kinds)))


def _each(stored: DataFrame, schema: str, row: Callable[[Stored, Transformed], tuple], **options: int) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("doc_id"), []
            for i, doc_id in enumerate(ids.to_pylist()):
                text = Stored(*(batch.column(c)[i].as_py() for c in Stored._fields))
                done = transform(text, doc_id, **options)
                rows.append((text.n, done.form, done.prefix_chars, done.middle_chars, *row(done)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            if arrays:
                yield pa.RecordBatch.from_arrays([ids, *arrays], names)

    return stored.mapInArrow(run, schema)


COMMON = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"


def fill_in_middle(docs: DataFrame, frame_bytes: int = FRAME_BYTES, **options: int) -> DataFrame:
    """The transformed texts: doc_id, n, form, prefix_chars, middle_chars and output."""

    def output(done: Transformed) -> tuple[str]:
        return (b"".join(done.output()).decode(),)

    return _each(store_texts(docs, frame_bytes), f"{COMMON}, output string", output, **options)


def fill_in_middle_digests(docs: DataFrame, frame_bytes: int = FRAME_BYTES, **options: int) -> DataFrame:
    """As ``fill_in_middle``, with the sha256 of the output and of the text restored from it in place of the output.

    No output is held whole: both digests are fed frame by frame."""

    def digests(done: Transformed) -> tuple[str, str]:
        return tuple(_sha256(pieces) for pieces in (done.output(), restored(done.output, done.form)))

    return _each(store_texts(docs, frame_bytes), f"{COMMON}, output_sha256 string, restored_sha256 string", digests, **options)


def _sha256(pieces: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()
