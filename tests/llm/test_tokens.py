"""Packing and token files against the tokenizers library's ids of whole texts."""

import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cohortry.llm.common import table
from cohortry.llm.packing import pack_documents
from cohortry.llm.queries import QUERIES
from cohortry.llm.token_files import Block, encode_block, token_files
from cohortry.llm.token_ids import byte_level, word_level

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n", "a", "a  b", "a   b", "a \n b", "\n\n x", "x\t y", "a\n\t b", "it's we'll", "É é ñ", "x  y", "  lead", "trail  ",
    "<|endoftext|> x", "日本 語", "a\x1cb \x85c", "tab\tx  y\tz", "w " * 9000, "z" * 3000,
]
DOCS = "doc_id bigint, text string, part int, start string"


@cache
def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def whole(path, text):
    t = library(path)
    return np.array(t.encode(text or "", add_special_tokens=False).ids, "<u4")


@given(st.text(st.sampled_from("ab Z\n\t'éñ 　.9s\x1c"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(text):
    assert byte_level(BYTE)(text) == whole(BYTE, text).tobytes()
    assert word_level(WORD)(text) == whole(WORD, text).tobytes()


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 600), max_size=1500), st.data())
@settings(max_examples=60, deadline=None)
def test_block_reads_any_id(ids, data):
    block = Block(encode_block(np.array(ids, np.uint32)))
    assert len(block) == len(ids)
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert block.run(a, b).tolist() == ids[a:b]
    assert [block[i] for i in range(a, b)] == ids[a:b]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else None, t, 1, "x") for i, t in enumerate(ODD)] + [(5, "a  b", 1, "x"), (5, "again", 1, "x")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_token_files_round_trip(docs):
    got = [tuple(r) for r in token_files(docs, BYTE, block_ids=50).orderBy("start").collect()]
    want, at = [], 0
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, (r.text or "").encode())):
        ids = np.append(whole(BYTE, r.text), 0).astype("<u4")
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


def test_packing_places_every_id_once(docs):
    rows = pack_documents(docs, WORD).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(np.append(whole(WORD, r.text), 2).astype("<u4"))
    for doc_id, options in texts.items():
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == doc_id)
        assert sum(p[1] for p in pieces) == sum(map(len, options))
        for start, length, crc, total in pieces:
            assert any(len(o) == total and zlib.crc32(o[start : start + length].tobytes()) == crc for o in options)
    sequences = {}
    for r in rows:
        sequences.setdefault((r.sequence_id, r.sequence_length), []).append((r.offset, r.length))
    for (_, size), pieces in sequences.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == size <= 4096 and size & (size - 1) == 0
    groups = {}
    for r in rows:
        groups.setdefault(r.step_group, set()).add(r.sequence_length)
    assert all(len(sizes) == 1 for sizes in groups.values())


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert pack_documents(none, WORD).count() == 0
    assert token_files(none, BYTE).count() == 0


def test_all_documents_are_packed(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") * 37 % 9000).cast("int")).alias("text"))
    rows = pack_documents(docs, WORD)
    assert rows.agg(F.sum("length")).first()[0] == docs.agg(F.sum(F.col("doc_id") * 37 % 9000 + 1)).first()[0]


@cache
def plain(path):
    return Tokenizer.from_file(path)


@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof", "a", "É", " ", "\n", "  ", "x9.", "e\u0301"]), max_size=12))
@settings(max_examples=400, deadline=None)
def test_special_strings_give_the_ids_of_the_plain_call(parts):
    text = "".join(parts)
    for path, level in ((BYTE, byte_level), (WORD, word_level)):
        assert level(path, special=True)(text) == np.array(plain(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_queries_and_stage_make_the_plain_call(spark, tmp_path):
    text = "a <|endoftext|> b"
    spark.createDataFrame([(1, text, "en", "s", 17)], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")

    ids = plain(BYTE).encode(text, add_special_tokens=False).ids
    assert QUERIES["op10_token_files"](spark, str(tmp_path)).first().ids_crc32 == zlib.crc32(np.array([*ids, 0], "<u4").tobytes())
    for packed in (QUERIES["op7_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, table(spark, str(tmp_path), "documents"), "")):
        assert {r.doc_tokens for r in packed.collect()} == {4}


def test_the_pipeline_leaves_no_memory_of_pieces_in_a_worker(spark):
    """Its workers go on with other stages; the query of packing alone keeps the pieces."""

    def pieces_left(batches):
        import gc

        from cohortry.llm.token_ids import _Pieces

        for _ in batches:
            pass
        gc.collect()
        n = sum(len(x) for x in gc.get_objects() if isinstance(x, _Pieces))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    docs = spark.createDataFrame([(i, f"some words and number {i}") for i in range(50)], "doc_id bigint, text string").coalesce(1)
    rows = corpus_pipeline.pack(spark, docs, "")
    assert {tuple(r) for r in rows.collect()} == {tuple(r) for r in pack_documents(docs, WORD, special=True).collect()}
    spark.conf.set("spark.sql.execution.pyspark.udf.faulthandler.enabled", "true")  # workers of its own
    try:
        assert rows.count() > 0
        assert docs.mapInArrow(pieces_left, "n long").first().n == 0
        assert pack_documents(docs, WORD, special=True).count() > 0
        assert docs.mapInArrow(pieces_left, "n long").first().n > 0
    finally:
        spark.conf.unset("spark.sql.execution.pyspark.udf.faulthandler.enabled")
