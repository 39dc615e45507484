"""Aligned token ids against the libraries' ids of whole texts and links counted one by one."""

import base64
import bisect
import hashlib
from array import array
from collections import Counter, defaultdict
from functools import cache

import public_tokenizers as P
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cohortry.llm import alignment
from cohortry.llm.alignment import align_tokenizers

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

ODD = [
    None,
    "",
    " ",
    "a",
    "  two  leading and trailing  ",
    "line\nbreaks\r\n\ttabs \n \n spaced",
    "mark ▁ of the pieces",
    "text with <|endoftext|> and </s> and <unk> and <0x41>",
    "日本語のテキスト 中文 한국어 mixed words 12345678 \U0001f600\U0001f680",
    "é ﬁ ​ zero width \x00 nul \x1c separators \x85 here",
    "code: if(x==1){return;} // 'quoted' \"double\"'s we'll",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20,
    "ab " * 3000,
    "ТЕКСТ на русском языке, ещё немного",
]


@cache
def library():
    return SentencePieceProcessor(model_file=B_PATH)


@cache
def library_a():
    model = Tokenizer.from_file(A_PATH)
    model.encode_special_tokens = True
    return model


def token_bytes():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        a = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    model = library()
    b = [
        bytes.fromhex(model.id_to_piece(i)[3:5]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.get_piece_size())
    ]
    return a, b


def brute(texts):
    a_model, b_model = library_a(), library()
    a_bytes, b_bytes = token_bytes()
    found = []
    for text in texts:
        groups, links, n_a, n_b = [], Counter(), 0, 0
        if text:
            whole = (" " + text).encode()
            a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
            if b"".join(a_bytes[i] for i in a) == whole == b"".join(b_bytes[i] for i in b):
                n_a, n_b = len(a), len(b)
                ends = []
                for ids, content in ((a, a_bytes), (b, b_bytes)):
                    at, own = 0, []
                    for i in ids:
                        at += len(content[i])
                        own.append(at)
                    ends.append(own)
                common = sorted(set(ends[0]) & set(ends[1]))
                cut = [[bisect.bisect_right(own, e) for e in common] for own in ends]
                for x0, x1, y0, y1 in zip([0, *cut[0]], cut[0], [0, *cut[1]], cut[1]):
                    groups.append((a[x0:x1], b[y0:y1]))
                    links.update((x, y) for x in a[x0:x1] for y in b[y0:y1])
        found.append((n_a, n_b, groups, links))
    docs = Counter(pair for *_, links in found for pair in links)
    best = defaultdict(int)
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    rows = []
    for n_a, n_b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append(
            (
                n_a,
                n_b,
                len(groups),
                sum(links.values()),
                sum(n for p, n in links.items() if docs[p] == best[p[0]]),
                sum(n * docs[p] for p, n in links.items()),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return rows


def aligned(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string, links int, pair string")
    got = align_tokenizers(docs, A_PATH, B_PATH, **options)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 1])
def test_odd_texts_with_repeats_and_clashing_columns(spark, limit):
    """Both joins: counts that are broadcast and counts that are not."""
    texts = [*ODD, ODD[4], ODD[10]]
    ids = [None, 7, 7, *range(10, 10 + len(texts) - 3)]
    want = sorted([(i, *r) for i, r in zip(ids, brute(texts))], key=repr)
    assert aligned(spark, [(i, t, "r", 1, "p") for i, t in zip(ids, texts)], broadcast_pairs=limit) == want
    assert [r for r in want if r[0] == 13][0][1:4] == (0, 0, 0)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = docs.select("doc_id", "text").collect()
    want = sorted((i, *r) for (i, _), r in zip(texts, brute([t for _, t in texts])))
    assert sorted(map(tuple, align_tokenizers(docs, A_PATH, B_PATH).collect())) == want


def test_empty_frame(spark):
    assert aligned(spark, []) == []


def test_blocks_do_not_change_the_result():
    both = alignment.vocabularies(A_PATH, B_PATH)
    texts = [t for t in ODD if t]
    whole = alignment.align_block(*both, texts)
    single = [alignment.align_block(*both, [t]) for t in texts]
    for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"):
        assert whole[name].to_pylist() == [x for s in single for x in s[name].to_pylist()]


@given(st.lists(st.text(st.sampled_from("ab Z\n\t\r'éñ 　.9s\x1c;{}日<>"), min_size=1, max_size=40), max_size=4))
@settings(max_examples=400, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(texts):
    ids, *_ = alignment.vocabularies(A_PATH, B_PATH)
    a_model = library_a()
    want = [(array("I", a_model.encode(" " + t, add_special_tokens=False).ids), array("I", library().encode(t))) for t in texts]
    assert ids.encode([" " + t for t in texts]) == [(a.tobytes(), b.tobytes()) for a, b in want]


def test_forgotten_pieces_are_made_again(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    monkeypatch.setattr(alignment, "LONGEST", 4)
    ids = alignment.PairedIds(alignment.byte_level_ids(A_PATH), alignment.piece_level_ids(B_PATH))
    texts = [" a b c", " b longer words", " a\nb longer", " c d e f g a", " a b c"]
    assert [ids.encode([t]) for t in texts] == [alignment.vocabularies(A_PATH, B_PATH)[0].encode([t]) for t in texts]
    assert len(ids.known) + len(ids.older) < 12


def test_words_encoded_together_have_the_ids_they_have_apart():
    """Also with other white space in a word, or none before it; each piece gives its own bytes."""
    model = Tokenizer.from_file(A_PATH)
    model.encode_special_tokens = True
    pieces = [*(f" w{i}é{i % 7}.," for i in range(1200)), "lead", " a\tb", "\n", " ", " 日本", " <|endoftext|>", " it's", " x​y", " \x1cz", "  two"]
    found = alignment.byte_level_ids(A_PATH)(pieces)
    assert found == [np.array(model.encode(p, add_special_tokens=False).ids, "<u4").tobytes() for p in pieces]
