"""Fill-in-middle by frames against the plain rule on whole texts."""

import hashlib
import re
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortry.llm import fill_in_middle as fim

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = [None, "", " ", "\n\t ", "a", " lead", "trail  ", "a<P>b", "<M>", "< P> <S", "é 日本 語 x \x85 \x1c y", "w " * 9000, "z" * 5000, "a\r\n b\vc"]


def brute(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    hexed = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@given(st.text(st.sampled_from("ab \n\té<PSM>日\x1c"), max_size=60), st.integers(0, 400), st.integers(1, 9))
@settings(max_examples=600, deadline=None)
def test_frames_of_any_size_give_the_plain_result(text, doc_id, size):
    stored = fim.store(text.encode(), size)
    done = fim.transform(stored, doc_id)
    assert (stored.n, done.form, done.prefix_chars, done.middle_chars, b"".join(done.output()).decode()) == brute(doc_id, text)
    assert b"".join(fim.restored(done.output, done.form)).decode() == text


@given(st.binary(max_size=30), st.integers(1, 4), st.sampled_from(["psm", "spm"]))
def test_marks_across_pieces(body, width, form):
    if any(m in body for m in fim.MARKS):
        return
    order = fim.ORDER[form]
    whole = b"".join(m + body[i::3] for i, m in enumerate(order))
    if any(whole.count(m) > 1 for m in order):
        return
    pieces = [whole[i : i + width] for i in range(0, len(whole), width)]
    got = dict.fromkeys(order, b"")
    for mark, part in fim.segments(pieces, form):
        got[mark] += part
    assert got == {m: body[i::3] for i, m in enumerate(order)}


@cache
def rows():
    texts = [*ODD, *ODD] * 4
    return [(None if i % 17 == 3 else i // 2, t, "x", [1]) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size", [7, fim.FRAME_BYTES])
def test_odd_texts(spark, size):
    docs = spark.createDataFrame(rows(), "doc_id bigint, text string, n string, frames array<int>")
    want = sorted([(i, *brute(i, t)) for i, t, *_ in rows()], key=repr)
    assert sorted(map(tuple, fim.fill_in_middle(docs, size).collect()), key=repr) == want
    digests = sorted([(i, *brute(i, t)[:4], sha(brute(i, t)[4]), sha(t)) for i, t, *_ in rows()], key=repr)
    assert sorted(map(tuple, fim.fill_in_middle_digests(docs, size).collect()), key=repr) == digests
    assert {r[2] for r in want} == {"plain", "psm", "spm"}


def test_empty_frame(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert fim.fill_in_middle(docs).collect() == fim.fill_in_middle_digests(docs).collect() == []


def test_only_the_cut_frames_are_searched(monkeypatch):
    text = ("word " * 2000).encode()
    stored = fim.store(text, 100)
    opened = []
    plain = fim._decompress()
    monkeypatch.setattr(fim, "_decompress", lambda: lambda frame: opened.append(frame) or plain(frame))
    assert stored.place(1234)[2] == 1234 * 5 - 1
    assert len(opened) <= 1 < len(stored.frames)
