"""Personal data against a brute-force scan with the plain patterns."""

import hashlib
import re
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortry.llm.common import table
from cohortry.llm.personal_data import BASE, find_personal_data, redact, span_list
from cohortry.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ODD = [
    None, "", "no data", "a@b.c_d@e.f", "x@y a@b.co, 1.2.3.4.5 é 300.1.1.1 and 001.02.3.255", "4111 1111 1111 1111 4111111111111112",
    "+1 (555) 010-2030 +4930123456 +1 2 +123456789012345678", "ü😀 mail: jo@x.example.com!", "a@b.c%d@e.f.g-h.", "1-1 1.1.1.1-2", "@@@",
    "9" * 3000, "1 " * 3000 + "+", "a" * 5000 + "@" + "b" * 5000, 'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f6" id 123-45-6789', "x@y.z" * 50,
]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in v.split(".")) if kind == "ip" else False,
                "card": 12 <= len(d) <= 19 and luhn(d),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans_equal_the_plain_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    got = {r.doc_id: r.s for r in find_personal_data(docs).select("doc_id", span_list(F.col("base_spans")).alias("s")).collect()}
    assert got == {i: brute(t) for i, t in enumerate(ODD)}


def test_query_on_the_test_table(spark):
    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("no test tables")
    got = {r.doc_id: r for r in QUERIES["op3_personal_data"](spark, sf).collect()}
    for r in table(spark, sf, "documents").collect():
        want, row = brute(r.text), got[r.doc_id]
        assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(row.spans.split(","))
        assert [row[f"n_{k}"] for k in BASE] == [len(re.findall(rf"\b{k}:", want)) for k in BASE]


def test_secrets_are_added_and_redacted(spark):
    rows = [(i, f'call token = "{i:02d}ef4d6b2755a36d7d9c25bd72c4d5f6" or a{i}@b.org', "base") for i in range(20)]
    docs = spark.createDataFrame([*rows, (None, None, "x")], "doc_id bigint, text string, base_spans string")
    out = {r.doc_id: r for r in redact(docs.drop("base_spans")).collect()}
    assert out[3].text == 'call token = "<SECRET>" or <EMAIL>'
    assert out[None].text is None
    assert find_personal_data(docs).count() == 21


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert find_personal_data(docs).count() == 0
    assert redact(docs).columns == ["doc_id", "text", "lang"]


def test_time_grows_with_the_numbers_of_a_text(spark):
    def seconds(n):
        docs = spark.createDataFrame([(1, "12, " * n)], "doc_id bigint, text string")
        start = time.perf_counter()
        assert find_personal_data(docs).select(F.size("all_spans")).first()[0] == 0
        return time.perf_counter() - start

    seconds(100)
    few, many = min(seconds(5_000) for _ in range(2)), seconds(20_000)
    assert many < 4 * few


def test_spans_over_block_borders(spark):
    """More matches than a block, some of which hold."""
    text = "".join(f"12, +49 30 {1000000 + i}; a{i}@b.example é " if i % 3 == 0 else "7 8 9 " for i in range(900))
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    spans = find_personal_data(docs).select("base_spans").first()[0]
    assert [text[s.start : s.end] for s in spans] == [s.value for s in spans]
    assert Counter(s.kind for s in spans) == {"email": 300, "phone": 300}
