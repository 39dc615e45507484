"""Fingerprints, languages and licences: brute force, held-out accuracy and odd rows."""

import hashlib
import itertools
import math
import random
import re
import textwrap
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import cohortry.llm.language as lang_module
from cohortry.llm.common import table
from cohortry.llm.language import Tree, learn, predict_language
from cohortry.llm.licenses import scan_licenses
from cohortry.llm.queries import QUERIES
from cohortry.llm import spotsigs
from cohortry.llm.spotsigs import fingerprints, likeness, printed, similar_pairs, spots

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
ODD = [(None, None), (4, "the cat sat on a mat by the door"), (4, "a"), (9, ""), (2, "😀" * 1001), (7, "x " * 5000), (11, "the cat sat on a mat by the door")]


# The common words, typed again.
COMMON = """the of and to in a is that for it was with by on as at be this are or from an not have der die das und den von zu mit ist im ein
eine nicht auf für le les des et est un une dans pour que qui sur pas par de la el en y los se del las lo al su para con por""".split()


def chains(text):
    """Spot signatures as tuples of words: a common word and the next two that are none."""
    words = [w.strip(".,;:!?|()\"'") for w in re.split("[\x20\x09-\x0d]+", text.translate({c: c + 32 for c in range(65, 91)})) if w]
    found = set()
    for i, w in enumerate(words):
        content = [x for x in itertools.islice((x for x in words[i + 1 :] if x not in COMMON), 2)]
        if w in COMMON and len(content) == 2:
            found.add((w, *content))
    if not found and words:
        found = {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    return frozenset(found)


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def wanted(rows):
    """(id, n, edited sha256, set, edited set, likeness to the edited and to the next text) by plain Python."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed_hash(r[1]), (r[1] or "").encode()))
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(t) // 2
        e = t[: len(t) - cut] + nxt[:cut]
        a, b, c = map(chains, (t, e, nxt))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, jaccard(a, b), jaccard(a, c)))
    return out


def signed_hash(text):
    h = xxhash.xxh64((text or "").encode(), seed=42).intdigest()
    return h - (1 << 64) if h >> 63 else h


def compare(got, want):
    """Equal in all but the names of the sets, and these one to one."""
    plain = [(*r[:3], *(round(x, 9) for x in r[5:])) for r in got]
    assert sorted(plain, key=repr) == sorted([(*r[:3], *(round(x, 9) for x in r[5:])) for r in want], key=repr)
    names = {}
    by_row = {(r[0], r[2]): r[3:5] for r in want}
    for r in got:
        for name, own in zip(r[3:5], by_row[r[0], r[2]]):
            assert names.setdefault(name, own) == own and int(name.split(":")[0]) == len(own)
    assert len(names) == len(set(names.values()))


@needs_tables
def test_fingerprints_of_the_test_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    compare([tuple(r) for r in QUERIES["op8_fingerprints"](spark, SF).collect()], wanted(rows))


@needs_tables
def test_fingerprints_with_very_many_partitions(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        compare([tuple(r) for r in QUERIES["op8_fingerprints"](spark, "/root/testdata/sf0.001").collect()], wanted(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fingerprints_of_odd_rows(spark):
    docs = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id bigint, text string, bucket string")
    compare([tuple(r) for r in fingerprints(docs).collect()], wanted(ODD))
    one = fingerprints(docs.filter("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert fingerprints(docs.limit(0)).count() == 0


def test_hot_ids_are_dealt_to_several_ranges(spark):
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"the word{i} and more{i} of text{i % 7}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    compare([tuple(r) for r in fingerprints(docs).collect()], wanted(rows))
    base = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    sizes = [r["count"] for r in base.groupBy(spotsigs._bucket(spotsigs.range_starts(base, 30))("id", "hash")).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 60


def test_long_texts_that_differ_in_few_words_have_other_fingerprints():
    words = [f"the a{i} b{i}" for i in range(3000)]
    one, two = " ".join(words).encode(), " ".join([*words[:1500], "the xq yq", *words[1501:]]).encode()
    assert printed(spots(one)) != printed(spots(two)) and likeness(spots(one), spots(two)) == 2999 / 3001


@needs_tables
def test_similar_pairs_equal_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    sets = {}
    for r in docs.orderBy("doc_id").collect():
        sets.setdefault(frozenset(spots((r.text or "").encode()).tolist()), r.doc_id)
    sets = {i: s for s, i in sets.items() if s}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b]) - 1e-9}
    assert {(r.a, r.b) for r in similar_pairs(docs, 0.5).collect()} == want


@needs_tables
def test_held_out_languages(spark):
    got = QUERIES["op2_language"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang_pred = lang").count() >= 0.97 * got.count()
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_code_lengths_are_exact():
    tree = Tree({b"a": 3, b" ": 1, b" a": 2, b"a ": 1})
    first = math.log2(3 / 2)
    assert tree.bits(b"a") == pytest.approx(first + math.log2(2 / 1))
    assert tree.bits(b"b") == pytest.approx(math.log2(3) + math.log2(6 / 2) + 8 + math.log2(6 / 1))


def test_windows_against_words(monkeypatch):
    """Code lengths and counts by windows, over block borders, against one word at a time."""
    monkeypatch.setattr(lang_module, "BLOCK", 97)
    draw = random.Random(3)
    texts = ["", "  ", "x", "a" * 300, *("".join(draw.choices("abcé \n\x00z", k=draw.randint(0, 300))) for _ in range(60))]
    bodies = [t.encode() for t in texts]
    wanted = Counter()
    owners = [Counter() for _ in texts]
    for own, body in zip(owners, bodies):
        for w in lang_module._spaced(body).split():
            s = b" " + w + b" "
            own.update(s[max(0, i - 4) : i + 1] for i in range(1, len(s)))
            wanted.update(s[i - k : i + 1] for i in range(1, len(s)) for k in range(min(4, i) + 1))
    got = [Counter() for _ in texts]
    for owner, found in lang_module._windows(bodies):
        for o, f in zip(owner.tolist(), found.tolist()):
            got[o][lang_module._gram(f)] += 1
    assert got == owners
    batch = pa.RecordBatch.from_arrays([pa.array(["q"] * len(bodies)), pa.array(bodies, pa.binary())], ["lang", "body"])
    assert {r["gram"]: r["n"] for out in lang_module._grams(iter([batch])) for r in out.to_pylist()} == wanted


def test_odd_languages(spark):
    schema = "doc_id bigint, text string, lang string, score string"
    docs = spark.createDataFrame([(1, "ab cd", "x", ""), (None, None, None, ""), (3, "12 !", "x", ""), (4, "é" * 9000, "y", ""), (4, "ab", None, "")], schema)
    out = {(r.doc_id, r.text): r.lang_pred for r in predict_language(docs, learn(docs, held_out=9)).collect()}
    assert (out[None, None], out[3, "12 !"], out[1, "ab cd"], out[4, "é" * 9000], out[4, "ab"]) == ("und", "und", "x", "y", "x")
    assert predict_language(docs, {}).filter("lang_pred = 'und' AND score = 0").count() == 5
    assert predict_language(docs.limit(0), {}).count() == 0


def test_license_rules(spark):
    mit = "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"  # noqa: E501
    rows = [(1, mit), (2, "x.\nReleased under the MIT License. Licensed under CC BY-NC 4.0."), (None, None), (4, ""), (5, "z" * 20_000), (5, mit.split("\n", 2)[2])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, licenses string")
    got = sorted(((r.doc_id, r.licenses) for r in scan_licenses(docs).collect()), key=repr)
    assert got == sorted([(1, "MIT"), (2, "MIT,CC-BY-NC-4.0"), (None, ""), (4, ""), (5, ""), (5, "MIT")], key=repr)
    assert scan_licenses(docs.limit(0)).count() == 0


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."  # noqa: E501
BSD = ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "3. Neither the name of Some University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."]  # noqa: E501
APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0"  # noqa: E501
GPL = "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version.\n\nYou should have received a copy of the GNU General Public License along with this program."  # noqa: E501
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."  # noqa: E501
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"


def test_wrapped_license_texts(spark):
    def wrapped(text, width, mark=""):
        return "\n".join(mark + line for part in text.split("\n") for line in (textwrap.wrap(part, width) or [""]))

    texts = {
        "MIT": MIT,
        "BSD-3-Clause": "\n".join(BSD),
        "BSD-2-Clause": "\n\n".join(BSD[:3]),
        "Apache-2.0": "Copyright 2020 Someone\n\n" + APACHE,
        "GPL-3.0": GPL.format(":", "General Public License", ",", 3),
        "GPL-2.0": GPL.format(";", "General Public License", ";", 2),
        "LGPL-2.1": GPL.format(";", "Lesser General Public License", ";", 2.1),
        "AGPL-3.0": GPL.format(":", "Affero General Public License", ",", 3),
        "ISC": ISC,
        "MPL-2.0": MPL,
        "CC-BY-4.0": "This work is licensed under CC BY 4.0.",
    }
    texts_2 = {"Apache-2.0": "   Apache License\n   Version 2.0, January 2004\n  http://www.apache.org/licenses/", "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n"}  # noqa: E501
    rows = [(n, wrapped(t, w, m)) for n, t in texts.items() for w in (40, 72, 80, 10_000) for m in ("", "# ", " * ", "// ")]
    rows += [("BSD-3-Clause", " ".join(BSD)), ("", MIT.replace("any person", "no person")), *texts_2.items()]
    docs = spark.createDataFrame(rows, "name string, text string")
    assert [(r.name, r.licenses, r.text) for r in scan_licenses(docs).collect() if r.name != r.licenses] == []
