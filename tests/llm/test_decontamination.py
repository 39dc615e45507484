"""Decontamination against brute force and planted templates."""

from pathlib import Path

import pytest

from cohortry.llm.common import Remembered, table
from cohortry.llm.decontamination import Template, _word, mark_contaminated
from cohortry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ITEM = "A train leaves Paris at 14 and reaches Lyon 120 km away when Paris sleeps. How fast was the train from Paris?"
FILLER = "plain words go on here without any sign of an end or of sense "


def brute(docs, items):
    known, out = Remembered(_word), {}
    split = {}
    for i, text in items:
        t = Template((text or "").encode(), known)
        w = min(5, len(t.words))
        split[i] = {t.words[j : j + w].tobytes() for j in range(len(t.words) - w + 1)} if w else set(), w
    for d, text in docs:
        t, hit = Template((text or "").encode(), known), []
        for i, (wins, w) in split.items():
            own = {t.words[j : j + w].tobytes() for j in range(len(t.words) - w + 1)} if w else set()
            if wins and len(wins & own) >= 0.8 * len(wins):
                hit.append(i)
        out[d] = hit
    return out


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_equals_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    got = {r.doc_id: r.item_ids for r in QUERIES["op9_decontamination"](spark, SF).collect()}
    assert got == brute(docs, items)
    assert any(got.values())


def test_new_parameters_are_found_and_mixed_ones_are_not(spark):
    same = ITEM.replace("Paris", "Rome").replace("Lyon", "Milan").replace("14", "9").replace("120 km", "300 mi")
    mixed = same.replace("when Rome", "when Oslo")
    rows = [(1, FILLER + ITEM + " " + FILLER, "x"), (2, FILLER + same, "x"), (3, mixed, "x"), (4, FILLER, "x"), (None, None, "x"), (6, "", "x"), (7, "ab", "x")]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id bigint, text string, containment string")
    items = spark.createDataFrame([(10, ITEM), (11, "ab"), (12, None), (None, "..."), (13, ITEM)], "item_id bigint, text string")
    got = [(r.doc_id, r.item_ids) for r in mark_contaminated(docs, items).collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, [10, 13]), (1, [10, 13]), (2, [10, 13]), (3, []), (4, []), (None, []), (6, []), (7, [11])], key=repr
    )


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    got = mark_contaminated(docs, items).select("doc_id", "contaminated", "item_ids", "containment").collect()
    assert [tuple(r) for r in got] == [(1, False, [], 0.0)]
    assert mark_contaminated(docs.limit(0), items).count() == 0
