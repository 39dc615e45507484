"""Reference tables in vintages, and the stem index."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortry.operators import slots
from cohortry.plans import clinical
from cohortry.sources.reference import Vintage, check_keys, label_at, read_reference, vintage_at
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def listed(tmp_path, name, text, **more):
    path = tmp_path / f"{name}.csv"
    path.write_bytes(text.encode())
    return Vintage(name, str(path), **more)


def test_published_forms_are_cleaned(spark, tmp_path):
    early = listed(tmp_path, "v15", "﻿CCS DIAGNOSIS CATEGORIES,LABELS\r\n.Z  ,Overall\r\n1,Tuberculosis  \r\n", rename={"CCS_DIAGNOSIS_CATEGORIES": "k", "LABELS": "v"}, n_keys=2)
    late = listed(tmp_path, "v18", "\"X.CCS.CATEGORY.\",\"ccs_grouper\"\n\"'1 '\",\"Tuberculosis\"\n\"10\",\n", rename={"X_CCS_CATEGORY_": "k", "ccs_grouper": "v"})
    out = read_reference(spark, [early, late], ["k"], ["v"])
    assert rows(out, "vintage", "k") == [("v15", ".Z", "Overall"), ("v15", "1", "Tuberculosis"), ("v18", "1", "Tuberculosis"), ("v18", "10", None)]


@pytest.mark.parametrize(
    ("text", "n_keys", "message"),
    [
        ("k,v\n1,a\n1,b\n", None, "bad: 0 empty and 1 repeated"),
        ("k,v\n1,a\n' ',b\n", None, "bad: 1 empty and 0 repeated"),
        ("k,v\n1,a\n2,b\n", 3, "bad: 2 keys, published with 3"),
        ("k,v\n", 3, "bad: 0 keys, published with 3"),
        ("k,w\n1,a\n", None, r"bad: no column \['v'\]"),
    ],
)
def test_a_wrong_file_is_named(spark, tmp_path, text, n_keys, message):
    good, bad = listed(tmp_path, "good", "k,v\n1,a\n"), listed(tmp_path, "bad", text, n_keys=n_keys)
    with pytest.raises(ValueError, match=message):
        read_reference(spark, [good, bad], ["k"], ["v"])


def test_vintage_names_are_unique(spark):
    with pytest.raises(ValueError, match="repeat"):
        read_reference(spark, [Vintage("a", "x"), Vintage("a", "y")], ["k"], [])


def test_the_vintage_of_a_day(spark):
    two = [Vintage("late", "", date(2018, 1, 1)), Vintage("early", "", date(2015, 1, 1))]
    open_ended = [Vintage("first", ""), *two]
    days = spark.createDataFrame([(date(2014, 12, 31),), (date(2015, 1, 1),), (date(2017, 12, 31),), (date(2018, 1, 1),), (None,)], "d date")
    got = [tuple(r) for r in days.select(vintage_at("d", two), vintage_at(F.col("d"), open_ended)).collect()]
    assert got == [(None, "first"), ("early", "early"), ("early", "early"), ("late", "late"), (None, "first")]


def test_labels_by_day_and_several_keys(spark):
    table = spark.createDataFrame([("a", "x", "1", "ax1"), ("b", "x", "1", "bx1"), ("b", "y", "1", "by1")], "vintage string, s string, k string, label string")
    df = spark.createDataFrame([(1, "x", 1, date(2000, 1, 1)), (2, "x", 1, date(2020, 1, 1)), (3, "y", 1, date(2000, 1, 1)), (4, None, 1, None)], "id int, sys string, code int, d date")
    out = label_at(df, table, [Vintage("a", ""), Vintage("b", "", date(2010, 1, 1))], "d", {"s": "sys", "k": "code"}, {"label": "found"})
    assert out.columns == ["id", "sys", "code", "d", "found"]
    assert [r.found for r in out.orderBy("id").collect()] == ["ax1", "bx1", None, None]
    check_keys(table, ["s", "k"], {"a": 1, "b": 2})


def test_an_unknown_group_is_an_error(spark, tmp_path):
    text = "code_system,code,category\nicd9_dx,3180,Neurologic and Neuromuscular\nicd9_dx,330,Respiratory\nicd9_dx,330,Neurologic and Neuromuscular\n"
    out = clinical.read_code_table(spark, [listed(tmp_path, "groups", text)])
    assert rows(out, "code", "priority") == [("icd9_dx", "3180", "Neurologic and Neuromuscular", 1), ("icd9_dx", "330", "Neurologic and Neuromuscular", 1), ("icd9_dx", "330", "Respiratory", 3)]
    with pytest.raises(ValueError, match="groups: no group is called 'Neuro'"):
        clinical.read_code_table(spark, [listed(tmp_path, "groups", "code_system,code,category\nicd9_dx,3180,Neuro\n")])


# Stems of one to five characters: a longer and a shorter one of the same code, ties, and one that is a whole code.
STEMS = [("330", "B", 2), ("3301", "A", 1), ("33", "C", 3), ("V4", "A", 1), ("V421", "C", 3), ("042", "B", 2), ("99680", "A", 1), ("996", "B", 2)]
DX = ["3301", "33019", "330", "331", "33", "3", "V42", "V421", "V4211", "042", "0420", "99680", "9968", "99", "", None, "W1"]


def brute(code, mode):
    hits = [c for _, c in sorted({(p, c) for stem, c, p in STEMS if code is not None and code.startswith(stem)})]
    return (hits[0] if hits else None) if mode == "first" else (hits or None)


@pytest.mark.parametrize("mode", ["first", "multi"])
@pytest.mark.parametrize("most", [200_000, 1])
def test_stems_by_index_and_by_expansion(spark, monkeypatch, mode, most):
    monkeypatch.setattr(slots, "BROADCAST_ROWS", most)
    codes = spark.createDataFrame([(s, c, p) for s, c, p in STEMS], "code string, category string, priority int")
    df = spark.createDataFrame([(i, c, DX[-1 - i]) for i, c in enumerate(DX)], "id int, dx string, odx string")
    out = slots.classify(df, ["dx", "odx"], codes, match="prefix", mode=mode)
    assert out.columns == ["id", "dx", "odx", "category_dx", "category_odx"]
    got = [(r.category_dx, r.category_odx) for r in out.orderBy("id").collect()]
    assert got == [(brute(c, mode), brute(DX[-1 - i], mode)) for i, c in enumerate(DX)]


def test_stems_without_a_list(spark):
    codes = spark.createDataFrame([], "code string, category string, priority int")
    out = slots.classify(spark.createDataFrame([("330",)], "dx string"), ["dx"], codes, match="prefix")
    assert rows(out) == [("330", None)]


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_stems_read_the_facts_once_and_share_one_broadcast(spark):
    codes = spark.createDataFrame(STEMS, "code string, category string, priority int")
    facts = spark.read.parquet(f"{SF}/orders.parquet").selectExpr("CAST(o_orderkey AS STRING) AS dx", "CAST(o_custkey AS STRING) AS odx")
    out = slots.classify(facts, ["dx", "odx"], codes, match="prefix")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and plan.count("BroadcastHashJoin") == 2 and plan.count("ReusedExchange") == 1


def test_repeated_labels_give_a_row_per_match(spark, tmp_path):
    vintages = [listed(tmp_path, "old", "category,label\n1,a\n1,b\n2,c\n"), listed(tmp_path, "new", "category,label\n1,d\n", valid_from=date(2010, 1, 1))]
    labels = clinical.read_single_labels(spark, vintages, "all")
    df = spark.createDataFrame([(1, "1", date(2000, 1, 1)), (2, "1", date(2020, 1, 1)), (3, "9", date(2000, 1, 1))], "id int, code string, d date")
    out = clinical.ccs_single_label_at(df, labels, vintages, "d", "code", "all")
    assert sorted(rows(out.select("id", "ccs285_label")), key=repr) == [(1, "a"), (1, "b"), (2, "d"), (3, None)]
