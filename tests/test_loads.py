"""Loads that run again, and what numbering reads."""

import re

import pytest
from pyspark.sql import functions as F

from cohortry.session import scratch_path, stored
from cohortry.sources import harmonise, loads, numbering
from tests.conftest import rows
from tests.test_sources import raw_emergency, raw_inpatient

SHAPE = "id bigint, v int, db_row_n bigint, k string"


def table_rows(spark, path):
    return rows(spark.read.schema(SHAPE).parquet(path).select("id", "v", "db_row_n", "k"), "id")


def test_ids_go_on_and_a_batch_is_replaced(spark):
    path = scratch_path(spark, "loads")
    df = spark.createDataFrame([(3, "b"), (1, "a"), (2, None), (1, "a")], "v int, k string")
    assert loads.highest_id(spark, path) == 0
    loads.load_batches(df, path, ["v"], ["k"])
    assert table_rows(spark, path) == [(1, 2, 1, None), (2, 1, 1, "a"), (3, 1, 2, "a"), (4, 3, 1, "b")]
    loads.load_batches(df.filter("k = 'a'"), path, ["v"], ["k"])
    assert table_rows(spark, path) == [(1, 2, 1, None), (4, 3, 1, "b"), (5, 1, 1, "a"), (6, 1, 2, "a")]
    loads.load_batches(df.filter("k IS NULL").withColumn("v", F.lit(9)), path, ["v"], ["k"])
    assert table_rows(spark, path)[-1] == (7, 9, 1, None)
    loads.load_batches(df.filter("v > 99"), path, ["v"], ["k"])
    assert len(table_rows(spark, path)) == 4 and loads.highest_id(spark, path) == 7


def test_old_ids_and_numbers_of_the_frame_are_not_kept(spark):
    path = scratch_path(spark, "loads")
    df = spark.createDataFrame([(77, 5, 8, "a")], SHAPE)
    loads.load_batches(df, path, ["v"], ["k"])
    assert table_rows(spark, path) == [(1, 5, 1, "a")]


def test_other_read_errors_are_not_an_empty_table(spark, tmp_path):
    (tmp_path / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        loads.highest_id(spark, str(tmp_path))


def test_encounter_loads_run_again(spark):
    path = scratch_path(spark, "encounters")
    old, ed = raw_inpatient(spark, 50, 2011, drop=harmonise.ADMISSION_SOURCE_NEW), raw_emergency(spark, 30, 2011)
    harmonise.load_encounters(spark, path, [old], [ed])
    harmonise.load_encounters(spark, path, [raw_inpatient(spark, 40, 2017, drop=harmonise.ADMISSION_SOURCE_OLD)])
    out = harmonise.load_encounters(spark, path, [], [ed])
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == harmonise.HARMONISED
    counts = rows(out.groupBy("database", "start_year").agg(F.count("*"), F.min("id"), F.max("id"), F.max("db_row_n")), "database", "start_year")
    assert counts == [("edd", 2011, 30, 121, 150, 30), ("pdd", 2011, 50, 31, 80, 50), ("pdd", 2017, 40, 81, 120, 40)]


def test_counting_reads_positions_and_batches_only(spark, monkeypatch):
    plans = {}

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name)

    monkeypatch.setattr(numbering, "stored", watched)
    wide = spark.range(100).selectExpr("id", "id % 3 AS k", "repeat('x', 50) AS payload", "id * 2 AS other")
    out = numbering.number_rows(wide, ["id"], batch=["k"], running_id="rid", from_files=True)
    assert rows(out.select("rid", "db_row_n"), "rid")[33:36] == [(34, 34), (35, 1), (36, 2)]
    read = {f.split(":")[0] for s in re.findall(r"ReadSchema: struct<([^>]*)>", plans["starts"]) for f in s.split(",")}
    assert read == {"k", "_part", "_pos"}


def test_numbers_without_batches_start_behind_after(spark):
    df = spark.createDataFrame([(2, None), (1, "x")], "v int, w string").withColumn("nothing", F.lit(None))
    out = numbering.number_rows(df, ["v"], running_id="id", after=10)
    assert rows(out, "id") == [(11, 1, "x", None, 1), (12, 2, None, None, 2)]


def test_stored_keeps_untyped_columns(spark):
    back = stored(spark.range(2).withColumn("n", F.lit(None)).withColumn("a b,c", F.lit("t")), "untyped")
    assert back.schema["n"].dataType.simpleString() == "void" and rows(back, "id") == [(0, None, "t"), (1, None, "t")]


def test_wide_rows_get_the_same_numbers(spark, tmp_path):
    """Ties over many ranges, NULL keys, a batch of one row and no rows at all."""
    path = str(tmp_path / "wide")
    made = spark.range(0, 3000, 1, 5).selectExpr(
        "id AS v", "IF(id = 7, 'z', IF(id % 3 = 0, NULL, concat('b', id % 3))) AS k", "IF(id % 2 = 0, DATE'2011-01-01', IF(id % 7 = 0, NULL, date_add(DATE'2011-01-01', CAST(id % 40 AS INT)))) AS d"
    )
    made.write.parquet(path)
    df = spark.read.parquet(path)
    want = numbering.number_rows(df, ["d"], batch=["k"], running_id="id", from_files=True, after=5)
    got = numbering.number_wide_rows(df, ["d"], ["k"], after=5)
    assert got.columns == want.columns and got.rdd.getNumPartitions() > 8
    assert rows(got, "id") == rows(want, "id")
    assert numbering.number_wide_rows(df.filter("v < 0"), ["d"], ["k"]).count() == 0


def test_combined_rows_are_not_written_before_the_table(spark, tmp_path):
    """The whole rows are read from their files, moved once and sorted once, also when they are written by batch."""
    path = str(tmp_path / "raw")
    raw_emergency(spark, 30, 2011).write.parquet(path)
    out = harmonise.combine([], [spark.read.parquet(path)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and path in plan and "placed" not in plan
