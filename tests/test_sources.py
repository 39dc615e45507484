import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortry.sources import files, harmonise, schema, tables
from tests.conftest import rows


def raw_inpatient(spark, n, year, drop=()):
    """All raw inpatient columns with a value each."""
    kinds = dict(harmonise.HARMONISED)
    source = {}
    for target, col in harmonise.INPATIENT_COLUMNS.items():
        source.setdefault(col, kinds[target])
    for c in drop:
        source.pop(c)
    date = f"date_format(date_add(DATE '{year}-03-01', CAST(id % 40 AS INT)), 'MM/dd/yyyy')"
    literal = {"int": "CAST(id % 22 AS INT)", "string": "CAST(id AS STRING)", "double": "1.5D", "date": date, "bigint": "id"}
    exprs = [f"{literal[k]} AS {c}" for c, k in source.items() if c not in ("admtyr",)]
    return spark.range(n).selectExpr(*exprs, f"{year} AS admtyr")


def raw_emergency(spark, n, year):
    kinds = dict(harmonise.HARMONISED)
    source = {}
    for target, col in harmonise.EMERGENCY_COLUMNS.items():
        source.setdefault(col, kinds[target])
    literal = {
        "int": "CAST(id % 22 AS INT)",
        "string": "CAST(id AS STRING)",
        "date": f"date_format(date_add(DATE '{year}-01-01', CAST(id % 40 AS INT)), 'M/d/yyyy')",
    }
    return spark.range(n).selectExpr(*[f"{literal[k]} AS {c}" for c, k in source.items() if c != "serv_y"], f"{year} AS serv_y")


def test_harmonised_schema():
    names = [n for n, _ in harmonise.HARMONISED]
    assert len(names) == len(set(names)) == 125
    assert names[:3] == ["id", "db_row_n", "database"] and names[-1] == "ip_cat_code"
    assert names.index("dx_prin") == 42 and names.index("ccs_dx_prin") == 68


def test_combine_both_sources_and_vintages(spark, tmp_path):
    old = raw_inpatient(spark, 50, 2011, drop=harmonise.ADMISSION_SOURCE_NEW)
    new = raw_inpatient(spark, 40, 2017, drop=harmonise.ADMISSION_SOURCE_OLD)
    out = harmonise.combine([old, new], [raw_emergency(spark, 30, 2011)])
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == harmonise.HARMONISED
    path = str(tmp_path / "combined")
    harmonise.append_combined(out, path)
    back = spark.read.parquet(path)
    counts = {(r["database"], r["start_year"]): r["n"] for r in back.groupBy("database", "start_year").agg(F.count("*").alias("n")).collect()}
    assert counts == {("pdd", 2011): 50, ("pdd", 2017): 40, ("edd", 2011): 30}
    assert sorted(r.id for r in back.select("id").collect()) == list(range(1, 121))
    one = back.filter("database = 'edd'").orderBy("db_row_n").collect()
    assert [r.db_row_n for r in one] == list(range(1, 31))
    assert [r.start_date for r in one] == sorted(r.start_date for r in one)
    assert all(r.los == 0 and r.end_date == r.start_date and r.ip_disp is None for r in one)
    assert back.filter("start_year = 2011 AND database = 'pdd'").filter("ip_source IS NULL OR ip_source_ns IS NOT NULL").count() == 0
    assert back.filter("start_year = 2017").filter("ip_source IS NOT NULL OR ip_source_ns IS NULL").count() == 0


def test_lookup_csv_cleans_names_and_casts(spark, tmp_path):
    path = tmp_path / "lookup.csv"
    path.write_bytes("﻿GEO.id2,HC02 EST\n00601,51000\n00602,-\n".encode())
    df = files.read_lookup_csv(spark, str(path), {"HC02_EST": "int"})
    assert df.columns == ["GEO_id2", "HC02_EST"]
    assert rows(df, "GEO_id2") == [("00601", 51000), ("00602", None)]


def test_typed_csv_stops_on_bad_row(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,x\nzz,y\n")
    with pytest.raises(Exception, match="(?i)malformed|parse|zz"):
        files.read_typed_csv(spark, str(path), "a int, b string").collect()


def test_spec_schema(spark):
    spec = spark.createDataFrame(
        [(2, "agyradm", "agyradm INT"), (1, "data_id", "data_id BIGINT"), (3, "dx", "dx varchar(3)"), (4, "g", "g float"), (5, None, None)],
        "position int, names string, types string",
    )
    assert schema.column_order(spec, "names", exclude=["data_id"]) == ["agyradm", "dx", "g"]
    got = schema.schema_from_spec(spec, "types", exclude=["data_id"])
    assert [(f.name, f.dataType.simpleString()) for f in got] == [("agyradm", "int"), ("dx", "string"), ("g", "double")]


def test_label_rows(spark):
    df = spark.createDataFrame([("Id", "Income"), ("00601", "5"), ("00602", "6")], "id string, v string")
    out = files.label_columns(df, "id")
    assert out.schema["v"].metadata["label"] == "Income"
    assert rows(out, "id") == [("00601", "5"), ("00602", "6")]


def test_audited_append_and_rename(spark):
    df = spark.range(10).select(F.col("id"), (F.col("id") % 2).alias("k"))
    tables.create_table(spark, "audit_t", df.schema)
    said = tables.audited_append(df, "audit_t", ["k", "id"], "k = 0")
    assert said == {"stage_rows": 10, "appended_rows": 5, "target_before": 0, "target_after": 5}
    tables.rename_table(spark, "audit_t", "audit_u")
    assert [r.table_name for r in tables.list_tables(spark, "audit_*").collect()] == ["audit_u"]
    tables.drop_table(spark, "audit_u")
    assert not spark.catalog.tableExists("audit_u")


def test_code_system_switch(spark):
    df = spark.createDataFrame([(dt.date(2015, 9, 30),), (dt.date(2015, 10, 1),), (None,)], "d date")
    assert [r[0] for r in rows(df.select(harmonise.code_system("d")))] == ["icd9_dx", "icd10_dx", None]
