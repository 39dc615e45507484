"""Code queries on a part table whose codes repeat: keys of more than five digits, and codes that visits hold."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
from check import compare  # noqa: E402

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")

NAMES = [
    "ccs_multilevel",
    "ccs_multilevel_icd10",
    "ccs_single_2018",
    "ccs_single_label",
    "code_slots_lookup",
    "injury_flags",
    "long_lookup_wide",
]


@pytest.fixture(scope="module")
def repeated(tmp_path_factory):
    """(connection, folder): every code above 99,999 stands for ten keys, and ten low keys are there twice with other values."""
    folder = tmp_path_factory.mktemp("repeated")
    con = duckdb.connect()
    con.sql(f"CREATE TABLE orders AS SELECT * FROM '{SF}/orders.parquet'")
    con.sql(f"CREATE TABLE part AS SELECT * FROM '{SF}/part.parquet'")
    con.sql("INSERT INTO part SELECT * REPLACE (p_partkey + 100000 AS p_partkey) FROM part")
    con.sql("INSERT INTO part SELECT * REPLACE ('SMALL' AS p_type, p_size + 1 AS p_size) FROM part WHERE p_partkey % 20 = 0 AND p_partkey < 200")
    for name in ("orders", "part"):
        con.sql(f"COPY {name} TO '{folder}/{name}.parquet'")
    return con, str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_repeated_codes_equal_sql(spark, repeated, name):
    con, folder = repeated
    sql = entry.oracle_sql()[name]
    assert len(con.sql(sql).fetchall()) > con.table("orders").shape[0]
    said = compare(entry.queries()[name](spark, folder), con, sql)
    assert said.startswith("ok"), said
