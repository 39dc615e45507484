"""The physical plans the operators are meant to have, read after execution."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from catalogue.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def final_plan(spark, name):
    df = QUERIES[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(plan):
    """Shuffles of the plan itself; reused ones are not written again."""
    return len(re.findall(r"(?<!Reused)Exchange (?:hash|range)partitioning", re.sub(r"ReusedExchange[^\n]*", "", plan)))


def test_entry_is_the_flagship():
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", ["encounter_recode", "outcome_classify", "band_numeric", "row_max", "flag_product", "injury_severity"])
def test_row_operators_never_shuffle(spark, name):
    plan = final_plan(spark, name)
    assert shuffles(plan) == 0
    assert "Python" not in plan


def test_slots_share_one_broadcast(spark):
    plan = final_plan(spark, "code_slots_lookup")
    assert shuffles(plan) == 0
    assert plan.count("BroadcastHashJoin") == 7
    assert len(re.findall(r"\+- BroadcastExchange", plan)) == 1 and plan.count("ReusedExchange") == 6


@pytest.mark.parametrize("name", ["hospital_profile", "outcome_pivot", "group_rate", "count_trues"])
def test_rates_take_one_shuffle(spark, name):
    plan = final_plan(spark, name)
    assert shuffles(plan) == 1
    assert "partial_count" in plan


def test_total_reuses_the_counts(spark):
    assert "ReusedExchange" in final_plan(spark, "share_within_group")


def test_scan_pushes_filters_and_prunes_columns(spark, capsys):
    QUERIES["table_scan"](spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_totalprice,300000.0)" in plan
    narrow = final_plan(spark, "group_rate")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", narrow).group(1)
    assert "l_extendedprice" not in schema and "l_shipdate" not in schema


def test_attrition_is_one_pass(spark):
    plan = final_plan(spark, "cohort_attrition")
    assert plan.count("FileScan") == 1 and shuffles(plan) == 0


@pytest.mark.parametrize("lacking", ["tokenizers", "cohortry.llm"])
def test_the_core_does_without_the_text_operators(lacking):
    code = (
        "import sys, warnings; warnings.simplefilter('ignore');"
        f"sys.modules[{lacking!r}] = None; import __spark_entry__ as e;"
        "from catalogue.registry import QUERIES, ORACLES;"
        "assert e.queries().keys() == QUERIES.keys() and e.oracle_sql().keys() == ORACLES.keys()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)


def test_wide_recodes_are_compiled_in_any_session(spark):
    """A method of more than 8,000 bytes is never compiled by the JVM; Spark then has to split it."""
    other = spark.newSession()
    other.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    df = QUERIES["encounter_recode"](other, SF)
    assert int(other.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    assert df.count() > 0
    other.conf.set("spark.sql.codegen.hugeMethodLimit", "4000")
    QUERIES["encounter_recode"](other, SF)
    assert other.conf.get("spark.sql.codegen.hugeMethodLimit") == "4000"
