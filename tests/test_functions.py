import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cohortry.functions import dates, levels, numeric, recode, rowwise, tails, text
from tests.conftest import rows


def one(spark, values, schema, *cols):
    return rows(spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema).select(*cols))


def test_recode_map_keeps_defaults_and_nulls(spark):
    got = one(
        spark,
        ["a", "b", None],
        "x string",
        recode.recode_map("x", {"a": "A"}),
        recode.recode_map("x", {"a": "A"}, default="other"),
        recode.recode_map("x", {"a": "A"}, default=None, missing="none"),
    )
    assert got == [("A", "A", "A"), ("b", "other", None), (None, None, "none")]


def test_in_set_and_values_to_null(spark):
    got = one(spark, ["1", "9", None], "x string", recode.in_set("x", ["1"]), recode.values_to_null("x", "9"))
    assert got == [(True, "1"), (False, None), (False, None)]


def test_band_edges(spark):
    band = recode.band("x", [20, 40], ["low", None, "high"])
    assert [r[0] for r in one(spark, [19.9, 20.0, 39.9, 40.0, None], "x double", band)] == ["low", None, None, "high", None]
    with pytest.raises(ValueError):
        recode.band("x", [1], ["only"])


def test_case_when_first_match(spark):
    c = recode.case_when((F.col("x") > 1, "big"), (F.col("x") > 0, "small"))
    assert [r[0] for r in one(spark, [2, 1, 0, None], "x int", c)] == ["big", "small", None, None]


def test_conditional_assign_unknown_condition_keeps(spark):
    c = recode.conditional_assign("x", F.col("y") > 0, None)
    assert [r[0] for r in one(spark, [(5, 1), (5, 0), (5, None)], "x int, y int", c)] == [None, 5, 5]


@pytest.mark.parametrize(
    "flags, label",
    [
        ((True, True, True), "Ped ED + Ped Ward + PICU"),
        ((True, True, False), "Ped ED + Ped Ward"),
        ((True, False, True), "Ped ED + PICU"),
        ((False, True, True), "Ped Ward + PICU"),
        ((True, False, False), "Ped ED only"),
        ((False, True, None), "Ped Ward only"),
        ((False, False, True), "PICU only"),
        ((None, False, False), "None"),
    ],
)
def test_flag_product(spark, flags, label):
    cols = list(zip(map(F.col, "abc"), ["Ped ED", "Ped Ward", "PICU"]))
    assert one(spark, [flags], "a boolean, b boolean, c boolean", recode.flag_product(cols)) == [(label,)]


def test_factor_levels_metadata_and_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("z",), (None,)], "x string")
    out = df.select("x", levels.factor("x", "y", ["b", "a"], ["B", "A"]))
    assert levels.levels_of(out, "y") == ["B", "A"]
    assert rows(out.select("y", levels.level_code("y", ["B", "A"]))) == [("B", 1), ("A", 2), (None, None), (None, None)]
    assert levels.levels_of(df.withColumns({"y": levels.factor("x", "y", ["a"])}), "y") == ["a"]
    with pytest.raises(ValueError):
        levels.levels_of(df, "x")


def test_relevel():
    assert levels.relevel(["a", "b", "c"], "last") == ["c", "a", "b"]
    assert levels.relevel(["a", "b", "c"], 2) == ["b", "a", "c"]
    assert levels.relevel(["a", "b", "c"], "b") == ["b", "a", "c"]
    with pytest.raises(ValueError):
        levels.relevel(["a"], "x")


def test_text(spark):
    got = one(
        spark,
        ["'0042 '", None],
        "x string",
        text.strip_chars("x"),
        text.substring_from(F.lit("106010776"), 4),
        text.pad_left(F.lit("12"), 6),
        text.pad_left(F.lit("1234567"), 6),
        text.concat_text("x", F.lit("b"), null_as="NA"),
        text.concat_text("x", F.lit("b")),
    )
    assert got[0] == ("0042", "010776", "000012", "1234567", "'0042 'b", "'0042 'b")
    assert got[1] == (None, "010776", "000012", "1234567", "NAb", None)


def test_replace_in_order_capped_income(spark):
    rules = [("2,500-", "2500"), ("250,000\\+", "250000"), ("-", None)]
    got = one(spark, ["2,500-", "250,000+", "-", "51000", None], "x string", text.replace_in_order("x", rules))
    assert [r[0] for r in got] == ["2500", "250000", None, "51000", None]


def test_replace_first_only(spark):
    assert one(spark, ["aXbXc"], "x string", text.replace_text("x", "X", "-", first_only=True), text.replace_text("x", "X", "-")) == [
        ("a-bXc", "a-b-c")
    ]


def test_safe_cast(spark):
    assert [r[0] for r in one(spark, ["12", "x", "", None, " 7 "], "x string", text.safe_cast("x", "int"))] == [12, None, None, None, 7]


def test_parse_date(spark):
    got = one(spark, ["1/5/2011", "01/05/2011", "02/29/2008", "13/45/2011", "", None], "x string", dates.parse_date("x"))
    d = dt.date(2011, 1, 5)
    assert [r[0] for r in got] == [d, d, dt.date(2008, 2, 29), None, None, None]


def test_age_years_exact(spark):
    d = dt.date
    pairs = [
        (d(2000, 1, 1), d(2001, 1, 1)),
        (d(2000, 6, 15), d(2000, 6, 15)),
        (d(2001, 3, 1), d(2002, 2, 28)),
        (d(2004, 2, 29), d(2005, 2, 28)),
        (d(2004, 2, 29), d(2008, 2, 28)),
        (d(2003, 7, 1), d(2004, 1, 1)),
    ]
    got = [r[0] for r in one(spark, pairs, "b date, s date", dates.age_years_exact("b", "s"))]
    want = [1.0, 0.0, 364 / 365, 1.0, 3 + 365 / 366, 184 / 366]
    assert got == pytest.approx(want)


def test_season_and_weekend(spark):
    got = one(spark, [dt.date(2011, 1, 1), dt.date(2011, 1, 3), None], "x date", dates.season(F.month("x")), dates.is_weekend("x"))
    assert got == [("Winter", True), ("Winter", False), (None, False)]


def test_ratio_zero_total(spark):
    assert one(spark, [(1, 0), (1, 4)], "a int, b int", numeric.ratio("a", "b")) == [(None,), (0.25,)]


def test_zscore(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    assert [r[0] for r in rows(df.select(numeric.zscore(df, "x")))] == [-1.0, 0.0, 1.0]


def test_row_reductions(spark):
    got = one(
        spark,
        [(1, None, 3), (None, None, None)],
        "a int, b int, c int",
        rowwise.row_max(["a", "b", "c"]),
        rowwise.row_count_true(["a", "b", "c"], lambda c: c > 0),
        rowwise.row_any(["a", "b", "c"], lambda c: c > 2),
    )
    assert got == [(3, 2, True), (None, 0, False)]


def test_tails_against_known_values():
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05)
    assert tails.chi2_upper(3.841458820694124, 1) == pytest.approx(0.05)
    assert tails.chi2_upper(18.307038053275146, 10) == pytest.approx(0.05)
    assert tails.chi2_upper(2.0, 2) == pytest.approx(math.exp(-1))
    assert tails.chi2_upper(0, 3) == 1.0
    assert tails.t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05)
    assert tails.f_upper(4.964602743730711, 1, 10) == pytest.approx(0.05)
    assert tails.f_upper(2.0, 4, 7) == pytest.approx(1 - tails.beta_lower(2, 3.5, 8 / 15), rel=1e-9)
    assert tails.fisher_two_sided(3, 1, 1, 3) == pytest.approx(0.48571428571428565)
    assert tails.fisher_two_sided(8, 2, 1, 5) == pytest.approx(0.03496503496503495)
    assert tails.fisher_two_sided(0, 5, 5, 0) == pytest.approx(2 / 252)


def test_p_value_column_passes_nulls(spark):
    df = spark.createDataFrame([(1.96,), (None,)], "z double")
    got = [r[0] for r in rows(df.select(tails.p_value(tails.normal_two_sided, "z")))]
    assert got[0] == pytest.approx(0.04999579) and got[1] is None
