import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortry.models import mixed
from cohortry.models.design import Factor, Number, design_matrix
from cohortry.models.grid import contrast, cross
from cohortry.models.logit import logit, or_table, ratio_table
from cohortry.models.mixed import SD, Cell, fit_grid, icc, mixed_logit
from tests.conftest import rows

CELLS = {(True, True): 20, (True, False): 10, (False, True): 5, (False, False): 15}


@pytest.fixture(scope="module")
def two_by_two(spark):
    data = [(x, y) for (x, y), n in CELLS.items() for _ in range(n)]
    return spark.createDataFrame(data, "x boolean, y boolean")


def simulate(sigma, seed=1, groups=40, size=200):
    rng = np.random.default_rng(seed)
    h = np.repeat(np.arange(groups), size)
    x = rng.integers(0, 2, len(h)).astype(float)
    u = rng.normal(0, sigma, groups)[h] if sigma else 0.0
    y = rng.random(len(h)) < 1 / (1 + np.exp(-(-1 + 0.7 * x + u)))
    return pd.DataFrame({"h": h, "x": x, "y": y})


def dense_log_lik(pdf, b0, b1, s):
    grid = np.linspace(-8, 8, 4001) * s
    total = 0.0
    for _, part in pdf.groupby("h"):
        a = -0.5 * (grid / s) ** 2 - math.log(s) - 0.5 * math.log(2 * math.pi)
        for x, cell in part.groupby("x"):
            lin = b0 + b1 * x + grid
            a = a + cell["y"].sum() * lin - len(cell) * np.logaddexp(0, lin)
        top = a.max()
        total += top + math.log(np.exp(a - top).sum() * (grid[1] - grid[0]))
    return total


def estimates(df):
    return {r["term"]: r for r in df.collect()}


def test_design_matrix_base_and_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None), ("z", 3.0)], "f string, n double")
    out = design_matrix(df, [Factor("f", ("a", "b", "c"), base="last"), Number("n")])
    assert out.columns == ["f=a", "f=b", "n"]
    assert rows(out, "n") == [(1.0, 0.0, 1.0), (0.0, 1.0, 2.0)]


def test_logit_closed_form(two_by_two):
    got = estimates(logit(two_by_two, F.col("y"), [Factor("x", (False, True))]))
    log_or, se = math.log(20 * 15 / (10 * 5)), math.sqrt(1 / 20 + 1 / 10 + 1 / 5 + 1 / 15)
    assert got["x=True"]["estimate"] == pytest.approx(log_or, abs=1e-6)
    assert got["x=True"]["std_error"] == pytest.approx(se, abs=1e-6)
    table = estimates(or_table(logit(two_by_two, F.col("y"), [Factor("x", (False, True))])))
    assert table["x=True"]["estimate"] == 6.0 and table["x=True"]["std_error"] == round(6 * se, 4)


def test_logit_without_terms(two_by_two):
    got = estimates(logit(two_by_two, F.col("y"), []))
    assert got["(intercept)"]["estimate"] == pytest.approx(0.0)
    assert got["(intercept)"]["std_error"] == pytest.approx(math.sqrt(2 / 25))


def test_plain_grid_equals_logit(two_by_two):
    term = Factor("x", (False, True))
    a = estimates(fit_grid(two_by_two, F.col("y"), [term], [Cell("all")]))
    b = estimates(logit(two_by_two, F.col("y"), [term]))
    for name in b:
        assert a[name]["estimate"] == pytest.approx(b[name]["estimate"], abs=1e-6)
        assert a[name]["std_error"] == pytest.approx(b[name]["std_error"], abs=1e-4)


def test_mixed_logit_reaches_the_maximum(spark):
    pdf = simulate(0.8)
    got = estimates(mixed_logit(spark.createDataFrame(pdf), F.col("y"), [Number("x")], "h"))
    theta = [got["(intercept)"]["estimate"], got["x"]["estimate"], got[SD]["estimate"]]
    best = dense_log_lik(pdf, *theta)
    assert got["x"]["log_lik"] == pytest.approx(best, abs=1e-4)
    for k in range(3):
        for d in (-0.02, 0.02):
            moved = list(theta)
            moved[k] += d
            assert dense_log_lik(pdf, *moved) < best
    # Standard error of the slope from a second difference along the profile of the dense likelihood.
    h = 1e-3
    hess = np.zeros((3, 3))
    for i in range(3):
        for j in range(3):
            e_i, e_j = np.eye(3)[i] * h, np.eye(3)[j] * h
            t = np.array(theta)
            hess[i, j] = (
                dense_log_lik(pdf, *(t + e_i + e_j))
                - dense_log_lik(pdf, *(t + e_i - e_j))
                - dense_log_lik(pdf, *(t - e_i + e_j))
                + dense_log_lik(pdf, *(t - e_i - e_j))
            ) / (4 * h * h)
    se = np.sqrt(np.diag(np.linalg.inv(-hess)))
    assert got["x"]["std_error"] == pytest.approx(se[1], rel=0.01)
    assert got["(intercept)"]["std_error"] == pytest.approx(se[0], rel=0.01)
    assert got[SD]["std_error"] == pytest.approx(se[2], rel=0.01)


def test_hot_group_in_chunks_gives_the_same_fit(spark, monkeypatch):
    pdf = simulate(0.5, seed=4, groups=12, size=60)
    rng = np.random.default_rng(9)
    hot = pd.DataFrame({"h": 99, "x": rng.normal(size=700), "y": rng.random(700) < 0.4})
    df = spark.createDataFrame(pd.concat([pdf, hot]))
    whole = estimates(mixed_logit(df, F.col("y"), [Number("x")], "h"))
    monkeypatch.setattr(mixed, "GROUP_CHUNK", 50)
    split = estimates(mixed_logit(df.repartition(5), F.col("y"), [Number("x")], "h"))
    for name in whole:
        assert split[name]["estimate"] == pytest.approx(whole[name]["estimate"], abs=1e-5)
        assert split[name]["std_error"] == pytest.approx(whole[name]["std_error"], rel=1e-4)


def test_without_group_effect_equals_logit(spark):
    # Every group has the same counts, so the estimated spread is zero.
    data = [(h, x, y) for h in range(20) for (x, y), n in CELLS.items() for _ in range(n)]
    df = spark.createDataFrame(data, "h int, x boolean, y boolean")
    term = Factor("x", (False, True))
    a = estimates(mixed_logit(df, F.col("y"), [term], "h"))
    b = estimates(logit(df, F.col("y"), [term]))
    assert a[SD]["estimate"] == 0.0 and a["x=True"]["icc"] == 0.0
    assert a["x=True"]["estimate"] == pytest.approx(b["x=True"]["estimate"], abs=1e-3)
    assert a["x=True"]["std_error"] == pytest.approx(b["x=True"]["std_error"], rel=1e-3)


def test_grid_cells_equal_single_fits(spark):
    pdf = simulate(0.6, seed=8)
    pdf["s"] = pdf["h"] % 2 == 0
    df = spark.createDataFrame(pdf)
    crude, full = (), (Number("x"),)
    cells = [Cell("even", (F.col("s"),), full), Cell("even crude", (F.col("s"),), crude), Cell("none", (F.col("h") > 1000,))]
    grid = fit_grid(df, F.col("y"), [Number("x")], cells, "h")
    got = {(r["cell"], r["term"]): r for r in grid.collect()}
    single = estimates(mixed_logit(df.filter("s"), F.col("y"), [Number("x")], "h"))
    for name in single:
        assert got[("even", name)]["estimate"] == pytest.approx(single[name]["estimate"], abs=1e-5)
    assert ("even crude", "x") not in got
    assert got[("none", None)]["status"] == "no rows"
    null = icc(df, F.col("y"), "h", [Cell("even", (F.col("s"),))]).first()
    sd = got[("even crude", SD)]["estimate"]
    assert null["icc"] == pytest.approx(sd**2 / (sd**2 + math.pi**2 / 3), abs=1e-6)


def test_empty_level_is_an_error(spark):
    df = spark.createDataFrame([(h, "a", h % 2 == 0) for h in range(40)], "h int, f string, y boolean")
    with pytest.raises(ValueError, match="not estimable"):
        mixed_logit(df, F.col("y"), [Factor("f", ("a", "b"))], "h")


def test_contrasts_and_cross(spark):
    df = spark.createDataFrame([("admitted",), ("dc home",), ("transferred",), (None,)], "outcome string")
    assert [df.filter(contrast(k)).count() for k in ("all", "admitted", "discharged")] == [3, 2, 2]
    cells = cross({"s": F.lit(True)}, {"all": None, "n": F.lit(False)})
    assert [c.name for c in cells][:2] == ["s|all|all|adjusted", "s|all|admitted|adjusted"] and len(cells) == 6


def test_ratio_table(two_by_two):
    got = {(r["variable"], r["level"]): r for r in ratio_table(two_by_two, F.col("y"), [Factor("x", (False, True))]).collect()}
    assert got[("x", "True")]["odds_ratio"] == pytest.approx(6.0)
    assert got[("x", "False")]["odds_ratio"] == 1.0 and got[("x", "False")]["std_error"] is None
    number = two_by_two.withColumn("z", F.col("x").cast("double"))
    fitted = ratio_table(number, F.col("y"), [], [Number("z")]).first()
    assert fitted["variable"] == "z" and fitted["odds_ratio"] == pytest.approx(6.0, abs=1e-5)


def by_term(df):
    return {r["term"]: (r["estimate"], r["std_error"], r["status"]) for r in df.collect()}


def counted(spark, cells):
    """(level, with the outcome, without) as rows."""
    data = [(level, y) for level, yes, no in cells for y, n in ((True, yes), (False, no)) for _ in range(n)]
    return spark.createDataFrame(data, "g string, y boolean")


def test_a_separated_level_leaves_the_others_as_they_are(spark):
    df = counted(spark, [("a", 20, 15), ("b", 10, 30), ("never", 0, 12), ("always", 7, 0)])
    got = by_term(logit(df, F.col("y"), [Factor("g", ("a", "b", "never", "always", "absent"))]))
    assert got["g=never"] == got["g=always"] == (None, None, "separated") and got["g=absent"] == (None, None, "no rows")
    assert got["g=b"][0] == pytest.approx(math.log(10 / 30) - math.log(20 / 15), abs=1e-7) and got["g=b"][2] == "ok"
    assert got["(intercept)"][:2] == (pytest.approx(math.log(20 / 15)), pytest.approx(math.sqrt(1 / 20 + 1 / 15), abs=1e-6))


def test_a_separated_reference_level(spark):
    df = counted(spark, [("a", 0, 15), ("b", 10, 30), ("c", 12, 9)]).withColumn("n", F.rand(3))
    got = by_term(logit(df, F.col("y"), [Factor("g", ("a", "b", "c")), Number("n")]))
    assert {v for k, v in got.items() if k != "n"} == {(None, None, "separated")}
    rest = by_term(logit(df.filter("g <> 'a'"), F.col("y"), [Factor("g", ("b", "c")), Number("n")]))
    assert got["n"] == (pytest.approx(rest["n"][0], abs=1e-6), pytest.approx(rest["n"][1], abs=1e-6), "ok")


def test_separation_that_shows_after_a_level_left(spark):
    """Without level x of f, level p of g has one outcome only."""
    data = [("x", "p", False)] * 5 + [("u", "p", True)] * 4 + [("u", "q", True)] * 6 + [("v", "q", False)] * 3 + [("v", "q", True)] * 2 + [("u", "q", False)] * 2
    got = by_term(logit(spark.createDataFrame(data, "f string, g string, y boolean"), F.col("y"), [Factor("f", ("u", "v", "x")), Factor("g", ("q", "p"))]))
    assert got["f=x"] == got["g=p"] == (None, None, "separated")
    assert got["f=v"][0] == pytest.approx(math.log(2 / 3) - math.log(6 / 2), abs=1e-6)


@pytest.mark.parametrize(("yes", "no", "status"), [(4, 0, "separated"), (0, 4, "separated"), (0, 0, "no rows"), (1, 3, "ok")])
def test_rows_that_are_all_alike(spark, yes, no, status):
    df = counted(spark, [("a", yes, no)])
    (bare,) = logit(df, F.col("y"), []).collect()
    assert bare["status"] == status and (bare["estimate"] is None) == (status != "ok")
    got = by_term(logit(df, F.col("y"), [Factor("g", ("a", "b"))]))
    assert got["(intercept)"][2] == status and got["g=b"] == (None, None, "no rows")


def test_a_number_that_splits_the_outcomes(spark):
    df = spark.createDataFrame([(float(i), i > 5, "ab"[i % 2]) for i in range(12)], "n double, y boolean, g string")
    got = by_term(logit(df, F.col("y"), [Number("n"), Factor("g", ("a", "b"))]))
    assert set(got.values()) == {(None, None, "separated")}
    touching = by_term(logit(df.union(df.filter("n = 5").withColumn("y", F.lit(True))), F.col("y"), [Number("n")]))
    assert set(touching.values()) == {(None, None, "separated")}


def test_separation_by_two_terms_together_is_not_estimable(spark):
    """The outcome is x > z: no term alone separates it."""
    data = [(float(x), float(z), x > z) for x in range(6) for z in range(6)]
    got = by_term(logit(spark.createDataFrame(data, "x double, z double, y boolean"), F.col("y"), [Number("x"), Number("z")]))
    assert got["x"][2] == got["z"][2] == "not estimable"


def test_levels_that_are_numbers(spark):
    df = counted(spark, [("3", 20, 15), ("2", 10, 30), ("1", 0, 4)]).withColumn("g", F.col("g").cast("int"))
    got = by_term(logit(df, F.col("y"), [Factor("g", (1, 2, 3), base="3")]))
    assert got["g=2"][0] == pytest.approx(math.log(10 / 30) - math.log(20 / 15), abs=1e-6) and got["g=1"][2] == "separated"
