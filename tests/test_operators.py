import random
import statistics

import pytest
from pyspark.sql import functions as F

from cohortry.functions.recode import pairs_to_lookup
from cohortry.operators import cohort, comparisons, counts, joins, order_stats, projection, rates, slots, summary
from cohortry.sources.numbering import number_rows, sparse_id
from tests.conftest import rows

LOOKUP = [("5190", "Respiratory", 3), ("5190", "Technology dependence", 11), ("14", "Malignancy", 9), ("042", "Hematologic", 6)]


@pytest.fixture(scope="module")
def slot_frame(spark):
    data = [(1, None, None, None), (2, "5190", "5190", "042"), (3, "14", "141", None), (4, "42", "x", "14")]
    return spark.createDataFrame(data, "id long, dx_prin string, odx1 string, odx2 string")


@pytest.fixture(scope="module")
def code_frame(spark):
    return spark.createDataFrame(LOOKUP, "code string, category string, priority int")


SLOTS = ["dx_prin", "odx1", "odx2"]


def labels(df):
    return rows(df.select("id", *[f"category_{s}" for s in SLOTS]), "id")


def test_classify_exact_first_wins(slot_frame, code_frame):
    assert labels(slots.classify(slot_frame, SLOTS, code_frame)) == [
        (1, None, None, None),
        (2, "Respiratory", "Respiratory", "Hematologic"),
        (3, "Malignancy", None, None),
        (4, None, None, "Malignancy"),
    ]


def test_classify_prefix_reaches_longer_codes(slot_frame, code_frame):
    got = labels(slots.classify(slot_frame, SLOTS, code_frame, match="prefix"))
    assert got[2] == (3, "Malignancy", "Malignancy", None)
    assert got[3] == (4, None, None, "Malignancy")  # "42" is not the code "042"


def test_classify_multi(slot_frame, code_frame):
    got = labels(slots.classify(slot_frame, SLOTS, code_frame, mode="multi"))
    assert got[1][1] == ["Respiratory", "Technology dependence"]
    assert got[0][1] is None


def test_lookup_forms_agree(spark, slot_frame, code_frame):
    lookup = code_frame.filter("priority <> 11")
    a = slots.lookup_slots(slot_frame, SLOTS, lookup, "code", ["category", "priority"], form="join")
    b = slots.lookup_slots(slot_frame, SLOTS, lookup, "code", ["category", "priority"], "id", form="long")
    cols = ["id", *[f"{v}_{s}" for s in SLOTS for v in ("category", "priority")]]
    assert rows(a.select(cols), "id") == rows(b.select(cols), "id")
    with pytest.raises(ValueError):
        slots.lookup_slots(slot_frame, SLOTS, lookup, "code", ["category"], form="long")


def test_repeated_lookup_key_fails(slot_frame, code_frame):
    with pytest.raises(ValueError, match="repeats"):
        slots.lookup_slots(slot_frame, SLOTS, code_frame, "code", ["category"])
    first = joins.unique_key(code_frame, ["code"], on_duplicate="first")
    assert rows(first.filter("code = '5190'")) == [("5190", "Respiratory", 3)]


def test_wide_long_round_trip(slot_frame):
    long = slots.wide_to_long(slot_frame, "id", SLOTS)
    assert long.count() == 12
    assert rows(slots.long_to_wide(long, "id", "slot", "code", SLOTS), "id") == rows(slot_frame, "id")


def test_unique_id(spark, slot_frame):
    slots.assert_unique_id(slot_frame, "id")
    with pytest.raises(ValueError):
        slots.assert_unique_id(slot_frame.union(slot_frame), "id")
    with pytest.raises(ValueError):
        slots.assert_unique_id(spark.createDataFrame([(None,), (1,)], "id int"), "id")


def test_null_safe_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    assert rows(joins.lookup_join(left, right, "k"), "v") == [("a", 1, 10), (None, 2, None)]
    assert rows(joins.lookup_join(left, right, "k", null_safe=True).select("v", "w"), "v") == [(1, 10), (2, 20)]


def test_recode_update_keeps_unmatched(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "x string")
    got = rows(joins.recode_update(df, "x", pairs_to_lookup(spark, {"1": "Sun"})))
    assert sorted(got, key=repr) == sorted([("Sun",), ("9",), (None,)], key=repr)


def test_update_join_can_set_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    other = spark.createDataFrame([(1, None)], "id int, y string")
    assert rows(joins.update_join(df, other, "id", {"x": "y"}), "id") == [(1, None), (2, "b")]


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert projection.require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="z"):
        projection.require_columns(df, ["a", "z"])


def test_attrition_equals_filtered_counts(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 3).alias("x"))
    steps = [("x known", F.col("x").isNotNull()), ("x > 0", F.col("x") > 0), ("id < 50", F.col("id") < 50)]
    got = [r.n for r in cohort.attrition(df, steps).orderBy("step").collect()]
    want = [df.count()]
    for i in range(len(steps)):
        want.append(cohort.apply_steps(df, steps[: i + 1]).count())
    assert got == want


def test_ed_arrival(spark):
    data = [("edd", None), ("edd", 2), ("pdd", 1), ("pdd", 2), ("pdd", None)]
    df = spark.createDataFrame(data, "database string, ip_source_route int")
    assert cohort.ed_arrival_cohort(df).count() == 3


def test_transfer_rates_empty_controls(spark):
    data = [("a", "transferred"), ("a", "admitted"), ("a", None), ("b", "dc home"), ("c", None), ("d", "admitted")]
    df = spark.createDataFrame(data, "h string, outcome string")
    got = {r["h"]: r for r in rates.transfer_rates(df, "h").collect()}
    assert (got["a"]["hf_ALL_total"], got["a"]["hf_ADMIT_total"], got["a"]["hf_DC_total"]) == (3, 2, 1)
    assert got["a"]["hf_ALL_transferred_rf"] == pytest.approx(1 / 3)
    assert got["b"]["hf_ADMIT_total"] is None and got["b"]["hf_ADMIT_transferred_total"] is None
    assert (got["c"]["hf_ALL_total"], got["c"]["hf_ADMIT_total"], got["c"]["hf_DC_total"]) == (1, None, None)
    assert got["d"]["hf_DC_total"] is None


def test_profile_equals_separate_aggregates(spark):
    rng = random.Random(3)
    data = [(rng.randrange(5), rng.choice(["transferred", "admitted", "dc home", None]), rng.random() < 0.3) for _ in range(400)]
    df = spark.createDataFrame(data, "h int, outcome string, flag boolean")
    both = rates.hospital_profile(df, "h", {"flag_rf": F.col("flag")}, {"": None, "ei_": F.col("outcome").isNotNull()})
    kept = df.filter("outcome IS NOT NULL")
    want = rates.transfer_rates(kept, "h", prefix="hf_ei_").join(
        rates.group_rate(kept, "h", {"hf_ei_flag_rf": F.col("flag")}).drop("total"), "h"
    )
    assert rows(both.select(*want.columns), "h") == rows(want, "h")
    assert rows(both.repartition(7), "h") == rows(both, "h")


def test_outcome_pivot_denominators(spark):
    data = [("a", "transferred"), ("a", "admitted"), ("b", "admitted"), ("b", None), ("c", "dc home")]
    df = spark.createDataFrame(data, "h string, outcome string")
    row = {r["h"]: r for r in counts.outcome_pivot(df, "h").collect()}
    assert row["a"]["transfer_adm_per"] == 0.5 and not row["a"]["all_none"]
    assert row["b"]["all_none"] and row["b"]["other"] == 1
    assert row["c"]["transfer_adm_per"] is None and row["c"]["all_none"]
    whole = {r["h"]: r for r in counts.outcome_pivot(df, "h", denominator="global").collect()}
    assert whole["a"]["total"] == 4 and whole["a"]["transfer_adm_per"] == pytest.approx(1 / 3)


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "x string")
    assert rows(counts.mode_value(df, "x")) == [("a", 2)]


def test_rare_category_flag_null_category(spark):
    df = spark.createDataFrame([(i, "a") for i in range(98)] + [(98, None), (99, "b")], "id int, x string")
    got = {r["id"]: r["rare"] for r in counts.rare_category_flag(df, "x", 0.05).collect()}
    assert got[98] and got[99] and not got[0]


def test_count_trues_denominator_is_all_rows(spark):
    df = spark.createDataFrame([("a", True), ("a", None), ("a", False), ("a", False)], "g string, f boolean")
    assert rows(counts.count_trues(df, "f", "g")) == [("a", 4, 1, 0.25)]


def test_number_rows_is_dense_and_ordered_with_ties(spark):
    # One date holds most rows, and the batch is NULL for some.
    data = [("x" if i % 3 else None, 7 if i % 5 else i) for i in range(2000)]
    df = spark.createDataFrame(data, "b string, d int").repartition(5)
    out = number_rows(df, ["d"], batch=["b"], running_id="id").cache()
    assert sorted(r.id for r in out.select("id").collect()) == list(range(1, 2001))
    for b in ("x", None):
        part = sorted((r.db_row_n, r.d) for r in out.filter(F.col("b").eqNullSafe(F.lit(b))).collect())
        assert [n for n, _ in part] == list(range(1, len(part) + 1))
        assert [d for _, d in part] == sorted(d for _, d in part)
    out.unpersist()


def test_sparse_id_is_unique(spark):
    df = sparse_id(spark.range(1000).repartition(4), "key")
    assert df.select("key").distinct().count() == 1000


def type7(values, p):
    values = sorted(values)
    h = (len(values) - 1) * p
    lo = int(h)
    hi = min(lo + 1, len(values) - 1)
    return values[lo] + (h - lo) * (values[hi] - values[lo])


@pytest.mark.parametrize("ranges", [2, 64])
def test_exact_quantiles_against_sorting(spark, ranges):
    rng = random.Random(5)
    data = [(g, rng.choice([0.0, 0.0, 0.0, rng.gauss(0, 5), None, float("nan")]), None) for g in "ab" for _ in range(700)]
    df = spark.createDataFrame(data, "g string, x double, empty double")
    got = {r["g"]: r for r in order_stats.exact_quantiles(df, ["x", "empty"], {"q1": 0.25, "med": 0.5, "p9": 0.9}, ["g"], ranges).collect()}
    for g in "ab":
        values = [v for k, v, _ in data if k == g and v is not None and v == v]
        assert got[g]["total"] == len(values)
        for name, p in {"q1": 0.25, "med": 0.5, "p9": 0.9}.items():
            assert got[g][name] == pytest.approx(type7(values, p))


def test_anova_and_kruskal_small(spark):
    data = [("a", v) for v in (1.0, 2.0, 3.0, 4.0)] + [("b", v) for v in (2.0, 4.0, 6.0, 8.0)] + [(None, 100.0), ("a", None)]
    df = spark.createDataFrame(data, "g string, x double")
    f = comparisons.anova(df, "g", ["x"]).first()
    a, b = [1, 2, 3, 4], [2, 4, 6, 8]
    t2 = (statistics.mean(a) - statistics.mean(b)) ** 2 / ((statistics.variance(a) + statistics.variance(b)) / 2 * (2 / 4))
    assert f["statistic"] == pytest.approx(t2) and (f["df1"], f["df2"]) == (1, 6)
    h = comparisons.kruskal_wallis(df, "g", ["x"]).first()
    # ranks: 1, 2.5, 4, 5.5 and 2.5, 5.5, 7, 8; two ties of size two
    raw = 12 / (8 * 9) * (13**2 / 4 + 23**2 / 4) - 3 * 9
    assert h["statistic"] == pytest.approx(raw / (1 - 12 / (8**3 - 8)))


def test_chi_square_two_by_two(spark):
    cells = {("T", "yes"): 20, ("F", "yes"): 10, ("T", "no"): 5, ("F", "no"): 15}
    data = [(g, x) for (x, g), n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(data, "g string, x string")
    got = comparisons.chi_square(df, "g", ["x"]).first()
    n = 50
    want = n * (20 * 15 - 10 * 5) ** 2 / (30 * 20 * 25 * 25)
    assert got["statistic"] == pytest.approx(want) and got["df"] == 1
    assert got["p_value"] == pytest.approx(0.00389241712627)  # upper tail of 8.333 on one degree of freedom


def test_odds_ratio_and_empty_cell(spark):
    full = spark.createDataFrame([(20, 10, 5, 15), (3, 0, 1, 2)], "a long, b long, c long, d long")
    got = rows(comparisons.odds_ratio(full).select("odds_ratio", "std_error"))
    assert got[0][0] == pytest.approx(6.0) and got[0][1] == pytest.approx((1 / 20 + 1 / 10 + 1 / 5 + 1 / 15) ** 0.5)
    assert got[1] == (None, None)


def test_normality_decides(spark):
    rng = random.Random(11)
    df = spark.createDataFrame([(rng.gauss(0, 1), rng.expovariate(1)) for _ in range(3000)], "n double, e double")
    got = {r["variable"]: r["is_normal"] for r in comparisons.normality(df, ["n", "e"]).collect()}
    assert got == {"n": True, "e": False}


def test_table_results(spark):
    rng = random.Random(2)
    data = [(rng.choice("ab"), rng.choice(["u", "v", None]), rng.gauss(0, 1), rng.expovariate(1)) for _ in range(800)]
    df = spark.createDataFrame(data, "g string, c string, n double, e double")
    out = summary.table_results(df, "g", ["c"], ["n", "e"])
    assert {r["variable"]: r["test"] for r in out["tests"].collect()} == {"c": "chi-square", "n": "anova", "e": "kruskal-wallis"}
    assert {r["variable"] for r in out["missing"].collect()} == {"c", "n", "e"}
    miss = summary.describe_by(df, "g", "c", include_missing=True)
    assert miss.filter("level IS NULL").count() == 2


def test_column_summary_of_empty_and_text(spark):
    df = spark.createDataFrame([(None, "a", True), (None, "b", None)], "x double, t string, f boolean")
    got = {r["variable"]: r for r in summary.column_summary(df).collect()}
    assert got["x"]["n_missing"] == 2 and got["x"]["p50"] is None
    assert got["t"]["n_levels"] == 2 and got["f"]["mean"] == 1.0


def test_printed_table_formats_and_hides(spark):
    data = [("a", "no", 1.0), ("a", "yes", 2.0), ("b", "yes", 4.0), ("b", "yes", 6.0), ("b", "no", 8.0)]
    df = spark.createDataFrame(data, "g string, f string, x double")
    out = summary.table_results(df, "g", ["f"], ["x"], missing=False, normal=["x"])
    got = {(r["variable"], r["level"]): (r["a"], r["b"]) for r in summary.printed_table(out["table"], out["tests"], ["a", "b"], ["x"], hide=["no"]).collect()}
    assert got == {("f", "yes"): ("1 (50.0%)", "2 (66.7%)"), ("x", None): ("1.50 (0.71)", "6.00 (2.00)")}
    skewed = {r["variable"]: r["b"] for r in summary.printed_table(out["table"], out["tests"], ["a", "b"]).collect() if r["level"] is None}
    assert skewed == {"x": "6.00 [5.00;7.00]"}


def test_ungrouped_table(spark):
    df = spark.createDataFrame([("u", 1.0), ("v", 3.0), (None, None)], "c string, x double")
    got = {(r["variable"], r["level"]): (r["grp"], r["n"], r["pct"], r["mean"]) for r in summary.bivariate_table(df, None, ["c"], ["x"]).collect()}
    assert got == {("c", "u"): ("[ALL]", 1, 50.0, None), ("c", "v"): ("[ALL]", 1, 50.0, None), ("x", None): ("[ALL]", 2, None, 2.0)}


def test_anova_does_not_change_when_values_are_shifted(spark):
    rows = [(g, float(i % 7 + 3 * (g == "b"))) for g in "ab" for i in range(40)]
    found = []
    for shift in (0.0, 1e8):
        df = spark.createDataFrame([(g, v + shift) for g, v in rows], "g string, v double")
        found.append(comparisons.anova(df, "g", ["v"]).first().statistic)
    assert abs(found[0] - found[1]) < 1e-4 * found[0]


def test_kruskal_wallis_of_one_value_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "g string, v double")
    assert all(r.statistic is None for r in comparisons.kruskal_wallis(df, "g", ["v"]).collect())


def test_large_lookups_give_the_rows_of_small_ones(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a", "b"), (1, "b", None), (None, "a", "a"), (None, None, "x"), (2, None, None)], "id int, s1 string, s2 string")
    lookup = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "code string, v int")
    small = slots.lookup_slots(df, ["s1", "s2"], lookup, "code", ["v"])
    monkeypatch.setattr(slots, "BROADCAST_ROWS", 2)
    for id_col in (None, "id"):
        large = slots.lookup_slots(df, ["s1", "s2"], lookup, "code", ["v"], id_col)
        assert large.columns == small.columns
        assert sorted(rows(large), key=repr) == sorted(rows(small), key=repr)
    codes = lookup.selectExpr("code", "concat('group ', v) AS category", "v AS priority")
    got = slots.classify(df, ["s1", "s2"], codes)
    assert sorted(rows(got.select("category_s1")), key=repr) == [("group 1",), ("group 1",), ("group 2",), (None,), (None,)]


def test_column_summary_profiles_dates(spark):
    df = spark.sql("SELECT DATE'2011-01-01' AS d, TIMESTAMP'2011-01-01 06:00:00' AS t, 1 AS n UNION ALL SELECT DATE'2011-01-03', NULL, 2 UNION ALL SELECT NULL, NULL, 3")
    got = {r["variable"]: r for r in summary.column_summary(df).selectExpr("variable", "n_missing", "p50", "string(t_p0) AS lo", "string(t_p50) AS mid", "string(t_p100) AS hi").collect()}
    assert tuple(got["d"])[1:] == (1, None, "2011-01-01 00:00:00", "2011-01-02 00:00:00", "2011-01-03 00:00:00")
    assert tuple(got["t"])[1:] == (2, None, *["2011-01-01 06:00:00"] * 3)
    assert got["n"]["p50"] == 2.0 and got["n"]["lo"] is None


def test_repeated_codes_give_a_row_per_match(spark, monkeypatch):
    """As left joins per slot in SQL, in every form."""
    df = spark.createDataFrame([(1, "a", "b"), (2, "b", "a"), (3, None, "a"), (4, "x", None)], "id int, s1 string, s2 string")
    lookup = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("b", 3, None), ("c", 4, "r"), ("c", 5, "s")], "code string, v int, w string")
    df.createOrReplaceTempView("dup_facts")
    lookup.createOrReplaceTempView("dup_codes")
    want = rows(spark.sql(
        "SELECT id, x.w, x.v, y.v FROM dup_facts LEFT JOIN dup_codes x ON s1 = x.code LEFT JOIN dup_codes y ON s2 = y.code"
    ))
    assert len(want) == 7
    for limit in (200_000, 3, 1):
        monkeypatch.setattr(slots, "BROADCAST_ROWS", limit)
        for form in ("auto", "join", "long"):
            got = slots.lookup_slots(df, ["s1", "s2"], lookup, "code", ["v"], "id", form, "all", ["w"])
            assert sorted(rows(got.select("id", "w", "v_s1", "v_s2")), key=repr) == sorted(want, key=repr)
    wide = slots.lookup_long_wide(df, "id", ["s1", "s2"], lookup, "code", "v", "all")
    assert sorted(rows(wide), key=repr) == sorted([(i, a, b) for i, _, a, b in want], key=repr)
    with pytest.raises(ValueError, match="on_duplicate"):
        slots.lookup_slots(df, ["s1"], lookup, "code", ["v"], on_duplicate="first")


def test_a_large_lookup_is_cut_to_the_codes_held(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"c{i % 4}", f"c{i % 3}") for i in range(12)], "id int, s1 string, s2 string")
    lookup = spark.range(100).selectExpr("concat('c', id) AS code", "id AS v")
    monkeypatch.setattr(slots, "BROADCAST_ROWS", 10)
    for form in ("auto", "join"):
        out = slots.lookup_slots(df, ["s1", "s2"], lookup, "code", ["v"], "id", form)
        assert rows(out.select("id", "v_s1", "v_s2"), "id") == [(i, i % 4, i % 3) for i in range(12)]
        assert out._jdf.queryExecution().optimizedPlan().toString().count("broadcast") == 2


def test_repeated_lookup_rows_join_all(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, k string")
    lookup = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    got = joins.lookup_join(df, lookup, "k", "all")
    assert sorted(rows(got.select("id", "v")), key=repr) == [(1, 1), (1, 2), (2, None), (3, None)]
    assert sorted(rows(joins.lookup_join(df, lookup, "k", "all", null_safe=True).select("id", "v")), key=repr) == [(1, 1), (1, 2), (2, 3), (3, None)]
    with pytest.raises(ValueError, match="on_duplicate"):
        joins.lookup_join(df, lookup, "k", "any")
