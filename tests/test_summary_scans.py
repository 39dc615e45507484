"""How often tables and profiles read the facts, and ranges that are split again."""

import datetime as dt
import random
import statistics

import pytest

from cohortry.operators import order_stats, summary
from tests.test_operators import type7

ROWS = 3000


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(4)
    day = dt.date(2014, 1, 1)
    data = [
        (rng.choice("abc"), rng.choice(["u", "v", None]), rng.gauss(1e6, 2), rng.choice([0.0, 0.0, rng.random(), None]), day + dt.timedelta(rng.randrange(900)))
        for _ in range(ROWS)
    ]
    return spark.createDataFrame(data, "g string, c string, x double, z double, d date"), data


def counted(spark, df):
    """The frame, and how many times its rows have been read."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), lambda: seen.value / ROWS


def test_a_table_reads_its_rows_four_times_at_most(spark, facts, tmp_path):
    """Numbers take three passes: sketches, counts and moments per range, the wanted ranges. Categories take one."""
    df, times = counted(spark, facts[0])
    assert summary.number_block(df, "g", ["x", "z"]).count() == 6 and times() <= 3
    facts[0].write.parquet(str(tmp_path / "facts"))
    out = summary.category_block(spark.read.parquet(str(tmp_path / "facts")), "g", ["c"])
    assert len(out.collect()) == 6
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_a_profile_reads_its_rows_four_times_at_most(spark, facts):
    df, times = counted(spark, facts[0])
    got = {r["variable"]: r for r in summary.column_summary(df).collect()}
    assert times() <= 4
    days = sorted(r[4] for r in facts[1])
    assert got["d"]["t_p0"].date() == days[0] and got["d"]["t_p100"].date() == days[-1] and got["d"]["p50"] is None
    assert got["x"]["mean"] == pytest.approx(statistics.mean(r[2] for r in facts[1])) and got["g"]["n_levels"] == 3


def test_moments_are_merged_without_cancelling(spark, facts):
    got = {(r["g"], r["variable"]): r for r in order_stats.exact_quantiles(facts[0], ["x", "z"], {"m": 0.5}, ["g"], moments=True).collect()}
    for g in "abc":
        for i, name in ((2, "x"), (3, "z")):
            own = [r[i] for r in facts[1] if r[0] == g and r[i] is not None]
            r = got[g, name]
            assert (r["total"], r["m"]) == (len(own), pytest.approx(type7(own, 0.5)))
            assert r["mean"] == pytest.approx(statistics.mean(own), rel=1e-12) and r["sd"] == pytest.approx(statistics.stdev(own), rel=1e-9)


def test_groups_without_a_value(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), (None, 2.0), ("b", float("nan"))], "g string, x double")
    out = order_stats.exact_quantiles(df, ["x"], {"m": 0.5}, ["g"], moments=True)
    got = sorted([(r["g"], r["total"], r["mean"], r["sd"], r["m"]) for r in out.collect()], key=repr)
    assert got == [("a", 0, None, None, None), ("b", 1, 1.0, None, 1.0), (None, 1, 2.0, None, 2.0)]


@pytest.mark.parametrize("most", [1, 7, 150])
def test_large_ranges_are_split_again(spark, monkeypatch, most):
    """Two ranges to begin with, one value that fills most of one, and groups of very different sizes."""
    monkeypatch.setattr(order_stats, "RANGE_VALUES", most)
    rng = random.Random(9)
    data = [("a", rng.choice([5.0, 5.0, rng.gauss(5, 1)])) for _ in range(2500)] + [("b", float(i)) for i in range(40)]
    df = spark.createDataFrame(data, "g string, x double")
    probs = {f"p{i}": p for i, p in enumerate((0.0, 0.01, 0.3, 0.5, 0.77, 1.0))}
    got = {r["g"]: r for r in order_stats.exact_quantiles(df, ["x"], probs, ["g"], 2).collect()}
    for g in "ab":
        own = [v for k, v in data if k == g]
        assert got[g]["total"] == len(own)
        assert [got[g][n] for n in probs] == pytest.approx([type7(own, p) for p in probs.values()])


def test_ranges_are_not_limited(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        assert order_stats.range_count(spark.range(1)) == 5000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
