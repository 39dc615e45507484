"""What the passes of a random-intercept grid move, and where its patterns lie."""

import pytest
from pyspark.sql import functions as F

from cohortry.models import mixed
from cohortry.models.design import Number
from cohortry.models.mixed import Cell, fit_grid
from tests.test_models import simulate


@pytest.fixture(scope="module")
def df(spark):
    """Groups from 30 up have a pattern for nearly every row, the others two patterns."""
    pdf = simulate(0.7, seed=5, groups=36, size=120)
    pdf.loc[pdf["h"] >= 30, "x"] += pdf.index[pdf["h"] >= 30] % 97 / 97
    return spark.createDataFrame(pdf)


def fitted(df):
    cells = [Cell("small", (F.col("h") < 30,)), Cell("odd", (F.col("h") % 2 == 1,), ()), Cell("large", (F.col("h") >= 30,))]
    return {(r["cell"], r["term"]): r for r in fit_grid(df, F.col("y"), [Number("x")], cells, "h").collect()}


def assert_same(a, b):
    assert a.keys() == b.keys()
    for key, r in a.items():
        assert (b[key]["n"], b[key]["n_groups"], b[key]["status"]) == (r["n"], r["n_groups"], r["status"])
        assert r["status"] == "converged"
        assert b[key]["estimate"] == pytest.approx(r["estimate"], abs=1e-5)
        assert b[key]["std_error"] == pytest.approx(r["std_error"], rel=1e-4)
        assert b[key]["log_lik"] == pytest.approx(r["log_lik"], abs=1e-5)


@pytest.fixture(scope="module")
def whole(df):
    return fitted(df)


def test_rows_and_groups_are_counted_exactly(whole):
    assert {(c, r["n"], r["n_groups"]) for (c, _), r in whole.items()} == {("small", 3600.0, 30), ("odd", 2160.0, 18), ("large", 720.0, 6)}


def test_passes_move_sums_per_cell_and_store_nothing(df, monkeypatch):
    keys, stored = [], []
    sum_by, checkpointed = mixed._sum_by, mixed.checkpointed
    monkeypatch.setattr(mixed, "_sum_by", lambda parts, by, *cols: keys.append(tuple(by)) or sum_by(parts, by, *cols))
    monkeypatch.setattr(mixed, "checkpointed", lambda frame: stored.append(frame.columns) or checkpointed(frame))
    fitted(df)
    assert len(keys) > 5 and set(keys) == {("cell",)}
    assert len(stored) == 1


def test_groups_that_go_over_batches(spark, df, whole):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert_same(whole, fitted(df))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("chunk", [25, 100_000])
def test_partitions_without_rows(spark, df, whole, monkeypatch, chunk):
    monkeypatch.setattr(mixed, "GROUP_CHUNK", chunk)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "97"}
    held = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert_same(whole, fitted(df))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_cells_with_whole_and_split_groups(df, whole, monkeypatch):
    """One cell has whole groups only, one split groups only; flags take more than one column."""
    monkeypatch.setattr(mixed, "GROUP_CHUNK", 25)
    monkeypatch.setattr(mixed, "WORD", 2)
    assert_same(whole, fitted(df))
