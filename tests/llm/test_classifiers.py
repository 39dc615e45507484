"""Classifiers by held-out accuracy on the test tables, and on odd inputs."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.llm.common import table
from cohortry.llm.labelled import labelled_sample
from cohortry.llm.quality import score_quality
from cohortry.llm.queries import QUERIES
from cohortry.llm.toxicity import Vectors, label_model, score_toxicity

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, score string"
ODD = [(None, None, None, "x"), (1, "", "en", None), (2, "z" * 50_000, "en", None), (2, "a b", None, None), (2, "a b", None, None), (3, "😀 é", None, None)]
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name, label, least", [("op5_toxicity", "toxic", 0.89), ("op6_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    got = QUERIES[name](spark, SF).join(table(spark, SF, "labels"), "doc_id").filter(f"held_out AND {label} IS NOT NULL")
    share, low, high = got.agg(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.min("score"), F.max("score")).first()
    assert share >= least and 0 <= low <= high <= 1


@pytest.mark.parametrize("fn", [score_toxicity, score_quality])
def test_odd_rows_and_missing_labels(spark, fn):
    docs = spark.createDataFrame(ODD, DOCS)
    for rows in ([], [(1, 1, 1)], [(1, 1, 1), (2, 0, 0), (None, 1, 1), (3, None, None)]):
        out = fn(docs, spark.createDataFrame(rows, LABELS))
        assert out.columns == ["doc_id", "text", "lang", "score"]
        assert out.count() == len(ODD) and out.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert fn(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_a_labelled_id_that_repeats_is_one_row_of_the_sample(spark):
    docs = spark.range(10_000).select((F.col("id") % 40 + 1).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.unionByName(spark.range(10_000).select(F.lit(2).alias("doc_id"), F.lit("same").alias("text")))
    labels = spark.range(1, 41).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    sample = labelled_sample(docs, labels, "toxic", 3, 1, 10).collect()
    assert len(sample) == len({r.id for r in sample}) == 10


def test_posteriors_come_from_the_votes():
    """Voters of known reliability: the model finds them, and no label is among its inputs."""
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.15
    on1, on0 = np.array([0.6, 0.5, 0.4, 0.3, 0.5, 0.05]), np.array([0.01, 0.02, 0.01, 0.03, 0.01, 0.05])
    votes = rng.random((4000, 6)) < np.where(truth[:, None], on1, on0)
    echoed = np.c_[votes, votes[:, 3], votes[:, 3]]
    for given in (votes, echoed):
        p = label_model(given, 0.15)
        assert ((p > 0.5) == truth).mean() > 0.9 and np.corrcoef(p, truth)[0, 1] > 0.75
    probes = np.array([[0] * 6, [0, 0, 0, 0, 0, 1], [1, 1, 0, 0, 0, 0]])
    none, useless, two = label_model(np.r_[votes, probes], 0.15)[-3:]
    assert none < 0.15 and useless < 0.2 and two > 0.9


def test_every_match_of_a_pattern_passes_its_quick_test():
    texts = [b"you are an idiot!", b"YOU such trash! no", b"f** off", b"a@# b", b"STOP THIS, SHOUTING! NOW", b"GO AWAY NOW", b"so!!!", b"calm words.", b"", b"x*#y $$"]
    vector = Vectors(np.array([1, 2], np.int64))
    for _, search, test in vector.patterns:
        assert all(test(t) for t in texts if search(t))
    fired = [[j - 2 for j in vector(t)[0].tolist() if 2 <= j < vector.width - 1] for t in texts]
    assert fired[0] == [0] and fired[6] == [3] and fired[7] == fired[8] == []
