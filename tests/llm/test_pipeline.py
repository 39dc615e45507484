"""Every stage of the pipeline against what its operator says, on the smallest tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from cohortry.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    counts = [docs.count()]
    for name, stage in p.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == list(p.COLUMNS)
        counts.append(docs.count())
        if name != "personal_data":
            assert docs.exceptAll(before).count() == 0
    assert counts[0] >= counts[1] > counts[2] > counts[3] == counts[4]
    assert docs.filter(F.col("text").rlike("@mail[0-9]") | (F.length("text") != F.col("n_chars"))).count() == 0
    packed = p.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == counts[-1]


def test_stages_take_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in p.STAGES:
        assert stage(spark, docs, SF).count() == 0
